"""Name-cleaning DataFrame transforms (job R2, family N).

Narrow plans: one parse projection plus a select; the optional file-name
exclusion is a filter on the stored column (pushed to the scan) or a
``left_anti`` join against a user table of names.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import spec_names as S
from ..functions.text import pstrip
from ..session import land
from .barrier import fence

# Candidate headers of the name column for profiles N1/N2 (fixed values).
NAME_COL_CANDIDATES = ["header_col_value", "full name", "full_name", "orig full name", "provider_full_name"]


def resolve_name_column(columns: Sequence[str]) -> str:
    """First column whose trimmed lower-case name is a candidate, else the first column."""
    cands = set(NAME_COL_CANDIDATES)
    for c in columns:
        if str(c).strip().lower() in cands:
            return c
    return columns[0]


def resolve_case_insensitive(columns: Sequence[str], wanted: str) -> str | None:
    by_lower = {c.lower(): c for c in columns}
    return by_lower.get(wanted.lower())


def _file_key(file_col: str) -> Column:
    return F.lower(pstrip(F.coalesce(F.col(file_col).cast("string"), F.lit(""))))


def _excluded_table(names: DataFrame, roster_file: str) -> DataFrame:
    """Distinct keys of a table of file names; the roster file is never among them."""
    keys = names.select(F.lower(pstrip(F.col("file_name"))).alias("__ex"))
    return keys.filter(F.col("__ex") != roster_file.lower()).distinct()


def _flagged(df: DataFrame, file_col: str, names: Iterable[str] | DataFrame, roster_file: str) -> DataFrame:
    """``df`` with ``__excluded``: whether ``exclude_files`` drops the row."""
    key = _file_key(file_col)
    if isinstance(names, DataFrame):
        ex = _excluded_table(names, roster_file)
        joined = df.withColumn("__key", key).join(ex, F.col("__key") == F.col("__ex"), "left")
        return joined.withColumn("__excluded", F.col("__ex").isNotNull()).drop("__key", "__ex")
    lowered = sorted({str(n).strip().lower() for n in names})
    return df.withColumn("__excluded", (key != roster_file.lower()) & key.isin(*lowered) if lowered else F.lit(False))


def exclude_files(df: DataFrame, file_col: str = "file_name", names: Iterable[str] | DataFrame = (),
                  roster_file: str = N.ROSTER_FILENAME) -> DataFrame:
    """Drop rows whose (trimmed, lower-case) file name is excluded; the roster
    file itself is never excluded.  ``names`` is a literal list (``isin``) or a
    DataFrame with a ``file_name`` column (``left_anti`` join; Spark broadcasts
    it when AQE measures it small)."""
    key = _file_key(file_col)
    protected = key == roster_file.lower()
    if isinstance(names, DataFrame):
        ex = _excluded_table(names, roster_file)
        tagged = df.withColumn("__key", key)
        return tagged.join(ex, tagged["__key"] == ex["__ex"], "left_anti").drop("__key")
    lowered = sorted({str(n).strip().lower() for n in names})
    if not lowered:
        return df
    return df.filter(protected | ~key.isin(*lowered))


def observe_exclusion(df: DataFrame, file_col: str = "file_name", names: Iterable[str] | DataFrame = (),
                      roster_file: str = N.ROSTER_FILENAME, name: str = "name_job"):
    """G4 as in-flight metrics: returns (observed DataFrame, Observation); the
    counts of input rows and rows the exclusion will drop are filled in when
    an action on the returned DataFrame (e.g. the write) completes. ``names`` as in ``exclude_files``."""
    from pyspark.sql import Observation
    obs = Observation(name)
    seen = _flagged(df, file_col, names, roster_file).observe(
        obs, F.count(F.lit(1)).alias("n_input"), F.count_if(F.col("__excluded")).alias("n_excluded"))
    return seen.drop("__excluded"), obs


def exclusion_counts(df: DataFrame, file_col: str = "file_name", names: Iterable[str] | DataFrame = (),
                     roster_file: str = N.ROSTER_FILENAME) -> DataFrame:
    """Rows in, rows excluded by file name, rows out (one global aggregate). ``names`` as in ``exclude_files``."""
    agg = _flagged(df, file_col, names, roster_file).agg(
        F.count(F.lit(1)).alias("n_input"), F.count_if(F.col("__excluded")).alias("n_excluded"))
    return agg.select("n_input", "n_excluded", (F.col("n_input") - F.col("n_excluded")).alias("n_output"))


def clean_names(df: DataFrame, profile: str = "credential_clean", value_col: str | None = None,
                file_col: str = "file_name", exclude: Iterable[str] | DataFrame = (),
                keep: Sequence[str] | None = None, designations: DataFrame | None = None,
                confidence: bool = False) -> DataFrame:
    """Parse a provider-name column; output layout follows the profile.

    ``designations`` (profile ``spec``): a table (token, kind, canonical) in place of the built-in lists, see
    ``token_dictionary``. ``confidence`` adds parse_rule and parse_confidence to the other profiles; ``spec`` always has
    them."""
    cols = df.columns
    if profile == "spec":
        return clean_spec_names(df, value_col or "header_col_value", designations)
    if designations is not None:
        raise ValueError("a designation table is read by profile 'spec' only; the other profiles have fixed lists")
    if confidence:
        return _with_confidence(df, profile, value_col, file_col, exclude, keep)
    if profile in ("degree_caps", "degree_dict"):
        src = value_col or resolve_name_column(cols)
        st = N.parse_degree_names(df, src, profile)
        outs = ["input_fullname", "firstname", "lastname", "middlename", "medical_degree", "organization"]
        return fence(st.result().select(*[F.col(f"`{c}`") for c in (keep or [])],
                                        *[F.col(f"__nm_{o}").alias(o) for o in outs]), outs)
    if profile == "format_detect":
        src = value_col or "header_col_value"
        if src not in cols:
            raise ValueError(f"Column '{src}' not found in DataFrame")
        st = N.detect_formats(df, src)
        outs = ["detected_format", "first_name_parsed", "middle_name_parsed", "last_name_parsed",
                "designation_parsed", "organization_parsed"]
        return fence(st.result().select(*[F.col(f"`{c}`") for c in cols],
                                        *[F.col(f"__fm_{o}").alias(o) for o in outs]), outs)
    if profile not in ("credential_org", "credential_list", "credential_clean"):
        raise ValueError(f"unknown name profile {profile!r}; expected one of {N.PROFILES}")
    src = resolve_case_insensitive(cols, value_col or "header_col_value")
    if src is None:
        raise ValueError(f"Column '{value_col or 'header_col_value'}' not found. Available: {cols}")
    outs = ["first_name", "middle_name", "last_name", "designation", "organization"]
    if profile == "credential_org":
        st = N.parse_credential_names(df, src, profile)
        others = [c for c in cols if c != src and c not in N_OUT]
        return fence(st.result().select(*[F.col(f"__cr_{o}").alias(o) for o in outs],
                                        *[F.col(f"`{c}`") for c in others]), outs)
    # credential_list / credential_clean: file-based organization + exclusion
    if file_col not in cols:
        df = df.withColumn(file_col, F.lit(""))
        cols = df.columns
    df = exclude_files(df, file_col, exclude)
    st = N.parse_credential_names(df, src, profile, file_col)
    others = [c for c in cols if c != src and c not in N_OUT]
    parsed = [F.col(f"__cr_{o}").alias(o) for o in outs]
    if profile == "credential_list":
        return fence(st.result().select(*parsed, *[F.col(f"`{c}`") for c in others]), outs)
    value = F.coalesce(F.col(f"`{src}`").cast("string"), F.lit("")).alias("header_col_value")
    return fence(st.result().select(value, *parsed,
                                    *[F.col(f"`{c}`") for c in others if c != "header_col_value"]), outs)


def token_dictionary(table: DataFrame, token_col: str = "token", kind_col: str = "kind", canonical_col: str = "canonical") -> DataFrame:
    """(key, designation, keyword, title): a user's table of tokens, one row a key.

    ``kind`` is designation, organization (a keyword) or title; a token may have several. Of several designations with one
    key the smallest counts."""
    kind, canonical = F.lower(pstrip(F.col(kind_col))), F.coalesce(F.col(canonical_col), F.col(token_col))
    return (table.groupBy(S.token_key(pstrip(F.col(token_col))).alias("key"))
            .agg(F.min(F.when(kind == S.DESIGNATION, canonical)).alias("canonical"),
                 F.max(kind == S.ORGANIZATION).alias("keyword"), F.max(kind == S.TITLE).alias("title"))
            .filter("key <> ''"))


def tag_tokens(df: DataFrame, value_col: str, dictionary: DataFrame) -> DataFrame:
    """``df`` with ``__tagged`` (see ``spec_names.tag_with_literals``), its tokens looked up in a ``token_dictionary``.

    Tokens are exploded with their places and joined by key, then regrouped by row: the dictionary may be of any size and
    is never collected; a frequent token is a skewed join key, which Spark splits. Rows are numbered and written first, so
    that a repeated task finds the same numbers."""
    rows = land(df.withColumn("__row", F.monotonically_increasing_id()), "names")
    parts = rows.select("__row", F.posexplode(S.value_parts(F.col(f"`{value_col}`").cast("string"))).alias("part", "p"))
    tokens = parts.select("__row", "part", F.col("p.text").alias("text"), F.posexplode("p.tokens").alias("place", "token"))
    known = tokens.withColumn("key", S.token_key(F.col("token"))).join(dictionary, "key", "left")
    canonical = F.when(S.written_as_listed(F.col("token"), F.col("canonical")), F.col("canonical"))
    tag = F.struct("place", F.struct("token", canonical.alias("designation"), F.coalesce("keyword", F.lit(False)).alias("keyword"),
                                     F.coalesce("title", F.lit(False)).alias("title")).alias("tag"))
    by_part = known.groupBy("__row", "part", "text").agg(F.array_sort(F.collect_list(tag)).alias("tags"))
    part = F.struct("part", F.struct("text", F.transform("tags", lambda t: t["tag"]).alias("tokens")).alias("p"))
    by_row = by_part.groupBy("__row").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    tagged = by_row.select("__row", F.transform("parts", lambda p: p["p"]).alias("__tagged"))
    joined = rows.join(tagged, "__row", "left").drop("__row")
    nothing = F.expr("array()").cast(tagged.schema["__tagged"].dataType)
    return joined.withColumn("__tagged", F.coalesce("__tagged", nothing))


def clean_spec_names(df: DataFrame, value_col: str = "header_col_value", designations: DataFrame | None = None) -> DataFrame:
    """Profile ``spec``: the columns of ``df`` (not those of its results) and ``spec_names.FIELDS``."""
    src = resolve_case_insensitive(df.columns, value_col)
    if src is None:
        raise ValueError(f"Column '{value_col}' not found. Available: {df.columns}")
    tagged = S.tag_with_literals(df, src) if designations is None else tag_tokens(df, src, token_dictionary(designations))
    others = [F.col(f"`{c}`") for c in df.columns if c not in S.FIELDS]
    return fence(S.assign(tagged, src).select(*others, *[F.col(f"__sp_{f}").alias(f) for f in S.FIELDS]), S.FIELDS)


#: parse_confidence of the other profiles by parse_rule, in percent; PUNCTUATION_COSTS less where a name part holds [,;/].
RULE_CONFIDENCE = {"empty": 0, "organization": 90, "last, first": 95, "first last": 90, "first middle last": 85,
                   "single name": 50, "no name found": 10}
PUNCTUATION_COSTS = 30


def parse_rule(value: Column, first: Column, middle: Column, last: Column, organization: Column, by_file: bool) -> Column:
    """Which rule a profile parsed a value by, told by the value and the parts found.

    ``by_file``: the organization is that of the file and says nothing about the value."""
    def found(c):
        return F.coalesce(pstrip(c) != "", F.lit(False))

    named = found(first) | found(last)
    organization_found = F.lit(False) if by_file else found(organization)
    return (F.when(~found(value), "empty").when(~named & organization_found, "organization").when(~named, "no name found")
            .when(found(first) & found(last) & value.contains(","), "last, first")
            .when(found(first) & found(last) & found(middle), "first middle last")
            .when(found(first) & found(last), "first last").otherwise("single name"))


def confidence_of(rule: Column, parts: Sequence[Column]) -> Column:
    percent = F.lit(0)
    for name, value in RULE_CONFIDENCE.items():
        percent = F.when(rule == name, F.lit(value)).otherwise(percent)
    marked = F.coalesce(F.concat_ws(" ", *parts).rlike("[,;/]"), F.lit(False)) & (percent > PUNCTUATION_COSTS)
    return (percent - F.when(marked, PUNCTUATION_COSTS).otherwise(0)) / F.lit(100.0)


#: Per profile the result columns for first, middle, last name and organization.
NAME_PARTS = {**dict.fromkeys(("degree_caps", "degree_dict"), ("firstname", "middlename", "lastname", "organization")),
              **dict.fromkeys(("credential_org", "credential_list", "credential_clean"), ("first_name", "middle_name", "last_name", "organization")),
              "format_detect": ("first_name_parsed", "middle_name_parsed", "last_name_parsed", "organization_parsed")}


def _with_confidence(df, profile, value_col, file_col, exclude, keep):
    if profile not in NAME_PARTS:
        raise ValueError(f"unknown name profile {profile!r}; expected one of {(*N.PROFILES, 'spec')}")
    wanted = value_col or ("header_col_value" if not profile.startswith("degree") else resolve_name_column(df.columns))
    src = resolve_case_insensitive(df.columns, wanted)
    if src is None:
        raise ValueError(f"Column '{wanted}' not found. Available: {df.columns}")
    valued = df.withColumn("__value", F.col(f"`{src}`").cast("string"))
    kept = [*(keep or []), "__value"] if profile.startswith("degree") else keep
    parsed = clean_names(valued, profile, src, file_col, exclude, kept)
    first, middle, last, organization = (F.col(c) for c in NAME_PARTS[profile])
    rule = parse_rule(F.col("__value"), first, middle, last, organization, profile in ("credential_list", "credential_clean"))
    return (parsed.withColumn("parse_rule", rule)
            .withColumn("parse_confidence", confidence_of(F.col("parse_rule"), [first, middle, last])).drop("__value"))


N_OUT = {"first_name", "middle_name", "last_name", "designation", "organization"}


def format_summary(parsed: DataFrame) -> DataFrame:
    """Counts per detected format (G5 summary over profile format_detect)."""
    return parsed.groupBy("detected_format").agg(F.count(F.lit(1)).alias("n_rows"))


def kind_summary(parsed: DataFrame) -> DataFrame:
    """persons / organizations / empty rows (G5) from any N3-N5 output."""
    kind = (F.when(F.col("organization") != "", F.lit("organization"))
            .when((F.col("first_name") != "") | (F.col("last_name") != ""), F.lit("person"))
            .otherwise(F.lit("ambiguous")))
    return parsed.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))


def parse_issues(parsed: DataFrame, value_col: str = "header_col_value", threshold: float | None = None) -> DataFrame:
    """Rows to review by hand, with a short reason (the "parsing issues" output
    the name job's specification asks for): empty input; neither a person name
    nor an organization found; punctuation left inside a name part.  Works on
    the output of the credential profiles (first/middle/last/organization).

    With a ``threshold``, on any profile with a confidence: the rows below it, the reason being their rule."""
    if threshold is not None:
        reason = F.concat(F.lit("low confidence: "), F.col("parse_rule"))
        return parsed.withColumn("reason", F.when(F.col("parse_confidence") < threshold, reason)).filter(F.col("reason").isNotNull())
    v = F.coalesce(F.col(f"`{value_col}`").cast("string"), F.lit(""))
    parts = [F.col("first_name"), F.col("middle_name"), F.col("last_name")]
    punct = F.lit(False)
    for c in parts:
        punct = punct | c.rlike(r"[,;/]")
    reason = (F.when(pstrip(v) == "", F.lit("empty input"))
              .when((F.col("first_name") == "") & (F.col("last_name") == "") & (F.col("organization") == ""),
                    F.lit("no person name or organization found"))
              .when(punct, F.lit("punctuation left in a name part")))
    return parsed.withColumn("reason", reason).filter(F.col("reason").isNotNull())
