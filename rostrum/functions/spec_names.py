"""Profile ``spec``: person and organization in one value, a known list of designations, a confidence.

A value is cut into comma parts, a part into tokens. Every token is looked up in a
dictionary (designations, organization keywords, titles); every part gets a class:

* ``organization``: a keyword among its tokens, or a slash or parenthesis;
* ``credential``: all its tokens are known designations;
* ``person``: everything else.

An ordered assignment over the classes follows (``assign``). A token is a designation
where the dictionary has it, dots left out, and it is written as listed, in capitals
or in small letters; so "Ma" stays a name where "MA" is a designation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .literals import str_map
from .names import Stager, split_trailing
from .text import pstrip, squash_ws, strip_chars

# ---------------------------------------------------------------------------
# Fixed values (must equal the specification's lists)
# ---------------------------------------------------------------------------
DESIGNATIONS = ["MD", "MBBS", "DO", "PA", "RN", "PhD", "MBA", "BSc", "MSc", "Dr", "Esq", "Jr", "Sr", "I", "II", "III"]
ORGANIZATION_KEYWORDS = ["hospital", "clinic", "institute", "center", "university", "college", "trust", "inc", "ltd",
                         "association", "organization", "corp"]
# ---------------------------------------------------------------------------
TITLES = ["Dr", "Prof", "Mr", "Mrs", "Ms"]      # before a name

DESIGNATION, ORGANIZATION, TITLE = "designation", "organization", "title"
ENTITY_MARK = r"[/()]"                # a slash or parenthesis makes a part an organization
MIDDLE_INITIALS = r"^[A-Z]{1,2}$"     # last of three tokens: LastName FirstName MI

#: Which rule parsed the value, and how sure it is, in percent.
CONFIDENCE = {"empty": 0, "organization": 90, "credential only": 20, "last, first": 95, "first last": 90,
              "first middle last": 85, "last first initials": 60, "single name": 50}
UNASSIGNED_COSTS = 30                 # percent less where a part found no place

FIELDS = ["first_name", "middle_name", "last_name", "designation", "organization_name", "unassigned", "parse_rule", "parse_confidence"]


def token_key(token: Column) -> Column:
    """A token as the dictionary knows it: dots left out, small letters."""
    return F.lower(F.replace(token, F.lit("."), F.lit("")))


def value_parts(value: Column) -> Column:
    """Comma parts of a value: array of (text, tokens); parts without a token are dropped."""
    def part(text):
        found = F.regexp_extract_all(text, F.lit(r"(?U)[^\s;/()]+"), F.lit(0))
        tokens = F.filter(F.transform(found, lambda t: strip_chars(t, ".,;")), lambda t: t != "")
        return F.struct(strip_chars(pstrip(text), ";").alias("text"), tokens.alias("tokens"))
    parts = F.transform(F.split(squash_ws(F.coalesce(value, F.lit(""))), ",", -1), part)
    return F.filter(parts, lambda p: F.size(p["tokens"]) > 0)


def built_in_dictionary() -> tuple[Column, Column, Column]:
    """Lookups by token key: designation, organization keyword, title (literals; Catalyst folds them)."""
    def lookup(words):
        return str_map({w.replace(".", "").lower(): w for w in words})
    return lookup(DESIGNATIONS), lookup(ORGANIZATION_KEYWORDS), lookup(TITLES)


def written_as_listed(token: Column, canonical: Column) -> Column:
    plain, listed = F.replace(token, F.lit("."), F.lit("")), F.replace(canonical, F.lit("."), F.lit(""))
    return F.coalesce((plain == listed) | (plain == F.upper(plain)) | (plain == F.lower(plain)), F.lit(False))


def tag_with_literals(df: DataFrame, src: str) -> DataFrame:
    """``df`` with ``__tagged``: array of (text, tokens: array of (token, designation, keyword, title)) of column ``src``."""
    designation, keyword, title = built_in_dictionary()

    def tag(token):
        canonical = F.try_element_at(designation, token_key(token))
        return F.struct(token.alias("token"), F.when(written_as_listed(token, canonical), canonical).alias("designation"),
                        F.map_contains_key(keyword, token_key(token)).alias("keyword"),
                        F.map_contains_key(title, token_key(token)).alias("title"))
    parts = value_parts(F.col(f"`{src}`").cast("string"))
    return df.withColumn("__tagged", F.transform(parts, lambda p: F.struct(p["text"].alias("text"),
                                                                           F.transform(p["tokens"], tag).alias("tokens"))))


def assign(df: DataFrame, src: str) -> DataFrame:
    """Columns ``__sp_<field>`` of FIELDS from ``__tagged``, by class:

    first part an organization, or no person but an organization -> the whole value is the organization;
    two persons or more -> last name, then given names; further person parts find no place;
    one person -> First Last, First Middle Last, Last First MI (three tokens, the last of one or two capitals) or a
    single first name; organizations behind a person are its organization; designations are collected in order.
    Before a name titles, behind it designations are taken off, as long as a token of the name is left.
    """
    value = F.col(f"`{src}`").cast("string")

    def kind(part):
        organization = part["text"].rlike(ENTITY_MARK) | F.exists(part["tokens"], lambda t: t["keyword"])
        return F.when(organization, F.lit(ORGANIZATION)).when(
            F.forall(part["tokens"], lambda t: t["designation"].isNotNull()), F.lit("credential")).otherwise(F.lit("person"))

    st = Stager(df, "sp")
    a = st.add(parts=F.transform(F.col("__tagged"), lambda p: F.struct(kind(p).alias("kind"), p["text"].alias("text"),
                                                                       p["tokens"].alias("tokens"))))
    b = st.add(persons=F.filter(a.parts, lambda p: p["kind"] == "person"),
               organizations=F.transform(F.filter(a.parts, lambda p: p["kind"] == ORGANIZATION), lambda p: p["text"]),
               credentials=F.flatten(F.transform(F.filter(a.parts, lambda p: p["kind"] == "credential"), lambda p: p["tokens"])),
               first_kind=F.try_element_at(a.parts, F.lit(1))["kind"])
    none = F.filter(b.credentials, lambda t: F.lit(False))

    def without_titles(tokens):
        n = F.size(tokens)
        behind = F.array_min(F.transform(tokens, lambda t, i: F.when(~t["title"], i)))
        skip = F.least(F.coalesce(behind, n), F.greatest(n - 1, F.lit(0)))
        return F.slice(tokens, F.lit(1), skip), F.slice(tokens, skip + 1, F.greatest(n - skip, F.lit(0)))

    one, two = (F.coalesce(F.try_element_at(b.persons, F.lit(i))["tokens"], none) for i in (1, 2))
    c = st.add(one=one, two=two)
    (t1, r1), (t2, r2) = without_titles(c.one), without_titles(c.two)
    d = st.add(t1=t1, r1=r1, t2=t2, r2=r2)

    def core_of(tokens):
        first = F.slice(tokens, 1, F.least(F.lit(1), F.size(tokens)))
        head, tail = split_trailing(F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0))), lambda t: t["designation"].isNotNull())
        return F.transform(F.concat(first, head), lambda t: t["token"]), tail

    (h1, e1), (h2, e2) = core_of(d.r1), core_of(d.r2)
    e = st.add(h1=h1, e1=e1, h2=h2, e2=e2)
    persons, n1 = F.size(b.persons), F.size(e.h1)
    empty = F.size(a.parts) == 0
    organization = (b.first_kind == ORGANIZATION) | ((persons == 0) & (F.size(b.organizations) > 0))
    initials = (n1 == 3) & F.try_element_at(e.h1, F.lit(3)).rlike(MIDDLE_INITIALS)
    f = st.add(rule=F.when(empty, "empty").when(organization, "organization").when(persons == 0, "credential only")
               .when(persons >= 2, "last, first").when(n1 == 1, "single name").when(n1 == 2, "first last")
               .when(initials, "last first initials").otherwise("first middle last"))

    def at(tokens, i):
        return F.try_element_at(tokens, F.lit(i))

    def middle(tokens, start, left_out):
        n = F.greatest(F.size(tokens) - left_out, F.lit(0))
        return F.array_join(F.slice(tokens, start, n), " ")

    def by_rule(**values):
        chain = F.when(F.lit(False), F.lit(None).cast("string"))
        for rule, v in values.items():
            chain = chain.when(f.rule == rule.replace("__", ", ").replace("_", " "), v)
        return F.nullif(chain, F.lit(""))

    marks = F.concat(*[F.filter(x, lambda t: t["designation"].isNotNull()) for x in (d.t1, e.e1, d.t2, e.e2, b.credentials)])
    is_organization = f.rule == "organization"
    left = F.array_join(F.transform(F.slice(b.persons, 3, F.greatest(persons - 2, F.lit(0))), lambda p: p["text"]), ", ")
    g = st.add(unassigned=F.when(~is_organization, F.nullif(left, F.lit(""))))
    score = F.lit(0)
    for rule, percent in CONFIDENCE.items():
        score = F.when(f.rule == rule, F.lit(percent)).otherwise(score)
    st.add(first_name=by_rule(last__first=at(e.h2, 1), first_last=at(e.h1, 1), first_middle_last=at(e.h1, 1),
                              last_first_initials=at(e.h1, 2), single_name=at(e.h1, 1)),
           middle_name=by_rule(last__first=middle(e.h2, 2, 1), first_middle_last=middle(e.h1, 2, 2), last_first_initials=at(e.h1, 3)),
           last_name=by_rule(last__first=F.array_join(e.h1, " "), first_last=at(e.h1, 2), first_middle_last=at(e.h1, -1),
                             last_first_initials=at(e.h1, 1)),
           designation=F.when(~is_organization, F.nullif(F.array_join(F.array_distinct(
               F.transform(marks, lambda t: t["designation"])), ", "), F.lit(""))),
           organization_name=F.when(is_organization, pstrip(value)).otherwise(F.nullif(F.array_join(b.organizations, ", "), F.lit(""))),
           parse_rule=f.rule,
           parse_confidence=(score - F.when(g.unassigned.isNotNull(), UNASSIGNED_COSTS).otherwise(0)) / F.lit(100.0))
    return st.result()
