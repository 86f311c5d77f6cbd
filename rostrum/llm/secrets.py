"""Secret scans by assignment-aware lexing.

Three base rules find keyword assignments, access keys and long hex strings.
The lexer then reads the text as source or configuration: names, operators
and literals. Every assignment becomes a name with its literals; a name on the
right stands for the literals that it was last given (constants propagate, also
through sums of strings). A literal is scored by how sensitive the names are
that it reaches, and by its own look (length, character classes, entropy,
placeholders). Literals at or above ``threshold`` and outside base spans are
added with kind ``literal``.

Defined results: a null text is empty and has no spans; repeated rows are
scanned alike; empty tables pass through. Whole texts are lexed in one pass,
linear in their length; columns beside id and text aren't read.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, as_batches, rows_of

# Fixed values of the base rules: pattern, and the smallest length of the given group.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")          # runs are maximal, so shorter ones can't hold a match
BASE = [("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24)]
KINDS = {kind: k for k, kind in enumerate(["assign", "access", "hex", "literal"])}

THRESHOLD = 0.6
#: Words of a target name and how sensitive they make it.
NAME_WORDS = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "secret": 1.0, "token": 0.9, "apikey": 1.0,
              "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "authorization": 0.8, "auth": 0.6, "signature": 0.7,
              "salt": 0.7, "dsn": 0.7}
#: Words of names whose literals may hold spaces.
PHRASE_WORDS = {"passphrase", "password", "passwd", "pwd", "pass"}
#: Pairs of neighbouring words.
NAME_PAIRS = {("api", "key"): 1.0, ("access", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0,
              ("signing", "key"): 0.9, ("encryption", "key"): 0.9, ("connection", "string"): 0.7}
PLACEHOLDERS = {"changeme", "password", "passwd", "secret", "token", "example", "placeholder", "none", "null", "true",
                "false", "default", "undefined", "required", "optional", "string", "your", "todo", "redacted", "test"}

# A target: a name (dashes may lead it) or quoted name at the start of a word, then an operator. Possessive, so each start is read once.
TARGET = re.compile(r"""(?<![\w.\-])-*+["']?(?P<name>[A-Za-z_$][\w.$\-]*+)["'\]]*+[ \t]*+(?P<op>:=|=>|==|=|:)(?![=/])[ \t]*+""", re.A)
# An operand of the right side: a quoted literal with escapes, or a bare word.
OPERAND = re.compile(r"""(?:[rbfuRBFU]{1,2})?(?:"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<t>[^`\n]*+)`)|(?P<bare>[^\s"'`,;(){}\[\]<>]++)""")
JOINED = re.compile(r"[ \t]*+\+[ \t]*+")
NAME = re.compile(r"[A-Za-z_$][\w.$\-]*", re.A)
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    words = [w.lower() for w in CAMEL.findall(name)]
    best = max((NAME_WORDS.get(w, 0.0) for w in words), default=0.0)
    return max([best, *(NAME_PAIRS.get(p, 0.0) for p in zip(words, words[1:]))])


def names_phrase(name: str) -> bool:
    """Can the literal of a target be a phrase?"""
    return any(w.lower() in PHRASE_WORDS for w in CAMEL.findall(name))


def literal_score(literal: str, phrase: bool = False) -> float:
    """How much a literal looks like a secret, 0 to 1; white space is fine in a phrase only."""
    n = len(literal)
    if n < 6 or not phrase and any(c.isspace() for c in literal):
        return 0.0
    words = [w.lower() for w in CAMEL.findall(literal)]
    if words and all(w in PLACEHOLDERS for w in words) or len(set(literal)) <= 2 or literal[0] in "<$%{":
        return 0.0
    counts = Counter(literal)
    entropy = -sum(k / n * math.log2(k / n) for k in counts.values())
    classes = sum(map(bool, (re.search("[a-z]", literal), re.search("[A-Z]", literal), re.search("[0-9]", literal),
                             re.search("[^A-Za-z0-9]", literal))))
    return min(1.0, 0.35 + 0.1 * classes + 0.08 * entropy + (0.15 if n >= 16 else 0.0))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind): leftmost matches of each rule that don't overlap, short ones dropped."""
    spans = []
    for kind, pattern, group, least in BASE:
        spans += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return spans


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str]]:
    """Literals that sensitive names are given, straight or through other names."""
    if "=" not in text and ":" not in text:
        return []
    # An assignment is a node with its own literals and the earlier assignments that it takes over: what it stands for
    # is never copied, so a name that is built up over many lines costs no more than its lines.
    given: dict[str, int] = {}                         # name: the assignment that it stands for
    nodes: list[tuple[list[tuple[int, int]], list[int]]] = []
    best: list[float] = []                             # the most sensitive name that an assignment reaches
    phrase: list[bool] = []                            # whether it reaches a name of phrases
    at = 0
    while target := TARGET.search(text, at):
        name, at = target["name"], target.end()
        values, taken = [], []
        while operand := OPERAND.match(text, at):
            group = operand.lastgroup
            a, b = operand.span(group)
            if group != "bare":
                values.append((a, b))
            else:
                while b > a and text[b - 1] in ".:!?":      # the end of a sentence isn't part of a word
                    b -= 1
                word = text[a:b]
                if word in given:
                    taken.append(given[word])
                elif group == "bare" and b > a and (not NAME.fullmatch(word) or target["op"] in ("=", ":=", ":")):
                    values.append((a, b))
            at = operand.end()
            more = JOINED.match(text, at)
            if not more:
                break
            at = more.end()
        if not values and not taken:
            continue
        given[name] = len(nodes)
        sensitive = name_score(name)
        nodes.append((values, taken))
        best.append(sensitive)
        phrase.append(bool(sensitive) and names_phrase(name))
    found = []
    for k in range(len(nodes) - 1, -1, -1):            # an assignment takes over earlier ones only
        values, taken = nodes[k]
        for earlier in taken:
            best[earlier] = max(best[earlier], best[k])
            phrase[earlier] |= phrase[k]
        if best[k]:
            found += [(a, b, "literal") for a, b in values if best[k] * literal_score(text[a:b], phrase[k]) >= threshold]
    return found


def scan(text: str | None, threshold: float = THRESHOLD) -> tuple[list, list]:
    """(base spans, all spans), each by start and then kind."""
    text = text or ""
    key = lambda s: (s[0], KINDS[s[2]], s[1])
    base = sorted(base_spans(text), key=key)
    added = [s for s in literal_spans(text, threshold) if not any(b[0] <= s[0] and s[1] <= b[1] for b in _near(base, s))]
    return base, sorted([*base, *added], key=key)


def _near(base: list, span: tuple) -> list:
    """Base spans that begin at or before the span's start; spans of a kind don't overlap, so few can hold it."""
    from bisect import bisect_right

    k = bisect_right(base, span[0], key=lambda b: b[0])
    found, kinds = [], set()
    while k and len(kinds) < 3:
        k -= 1
        if base[k][2] not in kinds:
            kinds.add(base[k][2])
            found.append(base[k])
    return found


def joined(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_documents(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal: a map over rows, no shuffle."""
    ddl = (f"{id_col} {docs.schema[id_col].dataType.simpleString()}, n_assign long, n_access long, n_hex long, "
           "base_sha256 string, spans string, n_literal long")
    schema = arrow_schema(ddl)

    def find(batches):
        def results():
            for key, text in rows_of(batches, [id_col, text_col]):
                base, spans = scan(text, threshold)
                n = Counter(kind for _, _, kind in spans)
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                yield key, n["assign"], n["access"], n["hex"], digest, joined(spans), n["literal"]
        yield from as_batches(results(), schema)

    return docs.select(id_col, text_col).mapInArrow(find, ddl)


def redact(text: str | None, threshold: float = THRESHOLD, mark: str = "[secret]") -> str | None:
    """The text with each run of overlapping spans replaced by ``mark``."""
    if not text:
        return text
    out, at, until = [], 0, -1
    for a, b, _ in scan(text, threshold)[1]:
        if a >= until:
            out += [text[at:a] if until < 0 else text[until:a], mark]
        until = max(until, b)
    return "".join([*out, text[until:]]) if until >= 0 else text


def redact_documents(docs: DataFrame, threshold: float = THRESHOLD, mark: str = "[secret]",
                     text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns; secrets in the text are replaced, and ``length_col`` is counted anew where it changed."""
    names = docs.columns

    def clean(batches):
        import pyarrow as pa

        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = [redact(t, threshold, mark) for t in batch.column(k).to_pylist()]
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, type=batch.schema.field(k).type))

    out = docs.mapInArrow(clean, docs.schema)
    if length_col in names:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.coalesce(F.length(text_col), F.lit(0)).cast(kind))
    return out.select(*names)
