"""Near-duplicates by SimHash with deletion-variant signatures.

Fingerprints: a bit is set if it is set in over half of the XXH64 values of the
word shingles, repeats counted.

Search: fingerprints are cut into fewer segments than there may be differing
bits, so that with at most ``distance`` of them one segment differs by at most
one bit: two segments for distances up to 3. A segment is indexed whole and as
each variant with one bit deleted; segments that differ by one bit meet in
that bit's variant, equal ones meet whole. Pairs that meet are verified on all
64 bits.

Scale: only distinct fingerprints are indexed. The fingerprints of a variant
form a bucket; what leaves its task is a star for each of its components, so
no bucket emits all its pairs. A bucket of more than ``block`` fingerprints is
dealt to blocks by a hash, and every pair of blocks is searched on its own:
nothing is capped, and no search holds more than two blocks.

Defined results: a null text is empty; a text without a word has the
fingerprint 0, which is linked like any other; fewer words than a shingle are
one shingle. Equal fingerprints are one component; a row with a null id takes
part, and a component's id is its smallest id that isn't null (null if it has
none). Empty tables give no rows.
"""
from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .common import arrow_schema, as_batches, rows_of
from .components import components

WORDS = 3
DISTANCE = 3
SEED = 42
BLOCK = 1024
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MOST = 1 << 14       # shingles counted at once


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a whole text."""
    from xxhash import xxh64_intdigest

    # bytes.split() parts at exactly the white space of [^\x20\x09-\x0D]+
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return 0
    if len(found) <= words:
        return xxh64_intdigest(b" ".join(found), seed)
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[words - 1:].tolist()
    total, counts = len(stops), np.zeros(64, np.int64)
    for at in range(0, total, MOST):
        hashes = np.array([xxh64_intdigest(line[a:b], seed) for a, b in zip(starts[at:at + MOST], stops[at:at + MOST])], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def with_fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED, text_col: str = "text",
                      name: str = "simhash") -> DataFrame:
    """All columns but the text, and the fingerprint as a long (the same 64 bits): a map, no shuffle."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name != text_col]
    out = StructType([*kept, StructField(name, LongType())])
    schema = to_arrow_schema(out)

    def add(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            prints = np.array([fingerprint(t, words, seed) for t in texts], np.uint64).view(np.int64)
            columns = [batch.column(batch.schema.get_field_index(f.name)).cast(s.type) for f, s in zip(kept, schema)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints)], schema=schema)

    return docs.mapInArrow(add, out)


def variants(prints: DataFrame, distance: int) -> DataFrame:
    """(key, rest, side, print): the segments of every fingerprint ``print``, whole and with each bit wiped out.

    ``key`` names the segment, or the wiped bit, whose value is ``side``.
    """
    segments = (distance + 2) // 2          # one of them differs by at most one bit
    keys = []

    def entry(key, mask, side):
        signed = mask - (1 << 64) if mask >> 63 else mask
        rest = F.col("print").bitwiseAND(F.lit(signed).cast("long"))
        return F.struct(F.lit(key).alias("key"), rest.alias("rest"), side.cast("int").alias("side"))

    for s in range(segments):
        low, high = 64 * s // segments, 64 * (s + 1) // segments
        mask = ((1 << (high - low)) - 1) << low
        keys.append(entry(64 + s, mask, F.lit(0)))
        for bit in range(low, high):
            keys.append(entry(bit, mask & ~(1 << bit), F.getbit("print", F.lit(bit))))
    return prints.select("print", F.explode(F.array(*keys)).alias("k")).select("k.key", "k.rest", "k.side", "print")


def stars(prints: np.ndarray, sides: np.ndarray, distance: int, across: bool) -> list[tuple[int, int]]:
    """Links of the components of close fingerprints, each to its component's smallest; ``across``: of different sides only."""
    order = np.argsort(prints, kind="stable")
    prints, sides = prints[order], sides[order]
    bits = prints.view(np.uint64)
    label = np.arange(len(prints))
    for i in range(len(prints)):
        close = np.bitwise_count(bits ^ bits[i]) <= distance
        if across:
            close &= sides != sides[i]
        met = np.unique(label[close])
        met = met[met != label[i]]
        if len(met):
            low = min(met[0], label[i])
            label[np.isin(label, met) | (label == label[i])] = low
    hung = np.flatnonzero(label != np.arange(len(prints)))
    return [(int(prints[i]), int(prints[label[i]])) for i in hung]


def _search(rows, distance: int):
    """Links of consecutive rows (key, rest, a, b, own, side, print) of a bucket's pair of blocks."""
    for (key, _, a, b), group in groupby(rows, key=itemgetter(0, 1, 2, 3)):
        group = list(group)
        across = key < 64
        if len(group) == 2:
            (*_, own, s, x), (*_, own2, t, y) = group
            if (not across or s != t) and ((x ^ y) & (1 << 64) - 1).bit_count() <= distance:
                yield max(x, y), min(x, y)
            continue
        prints = np.array([r[6] for r in group], np.int64)
        yield from stars(prints, np.array([r[5] for r in group]), distance, across)


def link_fingerprints(prints: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(u, v): links between distinct fingerprints ``print`` whose components are those of all close pairs."""
    if not 0 <= distance <= 15:
        raise ValueError("distance must be 0 to 15")
    indexed = variants(prints, distance)
    # Whole segments need two members; a wiped bit needs both its values, as equal segments meet whole.
    sizes = (indexed.groupBy("key", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("ones"))
             .filter("n > 1 and (key >= 64 or ones > 0 and ones < n)"))
    met = indexed.join(sizes.select("key", "rest", "n"), ["key", "rest"]).select(
        "key", "rest", "side", "print", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    # Blocks are dealt by a hash of the fingerprint; each row goes to its block's pairs with all blocks.
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("own")).alias("a"), F.greatest(k, F.col("own")).alias("b")))
    dealt = met.withColumn("own", own).withColumn("p", F.explode(pairs))
    order = ["key", "rest", "a", "b", "own", "side", "print"]
    dealt = dealt.select("key", "rest", "p.a", "p.b", "own", "side", "print")
    schema = arrow_schema("u long, v long")

    def search(batches):
        yield from as_batches(_search(rows_of(batches, order), distance), schema)

    return (dealt.repartition("key", "rest", "a", "b").sortWithinPartitions("key", "rest", "a", "b")
            .mapInArrow(search, "u long, v long"))


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(simhash, component) of distinct fingerprints ``simhash``: all that close pairs connect is one component."""
    of = components(link_fingerprints(prints.select(F.col("simhash").alias("print")), distance))
    joined = prints.select("simhash").join(of, prints["simhash"] == of["node"], "left")
    return joined.select("simhash", F.coalesce("component", "simhash").alias("component"))


def near_duplicates(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id of every row."""
    found = land(with_fingerprints(docs.select(id_col, text_col), words, seed, text_col), "simhash")
    prints = land(found.groupBy("simhash").agg(F.min(id_col).alias("least")), "prints")
    named = classes(prints, distance).join(prints, "simhash")
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("simhash", "component_id")
    return found.join(named, "simhash").select(
        id_col, F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each component, all columns as they are; of rows with that id, one."""
    names = docs.columns
    # own names inside: a user's column may have any
    held_ = [f"c{k}" for k in range(len(names))]
    key, text = held_[names.index(id_col)], held_[names.index(text_col)]
    numbered = docs.toDF(*held_).withColumn("row", F.monotonically_increasing_id()).withColumn("words", F.col(text))
    held = land(with_fingerprints(numbered, words, seed, "words"), "simhash")      # written, so row numbers stay
    first = F.struct(F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col("row").alias("row"))
    prints = land(held.groupBy("simhash").agg(F.min(first).alias("first")), "prints")
    kept = (classes(prints, distance).join(prints, "simhash").groupBy("component").agg(F.min("first").alias("first"))
            .select(F.col("first.row").alias("row")))
    return held.join(kept, "row", "left_semi").select(*held_).toDF(*names)
