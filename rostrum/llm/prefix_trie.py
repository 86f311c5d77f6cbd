"""The prefix trie of conversations, peeled from its deepest nodes up.

A node of depth d is a distinct sequence of d turns (role, text) with which at
least one conversation starts; the root is the empty sequence. A turn is told by
the first 128 bits of a SHA-256 over role and text, so a conversation's path is
16 bytes a turn, and texts themselves are never gathered.

Truncation peeling. Paths are sorted and dealt in ranges of (path, conv_id), read
in blocks. A block is peeled from its maximum depth down: at each depth the
conversations that end there are merged with the nodes that survived from below,
every node's counts are then complete, its row is written, its last turn is
stripped, and what is left is regrouped with equal sequences one depth up. Only
nodes on the path of a block's first or last row can go on in another block: they
aren't written or folded into their parents, but kept as survivors with the
counts that they have so far, at most two paths a block. Survivors are sorted,
dealt and peeled in the same way until one block holds them all. So every node is
found and counted in the one descent, a group of equal conversations or equal
first turns is spread over as many blocks as it fills, and neither a long
conversation nor a deep trie adds a shuffle of all rows.

The hash over the conversations that end in a node reads their ids in ascending
order; a node that lies in several blocks is hashed from the blocks' pieces of at
most ``BLOCK`` ids, in order, without holding more than a piece.

Defined results: turns are ordered by turn, null first, ties by role and then by
the digest of the turn; a null role or text is empty; a repeated row is a turn of
its own; rows without conv_id belong to no conversation; a conversation without
turns is a member of the root; an empty table has no node, not even a root. Long
texts count all their code points. Other columns of the input are ignored, whatever
their names. A conversation's turns are held in one row, 24 bytes a turn.
"""
from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import land
from .common import arrow_schema, as_batches, in_chunks, rows_of

BLOCK = 20_000        # rows that are peeled at a time
STEP = 16             # bytes of a turn in a path
NOTHING = hashlib.sha256(b"").hexdigest()

#: What a block hands on: kind 0 is a node, 1 a survivor, 2 a piece of a survivor's ids.
HANDED = ("kind int, path binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved long, ends string, lengths array<long>")


# ------------------------------------------------------------------ paths
def conversation_steps(turns: DataFrame) -> DataFrame:
    """(conv_id, steps) of every conversation; a step is (key, length): 128 bits as 32 hex digits, and code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * STEP)
    step = F.struct(F.col("turn"), role.alias("role"), key.alias("key"), F.length(text).cast("long").alias("length"))
    gathered = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    return gathered.select("conv_id", F.transform("steps", lambda s: F.struct(s["key"].alias("key"), s["length"].alias("length"))).alias("steps"))


def with_heads(conversations: DataFrame, most: int = 5, span: int = 100) -> DataFrame:
    """Conversations c rebuilt: the first h steps of conversation c - c % span, then c's own after its first h.

    h is crc32 of the decimal c modulo (most + 1). At most ``span`` conversations share a head."""
    heads = (conversations.filter(F.col("conv_id") % span == 0)
             .select(F.col("conv_id").alias("base"), F.slice("steps", 1, most).alias("head")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    based = conversations.withColumn("base", F.col("conv_id") - F.col("conv_id") % span).withColumn("h", h).join(heads, "base", "left")
    head = F.expr("coalesce(slice(head, 1, h), slice(steps, 1, 0))")
    return based.select("conv_id", F.concat(head, F.expr("slice(steps, h + 1, greatest(size(steps) - h, 0))")).alias("steps"))


def paths(conversations: DataFrame) -> DataFrame:
    """(path, lengths, conv_id) of conversations given by their steps."""
    return conversations.select(F.unhex(F.array_join(F.col("steps.key"), "")).alias("path"), F.col("steps.length").alias("lengths"), "conv_id")


# ------------------------------------------------------------------ peeling
class Node:
    __slots__ = ("path", "lengths", "conv_id", "n_convs", "children", "leaves", "saved", "below", "ids")

    def __init__(self, path, lengths, conv_id=None, n_convs=0, children=0, leaves=0, saved=0, ids=None):
        self.path, self.lengths = path, lengths        # lengths of the path's turns, more may follow
        self.conv_id, self.n_convs, self.children, self.leaves, self.saved = conv_id, n_convs, children, leaves, saved
        self.below: list[tuple] = []        # rows of finished children, which wait for their parent's conv_id
        self.ids = ids or []

    def add(self, conv_id, n_convs, children, leaves, saved, ids=()):
        if conv_id is not None and (self.conv_id is None or conv_id < self.conv_id):
            self.conv_id = conv_id
        self.n_convs += n_convs
        self.children += children
        self.leaves += leaves
        self.saved += saved
        self.ids.extend(ids)


def peel(ended: list[Node], last: bool, hashed: bool):
    """Peels a block of sorted nodes; yields rows of ``HANDED``.

    ``last``: no other block holds rows of these nodes. ``hashed``: the nodes are conversations, whose ids are hashed."""
    first_path, last_path = ended[0].path, ended[-1].path
    at = defaultdict(list)
    for node in ended:
        at[len(node.path) // STEP].append(node)
    survivors: dict[bytes, Node] = {}
    for depth in range(max(at), -1, -1):
        # newly ended conversations join the sequences that survived from below
        for node in at.pop(depth, ()):
            held = survivors.setdefault(node.path, node)
            if held is not node:
                held.add(node.conv_id, node.n_convs, node.children, node.leaves, node.saved, node.ids)
        regrouped: dict[bytes, Node] = {}
        for path, node in survivors.items():
            above = path[:-STEP]
            parent = regrouped.get(above)
            if parent is None and depth:
                parent = regrouped[above] = Node(above, node.lengths)
            whole = last or not (first_path.startswith(path) or last_path.startswith(path))
            for row in node.below:
                yield (0, row[0], None if whole else path, *row[1:3], node.conv_id if whole else None, *row[3:], None)
            joined = ",".join(map(str, node.ids))
            if not whole:
                yield (1, path, None, node.conv_id, depth, None, node.n_convs, node.children, node.leaves, node.saved, None, node.lengths[:depth])
                if node.ids:
                    yield (2, path, None, node.ids[0], depth, None, None, None, None, None, joined, None)
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n_convs - 1) * (node.lengths[depth - 1] if depth else 0)
            ends = hashlib.sha256(joined.encode()).hexdigest() if hashed else None
            row = (path, node.conv_id, depth, node.n_convs, node.children, leaves, saved, ends)
            if depth:
                parent.below.append(row)
                parent.add(node.conv_id, node.n_convs, 1, leaves, saved)
            else:
                yield (0, path, None, node.conv_id, 0, None, node.n_convs, node.children, leaves, saved, ends, None)
        survivors = regrouped


def _peeled(sorted_rows: DataFrame, block: int, last: bool, hashed: bool) -> DataFrame:
    schema = arrow_schema(HANDED)
    counts = [] if hashed else ["n_convs", "n_children", "n_leaves", "saved"]

    def run(batches):
        def handed():
            for part in in_chunks(rows_of(batches, ["path", "lengths", "conv_id", *counts]), block):
                if hashed:
                    nodes = [Node(bytes(path), lengths, c, 1, ids=[c]) for path, lengths, c in part]
                else:
                    nodes = [Node(bytes(path), lengths, c, *numbers) for path, lengths, c, *numbers in part]
                yield from peel(nodes, last, hashed)
        yield from as_batches(handed(), schema)

    return land(sorted_rows.mapInArrow(run, HANDED), "peeled")


def _ends(pieces: DataFrame) -> DataFrame:
    """(path, ends) from the pieces of the ids that end in a node."""
    schema = arrow_schema("path binary, ends string")

    def run(batches):
        def hashes():
            for path, parts in groupby(rows_of(batches, ["path", "text"]), key=lambda row: row[0]):
                digest = hashlib.sha256()
                for k, (_, text) in enumerate(parts):
                    digest.update(("," if k else "").encode() + text.encode())
                yield path, digest.hexdigest()
        yield from as_batches(hashes(), schema)

    dealt = pieces.repartition("path").sortWithinPartitions("path", "first")
    return dealt.mapInArrow(run, "path binary, ends string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of ``paths``-like rows (path, lengths, conv_id unique).

    path, conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = land(conversations.select("path", "lengths", "conv_id"), "paths")
    depth = rows.agg(F.max(F.size("lengths"))).first()[0] or 0
    block = max(block, 8 * (depth + 1))        # so that survivors, two paths a block at most, become fewer
    handed = _peeled(rows.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id"), block, False, True)
    rounds, kinds = [handed.filter("kind = 0")], []
    ends = _ends(handed.filter("kind = 2").select("path", F.col("conv_id").alias("first"), F.col("ends").alias("text")))
    while True:
        left = handed.filter("kind = 1")
        last = left.count() <= block
        dealt = left.coalesce(1) if last else left.repartitionByRange("path")
        handed = _peeled(dealt.sortWithinPartitions("path"), block, last, False)
        kinds.append(handed.filter("kind = 0"))
        if last:
            break
    late = kinds[0]
    for more in kinds[1:]:
        late = late.unionByName(more)
    late = land(late.drop("ends").join(ends, "path", "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING))), "nodes")
    nodes = rounds[0].unionByName(late)
    # the parents that were still unknown where their children were written lie in several blocks, so there are few of them
    known = late.select(F.col("path").alias("parent"), F.col("conv_id").alias("found"))
    nodes = nodes.join(known, "parent", "left")
    return nodes.select("path", "conv_id", "depth", F.coalesce("parent_conv_id", "found").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` of conversations as they are (without ``with_heads``), with the role and text of their last turn; null for the root."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * STEP)
    said = turns.filter("conv_id is not null").select(F.unhex(key).alias("key"), role.alias("role"), text.alias("text"))
    said = said.groupBy("key").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    held = nodes.withColumn("key", F.expr(f"if(depth > 0, substring(path, cast((depth - 1) * {STEP} + 1 as int), {STEP}), null)"))
    return held.join(said, "key", "left").drop("key")


def trie_of_conversations(turns: DataFrame, heads: bool = False, block: int = BLOCK) -> DataFrame:
    """The trie of a table of turns (conv_id, turn, role, text); with ``heads`` of the rebuilt conversations."""
    conversations = conversation_steps(turns)
    if heads:
        conversations = with_heads(land(conversations, "steps"))
    return prefix_trie(paths(conversations), block)
