"""Conversation prefix trie (operator 11).

Method. Turns become 16-byte codes, conversations sequences of codes, and equal
sequences one row with its members. The different sequences are range-sharded in
their order and cut into blocks; a block encodes its codes by a dictionary of its
own and builds a ternary search tree, into which the sorted sequences go by
medians, so that the trees of siblings are balanced. An iterative traversal lists
the nodes, and one pass backwards over the list accumulates members, leaves and
savings. Only the nodes on the paths of a block's first and last sequence can lie
in other blocks too: these are summed by prefix, and each pair of neighbouring
blocks takes back what both have counted along the path they share.

Scale. Texts never leave the scan: digests and lengths go on. Positions come from a
range sort over conversation and turn in two levels (the rows of a partition, then
of the few conversations that span partitions), so a conversation may hold any
share of the rows. Sequences hold at most ``LONG`` turns; the turns after them are
nodes of one member each and come straight from the rows, unless another
conversation shares all of the first ``LONG`` turns, in which case its whole
sequence of codes is one row. Ids of equal sequences are packed before they are
shuffled; their digest is a stream in one task, as SHA-256 is. A task holds one
block (about ``BLOCK`` turns) or one sequence.

Results in odd cases. Rows without a conversation id belong to no conversation and
are left out. Null role or text: empty. Turns of equal number are ordered by role,
then by code; a null number comes first; repeated rows are turns of their own. A
conversation without a turn after rebuilding is a member of the root alone. An
empty table has no node, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.scratch import table

CODE = 16
#: Turns of a sequence that travel as one row, and turns of a block.
LONG = 4096
BLOCK = 1 << 17
#: Conversations c of a block of SHARED_BY ids share the first turns of its first one, fewer than MOST_SHARED + 1.
SHARED_BY, MOST_SHARED = 100, 5
NO_ENDS = sha256(b"").hexdigest()

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PART = f"_kind int, _prefix binary, _parent binary, {_NODE}, _part int, _first binary, _last binary, _sizes binary, _closed boolean"
NODE_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]
WHOLE, SHARED, EDGE = 0, 1, 2


# --------------------------------------------------------------------------
# Sequences
# --------------------------------------------------------------------------

def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, code, n, pos): every turn with its place in its conversation, from 0."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    code = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, CODE)
    slim = rows.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), code.alias("code"), F.length(text).cast("long").alias("n"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("code")]
    # equal rows are interchangeable, so they may be spread by their place in the file
    ranged = slim.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    ranged = ranged.repartitionByRange(*order, F.col("_spread")).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = np.asarray(batch.column(0))
            if len(ids) == 0:
                continue
            new = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            runs = np.diff(np.append(new, len(ids)))
            local = np.arange(len(ids)) - np.repeat(new, runs)
            if ids[0] == last:
                local[: runs[0]] += seen
            last, seen = ids[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(local, pa.int64()), pa.array(np.full(len(ids), part), pa.int32())],
                names=["conv_id", "code", "n", "_local", "_part"],
            )

    found = ranged.select("conv_id", "code", "n").mapInArrow(number, "conv_id long, code binary, n long, _local long, _part int")
    found = table(found, "trie-turns")
    pieces = found.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    spread = pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_parts")).where("_parts > 1").select("conv_id")
    # a partition's edge lies in one conversation, so these are at most two rows a partition
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.join(spread, "conv_id").select("conv_id", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = found.join(F.broadcast(offsets), ["conv_id", "_part"], "left")
    return joined.select("conv_id", "code", "n", (F.col("_local") + F.coalesce("_before", F.lit(0))).alias("pos"))


def _shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (MOST_SHARED + 1)


def _heads(turns: DataFrame) -> DataFrame:
    """(_base, _head): the first turns of the conversations that others begin with, at most MOST_SHARED each."""
    first = turns.where((F.col("conv_id") % SHARED_BY == 0) & (F.col("pos") < MOST_SHARED))
    return first.groupBy(F.col("conv_id").alias("_base")).agg(F.sort_array(F.collect_list(F.struct("pos", "code", "n"))).alias("_head"))


def rebuilt(turns: DataFrame, longest: int | None = LONG, only: DataFrame | None = None) -> DataFrame:
    """(conv_id, key, sizes, total, shared): the rebuilt sequence of every conversation (of those in ``only``), cut after ``longest`` turns.

    key: the codes one after the other; sizes: code points of their texts;
    total: turns of the whole sequence; shared: how many come from the head.
    """
    h = _shared_turns(F.col("conv_id"))
    wanted = F.col("pos") >= h if longest is None else (F.col("pos") >= h) & (F.col("pos") < h + longest)
    own = turns if only is None else turns.join(only, "conv_id", "left_semi")
    own = own.groupBy("conv_id").agg((F.max("pos") + 1).alias("_len"), F.collect_list(F.when(wanted, F.struct("pos", "code", "n"))).alias("_own"))
    own = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % SHARED_BY, "_h": h.cast("int")})
    none = F.array().cast("array<struct<pos:bigint,code:binary,n:bigint>>")
    both = own.join(_heads(turns), "_base", "left").withColumn("_head", F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")))
    seq = F.concat("_head", F.sort_array("_own"))
    both = both.withColumn("_seq", seq if longest is None else F.slice(seq, 1, longest))
    return both.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("_seq", lambda x: F.hex(x["code"])), "")).alias("key"),
        F.transform("_seq", lambda x: x["n"]).alias("sizes"),
        (F.size("_head") + F.greatest(F.col("_len") - F.col("_h"), F.lit(0))).cast("long").alias("total"),
        F.size("_head").alias("shared"),
    )


def sequences(rows: DataFrame, longest: int = LONG) -> tuple[DataFrame, DataFrame | None]:
    """((conv_id, key, sizes, closed) of every conversation, the nodes after the cut of those that are cut)."""
    turns = numbered(rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text"))
    cut = table(rebuilt(turns, longest).withColumn("closed", F.col("total") <= longest), "trie-sequences")
    names = ["conv_id", "key", "sizes", "closed"]
    if cut.where("not closed").isEmpty():
        return cut.select(*names), None
    # a cut sequence stays cut where no other conversation has the same first turns
    alike = cut.where(F.col("total") >= longest).groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    deep = table(cut.where("not closed").join(alike, "key", "left_semi").select("conv_id"), "trie-deep")
    whole = rebuilt(turns, None, deep).withColumn("closed", F.lit(True))
    alone = cut.where("not closed").join(deep, "conv_id", "left_anti").select("conv_id", "total", "shared")
    h = _shared_turns(F.col("conv_id"))
    tail = turns.join(alone, "conv_id").where(F.col("pos") >= h).withColumn("depth", (F.col("pos") - h + F.col("shared") + 1).cast("long"))
    last = F.col("depth") == F.col("total")
    tails = tail.where(F.col("depth") > longest).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return cut.join(deep, "conv_id", "left_anti").select(*names).unionByName(whole.select(*names)), tails


# --------------------------------------------------------------------------
# Equal sequences
# --------------------------------------------------------------------------

def classes(seqs: DataFrame) -> DataFrame:
    """(key, sizes, closed, n, least, ends): one row for each different sequence, with its members' number, least id and digest."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, list[int]] = {}
            for i, (c, key, closed) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True)):
                groups.setdefault((key, closed), [i]).append(c)
            if groups:
                at = pa.array([g[0] for g in groups.values()], pa.int64())
                ids = [struct.pack(f"<{len(g) - 1}q", *g[1:]) for g in groups.values()]
                some = batch.take(at)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), some.column(3), pa.array(ids, pa.binary())], names=["_from", "key", "sizes", "closed", "_ids"])

    packed = seqs.select("conv_id", "key", "sizes", "closed").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    packed = packed.mapInArrow(pack, "_from long, key binary, sizes array<long>, closed boolean, _ids binary")
    # the packs of a sequence hold disjoint ranges of ids
    packed = packed.repartition("key").sortWithinPartitions("key", "closed", "_from")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, digest, done = None, None, None, []

        def close() -> None:
            if row:
                done.append((*row[:5], digest.hexdigest() if row[2] else NO_ENDS))

        def out() -> pa.RecordBatch:
            kinds = [pa.binary(), pa.list_(pa.int64()), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=["key", "sizes", "closed", "n", "least", "ends"])

        for batch in batches:
            for start, key, sizes, closed, ids in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if (key, closed) != now:
                    close()
                    now, row, digest = (key, closed), [key, sizes, closed, 0, start], sha256()
                ids = np.frombuffer(ids, "<i8")
                digest.update((b"," if row[3] else b"") + ",".join(map(str, ids.tolist())).encode())
                row[3] += len(ids)
            if done:
                yield out()
                done = []
        close()
        if done:
            yield out()

    return packed.mapInArrow(unite, "key binary, sizes array<long>, closed boolean, n long, least long, ends string")


# --------------------------------------------------------------------------
# The tree of a block
# --------------------------------------------------------------------------

class TernaryTree:
    """A ternary search tree of integer sequences; a node stands for the prefix that ends with its symbol.

    ``low`` and ``high`` lead to siblings, ``equal`` to the tree of the children. Node 0 is the root of the trie.
    """

    def __init__(self):
        self.symbol, self.low, self.equal, self.high = [-1], [-1], [-1], [-1]

    def _new(self, symbol: int) -> int:
        for column, v in ((self.symbol, symbol), (self.low, -1), (self.equal, -1), (self.high, -1)):
            column.append(v)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """Add a sequence; the node of its end."""
        at = 0
        for symbol in sequence:
            node, link, owner = self.equal[at], self.equal, at
            while node >= 0 and self.symbol[node] != symbol:
                link, owner = (self.low if symbol < self.symbol[node] else self.high), node
                node = link[owner]
            if node < 0:
                node = self._new(symbol)
                link[owner] = node
            at = node
        return at

    def insert_sorted(self, sequences: list[list[int]]) -> list[int]:
        """Add ascending sequences by medians, so that no tree of siblings is deeper than the logarithm of its size; the node of each."""
        ends, open_ = [0] * len(sequences), [(0, len(sequences))]
        while open_:
            lo, hi = open_.pop()
            if lo < hi:
                mid = (lo + hi) // 2
                ends[mid] = self.insert(sequences[mid])
                open_ += [(mid + 1, hi), (lo, mid)]
        return ends

    def preorder(self) -> tuple[list[int], list[int]]:
        """(nodes with every parent before its children and siblings ascending, parent of each node)."""
        order, parent = [], [-1] * len(self.symbol)
        stack = [(0, -1, False)]
        while stack:
            node, up, met = stack.pop()
            if not met and self.low[node] >= 0:
                stack += [(node, up, True), (self.low[node], up, False)]
                continue
            order.append(node)
            parent[node] = up
            if self.high[node] >= 0:
                stack.append((self.high[node], up, False))
            if self.equal[node] >= 0:
                stack.append((self.equal[node], node, False))
        return order, parent


def _prefix(key: bytes, depth: int) -> bytes:
    return sha256(key[: CODE * depth]).digest()[:CODE]


def block_nodes(rows: list[tuple]) -> list[tuple]:
    """Node rows of a block of ascending different sequences (key, sizes, closed, n, least, ends).

    Whole nodes are final but for the parent's id where the parent is shared;
    nodes on the paths of the first and last sequence are parts of sums.
    """
    codes = sorted({r[0][i : i + CODE] for r in rows for i in range(0, len(r[0]), CODE)})
    known = {c: i for i, c in enumerate(codes)}
    tree = TernaryTree()
    ends = tree.insert_sorted([[known[r[0][i : i + CODE]] for i in range(0, len(r[0]), CODE)] for r in rows])
    order, parent = tree.preorder()
    size = len(order)
    n, least, children, leaves, saved, depth, chars, digest, sample = [0] * size, [None] * size, [0] * size, [0] * size, [0] * size, [0] * size, [0] * size, [NO_ENDS] * size, [-1] * size
    for i, (end, row) in enumerate(zip(ends, rows, strict=True)):
        n[end], least[end], digest[end], sample[end] = row[3], row[4], row[5], i
        children[end] = 0 if row[2] else 1
        leaves[end] = children[end]  # the leaf below a cut
    for node in order[1:]:
        depth[node] = depth[parent[node]] + 1
    for node in reversed(order):
        if children[node] == 0:
            leaves[node] = 1
        i = sample[node]
        chars[node] = rows[i][1][depth[node] - 1] if depth[node] else 0
        saved[node] += (n[node] - 1) * chars[node]
        up = parent[node]
        if up >= 0:
            n[up] += n[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            sample[up] = i if sample[up] < 0 else sample[up]
    edge = set()
    for end in (ends[0], ends[-1]):
        while end >= 0:
            edge.add(end)
            end = parent[end]
    out = []
    for node in order:
        up, key = parent[node], rows[sample[node]][0]
        shared_parent = up in edge
        out.append(
            (
                SHARED if node in edge else WHOLE, _prefix(key, depth[node]) if node in edge else None, _prefix(key, depth[up]) if shared_parent else None,
                least[node], depth[node], None if up < 0 or shared_parent else least[up], n[node], children[node], leaves[node], saved[node], digest[node],
            )
        )
    return out


def corrections(last: tuple[bytes, bool], first: tuple[bytes, list[int]]) -> list[tuple]:
    """What two neighbouring blocks both count along the path that (key, closed) and (key, sizes) share."""
    a, b = last[0], first[0]
    both = 0
    while both < min(len(a), len(b)) // CODE and a[CODE * both : CODE * (both + 1)] == b[CODE * both : CODE * (both + 1)]:
        both += 1
    # a sequence that ends at the path's end was a leaf of its block and has a child in the next
    leaf = 1 if both == len(a) // CODE and last[1] else 0
    out, chars = [], 0
    for d in range(both, -1, -1):
        chars += first[1][d - 1] if d else 0
        out.append((SHARED, _prefix(b, d), None, None, d, None, 0, 0 if d == both else -1, -leaf, chars, None))
    return out


_KINDS = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
_PART_NAMES = [c.split()[0] for c in _PART.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r if len(r) == len(_KINDS) else (*r, None, None, None, None, None) for r in rows]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)], names=_PART_NAMES)


def shard_nodes(different: DataFrame, block: int = BLOCK) -> DataFrame:
    """The node rows of all blocks of all range shards, the corrections inside shards, and one edge row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns, before, head = [], 0, None, None
        for batch in _and_none(batches):
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True) if batch is not None else [None]:
                if held and (row is None or turns >= block):
                    nodes = block_nodes(held)
                    if before:
                        nodes += corrections(before, held[0])
                    head = head or held[0]
                    before = (held[-1][0], held[-1][2])
                    for at in range(0, len(nodes), 10_000):
                        yield _batch(nodes[at : at + 10_000])
                    held, turns = [], 0
                if row is not None:
                    held.append(row)
                    turns += 1 + len(row[0]) // CODE
        if before:
            sizes = np.array(head[1], "<i8").tobytes()
            yield _batch([(EDGE, *[None] * 10, TaskContext.get().partitionId(), head[0], before[0], sizes, before[1])])

    ranged = different.select("key", "sizes", "closed", "n", "least", "ends").repartitionByRange("key").sortWithinPartitions("key")
    return ranged.mapInArrow(run, _PART)


def _and_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _between_shards(edges: DataFrame) -> DataFrame:
    """The corrections of neighbouring shards; ``edges`` has one row a shard."""
    after = edges.select("_part", F.lead("_part").over(Window.orderBy("_part")).alias("_next"))
    first = edges.select(F.col("_part").alias("_next"), "_first", "_sizes")
    pairs = edges.select("_part", "_last", "_closed").join(after.where("_next is not null"), "_part").join(first, "_next")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _batch(corrections((r["_last"], r["_closed"]), (r["_first"], np.frombuffer(r["_sizes"], "<i8").tolist())))

    return pairs.select("_last", "_closed", "_first", "_sizes").mapInArrow(run, _PART)


def trie(rows: DataFrame, longest: int = LONG, block: int = BLOCK) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations in ``rows`` (conv_id, turn, role, text)."""
    seqs, tails = sequences(rows, longest)
    parts = table(shard_nodes(classes(seqs), block), "trie-nodes")
    shared = parts.where(F.col("_kind") == SHARED).drop("_part", "_first", "_last", "_sizes", "_closed")
    shared = shared.unionByName(_between_shards(parts.where(F.col("_kind") == EDGE)).select(shared.columns))
    merged = shared.groupBy("_prefix").agg(
        F.max("_parent").alias("_parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        # the members that end at a node stand in one block
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    merged = table(merged, "trie-shared")
    whole = parts.where(F.col("_kind") == WHOLE)
    open_ = whole.where(F.col("_parent").isNotNull()).select("_parent", *NODE_COLUMNS).unionByName(merged.select("_parent", *NODE_COLUMNS))
    owner = merged.select(F.col("_prefix").alias("_parent"), F.col("conv_id").alias("_owner"))
    named = open_.join(owner.hint("merge"), "_parent", "left").select(*[F.col("_owner").alias(c) if c == "parent_conv_id" else F.col(c) for c in NODE_COLUMNS])
    out = whole.where(F.col("_parent").isNull()).select(*NODE_COLUMNS).unionByName(named)
    return out.unionByName(tails.select(*NODE_COLUMNS)) if tails is not None else out
