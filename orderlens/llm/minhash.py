"""Near-duplicate documents by min-max hashing (operator 4).

Method. A text's set holds the hashes of its distinct five-word shingles. Under
each of 64 permutations both the minimum and the maximum are kept: 128
signature values from 64 hash evaluations, an unbiased estimate of the Jaccard
similarity with less variance than 128 independent minima. 32 bands of four
values (two minima, two maxima) give the candidates: two sets of similarity
0.75 share no band with probability 5e-6. Candidates whose estimate is far below
the threshold go; the others are confirmed on their full sets.

Scale. Texts are read once for signatures and once for the sets of candidates;
texts with equal sets become one node before any pairing, so a group of copies
costs one row. No step writes pairs. First *families* are found by signatures
alone: a band bucket is compared in blocks, each with the bucket's centre, that
emit no more links than unite their nodes. Then every node's set goes to its
family, in blocks that hold the family's centre too; a block compares sets until
its nodes are united and emits the links that do so. Nodes that are still apart
in a bucket or family of several blocks meet all of its blocks. A node whose shingles mostly occur nowhere else in its
block is not compared at all.

Results in odd cases. Null, empty and blank texts: no shingles, linked with
nothing, kept. Fewer words than a shingle: the whole sequence is one shingle.
Repeated rows: same component. A null id never names a component unless all
ids of it are null; such rows are kept. An empty table gives an empty result.
Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from orderlens.llm import textbatch as tb
from orderlens.llm.components import connected_components
from orderlens.llm.scratch import table

PERMUTATIONS = 64
BANDS = 32
#: Candidates with a lower estimate can't reach 0.75 (4 standard deviations).
LEAST_ESTIMATE = 0.60
#: Rows of a block of a bucket; rows and shingles of a block of a family; bits that mark the ids whose texts are fetched.
BLOCK = 4096
FAMILY_BLOCK, FAMILY_SHINGLES = 4096, 1 << 21
BITS = 1 << 24

_rng = np.random.Generator(np.random.PCG64(75))
_FACTOR = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2)


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tb.utf8(column)
    starts, ends, counts = tb.spans(data, offsets)
    return tb.distinct_sets(*tb.shingles(tb.hashes(data, starts, ends), counts, width))


def set_keys(values: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit key of each whole set, which sets have any element)."""
    key, full = np.zeros(len(per), np.uint64), per > 0
    if full.any():
        at = (np.cumsum(per) - per)[full]
        one = np.add.reduceat(values, at)
        two = np.add.reduceat(tb.mix64(values ^ np.uint64(0x5851F42D4C957F2D)), at)
        key[full] = tb.mix64(one * np.uint64(3) + tb.mix64(two))
    return key, full


def min_max(values: np.ndarray, per: np.ndarray) -> np.ndarray:
    """[texts, 2 * PERMUTATIONS] uint16: minima and maxima of each set, side by side."""
    full = per > 0
    at = (np.cumsum(per) - per)[full]
    out = np.zeros((len(per), 2 * PERMUTATIONS), np.uint16)
    if len(at) == 0:
        return out
    low, high = np.empty((len(at), PERMUTATIONS), np.uint64), np.empty((len(at), PERMUTATIONS), np.uint64)
    for k in range(PERMUTATIONS):
        x = (values ^ _MASK[k]) * _FACTOR[k]
        low[:, k] = np.minimum.reduceat(x, at)
        high[:, k] = np.maximum.reduceat(x, at)
    both = np.stack([tb.mix64(low), tb.mix64(high)], axis=2).reshape(len(at), -1)
    out[full] = (both >> np.uint64(48)).astype(np.uint16)
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(_id, _n, _key, _sig) of every row: set size, key of the set, min-max signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                values, per = shingle_sets(part.column(1), width)
                sig = min_max(values, per)
                key, full = set_keys(values, per)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(per, pa.int64()),
                        pa.array(key.view(np.int64), pa.int64(), mask=~full),
                        pa.array([s.tobytes() if f else None for s, f in zip(sig, full, strict=True)], pa.binary()),
                    ],
                    names=["_id", "_n", "_key", "_sig"],
                )

    schema = StructType(
        [
            StructField("_id", docs.schema[id_col].dataType),
            StructField("_n", LongType()),
            StructField("_key", LongType()),
            StructField("_sig", BinaryType()),
        ]
    )
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def _band(i: int):
    return F.xxhash64(F.lit(i), F.expr(f"substring(_sig, {8 * i + 1}, 8)"))


def _sets(docs: DataFrame, near: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(_key, _set) of the nodes in ``near``: the sorted hashes of the whole text's shingles.

    Only rows whose id hashes to a marked bit are shuffled; the bits are a table
    of at most BITS / 64 rows, whatever the number of nodes.
    """

    def bit(id_):
        return F.pmod(F.xxhash64(F.coalesce(F.col(id_).cast("string"), F.lit(""))), F.lit(BITS))

    def word(id_):
        return F.shiftright(bit(id_), 6)

    def mask(id_):
        return F.expr("shiftleft(1L, cast(_bit & 63 as int))")

    marked = near.withColumn("_bit", bit("_id")).groupBy(word("_id").alias("_word")).agg(F.bit_or(mask("_id")).alias("_marks"))
    marked = F.broadcast(table(marked, "marks"))  # at most BITS / 64 rows of 16 bytes
    found = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"))
    found = found.withColumns({"_bit": bit("_doc"), "_word": word("_doc")}).join(marked, "_word")
    found = found.where(F.col("_marks").bitwiseAND(mask("_doc")) != 0).select("_doc", "_text")
    found = found.join(near.select("_key", "_id").hint("merge"), F.col("_doc").eqNullSafe(F.col("_id")))
    return table(_own(found, width).dropDuplicates(["_key"]), "sets")


def _open(members: DataFrame, root: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components so far: with their component, and whether it is the bucket's largest."""
    known = members.select("_bucket", "_key").join(root.withColumnRenamed("node", "_key"), "_key", "left")
    known = table(known.select("_bucket", "_key", F.coalesce("root", "_key").alias("_in")), "known")
    sizes = known.groupBy("_bucket", "_in").agg(F.count(F.lit(1)).alias("_c"))
    mixed = sizes.groupBy("_bucket").agg(
        F.max(F.struct("_c", "_in")).alias("_main"), F.sum("_c").alias("_all"), F.count(F.lit(1)).alias("_k")
    )
    mixed = table(mixed.where("_k > 1").select("_bucket", F.col("_main._in").alias("_main"), F.col("_main._c").alias("_most"), "_all"), "mixed")
    return table(known.join(mixed, "_bucket").withColumn("_home", F.col("_in") == F.col("_main")).drop("_main"), "open")


def _grid(open_: DataFrame, payload: DataFrame, rows: str, most: str) -> DataFrame:
    """Each group as a grid of blocks of strays (members outside its largest component) and blocks of all members.

    ``rows`` and ``most`` are the numbers of blocks of strays and of members, as
    SQL over open_'s columns. A block in memory has about two blocks' rows.
    """
    both = open_.join(payload, "_key").withColumns({"_sb": F.expr(rows).cast("int"), "_mb": F.expr(most).cast("int")})
    value = next(c for c in payload.columns if c != "_key")
    own = F.pmod(F.xxhash64("_key"), F.lit(1 << 20))
    names = ["_bucket", "_key", "_in", value]
    stray = both.where("not _home").select(*names, F.lit(True).alias("_stray"), (own % F.col("_sb")).cast("int").alias("_s"), F.explode(F.sequence(F.lit(0), F.col("_mb") - 1)).alias("_m"))
    other = both.select(*names, F.lit(False).alias("_stray"), F.explode(F.sequence(F.lit(0), F.col("_sb") - 1)).alias("_s"), (own % F.col("_mb")).cast("int").alias("_m"))
    group = F.xxhash64("_bucket", "_s", "_m")
    return _grouped(stray.unionByName(other).select(group.alias("_group"), "_stray", "_key", "_in", F.col(value).alias("_value")))


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("_group").sortWithinPartitions("_group")


def _united(groups: DataFrame, compare, name: str) -> DataFrame:
    """(a, b): the links that unite the rows of each group, by ``compare(stray, value) -> function(i, others) -> linked``.

    ``groups`` is (_group, _stray, _key, _in, _value) sorted by group: a stray is
    compared with all rows of another component, until one component is left. At
    most one link a row leaves a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_groups(batches):
            stray, key = part.column(1).to_numpy(zero_copy_only=False), part.column(2).to_numpy()
            _, label = np.unique(part.column(3).to_numpy(), return_inverse=True)
            found = []
            linked = compare(part.column(4), stray)
            alone = stray.all()
            for i in np.flatnonzero(stray):
                # in a group of strays alone each pair is met once; else a stray meets the members, strays among them
                others = np.flatnonzero((label != label[i]) & ((key > key[i]) if alone else ~stray))
                others = others[linked(i, others)] if len(others) else others
                if len(others):
                    seen, first = np.unique(label[others], return_index=True)
                    found += [(key[i], key[j]) for j in others[first]]
                    label[np.isin(label, seen)] = label[i]
                if (label == label[0]).all():
                    break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return table(groups.mapInArrow(run, "a long, b long").distinct(), name)


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group, from batches sorted by their first column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        group = batch.column(0).to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        for lo, hi in zip(edges, edges[1:], strict=False):
            if held and held[0].column(0)[0].as_py() != group[lo]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _by_signature(values: pa.ChunkedArray, stray: np.ndarray):
    sig = np.frombuffer(b"".join(values.to_pylist()), np.uint16).reshape(len(stray), -1)
    return lambda i, others: (sig[others] == sig[i]).mean(axis=1) >= LEAST_ESTIMATE


def by_sets(percent: int):
    """Exact comparison: 100 * intersection >= percent * union of the full sets."""

    def compare(values: pa.ChunkedArray, stray: np.ndarray):
        sets = [np.frombuffer(x, np.uint64) for x in values.to_pylist()]
        size = np.array([len(x) for x in sets], np.int64)
        place, code = np.unique(np.concatenate(sets), return_inverse=True)
        times = np.bincount(code, minlength=len(place))
        starts = np.cumsum(size) - size
        # what occurs in no other row can't be shared; equal rows stand twice where a stray is a member too
        shared = np.add.reduceat((times > 1)[code].astype(np.int64), starts)
        able = 100 * shared >= percent * size
        mark = np.zeros(len(place), bool)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            good = np.zeros(len(others), bool)
            if not able[i]:
                return good
            near = np.flatnonzero(able[others] & (100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])))
            if len(near) == 0:
                return good
            own = code[starts[i] : starts[i] + size[i]]
            mark[own] = True
            if 2 * len(near) > len(size):
                common = np.add.reduceat(mark[code].astype(np.int64), starts)[others[near]]
            else:
                common = np.array([np.count_nonzero(mark[code[starts[j] : starts[j] + size[j]]]) for j in others[near]])
            mark[own] = False
            good[near] = 100 * common >= percent * (size[others[near]] + size[i] - common)
            return good

        return linked

    return compare


def _blocked(rows: DataFrame, group: str, centre: str, value: str) -> DataFrame:
    """Groups of rows (``group``, _blocks, _key, value) cut into _blocks blocks each, the group's ``centre`` in all of them."""
    every = F.sequence(F.lit(0), F.col("_blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("_key"), F.col("_blocks")).cast("int"))
    parts = rows.withColumn("_block", F.explode(F.when(F.col("_key") == F.col(centre), every).otherwise(own)))
    return _grouped(
        parts.select(F.xxhash64(group, "_block").alias("_group"), F.lit(True).alias("_stray"), "_key", F.col("_key").alias("_in"), F.col(value).alias("_value"))
    )


def _families(members: DataFrame, near: DataFrame) -> DataFrame:
    """(_key, _root) of the nodes that resemble another one by their signatures, through others too."""
    rows = members.withColumn("_blocks", F.ceil(F.col("_count") / BLOCK).cast("int"))
    links = _united(_blocked(rows.join(near.select("_key", "_sig"), "_key"), "_bucket", "_centre", "_sig"), _by_signature, "likely")
    wide = rows.where("_blocks > 1")
    if not wide.isEmpty():
        apart = _open(wide, connected_components(links))
        grid = _grid(apart, near.select("_key", "_sig"), f"ceil((_all - _most) / {BLOCK})", f"ceil(_all / {BLOCK})")
        links = links.unionByName(_united(grid, _by_signature, "likely"))
    return connected_components(links).withColumnRenamed("node", "_key").withColumnRenamed("root", "_root")


def _exact_links(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of full sets that unite what is linked within each family."""
    own = families.join(sets, "_key")
    # the blocks of a family: few enough rows and shingles each, whatever its size
    shape = own.groupBy("_root").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK), F.ceil(F.sum(F.octet_length("_set")) / (8 * FAMILY_SHINGLES))).cast("int").alias("_blocks")
    )
    shape = table(shape, "family-blocks")
    links = _united(_blocked(own.join(shape, "_root"), "_root", "_root", "_set"), by_sets(percent), "links")
    wide = shape.where("_blocks > 1")
    if wide.isEmpty():
        return links
    members = families.join(wide.select("_root"), "_root", "left_semi").select(F.col("_root").alias("_bucket"), "_key")
    apart = _open(members, connected_components(links)).join(wide.withColumnRenamed("_root", "_bucket"), "_bucket")
    rows = "greatest(1, ceil(_blocks * (_all - _most) / _all))"
    more = _united(_grid(apart, sets, rows, "_blocks"), by_sets(percent), "links")
    return links.unionByName(more)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) of every row of ``docs``; the bands are made for ``percent`` of 75 or more."""
    rows = table(signatures(docs, id_col, text_col, width), "signatures")
    nodes = rows.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_id").alias("_id"), F.first("_sig").alias("_sig"))
    nodes = table(nodes, "nodes")

    banded = nodes.select("_key", F.explode(F.array(*[_band(i) for i in range(BANDS)])).alias("_bucket"))
    shared = banded.groupBy("_bucket").agg(F.min("_key").alias("_centre"), F.count(F.lit(1)).alias("_count"))
    shared = table(shared.where("_count > 1"), "buckets")
    members = table(banded.join(shared.hint("merge"), "_bucket"), "members")
    near = table(members.select("_key").distinct().join(nodes, "_key"), "near")
    families = table(_families(members, near), "families")
    candidates = table(nodes.join(families.select("_key"), "_key", "left_semi"), "candidates")
    sets = _sets(docs, candidates, id_col, text_col, width)
    root = connected_components(_exact_links(families, sets, percent))

    part = nodes.select("_key", "_id").join(root.withColumnRenamed("node", "_key"), "_key")
    least = table(part.groupBy("root").agg(F.min("_id").alias("_least")), "least")
    linked = part.join(least, "root").select("_key", "_least")
    named = nodes.select("_key", "_id").join(linked, "_key", "left").select("_key", F.coalesce("_least", "_id").alias("_least"))
    named = table(named, "classes")
    full = rows.where(F.col("_key").isNotNull()).drop("_sig").join(named.hint("merge"), "_key")
    out = full.select("_id", "_n", "_least").unionByName(
        rows.where(F.col("_key").isNull()).select("_id", "_n", F.col("_id").alias("_least"))
    )
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_n").alias("n_shingles"),
        F.col("_least").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("_least")).alias("kept"),
    )


def _own(found: DataFrame, width: int) -> DataFrame:
    """(_key, _set) of the rows whose own set has the key: an id may repeat with other texts."""

    def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                values, per = shingle_sets(part.column(1), width)
                key, full = set_keys(values, per)
                own = full & (key.view(np.int64) == np.asarray(part.column(0)))
                ends = np.cumsum(per)
                sets = [values[ends[i] - per[i] : ends[i]].tobytes() for i in np.flatnonzero(own)]
                yield pa.RecordBatch.from_arrays([part.column(0).filter(pa.array(own)), pa.array(sets, pa.binary())], names=["_key", "_set"])

    return found.select("_key", "_text").mapInArrow(same, "_key long, _set binary")


def _numbered(docs: DataFrame, number: str) -> DataFrame:
    """``docs`` with a key of each row: its place in its file where ``docs`` is a scan of files, else a number in a written copy."""
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.withColumn(number, place)
    except AnalysisException:
        return table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near duplicates the one with the least id (null last).

    Rows are told apart by a number of their own, so ids may be null or repeat;
    rows without a word are linked with nothing and stay.
    """
    number = "_row"
    while number in docs.columns:
        number += "_"
    rows = _numbered(docs, number)
    found = near_duplicates(rows, number, text_col).select(F.col(number), "component_id")
    first = F.min(F.struct(F.col(id_col).isNull().alias("_no_id"), F.col(id_col).alias("_id"), F.col(number).alias("_number")))
    named = rows.select(F.col(id_col), F.col(number)).join(found, number)
    kept = named.groupBy("component_id").agg(first.alias("_first")).select(F.col("_first._number").alias(number))
    return rows.join(kept, number, "left_semi").select(*docs.columns)
