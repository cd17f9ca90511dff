"""Near-duplicate embeddings by a robust-pruned flat graph (operator 5).

Method. Distinct vectors are dealt to overlapping cluster shards: each goes to
the shards of its nearest centroids. In every shard a flat graph is built: each
vector's nearest ones, robustly pruned (a neighbour that is closer to a kept
neighbour than to the vector itself, by a factor, is left out) and made
symmetric. Pruning looks at the nearest ones only, so edges are added until
every vector has, for each other one within the radius, an edge to it or to a
vector nearer to it. The adjacency lists of a vector in several shards are
united. The search for a vector's links starts at the vector and expands every
one found within the radius until none is left: from each of its links a path
of ever nearer vectors leads to it, so the search misses no link of a shard.
Every link is verified by its cosine in double precision. The recall is audited
against brute force: all vectors whose id is divisible by 100 are queries against
all vectors, in blocks, and other vectors are counted, not their copies; below
``LEAST_RECALL`` the search is repeated with wider overlaps, and fails if that
does not do.

Scale. Copies become one vector with a count before anything else. Centroids
come from a bounded sample. A shard holds a bounded number of vectors: one that
is too large is divided anew by centroids of its own, with the same overlap. A
link is counted in the smallest shard both ends share, so nothing is counted
twice and pairs never leave a task; counts and spanning links do.

Results in odd cases. A vector that is null, zero, of another length than most,
or holds null or non-finite components links with nothing and is kept. Repeated
rows and equal directions of equal components are links of each other. Null ids
take part and never name a component unless all its ids are null. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from orderlens.llm.components import connected_components
from orderlens.llm.scratch import table

LEAST = 0.9
#: Vectors of the sample that centroids are drawn from, most centroids of a level, vectors aimed at in a shard.
SAMPLE = 20_000
MOST_CENTROIDS = 1024
SHARD = 1500
#: A vector also goes to every shard whose centroid is this close (in cosine) to its nearest one, to MOST_SHARDS at most.
SLACK = 0.12
MOST_SHARDS = 4
#: Cosine from which two centroids are one: wider than the radius of a link.
APART = 0.8
#: Degree before symmetry and the added edges, the pruning factor.
DEGREE, ALPHA = 24, 1.2
#: Cosine from which vectors are joined by a star: nearer ones can't be told from rounding.
SAME = 1 - 1e-9
#: A vector counts as nearer than another one from this difference in cosine.
NEARER = 1e-12
#: Queries searched together, and vectors expanded together.
QUERIES_AT_ONCE, EXPANDED_AT_ONCE = 256, 1 << 15
#: Levels of centroids, shards divided in a pass, and queries that the audit compares at once.
LEVELS, DIVIDED, AUDIT_BLOCK = 3, 64, 4096
LEAST_RECALL = 0.9


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centroids(sample: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of unit vectors, from evenly spaced starts."""
    c = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1)
        c[norm > 0] = total[norm > 0] / norm[norm > 0, None]
    return apart(c)


def apart(c: np.ndarray) -> np.ndarray:
    """The centroids that are not within APART of an earlier one: no group of near vectors is cut between several."""
    kept = np.zeros(0, np.int64)
    for k in range(len(c)):
        if not len(kept) or (c[kept] @ c[k]).max() < APART:
            kept = np.append(kept, k)
    return c[kept]


def nearest(vectors: np.ndarray, c: np.ndarray, wider: int = 1) -> list[list[int]]:
    """The clusters of each vector: its nearest one and those about as near."""
    out = []
    for i in range(0, len(vectors), 4096):
        sim = vectors[i : i + 4096] @ c.T
        top = np.argsort(-sim, axis=1, kind="stable")[:, : wider * MOST_SHARDS]
        value = np.take_along_axis(sim, top, axis=1)
        good = value >= value[:, :1] - wider * SLACK
        good[:, :2] = True  # always two, so that shards overlap
        out += [sorted(t[g].tolist()) for t, g in zip(top, good, strict=True)]
    return out


def _top(sim: np.ndarray, pool: int) -> np.ndarray:
    """The columns of the ``pool`` largest values of each row, largest first.

    Every row is cut at a bar drawn from some of its columns; rows with fewer
    than ``pool`` values above theirs are partitioned whole.
    """
    n = sim.shape[1]
    near = np.empty((len(sim), pool), np.int64)
    rest = np.arange(len(sim))
    if n > 8 * pool:
        some = sim[:, :: max(1, n // 512)]
        rank = math.ceil(2.5 * pool * some.shape[1] / n)
        above = sim >= np.partition(some, some.shape[1] - rank, axis=1)[:, some.shape[1] - rank, None]
        count = above.sum(axis=1)
        above &= (count >= pool)[:, None] & (count <= 8 * pool)[:, None]
        cell = np.flatnonzero(above)
        r = cell // n
        count = np.bincount(r, minlength=len(sim))
        fine = np.flatnonzero(count)
        if len(fine):
            at = np.repeat(np.arange(len(fine)), count[fine])
            place = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
            value = np.full((len(fine), count.max()), -np.inf, sim.dtype)
            column = np.zeros(value.shape, np.int64)
            value[at, place] = sim.ravel()[cell]
            column[at, place] = cell - r * n
            near[fine] = np.take_along_axis(column, np.argsort(-value, axis=1)[:, :pool], axis=1)
            rest = np.setdiff1d(rest, fine)
    if len(rest):
        part = np.argpartition(-sim[rest], pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(sim[rest], part, axis=1), axis=1, kind="stable")
        near[rest] = np.take_along_axis(part, order, axis=1)
    return near


def _pruned(vectors: np.ndarray, cand: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which candidates (nearest first, at distances ``own``) robust pruning keeps in each row."""
    x = vectors[cand]
    among = 1 - x @ x.transpose(0, 2, 1)
    kept, count = np.ones(cand.shape, bool), np.zeros(len(cand), np.int64)
    for k in range(cand.shape[1]):
        kept[:, k] &= count < DEGREE
        here = kept[:, k]
        count += here
        kept[:, k + 1 :] &= ~here[:, None] | (ALPHA * among[:, k, k + 1 :] > own[:, k + 1 :])
    return kept


def build(vectors: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of a shard: nearest neighbours, robustly pruned; the nearest one comes first."""
    n = len(vectors)
    pool = min(n - 1, 3 * DEGREE)
    if pool <= 0:
        return [np.zeros(0, np.int64) for _ in range(n)]
    # the lists propose edges only, single precision does: links are found in double precision
    v = vectors.astype(np.float32)
    few, out = min(pool, DEGREE + DEGREE // 3), []
    for lo in range(0, n, 512):
        sim = v[lo : lo + 512] @ v.T
        rows = np.arange(len(sim))
        sim[rows, lo + rows] = -np.inf
        near = _top(sim, pool)
        own = 1 - np.take_along_axis(sim, near, axis=1)
        kept = np.zeros(near.shape, bool)
        kept[:, :few] = _pruned(v, near[:, :few], own[:, :few])
        # the later candidates count where the first ones leave room
        open_ = np.flatnonzero(kept.sum(axis=1) < DEGREE)
        if few < pool and len(open_):
            kept[open_] = _pruned(v, near[open_], own[open_])
        out += np.split(near[kept], np.cumsum(kept.sum(axis=1))[:-1])
    return out


def _distinct(numbers: np.ndarray) -> np.ndarray:
    numbers = np.sort(numbers)
    return numbers[np.diff(numbers, prepend=-1) != 0]


def _edges(vectors: np.ndarray, near: list[np.ndarray], least: float) -> np.ndarray:
    """The edges i * n + j, sorted, of ``near`` made symmetric and ``completed``."""
    n = len(vectors)
    i, j = np.repeat(np.arange(n), [len(x) for x in near]), np.concatenate([np.zeros(0, np.int64), *near])
    edges = _distinct(np.concatenate([i * n + j, j * n + i]))
    # only vectors whose nearest one is within the radius can miss an edge; single precision chose it
    some = np.flatnonzero([len(x) > 0 for x in near])
    best = np.array([near[k][0] for k in some], np.int64)
    some = some[np.einsum("ij,ij->i", vectors[some], vectors[best]) >= min(least, SAME) - 1e-5]
    if not len(some):
        return edges
    v, m = vectors[some], len(some)
    place = np.full(n, -1)
    place[some] = np.arange(m)
    a, b = place[edges // n], place[edges % n]
    a, b = a[(a >= 0) & (b >= 0)], b[(a >= 0) & (b >= 0)]
    both = [set(x.tolist()) for x in np.split(b, np.searchsorted(a, np.arange(1, m)))]
    star = np.arange(m)
    for lo in range(0, m, 1024):
        star[lo : lo + 1024] = np.minimum(star[lo : lo + 1024], (v[lo : lo + 1024] @ v.T >= SAME).argmax(axis=1))
    for i in np.flatnonzero(star != np.arange(m)).tolist():
        both[i].add(int(star[i]))
        both[star[i]].add(i)
    for lo in range(0, m, 1024):
        sims = v[lo : lo + 1024] @ v.T
        for i, sim in enumerate(sims, lo):
            known = np.fromiter(both[i], np.int64, len(both[i]))
            wanted = (sim >= least - 1e-9) & (star != star[i])
            wanted[known] = False
            ball = np.flatnonzero(wanted)
            if len(ball) == 0:
                continue
            bar = sim[ball] + NEARER
            missed = np.ones(len(ball), bool)
            for k in range(0, len(known), 64):
                left = np.flatnonzero(missed)
                missed[left] = (v[known[k : k + 64]] @ v[ball[left]].T).max(axis=0) <= bar[left]
            while missed.any():
                left = np.flatnonzero(missed)
                k = left[sim[ball[left]].argmax()]
                j = int(ball[k])
                both[i].add(j)
                both[j].add(i)
                missed[left] = v[ball[left]] @ v[j] <= bar[left]
                missed[k] = False
    a = np.repeat(np.arange(m), [len(x) for x in both])
    b = np.fromiter((y for x in both for y in x), np.int64, len(a))
    return _distinct(np.concatenate([edges, some[a] * n + some[b]]))


def completed(vectors: np.ndarray, near: list[np.ndarray], least: float) -> list[np.ndarray]:
    """``near`` (from ``build``) made symmetric, with the edges that a search within ``least`` needs to miss nothing.

    Afterwards each vector has, for every other one within the radius, an edge
    to it or to a vector that is nearer to it. Vectors that are the same but for
    rounding hang on the first one of them.
    """
    n = len(vectors)
    edges = _edges(vectors, near, least)
    return np.split(edges % n, np.searchsorted(edges, np.arange(1, n) * n))


def search(vectors: np.ndarray, links: np.ndarray, least: float) -> list[np.ndarray]:
    """The vectors within ``least`` of each vector, itself included, by range expansion from it.

    ``links`` is [n, degree], padded with -1. The queries of a block step
    together, and each expands all it has found within the radius and not yet
    expanded.
    """
    n, found = len(vectors), []
    for lo in range(0, n, QUERIES_AT_ONCE):
        own = np.arange(lo, min(n, lo + QUERIES_AT_ONCE))
        rows = np.arange(len(own))
        seen = np.zeros((len(own), n), bool)
        seen[rows, own] = True
        good = seen.copy()
        x, y = rows, own
        while len(x):
            more = []
            for at in range(0, len(x), EXPANDED_AT_ONCE):
                near = links[y[at : at + EXPANDED_AT_ONCE]]
                cell = np.flatnonzero(near >= 0)
                a, b = x[at + cell // near.shape[1]], near.ravel()[cell]
                new = ~seen[a, b]
                pair = _distinct(a[new] * n + b[new])
                a, b = pair // n, pair % n
                seen[a, b] = True
                for k in range(0, len(a), EXPANDED_AT_ONCE):
                    s = np.einsum("ij,ij->i", vectors[own[a[k : k + EXPANDED_AT_ONCE]]], vectors[b[k : k + EXPANDED_AT_ONCE]])
                    more.append(pair[k : k + EXPANDED_AT_ONCE][s >= least])
            pair = np.concatenate(more) if more else np.zeros(0, np.int64)
            x, y = pair // n, pair % n
            good[x, y] = True
        cell = np.flatnonzero(good)
        found += np.split(cell % n, np.searchsorted(cell, rows[1:] * n))
    return found


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _lists(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each element, the elements."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), column.flatten().to_numpy(zero_copy_only=False)


def _padded(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The values of each of ``n`` rows (``row`` ascends), padded with -1."""
    count = np.bincount(row, minlength=n)
    out = np.full((n, max(1, count.max())), -1, np.int64)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = value
    return out


def _shards(distinct: DataFrame, sample: np.ndarray, size: int, wider: int) -> DataFrame:
    """(_v, _unit, _shards) of every distinct vector, by centroids of the sample."""
    k = min(MOST_CENTROIDS, max(1, math.ceil(size / SHARD)), max(1, len(sample)))
    c = distinct.sparkSession.sparkContext.broadcast(centroids(sample, k))  # at most MOST_CENTROIDS vectors

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                v = _vectors(batch.column(1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(nearest(v, c.value, wider), pa.list_(pa.int64()))], names=["_v", "_unit", "_shards"]
                )

    return distinct.mapInArrow(deal, "_v long, _unit array<double>, _shards array<long>")


def _scaled(column: pa.Array) -> pa.Array:
    """The unit vectors of lists of doubles; null: a list that is null, empty, zero or holds null or non-finite components."""
    at = column.offsets.to_numpy().astype(np.int64)
    x = column.values.to_numpy(zero_copy_only=False)  # null: NaN
    out, none = np.zeros(len(x)), np.ones(len(column), bool)
    size = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(at), 0)
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        e = x[at[rows, None] + np.arange(d)]
        # vectors whose square under- or overflows still have a direction: they are scaled first
        most = np.abs(e).max(axis=1)  # NaN where a component is
        fine = np.isfinite(most) & (most > 0)
        rows, e = rows[fine], e[fine] / most[fine, None]
        square = np.zeros(len(e))
        for k in range(d):
            square += e[:, k] * e[:, k]
        out[at[rows, None] + np.arange(d)] = e / np.sqrt(square)[:, None]
        none[rows] = False
    return pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(out[at[0] : at[-1]]), mask=pa.array(none))


def units(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(_id, _unit, _v): each row's unit vector and its key, null where the vector links with nothing."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _scaled(batch.column(1))], names=["_id", "_unit"])

    v = rows.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_e"))
    # in Python: as an expression the norm is worked out again for every component
    v = v.mapInArrow(run, StructType([v.schema["_id"], StructField("_unit", ArrayType(DoubleType()))]))
    return v.withColumn("_v", F.when(F.col("_unit").isNotNull(), F.xxhash64("_unit")))


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST, wider: int = 1, with_key: bool = False
) -> DataFrame:
    """(id_col, n_links, component_id, kept, n_vectors) of every row; n_vectors: different vectors it links with.

    ``wider`` multiplies the overlap of the shards; ``with_key`` adds _v, the key of the vector.
    """
    v = table(units(rows, id_col, vector_col), "vectors")
    distinct = v.where(F.col("_v").isNotNull()).groupBy("_v").agg(F.first("_unit").alias("_unit"), F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least"))
    distinct = table(distinct, "distinct")
    lengths = {r["_d"]: r["_c"] for r in distinct.groupBy(F.size("_unit").alias("_d")).agg(F.count(F.lit(1)).alias("_c")).collect()}
    dim = max(lengths, key=lambda d: (lengths[d], d)) if lengths else 0
    size = lengths.get(dim, 0)
    usable = distinct.where(F.size("_unit") == dim)
    spark = rows.sparkSession
    if size:
        share = min(1.0, SAMPLE / size)
        drawn = usable.where(F.pmod(F.col("_v"), F.lit(1 << 20)) < share * (1 << 20)).select("_v", "_unit").limit(2 * SAMPLE)
        drawn = drawn.toArrow().sort_by("_v")
        sample = _vectors(drawn["_unit"].combine_chunks()).reshape(-1, dim)
        if len(sample) == 0:
            sample = np.array([usable.first()["_unit"]])
    else:
        sample = np.zeros((1, max(dim, 1)))

    dealt = _shards(usable.select("_v", "_unit"), sample, size, wider)
    dealt = table(dealt.withColumn("_shard", F.explode("_shards")).drop("_shards"), "dealt") if size else None
    if dealt is None:
        links = spark.createDataFrame([], "a long, b long")
        counts = spark.createDataFrame([], "_v long, _links long, _others long")
    else:
        dealt = _divided(dealt, wider)

        def link(part: pa.Table) -> pa.Table:
            return _build_shard(part, least)

        graph = table(dealt.groupBy("_shard").applyInArrow(link, "_v long, _near array<long>, _home long"), "graph")
        united = graph.groupBy("_v").agg(
            F.array_distinct(F.flatten(F.collect_list("_near"))).alias("_near"), F.sort_array(F.collect_set("_home")).alias("_homes")
        )
        full = dealt.join(united, "_v").join(usable.select("_v", "_n"), "_v")

        def find(part: pa.Table) -> pa.Table:
            return _search_shard(part, least)

        found = full.groupBy("_shard").applyInArrow(find, "_v long, _links long, _others long, _root long")
        found = table(found, "found")
        counts = found.groupBy("_v").agg(F.sum("_links").alias("_links"), F.sum("_others").alias("_others"))
        links = found.where(F.col("_root").isNotNull()).select(F.col("_v").alias("a"), F.col("_root").alias("b"))
    root = connected_components(links)
    classes = distinct.select("_v", "_n", "_least").join(root.withColumnRenamed("node", "_v"), "_v", "left").join(counts, "_v", "left")
    classes = table(classes.withColumn("_root", F.coalesce("root", "_v")).drop("root"), "classes")
    least_id = table(classes.groupBy("_root").agg(F.min("_least").alias("_first")), "first")
    others = F.coalesce("_others", F.lit(0)).alias("_others")
    classes = classes.join(least_id, "_root").select("_v", "_first", (F.col("_n") - 1 + F.coalesce("_links", F.lit(0))).alias("_links"), others)
    classes = table(classes, "named")
    out = v.where(F.col("_v").isNotNull()).select("_id", "_v").join(classes, "_v").select("_id", "_v", "_links", "_others", "_first")
    none = F.lit(0).cast("long")
    out = out.unionByName(v.where(F.col("_v").isNull()).select("_id", "_v", none.alias("_links"), none.alias("_others"), F.col("_id").alias("_first")))
    return out.select(
        F.col("_id").alias(id_col), F.col("_links").alias("n_links"), F.col("_first").alias("component_id"), F.col("_id").eqNullSafe(F.col("_first")).alias("kept"),
        F.col("_others").alias("n_vectors"), *(["_v"] if with_key else []),
    )


def _mixed_id(shard: int, k: int) -> int:
    """The number of the k-th part of a shard."""
    return ((shard + 1) * 0x9E3779B97F4A7C15 + (k + 1) * 0xC2B2AE3D27D4EB4F & (1 << 62) - 1) >> 1


def _large(dealt: DataFrame) -> DataFrame:
    sizes = dealt.groupBy("_shard").agg(F.count(F.lit(1)).alias("_c"))
    return table(sizes.where(F.col("_c") > 4 * SHARD), "large")


def _divided(dealt: DataFrame, wider: int = 1) -> DataFrame:
    """Shards of a bounded size.

    A shard beyond 4 * SHARD vectors is divided by centroids of its own, DIVIDED
    shards in a pass, so that their centroids stay a bounded broadcast. What
    centroids can't divide (vectors that are all near each other) is cut into
    blocks, each pair of blocks being a shard: no link is lost, and the work is
    that of the links to count.
    """
    for _ in range(LEVELS):
        large = _large(dealt)
        if large.isEmpty():
            return dealt
        while True:
            some = large.limit(DIVIDED).collect()
            if not some:
                break
            marks = {r["_shard"]: min(MOST_CENTROIDS // 8, math.ceil(r["_c"] / SHARD)) for r in some}
            shares = F.create_map(*[F.lit(x) for r in some for x in (r["_shard"], min(1.0, 16 * marks[r["_shard"]] / r["_c"]))])
            drawn = dealt.where(F.col("_shard").isin(list(marks)))
            drawn = drawn.where(F.pmod(F.xxhash64("_v"), F.lit(1 << 20)) < shares[F.col("_shard")] * (1 << 20)).collect()
            own: dict[int, list] = {}
            for r in sorted(drawn, key=lambda r: r["_v"]):
                own.setdefault(r["_shard"], []).append(r["_unit"])
            picked = {k: centroids(np.array(x), min(marks[k], len(x))) for k, x in own.items()}
            picked = {k: c for k, c in picked.items() if len(c) > 1}
            large = large.where(~F.col("_shard").isin(list(marks)))
            if not picked:
                continue
            shared = dealt.sparkSession.sparkContext.broadcast(picked)

            def again(batches, shared=shared):
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    shard, v = batch.column(2).to_numpy(), _vectors(batch.column(1))
                    out = [[int(x)] for x in shard]
                    for x, c in shared.value.items():
                        at = np.flatnonzero(shard == x)
                        for i, near in zip(at, nearest(v[at], c, wider), strict=True):
                            out[i] = [_mixed_id(int(x), k) for k in near]
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], names=["_v", "_unit", "_shards"])

            cut = dealt.select("_v", "_unit", "_shard").mapInArrow(again, "_v long, _unit array<double>, _shards array<long>")
            dealt = table(cut.withColumn("_shard", F.explode("_shards")).drop("_shards").distinct(), "dealt")
    large = _large(dealt)
    if large.isEmpty():
        return dealt
    blocks = F.ceil(F.col("_c") / SHARD).cast("int")
    own = F.pmod(F.xxhash64("_v", F.lit(5)), F.col("_m")).cast("int")
    grid = dealt.join(large, "_shard", "left").withColumn("_m", blocks).withColumn("_b", own)
    pair = F.transform(F.sequence(F.lit(0), F.col("_m") - 1), lambda j: F.abs(F.xxhash64("_shard", F.least("_b", j), F.greatest("_b", j))))
    cut = grid.withColumn("_shard", F.explode(F.when(F.col("_m").isNull(), F.array("_shard")).otherwise(pair)))
    return table(cut.select("_v", "_unit", "_shard"), "dealt")


def _build_shard(part: pa.Table, least: float) -> pa.Table:
    shard = part["_shard"][0]
    part = part.sort_by("_v").combine_chunks()
    key, n = part["_v"].to_numpy(), part.num_rows
    v = _vectors(part["_unit"].chunk(0))
    # symmetric: who is near knows it too
    edges = _edges(v, build(v), least)
    near = pa.ListArray.from_arrays(pa.array(np.searchsorted(edges, np.arange(n + 1) * n), pa.int32()), pa.array(key[edges % n]))
    return pa.table({"_v": key, "_near": near, "_home": pa.repeat(shard, n)})


def _search_shard(part: pa.Table, least: float) -> pa.Table:
    """Links counted in this shard (of the vectors' rows), and a spanning link of each vector."""
    part = part.sort_by("_v").combine_chunks()
    key, n_rows = part["_v"].to_numpy(), part["_n"].to_numpy()
    shard = part["_shard"][0].as_py()
    v = _vectors(part["_unit"].chunk(0))
    row, near = _lists(part["_near"])
    at = np.minimum(np.searchsorted(key, near), len(key) - 1)
    here = key[at] == near
    links = _padded(row[here], at[here], len(v))
    found = search(v, links, least)
    i = np.repeat(np.arange(len(v)), [len(x) for x in found])
    j = np.concatenate(found)
    # what one end finds the other has found
    pair = _distinct(np.minimum(i, j)[i != j] * len(v) + np.maximum(i, j)[i != j])
    i, j = pair // len(v), pair % len(v)
    root = np.arange(len(v))
    while True:  # smallest neighbour, then pointer jumping, until nothing moves
        new = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    # a pair is counted in the smallest shard both ends are in
    homes = _padded(*_lists(part["_homes"]), len(v))
    mine = np.ones(len(i), bool)
    for a in range(homes.shape[1]):
        x = homes[i, a]
        smaller = np.flatnonzero((x >= 0) & (x < shard) & mine)
        if len(smaller):
            mine[smaller[(homes[j[smaller]] == x[smaller, None]).any(axis=1)]] = False
    total = np.bincount(i[mine], n_rows[j[mine]], minlength=len(v)) + np.bincount(j[mine], n_rows[i[mine]], minlength=len(v))
    others = np.bincount(i[mine], minlength=len(v)) + np.bincount(j[mine], minlength=len(v))
    linked = root != np.arange(len(v))
    return pa.table({"_v": key, "_links": total.astype(np.int64), "_others": others.astype(np.int64), "_root": pa.array(key[root], pa.int64(), mask=~linked)})


def audit(rows: DataFrame, result: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> float:
    """Recall of ``result`` (made ``with_key``) against brute force.

    Every vector of an id divisible by 100 is compared with all vectors,
    AUDIT_BLOCK queries at once, each block a broadcast. Counted are different
    vectors within ``least``, so that copies hide no loss; a query counts no more
    than it has.
    """
    distinct = units(rows, id_col, vector_col).where(F.col("_v").isNotNull()).groupBy("_v").agg(F.first("_unit").alias("_unit"))
    distinct = table(distinct, "audit-vectors")
    asked = result.where((F.col(id_col) % 100 == 0) & F.col("_v").isNotNull()).groupBy("_v").agg(F.max("n_vectors").alias("_found"))
    asked = table(asked.join(distinct, "_v"), "audit-queries")
    blocks = max(1, math.ceil(asked.count() / AUDIT_BLOCK))
    want = got = 0
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("_v"), F.lit(blocks)) == b).collect()  # about AUDIT_BLOCK vectors
        by_length: dict[int, list] = {}
        for k, r in enumerate(block):
            by_length.setdefault(len(r["_unit"]), []).append(k)
        queries = {d: (np.array(ks), np.array([block[k]["_unit"] for k in ks])) for d, ks in by_length.items()}
        shared = distinct.sparkSession.sparkContext.broadcast((len(block), queries))

        def count(batches, shared=shared):
            n, by_length = shared.value
            total = np.zeros(n, np.int64)
            for batch in batches:
                sizes = np.asarray(batch.column(0).value_lengths())
                for d, (at, q) in by_length.items():
                    same = batch.filter(pa.array(sizes == d))
                    for lo in range(0, same.num_rows, 1024):
                        total[at] += (q @ _vectors(same.column(0).slice(lo, 1024)).T >= least + NEARER).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total)], names=["k", "c"])

        true = {r["k"]: r["c"] for r in distinct.select("_unit").mapInArrow(count, "k long, c long").groupBy("k").agg(F.sum("c").alias("c")).collect()}
        for k, r in enumerate(block):
            here = max(0, true.get(k, 0) - 1)  # itself
            want += here
            got += min(here, r["_found"])
    return got / want if want else 1.0


def audited(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST) -> tuple[DataFrame, float]:
    """(``near_vectors`` with a recall of LEAST_RECALL or more, that recall); overlaps are widened until it is reached."""
    for wider in (1, 2, 4):
        found = table(near_vectors(rows, id_col, vector_col, least, wider, with_key=True), "near-vectors")
        recall = audit(rows, found, id_col, vector_col, least)
        if recall >= LEAST_RECALL:
            return found.drop("_v"), recall
    raise ValueError(f"recall is {recall:.3f}")
