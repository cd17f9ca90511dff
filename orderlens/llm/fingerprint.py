"""Document fingerprints by randomised edit embedding (operator 1).

Method. A walk over a text emits the current character at every step and moves
on or stays by a shared random bit of (step, character). Two texts that walk
with the same randomness agree at most steps if their edit distance is small:
the walk turns edits into Hamming distance. The fingerprint samples 256 of the
emitted (character, step) values, four bits each, at steps chosen by the same
random order for all texts (the first step in that order among those the walk
has), so texts of similar length sample the same steps and the samples lie all
over the whole text. The share of equal samples is the likeness; bands of
samples give candidates, which a check against the whole samples confirms.

The number of steps at a character depends on the step modulo ``PERIOD`` and the
character's class only, so a character is one table look-up.

Scale. Each text is read once. Documents are dealt by quantiles of their ids;
only the head of each range travels to its neighbour, so the texts are shuffled
once and no window spans the table. Memory is one batch of rows.

Results in odd cases. Null text is empty; the empty text has the all-zero
fingerprint, is like itself (1) and unlike any other (0). Null ids come last in
descending order, equal ids in the order of their texts' hashes. A table of one
row is its own next document. Extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from orderlens.llm.components import connected_components
from orderlens.llm.minhash import _blocked, _grid, _open, _united
from orderlens.llm.scratch import table

SAMPLES = 256
PERIOD = 4096
CLASSES = 256
#: Ranges of ids for each shuffle partition; only the layout depends on it.
RANGES = 4

_rng = np.random.Generator(np.random.PCG64(1618))
_bits = _rng.integers(0, 2, (PERIOD, CLASSES), dtype=np.int64)
_bits[-1] = 1  # a walk moves on once in a period at least


def _steps() -> np.ndarray:
    """[PERIOD, CLASSES] steps spent at a character met at a given step."""
    out = np.empty((PERIOD, CLASSES), np.int32)
    wait = np.ones(CLASSES, np.int32)  # at step PERIOD - 1 every bit is 1
    out[-1] = 1
    for s in range(PERIOD - 2, -1, -1):
        wait = np.where(_bits[s] == 1, 1, wait + 1).astype(np.int32)
        out[s] = wait
    return out


STEPS = _steps()
_ROWS = [row.tolist() for row in STEPS]
_SALT = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _records() -> np.ndarray:
    """[SAMPLES, n] for each sample the steps that come before all earlier ones in its random order.

    The next such step after step t - 1 (the t-th) is t / u for a uniform u, so
    the table is drawn directly and covers walks of any length.
    """
    rows = []
    for _ in range(SAMPLES):
        t, row = 1, []
        while t < 1 << 53:
            row.append(t - 1)
            t = int(t / max(_rng.random(), 1e-12)) + 1
        rows.append(row)
    out = np.full((SAMPLES, max(map(len, rows))), np.iinfo(np.int64).max)
    for k, row in enumerate(rows):
        out[k, : len(row)] = row
    return out


RECORDS = _records()


def sampled_steps(n: int) -> np.ndarray:
    """The step each sample takes of a walk of ``n`` steps: uniform over them, and mostly the same for a similar ``n``."""
    return RECORDS[np.arange(SAMPLES), (RECORDS < n).sum(axis=1) - 1]


def walk(classes: np.ndarray, start: int = 0) -> np.ndarray:
    """The step after each character, for a walk that is at ``start`` before the first."""
    if len(classes) == 0:
        return np.zeros(0, np.int64)
    rows, mask = _ROWS, PERIOD - 1
    out = accumulate(classes.tolist(), lambda j, c: j + rows[j & mask][c], initial=start)
    return np.fromiter(out, np.int64, len(classes) + 1)[1:]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def classes_of(points: np.ndarray) -> np.ndarray:
    return (points ^ (points >> 8) * np.uint32(37)) & np.uint32(CLASSES - 1)


def fingerprint(points: np.ndarray, ends: np.ndarray) -> str:
    """Hex of the sampled values of a walk over ``points`` with step ``ends``."""
    if len(points) == 0:
        return "0" * SAMPLES
    step = sampled_steps(int(ends[-1]))
    char = points[np.searchsorted(ends, step, "right")]
    value = _mix(char.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + step.astype(np.uint64) + _SALT) >> np.uint64(60)
    nibbles = value.astype(np.uint8)
    return (nibbles[::2] << 4 | nibbles[1::2]).tobytes().hex()


_ZERO = "0" * SAMPLES


def likeness(a: str, b: str) -> float:
    """Share of equal samples, corrected for those that are equal by chance (1 in 16)."""
    if a == b:
        return 1.0
    if a == _ZERO or b == _ZERO:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint8) for s in (a, b))
    d = x ^ y
    equal = ((d & 15) == 0).sum() + ((d >> 4) == 0).sum()
    return max(0.0, (float(equal) / SAMPLES - 1 / 16) / (15 / 16))


def bands(print_: str, size: int = 8) -> list[str]:
    """Bit-sampled bands of a fingerprint: two texts of likeness 0.9 share one of 32 but for 2e-7."""
    return [f"{i}:{print_[i : i + size]}" for i in range(0, SAMPLES, size)]


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_range, _id, _text, _tie, _guest): documents by id range, and the head of each range as guest of the one before it."""
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ids = d.select("_id")
    n = RANGES * int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.where(F.col("_id").isNotNull()).approxQuantile("_id", [i / n for i in range(1, n)], 1 / (4 * n))
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    # range 0 holds the largest ids; null ids come after all others
    place = _by_search(cuts)("_id")
    d = d.withColumn("_range", place.cast("int"))
    heads = ids.withColumn("_range", place.cast("int")).groupBy("_range").agg(F.max("_id").alias("_head")).orderBy("_range").collect()
    if not heads:
        return d.withColumns({"_tie": F.lit(0).cast("long"), "_guest": F.lit(False)})
    # each range's head also goes to the end of the range before it, the first one's to the end of the last
    before = {heads[i]["_range"]: heads[i - 1]["_range"] for i in range(len(heads))}
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    head = F.create_map(*[F.lit(x) for r in heads for x in (r["_range"], r["_head"])])
    is_head = F.col("_id").eqNullSafe(head[F.col("_range")])
    copies = F.when(is_head, F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("g")), F.struct(to[F.col("_range")].alias("r"), F.lit(True).alias("g")))).otherwise(
        F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("g")))
    )
    d = d.withColumn("_copy", F.explode(copies))
    return d.select(F.col("_copy.r").alias("_range"), "_id", "_text", F.xxhash64("_text").alias("_tie"), F.col("_copy.g").alias("_guest"))


def _by_search(cuts: list[int]):
    edges = np.array(cuts[::-1], np.int64)

    @F.pandas_udf("int")
    def place(ids):
        import pandas as pd

        known = ids.notna()
        at = len(edges) - np.searchsorted(edges, ids.fillna(0).astype("int64").to_numpy(), "right")
        return pd.Series(np.where(known, at, len(edges) + 1)).astype("int32")

    return place


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and the likeness to that and to the next document's.

    The edited text replaces the last floor(n / 2) code points by the first as
    many (or all) of the next document in descending id order, the first
    document following the last.
    """
    d = _dealt(docs, id_col, text_col)
    d = d.repartition("_range").sortWithinPartitions("_range", "_guest", F.col("_id").desc_nulls_last(), "_tie")
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("n_chars", LongType()),
            StructField("edited_sha256", StringType()),
            StructField("fingerprint", StringType()),
            StructField("edited_fingerprint", StringType()),
            StructField("near_edited", DoubleType()),
            StructField("near_next", DoubleType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next document
        guest_of = None  # the range whose guest has come: later guests are ties of it
        out: list[tuple] = []
        for batch in batches:
            cols = [c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(3))]
            for i in range(batch.num_rows):
                range_, id_, guest = cols[0][i], cols[1][i], cols[2][i]
                if guest and guest_of == range_:
                    continue
                guest_of = range_ if guest else None
                points = code_points(batch.column(2)[i].as_py())
                classes = classes_of(points)
                ends = walk(classes)
                own = fingerprint(points, ends)
                if held is not None:
                    pid, ppoints, pends, pown = held
                    half = len(ppoints) // 2
                    stay = len(ppoints) - half
                    edited = np.concatenate([ppoints[:stay], points[:half]])
                    more = walk(classes[:half], int(pends[stay - 1]) if stay else 0)
                    other = fingerprint(edited, np.concatenate([pends[:stay], more]))
                    sha = hashlib.sha256(edited.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((pid, len(ppoints), sha, pown, other, likeness(pown, other), likeness(pown, own)))
                held = None if guest else (id_, points, ends, own)
                if len(out) >= 256:
                    yield _rows(out, schema)
                    out = []
        if out:
            yield _rows(out, schema)

    return d.select("_range", "_id", "_text", "_guest").mapInArrow(run, schema)


def _rows(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    types = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    arrays = [pa.array(c, t) if t else pa.array(c) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row of ``docs``, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(1):
                points = code_points(t.as_py() or "")
                out.append(fingerprint(points, walk(classes_of(points))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=[id_col, "fingerprint"])

    schema = StructType([docs.schema[id_col], StructField("fingerprint", StringType())])
    return docs.select(id_col, text_col).mapInArrow(run, schema)


#: Fingerprints of a block of a band.
BLOCK = 2048


def _alike(least: float):
    """Comparison of whole fingerprints: likeness of ``least`` or more."""
    need = least * 15 / 16 + 1 / 16

    def compare(values: pa.ChunkedArray, stray: np.ndarray):
        raw = np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(len(stray), -1)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            d = raw[others] ^ raw[i]
            equal = ((d & 15) == 0).sum(axis=1) + ((d >> 4) == 0).sum(axis=1)
            return equal / SAMPLES >= need - 1e-12

        return linked

    return compare


def _links(members: DataFrame, prints: DataFrame, compare) -> DataFrame:
    """(a, b): links that unite what ``compare`` links within each band."""
    rows = members.withColumn("_blocks", F.ceil(F.col("_count") / BLOCK).cast("int"))
    links = _united(_blocked(rows.join(prints, "_key"), "_bucket", "_centre", "_print"), compare, "near")
    wide = rows.where("_blocks > 1")
    if wide.isEmpty():
        return links
    apart = _open(wide, connected_components(links))
    grid = _grid(apart, prints, f"ceil((_all - _most) / {BLOCK})", f"ceil(_all / {BLOCK})")
    return links.unionByName(_united(grid, compare, "near"))


def near_classes(prints: DataFrame, id_col: str = "doc_id", least: float = 0.9) -> DataFrame:
    """(id_col, fingerprint, class_id) of every row of ``prints``: the least id reachable over near fingerprints.

    Two fingerprints are near if they share a band and their likeness is
    ``least`` or more. Equal fingerprints are one node and go on once; a band's
    members are compared in blocks, whose rows are united there, so at most one
    link a row leaves a block and no pair does. Where the blocks of a wide band
    are not one class already, what lies outside its largest class meets all of
    its blocks: no link between classes is lost. The all-zero fingerprint of
    empty texts is a class of each row's own; a null id is its own class too and
    gives none to others.
    """
    rows = prints.select(F.col(id_col).alias("_id"), "fingerprint").withColumn(
        "_key", F.when(F.col("fingerprint") != _ZERO, F.xxhash64("fingerprint"))
    )
    nodes = rows.where(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.min("_id").alias("_least"), F.unhex(F.first("fingerprint")).alias("_print")
    )
    nodes = table(nodes, "prints")
    size = 4  # bytes of a band: eight samples
    band = [F.xxhash64(F.lit(i), F.substring("_print", size * i + 1, size)) for i in range(SAMPLES // (2 * size))]
    banded = nodes.select("_key", F.explode(F.array(*band)).alias("_bucket"))
    shared = banded.groupBy("_bucket").agg(F.min("_key").alias("_centre"), F.count(F.lit(1)).alias("_count"))
    members = table(banded.join(table(shared.where("_count > 1"), "bands").hint("merge"), "_bucket"), "members")
    payload = table(nodes.join(members.select("_key").distinct(), "_key", "left_semi").select("_key", "_print"), "candidates")
    root = connected_components(_links(members, payload, _alike(least))).withColumnRenamed("node", "_key")
    part = nodes.join(root, "_key", "left").select("_key", F.coalesce("root", "_key").alias("_root"), "_least")
    part = table(part, "classes")
    named = part.join(part.groupBy("_root").agg(F.min("_least").alias("class_id")).hint("merge"), "_root").select("_key", "class_id")
    return rows.join(named.hint("merge"), "_key", "left").select(
        F.col("_id").alias(id_col), "fingerprint", F.when(F.col("_id").isNull(), F.col("_id")).otherwise(F.coalesce("class_id", "_id")).alias("class_id")
    )
