"""Toxicity by FTRL-proximal logistic regression (operator 8).

Method. A text's features are the hashes of its distinct words, word pairs and
skip pairs (one word left out) in 2^20 cells. FTRL-proximal with per-coordinate
learning rates and L1 keeps few weights. One learner goes over a bounded sample
of the labelled rows; the non-zero weights, a table bounded by the number of
cells, are broadcast to score whole texts in one pass without a shuffle. Where
the sample holds the classes in other shares than the labels do, the bias is
moved by the difference in log odds, so that scores don't depend on the bound.

Results in odd cases. Null or empty text scores by the bias alone. No labels:
every score is 0.5 and predicted is 1 by the rule score >= 0.5. A text labelled
twice trains twice; a label on no document is ignored. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from orderlens.llm import textbatch as tb
from orderlens.llm.split import held_out, rows_per_sampled, sample_by_class

CELLS = 1 << 20
#: Bound of the training sample: labelled documents of each class.
SAMPLE_DOCS = 6_000
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2.0, 1.0
PASSES = 3
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_TRIM = np.zeros(256, bool)
_TRIM[[33, 34, 39, 40, 41, 44, 46, 58, 59, 63]] = True


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each feature, features of each text), repeats included."""
    data, offsets = tb.utf8(column)
    starts, ends, counts = tb.spans(data, offsets)
    # a mark at a word's end is not part of it (two at most)
    for _ in range(2):
        ends = ends - (_TRIM[data[ends - 1]] & (ends - starts > 1))
    w = tb.hashes(data, starts, ends)
    doc = np.repeat(np.arange(len(counts)), counts)
    cells, docs = [w], [doc]
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(w) > gap:
            own = doc[gap:] == doc[:-gap]
            cells.append(tb.mix64(w[:-gap] * factor + w[gap:])[own])
            docs.append(doc[gap:][own])
    cell = (np.concatenate(cells) >> np.uint64(44)).astype(np.int64)
    doc = np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return cell[order], np.bincount(doc, minlength=len(counts))


class Ftrl:
    """One learner; cell CELLS is the bias, which has no L1."""

    def __init__(self):
        self.z, self.n = np.zeros(CELLS + 1), np.zeros(CELLS + 1)

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        limit = np.where(i == CELLS, 0.0, L1)
        return np.where(np.abs(z) <= limit, 0.0, -(z - np.sign(z) * limit) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, i: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def train(labelled: DataFrame, stands_for: dict[int, float] | None = None) -> dict[int, float]:
    """Non-zero weights by cell, from a bounded sample of (_id, _text, _y) rows.

    ``stands_for`` has the labelled rows that a sampled one of each class stands for.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                values, per = features(part.column(2))
                own = [np.unique(x).astype(np.int32).tobytes() for x in np.split(values, np.cumsum(per)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.binary())], names=["_id", "_y", "_cells"])

    # where the documents are read: the one learner gets the distinct cells, not the texts
    kind = labelled.schema["_id"].dataType.simpleString()
    rows = labelled.select("_id", "_y", "_text").mapInArrow(extract, f"_id {kind}, _y int, _cells binary")

    def learner(part: pa.Table) -> pa.Table:
        ids, labels = part["_id"].to_pylist(), part["_y"].to_pylist()
        sets = [np.append(np.frombuffer(x.as_py(), np.int32), CELLS) for x in part["_cells"]]
        order = sorted(range(len(ids)), key=lambda k: (str(ids[k])[::-1], labels[k], len(sets[k])))
        model = Ftrl()
        for p in range(PASSES):
            for k in order if p % 2 == 0 else order[::-1]:
                model.learn(sets[k], labels[k])
        w = model.weights(np.arange(CELLS + 1))
        used = np.flatnonzero(w)
        return pa.table({"cell": pa.array(used, pa.int64()), "w": pa.array(w[used])})

    # the sample is bounded, and so are the at most CELLS + 1 weights that reach the driver
    weights = {r["cell"]: r["w"] for r in rows.groupBy().applyInArrow(learner, "cell long, w double").collect()}
    if weights and stands_for and len(stands_for) == 2:
        weights[CELLS] = weights.get(CELLS, 0.0) + math.log(stands_for[1] / stands_for[0])
    return weights


def score(docs: DataFrame, weights: dict[int, float], text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with score (double) added."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rest = [c for c in docs.columns if c != text_col]
    schema = StructType([docs.schema[c] for c in rest] + [StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(CELLS + 1)
        w[list(shared.value)] = list(shared.value.values())
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                cells, per = features(part.column(part.num_columns - 1))
                doc = np.repeat(np.arange(len(per)), per)
                hit = np.flatnonzero(w[cells])
                # each distinct feature counts once
                pair = np.unique(np.stack([doc[hit], cells[hit]], axis=1), axis=0) if len(hit) else np.zeros((0, 2), np.int64)
                total = w[CELLS] + np.bincount(pair[:, 0], w[pair[:, 1]], minlength=len(per))
                p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(p, pa.float64())], names=schema.names)

    return docs.select(*rest, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): learnt from labelled rows not held out, applied to all."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out("doc_id", 5, 0)).select(
        F.col("doc_id").alias("_label_id"), F.col("toxic").cast("int").alias("_y")
    )
    labelled = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    # bounded by SAMPLE_DOCS of each of two classes
    known = known.withColumnRenamed("_label_id", "_id")
    sample = sample_by_class(known, "_id", "_y", SAMPLE_DOCS)
    weights = train(labelled.join(F.broadcast(sample), "_id"), rows_per_sampled(known, sample, "_y"))
    out = score(docs.select("doc_id", "text"), weights)
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
