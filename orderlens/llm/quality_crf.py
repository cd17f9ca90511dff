"""Document quality from a line-level conditional random field (operator 3).

Method. Every line is good or bad. A line's features are binned measures of it
(kinds of characters, word lengths, repeats in the line, copies of the line in
the text) and of the lines before and after it; a linear chain joins the
labels of neighbouring lines. The document labels train it (each line of a
labelled text carries the text's label, a text weighs the same whatever its
length). Forward-backward gives each line's probability of being good; their
mean, weighted by line length, is the document's score.

Scale. The training sample is bounded by ``SAMPLE_DOCS`` of each class, some ``SAMPLE_LINES`` lines in all, and only
its binned features (12 bytes a line) reach the driver. A sampled text weighs as
many labelled rows of its class as it stands for, so that scores don't depend
on the bound. Scoring is one pass over whole texts without a shuffle; the
chains of a batch run in lockstep.

Results in odd cases. Null or empty text (no line): the share of good labels
among all training labels. No labels of a class: that share for every text, 0.5
without any label. Labels other than 0 and 1 are ignored; a text labelled twice
trains twice. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from orderlens.llm import textbatch as tb
from orderlens.llm.scratch import table
from orderlens.llm.split import held_out, rows_per_sampled, sample_by_class

SAMPLE_LINES = 400_000
SAMPLE_DOCS = 4000
STEPS, RATE, RIDGE = 150, 0.15, 1e-4

#: Kinds of bytes: lower, upper, beyond ASCII, digit, blank, common marks, ! and ?, symbols, table marks.
KINDS = 9
_KIND = np.full(256, 7, np.int64)
_KIND[97:123], _KIND[65:91], _KIND[128:], _KIND[48:58] = 0, 1, 2, 3
_KIND[list(b" \t\r\v\f\n")] = 4
_KIND[list(b".,;:'\"-()")] = 5
_KIND[list(b"!?")] = 6
_KIND[list(b"|/\\")] = 8
#: Upper edges of the bins of a share.
_EDGES = np.array([1e-9, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
BINS = len(_EDGES) + 1
MEASURES = KINDS + 5
WIDTH = 3 * (MEASURES * BINS + 1) + 1


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, lines of each text) of the lines that hold a word."""
    starts, ends, counts = tb.spans(data, offsets)
    if len(starts) == 0:
        return starts, ends, counts
    # a line starts at its first word and ends with its last
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    new = np.ones(len(starts), bool)
    new[1:] = breaks[starts[1:]] != breaks[starts[:-1]]
    first_of_text = (np.cumsum(counts) - counts)[counts > 0]
    new[first_of_text] = True
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts)) - 1
    per = np.add.reduceat(new, first_of_text) if len(first_of_text) else np.zeros(0, np.int64)
    lines = np.zeros(len(counts), np.int64)
    lines[counts > 0] = per
    return starts[at], ends[last], lines


def binned(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """([lines, MEASURES] bins, bytes of each line, lines of each text)."""
    data, offsets = tb.utf8(column)
    a, b, lines = lines_of(data, offsets)
    n = len(a)
    if n == 0:
        return np.zeros((0, MEASURES), np.uint8), np.zeros(0, np.int64), lines
    size = b - a
    share = np.zeros((n, MEASURES))
    for lo in range(0, len(data), 1 << 18):  # byte windows, whatever the length of a line
        hi = min(len(data), lo + (1 << 18))
        i, j = np.searchsorted(a, [lo, hi])
        # what stands before the window's first line start belongs to the line before it
        line = np.repeat(np.concatenate([[max(i - 1, 0)], np.arange(i, j)]), np.diff(np.concatenate([[lo], a[i:j], [hi]])))
        low = int(line[0])
        kinds = np.bincount((line - low) * KINDS + _KIND[data[lo:hi]], minlength=(int(line[-1]) - low + 1) * KINDS)
        share[low : int(line[-1]) + 1, :KINDS] += kinds.reshape(-1, KINDS)
    total = share[:, :KINDS].sum(axis=1)
    share[:, :KINDS] /= np.maximum(total, 1)[:, None]
    ws, we, _ = tb.spans(data, offsets)
    h = tb.hashes(data, ws, we)
    line = np.searchsorted(a, ws, "right") - 1
    words = np.maximum(np.bincount(line, minlength=n), 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    key = np.sort((line.astype(np.uint64) << np.uint64(36)) | (h >> np.uint64(28)))
    same = key[1:][key[1:] == key[:-1]] >> np.uint64(36)
    share[:, KINDS] = np.bincount(line, again, minlength=n) / words
    share[:, KINDS + 1] = np.bincount(same.astype(np.int64), minlength=n) / words
    share[:, KINDS + 2] = np.minimum(size / words / 20, 1)
    share[:, KINDS + 3] = np.minimum(np.log1p(size) / 10, 1)
    at = np.searchsorted(line, np.arange(n))
    place = (np.arange(len(h)) - at[line]).astype(np.uint64)
    key = tb.mix64(np.add.reduceat(h * tb.mix64(place), at))  # of a line's words in order
    doc = np.repeat(np.arange(len(lines)), lines)
    order = np.lexsort((key, doc))
    k, d = key[order], doc[order]
    new = np.ones(n, bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    group = np.cumsum(new) - 1
    copies = np.empty(n)
    copies[order] = np.bincount(group)[group]
    share[:, KINDS + 4] = (copies - 1) / np.maximum(lines[doc], 1)
    return np.searchsorted(_EDGES, share, "right").astype(np.uint8), size, lines


def indices(bins: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """[lines, 3 * (MEASURES + 1) + 1] weight indices: a line's own, its neighbours' (or that there is none), the bias."""
    n = len(bins)
    block = MEASURES * BINS + 1
    own = bins.astype(np.int64) + np.arange(MEASURES) * BINS
    ends = np.cumsum(lines)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    first[(ends - lines)[lines > 0]] = True
    last[(ends - 1)[lines > 0]] = True
    out = [own]
    for k, edge, shift in ((1, first, 1), (2, last, -1)):
        beside = np.roll(own, shift, axis=0) + k * block
        beside[edge] = (k + 1) * block - 1
        out.append(beside)
    return np.concatenate([*out, np.full((n, 1), WIDTH - 1)], axis=1)


def marginals(emit: np.ndarray, trans: np.ndarray, lines: np.ndarray, pairs: np.ndarray | None = None):
    """P(good) of each line from forward-backward; with ``pairs`` (the weight of each text) also [2, 2] sums of pair marginals weighted pairs / lines.

    ``emit`` is each line's score of good against bad, ``trans`` [2, 2] the
    scores of (label, next label). The chains of all texts step together, the
    longest first.
    """
    order = np.argsort(-lines, kind="stable")
    begin = (np.cumsum(lines) - lines)[order]
    length = lines[order]
    n = len(emit)
    fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
    e = np.stack([np.zeros(n), emit], axis=1)
    most = int(length[0]) if len(length) else 0
    alive = np.searchsorted(-length, -np.arange(1, most + 1), "right")
    for t in range(most):
        at = begin[: alive[t]] + t
        x = e[at]
        if t:
            prev = fwd[at - 1]
            x = x + np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1])
        fwd[at] = x - np.logaddexp(x[:, :1], x[:, 1:])
    for t in range(most - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        x = e[at + 1] + bwd[at + 1]
        x = np.logaddexp(x[:, :1] + trans[:, 0], x[:, 1:] + trans[:, 1])
        bwd[at] = x - np.logaddexp(x[:, :1], x[:, 1:])
    both = fwd + bwd
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
    if pairs is None:
        return good
    inner = np.ones(n, bool)
    inner[(np.cumsum(lines) - 1)[lines > 0]] = False
    at = np.flatnonzero(inner)
    joint = fwd[at][:, :, None] + trans[None] + (e[at + 1] + bwd[at + 1])[:, None, :]
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    weight = np.repeat(pairs / np.maximum(lines, 1), lines)[at]
    return good, (joint * weight[:, None, None]).sum(axis=0)


def fit(bins: np.ndarray, lines: np.ndarray, y: np.ndarray, texts: np.ndarray | None = None) -> dict:
    """Weights by gradient ascent (Adam) on the mean log-likelihood of the line labels, a text weighing ``texts`` (1 by default)."""
    texts = np.ones(len(y)) if texts is None else texts
    prior = float(np.average(y, weights=texts)) if len(y) else 0.5
    if len(y) == 0 or y.min() == y.max() or len(bins) == 0:
        return {"w": np.zeros(WIDTH), "t": np.zeros((2, 2)), "prior": prior, "flat": True}
    ind = indices(bins, lines)
    weight = np.repeat(texts / np.maximum(lines, 1), lines)
    target = np.repeat(y, lines)
    w, t = np.zeros(WIDTH), np.zeros((2, 2))
    inner = np.where(lines > 1, (lines - 1) / np.maximum(lines, 1), 0) * texts
    seen = np.diag([inner[y == 0].sum(), inner[y == 1].sum()])
    m, v = np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)
    for step in range(1, STEPS + 1):
        good, pair = marginals(w[ind].sum(axis=1), t, lines, pairs=texts)
        gw = np.bincount(ind.ravel(), np.repeat(weight * (target - good), ind.shape[1]), minlength=WIDTH)
        g = np.concatenate([gw, (seen - pair).ravel()]) / texts.sum() - RIDGE * np.concatenate([w, t.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, t = w + move[:WIDTH], t + move[WIDTH:].reshape(2, 2)
    return {"w": w, "t": t, "prior": prior, "flat": False}


def document_scores(column: pa.Array, model: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each text, P(good) of each line, lines of each text)."""
    bins, size, lines = binned(column)
    good = np.full(len(bins), model["prior"])
    if len(bins) and not model["flat"]:
        good = marginals(model["w"][indices(bins, lines)].sum(axis=1), model["t"], lines)
    doc = np.repeat(np.arange(len(lines)), lines)
    total = np.bincount(doc, size, minlength=len(lines))
    mean = np.bincount(doc, size * good, minlength=len(lines)) / np.maximum(total, 1)
    return np.where(lines > 0, np.clip(mean, 0, 1), model["prior"]), good, lines


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """The model from a bounded sample of the labelled rows."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
    sample = sample_by_class(known, "_id", "_y", SAMPLE_DOCS)
    stands_for = rows_per_sampled(known, sample, "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tb.slices(batch, "_text"):
                bins, _, lines = binned(part.column(2))
                cut = np.split(bins, np.cumsum(lines)[:-1]) if len(lines) else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([c.tobytes() for c in cut], pa.binary())], names=["_id", "_y", "_bins"]
                )

    # at most about SAMPLE_DOCS labelled rows of either class, and about SAMPLE_LINES of their lines, reach the driver
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id")
    kind = rows.schema["_id"].dataType.simpleString()
    lines = table(rows.select("_id", "_y", "_text").mapInArrow(run, f"_id {kind}, _y int, _bins binary"), "quality-lines")
    size = lines.agg(F.sum(F.octet_length("_bins")).alias("b")).first()["b"] or 0
    if size > SAMPLE_LINES * MEASURES:  # whole documents, drawn by hash; each stands for as many more
        share = SAMPLE_LINES * MEASURES / size
        place = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("lines")), F.lit(1 << 30)) / float(1 << 30)
        thinned = lines.where(place < share)
        kept = rows_per_sampled(lines, thinned, "_y")
        lines, stands_for = thinned, {y: stands_for[y] * kept[y] for y in kept}
    got = lines.collect()
    got.sort(key=lambda r: (str(r["_id"]), r["_y"], bytes(r["_bins"])))
    bins = np.frombuffer(b"".join(bytes(r["_bins"]) for r in got), np.uint8).reshape(-1, MEASURES)
    lines = np.array([len(r["_bins"]) // MEASURES for r in got], np.int64)
    return fit(bins, lines, np.array([r["_y"] for r in got], np.int64), np.array([stands_for[r["_y"]] for r in got], np.float64))


def scorer(spark: SparkSession, model: dict, with_lines: bool = False):
    """A function of a text column: a struct of its score and, ``with_lines``, the probability of each line that holds a word.

    Only the text goes through Python, in pieces of bounded size; the other
    columns of a row stay where they are.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<score double, line_good array<double>>")
    def scored(text: pa.Array) -> pa.Array:
        scores, per_line = [np.zeros(0)], []
        for part in tb.slices(pa.RecordBatch.from_arrays([text], names=["_text"]), "_text"):
            got, good, lines = document_scores(part.column(0), shared.value)
            scores.append(got)
            if with_lines and len(lines):
                per_line += np.split(good, np.cumsum(lines)[:-1])
        lines = pa.array(per_line if with_lines else [None] * len(text), pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(scores), pa.float64()), lines], names=["score", "line_good"])

    return scored


def score(docs: DataFrame, model: dict, text_col: str = "text", with_lines: bool = False) -> DataFrame:
    """``docs`` with _score (and _line_good, the probability of each line that holds a word) added; columns of these names are replaced."""
    out = docs.withColumn("_score", scorer(docs.sparkSession, model, with_lines)(F.col(text_col)))
    if with_lines:
        out = out.withColumn("_line_good", F.col("_score.line_good"))
    return out.withColumn("_score", F.col("_score.score"))


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): learnt from labelled rows not held out, applied to all."""
    model = learn(docs, labels.where(~held_out("doc_id", 3, 1)))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``least``."""
    model = learn(docs, labels.where(~held_out("doc_id", 3, 1)))
    return docs.where(scorer(docs.sparkSession, model)(F.col(text_col))["score"] >= least)
