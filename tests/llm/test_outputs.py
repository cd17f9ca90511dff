"""Embeddings, pages, token output, SentencePiece and the pipeline against brute-force versions."""

from __future__ import annotations

import functools
import os
import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from orderlens.llm import ann_graph, html_extract, range_coder, sp_encode, token_output


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(40):
        base = rng.normal(size=16)
        out += [(base + rng.normal(size=16) * 0.08 * k).tolist() for k in range(rng.integers(1, 9))]
    out += [out[0], out[0], (np.array(out[1]) * 3).tolist(), [0.0] * 16, None, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, []]
    return out


def brute_links(rows, least=0.9):
    unit = []
    for v in rows:
        ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v) / np.linalg.norm(v) if ok else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return links, [top(i) for i in range(len(rows))]


@pytest.mark.parametrize("shard", [1500, 12])
def test_embedding_links_match_brute_force(spark, shard, monkeypatch):
    rows = vectors()
    d = spark.createDataFrame([(i, v, 0, 1) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int, _v int")
    monkeypatch.setattr(ann_graph, "SHARD", shard)
    result = ann_graph.near_vectors(d, with_key=True)
    got = {r.vec_id: r for r in result.collect()}
    links, root = brute_links(rows)
    assert len(got) == len(rows)
    assert sum(abs(got[i].n_links - links[i]) for i in got) <= 0.02 * sum(links)
    assert np.mean([got[i].component_id == root[i] for i in got]) > 0.98
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert ann_graph.audit(d, result) > 0.9
    assert ann_graph.audit(d, result.withColumn("n_vectors", F.lit(0).cast("long"))) == 0.0  # copies alone are no recall


def groups(sizes, dim=64, noise=0.02, seed=11):
    """Groups of distinct near vectors around centres that are far from each other."""
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        base = rng.normal(size=dim)
        out += [(base + rng.normal(size=dim) * noise).tolist() for _ in range(size)]
    return out


@pytest.mark.parametrize("sizes", [[80] * 20 + [1] * 60, [200] * 8 + [1] * 60])
def test_groups_larger_than_the_pool_keep_all_links(spark, sizes, monkeypatch):
    monkeypatch.setattr(ann_graph, "SHARD", 10_000)  # one shard
    rows = groups(sizes)
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    d = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in ann_graph.near_vectors(d).collect()}
    assert [got[i].n_links for i in range(len(rows))] == want.tolist()
    first = np.repeat(np.cumsum([0, *sizes[:-1]]), sizes)
    assert [got[i].component_id for i in range(len(rows))] == first.tolist()


@pytest.mark.parametrize("case", ["clumps", "wide", "rounding"])
def test_search_of_a_shard_is_exact(case):
    rng = np.random.default_rng(12)
    if case == "clumps":  # within the radius of each other, and each larger than the pool of neighbours
        base = rng.normal(size=64)
        v = np.concatenate([base + rng.normal(size=64) * 0.25 + rng.normal(size=(90, 64)) * 0.001 for _ in range(6)])
    elif case == "wide":  # the radius cuts through the groups
        v = np.concatenate([rng.normal(size=64) + rng.normal(size=(150, 64)) * s for s in (0.2, 0.3, 0.35, 0.4)])
    else:
        v = np.concatenate([rng.normal(size=(1, 64)) * (1 + rng.integers(0, 2, size=(200, 64)) * 1e-15) for _ in range(2)] + [rng.normal(size=(5, 64))])
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = ann_graph.completed(v, ann_graph.build(v), 0.9)
    links = np.full((len(v), max(map(len, near))), -1, np.int64)
    for i, x in enumerate(near):
        links[i, : len(x)] = x
    want = v @ v.T >= 0.9
    assert all(np.array_equal(x, np.flatnonzero(w)) for x, w in zip(ann_graph.search(v, links, 0.9), want, strict=True))


def test_units_work_their_norm_out_once(spark):
    rng = np.random.default_rng(5)
    rows = [*rng.normal(size=(40, 64)).tolist(), None, [], [0.0, 0.0], [1.0, None], [float("nan")], [float("inf"), 1.0], [3e-200, 4e-200], [3e200, 4e200], [-7.0]]
    d = spark.createDataFrame([(i if i else None, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    v = ann_graph.units(d)
    # what the audit makes of them: a filter that is pushed below the projection repeats its expressions
    used = v.where(F.col("_v").isNotNull()).groupBy("_v").agg(F.first("_unit").alias("_unit"))
    assert "lambda" not in used._jdf.queryExecution().optimizedPlan().toString()
    got = {r["_id"]: r for r in v.collect()}
    assert len(got) == len(rows) and all((r["_v"] is None) == (r["_unit"] is None) for r in got.values())
    for i, x in enumerate(rows):
        unit = got[i if i else None]["_unit"]
        if x and None not in x and np.isfinite(x).all() and any(x):
            scaled = [y / max(map(abs, x)) for y in x]
            norm = float(np.sqrt(functools.reduce(lambda a, y: a + y * y, scaled, 0.0)))
            assert unit == [y / norm for y in scaled]
        else:
            assert unit is None
    assert used.count() == 42  # two of them have one direction


@pytest.mark.parametrize("n", [1, 2, 60, 900])
def test_nearest_come_whole_and_in_order(n):
    rng = np.random.default_rng(n)
    sim = rng.normal(size=(50, n)).astype(np.float32)
    sim[:5, : n // 2] = 1  # many ties
    sim[5:10, ::7] += 9  # the columns that a bar is drawn from may mislead it
    pool = min(n, 72)
    near = ann_graph._top(sim, pool)
    assert all(len(set(x)) == pool for x in near.tolist())
    assert np.array_equal(np.take_along_axis(sim, near, axis=1), -np.sort(-sim, axis=1)[:, :pool])


def test_dense_group_is_divided_without_loss(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    rows = [(base + rng.normal(size=16) * 0.02).tolist() for _ in range(150)]
    d = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann_graph, "SHARD", 10)
    got = ann_graph.near_vectors(d).collect()
    assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}
    assert ann_graph.near_vectors(d.limit(0)).count() == 0


PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><header>Site name</header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div id="cookie-notice">We use cookies and the like of it.</div>
<article><h1>Head&amp;line</h1><p>The first of the paragraphs is long enough to be decided by the rules that are in use here.</p>
<p>Short&nbsp;one.</p><div class="ad">Buy the thing now</div><p>a &lt; b <b>bo</b>ld<br>next</p></article>
<aside>More</aside><div class="comments"><p>I think that this is the best of all the things I have read.</p></div>
<form><p>Your name</p></form><footer>&copy; me</footer></body></html>"""


def test_main_text():
    want = (
        "Head&line The first of the paragraphs is long enough to be decided by the rules that are in use here. Short one. a < b bold next"
    )
    assert html_extract.main_text(PAGE) == want
    assert html_extract.main_text(PAGE.replace("article>", "div>")) == want
    assert [html_extract.main_text(x) for x in (None, "", "<p></p>", "<script>x", "plain", "<p>a<p>b<script>x")] == ["", "", "", "", "plain", "a b"]
    assert html_extract.main_text("<p>" + "word of the " * 50_000 + "</p>") == ("word of the " * 50_000).strip()


def test_pages(spark):
    d = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, None)], "page_id long, url string, html string, text string")
    got = html_extract.extract(d).collect()
    assert [r.n_chars for r in got] == [len(r.text) for r in got] and sorted(r.page_id for r in got) == [1, 1, 2]
    assert html_extract.extract(d.limit(0)).count() == 0


def test_words_are_encoded_together_and_as_by_themselves():
    e = token_output.Encoder(token_output.vocabulary_path())
    real, given = e.tokenizer, []

    class Counting:
        def __getattr__(self, name):
            def call(texts, **options):
                given.extend(texts)
                return getattr(real, name)(texts, **options)

            return call

    e.tokenizer = Counting()
    words = [f"word{i} {i:x}'ll" for i in range(2000)]
    odd = ["<|endoftext|>", "a<|endoftext|>b <|endoftext| |>", "<|ENDOFTEXT|> <|startoftext|>", "", " \t\r\n ", "\u0301 e\u0301 \u0301e", "a\x0bb\u2003c\u3000d \x00", "I'LL don't 's"]
    texts = [" ".join(words), "\t\t".join(words[:9]) + "\n", *odd]
    got = e.encode(texts)
    assert len(given) < 50  # not one a word
    assert e.between is not None and [x.tolist() for x in got] == [[*real.encode(t, add_special_tokens=False).ids, token_output.END_ID] for t in texts]
    e.between = None
    e.words = {"": b""}
    assert all(np.array_equal(a, b) for a, b in zip(got, e.encode(texts), strict=True))


def test_range_coder_round_trip():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, range_coder.ALPHABET, n).astype(np.uint16) for n in (0, 1, 2, 700, 3000)]
    blocks += [np.minimum(rng.zipf(1.2, 2000), range_coder.ALPHABET - 1).astype(np.uint16), np.zeros(2500, np.uint16), np.tile(np.arange(9), 300).astype(np.uint16)]
    codes = range_coder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, range_coder.decode(codes, [len(b) for b in blocks]), strict=True))
    # repeated ids cost almost nothing, random ones about their entropy
    assert len(codes[6]) < 100 and len(codes[7]) < 200 and len(codes[4]) < 2.1 * 3000
    assert range_coder.encode(blocks[3:4])[0] == codes[3]  # a block does not depend on its neighbours


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    parts = ["The", "it's", "naïve", "日本", "👍🏽", "x1y22", "a b", "é", "<|endoftext|>", "!!", " ", "ǅ"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 30]))) for _ in range(60)] + [None, "\n\t ", "word " * 400]
    d = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, payload string").repartition(3)
    token_output.write(d, str(tmp_path / "blocks"), size=64)
    got = {r.doc_id: r for r in token_output.read(spark, str(tmp_path / "blocks")).collect()}
    t, at = Tokenizer.from_file(token_output.vocabulary_path()), 0
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[3 * i].start, got[3 * i].n_tokens, got[3 * i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(got) == len(texts)
    assert token_output.write_and_read(d.limit(0)).count() == 0


def test_damaged_block_is_found(spark, tmp_path):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    token_output.write(d, str(tmp_path / "a"))
    blocks = spark.read.parquet(str(tmp_path / "a"))
    blocks.withColumn("payload", F.expr("concat(substring(payload, 1, 1), X'FF', substring(payload, 3, 100000))")).write.parquet(str(tmp_path / "b"))
    with pytest.raises(Exception, match="damaged"):
        token_output.read(spark, str(tmp_path / "b")).collect()


def test_crc_of_joined_bytes():
    a, b = os.urandom(100), os.urandom(12345)
    assert token_output.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert token_output.crc32_combine(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def awkward(rng):
    return "".join(rng.choice(["the ", "ing", " ", "  ", "ñ", "日本", "\n", "a", "😀", "thing", "ed ", "    ", "▁"]) for _ in range(rng.randrange(1, 70)))


def test_scan_of_chunks_is_the_sequential_cut():
    rng, v = random.Random(3), sp_encode.vocabulary(sp_encode.model_path())
    for _ in range(60):
        text, size = sp_encode.normal(awkward(rng)), rng.choice([16, 23, 40])
        score, ids = v.cut(text)
        assert (score, list(ids)) == (v.encode(text)[0], v.encode(text)[1])
        chunks = [text[i : i + size] for i in range(0, len(text), size)]
        ahead = [text[(k + 1) * size : (k + 1) * size + v.longest] for k in range(len(chunks))]
        m = [sp_encode.transfer(v, c, a) for c, a in zip(chunks, ahead, strict=True)]
        states = sp_encode.cut_states(m)
        traced = [i for k, c in enumerate(chunks) for i in sp_encode.trace(v, c, ahead[k], states[k], states[k + 1])]
        assert sum(x[states[k], states[k + 1]] for k, x in enumerate(m)) == score
        assert sum(v_score(v, traced)) == sum(v_score(v, ids))
        whole = m[0]
        for x in m[1:]:
            whole = sp_encode.product(whole, x)
        assert whole[0, 0] == score


def v_score(v, ids):
    return [v.score[v.pieces[i]][0] if v.pieces[i] in v.score and v.plain[i] else 0 for i in ids]


def test_encoding_and_decoding(spark):
    rng = random.Random(5)
    texts = [awkward(rng) for _ in range(40)] + [None, "", " ", "x" * 500, "the " * 500, "\x00\x7f", " lead and trail "]
    d = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    for chunk, block in ((1 << 16, 64), (100, 64), (100, 3)):
        got = {r.doc_id: r for r in sp_encode.decode(sp_encode.encode(d, chunk=chunk, block=block)).collect()}
        assert len(got) == len(texts)
        assert all(got[i].decoded == (t or "").replace("▁", " ") for i, t in enumerate(texts))
        if chunk == 100:
            assert {i: r.score for i, r in got.items()} == scores
        scores = {i: r.score for i, r in got.items()}
    assert sp_encode.encode(d.limit(0)).count() == 0
    assert sp_encode.encode(d.unionByName(d.limit(2))).count() == len(texts) + 2


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.table(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == docs.columns and 0 < out.count()
        if name != "mixing":
            assert out.count() <= docs.count() and out.count() > 0.5 * docs.count()
        docs = out
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert tokens.count() == docs.count() and n > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "tokens"]
