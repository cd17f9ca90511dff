"""Near duplicates: brute force at any width, groups below the threshold, short partitions, rows that keep_one drops."""

from __future__ import annotations

import random

import pytest

from orderlens.llm import minhash
from orderlens.llm import textbatch as tb

import pyarrow as pa


def shingles(text, width):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, width=5, percent=75):
    sets = {i: shingles(t, width) for i, t in rows}
    least = {i: i for i in sets}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                least[y] = x
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def family(rng, base, n, change):
    """``n`` texts that differ from ``base`` in ``change`` words each, at places of their own."""
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), change):
            words[at] = f"z{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("n", range(7))
@pytest.mark.parametrize("width", range(1, 9))
def test_shingles_of_few_words(n, width):
    text = " ".join(f"w{i}" for i in range(n))
    column = pa.array([text, None, "", text + " more"])
    values, per = tb.distinct_sets(*tb.shingles(tb.hashes(*_words(column)[:3]), _words(column)[3], width))
    assert per.tolist() == [len(shingles(t, width)) for t in (text, None, "", text + " more")]
    _, alone = minhash.shingle_sets(pa.array([text]), width)
    assert alone.tolist() == [len(shingles(text, width))]


def _words(column):
    data, offsets = tb.utf8(column)
    starts, ends, counts = tb.spans(data, offsets)
    return data, starts, ends, counts


@pytest.mark.parametrize("width,percent", [(5, 75), (3, 85)])
def test_matches_brute_force(spark, monkeypatch, width, percent):
    monkeypatch.setattr(minhash, "FAMILY_BLOCK", 8)  # several blocks a family
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(width * percent)
    texts = [None, "", " ", "x y", "x y z", "X  y", "one two three four", "One two three four"]
    for change in (1, 2, 3, 4):
        base = [f"b{change}-{rng.randrange(10**6)}" for _ in range(60)]
        texts += family(rng, base, 14, change) + [" ".join(base)] * 3
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {tuple(r) for r in minhash.near_duplicates(df, percent=percent, width=width).collect()}
    assert got == brute(rows, width, percent)


def test_a_family_below_the_threshold_writes_no_pairs(spark, monkeypatch, tmp_path):
    rng = random.Random(1)
    base = [f"t{i}" for i in range(300)]
    rows = list(enumerate(family(rng, base, 200, 12)))  # pairwise similarity about 0.67
    sizes = {}
    plain = minhash.table

    def counted(df, name):
        out = plain(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash, "table", counted)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in got.collect()} == brute(rows)
    assert sizes["links"] == 0 and sizes["likely"] <= 12 * len(rows)


def test_keep_one_goes_by_rows(spark, tmp_path):
    base = [f"k{i}" for i in range(50)]
    near = " ".join(base[:-1] + ["other"])
    text = " ".join(base)
    rows = [(None, text, "a"), (None, near, "a"), (7, text, "b"), (7, "quite another text of seven words", "b"), (3, near, "c"), (None, "", "d"), (None, None, "d"), (8, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    got = sorted(str(tuple(r)) for r in minhash.keep_one(docs).collect())
    assert got == sorted(str(r) for r in [rows[3], rows[4], rows[5], rows[6], rows[7]])
    assert minhash.keep_one(docs.limit(0)).count() == 0
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    scanned = spark.read.parquet(str(tmp_path / "docs"))
    again = sorted(str(tuple(r)) for r in minhash.keep_one(scanned).collect())
    assert again == got and "numbered" not in minhash._numbered(scanned, "_place")._jdf.queryExecution().toString()
