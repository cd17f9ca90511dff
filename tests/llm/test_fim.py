"""Fill-in-middle against a restatement by regular expressions."""

from __future__ import annotations

import hashlib
import re

import pytest

from orderlens.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = [
    None, "", " ", "\t\n ", "one", " one", "one ", "one two", "  a  b\tc\n", "é ü ß 漢字 🙂 end ", "has <P> inside", "a <S>", "<M>", "< P> <P", "x<", ">y <",
    " ".join(f"w{i}" for i in range(3000)), "z" * 300_000, "tab\x0bvt\x0cff\rcr", "same", "same", "nul\x00 byte", " em space is no blank",
]


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        form, out = "plain", text
    elif h4 % 100 < 80:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    else:
        form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    plain = form == "plain"
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return n, form, None if plain else len(p), None if plain else len(m), digest(out), digest(text), out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i + 100 * k, t, k, "clash") for k in range(12) for i, t in enumerate(TEXTS)] + [(None, "no id at all", 0, "clash")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, n int, output string")


def test_matches_brute_force(spark, docs):
    rows = fim.transform(docs).collect()
    assert len(rows) == docs.count()
    want = {(r.doc_id, r.text): brute(r.doc_id, r.text) for r in docs.collect()}
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    for (doc_id, _), w in want.items():
        assert got[doc_id] == {w}
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_outputs_restore(spark, docs):
    out = fim.restored(fim.transform(docs)).join(docs.select("doc_id", "text").distinct(), "doc_id")
    assert out.where("restored != coalesce(text, '')").count() == 0


def test_rates_and_seed(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'a b c d e f' as text")
    none = fim.transform(docs, rule=fim.Rule(rate=0)).select("form").distinct().collect()
    every = {r.form: r["count"] for r in fim.transform(docs, rule=fim.Rule(rate=100, suffix_first=50)).groupBy("form").count().collect()}
    assert [r.form for r in none] == ["plain"]
    assert set(every) == {"psm", "spm"} and abs(every["psm"] - 1500) < 200
    one, two = ([r.form for r in fim.transform(docs, rule=fim.Rule(seed=s)).orderBy("doc_id").select("form").collect()] for s in (1, 2))
    assert one != two


def test_partitions_do_not_matter_and_empty(spark, docs):
    one = sorted(map(str, fim.digests(docs.coalesce(1)).collect()))
    assert one == sorted(map(str, fim.digests(docs.repartition(13)).collect()))
    assert fim.digests(docs.limit(0)).collect() == []


def test_split_and_add_are_exact():
    raw = bytes(range(97, 123))
    whole = fim.Pieces((memoryview(raw), memoryview(fim.SENTINELS)), ((fim.TEXT, 0, 10), (fim.TEXT, 10, 16)))
    for a in range(27):
        for b in range(a, 27):
            x, y, z = whole.split(a, b)
            assert (x.render(), y.render(), z.render()) == (raw[:a], raw[a:b], raw[b:])
            assert (x + y + z).sha256() == hashlib.sha256(raw).hexdigest()
