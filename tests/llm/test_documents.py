"""Operators on documents against brute-force versions, with the odd cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from orderlens.llm import curriculum, fingerprint, langid, minhash, quality_crf, toxicity
from orderlens.llm.components import connected_components
from orderlens.llm.split import held_out

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def frame(spark, docs_schema, texts, langs=None, sources=None, ids=None):
    """Documents with extra columns whose names clash with the operators' own."""
    n = len(texts)
    rows = [
        (i if ids is None else ids[i], t, (langs or ["en"] * n)[i], (sources or ["s"] * n)[i], len(t or ""), "x", -1, -1) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, docs_schema)


def near_texts(seed=7):
    """Groups of edited copies around texts, chains of edits, copies, short and empty texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    out = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        now = list(base)
        for k in range(rng.randint(1, 12)):
            if k % 2:
                now = list(base)
            for _ in range(rng.randint(0, 3)):
                now[rng.randrange(len(now))] = rng.choice(vocabulary)
            out.append(" ".join(now) if k % 3 else "\n".join(now).upper())
    return out + ["", None, "  \t", "one two", "ONE  two", "one two three four", out[0], out[0], out[5]]


def expected_components(texts, ids):
    sets = []
    for t in texts:
        w = WORDS.findall((t or "").translate(LOWER))
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)]))
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {ids[i]: (len(sets[i]), ids[top(i)]) for i in range(len(texts))}


def test_near_duplicates_match_brute_force(spark, docs_schema):
    texts = near_texts()
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, docs_schema, texts)).collect()}
    want = expected_components(texts, list(range(len(texts))))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_near_duplicates_odd_rows(spark, docs_schema):
    text = "a b c d e f g h"
    ids = [5, 5, None, 7, 8]
    got = minhash.near_duplicates(frame(spark, docs_schema, [text, text, text, None, ""], ids=ids)).collect()
    assert len(got) == 5
    assert sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in got if r.n_shingles) == [
        (False, 5, 5, True), (False, 5, 5, True), (True, None, 5, False)
    ]
    assert all(r.kept for r in got if not r.n_shingles)
    assert minhash.near_duplicates(frame(spark, docs_schema, [text]).limit(0)).count() == 0
    assert minhash.keep_one(frame(spark, docs_schema, [text, text, "x"], ids=[1, 2, 3])).count() == 2


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_fingerprints_of_edited_texts(spark, docs_schema):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh é\n") for _ in range(rng.choice([0, 1, 2, 7, 900, 3000]))) for _ in range(60)] + [None, "same", "same"]
    got = {r.doc_id: r for r in fingerprint.with_next(frame(spark, docs_schema, texts)).collect()}
    order = sorted(range(len(texts)), reverse=True)
    for k, i in enumerate(order):
        own, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        points = fingerprint.code_points(edited)
        assert r.edited_fingerprint == fingerprint.fingerprint(points, fingerprint.walk(fingerprint.classes_of(points)))
        assert 0 <= r.near_next <= 1
        if len(own) >= 900 and len(following) >= 500:
            assert 0.3 < r.near_edited < 0.75 and r.near_next < 0.35
    assert got[len(texts) - 1].fingerprint == got[len(texts) - 2].fingerprint and got[len(texts) - 1].near_next == 1.0


def test_fingerprints_odd_tables(spark, docs_schema):
    one = fingerprint.with_next(frame(spark, docs_schema, ["abcdef"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert fingerprint.with_next(frame(spark, docs_schema, ["a"]).limit(0)).count() == 0
    assert fingerprint.with_next(frame(spark, docs_schema, ["a", "b", "c"], ids=[1, 1, None])).count() == 3


@pytest.mark.parametrize("block", [2048, 7])
def test_near_classes_match_brute_force(spark, block, monkeypatch):
    rng = random.Random(17)
    digits = "0123456789abcdef"
    prints = [fingerprint._ZERO]
    template = "".join(rng.choice(digits) for _ in range(64))
    for k in range(12):  # a template gives bands that all groups share; members differ from each other by up to 30 values
        base = (template if k % 2 else "") + "".join(rng.choice(digits) for _ in range(192 if k % 2 else 256))
        for _ in range(rng.randint(1, 9)):
            p = list(base)
            for _ in range(rng.randint(0, 15)):
                p[rng.randrange(256)] = rng.choice(digits)
            prints.append("".join(p))
    prints += prints[:5]
    monkeypatch.setattr(fingerprint, "BLOCK", block)
    rows = [(500 - i, p) for i, p in enumerate(prints)] + [(None, prints[1]), (None, fingerprint._ZERO), (7, fingerprint._ZERO)]
    d = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = {(r.doc_id, r.fingerprint): r.class_id for r in fingerprint.near_classes(d).collect()}
    distinct = sorted(set(prints) - {fingerprint._ZERO})
    near = {p: {q for q in distinct if fingerprint.likeness(p, q) >= 0.9 and set(fingerprint.bands(p)) & set(fingerprint.bands(q))} for p in distinct}
    assert sum(map(len, near.values())) > len(distinct) + 100
    for i, p in rows:
        reached, todo = {p}, [p]
        while todo and p in near:
            more = near[todo.pop()] - reached
            reached |= more
            todo += more
        want = None if i is None else i if p == fingerprint._ZERO else min(j for j, q in rows if q in reached and j is not None)
        assert got[i, p] == want
    assert len(got) == len(set(rows)) and fingerprint.near_classes(d).count() == len(rows)
    assert fingerprint.near_classes(d.limit(0)).count() == 0


def test_walk_is_the_step_by_step_walk():
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 256, 500)
    step, ends = 0, []
    for c in classes:
        while not fingerprint._bits[step % fingerprint.PERIOD, c]:
            step += 1
        step += 1
        ends.append(step)
    assert fingerprint.walk(classes).tolist() == ends


SAMPLE = {
    "en": "the of and that with from this have been which their would there about people other into could more ",
    "de": "der und die das nicht auf eine sich auch werden einer nach sind haben über einen durch wurde noch ",
    "fr": "les des une que dans pour pas sur qui avec sont mais comme nous vous cette leur elle tout être ",
}


def sentences(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    words = SAMPLE[lang].split()
    return [" ".join(rng.choice(words) for _ in range(rng.randint(20, 120))).capitalize() + "." for _ in range(n)]


def test_language_of_held_out_texts(spark, docs_schema):
    texts, langs = [], []
    for lang in SAMPLE:
        texts += sentences(lang, 60, 1)
        langs += [lang] * 60
    texts += [None, "123 !!", "", "ÜBER DER UND DIE NICHT !!!"]
    langs += ["en", None, "de", None]
    got = {r.doc_id: r for r in langid.predict(frame(spark, docs_schema, texts, langs)).collect()}
    assert len(got) == len(texts)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in range(180, 183)) and got[183].lang_pred == "de"
    held = [i for i in range(180) if got[i].held_out]
    assert held == [i for i in range(180) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].lang_pred == langs[i] for i in held]) > 0.95
    assert langid.predict(frame(spark, docs_schema, texts[:3], [None] * 3)).where("lang_pred = 'und'").count() == 3


def test_dictionary_is_drawn_from_all_of_the_sample(spark, docs_schema):
    rng = random.Random(31)
    marks = ["".join(rng.choice("bcdfghjk") for _ in range(9)) for _ in range(300)]
    texts = [" ".join(rng.choice(["the", "of", "and", "which", "people"]) + ("" if k % 8 else " " + m) for k in range(700)) for m in marks]
    raw = langid.learn(frame(spark, docs_schema, [*texts, "12"], ["en"] * 300 + ["xx"]))
    held = [m.encode() in raw["en"] for m in marks]
    assert len(raw["en"]) == langid.DICT_BYTES and raw["xx"] == b""
    assert sum(held) > 200 and min(sum(held[:150]), sum(held[150:])) > 90
    late = langid.learn(frame(spark, docs_schema, ["the of and " * 300 + "zebra"], ["en"]))
    assert b"zebra" in late["en"]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_quality_of_held_out_texts(spark, docs_schema):
    rng = random.Random(5)
    good = ["\n".join(sentences("en", rng.randint(1, 5), k)) for k in range(150)]
    bad = [re.sub(r" ", "%%% ", t).upper() for t in good[:75]] + ["\n".join(["BUY !! NOW !!"] * 6)] * 20
    texts = good + bad + [None, "", "\n\n", "x " * 30_000]
    labels = [(i, int(i < 150), 0, "clash") for i in range(245)] + [(9999, 1, 0, ""), (3, None, None, None)]
    got = {r.doc_id: r for r in quality_crf.predict(frame(spark, docs_schema, texts), labelled(spark, labels)).collect()}
    held = [i for i in range(245) if got[i].held_out]
    assert held == [i for i in range(245) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].predicted == int(i < 150) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values()) and len(got) == len(texts)
    none = quality_crf.predict(frame(spark, docs_schema, texts[:4]), labelled(spark, []))
    assert {r.score for r in none.collect()} == {0.5}


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    emit, trans = rng.normal(size=7), rng.normal(size=(2, 2))
    lines = np.array([4, 0, 1, 2])
    got, at = quality_crf.marginals(emit, trans, lines), 0
    for n in lines:
        weight, good = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            p = np.exp(sum(emit[at + k] for k in range(n) if y[k]) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False)))
            weight, good = weight + p, good + p * np.array(y)
        if n:
            assert np.allclose(got[at : at + n], good / weight)
        at += n


def test_toxicity_of_held_out_texts(spark, docs_schema):
    rng = random.Random(6)
    clean = sentences("en", 400, 9)
    texts = [t if i % 4 else t.replace(" the ", " the scumbag ", 2) + " scumbag loser!" for i, t in enumerate(clean)] + [None, ""]
    labels = [(i, 1, int(i % 4 == 0), "") for i in range(400)]
    got = {r.doc_id: r for r in toxicity.predict(frame(spark, docs_schema, texts), labelled(spark, labels)).collect()}
    held = [i for i in range(400) if got[i].held_out]
    assert np.mean([got[i].predicted == int(i % 4 == 0) for i in held]) > 0.95 and len(got) == 402
    assert got[400].score == got[401].score < 0.5
    none = toxicity.predict(frame(spark, docs_schema, texts[:4]), labelled(spark, []))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.5, 1)}
    assert rng is not None


def borderline(n, rare, seed):
    """Texts whose words say a little of their class, and labels of which one in ``rare`` is 1."""
    rng = random.Random(seed)
    labels = [int(rng.random() < 1 / rare) for _ in range(n)]
    words = [f"word{k}" for k in range(40)]
    return [" ".join(rng.choice(words[8 * y : 32 + 8 * y]) for _ in range(12)) for y in labels], labels


def test_toxicity_does_not_depend_on_the_sample_bound(spark, docs_schema, monkeypatch):
    texts, toxic = borderline(3000, 10, 21)
    docs, labels = frame(spark, docs_schema, [*texts, None]), labelled(spark, [(i, 1, y, "") for i, y in enumerate(toxic)])
    whole = {r.doc_id: r.score for r in toxicity.predict(docs, labels).collect()}
    monkeypatch.setattr(toxicity, "SAMPLE_DOCS", 300)
    part = {r.doc_id: r.score for r in toxicity.predict(docs, labels).collect()}

    def odds(p):
        return np.log(p / (1 - p))

    moved = np.mean([odds(part[i]) - odds(whole[i]) for i in range(3000)])
    assert abs(moved) < 1
    assert part[3000] < 0.2  # at equal shares a text without words scores about 0.5
    assert abs(np.mean([part[i] >= 0.5 for i in part]) - np.mean([whole[i] >= 0.5 for i in whole])) < 0.03


def test_quality_does_not_depend_on_the_sample_bound(spark, docs_schema, monkeypatch):
    texts, bad = borderline(3000, 8, 22)
    # marks are what a line is measured by
    rng = random.Random(23)
    texts = [" ".join(w + ("!" if rng.random() < 0.1 + 0.1 * y else "") for w in t.split()) for t, y in zip(texts, bad, strict=True)]
    docs, labels = frame(spark, docs_schema, [*texts, None, "", "\n \n"]), labelled(spark, [(i, 1 - y, 0, "") for i, y in enumerate(bad)])
    whole = {r.doc_id: r.score for r in quality_crf.predict(docs, labels).collect()}
    kept = quality_crf.keep_good(docs, labels).count()
    monkeypatch.setattr(quality_crf, "SAMPLE_DOCS", 300)
    part = {r.doc_id: r.score for r in quality_crf.predict(docs, labels).collect()}
    share = np.mean([1 - y for i, y in enumerate(bad) if zlib.crc32(str(i).encode()) % 3 != 1])
    assert all(abs(s[i] - share) < 1e-9 for s in (whole, part) for i in range(3000, 3003))
    assert abs(np.mean([part[i] - whole[i] for i in range(3000)])) < 0.05
    assert abs(quality_crf.keep_good(docs, labels).count() - kept) < 0.05 * len(whole)


def shares(sizes, weights, total):
    """Targets by resharing the excess until no source is above twice its size."""
    target, fixed = {}, {}
    while True:
        open_ = [s for s in sizes if s not in fixed]
        left = total - sum(fixed.values())
        all_weight = sum(weights[s] for s in open_)
        target = {s: fixed.get(s, left * weights[s] / all_weight if open_ else 0) for s in sizes}
        over = [s for s in open_ if target[s] > 2 * sizes[s]]
        if not over:
            return target
        for s in over:
            fixed[s] = 2 * sizes[s]


@pytest.mark.parametrize("names", [["a", "b", "c"], ["a", "z", None, "ä", "B"], ["only"]])
def test_mix_meets_the_targets(spark, docs_schema, names):
    rng = random.Random(len(names))
    texts = [" ".join(["w"] * rng.choice([0, 1, 5, 40, 300])) for _ in range(200)] + [None]
    sources = [names[0] if i % 3 == 0 else rng.choice(names) for i in range(201)]
    d = frame(spark, docs_schema, texts, sources=sources)
    got = {r.doc_id: r for r in curriculum.mix(d).collect()}
    assert {i: (r.size, r.taken) for i, r in got.items()} == {r.doc_id: (r.size, r.taken) for r in curriculum.mix(d.repartition(3)).collect()}
    sizes = defaultdict(int)
    for i, t in enumerate(texts):
        sizes[sources[i]] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    want = shares(sizes, weights, 1.5 * sum(sizes.values()))
    for i, r in got.items():
        assert r.source_size == sizes[sources[i]] and abs(r.target - want[sources[i]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size and len(r.positions) == (r.taken > 0) + (r.taken > r.size)
    for s in sizes:
        assert abs(sum(r.taken for i, r in got.items() if sources[i] == s) - want[s]) <= 1
    assert all(0 <= p <= 1 for r in got.values() for p in r.positions)
    assert curriculum.mix(d.limit(0)).count() == 0


def test_schedules_are_inverted(spark):
    from pyspark.sql import functions as F

    for knots in curriculum.SCHEDULES:
        grid = np.linspace(0, 1, 2001)
        w = np.interp(grid, [k[0] for k in knots], [k[1] for k in knots])
        area = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
        for r in spark.range(11).select((F.col("id") / 10).alias("u")).withColumn("t", curriculum.invert(F.col("u"), knots)).collect():
            assert abs(np.interp(r.t, grid, area / area[-1]) - r.u) < 1e-3


def test_held_out_is_the_remainder(spark):
    rows = spark.range(50).withColumn("h", held_out("id", 5, 0)).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_remembered_words_stay_right_over_generations(monkeypatch):
    from orderlens.llm import sp_encode

    monkeypatch.setattr(sp_encode, "_REMEMBERED", 7)
    v, fresh = sp_encode.Vocabulary(sp_encode.model_path()), sp_encode.vocabulary(sp_encode.model_path())
    rng = random.Random(3)
    pool = [("the" if k < 3 else "") + "".join(rng.choice("abcdeé日 ") for _ in range(rng.randint(1, 9))) for k in range(60)]
    for _ in range(20):
        text = sp_encode.normal(" ".join(rng.choice(pool) for _ in range(rng.randint(0, 40))))
        parts = [fresh.cut(w) for w in sp_encode.words(text)]
        assert v.encode(text) == (sum(p[0] for p in parts), [i for p in parts for i in p[1]])
        assert len(v.words) <= 7 and len(v.older) <= 7


def test_cut_of_a_word_is_the_best_of_all_cuts_and_walks_no_trie():
    from orderlens.llm import sp_encode

    def best(v, text):  # by all substrings, the longest last piece first
        at = [(0.0, ())]
        for j in range(1, len(text) + 1):
            options = []
            for i in range(max(0, j - v.longest), j):
                known = v.score.get(text[i:j])
                if known or i == j - 1:
                    options.append((at[i][0] + (known[0] if known else v.worst), -i, at[i][1] + v.ids_of(text[i:j])))
            score, _, ids = max(options, key=lambda x: x[:2])
            at.append((score, ids))
        return at[-1]

    given = sp_encode.Vocabulary(sp_encode.model_path())
    # scores with ties, a character ("c") that has no piece of its own, no bytes
    tied = sp_encode.Vocabulary.__new__(sp_encode.Vocabulary)
    tied.score = {p: (float(w), i) for i, (p, w) in enumerate({"a": -1, "b": -1, "ab": -2, "ba": -2, "abc": -4, "cb": -3, "aab": -3, "bb": -3}.items(), 1)}
    tied.byte, tied.unknown, tied.longest, tied.worst, tied.words, tied.older = {}, 0, 3, -9.0, {}, {}
    rng = random.Random(11)
    for v, letters in ((given, ["▁", "the", "ing", "é", "日本", "\n", "a", "😀", "\ue000", "\x00", "&&&", "47"]), (tied, ["a", "b", "c", "é", "\ue000", "\ue001"])):
        for _ in range(300):
            text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 14)))
            assert v.cut(text) == best(v, text)
        assert "trie" not in v.__dict__
