"""Archives against a restatement, their bytes against another cluster's layout, damage and repeated commits."""

from __future__ import annotations

import gzip
import hashlib
import os

import pytest

from orderlens.llm import warc

LONG = "<html><body>" + "x" * 200 + "</body></html>"
ROWS = [
    (7, "http://a/7", LONG), (3, "http://a/3", LONG), (9, None, LONG), (None, "http://a/none", LONG), (1, "http://a/1", "short"), (2, "http://a/2", "short"),
    (4, "http://a/4", None), (5, "http://a/5", ""), (6, "http://ä/6 b\r\nX: y", "é" * 99), (8, "http://a/8", "é" * 99), (10, "u", "only " * 5000),
    (11, "same", "twice " * 60), (11, "same", "twice " * 60), (12, "b", "tied " * 60), (12, "a", "tied " * 60), (12, None, "tied " * 60), (13, "x", "a" * 100), (14, "x", "a" * 100),
    (15, "y", "a" * 99 + "b"), (None, None, "no id " * 40), (None, None, "no id " * 40), (20, "z", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
]


def expected(rows):
    out = []
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is None, rows[i][1] or "", i))
    for i in order:
        page_id, _, html = rows[i]
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        owner = first.setdefault(digest, page_id) if len(payload) >= 100 else None
        new = len(payload) < 100 or digest not in expected_seen(out)
        out.append((page_id, len(payload), digest, "response" if new else "revisit", None if new else owner))
    return sorted(map(str, out))


def expected_seen(out):
    return {r[2] for r in out if r[1] >= 100}


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "clash", 0) for r in ROWS], "page_id long, url string, html string, _digest string, _kind int")


def files(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in sorted(os.listdir(path)) if n.endswith(".warc.gz")}


@pytest.mark.parametrize("shard_bytes,file_bytes", [(1 << 20, 1 << 20), (4000, 1 << 20), (4000, 600), (1, 1)])
def test_matches_brute_force(spark, pages, tmp_path, shard_bytes, file_bytes):
    warc.write(pages, str(tmp_path / "w"), shard_bytes=shard_bytes, file_bytes=file_bytes)
    got = warc.read(spark, str(tmp_path / "w")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r)) for r in got.collect()) == expected(ROWS)


def test_same_bytes_on_any_layout(spark, pages, tmp_path):
    warc.write(pages.coalesce(1), str(tmp_path / "a"), shard_bytes=4000, file_bytes=2000)
    warc.write(pages.repartition(7), str(tmp_path / "b"), shard_bytes=4000, file_bytes=2000)
    a, b = files(tmp_path / "a"), files(tmp_path / "b")
    assert a == b and len(a) > 3
    text = gzip.decompress(a["part-000000-00000.warc.gz"])
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert b"\r\nX: y" not in b"".join(gzip.decompress(x) for x in a.values())


def test_payloads_come_back(spark, pages, tmp_path):
    warc.write(pages, str(tmp_path / "w"), shard_bytes=4000)
    back = {r.page_id: bytes(r.payload) for r in warc.read(spark, str(tmp_path / "w"), payloads=True).where("record_type = 'response'").collect()}
    want = {r[0]: (r[2] or "").encode() for r in ROWS}
    assert all(want[k] == v for k, v in back.items() if k is not None)
    assert back[20] == ("\r\n\r\nWARC/1.1\r\n\r\n" * 20).encode()


def test_commit_may_be_repeated_and_damage_is_found(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        warc.read(spark, path)
    warc.write(pages, path, shard_bytes=4000)
    open(f"{path}/.part-000000-00000.warc.gz.lost.tmp", "wb").write(b"an attempt that was lost")
    assert warc.commit(spark, path).count() == len(files(path))
    assert warc.read(spark, path).count() == len(ROWS)
    name = sorted(files(path))[1]
    raw = bytearray(open(f"{path}/{name}", "rb").read())
    raw[-20] ^= 1
    open(f"{path}/{name}", "wb").write(bytes(raw))
    with pytest.raises(Exception, match="part-000001|incorrect data check|invalid"):
        warc.read(spark, path).collect()


def test_empty_table(spark, pages, tmp_path):
    assert warc.write(pages.limit(0), str(tmp_path / "w")).count() == 0
    assert warc.read(spark, str(tmp_path / "w")).count() == 0


def test_a_hot_payload_is_broadcast_and_others_joined(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id as page_id", "'u' as url", "case when id % 3 = 0 then repeat('hot ', 60) else repeat(concat('p', id div 7, ' '), 60) end as html")
    warc.write(rows, str(tmp_path / "w"), shard_bytes=100_000)
    got = warc.read(spark, str(tmp_path / "w"))
    assert got.where("record_type = 'response'").count() == got.select("payload_digest").distinct().count()
    assert got.where("record_type = 'revisit' and refers_to >= page_id").count() == 0
    assert got.where("refers_to = 0").count() == 4000 // 3
