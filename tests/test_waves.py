"""The round trips in waves: landed messages don't pile up, nothing is lost or counted twice."""

from __future__ import annotations

import datetime
import glob
import gzip

import pytest

from orderlens.operators import marts
from orderlens.plans import stream_job
from orderlens.plans.facts import facts
from orderlens.session import shuffles_dropped
from orderlens.streaming.batches import kpi_from_state, read_state, revenue_from_state

ORDERS = 60


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Tables of the driver's schema: a null and a repeated order key among them."""
    at, day = str(tmp_path_factory.mktemp("waves")), datetime.datetime(1996, 1, 2)
    orders = [(k, k % 7, "FOP"[k % 3], 10.5 + k, day + datetime.timedelta(days=k), f"{k % 5}-P") for k in range(1, ORDERS + 1)]
    orders += [(None, 3, "F", 1.0, day, "1-P"), orders[4]]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    ).write.parquet(f"{at}/orders.parquet")
    items = [(k, k % 9, k % 4, n, 100.25 + k + n, 0.05, day + datetime.timedelta(days=k + 31 * (n - 1))) for k in range(1, ORDERS + 1) for n in range(1, 1 + k % 4)]
    spark.createDataFrame(
        items, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_tax double, l_shipdate timestamp"
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(k, f"Brand#{k}", k + 10) for k in range(9)], "p_partkey long, p_brand string, p_size int").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(k, k % 3, "M") for k in range(6)], "c_custkey long, c_nationkey long, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(k, f"N{k}") for k in range(3)], "n_nationkey long, n_name string").write.parquet(f"{at}/nation.parquet")
    return at


@pytest.fixture
def base(monkeypatch, tmp_path):
    """Three waves into folders that the test knows."""
    monkeypatch.setattr(stream_job, "run_folder", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(stream_job, "waves_of", lambda spark, sf_dir: 3)
    return tmp_path


def landed(folder) -> int:
    files = glob.glob(f"{folder}/landing/part-*")
    assert all(f.endswith(".txt.gz") for f in files)
    return sum(len(gzip.open(f).read().splitlines()) for f in files)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_parquet_round_trip_keeps_no_more_than_the_last_waves(spark, sf_dir, base):
    f = facts(spark, sf_dir)
    assert rows(stream_job.ingest_roundtrip(spark, sf_dir)) == rows(marts.late_delivery_by_state(f))
    assert spark.read.parquet(str(base / "stream/snapshot")).count() == f.count()
    assert 0 < landed(base / "stream") < f.count()


def test_csv_round_trip_keeps_no_more_than_the_last_waves(spark, sf_dir, base):
    f = facts(spark, sf_dir)
    assert rows(stream_job.csv_snapshot_roundtrip(spark, sf_dir)) == rows(marts.avg_payment_by_type(f))
    assert glob.glob(str(base / "snapshot/snapshot/part-*")) == glob.glob(str(base / "snapshot/snapshot/part-*.csv.gz"))
    assert 0 < landed(base / "snapshot") < f.count()


def test_state_of_waves_through_a_repeated_batch(spark, sf_dir, base):
    f = facts(spark, sf_dir)
    state = stream_job.streamed_state(spark, sf_dir)
    assert rows(revenue_from_state(state)) == rows(marts.revenue_by_state(f))
    batches = spark.read.parquet(str(base / "state/state/batches"))
    assert {r.batch_id for r in batches.select("batch_id").distinct().collect()} == set(range(5))
    # the broken-off batch was compacted, then repeated
    assert [r.version for r in spark.read.parquet(str(base / "state/state/complete")).collect()] == [2]
    assert 0 < landed(base / "state") < f.count()
    assert read_state(spark, str(base / "state/state")).count() == batches.count()  # an order is in one batch


def test_kpi_of_waves(spark, sf_dir, base):
    """An order without an id, a repeated one and the broken-off batch count as in one pass."""
    state = stream_job.streamed_state(spark, sf_dir)
    assert rows(kpi_from_state(state)) == rows(marts.kpi_summary(facts(spark, sf_dir)))
    assert 0 < landed(base / "state") < facts(spark, sf_dir).count()


def test_waves_grow_with_the_tables(spark, sf_dir, monkeypatch):
    assert stream_job.waves_of(spark, sf_dir) == 1
    monkeypatch.setattr(stream_job, "WAVE_BYTES", 4096)
    assert 1 < stream_job.waves_of(spark, sf_dir) <= stream_job.MOST_WAVES


def test_shuffle_cleanup_is_set_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == before
