"""S1 landing CSV scan, S8 snapshot scan, S11 translation lookup."""

from __future__ import annotations

from fixtures import basic
from orderlens.functions.cleaning import clean
from orderlens.operators import marts
from orderlens.operators.enrich import enrich
from orderlens.plans.facts import facts_from_raw, facts_from_tables
from orderlens.sources import read_csv_tables, read_snapshot, read_translation, translate_categories
from orderlens.sources.tables import write_csv_tables


def test_landing_csv_roundtrip(spark, tmp_path):
    landing = str(tmp_path / "landing")
    write_csv_tables(basic(spark), landing)
    back = facts_from_tables(read_csv_tables(spark, landing))
    kpi = marts.kpi_summary(back).first()
    assert kpi.total_revenue == 330.30 and kpi.total_orders == 2
    assert [tuple(r) for r in marts.revenue_by_state(back).collect()] == [
        tuple(r) for r in marts.revenue_by_state(facts_from_tables(basic(spark))).collect()
    ]


def test_snapshot_scan_keeps_awkward_comments(spark, tmp_path):
    text = 'late,\n"really" late'
    e = clean(enrich(basic(spark)))
    from pyspark.sql import functions as F

    e = e.withColumn("review_comment_message", F.lit(text))
    path = str(tmp_path / "snap")
    e.write.option("header", True).option("escape", '"').csv(path)
    raw = read_snapshot(spark, path)
    assert raw.count() == e.count()
    assert {r.review_comment_message for r in raw.collect()} == {text}
    assert marts.kpi_summary(facts_from_raw(raw)).first().total_revenue == 330.30


def test_translation_lookup(spark, tmp_path):
    path = tmp_path / "translation.csv"
    path.write_text("﻿product_category_name,product_category_name_english\ntoys,toys_en\nbooks,books_en\n",
                    encoding="utf-8")
    tr = read_translation(spark, str(path))
    out = translate_categories(marts.revenue_by_category(facts_from_tables(basic(spark))), tr)
    got = {r.product_category_name: r.product_category_name_english for r in out.collect()}
    assert got == {"toys": "toys_en", "unknown": None}
