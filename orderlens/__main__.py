"""Command line: the reference's entry points as Spark jobs.

  python -m orderlens land    --landing DIR --out DIR        (CSV files to Parquet, once)
  python -m orderlens publish --landing DIR --out DIR        (producer: join + encode)
  python -m orderlens ingest  --source DIR --sink DIR --checkpoint DIR [--csv]
                                                             (consumer: checkpointed stream)
  python -m orderlens refresh (--landing DIR | --snapshot DIR [--csv]) --out DIR
                                                             (analysis: all published tables)
  python -m orderlens check   --out DIR                      (serving-side contract checks)

``--single-line`` says that no field of the CSV files holds a newline, so that
they are split into many tasks; ``--parquet`` that a landing was landed before.
``--kafka-bootstrap`` / ``--topic`` switch publish and ingest to Kafka (needs the
connector on the classpath). Paths must be shared storage on a cluster.
"""

from __future__ import annotations

import argparse
import sys

from orderlens.session import get_spark


def _args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="orderlens")
    sub = p.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land")
    land.add_argument("--landing", required=True)
    land.add_argument("--out", required=True)
    pub = sub.add_parser("publish")
    pub.add_argument("--landing", required=True)
    pub.add_argument("--out")
    ing = sub.add_parser("ingest")
    ing.add_argument("--source")
    ing.add_argument("--sink", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--csv", action="store_true", help="write the snapshot as CSV instead of Parquet")
    ing.add_argument("--max-per-trigger", type=int)
    for sp in (pub, ing):
        sp.add_argument("--kafka-bootstrap")
        sp.add_argument("--topic")
    ref = sub.add_parser("refresh")
    src = ref.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing")
    src.add_argument("--snapshot")
    ref.add_argument("--csv", action="store_true", help="the snapshot is CSV")
    ref.add_argument("--out", required=True)
    for sp in (land, pub, ref):
        sp.add_argument("--single-line", action="store_true", help="no CSV field holds a newline")
    for sp in (pub, ref):
        sp.add_argument("--parquet", action="store_true", help="the landing was written by the land command")
    chk = sub.add_parser("check")
    chk.add_argument("--out", required=True)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    spark = get_spark("orderlens-" + a.cmd)
    from orderlens.functions.cleaning import clean
    from orderlens.operators import contracts
    from orderlens.operators.enrich import enrich
    from orderlens.plans.facts import facts_from_raw
    from orderlens.plans.refresh import refresh, refresh_facts
    from orderlens.sources.tables import land_parquet, read_csv_tables, read_landed, read_snapshot
    from orderlens.streaming import publish, read_stream, run_append

    kafka = {"kafka.bootstrap.servers": a.kafka_bootstrap} if getattr(a, "kafka_bootstrap", None) else None
    multiline = not getattr(a, "single_line", False)

    def landed():
        return read_landed(spark, a.landing) if a.parquet else read_csv_tables(spark, a.landing, multiline)

    if a.cmd == "land":
        land_parquet(spark, a.landing, a.out, multiline)
    elif a.cmd == "publish":
        rows = clean(enrich(landed()))
        if kafka:
            publish(rows, fmt="kafka", options={**kafka, "topic": a.topic})
        else:
            publish(rows, fmt="text", path=a.out)
    elif a.cmd == "ingest":
        source = (
            read_stream(spark, fmt="kafka", topic=a.topic, options=kafka, max_per_trigger=a.max_per_trigger)
            if kafka
            else read_stream(spark, fmt="text", path=a.source, max_per_trigger=a.max_per_trigger)
        )
        run_append(source, a.sink, a.checkpoint, fmt="csv" if a.csv else "parquet").awaitTermination()
    elif a.cmd == "refresh":
        if a.landing:
            refresh(spark, landed(), out_dir=a.out)
        else:
            raw = read_snapshot(spark, a.snapshot, multiline) if a.csv else spark.read.parquet(a.snapshot)
            refresh_facts(spark, facts_from_raw(raw), out_dir=a.out)
    elif a.cmd == "check":
        report = contracts.contract_report(spark, a.out)
        report.orderBy("table").show(100, truncate=False)
        contracts.contract_summary(report).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
