"""The command line drives publish -> ingest -> refresh -> check end to end."""

from __future__ import annotations

import contextlib
import io

from fixtures import basic
from orderlens.__main__ import main
from orderlens.sources.sinks import read_table
from orderlens.sources.tables import write_csv_tables


def test_cli_pipeline(spark, tmp_path):
    landing, msgs, snap, out = (str(tmp_path / n) for n in ("landing", "msgs", "snap", "out"))
    write_csv_tables(basic(spark), landing)
    assert main(["publish", "--landing", landing, "--out", msgs]) == 0
    assert main(["ingest", "--source", msgs, "--sink", snap, "--checkpoint", str(tmp_path / "chk")]) == 0
    assert main(["refresh", "--snapshot", snap, "--out", out]) == 0
    kpi = read_table(spark, out, "kpi_summary").first()
    assert kpi.total_revenue == 330.30 and kpi.total_orders == 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        assert main(["check", "--out", out]) == 0
    assert "error" not in buf.getvalue()
    assert main(["refresh", "--landing", landing, "--out", str(tmp_path / "out2")]) == 0
    assert read_table(spark, str(tmp_path / "out2"), "kpi_summary").first() == kpi
