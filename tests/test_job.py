"""End-to-end run: verdict staging, outputs, counts, backfill modes (§3.1, K1-K5, F5)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rowgate.contract import ContractError
from rowgate.plans.job import EmptyInput, run
from tests import feed_files
from tests.conftest import CONTRACT

AS_OF = dt.date(2026, 4, 1)


def test_run_outputs_and_counts(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    res = run(spark, src, out, CONTRACT, as_of=AS_OF)
    assert res.counts == {"rows": 18, "valid_rows": 8, "invalid_rows": 10, "violations": 12}
    silver = spark.read.parquet(f"{out}/silver")
    assert silver.count() == 8
    assert "business_date" in silver.columns and "_source_file" not in silver.columns
    q = spark.read.parquet(f"{out}/quarantine")
    assert q.count() == 10 and {"rejection_reasons", "violations", "_delimiter_issue"} <= set(q.columns)
    rep = spark.read.option("header", "true").csv(f"{out}/report")
    assert rep.count() == 12
    assert rep.columns[:3] == ["record_id", "source_file", "business_date"] and "violation" in rep.columns
    assert rep.where(F.col("violation").contains("|")).count() == 0
    by_file = {r._source_file: r for r in spark.read.parquet(f"{out}/summary_by_file")
               .groupBy("_source_file").agg(F.sum("valid_rows").alias("valid_rows")).collect()}
    assert by_file["payments_2026-03-02.csv"].valid_rows == 3
    by_rule = spark.read.parquet(f"{out}/summary_by_rule").agg(F.sum("violations")).first()[0]
    assert by_rule == 12


def test_backfill_dynamic_keeps_other_dates(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF)
    before = spark.read.parquet(f"{out}/silver").count()
    run(spark, src, out, CONTRACT, as_of=AS_OF, start="2026-03-03", end="2026-03-03")
    after = spark.read.parquet(f"{out}/silver")
    assert after.count() == before
    run(spark, src, out, CONTRACT, as_of=AS_OF, start="2026-03-03", end="2026-03-03", overwrite="static")
    history = spark.read.parquet(f"{out}/run_metrics").collect()
    assert len(history) == 3 and sorted(r.rows for r in history) == [5, 5, 18]
    assert all(r.sec_total > 0 for r in history)
    dates = {str(r[0]) for r in spark.read.parquet(f"{out}/silver").select("business_date").distinct().collect()}
    assert dates == {"2026-03-03", "2026-03-04"}


def test_quarantine_keeps_raw_line(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, keep_line=True)
    q = spark.read.parquet(f"{out}/quarantine").where("record_id = 'B4'").first()
    assert q._line == "B4,2026-03-02 03:00:04,2026-03-02,ACH_GATEWAY,EUR,44.00" and q._malformed
    assert "_line" not in spark.read.parquet(f"{out}/silver").columns


def test_drift_policies(spark, scratch):
    df = spark.createDataFrame([("X1", "2026-03-01", "extra")], "record_id string, business_date string, notes string")
    res = run(spark, df, os.path.join(scratch, "o1"), CONTRACT, as_of=AS_OF, on_missing="null_fill",
              on_unexpected="drop")
    assert ("notes", "unexpected") in res.drift and ("amount", "missing") in res.drift
    assert "notes" not in spark.read.parquet(os.path.join(scratch, "o1", "verdict")).columns
    with pytest.raises(Exception):
        run(spark, df, os.path.join(scratch, "o2"), CONTRACT, as_of=AS_OF)


def _snapshot(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names}


def test_nothing_is_written_before_the_guards(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF)
    before = _snapshot(out)
    with pytest.raises(EmptyInput):
        run(spark, src, out, CONTRACT, as_of=AS_OF, start="2030-01-01")
    with pytest.raises(ContractError):
        run(spark, spark.createDataFrame([("X",)], "record_id string"), out, CONTRACT, as_of=AS_OF)
    for source, target in ((src, src), (src, os.path.join(src, "out")), (os.path.join(out, "bronze"), out)):
        with pytest.raises(ContractError):
            run(spark, source, target, CONTRACT, as_of=AS_OF)
    assert _snapshot(out) == before


def _ids(spark, path, fmt="parquet"):
    return sorted(r.record_id for r in spark.read.option("header", "true").format(fmt).load(path).select("record_id").collect())


def test_backfill_replaces_what_its_files_gave(spark, scratch):
    """A late row of another file's date stays apart from that file's rows, and a
    file that has no good (or no bad) row any more leaves none behind."""
    src = os.path.join(scratch, "in")
    line = "{},2026-03-0{} 10:00:00,2026-03-0{},WIRE_HUB,EUR,{},NEW,ART,FR".format
    feed_files.write(src, {"payments_2026-03-03.csv": [line("A1", 3, 3, "1.00"), line("A2", 4, 4, "2.00"), line("A9", 3, 3, "x")],
                           "payments_2026-03-04.csv": [line("B1", 4, 4, "3.00"), line("B2", 4, 4, "y")]})
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF)
    day = dict(start="2026-03-03", end="2026-03-03")
    run(spark, src, out, CONTRACT, as_of=AS_OF, **day)
    assert _ids(spark, f"{out}/silver") == ["A1", "A2", "B1"] and _ids(spark, f"{out}/quarantine") == ["A9", "B2"]
    assert _ids(spark, f"{out}/report", "csv") == ["A9", "B2"] and len(_ids(spark, f"{out}/bronze")) == len(_ids(spark, f"{out}/verdict")) == 5
    assert spark.read.parquet(f"{out}/summary_by_rule").count() == 2
    feed_files.write(src, {"payments_2026-03-03.csv": [line("A1", 3, 3, "z")], "payments_2026-03-04.csv": [line("B1", 4, 4, "3.00")]})
    run(spark, src, out, CONTRACT, as_of=AS_OF, **day)
    assert _ids(spark, f"{out}/silver") == ["B1"] and _ids(spark, f"{out}/quarantine") == ["A1", "B2"]
    run(spark, src, out, CONTRACT, as_of=AS_OF, start="2026-03-04")
    assert _ids(spark, f"{out}/silver") == ["B1"] and _ids(spark, f"{out}/quarantine") == ["A1"] == _ids(spark, f"{out}/report", "csv")


def test_dynamic_run_over_a_frame(spark, scratch):
    out = os.path.join(scratch, "out")
    row = lambda i, f, amount="1.00": (i, "2026-03-01 10:00:00", "2026-03-01", "WIRE_HUB", "EUR", amount, "NEW", "ART", "FR", f)
    names = [*feed_files.HEADER.split(","), "_source_file"]
    frame = lambda *rows: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    run(spark, frame(row("A", "f1"), row("B", "f2"), row("C", "f2", "bad")), out, CONTRACT, as_of=AS_OF)
    run(spark, frame(row("D", "f2"), row("E", "f3", "bad")), out, CONTRACT, as_of=AS_OF, overwrite="dynamic")
    assert _ids(spark, f"{out}/silver") == ["A", "D"] and _ids(spark, f"{out}/quarantine") == ["E"]


def test_run_reports_header_drift(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    lines = ["D1,2026-03-05 10:00:00,2026-03-05,WIRE_HUB,EUR,NEW,5.00,ART,FR"]
    feed_files.write(src, {"payments_2026-03-05.csv": lines}, header=feed_files.HEADER.replace("amount,status", "status,amount"))
    out = os.path.join(scratch, "out")
    res = run(spark, src, out, CONTRACT, as_of=AS_OF)
    assert [(d["files"], d["reordered"], d["missing"]) for d in res.header_drift] == [(1, True, [])]
    assert "D1" in _ids(spark, f"{out}/silver")


def test_single_file_report(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, single_report_file=True)
    parts = [p for p in os.listdir(f"{out}/report_file") if p.startswith("part-")]
    assert len(parts) == 1
    assert spark.read.option("header", "true").csv(f"{out}/report_file").count() == 12


def test_command_line(spark, scratch, capsys):
    import json as _json

    from rowgate.__main__ import main

    src = feed_files.write(os.path.join(scratch, "in"))
    out = os.path.join(scratch, "out")
    assert main([src, out, CONTRACT, "2026-03-02", "2026-03-03", "--as-of", "2026-04-01"]) == 0
    printed = _json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # without the first file, A3 has no twin: B1, B2, B5, A3 and C1, C2, C5 are valid
    assert printed["rows"] == 15 and printed["valid_rows"] == 7
    assert main([src, out, CONTRACT, "2030-01-01"]) == 1
