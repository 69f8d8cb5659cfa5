"""Outputs that change together, and dataset keys across runs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from rowgate.contract import ContractError
from rowgate.plans import job
from rowgate.plans.job import run
from rowgate.sinks.versions import CommitConflict, Outputs, Version
from tests import feed_files
from tests.conftest import CONTRACT
from tests.test_job import AS_OF

LINE = "{},2026-03-0{} 10:00:00,2026-03-0{},WIRE_HUB,EUR,{},NEW,ART,FR".format
NAMES = ["bronze", "verdict", "silver", "quarantine", "report", "summary_by_file", "summary_by_rule"]
#: Differs from run to run, or is the file's own.
VOLATILE = {"_ingested_at", "_source_path"}


def write(src, **days):
    """Files of March 2026: ``d3=[(id, amount), ...]``."""
    feed_files.write(src, {f"payments_2026-03-0{d[1:]}.csv": [LINE(i, d[1:], d[1:], a) for i, a in rows] for d, rows in days.items()})
    return src


def state(spark, out, names=NAMES):
    """All rows of all outputs, as text."""
    outs = Outputs(spark, out)
    there = outs.names()
    got = {}
    for name in [n for n in names if n in there]:
        df = outs.read(name)
        got[name] = sorted(str(tuple(r)) for r in df.select(*sorted(c for c in df.columns if c not in VOLATILE)).collect())
    return got


def day(d):
    return dict(start=f"2026-03-0{d}", end=f"2026-03-0{d}")


def test_a_run_that_dies_changes_nothing(spark, scratch, monkeypatch):
    src = write(os.path.join(scratch, "in"), d3=[("A1", "1.00"), ("A2", "x")], d4=[("B1", "2.00"), ("B2", "y")])
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=True)
    before = state(spark, out, [*NAMES, "key_state", "run_metrics"])
    write(src, d3=[("A1", "z"), ("A5", "5.00")], d4=[("B1", "2.00"), ("A5", "7.00")])
    real, publish = Version.write, Outputs._publish
    for dies_after in (1, 2, 5, 9):
        done = []

        def dying(self, name, *a, **kw):
            real(self, name, *a, **kw)
            done.append(name)
            if len(done) == dies_after:
                raise RuntimeError("killed")

        monkeypatch.setattr(Version, "write", dying)
        with pytest.raises(RuntimeError, match="killed"):
            run(spark, src, out, CONTRACT, as_of=AS_OF, **(day(3) if dies_after % 2 else {}))
        assert state(spark, out, [*NAMES, "key_state", "run_metrics"]) == before
    monkeypatch.setattr(Version, "write", real)

    # dying between the commit's file and the rename leaves the old state too ...
    def no_publish(self, manifest):
        raise RuntimeError("killed")
    monkeypatch.setattr(Outputs, "_publish", no_publish)
    with pytest.raises(RuntimeError, match="killed"):
        run(spark, src, out, CONTRACT, as_of=AS_OF, **day(3))
    assert state(spark, out, [*NAMES, "key_state", "run_metrics"]) == before
    monkeypatch.setattr(Outputs, "_publish", publish)

    # ... and dying after it, before anything old is deleted, the new one
    clean = Outputs.clean
    monkeypatch.setattr(Outputs, "clean", lambda self: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        run(spark, src, out, CONTRACT, as_of=AS_OF, **day(3))
    monkeypatch.setattr(Outputs, "clean", clean)
    after = state(spark, out)
    assert after != before and len(after["verdict"]) == 4
    Outputs(spark, out).clean()
    assert state(spark, out) == after
    # plain readers see the same once it is clean, and nothing of the dead runs is left
    for name in NAMES:
        fmt = "csv" if name == "report" else "parquet"
        assert spark.read.option("header", "true").format(fmt).load(f"{out}/{name}").count() == len(after[name])
    live = {v["version"] for o in Outputs(spark, out).manifest()["outputs"].values() for v in o["live"]}
    found = {f for n in [*NAMES, "key_state", "run_metrics"] for f in os.listdir(f"{out}/{n}") if f.startswith("_version=")}
    assert {f.removeprefix("_version=") for f in found} <= live and os.listdir(f"{out}/claims") == []


def test_of_two_runs_at_once_one_commits(spark, scratch):
    outs = Outputs(spark, os.path.join(scratch, "out"))
    one, two = outs.begin(), outs.begin()
    for v, x in ((one, 1), (two, 2)):
        v.write("t", spark.createDataFrame([(x, "k")], "x int, k string"), key="k")
    two.commit()
    with pytest.raises(CommitConflict):
        one.commit()
    assert [r.x for r in outs.read("t").collect()] == [2]
    outs.clean()
    assert len([f for f in os.listdir(f"{outs.root}/t") if f.startswith("_version=")]) == 1
    with pytest.raises(KeyError):
        outs.read("nothing")


def test_keys_with_odd_values_are_replaced(spark, scratch):
    outs = Outputs(spark, os.path.join(scratch, "out"))
    schema = "x int, k string"

    def put(rows, keys=None):
        v = outs.begin()
        v.write("t", spark.createDataFrame(rows, schema), key="k")
        v.commit("all" if keys is None else spark.createDataFrame([(k, ["t"]) for k in keys], "key string, outputs array<string>"))
        return sorted((r.x, r.k) for r in outs.read("t").collect() if r.k is not None), sum(r.k is None for r in outs.read("t").collect())

    put([(1, None), (2, "a/b=c"), (3, "ü %"), (4, "z")])
    for clean in (False, True):
        assert put([(5, "a/b=c")], ["a/b=c", None, "gone"]) == ([(3, "ü %"), (4, "z"), (5, "a/b=c")], 0)
        if clean:
            outs.clean()
        assert put([(6, None)], [None, "z"]) == ([(3, "ü %"), (5, "a/b=c")], 1)
        put([(4, "z")], ["z"])
    outs.clean()
    plain = spark.read.schema(schema).parquet(f"{outs.root}/t").select("x", "k")
    assert sorted(r.x for r in plain.collect()) == [3, 4, 5, 6]


def test_compaction_keeps_the_rows(spark, scratch):
    src = os.path.join(scratch, "in")
    days = {f"d{d}": [(f"A{d}{i}", "1.00" if i else "x") for i in range(3)] for d in range(1, 5)}
    write(src, **days)
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=True)
    for d in (2, 4):
        run(spark, src, out, CONTRACT, as_of=AS_OF, **day(d))
    before = state(spark, out)
    outs = Outputs(spark, out)
    assert any(len(o["live"]) > 1 for o in outs.manifest()["outputs"].values())
    files = lambda n: sum(f.startswith("part-") for _, _, fs in os.walk(f"{out}/{n}") for f in fs)
    many = {n: files(n) for n in NAMES}
    done = outs.compact()
    assert state(spark, out) == before
    assert all(len(outs.manifest()["outputs"][n]["live"]) == 1 for n in done)
    assert all(files(n) <= many[n] for n in NAMES)
    run(spark, src, out, CONTRACT, as_of=AS_OF, **day(3))
    assert state(spark, out) == before


def test_silver_in_few_files_or_in_folders(spark, scratch):
    src = feed_files.write(os.path.join(scratch, "in"))
    packed, folders = os.path.join(scratch, "o1"), os.path.join(scratch, "o2")
    run(spark, src, packed, CONTRACT, as_of=AS_OF)
    run(spark, src, folders, CONTRACT, as_of=AS_OF, silver_folders=True)
    parts = [d for d, _, fs in os.walk(f"{packed}/silver") for f in fs if f.startswith("part-")]
    assert len(parts) == len(set(parts)) and not any("business_date=" in d for d in parts)  # a file for each file date
    assert any("business_date=" in d for d, _, fs in os.walk(f"{folders}/silver") if fs)
    assert state(spark, packed)["silver"] == state(spark, folders)["silver"]


# keys across runs

def test_backfill_flags_and_unflags_rows_of_other_files(spark, scratch):
    src = write(os.path.join(scratch, "in"), d1=[("A", "1.00"), ("B", "1.00")], d2=[("C", "1.00"), ("D", "1.00")], d3=[("A", "1.00"), ("E", "1.00")])
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=True)
    ids = lambda name: sorted(r.record_id for r in Outputs(spark, out).read(name).collect())
    assert ids("quarantine") == ["A", "A"]
    write(src, d3=[("C", "1.00"), ("E", "1.00")])  # A's twin is gone, C has one
    res = run(spark, src, out, CONTRACT, as_of=AS_OF, **day(3))
    assert ids("quarantine") == ["C", "C"] and ids("silver") == ["A", "B", "D", "E"]
    assert res.counts["rows"] == 2 and res.corrected_rows == 4  # the files of A and C
    write(src, d3=[("C", "1.00"), ("E", "2.00")])  # no key changes: no other file is touched
    res = run(spark, src, out, CONTRACT, as_of=AS_OF, **day(3))
    assert res.corrected_rows == 0 and ids("quarantine") == ["C", "C"]
    with pytest.raises(ContractError):
        run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=False, **day(3))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_backfills_is_one_full_run(spark, scratch, seed):
    r = random.Random(seed)
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    draw = lambda: [(r.choice(["", " ", "A", "B", "B ", "C", "D", "E", "F", "G"]), r.choice(["1.00", "x"])) for _ in range(r.randint(1, 4))]
    write(src, **{f"d{d}": draw() for d in (1, 2, 3, 4)})
    run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=seed == 1)
    for step in range(2):
        d = r.choice((1, 2, 3, 4, 5))
        write(src, **{f"d{d}": draw()})
        run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=True, **day(d))  # with seed 2, the state is made here first
        whole = os.path.join(scratch, f"whole{step}")
        run(spark, src, whole, CONTRACT, as_of=AS_OF, keys_across_runs=True)
        assert state(spark, out, [*NAMES, "key_state"]) == state(spark, whole, [*NAMES, "key_state"])


def test_keys_across_runs_of_frames(spark, scratch):
    """Two keys, one that ignores nulls; files named in a column."""
    contract = {"schema": [{"name": "id"}, {"name": "a"}, {"name": "b"}], "file_column": "f",
                "unique_keys": [{"columns": ["id"], "null_keys": "ignore"}, {"columns": ["a", "b"]}, {"columns": ["id"], "scope": "file"}]}
    frame = lambda *rows: spark.createDataFrame(rows, "id string, a int, b double, f string")
    out = os.path.join(scratch, "out")
    f1 = [(None, 1, 1.0, "f1"), ("x", 2, 1.0, "f1"), ("y", 3, None, "f1")]
    f2 = [(None, 4, 1.0, "f2"), ("z", 5, 1.0, "f2"), ("z", 5, 2.0, "f2")]
    run(spark, frame(*f1, *f2), out, contract, as_of=AS_OF, silver_partition=None, keys_across_runs=True)
    f2 = [(None, 1, 1.0, "f2"), ("x", 3, None, "f2")]
    run(spark, frame(*f2), out, contract, as_of=AS_OF, silver_partition=None, overwrite="dynamic")
    whole = os.path.join(scratch, "whole")
    run(spark, frame(*f1, *f2), whole, contract, as_of=AS_OF, silver_partition=None, keys_across_runs=True)
    assert state(spark, out, [*NAMES, "key_state"]) == state(spark, whole, [*NAMES, "key_state"])
    bad = {r.id: r.rejection_reasons for r in Outputs(spark, out).read("quarantine").where("f = 'f1'").collect()}
    assert set(bad) == {None, "x", "y"} and "id: duplicate" in bad["x"] and "(a, b)" in bad["y"] and "id:" not in bad[None]
    with pytest.raises(ContractError):
        run(spark, frame(*f1).drop("f"), os.path.join(scratch, "o3"), contract, as_of=AS_OF, silver_partition=None, keys_across_runs=True)


def test_state_is_a_narrow_table(spark, scratch):
    src = write(os.path.join(scratch, "in"), d1=[("A", "1.00"), ("A", "1.00"), ("B", "1.00")])
    out = os.path.join(scratch, "out")
    run(spark, src, out, CONTRACT, as_of=AS_OF, keys_across_runs=True)
    rows = Outputs(spark, out).read("key_state")
    assert set(rows.columns) == {"rule", "digest", "n", job.FILE_DATE}
    assert sorted(r.n for r in rows.collect()) == [1, 2] and rows.select(F.max(F.octet_length("digest"))).first()[0] == 32
