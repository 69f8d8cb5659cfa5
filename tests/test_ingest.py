"""Delimited ingest: separator repair, lineage, date ranges, header drift."""

import datetime as dt
import os

from pyspark.sql import functions as F

from rowgate import Contract, evaluate
from rowgate.sources.delimited import header_drift, read_delimited, schema_drift
from tests import feed_files
from tests.conftest import CONTRACT

AS_OF = dt.date(2026, 4, 1)


def _bronze(spark, scratch, **kw):
    folder = feed_files.write(os.path.join(scratch, "in"))
    return read_delimited(spark, folder, Contract.load(CONTRACT), **kw)


def test_every_line_parsed_once(spark, scratch):
    b = _bronze(spark, scratch).collect()
    ids = sorted(r.record_id for r in b)
    assert len(b) == 18  # header and empty lines dropped
    assert ids.count("A3") == 2 and "record_id" not in ids
    by = {r.record_id: r for r in b}
    assert by["B1"]._delimiter_issue and by["B2"]._delimiter_issue and not by["A1"]._delimiter_issue
    assert by["B1"].country_code == "NO" and by["B2"].amount == "18.80"
    assert by["B3"]._malformed and by["B4"]._malformed and by["B5"]._malformed
    assert by["B4"].status is None and by["B5"].country_code == "CH"
    assert by["B7 "].business_date == "2026-14-02" and by["B6"].currency is None
    assert by["C5"].merchant_category == "HOME;GARDEN" and not by["C5"]._delimiter_issue
    assert by["B3"].merchant_category.startswith("GARDEN,MX") and by["B3"].country_code is None


def test_lineage(spark, scratch):
    b = _bronze(spark, scratch)
    files = {r._source_file for r in b.select("_source_file").distinct().collect()}
    assert files == set(feed_files.FILES)
    assert b.select("_ingested_at").distinct().count() == 1


def test_golden_verdict(spark, scratch):
    v = evaluate(_bronze(spark, scratch), CONTRACT, as_of=AS_OF).cache()
    got = {r.record_id: len(r.violations) for r in v.collect()}
    assert got == {k: n for k, n in feed_files.EXPECTED_VIOLATIONS.items()}
    assert v.where("is_valid").count() == 8
    assert v.agg(F.sum(F.size("violations"))).first()[0] == 12
    per_file = {r._source_file: r.n for r in v.where("is_valid").groupBy("_source_file")
                .agg(F.count("*").alias("n")).collect()}
    assert per_file == {"payments_2026-03-01.csv": 2, "payments_2026-03-02.csv": 3,
                        "payments_2026-03-03.csv": 3}
    b4 = v.where("record_id = 'B4'").first()
    assert [(x.kind, x.column) for x in b4.violations] == [("required", "status"), ("required", "country_code")]


def test_date_range_both_and_open_ends(spark, scratch):
    def files(**kw):
        b = _bronze(spark, scratch, **kw)
        return sorted(r[0] for r in b.select("_source_file").distinct().collect())

    assert files(start="2026-03-02", end="2026-03-02") == ["payments_2026-03-02.csv"]
    assert files(start="2026-03-02") == ["payments_2026-03-02.csv", "payments_2026-03-03.csv"]
    assert files(end="2026-03-01") == ["payments_2026-03-01.csv"]
    assert files(start="2027-01-01") == []


def test_date_in_folder_name(spark, scratch):
    root = os.path.join(scratch, "tree")
    feed_files.write(os.path.join(root, "load_2026-05-01"), {"part-0.csv": feed_files.FILES["payments_2026-03-01.csv"]})
    feed_files.write(os.path.join(root, "load_2026-05-02"), {"part-0.csv": feed_files.FILES["payments_2026-03-03.csv"]})
    b = read_delimited(spark, [os.path.join(root, "load_2026-05-01"), os.path.join(root, "load_2026-05-02")],
                       CONTRACT, start="2026-05-02")
    assert sorted(r.record_id for r in b.collect()) == ["C1", "C2", "C3", "C4", "C5"]


def test_date_range_prunes_files_at_listing(spark, scratch):
    from rowgate.sources.delimited import read_lines

    folder = feed_files.write(os.path.join(scratch, "in"))
    for kw, files in (({}, 3), ({"start": "2026-03-02", "end": "2026-03-02"}, 1)):
        lines = read_lines(spark, folder, **kw)
        lines.collect()
        scan = lines._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert scan.metrics().get("numFiles").get().value() == files


def test_header_drift(spark, scratch):
    folder = os.path.join(scratch, "drift")
    feed_files.write(folder)
    bad = feed_files.HEADER.replace("currency,amount", "amount,currency").replace("merchant_category", "mcc")
    feed_files.write(folder, {"payments_2026-03-09.csv": feed_files.FILES["payments_2026-03-01.csv"]}, header=bad)
    rows = {r._source_file: r for r in header_drift(spark, folder, CONTRACT).collect()}
    assert len(rows) == 4
    clean = rows["payments_2026-03-01.csv"]
    assert clean.header_lines == 1 and clean.missing == "" and clean.unexpected == "" and not clean.reordered
    drift = rows["payments_2026-03-09.csv"]
    assert drift.missing == "merchant_category" and drift.unexpected == "mcc" and drift.reordered
    assert drift.file_date == dt.date(2026, 3, 9)


def test_schema_drift(spark):
    df = spark.createDataFrame([("1", "x", "y")], "record_id string, extra string, _meta string")
    got = {tuple(r) for r in schema_drift(df, CONTRACT).collect()}
    assert ("extra", "unexpected") in got and ("amount", "missing") in got
    assert not any(c == "_meta" for c, _ in got)


def test_header_order_labels_fields(spark, scratch):
    order = ["event_ts", "record_id", "business_date", "source_system", "currency", "amount", "status",
             "country_code", "merchant_category", "notes"]
    lines = ["2026-03-05T08:00:00Z,D1,2026-03-05,CARD_PROC,USD,3.00,POSTED,US,FOOD,hello",
             "2026-03-05T08:01:00Z|D2|2026-03-05|CARD_PROC|USD|4.00|POSTED|FR|FOOD|x"]
    folder = feed_files.write(os.path.join(scratch, "hdr"), {"payments_2026-03-05.csv": lines},
                              header=",".join(order))
    b = read_delimited(spark, folder, CONTRACT)
    rows = {r.record_id: r for r in b.collect()}
    assert set(rows) == {"D1", "D2"}
    assert rows["D2"].country_code == "FR" and rows["D1"].merchant_category == "FOOD"
    assert rows["D1"].notes == "hello" and b.columns[:9] == Contract.load(CONTRACT).column_names
    v = evaluate(b, CONTRACT, as_of=AS_OF, on_missing="null_fill")
    assert v.where("is_valid").count() == 2
    positional = read_delimited(spark, folder, CONTRACT, header="contract").collect()
    assert {r.record_id for r in positional} == {"2026-03-05T08:00:00Z", "2026-03-05T08:01:00Z"}


def test_within_file_uses_full_path(spark, scratch):
    root = os.path.join(scratch, "tree")
    rows = ["Z1,2026-03-01T08:00:00Z,2026-03-01,CARD_PROC,USD,1.00,POSTED,FOOD,US"]
    feed_files.write(os.path.join(root, "load_2026-05-01"), {"part-0.csv": rows})
    feed_files.write(os.path.join(root, "load_2026-05-02"), {"part-0.csv": rows})
    doc = Contract.load(CONTRACT).raw
    schema = [dict(c, unique=False, unique_within_file=(c["name"] == "record_id")) for c in doc["schema"]]
    within = Contract.from_dict({**doc, "schema": schema})
    b = read_delimited(spark, [os.path.join(root, "load_2026-05-01"), os.path.join(root, "load_2026-05-02")], within)
    v = evaluate(b, within, as_of=AS_OF).collect()
    assert len(v) == 2 and all(r.is_valid for r in v)  # same base name, different files


def _files(root, **files):
    os.makedirs(root)
    for name, lines in files.items():
        with open(os.path.join(root, name + ".csv"), "w") as fh:
            fh.write("\n".join(lines))
    return root


TWO = {"schema": [{"name": "name"}, {"name": "status"}]}


def test_rows_that_look_like_headers_stay(spark, scratch):
    root = _files(os.path.join(scratch, "x"), a=["alpha,ok", "status,ok", "beta,name", "name,status"], b=["name,status", "c,d", "status,name"])
    got = {tuple(r) for r in read_delimited(spark, root, TWO).select("name", "status").collect()}
    assert got == {("alpha", "ok"), ("status", "ok"), ("beta", "name"), ("name", "status"), ("c", "d"), ("status", "name")}
    everything = read_delimited(spark, root, TWO, header=None)
    assert everything.count() == 7


def test_every_file_by_its_own_header(spark, scratch):
    root = _files(os.path.join(scratch, "sp ace"), a=["name,status", "a,1"], b=["STATUS;Name;more", "2;b;x"], c=["c,3"], d=[" ", "name,status", "d,4"])
    got = {r.name: (r.status, r.more) for r in read_delimited(spark, root, TWO).collect()}
    assert got == {"a": ("1", None), "b": ("2", "x"), "c": ("3", None), "d": ("4", None)}


def test_both_separators_in_one_line(spark, scratch):
    contract = {"schema": [{"name": c} for c in "abcd"]}
    root = _files(os.path.join(scratch, "x"), a=["1|2;3|4", '5;"6|7";8|9', "p,q;r,s,t"])
    got = sorted((r.a, r.b, r.c, r.d, r._malformed) for r in read_delimited(spark, root, contract).collect())
    assert got == [("1", "2", "3", "4", False), ("5", "6|7", "8", "9", False), ("p", "q;r", "s", "t", False)]


def test_quoted_records_as_the_multiline_reader_reads_them(spark, scratch):
    """Many blocks of one file, records across their edges; a stray quote keeps a file to its lines."""
    from rowgate.sources.delimited import join_records, read_delimited, read_lines

    rows = []
    for i in range(400):
        text = f"text {i}" if i % 3 else f"first {i}\n\nsecond, \\\"{i}\\\"\n" + "x" * (i % 40) + "\nlast"
        rows.append(f'{i},"{text}",end{i}' if i % 3 != 1 else f"{i},{text},end{i}")
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("id,text,tail\n" + "\n".join(rows) + "\n")
    contract = {"schema": [{"name": n} for n in ("id", "text", "tail")]}
    want = sorted(map(tuple, spark.read.option("header", "true").option("multiLine", "true").csv(src).collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("134217728", "700", "61"):  # blocks that hold all, some and no whole record
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = read_delimited(spark, src, contract, records="quoted", header="contract")
            assert read_lines(spark, src).rdd.getNumPartitions() > (1 if size != "134217728" else 0)
            assert sorted((r.id, r.text, r.tail) for r in got.collect()) == want and len(want) == 400
            assert got.where("_malformed").count() == 0
        records = join_records(read_lines(spark, src, blank=True), max_lines=3)
        assert records.count() == read_lines(spark, src).count()  # line by line
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
