"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads whole driver tables (or data Spark derives from them) and
runs the library's public API over it; :mod:`rowgate.plans.oracle` holds the
matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract
from ..operators import route
from ..operators.evaluate import evaluate
from ..session import fresh_dir
from ..sinks.versions import Outputs
from ..sources.delimited import header_drift as _header_drift
from ..sources.delimited import path_date, read_delimited
from . import fixtures as fx
from .job import FILE_DATE, run

REPORT_COLS = ["kind", "column", "rule", "violation"]


def _feed_report(spark, sf_dir, contract: Contract, kind: str | None = None, **kw) -> DataFrame:
    v = evaluate(fx.dirty_orders(spark, sf_dir), contract, as_of=fx.AS_OF, **kw)
    r = route.report(v, keep=["order_key"]).select("order_key", *REPORT_COLS)
    return r.where(F.col("kind") == kind) if kind else r


def _typed_feed(**columns) -> Contract:
    return fx.feed_subset(columns={k: set(v) for k, v in columns.items()})


def rule_required(spark, sf_dir):
    req = ("required",)
    return _feed_report(spark, sf_dir, _typed_feed(
        record_id=req, event_ts=req, business_date=req, source_system=req, status=req, amount=req,
        country_code=req))


def rule_allowed_values(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(source_system=("allowed_values",),
                                                   status=("allowed_values",)))


def rule_type_timestamp(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(event_ts=("type",)))


def rule_type_date(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(business_date=("type",)))


def rule_type_decimal(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(amount=("type",)))


def rule_regex(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(country_code=("regex",)))


def rule_min(spark, sf_dir):
    return _feed_report(spark, sf_dir, _typed_feed(amount=("type", "min_value")), kind="range")


def _business(name: str):
    def query(spark, sf_dir):
        contract = fx.feed_subset(
            columns={"event_ts": {"type"}, "business_date": {"type"}, "amount": {"type"}},
            rules=[name])
        return _feed_report(spark, sf_dir, contract, kind="business_rule")
    query.__name__ = f"rule_{name}"
    return query


rule_positive_when_status = _business("final_amount_positive")
rule_ts_near_date = _business("event_ts_near_business_date")
rule_not_future = _business("business_date_not_far_future")


def _table_report(spark, sf_dir, table: str, contract: dict, keep: list[str], **kw) -> DataFrame:
    v = evaluate(fx.table(spark, sf_dir, table), Contract.from_dict(contract), as_of=fx.AS_OF, **kw)
    return route.report(v, keep=keep).select(*keep, *REPORT_COLS)


def rule_assert(spark, sf_dir):
    contract = {"schema": [], "business_rules": [
        {"name": "quantity_below_fifty", "assert": "l_quantity < 50"},
        {"name": "discounted_price_positive", "assert": "l_extendedprice * (1 - l_discount) > 1000"},
    ]}
    return _table_report(spark, sf_dir, "lineitem", contract,
                         ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


#: Rules that fail on some rows: a division by zero, an index, a cast, an overflow.
FAILING_RULES = {"schema": [], "on_bad_rule": "skip", "business_rules": [
    {"name": "price_per_line", "assert": "l_extendedprice / (l_linenumber - 1) > 5000"},
    {"name": "line_price_again", "assert": "l_extendedprice / (l_linenumber - 1) > 9000", "condition": "l_returnflag <> 'N'"},
    {"name": "step_of_line", "assert": "element_at(array(1, 5, 9), l_linenumber) < 9"},
    {"name": "flag_is_a_number", "assert": "cast(if(l_linestatus = 'O', l_returnflag, '7') as int) = 7"},
    {"name": "key_fits", "assert": "cast(l_orderkey as int) * 2000000 > 0"},
    {"name": "no_such", "assert": "no_such_column > 0"},
]}


def rule_runtime_errors(spark, sf_dir):
    """Rules that fail on rows flag these rows, and judge all others."""
    return _table_report(spark, sf_dir, "lineitem", FAILING_RULES, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def rule_error_counts(spark, sf_dir):
    """The catalogue of such rules with their violations and errors."""
    from ..operators.evaluate import rule_catalog as catalog_of, rule_hits

    lines = fx.table(spark, sf_dir, "lineitem")
    v = evaluate(lines, FAILING_RULES, as_of=fx.AS_OF)
    return rule_hits(catalog_of(lines, FAILING_RULES), v, errors=True).select("rule", "status", "violations", "errors")


def rule_conditional_assert(spark, sf_dir):
    contract = {"schema": [], "business_rules": [
        {"name": "purchase_value_at_least_one", "condition": "event_type = 'purchase'",
         "assert": "value >= 1"},
        {"name": "error_has_props", "condition": "event_type = 'error'",
         "assert": "props IS NOT NULL AND props LIKE '{%}'"},
    ]}
    return _table_report(spark, sf_dir, "events", contract, ["event_id"])


def rule_regex_urls(spark, sf_dir):
    contract = {"schema": [{"name": "url", "regex": r"^https://[a-z]+\.example\.(com|org)/"}]}
    return _table_report(spark, sf_dir, "pages", contract, ["page_id"])


def rule_customer(spark, sf_dir):
    contract = {"schema": [
        {"name": "c_name", "regex": "^Customer#0{5}[0-9]{4}$"},
        {"name": "c_acctbal", "min_value": 0},
    ]}
    return _table_report(spark, sf_dir, "customer", contract, ["c_custkey"])


def rule_max(spark, sf_dir):
    contract = {"schema": [
        {"name": "p_brand", "allowed_values": ["Brand#11", "Brand#12", "Brand#13"]},
        {"name": "p_size", "max_value": 45},
    ]}
    return _table_report(spark, sf_dir, "part", contract, ["p_partkey"])


def rules_labels(spark, sf_dir):
    contract = {
        "schema": [{"name": "doc_id", "unique": True}, {"name": "quality", "allowed_values": [0, 1]}],
        "business_rules": [{"name": "toxic_is_low_quality", "condition": "toxic = 1", "assert": "quality = 0",
                            "message": "doc {doc_id} is toxic but quality 1"}],
    }
    return _table_report(spark, sf_dir, "labels", contract, ["doc_id"])


def rules_conversations(spark, sf_dir):
    contract = {
        "schema": [{"name": "role", "allowed_values": ["user", "assistant"]},
                   {"name": "text", "required": True}],
        "unique_keys": [{"columns": ["conv_id", "turn"]}],
    }
    return _table_report(spark, sf_dir, "conversations", contract, ["conv_id", "turn"])


# ----------------------------------------------------------------- uniqueness
def _unique_feed(**kw):
    contract = fx.feed_subset(columns={}, unique=True)
    return lambda spark, sf_dir: _feed_report(spark, sf_dir, contract, **kw)


unique_dataset = _unique_feed()
unique_dataset_window = _unique_feed(unique_strategy="window")
# Hot-key path on real data: null and blank ids (about 1% of rows each) pass
# the hot threshold, so they take the broadcast + salted branch.
unique_dataset_skew = _unique_feed(hot_key_rows=20)


def unique_within_file(spark, sf_dir):
    contract = fx.feed_subset(columns={}, within_file=True)
    return _feed_report(spark, sf_dir, contract)


def unique_composite(spark, sf_dir):
    contract = {"schema": [], "unique_keys": [{"columns": ["l_orderkey", "l_linenumber"]}]}
    return _table_report(spark, sf_dir, "lineitem", contract,
                         ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def unique_hot_keys(spark, sf_dir):
    """Every key holds about a quarter to a third of ``lineitem``: all rows are
    duplicates and all keys take the hot path (broadcast flag, salted rows)."""
    contract = {"schema": [], "unique_keys": [{"columns": ["l_returnflag", "l_linestatus"]}]}
    return _table_report(spark, sf_dir, "lineitem", contract,
                         ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], hot_key_rows=1000)


def unique_text_hashed(spark, sf_dir):
    contract = {"schema": [], "unique_keys": [{"columns": ["text"], "hashed": True}]}
    return _table_report(spark, sf_dir, "documents", contract, ["doc_id"])


def unique_multi_key(spark, sf_dir):
    """Four keys of ``lineitem``, all counted on the table itself."""
    keys = [["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], ["l_extendedprice"], ["l_returnflag", "l_linestatus"]]
    contract = {"schema": [], "unique_keys": [{"columns": k} for k in keys]}
    return _table_report(spark, sf_dir, "lineitem", contract, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                         hot_key_rows=5000)


def null_keys_ignore(spark, sf_dir):
    """Null ids are no duplicates of each other; blank ones are."""
    contract = Contract.from_dict({"schema": [], "unique_keys": [{"columns": ["record_id"], "null_keys": "ignore"}]})
    return _feed_report(spark, sf_dir, contract)


def rule_allowed_typed(spark, sf_dir):
    """Allowed numbers against numbers, whatever their text looks like."""
    contract = {"schema": [{"name": "l_discount", "allowed_values": [0, 0.01, 0.02, 0.03, 0.04, "0.050", 0.06]},
                           {"name": "l_linenumber", "allowed_values": [1, "2", 3]}]}
    return _table_report(spark, sf_dir, "lineitem", contract, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).drop("violation")


def strict_scale(spark, sf_dir):
    """Prices with more decimals than the declared scale, instead of rounding."""
    contract = Contract.from_dict({"schema": [{"name": "amount", "type": "decimal(18,1)", "strict_scale": True}]})
    r = _feed_report(spark, sf_dir, contract)
    return r.where(F.col("rule") == "strict_scale")


def drift(spark, sf_dir):
    """Columns of ``orders`` against the feed's contract."""
    from ..sources.delimited import schema_drift

    return schema_drift(fx.table(spark, sf_dir, "orders"), fx.feed_contract())


# -------------------------------------------------------------- verdict & co
def _feed_verdict(spark, sf_dir) -> DataFrame:
    return evaluate(fx.dirty_orders(spark, sf_dir), fx.feed_contract(), as_of=fx.AS_OF)


def verdict(spark, sf_dir):
    v = _feed_verdict(spark, sf_dir)
    return v.select("order_key", "record_id", "is_valid", "rejection_reasons",
                    F.size("violations").alias("n_violations"))


def report(spark, sf_dir):
    v = _feed_verdict(spark, sf_dir)
    return route.report(v, keep=["order_key", "source_file", "business_date"])


def summary_by_rule(spark, sf_dir):
    return route.summary_by_rule(_feed_verdict(spark, sf_dir))


def summary_by_file(spark, sf_dir):
    return route.summary_by(_feed_verdict(spark, sf_dir), "source_file")


def content_drift(spark, sf_dir):
    """The feed's files of after 1996 with three columns under other names, one of them
    with other values, against those before."""
    from ..operators.drift import content_drift as by_content

    feed = fx.dirty_orders(spark, sf_dir)
    now = feed.select(*[c for c in feed.columns if c not in ("amount", "source_system", "country_code")], F.col("amount").alias("total"),
                      F.lower("source_system").alias("origin"), F.col("country_code").alias("region"), (F.col("order_key") % 7).alias("batch"))
    return by_content(now, feed, fx.feed_contract())


def summary_levels(spark, sf_dir):
    """Totals, files, dates and rules, all levels from one pass."""
    return route.summary_levels(_feed_verdict(spark, sf_dir), "source_file", "business_date")


def stage_counts(spark, sf_dir):
    return route.stage_counts(_feed_verdict(spark, sf_dir))


# ------------------------------------------------- sinks, written and re-read
def silver(spark, sf_dir):
    feed = fx.dirty_orders(spark, sf_dir)
    out = fresh_dir(spark, "silver")
    run(spark, feed, out, fx.feed_contract(), as_of=fx.AS_OF)
    return Outputs(spark, out).read("silver").select(*fx.FEED_COLUMNS)


def silver_typed(spark, sf_dir):
    feed = fx.dirty_orders(spark, sf_dir)
    schema = [dict(c) for c in fx.FEED_CONTRACT["schema"]]
    for c in schema:
        if c["name"] == "event_ts":
            c["type"] = "timestamp_ntz"
    contract = fx.feed_contract(schema=schema)
    out = fresh_dir(spark, "silver-typed")
    run(spark, feed, out, contract, as_of=fx.AS_OF, typed_silver=True)
    return spark.read.parquet(f"{out}/silver").select(*fx.FEED_COLUMNS)


def quarantine(spark, sf_dir):
    feed = fx.dirty_orders(spark, sf_dir)
    out = fresh_dir(spark, "quarantine")
    run(spark, feed, out, fx.feed_contract(), as_of=fx.AS_OF)
    q = spark.read.parquet(f"{out}/quarantine")
    return q.select(*[F.col(c).cast(feed.schema[c].dataType) for c in fx.FEED_COLUMNS], "rejection_reasons")


# ------------------------------------------------------------ ingest queries
def _feed_files(spark, sf_dir, label: str, drift: bool = False) -> str:
    return fx.write_feed_files(spark, sf_dir, fresh_dir(spark, label), drift=drift)


def delimiter_repair(spark, sf_dir):
    root = _feed_files(spark, sf_dir, "feed-text")
    bronze = read_delimited(spark, root, fx.feed_contract())
    return bronze.select(*fx.FEED_COLUMNS, "_delimiter_issue", "_malformed")


def lineage(spark, sf_dir):
    root = _feed_files(spark, sf_dir, "feed-text")
    bronze = read_delimited(spark, root, fx.feed_contract())
    return bronze.select("order_key", path_date(F.col("_source_path")).alias("file_date"),
                         F.col("_source_file").startswith("part-").alias("named_by_writer"))


def date_range(spark, sf_dir):
    root = _feed_files(spark, sf_dir, "feed-text")
    bronze = read_delimited(spark, root, fx.feed_contract(), start="1996-01-01", end="1997-12-31")
    return bronze.select("order_key", "record_id", path_date(F.col("_source_path")).alias("file_date"))


def _backfill(mode: str):
    def query(spark, sf_dir):
        root = _feed_files(spark, sf_dir, "feed-text")
        out = fresh_dir(spark, f"backfill-{mode}")
        contract = fx.feed_contract()
        run(spark, root, out, contract, as_of=fx.AS_OF)
        run(spark, root, out, contract, as_of=fx.AS_OF, start="1996-01-01", end="1996-12-31",
            overwrite=mode)
        return _text_silver(spark, out)
    query.__name__ = f"backfill_{mode}"
    return query


backfill_dynamic = _backfill("dynamic")
backfill_static = _backfill("static")


def _text_silver(spark, out: str) -> DataFrame:
    """Silver of a text run, all columns as text (the file date is its first
    partition, so a schema of one's own has to name it)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*fx.FEED_COLUMNS, FILE_DATE)])
    return spark.read.schema(schema).parquet(f"{out}/silver").select(*fx.FEED_COLUMNS)


def backfill_late_rows(spark, sf_dir):
    """Files that hold rows of another file's dates, one year of them read again:
    the rows of the other files stay."""
    root = fx.write_feed_files(spark, sf_dir, fresh_dir(spark, "feed-late"), late=True)
    out = fresh_dir(spark, "backfill-late")
    run(spark, root, out, fx.feed_contract(), as_of=fx.AS_OF)
    run(spark, root, out, fx.feed_contract(), as_of=fx.AS_OF, start="1996-01-01", end="1996-12-31")
    return _text_silver(spark, out)


def report_csv(spark, sf_dir):
    """The written report of a run and a backfill over it, read back as CSV."""
    root = _feed_files(spark, sf_dir, "feed-text")
    out = fresh_dir(spark, "report-csv")
    run(spark, root, out, fx.feed_contract(), as_of=fx.AS_OF)
    run(spark, root, out, fx.feed_contract(), as_of=fx.AS_OF, start="1996-01-01", end="1996-12-31")
    rows = spark.read.option("header", "true").csv(f"{out}/report")
    return rows.select(*[F.col(c).cast("string") for c in ("order_key", "violation_index", *REPORT_COLS, "file_date")])


def backfill_keys(spark, sf_dir):
    """Keys across runs: files of 1996 whose ids are those of other years' rows, then the
    true ones read again.  Rows of files that are not read lose their twins, or get one;
    the verdict is that of one run over all files."""
    root = _feed_files(spark, sf_dir, "feed-text")
    other = fx.write_feed_files(spark, sf_dir, fresh_dir(spark, "feed-other-ids"), other_ids=True)
    out = fresh_dir(spark, "backfill-keys")
    contract = fx.feed_contract()
    run(spark, other, out, contract, as_of=fx.AS_OF, keys_across_runs=True)
    run(spark, root, out, contract, as_of=fx.AS_OF, start="1996-01-01", end="1996-12-31")
    v = Outputs(spark, out).read("verdict")
    return v.select("order_key", "record_id", "is_valid", "rejection_reasons", F.size("violations").alias("n_violations"))


def run_metrics(spark, sf_dir):
    """The history row of a run over the feed."""
    out = fresh_dir(spark, "metrics")
    run(spark, fx.dirty_orders(spark, sf_dir), out, fx.feed_contract(), as_of=fx.AS_OF)
    return spark.read.parquet(f"{out}/run_metrics").select("rows", "valid_rows", "invalid_rows", "violations", "params")


def ingest_time(spark, sf_dir):
    """One ingest time for all lines of a run."""
    bronze = read_delimited(spark, _feed_files(spark, sf_dir, "feed-text"), fx.feed_contract())
    return bronze.agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("_ingested_at").alias("times"))


def ingest_header_order(spark, sf_dir):
    """Every file by its own header: one year's names two columns the other way
    round and has one of its own."""
    bronze = read_delimited(spark, _feed_files(spark, sf_dir, "feed-drift", drift=True), fx.feed_contract())
    return bronze.select(*fx.FEED_COLUMNS, "amt")


def ingest_mixed_separators(spark, sf_dir):
    """Lines in which ``|`` and ``;`` both separate, without a header."""
    part = fx.table(spark, sf_dir, "part")
    lines = part.select(F.concat_ws("", F.col("p_partkey").cast("string"), F.lit("|"), "p_name", F.lit(";"),
                                    F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('"'), "p_brand", F.lit('|x"'))).otherwise(F.col("p_brand")),
                                    F.lit("|"), F.col("p_size").cast("string")).alias("value"))
    root = fx.write_plain_lines(lines, fresh_dir(spark, "mixed"), None)
    columns = ["p_partkey", "p_name", "p_brand", "p_size"]
    return read_delimited(spark, root, {"schema": [{"name": c} for c in columns]}).select(*columns, "_malformed")


def ingest_quoted_records(spark, sf_dir):
    """Fields in quotes that go over several lines, a blank one among them."""
    p = fx.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = (F.when(k % 3 == 0, F.concat(F.lit('"'), "p_name", F.lit('\n\nsecond, line\n'), "p_brand", F.lit('"')))
            .when(k % 5 == 0, F.concat(F.lit('"said \\"'), "p_name", F.lit('\\";\nend"'))).otherwise(F.col("p_name")))
    root = fx.write_plain_lines(p.select(F.concat_ws(",", k.cast("string"), name, F.col("p_size").cast("string")).alias("value")),
                                fresh_dir(spark, "quoted"), None)
    columns = ["p_partkey", "p_name", "p_size"]
    return read_delimited(spark, root, {"schema": [{"name": n} for n in columns]}, records="quoted").select(*columns, "_malformed")


def ingest_separator_by_evidence(spark, sf_dir):
    """Files with ``;`` and decimal commas in the first field, and comma files whose first
    field holds a ``;`` in some lines: each file's lines decide together."""
    c = fx.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    euro = c.where(k % 2 == 0).select(F.concat_ws(";", F.translate(F.col("c_acctbal").cast("decimal(18,2)").cast("string"), ".", ","), k.cast("string"),
                                                  "c_mktsegment").alias("value"))
    plain = c.where(k % 2 == 1).select(F.concat_ws(",", F.when(k % 5 == 0, F.concat(k.cast("string"), F.lit(";x|y"))).otherwise(F.lit("0.5")),
                                                   k.cast("string"), F.when(k % 3 == 0, F.concat(F.lit('"a,b;'), "c_mktsegment", F.lit('"'))).otherwise(F.col("c_mktsegment"))).alias("value"))
    roots = [fx.write_plain_lines(lines, fresh_dir(spark, "evidence"), header) for lines, header in ((euro, "balance;id;segment"), (plain, "balance,id,segment"))]
    columns = ["balance", "id", "segment"]
    return read_delimited(spark, roots, {"schema": [{"name": n} for n in columns]}, separator="evidence").select(*columns, "_delimiter_issue", "_malformed")


def ingest_header_like_rows(spark, sf_dir):
    """Data that names columns is data: half of a line, or all of it the other way round."""
    k = F.col("c_custkey")
    lines = fx.table(spark, sf_dir, "customer").select(F.concat_ws(
        ",", k.cast("string"), F.when(k % 5 == 0, "segment").when(k % 7 == 0, "name").otherwise(F.col("c_name")),
        F.when(k % 5 == 0, "name").when(k % 3 == 0, "segment").otherwise(F.col("c_mktsegment"))).alias("value"))
    root = fx.write_plain_lines(lines, fresh_dir(spark, "header-like"), "id,name,segment")
    return read_delimited(spark, root, {"schema": [{"name": "ID"}, {"name": "name"}, {"name": "segment"}]}).select("ID", "name", "segment")


def reject_malformed(spark, sf_dir):
    """Lines with a wrong number of fields as violations."""
    bronze = read_delimited(spark, _feed_files(spark, sf_dir, "feed-text"), fx.feed_contract())
    v = evaluate(bronze, fx.feed_contract(), as_of=fx.AS_OF, reject_malformed=True, include_unique=False)
    return route.report(v, keep=["order_key"]).where(F.col("kind") == "malformed").select("order_key", *REPORT_COLS)


def header_drift(spark, sf_dir):
    root = _feed_files(spark, sf_dir, "feed-drift", drift=True)
    per_file = _header_drift(spark, root, fx.feed_contract())
    # One row per dated folder, however many files its writers produced.
    return per_file.groupBy("file_date").agg(
        F.min("header_lines").alias("min_header_lines"), F.max("header_lines").alias("max_header_lines"),
        F.max("missing").alias("missing"), F.max("unexpected").alias("unexpected"),
        F.max("reordered").alias("reordered"))


def rule_catalog(spark, sf_dir):
    """Every rule of the feed contract (one deliberately broken, skipped) with
    its status and its violation count over the whole feed."""
    from ..operators.evaluate import rule_catalog as catalog_of, rule_hits

    doc = dict(fx.FEED_CONTRACT)
    doc["on_bad_rule"] = "skip"
    doc["business_rules"] = list(doc["business_rules"]) + [
        {"name": "uses_unknown_column", "assert": "no_such_column > 0"}]
    contract = Contract.from_dict(doc)
    feed = fx.dirty_orders(spark, sf_dir)
    v = evaluate(feed, contract, as_of=fx.AS_OF)
    return rule_hits(catalog_of(feed, contract), v).drop("note")


# ------------------------------------------------------------------ streaming
def stream_verdict(spark, sf_dir):
    """Row rules on ``orders`` read as a stream, routed per micro-batch, re-read."""
    from ..streaming.stream import route_stream

    feed = fx.dirty_orders_from(fx.orders_stream(spark, sf_dir))
    out = fresh_dir(spark, "stream")
    query = route_stream(feed, fx.feed_contract(), out, f"{out}/_checkpoint", as_of=fx.AS_OF, ignore_unique=True,
                         trigger={"availableNow": True})
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    good = spark.read.parquet(f"{out}/silver").select("order_key", F.lit("").alias("rejection_reasons"))
    bad = spark.read.parquet(f"{out}/quarantine").select("order_key", "rejection_reasons")
    return good.unionByName(bad)


def stream_keys(spark, sf_dir):
    """``orders`` as a stream in several micro-batches, ids judged over all of them."""
    from ..streaming.stream import route_stream_with_keys

    # The orders come in thirds, each in files of bounded size, so that a micro-batch of any size is
    # read by many tasks.  A run of the query takes all new files as one micro-batch.
    orders = fx.table(spark, sf_dir, "orders")
    parts, out = fresh_dir(spark, "stream-parts"), fresh_dir(spark, "stream-keys")
    for third in range(3):
        fx.write_orders_part(orders, third, 3, parts)
        stream = spark.readStream.schema(orders.schema).parquet(parts)
        query = route_stream_with_keys(fx.dirty_orders_from(stream), fx.feed_contract(), out, f"{out}-checkpoint", as_of=fx.AS_OF,
                                       trigger={"availableNow": True})
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    outs = Outputs(spark, out)
    good = outs.read("silver").select("order_key", F.lit("").alias("rejection_reasons"))
    return good.unionByName(outs.read("quarantine").select("order_key", "rejection_reasons"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_required": rule_required,
    "rule_allowed_values": rule_allowed_values,
    "rule_type_timestamp": rule_type_timestamp,
    "rule_type_date": rule_type_date,
    "rule_type_decimal": rule_type_decimal,
    "rule_regex": rule_regex,
    "rule_min": rule_min,
    "rule_positive_when_status": rule_positive_when_status,
    "rule_ts_near_date": rule_ts_near_date,
    "rule_not_future": rule_not_future,
    "rule_assert": rule_assert,
    "rule_conditional_assert": rule_conditional_assert,
    "rule_regex_urls": rule_regex_urls,
    "rule_customer": rule_customer,
    "rule_max": rule_max,
    "rules_labels": rules_labels,
    "rules_conversations": rules_conversations,
    "unique_dataset": unique_dataset,
    "unique_dataset_window": unique_dataset_window,
    "unique_dataset_skew": unique_dataset_skew,
    "unique_within_file": unique_within_file,
    "unique_composite": unique_composite,
    "unique_hot_keys": unique_hot_keys,
    "unique_text_hashed": unique_text_hashed,
    "verdict": verdict,
    "report": report,
    "summary_by_rule": summary_by_rule,
    "summary_by_file": summary_by_file,
    "stage_counts": stage_counts,
    "silver": silver,
    "silver_typed": silver_typed,
    "quarantine": quarantine,
    "delimiter_repair": delimiter_repair,
    "lineage": lineage,
    "date_range": date_range,
    "backfill_dynamic": backfill_dynamic,
    "backfill_static": backfill_static,
    "header_drift": header_drift,
    "stream_verdict": stream_verdict,
    "rule_catalog": rule_catalog,
    "unique_multi_key": unique_multi_key,
    "null_keys_ignore": null_keys_ignore,
    "rule_allowed_typed": rule_allowed_typed,
    "strict_scale": strict_scale,
    "drift": drift,
    "backfill_late_rows": backfill_late_rows,
    "report_csv": report_csv,
    "backfill_keys": backfill_keys,
    "rule_runtime_errors": rule_runtime_errors,
    "rule_error_counts": rule_error_counts,
    "content_drift": content_drift,
    "ingest_separator_by_evidence": ingest_separator_by_evidence,
    "ingest_quoted_records": ingest_quoted_records,
    "summary_levels": summary_levels,
    "stream_keys": stream_keys,
    "run_metrics": run_metrics,
    "ingest_time": ingest_time,
    "ingest_header_order": ingest_header_order,
    "ingest_mixed_separators": ingest_mixed_separators,
    "ingest_header_like_rows": ingest_header_like_rows,
    "reject_malformed": reject_malformed,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
