"""The end-to-end run (section 3.1): bronze -> verdict -> silver / quarantine / report.

Plan: one evaluation of the contract, written once as the ``verdict`` table on
the output's shared storage - that write cuts the lineage, so a lost executor
later never re-runs the uniqueness shuffle, and the three outputs read only the
partitions they need.  Counts come from an ``Observation`` on that same write.

Every output is partitioned by where its rows came from first (the *run key*:
the date in the file's path, or the file column of a DataFrame source), so a
backfill replaces exactly the rows of the files it reads again, in all outputs
alike: rows of other files stay, whatever dates are in them.

A run writes a version of its own of every output, and all become live by one
commit at the end (:mod:`rowgate.sinks.versions`): a run that fails before it leaves
every output as it was.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract, ContractError
from ..operators import key_state, route
from ..operators.evaluate import as_of_date, evaluate, with_contract_columns
from ..session import fresh_dir
from ..sinks.versions import Outputs
from ..sinks.writers import write_csv_file
from ..sources.delimited import drift_rows, path_date, read_with_headers

#: Partition of all outputs of a text source: the date in the file's path.
FILE_DATE = "_file_date"
UNDATED = "undated"


class EmptyInput(RuntimeError):
    """Nothing to validate (no file in range, or no data row)."""


@dataclass
class RunResult:
    output_dir: str
    counts: dict
    drift: list
    timings: dict = field(default_factory=dict)
    header_drift: list = field(default_factory=list)
    #: Rows of files that were not read whose verdict was made anew.
    corrected_rows: int = 0

    def path(self, name: str) -> str:
        return f"{self.output_dir}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return Outputs(spark, self.output_dir).read(name)


def _apart(source, output_dir: str) -> None:
    """The outputs must not lie in the source, nor the source in the outputs."""
    def plain(p: str) -> str:
        return "/" + str(p).removeprefix("file:").strip("/") + "/"

    out = plain(output_dir)
    for p in source if isinstance(source, (list, tuple)) else [source]:
        if plain(p).startswith(out) or out.startswith(plain(p)):
            raise ContractError(f"output folder {output_dir!r} and source {p!r} overlap")


def run(
    spark: SparkSession,
    source,
    output_dir: str,
    contract,
    *,
    start=None,
    end=None,
    as_of=None,
    overwrite: str | None = None,
    on_missing: str = "fail",
    on_unexpected: str = "keep",
    silver_partition: str | None = "business_date",
    silver_folders: bool = False,
    keys_across_runs: bool | None = None,
    key_column: str | None = None,
    single_report_file: bool = False,
    typed_silver: bool = False,
    keep_line: bool = False,
    stage_bronze: bool = True,
    header: str | list | None = "auto",
    separator: str = "line",
    records: str = "line",
    **evaluate_kw,
) -> RunResult:
    """Validate ``source`` (path(s) of delimited text, or a DataFrame) and write
    ``bronze`` (text sources), ``verdict``, ``silver``, ``quarantine``,
    ``report``, ``summary_by_file``, ``summary_by_rule`` and a ``run_metrics``
    row under ``output_dir``.  All of them change together, by one commit; read them
    with ``Outputs(spark, output_dir).read(name)``, or by their paths between runs.

    ``overwrite`` is ``"dynamic"`` (replace only what came from the files of this
    run - the default when a date range is given) or ``"static"`` (replace whole
    outputs).  Drift policies: ``on_missing`` ``"fail"`` / ``"null_fill"``,
    ``on_unexpected`` ``"keep"`` / ``"drop"`` (columns the contract does not
    declare).  ``keep_line`` carries each input line as ``_line`` into the
    quarantine.  Silver's files are ordered by ``silver_partition``; with
    ``silver_folders`` each of its values is a folder.  ``keys_across_runs`` judges
    dataset keys among the rows of all files of all runs: rows read now against those
    of other files, and rows of other files anew where a key has got a twin or lost it
    (``corrected_rows``).  Without it, a run sees its own rows only; the default is
    what the outputs have been kept with.  ``key_column`` names the run key of a
    DataFrame source, in place of the file column.  ``stage_bronze`` (text sources): write the parsed lines once as
    the Parquet ``bronze`` table and validate from it.  ``single_report_file``
    also writes the whole report of this run as one CSV file (``report_file``).

    Nothing is written before the input is known to have rows and the
    contract's columns, and to lie apart from the outputs.
    """
    contract = Contract.load(contract)
    timings: dict[str, float] = {}
    t0 = time.perf_counter()
    as_of = as_of_date(spark, as_of)
    dynamic = (overwrite or ("dynamic" if (start or end) else "static")) == "dynamic"
    headers: list = []
    text = not isinstance(source, DataFrame)
    if text:
        _apart(source, output_dir)
        bronze, headers = read_with_headers(spark, source, contract, start=start, end=end, keep_line=keep_line, header=header, separator=separator,
                                            records=records)
        bronze = bronze.withColumn(FILE_DATE, F.coalesce(path_date(F.col("_source_path")).cast("string"), F.lit(UNDATED)))
        key = FILE_DATE
    else:
        bronze = source
        key = key_column or (contract.file_column if contract.file_column in source.columns else None)
        if dynamic and key is None:
            raise ContractError(f"a dynamic overwrite needs the file column {contract.file_column!r} in the data")
    if bronze.isEmpty():
        raise EmptyInput(f"no rows to validate in {source!r} (range {start}..{end})")
    drift = drift_rows(bronze.columns, contract)
    if any(kind == "missing" for _, kind in drift) and on_missing == "fail":
        raise ContractError(f"columns missing from input: {[c for c, k in drift if k == 'missing']}")
    drift = [(c, kind) for c, kind in drift if c != key_column]
    unexpected = [c for c, kind in drift if kind == "unexpected" and c != key]
    if unexpected and on_unexpected == "drop":
        bronze = bronze.drop(*unexpected)
    by_key = (key,) if key else ()
    outs = Outputs(spark, output_dir)
    version = outs.begin()
    keys = _feed_keys(contract, version.base, keys_across_runs)
    if keys and key is None:
        raise ContractError(f"keys across runs need the file column {contract.file_column!r} in the data")

    if text and stage_bronze:
        version.write("bronze", bronze, key=key, pack=False)
        bronze = version.own("bronze").select(*bronze.columns)
    read_keys = _staged(bronze.select(key).distinct(), "run-keys") if dynamic else None
    rows, state = bronze.withColumn(CORRECTED, F.lit(False)), {}
    changed = None
    if keys:
        rows, changed, totals = _with_changed(outs, version, bronze, contract, keys, key, read_keys)
        state = {"key_totals": totals}
    timings["bronze"] = time.perf_counter() - t0

    t = time.perf_counter()
    verdict = evaluate(rows, contract, as_of=as_of, on_missing=on_missing, **state, **evaluate_kw)
    obs = Observation("rowgate_run")
    own = ~F.col(CORRECTED)
    counted = verdict.observe(
        obs,
        F.count_if(own).alias("rows"),
        F.count_if(own & F.col("is_valid")).alias("valid_rows"),
        F.count_if(own & ~F.col("is_valid")).alias("invalid_rows"),
        F.coalesce(F.sum(F.when(own, F.size("violations"))), F.lit(0)).cast("long").alias("violations"),
        F.count_if(~own).alias("corrected_rows"),
    )
    version.write("verdict", counted.drop(CORRECTED), key=key, by=("is_valid",), pack=False)
    counts = dict(obs.get)
    corrected = counts.pop("corrected_rows")
    timings["validate"] = time.perf_counter() - t

    staged = version.own("verdict")
    cols = [c for c in contract.column_names if c in staged.columns]
    part = next((c for c in (silver_partition,) if c in cols and c != key), None)
    bad = staged.where(~F.col("is_valid"))

    keep = [c for c in (cols[0] if cols else None, contract.file_column, silver_partition, key)
            if c and c in staged.columns]
    rep = route.report(bad, keep=list(dict.fromkeys(keep)))
    # metadata names in, readable names out (the report is for people)
    shown = {c: c.lstrip("_") for c in (contract.file_column, key) if c and c.startswith("_") and c in rep.columns}
    by = list(dict.fromkeys(c for c in (contract.file_column, silver_partition, key) if c and c in staged.columns))
    # all of them read the verdict just written, and none waits for another
    timings |= _together({
        "silver": lambda: version.write("silver", route.silver(staged, contract, typed=typed_silver, extra=by_key), key=key,
                                        by=(part,) if part and silver_folders else (), order=part),
        "quarantine": lambda: version.write("quarantine", route.quarantine(staged, contract, extra=by_key), key=key),
        "report": lambda: version.write("report", rep.withColumnsRenamed(shown), key=shown.get(key, key), fmt="csv", options={"header": "true"}),
        "summaries": lambda: version.write("summary_by_file", route.summary_by(staged, *by), key=key),
        "rules": lambda: version.write("summary_by_rule", route.summary_by_rule(bad, *by_key), key=key),
    })
    timings["total"] = time.perf_counter() - t0
    metrics = _metrics(spark, contract, counts, timings, drift, start=start, end=end, as_of=as_of, dynamic=dynamic)
    version.write("run_metrics", metrics, key=None, pack=False, append=True)
    version.commit(_claims(version, read_keys, changed) if dynamic else "all")
    outs.clean()
    if single_report_file:
        write_csv_file(version.own("report"), f"{output_dir}/report_file")
    names = contract.column_names
    found = [d for d in (h.drift(names) for h in headers) if d["header"] is None or d["missing"] or d["unexpected"] or d["reordered"]]
    return RunResult(output_dir, counts, drift, timings, found, corrected)


#: Marks rows of files that a run has not read itself.
CORRECTED = "__corrected"


def _together(writes: dict) -> dict[str, float]:
    """Run independent writes at the same time; the seconds of each."""
    def timed(write) -> float:
        t = time.perf_counter()
        write()
        return time.perf_counter() - t

    with ThreadPoolExecutor(len(writes)) as pool:
        started = {name: pool.submit(timed, write) for name, write in writes.items()}
        return {name: f.result() for name, f in started.items()}


def _staged(df: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _feed_keys(contract: Contract, base: dict, across: bool | None) -> list:
    """The keys that this run judges over all runs."""
    kept = key_state.NAME in base["outputs"]
    if across is False and kept:
        raise ContractError("these outputs are kept with keys across runs; a run without would leave their state behind")
    return key_state.feed_keys(contract) if (kept if across is None else across) else []


def _with_changed(outs: Outputs, version, bronze: DataFrame, contract: Contract, keys: list, key: str,
                  read_keys: DataFrame | None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """The rows read with those of other files whose verdict changes, the keys of
    these files, and the totals of all keys that rows of both have.  Writes this run's
    part of the key state."""
    rules = sorted(key_state.rule_id(k) for k in keys)
    now = key_state.counts(with_contract_columns(bronze, contract, "null_fill"), keys, key)
    base = version.base
    older = base["outputs"].get(key_state.NAME)
    rows = bronze.withColumn(CORRECTED, F.lit(False))
    if read_keys is None or "verdict" not in base["outputs"]:  # nothing else stays
        version.write(key_state.NAME, now, key=key, order="digest", about={"rules": rules})
        now = version.own(key_state.NAME)
        return rows, None, key_state.totals(now.limit(0), now, key, None)
    mine = read_keys.select(F.col(key).alias("__mine"))
    is_mine = key_state.same(key, "__mine")
    verdict = outs.read("verdict", base)
    if older and older["about"].get("rules") == rules:
        version.write(key_state.NAME, now, key=key, order="digest", about={"rules": rules})
        now = version.own(key_state.NAME)
        state = outs.read(key_state.NAME, base)
    else:  # no state yet, or one of other keys: made from the stored rows, once
        state = _staged(key_state.counts(verdict, keys, key), "key-state")
        everything = state.join(mine, is_mine, "left_anti").unionByName(now)
        version.write(key_state.NAME, everything, key=key, order="digest", whole=True, about={"rules": rules})
        now = version.own(key_state.NAME).join(mine, is_mine, "left_semi")
    others = state.join(mine, is_mine, "left_anti")
    changed = _staged(key_state.changed_files(others, state.join(mine, is_mine, "left_semi"), now, key), "changed-files")
    if changed.isEmpty():
        return rows, None, key_state.totals(others, now, key, None)
    again = verdict.join(changed.select(F.col(key).alias("__changed")), key_state.same(key, "__changed"), "left_semi")
    again = again.drop(*route.VERDICT_COLUMNS).withColumn(CORRECTED, F.lit(True))
    return rows.unionByName(again, allowMissingColumns=True), changed, key_state.totals(others, now, key, changed)


def _claims(version, read_keys: DataFrame, changed: DataFrame | None) -> DataFrame:
    """``key, outputs``: what a dynamic run replaces.  Bronze and the key state hold the
    files read; all other outputs those with another verdict too."""
    def of(keys: DataFrame, names: list[str]) -> DataFrame:
        return keys.select(F.col(keys.columns[0]).cast("string").alias("key"), F.array(*[F.lit(n) for n in names]).alias("outputs"))

    names = [n for n, w in version.written.items() if not w["append"]]
    claims = of(read_keys, names)
    if changed is not None:
        claims = claims.unionByName(of(changed, [n for n in names if n not in ("bronze", key_state.NAME)]))
    return claims


def _metrics(spark, contract, counts, timings, drift, **params) -> DataFrame:
    """one row per run for ``run_metrics`` (a run history)."""
    row = {
        "run_id": uuid.uuid4().hex,
        "finished_at": _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
        "dataset": contract.dataset,
        "contract_version": contract.version,
        "params": json.dumps({k: (None if v is None else str(v)) for k, v in params.items()}),
        "drift": json.dumps(drift),
        **{k: int(counts.get(k) or 0) for k in ("rows", "valid_rows", "invalid_rows", "violations")},
        **{f"sec_{k}": round(float(v), 3) for k, v in timings.items()},
    }
    schema = ("run_id string, finished_at timestamp, dataset string, contract_version string, params string, "
              "drift string, rows long, valid_rows long, invalid_rows long, violations long, "
              + ", ".join(f"sec_{k} double" for k in timings))
    return spark.createDataFrame([tuple(row.values())], schema)
