"""Delimited text ingest with separator repair.

* a file's header is its first line that isn't blank, if more than half of the
  contract's columns are in it (case aside); each file is labelled by its own
  header, and only that line is taken out of the data.  Other lines are data,
  whatever they look like;
* a line's separator is the first of ``, | ;`` outside double quotes (so
  ``a,b;c`` stays a comma row); in a line that begins with ``|`` or ``;`` both
  separate;
* a record is a line; with ``records="quoted"`` a quoted field may go over several lines
  (:func:`join_records`);
* with ``separator="evidence"`` a file's lines decide together: the separator by which
  most of them have as many fields as the file has columns, if it is more than half and
  no other does as well, separates all lines of the file, and others are text (decimal
  commas, a ``;`` in a first field).  Files without such a one keep the line rule;
* ``from_csv`` parses it (quotes honoured, short rows null-filled, extra fields
  dropped, unclosed quotes swallow the rest); lines with a wrong field count
  are flagged ``_malformed``;
* lineage comes from ``_metadata`` (file name and path), the ingest time is
  one literal per run, and a date range on the *last* ``yyyy-MM-dd`` in the
  file path selects files (works for dated file names and dated folders, on
  any file system Spark reads).

Headers are found by one aggregation over the first block of every file
(``header=None`` leaves it out).  Only distinct headers reach the driver.  Files with the most common header need no join; a
join on the path labels the lines of the others.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..contract import Contract, ContractError

# The separators a line may use, and how the first one is found.
SEPARATORS = (",", "|", ";")
_FIRST_SEPARATOR = r'^(?:"[^"]*"|[^,|;"])*+([,|;])'
_UNQUOTED_SEPARATOR = r'[|;](?=(?:[^"]*"[^"]*")*[^"]*$)'
_PATH_DATE = r".*(\d{4}-\d{2}-\d{2})"

META_COLUMNS = ("_source_file", "_source_path", "_ingested_at", "_delimiter_issue", "_malformed")
#: Different headers of one feed beyond which it is taken for a mistake.
MAX_HEADERS = 200


def path_date(path: Column) -> Column:
    """The last ``yyyy-MM-dd`` in a path as a date (null when absent or impossible)."""
    return F.regexp_extract(path, _PATH_DATE, 1).try_cast("date")


def _date(value) -> _dt.date | None:
    if value is None or value == "":
        return None
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value))


def date_filter(path: Column, start=None, end=None) -> Column | None:
    """Inclusive file-date range; either end may be open."""
    start, end = _date(start), _date(end)
    if start is None and end is None:
        return None
    d = path_date(path)
    cond = d.isNotNull()
    if start is not None:
        cond = cond & (d >= F.lit(start))
    if end is not None:
        cond = cond & (d <= F.lit(end))
    return cond


def read_lines(spark: SparkSession, paths, *, start=None, end=None, blank: bool = False) -> DataFrame:
    """Raw lines of one path, a directory or a list, with lineage.

    Lines of blanks only are skipped, unless ``blank``.  ``_block`` is where the block
    that holds the line starts in its file.
    """
    if isinstance(paths, (list, tuple)):
        paths = list(paths)
    raw = spark.read.text(paths)
    cond = date_filter(F.col("_metadata.file_path"), start, end)
    if cond is not None:
        raw = raw.where(cond)
    lines = raw.select(
        F.col("value"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    return lines if blank else lines.where(F.col("value").rlike(r"\S"))


#: Lines of one record beyond which its opening quote is taken for a stray one.
MAX_RECORD_LINES = 10_000


def join_records(lines: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """Lines (:func:`read_lines` with blank ones) as records: those between an opening and
    a closing quote are one, with their line ends.

    A file is still read in blocks by many tasks.  Whether a line begins inside quotes
    depends on the number of quotes before it, odd or even.  Each block counts its own; a
    running sum over the blocks of a file (a row each) tells where every block begins, and
    one within the block where every line does.  Blocks without a line of an odd number
    of quotes, begun outside of any, pass through as they are; of the others, only the
    lines of records of several lines are brought together, across blocks too.  A file with
    a record of more than ``max_lines`` lines has a stray quote and is read line by line.
    """
    names = ["value", "_source_file", "_source_path", "_block"]
    plain = F.replace("value", F.lit('\\"'), F.lit(""))
    odd = (F.length(plain) - F.length(F.replace(plain, F.lit('"')))) % 2
    lines = lines.withColumn("__at", F.monotonically_increasing_id()).withColumn("__odd", odd)
    block = ["_source_path", "_block"]
    earlier = Window.partitionBy("_source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (lines.groupBy(*block).agg(F.sum("__odd").alias("n"))
              .withColumn("begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)) % 2).where("n > 0 or begin = 1"))
    whole = lines.join(blocks.select(*block), block, "left_anti")
    before = Window.partitionBy(*block).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*block).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = lines.join(blocks.select(*block, "begin"), block)
    inside = inside.withColumn("__inside", (F.col("begin") + F.coalesce(F.sum("__odd").over(before), F.lit(0))) % 2 == 1)
    inside = inside.withColumn("__no", F.sum((~F.col("__inside")).cast("int")).over(upto))
    # a line that goes on with an earlier block's record belongs to the last one begun there
    last = (inside.groupBy(*block).agg(F.max("__no").alias("last"))
            .withColumn("owner", F.last(F.when(F.col("last") > 0, F.struct(F.col("_block").alias("b"), F.col("last").alias("no"))), True).over(earlier)))
    alone = ~F.col("__inside") & (F.col("__odd") == 0)
    single = inside.where(alone)
    several = (inside.where(~alone).join(last.select(*block, "owner"), block)
               .withColumn("__record", F.when(F.col("__no") > 0, F.struct(F.col("_block").alias("b"), F.col("__no").alias("no"))).otherwise(F.col("owner"))))
    record = ["_source_path", "__record"]
    stray = several.groupBy(*record).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_lines).select("_source_path").distinct()
    joined = (several.join(stray, "_source_path", "left_anti").groupBy(*record, "_source_file")
              .agg(F.array_sort(F.collect_list(F.struct("_block", "__at", "value"))).alias("v"))
              .select(F.array_join("v.value", "\n").alias("value"), "_source_file", "_source_path", F.col("__record.b").alias("_block")))
    by_line = several.join(stray, "_source_path", "left_semi")
    out = whole.select(*names).unionByName(single.select(*names)).unionByName(joined.select(*names)).unionByName(by_line.select(*names))
    return out.where(F.col("value").rlike(r"\S"))


def _tokens(line: Column) -> Column:
    """The names in a header line."""
    return F.transform(F.split(line, r"[,|;]"), lambda t: F.trim(F.regexp_replace(F.trim(t), '^"|"$', "")))


def file_headers(lines: DataFrame, names: list[str]) -> DataFrame:
    """``_source_path, _source_file, first, header``: per file its first line,
    and the same as ``header`` where it is one."""
    # within a file, ids grow with the lines of its first block
    first = (lines.where("_block = 0").withColumn("_at", F.monotonically_increasing_id())
             .groupBy("_source_path", "_source_file").agg(F.min_by("value", "_at").alias("first")))
    tokens = F.transform(_tokens(F.col("first")), F.lower)
    known = F.array(*[F.lit(n.lower()) for n in names])
    is_header = ((2 * F.size(F.array_intersect(tokens, known)) > len(names))
                 & (F.size(F.array_distinct(tokens)) == F.size(tokens)))
    return first.withColumn("header", F.when(is_header, F.col("first")))


@dataclass(frozen=True)
class Header:
    """One header of a feed: its line (None for files without), its columns in
    order under the contract's spelling, and how many files have it."""

    line: str | None
    columns: tuple[str, ...]
    files: int

    def drift(self, names: list[str]) -> dict:
        found = [c for c in self.columns if c in names]
        return {
            "header": self.line, "files": self.files,
            "missing": [c for c in names if c not in self.columns],
            "unexpected": [c for c in self.columns if c not in names],
            "reordered": found != [c for c in names if c in found],
        }


def find_headers(lines: DataFrame, names: list[str]) -> list[Header]:
    """The distinct headers, the most common first."""
    spelled = {n.lower(): n for n in names}
    rows = (file_headers(lines, names).groupBy("header").agg(F.count(F.lit(1)).alias("files"))
            .select("header", "files", _tokens(F.col("header")).alias("tokens"))
            .orderBy(F.desc("files"), "header").limit(MAX_HEADERS + 1).collect())
    if len(rows) > MAX_HEADERS:
        raise ContractError(f"more than {MAX_HEADERS} different headers; give the header")
    return [Header(r["header"], tuple(spelled.get(t.lower(), t) for t in r["tokens"]) if r["header"] else tuple(names), r["files"])
            for r in rows]


def file_separators(lines: DataFrame, width: Column) -> DataFrame:
    """``_source_path, separator``: of every file, the separator that its lines agree on,
    by one aggregation over all lines (null where they don't)."""
    plain = F.regexp_replace("value", '"[^"]*"', "")
    fits = [F.count_if(F.length(plain) - F.length(F.replace(plain, F.lit(s))) + 1 == width).alias(f"n{i}") for i, s in enumerate(SEPARATORS)]
    counted = lines.groupBy("_source_path").agg(F.count(F.lit(1)).alias("n"), *fits)
    most = F.greatest(*[F.col(f"n{i}") for i in range(len(SEPARATORS))])
    chosen = F.array_compact(F.array(*[F.when(F.col(f"n{i}") == most, F.lit(s)) for i, s in enumerate(SEPARATORS)]))
    alone = (2 * most > F.col("n")) & (F.size(chosen) == 1)
    return counted.select("_source_path", F.when(alone, F.element_at(chosen, 1)).alias("separator"))


def parse_lines(lines: DataFrame, names: list[str], headers: list[Header], *, ingested_at=None, keep_line: bool = False,
                separator: str = "line") -> DataFrame:
    """Detect the separator, parse by the file's header, flag, drop headers."""
    if separator not in ("line", "evidence"):
        raise ContractError(f"separator must be line or evidence, got {separator!r}")
    headers = headers or [Header(None, tuple(names), 0)]
    extra = list(dict.fromkeys(c for h in headers for c in h.columns if c not in names))
    numbered = lines.withColumn("__h", F.lit(0))
    if len(headers) > 1:
        number = F.lit(None).cast("int")
        for i, h in enumerate(headers):
            number = F.when(F.col("header").eqNullSafe(F.lit(h.line)), F.lit(i)).otherwise(number)
        others = (file_headers(lines, names).select("_source_path", number.alias("__other")).where("__other > 0"))
        numbered = (lines.join(others, "_source_path", "left")
                    .withColumn("__h", F.coalesce("__other", F.lit(0))).drop("__other"))
    sep = F.regexp_extract("value", _FIRST_SEPARATOR, 1)
    own = F.lit(None).cast("string")
    if separator == "evidence":
        width = F.lit(len(headers[0].columns))
        for i, h in enumerate(headers):
            width = F.when(F.col("__h") == i, len(h.columns)).otherwise(width)
        numbered = numbered.join(file_separators(numbered, width), "_source_path", "left").withColumnRenamed("separator", "__own")
        own = F.col("__own")
        sep = F.coalesce(own, sep)
    line = (F.when(~sep.isin("|", ";") | own.isNotNull(), F.col("value"))
            .when(F.col("value").contains('"'), F.regexp_replace("value", _UNQUOTED_SEPARATOR, "|"))
            .otherwise(F.translate("value", ";", "|")))
    staged = numbered.select("*", sep.alias("__sep"), line.alias("__line"), (own == ";").alias("__semi"))
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = []
    for i, h in enumerate(headers):
        ddl = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in h.columns) + ", `_corrupt_record` STRING"
        own = F.when(F.col("__sep").isin("|", ";"), F.from_csv("__line", ddl, {**opts, "sep": "|"})).otherwise(
            F.from_csv("__line", ddl, {**opts, "sep": ","}))
        if separator == "evidence":
            own = F.when(F.col("__semi"), F.from_csv("__line", ddl, {**opts, "sep": ";"})).otherwise(own)
        parsed.append((own if len(headers) == 1 else F.when(F.col("__h") == i, own)).alias(f"__p{i}"))
    header_line = F.lit(None).cast("string")
    for i, h in enumerate(headers):
        header_line = F.when(F.col("__h") == i, F.lit(h.line)).otherwise(header_line)
    is_header = (F.col("_block") == 0) & F.coalesce(F.col("value") == header_line, F.lit(False))
    staged = staged.where(~is_header).select("*", *parsed)

    def field(c: str) -> Column:
        own = [F.col(f"__p{i}").getField(c) for i, h in enumerate(headers) if c in h.columns or c == "_corrupt_record"]
        return F.coalesce(*own) if own else F.lit(None).cast("string")

    if ingested_at is None:
        ingested_at = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    out = [field(c).alias(c) for c in [*names, *extra]]
    out += [
        F.col("_source_file"),
        F.col("_source_path"),
        F.lit(ingested_at).alias("_ingested_at"),
        F.col("__sep").isin("|", ";").alias("_delimiter_issue"),
        field("_corrupt_record").isNotNull().alias("_malformed"),
    ]
    if keep_line:
        out.append(F.col("value").alias("_line"))
    return staged.select(*out)


def read_delimited(spark: SparkSession, paths, contract, *, start=None, end=None,
                   ingested_at=None, keep_line: bool = False, header: str | list | None = "auto", separator: str = "line",
                   records: str = "line") -> DataFrame:
    """Bronze: contract columns as strings plus lineage and repair flags.

    ``header="auto"`` labels every file's fields by its own header (columns the
    contract does not know are kept as extra columns, contract columns that a
    header lacks are null, and a file without a header is in contract order).
    ``header="contract"`` labels all files in contract order and a list gives the
    order; header lines are only taken out.  ``header=None`` is for files that have
    none: every line is data.  ``separator="evidence"`` lets the lines of a file decide
    on its separator together, at the cost of reading them twice.  ``records="quoted"``
    lets quoted fields go over several lines.
    """
    return read_with_headers(spark, paths, contract, start=start, end=end, ingested_at=ingested_at,
                             keep_line=keep_line, header=header, separator=separator, records=records)[0]


def read_with_headers(spark: SparkSession, paths, contract, *, start=None, end=None, ingested_at=None,
                      keep_line: bool = False, header: str | list | None = "auto", separator: str = "line",
                      records: str = "line") -> tuple[DataFrame, list[Header]]:
    """As :func:`read_delimited`, with the headers found."""
    names = Contract.load(contract).column_names
    if records not in ("line", "quoted"):
        raise ContractError(f"records must be line or quoted, got {records!r}")
    lines = read_lines(spark, paths, start=start, end=end)
    headers = [Header(None, tuple(names), 0)] if header is None else find_headers(lines, names)
    found = headers
    if header not in ("auto", None):  # labels are given; headers are only taken out
        order = tuple(header) if isinstance(header, (list, tuple)) else tuple(names)
        headers = [Header(h.line, order, h.files) for h in headers]
    if records == "quoted":
        lines = join_records(read_lines(spark, paths, start=start, end=end, blank=True))
    return parse_lines(lines, names, headers, ingested_at=ingested_at, keep_line=keep_line, separator=separator), found


def header_drift(spark: SparkSession, paths, contract, *, start=None, end=None) -> DataFrame:
    """Per file, its header versus the contract (missing / unexpected /
    reordered columns, or no header at all).  One aggregation over the files'
    first blocks; one row per file."""
    columns = Contract.load(contract).column_names
    per_file = file_headers(read_lines(spark, paths, start=start, end=end), columns)
    names = F.array(*[F.lit(c.lower()) for c in columns])
    found = F.when(F.col("header").isNull(), F.array().cast("array<string>")).otherwise(F.transform(_tokens(F.col("header")), F.lower))
    shown = F.when(F.col("header").isNull(), F.array().cast("array<string>")).otherwise(_tokens(F.col("header")))
    return per_file.select(
        "_source_file", "_source_path",
        path_date(F.col("_source_path")).alias("file_date"),
        F.col("header").isNotNull().cast("long").alias("header_lines"),
        F.when(F.col("header").isNotNull(), F.array_join(shown, ",")).alias("header"),
        F.array_join(F.filter(F.array(*[F.lit(c) for c in columns]), lambda c: ~F.array_contains(found, F.lower(c))), ",").alias("missing"),
        F.array_join(F.filter(shown, lambda t: ~F.array_contains(names, F.lower(t))), ",").alias("unexpected"),
        (F.col("header").isNotNull() & (F.array_join(F.array_intersect(found, names), ",")
                                        != F.array_join(F.array_intersect(names, found), ","))
         ).alias("reordered"),
    )


def drift_rows(columns: list[str], contract) -> list[tuple[str, str]]:
    """D1-D3 on the driver: ``(column, "missing" | "unexpected")`` pairs.
    Names that start with ``_`` are metadata and ignored, case differences too."""
    expected = Contract.load(contract).column_names
    actual = [c for c in columns if not c.startswith("_")]
    there, known = {c.lower() for c in actual}, {c.lower() for c in expected}
    rows = [(c, "missing") for c in expected if c.lower() not in there]
    rows += [(c, "unexpected") for c in actual if c.lower() not in known]
    return rows


def schema_drift(df: DataFrame, contract) -> DataFrame:
    """D1-D3 as a small DataFrame (schema comparison only; no job reads data)."""
    return df.sparkSession.createDataFrame(drift_rows(df.columns, contract), "column string, drift string")
