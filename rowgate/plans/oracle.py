"""DuckDB SQL oracles for the registered queries.

Written by hand from the rule semantics (not generated from contract
objects), so they check the Spark plans independently.  Tables are the
driver's pre-registered views; ``FEED`` re-creates the dirty-orders feed of
:func:`rowgate.plans.fixtures.dirty_orders` in SQL.
"""

from __future__ import annotations


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


FEED = """
feed AS (
  SELECT
    o_orderkey AS order_key,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN ' '
         WHEN o_orderkey % 53 = 0 THEN concat('K', CAST(o_orderkey - 1 AS varchar), ' ')
         ELSE concat('K', CAST(o_orderkey AS varchar)) END AS record_id,
    CASE WHEN o_orderkey % 97 = 0 THEN 'noon on day 41'
         WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_orderdate + INTERVAL 9 DAY AS date) AS varchar)
         ELSE CAST(CAST(o_orderdate AS date) AS varchar) END AS event_ts,
    CASE WHEN o_orderkey % 83 = 0 THEN '2021-13-01' WHEN o_orderkey % 79 = 0 THEN '2044-07-09'
         ELSE CAST(CAST(o_orderdate AS date) AS varchar) END AS business_date,
    CASE WHEN o_orderkey % 73 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS source_system,
    CASE WHEN o_orderkey % 71 = 0 THEN concat(' ', o_orderstatus) WHEN o_orderkey % 67 = 0 THEN '?'
         ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 61 = 0 THEN '12,5 EUR' WHEN o_orderkey % 59 = 0 THEN '-0.75'
         WHEN o_orderkey % 47 = 0 THEN '0.00' WHEN o_orderkey % 43 = 0 THEN NULL
         ELSE CAST(CAST(o_totalprice AS decimal(18,2)) AS varchar) END AS amount,
    CASE WHEN o_orderkey % 41 = 0 THEN 'Z9' WHEN o_orderkey % 37 = 0 THEN ' ' ELSE 'US' END AS country_code,
    CASE WHEN o_custkey % 2 = 0 THEN 'f0' ELSE 'f1' END AS source_file,
    year(o_orderdate) AS order_year
  FROM orders
)"""

PRIORITY_LIST = "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']"
STATUS_LIST = "['F', 'O', 'P']"


def v(kind: str, column: str | None, rule: str, bad: str, message: str) -> str:
    """One rule as ``CASE WHEN bad THEN {kind, column, rule, message} END``."""
    col = "NULL::varchar" if column is None else lit(column)
    return (f"CASE WHEN {bad} THEN {{'kind': {lit(kind)}, 'column': {col}, 'rule': {lit(rule)}, "
            f"'message': {message}}} END")


# ---- feed rules, in verdict order --------------------------------------------
def req(c: str) -> str:
    return v("required", c, "required", f"({c} IS NULL OR trim({c}) = '')",
             lit(f"{c}: required field is null or empty"))


def allowed(c: str, values: list[str], shown: str) -> str:
    inlist = ", ".join(lit(x) for x in values)
    return v("allowed_values", c, "allowed_values", f"({c} IS NOT NULL AND trim({c}) NOT IN ({inlist}))",
             f"{lit(c + ': ' + chr(39))} || {c} || {lit(chr(39) + ' not in allowed_values ' + shown)}")


def typecheck(c: str, sqltype: str, rule: str, word: str) -> str:
    return v("type", c, rule, f"({c} IS NOT NULL AND try_cast({c} AS {sqltype}) IS NULL)",
             f"{lit(c + ': ' + chr(39))} || {c} || {lit(chr(39) + ' is not a valid ' + word)}")


R_REQ = [req(c) for c in ("record_id", "event_ts", "business_date", "source_system", "status",
                          "amount", "country_code")]
R_ALLOWED = [
    allowed("source_system", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], PRIORITY_LIST),
    allowed("status", ["F", "O", "P"], STATUS_LIST),
]
R_TYPE_TS = typecheck("event_ts", "TIMESTAMP", "type:timestamp", "timestamp")
R_TYPE_DATE = typecheck("business_date", "DATE", "type:date", "date")
R_TYPE_DEC = typecheck("amount", "DECIMAL(18,2)", "type:decimal(18,2)", "decimal")
R_REGEX = v("regex", "country_code", "regex",
            "(country_code IS NOT NULL AND NOT regexp_matches(country_code, '^[A-Z]{2}$'))",
            "'country_code: ''' || country_code || ''' does not match pattern ^[A-Z]{2}$'")
R_MIN = v("range", "amount", "min_value",
          "(try_cast(amount AS DECIMAL(18,2)) < 0)",
          "'amount: ' || amount || ' is below min_value 0'")
R_FINAL = v("business_rule", None, "final_amount_positive",
            "(upper(trim(status)) = 'F' AND NOT (try_cast(amount AS DECIMAL(18,2)) > 0))",
            "'business_rule: final_amount_positive - amount must be > 0 when status=F'")
R_NEAR = v("business_rule", None, "event_ts_near_business_date",
           "(NOT (abs(date_diff('day', try_cast(business_date AS DATE), "
           "CAST(try_cast(event_ts AS TIMESTAMP) AS DATE))) <= 7))",
           "'business_rule: event_ts_near_business_date - event_ts ' || event_ts || "
           "' is more than 7 days from business_date ' || business_date")
R_FUTURE = v("business_rule", None, "business_date_not_far_future",
             "(NOT (try_cast(business_date AS DATE) <= DATE '2020-01-02'))",
             "'business_rule: business_date_not_far_future - business_date ' || business_date || "
             "' is more than 1 day in the future'")
R_DUP = v("unique", "record_id", "unique", "(count(*) OVER (PARTITION BY trim(record_id)) > 1)",
          "'record_id: duplicate record_id found across files'")
R_DUP_FILE = v("unique", "record_id", "unique_within_file",
               "(count(*) OVER (PARTITION BY source_file, trim(record_id)) > 1)",
               "'record_id: duplicate record_id found within file'")

ALL_FEED_RULES = R_REQ + R_ALLOWED + [R_TYPE_TS, R_TYPE_DATE, R_TYPE_DEC, R_REGEX, R_MIN,
                                      R_FINAL, R_NEAR, R_FUTURE, R_DUP]


def feed_checked(rules: list[str]) -> str:
    """CTEs ``feed`` and ``checked`` (feed + list ``vs`` of violation structs)."""
    arr = ",\n      ".join(rules)
    return (f"WITH {FEED},\nchecked AS (\n  SELECT *, list_filter([\n      {arr}\n    ], lambda x: x IS NOT NULL) AS vs\n"
            f"  FROM feed\n)")


def feed_report(rules: list[str], kind: str | None = None) -> str:
    where = f"WHERE r.v.kind = {lit(kind)}" if kind else ""
    return (feed_checked(rules) + "\nSELECT order_key, r.v.kind AS kind, r.v.column AS \"column\", "
            "r.v.rule AS rule, r.v.message AS violation\n"
            "FROM (SELECT order_key, unnest(vs) AS v FROM checked) r " + where)


def feed_verdict(rules: list[str]) -> str:
    return (feed_checked(rules) + "\nSELECT order_key, record_id, len(vs) = 0 AS is_valid, "
            "array_to_string(list_transform(vs, lambda x: x.message), '|') AS rejection_reasons, "
            "CAST(len(vs) AS INTEGER) AS n_violations FROM checked")


FEED_COLS = ("order_key, record_id, event_ts, business_date, source_system, status, amount, "
             "country_code, source_file")


def _report_indexed(rules: list[str]) -> str:
    return (feed_checked(rules) + "\nSELECT order_key, source_file, business_date, "
            "CAST(r.i - 1 AS INTEGER) AS violation_index, r.vs[r.i].kind AS kind, "
            "r.vs[r.i].column AS \"column\", r.vs[r.i].rule AS rule, r.vs[r.i].message AS violation\n"
            "FROM (SELECT order_key, source_file, business_date, vs, "
            "unnest(generate_series(1, len(vs))) AS i FROM checked WHERE len(vs) > 0) r")


def _summary_rule(rules: list[str]) -> str:
    return (feed_checked(rules) + "\nSELECT r.v.kind AS kind, r.v.column AS \"column\", r.v.rule AS rule, "
            "count(*) AS violations FROM (SELECT unnest(vs) AS v FROM checked) r GROUP BY ALL")


def _summary_file(rules: list[str]) -> str:
    return (feed_checked(rules) + "\nSELECT source_file, count(*) AS \"rows\", "
            "count(*) FILTER (WHERE len(vs) = 0) AS valid_rows, "
            "count(*) FILTER (WHERE len(vs) > 0) AS invalid_rows, "
            "CAST(sum(len(vs)) AS BIGINT) AS violations FROM checked GROUP BY source_file")


def _stage_counts(rules: list[str]) -> str:
    return (feed_checked(rules) + "\nSELECT count(*) AS \"rows\", "
            "count(*) FILTER (WHERE len(vs) = 0) AS valid_rows, "
            "count(*) FILTER (WHERE len(vs) > 0) AS invalid_rows, "
            "CAST(sum(len(vs)) AS BIGINT) AS violations FROM checked")


# ---- other tables ----------------------------------------------------------
LINEITEM_ASSERT = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'business_rule' AS kind, NULL::varchar AS "column",
       'quantity_below_fifty' AS rule, 'business_rule: quantity_below_fifty failed' AS violation
FROM lineitem WHERE NOT (l_quantity < 50)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'business_rule', NULL::varchar,
       'discounted_price_positive', 'business_rule: discounted_price_positive failed'
FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) > 1000)
"""

EVENTS_CONDITIONAL = """
SELECT event_id, 'business_rule' AS kind, NULL::varchar AS "column", 'purchase_value_at_least_one' AS rule,
       'business_rule: purchase_value_at_least_one failed' AS violation
FROM events WHERE event_type = 'purchase' AND NOT (value >= 1)
UNION ALL
SELECT event_id, 'business_rule', NULL::varchar, 'error_has_props',
       'business_rule: error_has_props failed'
FROM events WHERE event_type = 'error' AND NOT (props IS NOT NULL AND props LIKE '{%}')
"""

PAGES_REGEX = """
SELECT page_id, 'regex' AS kind, 'url' AS "column", 'regex' AS rule,
       'url: ''' || url || ''' does not match pattern ^https://[a-z]+\\.example\\.(com|org)/' AS violation
FROM pages WHERE url IS NOT NULL AND NOT regexp_matches(url, '^https://[a-z]+\\.example\\.(com|org)/')
"""

CUSTOMER_RULES = """
SELECT c_custkey, 'regex' AS kind, 'c_name' AS "column", 'regex' AS rule,
       'c_name: ''' || c_name || ''' does not match pattern ^Customer#0{5}[0-9]{4}$' AS violation
FROM customer WHERE c_name IS NOT NULL AND NOT regexp_matches(c_name, '^Customer#0{5}[0-9]{4}$')
UNION ALL
SELECT c_custkey, 'range', 'c_acctbal', 'min_value',
       'c_acctbal: ' || CAST(c_acctbal AS varchar) || ' is below min_value 0'
FROM customer WHERE c_acctbal < 0
"""

PART_MAX = """
SELECT p_partkey, 'range' AS kind, 'p_size' AS "column", 'max_value' AS rule,
       'p_size: ' || CAST(p_size AS varchar) || ' exceeds max_value 45' AS violation
FROM part WHERE p_size > 45
UNION ALL
SELECT p_partkey, 'allowed_values', 'p_brand', 'allowed_values',
       'p_brand: ''' || p_brand || ''' not in allowed_values [''Brand#11'', ''Brand#12'', ''Brand#13'']'
FROM part WHERE p_brand IS NOT NULL AND trim(p_brand) NOT IN ('Brand#11', 'Brand#12', 'Brand#13')
"""

LINEITEM_UNIQUE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'unique' AS kind, 'l_orderkey,l_linenumber' AS "column",
       'unique' AS rule,
       '(l_orderkey, l_linenumber): duplicate (l_orderkey, l_linenumber) found across files' AS violation
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
WHERE n > 1
"""

LINEITEM_HOT = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'unique' AS kind, 'l_returnflag,l_linestatus' AS "column",
       'unique' AS rule,
       '(l_returnflag, l_linestatus): duplicate (l_returnflag, l_linestatus) found across files' AS violation
FROM (SELECT *, count(*) OVER (PARTITION BY trim(l_returnflag), trim(l_linestatus)) AS n FROM lineitem)
WHERE n > 1
"""

DOCUMENTS_UNIQUE = """
SELECT doc_id, 'unique' AS kind, 'text' AS "column", 'unique' AS rule,
       'text: duplicate text found across files' AS violation
FROM (SELECT doc_id, count(*) OVER (PARTITION BY trim(text)) AS n FROM documents) WHERE n > 1
"""

LABELS_RULES = """
SELECT doc_id, 'allowed_values' AS kind, 'quality' AS "column", 'allowed_values' AS rule,
       'quality: ''' || CAST(quality AS varchar) || ''' not in allowed_values [0, 1]' AS violation
FROM labels WHERE quality IS NOT NULL AND CAST(quality AS varchar) NOT IN ('0', '1')
UNION ALL
SELECT doc_id, 'business_rule', NULL::varchar, 'toxic_is_low_quality',
       'business_rule: toxic_is_low_quality - doc ' || CAST(doc_id AS varchar) || ' is toxic but quality 1'
FROM labels WHERE toxic = 1 AND NOT (quality = 0)
UNION ALL
SELECT doc_id, 'unique', 'doc_id', 'unique', 'doc_id: duplicate doc_id found across files'
FROM (SELECT doc_id, count(*) OVER (PARTITION BY doc_id) AS n FROM labels) WHERE n > 1
"""

CONVERSATIONS_RULES = """
SELECT conv_id, turn, 'allowed_values' AS kind, 'role' AS "column", 'allowed_values' AS rule,
       'role: ''' || role || ''' not in allowed_values [''user'', ''assistant'']' AS violation
FROM conversations WHERE role IS NOT NULL AND trim(role) NOT IN ('user', 'assistant')
UNION ALL
SELECT conv_id, turn, 'required', 'text', 'required', 'text: required field is null or empty'
FROM conversations WHERE text IS NULL OR trim(text) = ''
UNION ALL
SELECT conv_id, turn, 'unique', 'conv_id,turn', 'unique',
       '(conv_id, turn): duplicate (conv_id, turn) found across files'
FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id, turn) AS n FROM conversations) WHERE n > 1
"""


def _feed_rows(where: str = "", extra: str = "") -> str:
    return f"WITH {FEED}\nSELECT {FEED_COLS}{extra} FROM feed {where}"


def _silver(typed: bool) -> str:
    if not typed:
        cols = FEED_COLS
    else:
        cols = ("order_key, record_id, CAST(event_ts AS TIMESTAMP) AS event_ts, "
                "CAST(business_date AS DATE) AS business_date, source_system, status, "
                "CAST(amount AS DECIMAL(18,2)) AS amount, country_code, source_file")
    return feed_checked(ALL_FEED_RULES) + f"\nSELECT {cols} FROM checked WHERE len(vs) = 0"


def _quarantine() -> str:
    return (feed_checked(ALL_FEED_RULES) + f"\nSELECT {FEED_COLS}, "
            "array_to_string(list_transform(vs, lambda x: x.message), '|') AS rejection_reasons "
            "FROM checked WHERE len(vs) > 0")


TEXT_COLS = ("CAST(order_key AS VARCHAR) AS order_key, record_id, event_ts, business_date, "
             "source_system, status, amount, country_code, source_file")


def _backfill(dynamic: bool, late: bool = False) -> str:
    """A run over all files, then one over those of 1996: what it replaces is
    what came from these files, whatever the dates of their rows."""
    rules = ",\n      ".join(ALL_FEED_RULES)
    year = "order_year + CASE WHEN order_key % 11 = 0 THEN 1 ELSE 0 END" if late else "order_year"
    head = (f"WITH {FEED},\n"
            f"files AS (SELECT *, {year} AS file_year FROM feed),\n"
            f"run1 AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS vs FROM files),\n"
            f"again AS (SELECT * FROM files WHERE file_year = 1996),\n"
            f"run2 AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS vs FROM again)\n")
    second = f"SELECT {TEXT_COLS} FROM run2 WHERE len(vs) = 0"
    if not dynamic:
        return head + second
    return head + f"SELECT {TEXT_COLS} FROM run1 WHERE len(vs) = 0 AND file_year <> 1996\nUNION ALL\n" + second


def _backfill_keys() -> str:
    """The verdict of all files in one run; keys are text as the files hold them."""
    return feed_verdict(ALL_FEED_RULES).replace("SELECT order_key,", "SELECT CAST(order_key AS VARCHAR) AS order_key,")


def _report_csv() -> str:
    rules = ",\n      ".join(ALL_FEED_RULES)
    rows = ("SELECT CAST(order_key AS VARCHAR) AS order_key, CAST(r.i - 1 AS VARCHAR) AS violation_index, r.vs[r.i].kind AS kind, "
            "r.vs[r.i].column AS \"column\", r.vs[r.i].rule AS rule, r.vs[r.i].message AS violation, "
            "CAST(order_year AS VARCHAR) || '-01-01' AS file_date "
            "FROM (SELECT order_key, order_year, vs, unnest(generate_series(1, len(vs))) AS i FROM ")
    return (f"WITH {FEED},\n"
            f"run1 AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS vs FROM feed),\n"
            f"again AS (SELECT * FROM feed WHERE order_year = 1996),\n"
            f"run2 AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS vs FROM again)\n"
            f"{rows}run1 WHERE len(vs) > 0 AND order_year <> 1996) r\nUNION ALL\n{rows}run2 WHERE len(vs) > 0) r")


def _run_metrics() -> str:
    params = '{"start": null, "end": null, "as_of": "2020-01-01", "dynamic": "False"}'
    return _stage_counts(ALL_FEED_RULES).replace("AS violations FROM checked", f"AS violations, {lit(params)} AS params FROM checked")


LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _line_unique(*keys: str) -> str:
    """Rows of lineitem whose key occurs again, for every key."""
    parts = []
    for k in keys:
        name = f"({k})" if ", " in k else k
        parts.append(f"SELECT {LINE_KEYS}, 'unique' AS kind, {lit(k.replace(', ', ','))} AS \"column\", 'unique' AS rule, "
                     f"{lit(f'{name}: duplicate {name} found across files')} AS violation "
                     f"FROM (SELECT *, count(*) OVER (PARTITION BY {k}) AS n FROM lineitem) WHERE n > 1")
    return "\nUNION ALL\n".join(parts)


ALLOWED_TYPED = f"""
SELECT {LINE_KEYS}, 'allowed_values' AS kind, 'l_discount' AS "column", 'allowed_values' AS rule
FROM lineitem WHERE l_discount IS NOT NULL AND l_discount NOT IN (0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06)
UNION ALL
SELECT {LINE_KEYS}, 'allowed_values', 'l_linenumber', 'allowed_values'
FROM lineitem WHERE l_linenumber IS NOT NULL AND l_linenumber NOT IN (1, 2, 3)
"""

# name, rows on which the rule fails, rows that break it
_FAILING = [
    ("price_per_line", "l_linenumber = 1", "NOT (l_extendedprice / (l_linenumber - 1) > 5000)"),
    ("line_price_again", "l_returnflag <> 'N' AND l_linenumber = 1", "l_returnflag <> 'N' AND NOT (l_extendedprice / (l_linenumber - 1) > 9000)"),
    ("step_of_line", "l_linenumber > 3", "l_linenumber = 3"),
    ("flag_is_a_number", "l_linestatus = 'O'", "FALSE"),
    ("key_fits", "l_orderkey > 1073", "NOT (l_orderkey > 0)"),
]


def _runtime_errors() -> str:
    parts = []
    for name, fails, breaks in _FAILING:
        for kind, where, text in (("rule_error", fails, f"business_rule: {name} could not be evaluated"),
                                  ("business_rule", f"NOT ({fails}) AND ({breaks})", f"business_rule: {name} failed")):
            parts.append(f"SELECT {LINE_KEYS}, {lit(kind)} AS kind, NULL::varchar AS \"column\", {lit(name)} AS rule, {lit(text)} AS violation "
                         f"FROM lineitem WHERE {where}")
    return "\nUNION ALL\n".join(parts)


def _error_counts() -> str:
    parts = [f"SELECT {lit(name)} AS rule, 'ok' AS status, count(*) FILTER (WHERE NOT ({fails}) AND ({breaks})) AS violations, "
             f"count(*) FILTER (WHERE {fails}) AS errors FROM lineitem" for name, fails, breaks in _FAILING]
    return "\nUNION ALL\n".join([*parts, "SELECT 'no_such', 'skipped', 0, 0"])


NULL_KEYS = f"""WITH {FEED}
SELECT order_key, 'unique' AS kind, 'record_id' AS "column", 'unique' AS rule,
       'record_id: duplicate record_id found across files' AS violation
FROM (SELECT *, count(*) OVER (PARTITION BY trim(record_id)) AS n FROM feed) WHERE n > 1 AND record_id IS NOT NULL
"""

STRICT_SCALE = f"""WITH {FEED}
SELECT order_key, 'type' AS kind, 'amount' AS "column", 'strict_scale' AS rule,
       'amount: ''' || amount || ''' has more decimals than decimal(18,1)' AS violation
FROM feed WHERE try_cast(amount AS DECIMAL(38,18)) <> try_cast(amount AS DECIMAL(18,1))
"""

_FEED_NAMES = ["order_key", "record_id", "event_ts", "business_date", "source_system", "status", "amount", "country_code", "source_file"]
_ORDER_NAMES = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
DRIFT = ("SELECT * FROM (VALUES " + ", ".join([f"({lit(c)}, 'missing')" for c in _FEED_NAMES] + [f"({lit(c)}, 'unexpected')" for c in _ORDER_NAMES])
         + ") t(\"column\", drift)")

HEADER_ORDER = f"""WITH {FEED}
SELECT CAST(order_key AS VARCHAR) AS order_key, record_id, event_ts, business_date,
       CASE WHEN order_year = 1997 THEN status ELSE source_system END AS source_system,
       CASE WHEN order_year = 1997 THEN source_system ELSE status END AS status,
       CASE WHEN order_year = 1997 THEN NULL ELSE amount END AS amount, country_code, source_file,
       CASE WHEN order_year = 1997 THEN amount END AS amt
FROM feed
"""

MIXED_SEPARATORS = """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CASE WHEN p_size % 3 = 0 THEN p_brand || '|x' ELSE p_brand END AS p_brand,
       CAST(p_size AS VARCHAR) AS p_size, FALSE AS _malformed
FROM part
"""

QUOTED_RECORDS = """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey,
       CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || chr(10) || 'second, line' || chr(10) || p_brand
            WHEN p_partkey % 5 = 0 THEN 'said "' || p_name || '";' || chr(10) || 'end' ELSE p_name END AS p_name,
       CAST(p_size AS VARCHAR) AS p_size, FALSE AS _malformed
FROM part
"""

SEPARATOR_BY_EVIDENCE = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN replace(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
            WHEN c_custkey % 5 = 0 THEN c_custkey || ';x|y' ELSE '0.5' END AS balance,
       CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 2 = 1 AND c_custkey % 3 = 0 THEN 'a,b;' || c_mktsegment ELSE c_mktsegment END AS segment,
       c_custkey % 2 = 0 AS _delimiter_issue, FALSE AS _malformed
FROM customer
"""

HEADER_LIKE = """
SELECT CAST(c_custkey AS VARCHAR) AS "ID",
       CASE WHEN c_custkey % 5 = 0 THEN 'segment' WHEN c_custkey % 7 = 0 THEN 'name' ELSE c_name END AS name,
       CASE WHEN c_custkey % 5 = 0 THEN 'name' WHEN c_custkey % 3 = 0 THEN 'segment' ELSE c_mktsegment END AS segment
FROM customer
"""

MALFORMED = f"""WITH {FEED}
SELECT CAST(order_key AS VARCHAR) AS order_key, 'malformed' AS kind, NULL::varchar AS "column", 'malformed' AS rule,
       'row: wrong number of fields or unclosed quote' AS violation
FROM feed WHERE order_key % 29 = 0
"""


DELIMITER_REPAIR = (f"WITH {FEED}\nSELECT {TEXT_COLS}, order_key % 7 IN (3, 5) AS _delimiter_issue, "
                    "order_key % 29 = 0 AS _malformed FROM feed")

LINEAGE = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS file_date,
       TRUE AS named_by_writer
FROM orders
"""

DATE_RANGE = (f"WITH {FEED}\nSELECT CAST(order_key AS VARCHAR) AS order_key, record_id, "
              "make_date(CAST(order_year AS INTEGER), 1, 1) AS file_date FROM feed "
              "WHERE order_year BETWEEN 1996 AND 1997")

HEADER_DRIFT = """
SELECT DISTINCT make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS file_date,
       CAST(1 AS BIGINT) AS min_header_lines, CAST(1 AS BIGINT) AS max_header_lines,
       CASE WHEN year(o_orderdate) = 1997 THEN 'amount' ELSE '' END AS missing,
       CASE WHEN year(o_orderdate) = 1997 THEN 'amt' ELSE '' END AS unexpected,
       year(o_orderdate) = 1997 AS reordered
FROM orders
"""


CATALOG_ROWS = [
    # position, kind, column, rule, detail, status
    (1, "required", "record_id", "required", None, "ok"),
    (2, "required", "event_ts", "required", None, "ok"),
    (3, "required", "business_date", "required", None, "ok"),
    (4, "required", "source_system", "required", None, "ok"),
    (5, "required", "status", "required", None, "ok"),
    (6, "required", "amount", "required", None, "ok"),
    (7, "required", "country_code", "required", None, "ok"),
    (8, "allowed_values", "source_system", "allowed_values", PRIORITY_LIST, "ok"),
    (9, "allowed_values", "status", "allowed_values", STATUS_LIST, "ok"),
    (10, "type", "event_ts", "type:timestamp", "timestamp", "ok"),
    (11, "type", "business_date", "type:date", "date", "ok"),
    (12, "type", "amount", "type:decimal(18,2)", "decimal(18,2)", "ok"),
    (13, "regex", "country_code", "regex", "^[A-Z]{2}$", "ok"),
    (14, "range", "amount", "min_value", "0", "ok"),
    (15, "business_rule", None, "final_amount_positive", "upper(trim(status)) = 'F' => amount > 0", "ok"),
    (16, "business_rule", None, "event_ts_near_business_date",
     "abs(datediff(to_date(event_ts), business_date)) <= 7", "ok"),
    (17, "business_rule", None, "business_date_not_far_future", "business_date <= date_add(as_of, 1)", "ok"),
    (18, "business_rule", None, "uses_unknown_column", "no_such_column > 0", "skipped"),
    (19, "unique", "record_id", "unique", "dataset", "ok"),
]


def _catalog() -> str:
    def cell(x):
        return "NULL::varchar" if x is None else (str(x) if isinstance(x, int) else lit(x))
    values = ",\n  ".join("(" + ", ".join(cell(x) for x in row) + ")" for row in CATALOG_ROWS)
    return (feed_checked(ALL_FEED_RULES)
            + ",\nhits AS (SELECT r.v.kind AS kind, r.v.column AS col, r.v.rule AS rule, count(*) AS n "
            "FROM (SELECT unnest(vs) AS v FROM checked) r GROUP BY ALL),\n"
            f"cat(position, kind, \"column\", rule, detail, status) AS (VALUES\n  {values})\n"
            "SELECT CAST(cat.position AS INTEGER) AS position, cat.kind, cat.\"column\", cat.rule, cat.detail, "
            "cat.status, CAST(coalesce(hits.n, 0) AS BIGINT) AS violations\n"
            "FROM cat LEFT JOIN hits ON cat.kind = hits.kind AND cat.\"column\" IS NOT DISTINCT FROM hits.col "
            "AND cat.rule = hits.rule")


SUMMARY_LEVELS = feed_checked(ALL_FEED_RULES) + """,
exploded AS (
  SELECT source_file, business_date, len(vs) = 0 AS is_valid, i = 1 AS one, vs[i].kind AS kind, vs[i].column AS "column", vs[i].rule AS rule
  FROM (SELECT *, unnest(generate_series(1, greatest(len(vs), 1))) AS i FROM checked)),
grouped AS (
  SELECT grouping(source_file) AS g1, grouping(business_date) AS g2, grouping(kind) AS g3, source_file, business_date, kind, "column", rule,
         count(*) FILTER (WHERE one) AS n, count(*) FILTER (WHERE one AND is_valid) AS ok, count(*) FILTER (WHERE kind IS NOT NULL) AS violations
  FROM exploded
  GROUP BY GROUPING SETS ((), (source_file), (business_date), (kind, "column", rule), (source_file, kind, "column", rule), (business_date, kind, "column", rule)))
SELECT concat_ws(',', CASE WHEN g1 = 0 THEN 'source_file' END, CASE WHEN g2 = 0 THEN 'business_date' END, CASE WHEN g3 = 0 THEN 'kind,column,rule' END) AS level,
       source_file, business_date, kind, "column", rule, CASE WHEN g3 = 1 THEN n END AS "rows", CASE WHEN g3 = 1 THEN ok END AS valid_rows, violations
FROM grouped WHERE g3 = 1 OR kind IS NOT NULL
"""

CONTENT_DRIFT = f"""WITH {FEED},
long AS (
  SELECT 'amount' AS "column", 'missing' AS drift, amount AS value FROM feed
  UNION ALL SELECT 'source_system', 'missing', source_system FROM feed
  UNION ALL SELECT 'country_code', 'missing', country_code FROM feed
  UNION ALL SELECT 'total', 'unexpected', amount FROM feed
  UNION ALL SELECT 'origin', 'unexpected', lower(source_system) FROM feed
  UNION ALL SELECT 'region', 'unexpected', country_code FROM feed
  UNION ALL SELECT 'batch', 'unexpected', CAST(order_key % 7 AS VARCHAR) FROM feed),
profile AS (SELECT "column", drift, count(*) AS "rows", count(value) AS non_null, count(DISTINCT value) AS "distinct" FROM long GROUP BY ALL),
vals AS (SELECT DISTINCT "column" AS c, drift, value FROM long WHERE value IS NOT NULL),
pairs AS (
  SELECT m.c AS m, u.c AS u, count(*) / (any_value(pm."distinct") + any_value(pu."distinct") - count(*)) AS similarity
  FROM vals m JOIN vals u ON m.value = u.value AND m.drift = 'missing' AND u.drift = 'unexpected'
  JOIN profile pm ON pm."column" = m.c JOIN profile pu ON pu."column" = u.c GROUP BY m.c, u.c),
best AS (
  SELECT * FROM pairs WHERE similarity >= 0.5
  QUALIFY row_number() OVER (PARTITION BY m ORDER BY similarity DESC, u) = 1 AND row_number() OVER (PARTITION BY u ORDER BY similarity DESC, m) = 1)
SELECT p.*, coalesce(a.u, b.m) AS renamed, coalesce(a.similarity, b.similarity) AS similarity
FROM profile p LEFT JOIN best a ON a.m = p."column" LEFT JOIN best b ON b.u = p."column"
"""


def oracle_sql() -> dict[str, str]:
    return {
        "rule_required": feed_report(R_REQ),
        "rule_allowed_values": feed_report(R_ALLOWED),
        "rule_type_timestamp": feed_report([R_TYPE_TS]),
        "rule_type_date": feed_report([R_TYPE_DATE]),
        "rule_type_decimal": feed_report([R_TYPE_DEC]),
        "rule_regex": feed_report([R_REGEX]),
        "rule_min": feed_report([R_MIN]),
        "rule_positive_when_status": feed_report([R_FINAL]),
        "rule_ts_near_date": feed_report([R_NEAR]),
        "rule_not_future": feed_report([R_FUTURE]),
        "rule_assert": LINEITEM_ASSERT,
        "rule_conditional_assert": EVENTS_CONDITIONAL,
        "rule_regex_urls": PAGES_REGEX,
        "rule_customer": CUSTOMER_RULES,
        "rule_max": PART_MAX,
        "rules_labels": LABELS_RULES,
        "rules_conversations": CONVERSATIONS_RULES,
        "unique_dataset": feed_report([R_DUP]),
        "unique_dataset_window": feed_report([R_DUP]),
        "unique_dataset_skew": feed_report([R_DUP]),
        "unique_within_file": feed_report([R_DUP_FILE]),
        "unique_composite": LINEITEM_UNIQUE,
        "unique_hot_keys": LINEITEM_HOT,
        "unique_text_hashed": DOCUMENTS_UNIQUE,
        "verdict": feed_verdict(ALL_FEED_RULES),
        "report": _report_indexed(ALL_FEED_RULES),
        "summary_by_rule": _summary_rule(ALL_FEED_RULES),
        "summary_by_file": _summary_file(ALL_FEED_RULES),
        "stage_counts": _stage_counts(ALL_FEED_RULES),
        "silver": _silver(False),
        "silver_typed": _silver(True),
        "quarantine": _quarantine(),
        "delimiter_repair": DELIMITER_REPAIR,
        "lineage": LINEAGE,
        "date_range": DATE_RANGE,
        "backfill_dynamic": _backfill(True),
        "backfill_static": _backfill(False),
        "header_drift": HEADER_DRIFT,
        "rule_catalog": _catalog(),
        "unique_multi_key": _line_unique("l_orderkey, l_linenumber", "l_partkey, l_suppkey", "l_extendedprice", "l_returnflag, l_linestatus"),
        "null_keys_ignore": NULL_KEYS,
        "rule_allowed_typed": ALLOWED_TYPED,
        "strict_scale": STRICT_SCALE,
        "drift": DRIFT,
        "backfill_late_rows": _backfill(True, late=True),
        "report_csv": _report_csv(),
        "backfill_keys": _backfill_keys(),
        "rule_runtime_errors": _runtime_errors(),
        "rule_error_counts": _error_counts(),
        "content_drift": CONTENT_DRIFT,
        "ingest_separator_by_evidence": SEPARATOR_BY_EVIDENCE,
        "ingest_quoted_records": QUOTED_RECORDS,
        "summary_levels": SUMMARY_LEVELS,
        "stream_keys": (feed_checked(ALL_FEED_RULES)
                        + "\nSELECT order_key, array_to_string(list_transform(vs, lambda x: x.message), '|') AS rejection_reasons FROM checked"),
        "run_metrics": _run_metrics(),
        "ingest_time": "SELECT count(*) AS lines, CAST(1 AS BIGINT) AS times FROM orders",
        "ingest_header_order": HEADER_ORDER,
        "ingest_mixed_separators": MIXED_SEPARATORS,
        "ingest_header_like_rows": HEADER_LIKE,
        "reject_malformed": MALFORMED,
        "stream_verdict": (feed_checked([r for r in ALL_FEED_RULES if r is not R_DUP])
                           + "\nSELECT order_key, array_to_string(list_transform(vs, lambda x: x.message), '|') "
                           "AS rejection_reasons FROM checked"),
    }
