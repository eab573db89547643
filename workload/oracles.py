"""The same results as plain SQL for DuckDB, over the same Parquet tables."""

from __future__ import annotations

from quotemill.schemas import MEASURE_DIMS, QUOTE, STAGING, STREAM_RENAMES

CODE = "'U' || lpad(CAST({0} AS VARCHAR), greatest(5, length(CAST({0} AS VARCHAR)))::INT, '0')"
USER = CODE.format("user_id")
CUSTOMER = CODE.format("c_custkey")
NUMBER = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def quoted(names, prefix="") -> str:
    return ", ".join(f'{prefix}"{name}"' for name in names)


QUOTE_NAMES = QUOTE.fieldNames()
STAGING_NAMES = STAGING.fieldNames()
COLUMNS = quoted(QUOTE_NAMES)
STAGING_COLUMNS = quoted(STAGING_NAMES)


def order_by(first, names, direction="ASC") -> str:
    nulls = "NULLS FIRST" if direction == "ASC" else "NULLS LAST"
    lead = [f'"{name}" {direction} {nulls}' for name in first]
    rest = [f'"{name}" ASC NULLS FIRST' for name in names if name not in first]
    return ", ".join([*lead, *rest])


F1 = f"""
quotes_raw AS (
  SELECT {USER} AS code, CAST(ts AS DATE) AS "date",
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "time", event_type AS "floor", 'STOCK' AS "type",
    value AS "basicPrice", value * 1.07 AS "ceilingPrice", value * 0.93 AS "floorPrice",
    value AS "open", value + 1.0 AS "high", value - 1.0 AS "low", value + 0.5 AS "close",
    value AS "average", value / 2 AS "adOpen", (value + 1.0) / 2 AS "adHigh",
    (value - 1.0) / 2 AS "adLow", (value + 0.5) / 2 AS "adClose", value / 2 AS "adAverage",
    {NUMBER} AS "nmVolume", {NUMBER} * value AS "nmValue",
    CAST(0 AS DOUBLE) AS "ptVolume", CAST(0 AS DOUBLE) AS "ptValue",
    CAST(0.5 AS DOUBLE) AS "change", CAST(0.25 AS DOUBLE) AS "adChange",
    CAST(50.0 AS DOUBLE) / nullif(value, 0) AS "pctChange"
  FROM events)"""

F2 = f"""{F1},
quotes_daily AS (
  SELECT {COLUMNS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY code, "date" ORDER BY "time", "basicPrice", "floor", "nmVolume") AS rn
    FROM quotes_raw) WHERE rn = 1)"""

FIRST_DAILY = f"""
first_daily AS (
  SELECT {COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY "date") AS rn FROM quotes_daily)
  WHERE rn = 1)"""


def staging(name: str, source: str, bare_run_date: str | None = None) -> str:
    renamed = {"code", "date", "time"}
    plain = ", ".join(
        f'"{old}" AS "{new}"'
        for old, new in zip(QUOTE_NAMES, STAGING_NAMES)
        if old not in renamed
    )
    if bare_run_date is None:
        update, parts = "CAST(split_part(\"time\", ' ', 1) AS DATE)", '"date"'
    else:
        update = parts = f"DATE '{bare_run_date}'"
    clock = "split_part(\"time\", ' ', 2)"
    return f"""
{name} AS (
  SELECT code, "date" AS stock_date, {clock} AS time_update, {plain},
    strftime("date", '%Y-%m-%d') AS date_string,
    CAST(year("date") AS INT) AS year_col, CAST(month("date") AS INT) AS month_col,
    CAST(day("date") AS INT) AS day_col, {update} AS date_update,
    CAST(year({parts}) AS INT) AS year_update, CAST(month({parts}) AS INT) AS month_update,
    CAST(day({parts}) AS INT) AS day_update,
    CAST(split_part({clock}, ':', 1) AS INT) AS hours_update,
    CAST(split_part({clock}, ':', 2) AS INT) AS minutes_update,
    CAST(split_part({clock}, ':', 3) AS INT) AS seconds_update
  FROM {source})"""


def dates(name: str, source: str, padded: bool = False) -> str:
    parts = ["year_col", "month_col", "day_col", "hours_update", "minutes_update", "seconds_update"]
    texts = [f"CAST({p} AS VARCHAR)" for p in parts]
    if padded:
        texts = [f"lpad({t}, {4 if i == 0 else 2}, '0')" for i, t in enumerate(texts)]
    return f"""
{name} AS (
  SELECT DISTINCT CAST({" || ".join(texts)} AS BIGINT) AS date_id, stock_date,
    year_col AS stock_year, month_col AS stock_month, day_col AS stock_day, date_update,
    year_update, month_update, day_update, time_update, hours_update, minutes_update,
    seconds_update
  FROM {source})"""


def measures(table: str) -> str:
    return ", ".join(f'"{old}" AS "{new}"' for new, old in MEASURE_DIMS[table][1].items())


def measure(name: str, table: str, source: str) -> str:
    key = MEASURE_DIMS[table][0]
    return f"""
{name} AS (
  SELECT CAST(row_number() OVER (ORDER BY stock_date, code) AS BIGINT) AS "{key}",
    code, stock_date, {measures(table)} FROM {source})"""


def dims(source: str, prefix: str = "", padded: bool = False) -> str:
    parts = [dates(f"{prefix}datetime_dim", source, padded)]
    parts += [measure(f"{prefix}{table}", table, source) for table in MEASURE_DIMS]
    return ",".join(parts)


def fact(source: str, prefix: str = "") -> str:
    return f"""
fact_table AS (
  SELECT s.code, dt.date_id AS "dateKey", s."floor", s."typeStock", p.price_id AS "priceKey",
    o."idOHLC" AS "OHLCKey", a.ad_id AS "adKey", v.id_vol_val_dim AS vol_val_key,
    c.change_id AS "changeKey"
  FROM {source} s
  JOIN {prefix}datetime_dim dt ON s.stock_date = dt.stock_date AND s.time_update = dt.time_update
  JOIN {prefix}price_dim p ON s.code = p.code AND s.stock_date = p.stock_date
  JOIN {prefix}OHLC_dim o ON s.code = o.code AND s.stock_date = o.stock_date
  JOIN {prefix}ad_dim a ON s.code = a.code AND s.stock_date = a.stock_date
  JOIN {prefix}vol_val_dim v ON s.code = v.code AND s.stock_date = v.stock_date
  JOIN {prefix}change_dim c ON s.code = c.code AND s.stock_date = c.stock_date)"""


STAGED = f"{F2},{staging('full_data', 'quotes_daily')}"
STAR = f"{STAGED},{dims('full_data')},{fact('full_data')}"
FIRST_STAGED = f"{FIRST_DAILY},{staging('first_data', 'first_daily')}"
SHARDS = f"""
codes AS (SELECT DISTINCT code FROM quotes_raw),
placed AS (
  SELECT code, row_number() OVER (ORDER BY code) - 1 AS pos, (SELECT count(*) FROM codes) AS n
  FROM codes),
shards AS (
  SELECT code, CAST(CASE WHEN n < 3 THEN 2 ELSE least(pos // (n // 3), 2) END AS INT) AS shard
  FROM placed)"""


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def page(size: int, number: int) -> str:
    low, high = size * (number - 1), size * number
    return select(F1, f"""
SELECT {COLUMNS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY code ORDER BY {order_by(["date"], QUOTE_NAMES)}) AS rn
  FROM quotes_raw) WHERE rn > {low} AND rn <= {high}""")


def first(direction: str) -> str:
    return select(F1, f"""
SELECT {COLUMNS} FROM (
  SELECT *, row_number() OVER (
    PARTITION BY code ORDER BY {order_by(["date"], QUOTE_NAMES, direction)}) AS rn
  FROM quotes_raw) WHERE rn = 1""")


def numbered(name: str, source: str, start: str = "0") -> str:
    return f"""
{name} AS (
  SELECT CAST({start} + row_number() OVER (
    ORDER BY {order_by(["date", "code"], QUOTE_NAMES)}) AS BIGINT) AS quote_id, {COLUMNS}
  FROM {source})"""


def fanout() -> str:
    twice = ",".join(
        f"""
twice_{table} AS (
  SELECT * FROM {table} UNION ALL
  SELECT "{key}" + (SELECT max("{key}") FROM {table}), * EXCLUDE ("{key}") FROM {table})"""
        for table, (key, _) in MEASURE_DIMS.items()
    )
    ctes = f"""{STAGED},{dims('full_data')},
twice_datetime_dim AS (SELECT * FROM datetime_dim),{twice},{fact('full_data', 'twice_')}"""
    return select(ctes, "SELECT * FROM fact_table")


def orphans(prefix: str) -> str:
    keys = {
        "dateKey": ("datetime_dim", "date_id"),
        "priceKey": ("price_dim", "price_id"),
        "OHLCKey": ("OHLC_dim", "idOHLC"),
        "adKey": ("ad_dim", "ad_id"),
        "vol_val_key": ("vol_val_dim", "id_vol_val_dim"),
        "changeKey": ("change_dim", "change_id"),
    }
    return " UNION ALL ".join(
        f"""
SELECT '{column}' AS fact_column, "{column}" AS "key", count(*) AS n_rows FROM fact_table f
WHERE "{column}" IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {prefix}{table} d WHERE d."{key}" = f."{column}")
GROUP BY "{column}" """
        for column, (table, key) in keys.items()
    )


def unmatched() -> str:
    parts = []
    for table in ["datetime_dim", *MEASURE_DIMS]:
        on = "time_update" if table == "datetime_dim" else "code"
        parts.append(f"""
SELECT code, stock_date, time_update, '{table}' AS reason FROM full_data s
WHERE NOT EXISTS (
  SELECT 1 FROM first_{table} d WHERE d.stock_date = s.stock_date AND d.{on} = s.{on})""")
    return " UNION ALL ".join(parts)


def readback() -> str:
    own = {
        "stock_date": "dt.stock_date", "time_update": "dt.time_update",
        "date_string": "strftime(dt.stock_date, '%Y-%m-%d')",
        "year_col": "dt.stock_year", "month_col": "dt.stock_month", "day_col": "dt.stock_day",
        "code": "f.code", "floor": 'f."floor"', "typeStock": 'f."typeStock"',
    }
    source = {
        old: f'"{table}"."{new}"'
        for table, (_, names) in MEASURE_DIMS.items()
        for new, old in names.items()
    }
    columns = ", ".join(
        f'{own.get(c) or source.get(c) or f"dt.{c}"} AS "{c}"' for c in STAGING_NAMES
    )
    return f"""
SELECT {columns} FROM fact_table f
JOIN datetime_dim dt ON f."dateKey" = dt.date_id
JOIN price_dim ON f."priceKey" = price_dim.price_id
JOIN OHLC_dim ON f."OHLCKey" = OHLC_dim."idOHLC"
JOIN ad_dim ON f."adKey" = ad_dim.ad_id
JOIN vol_val_dim ON f.vol_val_key = vol_val_dim.id_vol_val_dim
JOIN change_dim ON f."changeKey" = change_dim.change_id"""


ALL_STAGED = select(STAGED, f"SELECT {STAGING_COLUMNS} FROM full_data")
DAILY = select(F2, f"SELECT {COLUMNS} FROM quotes_daily")
RAW = select(F1, f"SELECT {COLUMNS} FROM quotes_raw")
RAW_STAGED = select(
    f"{F1},{staging('full_data', 'quotes_raw')}", f"SELECT {STAGING_COLUMNS} FROM full_data"
)
STREAM_COLUMNS = ", ".join(f'"{c}" AS "{STREAM_RENAMES.get(c, c)}"' for c in QUOTE_NAMES)
NEXT_DAY = ", ".join(
    'CAST("date" + 1 AS DATE) AS "date"' if c == "date" else f'"{c}"' for c in QUOTE_NAMES
)
READABLE = 'CAST("nmVolume" AS INT) % 7 <> 6'
RECORDS = 'CAST("nmVolume" AS INT) % 3'
# A broken number loses that field only in lenient decoding; strict splitting rejects the message.
REJECTED = "\"floor\" IN ('error', 'signup')"


def measure_query(table: str) -> str:
    return select(f"{STAGED},{measure('d', table, 'full_data')}", "SELECT * FROM d")


LISTED = f"""
SELECT {CUSTOMER} AS "Stock_Code",
  CAST(row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR))) - 1 AS BIGINT) AS "position" FROM customer"""

ORACLES: dict[str, str] = {
    "envelope_explode": select(F1, f"""
SELECT {COLUMNS} FROM quotes_raw WHERE {READABLE} AND {RECORDS} >= 1
UNION ALL
SELECT {NEXT_DAY} FROM quotes_raw WHERE {READABLE} AND {RECORDS} = 2"""),
    "response_status": select(F1, f"""
SELECT code, status, count(*) AS n_responses, CAST(sum(n) AS BIGINT) AS n_records FROM (
  SELECT code, CASE WHEN {READABLE} THEN {RECORDS} END AS n,
    CASE WHEN NOT ({READABLE}) THEN 'failed' WHEN {RECORDS} = 0 THEN 'empty'
         WHEN {RECORDS} = 1 THEN 'single' ELSE 'multi' END AS status
  FROM quotes_raw) GROUP BY code, status"""),
    "symbol_scan": f'SELECT {CUSTOMER} AS "Stock_Code" FROM customer',
    "html_rows": """
SELECT page_id, CAST(pos AS INT) AS pos, matches[pos] AS href FROM (
  SELECT page_id, matches, unnest(range(1, len(matches) + 1)) AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">', 1) AS matches
    FROM pages))""",
    "table_rows": f"""
SELECT c_custkey AS page_id, CAST(3 AS INT) AS pos, {CUSTOMER} AS "Stock_Code",
  c_name AS "Name_Company",
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS "Industry",
  CASE WHEN c_acctbal >= 0 THEN 'EX' || CAST(c_nationkey AS VARCHAR) END AS "Exchange",
  CASE WHEN c_acctbal >= 0 THEN CAST(c_custkey AS VARCHAR) END AS "KLCPNY"
FROM customer""",
    "nested_table_rows": """
WITH orders_of AS (
  SELECT l_orderkey AS page_id, count(*) AS n,
    string_agg(CAST(l_linenumber AS VARCHAR) || ' ' || l_linestatus || ' ' || l_returnflag, ' '
      ORDER BY l_linenumber, l_suppkey, l_linestatus, l_returnflag) AS lines
  FROM lineitem GROUP BY l_orderkey)
SELECT page_id, CAST(1 AS INT) AS table_no, CAST(1 AS INT) AS pos, CAST(page_id AS VARCHAR) AS name,
  'lines ' || lines || ' end' AS content, 'last' AS flag FROM orders_of
UNION ALL SELECT page_id, 1, 2, 'total', CAST(n AS VARCHAR), NULL FROM orders_of""",
    "inner_table_rows": """
WITH line AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_linestatus, l_returnflag) AS INT) AS nth
  FROM lineitem)
SELECT l_orderkey AS page_id, CAST(1 AS INT) AS table_no, nth AS pos, CAST(l_linenumber AS VARCHAR) AS name,
  l_linestatus AS content, l_returnflag AS flag, CAST(2 AS INT) AS depth FROM line
UNION ALL SELECT l_orderkey, nth, 1, l_linestatus, NULL, NULL, 3 FROM line""",
    "company_records": """
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier""",
    "company_records_inferred": """
SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS nation FROM supplier""",
    "csv_roundtrip": DAILY,
    "directory_scan": DAILY,
    "directory_scan_new": select(f"{F2},{SHARDS}", f"""
SELECT {quoted(QUOTE_NAMES, "q.")} FROM quotes_daily q JOIN shards s ON q.code = s.code
WHERE s.shard = 2 OR s.shard = 1 AND q."floor" <> 'error'"""),
    "bulk_load_positional": ALL_STAGED,
    "blank_staging": RAW_STAGED,
    "sql_query": select(STAR, """
SELECT d.stock_month, d.stock_day, f."floor", count(*) AS n_quotes,
  min(o.low_col) AS lowest, max(o.high_col) AS highest, max(v."nmVolumne") AS top_volume
FROM fact_table f
JOIN datetime_dim d ON f."dateKey" = d.date_id
JOIN OHLC_dim o ON f."OHLCKey" = o."idOHLC"
JOIN vol_val_dim v ON f.vol_val_key = v.id_vol_val_dim
GROUP BY d.stock_month, d.stock_day, f."floor" """),
    "sql_query_named": select(STAGED, """
SELECT code AS symbol, max(high_col) AS top, min(low_col) AS bottom, count(*) AS days
FROM full_data GROUP BY code"""),
    "distinct_on_date": select(F1, f"""
SELECT DISTINCT {COLUMNS} FROM quotes_raw WHERE "date" = DATE '2024-01-15'"""),
    "price_range": select(F1, f"""
SELECT {COLUMNS} FROM quotes_raw
WHERE "date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND code IN (SELECT {CUSTOMER} FROM customer WHERE c_mktsegment = 'BUILDING')"""),
    "price_page": page(9990, 1),
    "price_page_small": page(70, 1),
    "price_page_second": page(30, 2),
    "first_record": first("ASC"),
    "first_record_latest": first("DESC"),
    "symbol_count": "SELECT count(*) AS n_symbols FROM customer",
    "position_slice": f"""
SELECT "Stock_Code", "position" FROM (
  SELECT code AS "Stock_Code", CAST(row_number() OVER (ORDER BY code) - 1 AS BIGINT) AS "position"
  FROM (SELECT {CUSTOMER} AS code FROM customer))
WHERE "position" >= 25 AND "position" < 75""",
    "symbol_shards": f"""
SELECT "Stock_Code", "position",
  CAST(CASE WHEN n < 3 THEN 2 ELSE least("position" // (n // 3), 2) END AS INT) AS shard
FROM (
  SELECT code AS "Stock_Code", CAST(row_number() OVER (ORDER BY code) - 1 AS BIGINT) AS "position",
    count(*) OVER () AS n
  FROM (SELECT {CUSTOMER} AS code FROM customer))""",
    "position_slice_listed": f"""
SELECT * FROM ({LISTED}) WHERE "position" >= 25 AND "position" < 75""",
    "symbol_shards_listed": f"""
SELECT "Stock_Code", "position",
  CAST(CASE WHEN n < 3 THEN 2 ELSE least("position" // (n // 3), 2) END AS INT) AS shard
FROM (SELECT *, count(*) OVER () AS n FROM ({LISTED}))""",
    "missing_codes": f"""
SELECT {CUSTOMER} AS "Stock_Code" FROM customer
WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""",
    "union_by_name": select(f"{F2},{SHARDS}", f"""
SELECT {", ".join('CASE WHEN shard < 2 THEN q."ptValue" END AS "ptValue"' if c == "ptValue"
                  else f'q."{c}"' for c in QUOTE_NAMES)}, s.shard
FROM quotes_daily q JOIN shards s ON q.code = s.code"""),
    "publish_complete": select(f"{F2},{SHARDS}", f"""
SELECT {quoted(QUOTE_NAMES, "q.")}, s.shard
FROM quotes_daily q JOIN shards s ON q.code = s.code"""),
    "publish_incomplete": select(f"{F2},{SHARDS}", f"""
SELECT {quoted(QUOTE_NAMES, "q.")}, s.shard
FROM quotes_daily q JOIN shards s ON q.code = s.code
WHERE s.shard <> 2
  AND (SELECT count(DISTINCT shard) FROM shards WHERE shard <> 2) = 3"""),
    "transform_quotes": RAW_STAGED,
    "transform_quotes_bare_time": select(
        f"{F1},{staging('full_data', 'quotes_raw', '2024-02-01')}",
        f"SELECT {STAGING_COLUMNS} FROM full_data",
    ),
    "datetime_dim": select(
        f"{STAGED},{dates('datetime_dim', 'full_data')}", "SELECT * FROM datetime_dim"
    ),
    "datetime_dim_padded": select(
        f"{F1},{staging('full_data', 'quotes_raw')},{dates('datetime_dim', 'full_data', True)}",
        "SELECT * FROM datetime_dim",
    ),
    "price_dim": measure_query("price_dim"),
    "ohlc_dim": measure_query("OHLC_dim"),
    "ad_dim": measure_query("ad_dim"),
    "vol_val_dim": measure_query("vol_val_dim"),
    "change_dim": measure_query("change_dim"),
    "assign_keys": select(f"{F1},{numbered('n', 'quotes_raw')}", "SELECT * FROM n"),
    "assign_keys_continue": select(
        f"""{F1},
first_raw AS (
  SELECT {COLUMNS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY code ORDER BY {order_by(["date"], QUOTE_NAMES)}) AS rn
    FROM quotes_raw) WHERE rn = 1),{numbered('a', 'first_raw')},
{numbered('b', 'quotes_raw', '(SELECT count(*) FROM first_raw)')}""",
        "SELECT * FROM a UNION ALL SELECT * FROM b",
    ),
    "dim_append_new": select(
        f"{STAGED},{FIRST_STAGED}",
        f"""
SELECT CAST((SELECT count(*) FROM first_data) + row_number() OVER (ORDER BY stock_date, code)
  AS BIGINT) AS price_id, code, stock_date, {measures("price_dim")}
FROM full_data s WHERE NOT EXISTS (
  SELECT 1 FROM first_data d WHERE d.code = s.code AND d.stock_date = s.stock_date)""",
    ),
    "fact_table": select(STAR, "SELECT * FROM fact_table"),
    "fact_reload_fanout": fanout(),
    "star_readback": select(
        f"{STAGED},{dims('full_data', padded=True)},{fact('full_data')}", readback()
    ),
    "daily_load": select(
        f"{F2},{FIRST_STAGED},{dims('first_data')},{fact('first_data')}",
        "SELECT * FROM fact_table",
    ),
    "daily_reload_corrected": select(f"""{F2},
first_load AS (
  SELECT *, row_number() OVER (ORDER BY "date", code) AS k FROM quotes_daily
  WHERE NOT ("date" BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND "floor" = 'signup')
), again AS (
  SELECT * REPLACE (
    CASE WHEN "floor" IN ('click', 'view') THEN substr("time", 1, 11) || '23:59:59' ELSE "time" END AS "time",
    "basicPrice" + CASE WHEN "floor" IN ('purchase', 'view') THEN 1 ELSE 0 END AS "basicPrice",
    "close" + CASE WHEN "floor" IN ('purchase', 'view') THEN 1 ELSE 0 END AS "close")
  FROM quotes_daily WHERE "date" BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND "floor" <> 'error'
), keyed AS (
  SELECT a.*, coalesce(f.k, (SELECT count(*) FROM first_load)
    + row_number() OVER (PARTITION BY f.k IS NULL ORDER BY a."date", a.code)) AS k
  FROM again a LEFT JOIN first_load f ON f.code = a.code AND f."date" = a."date"
), stored AS (
  SELECT * FROM first_load WHERE NOT ("date" BETWEEN DATE '2024-01-10' AND DATE '2024-01-20')
  UNION ALL BY NAME SELECT * FROM keyed
)""", """
SELECT code, CAST(strftime("date", '%Y%m%d') || replace(split_part("time", ' ', 2), ':', '') AS BIGINT) AS "dateKey",
  "floor", "type" AS "typeStock", CAST(k AS BIGINT) AS "priceKey", CAST(k AS BIGINT) AS "OHLCKey",
  CAST(k AS BIGINT) AS "adKey", CAST(k AS BIGINT) AS vol_val_key, CAST(k AS BIGINT) AS "changeKey",
  "date" AS stock_date, "basicPrice", "close" AS close_col, split_part("time", ' ', 2) AS time_update,
  CAST(0 AS BIGINT) AS n_orphans
FROM stored"""),
    "assign_keys_ledger": select(f"""{STAGED},
loads AS (
  SELECT 1 AS load, * FROM full_data WHERE stock_date <= DATE '2024-01-12'
  UNION ALL SELECT 2, * FROM full_data WHERE stock_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-20'
  UNION ALL SELECT 3, * FROM full_data WHERE stock_date >= DATE '2024-01-21'
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY load, stock_date, code) AS k FROM loads
)""", f"""
SELECT CAST(k AS BIGINT) AS price_id, code, stock_date, {measures("price_dim")} FROM numbered
WHERE load <> 2 OR stock_date > DATE '2024-01-12'"""),
    "response_rejects": select(F2, f"""
SELECT DISTINCT code AS symbol, CASE WHEN CAST("nmVolume" AS INT) % 7 = 6 THEN 'unreadable' ELSE 'undated' END AS reason,
  CAST(0 AS BIGINT) AS n_published
FROM quotes_daily WHERE (CAST("nmVolume" AS INT) % 7 = 6 OR "date" = DATE '2024-01-01')
  AND code IN (SELECT {CUSTOMER} FROM customer)
UNION ALL
SELECT {CUSTOMER}, 'absent', CAST(0 AS BIGINT) FROM customer WHERE {CUSTOMER} NOT IN (SELECT code FROM quotes_daily)"""),
    "daily_load_all_dates": select(STAR, "SELECT * FROM fact_table"),
    "daily_load_absent_response": select(STAR, "SELECT * FROM fact_table WHERE false"),
    "daily_load_bad_date": select(STAR, "SELECT * FROM fact_table WHERE false"),
    "pk_violations": select(
        f"{STAGED},{dates('datetime_dim', 'full_data')}",
        """
SELECT date_id, count(*) AS n_rows FROM datetime_dim
GROUP BY date_id HAVING count(*) > 1 OR date_id IS NULL""",
    ),
    "date_id_overflow": select(
        f"{STAGED},{dates('datetime_dim', 'full_data')}",
        "SELECT * FROM datetime_dim WHERE date_id > 2147483647",
    ),
    "fk_orphans": select(
        f"{STAR},{FIRST_STAGED},{dims('first_data', 'first_')}", orphans("first_")
    ),
    "fk_orphans_valid": select(STAR, orphans("")),
    "pk_violations_of_load": select(
        f"{STAGED},{dates('datetime_dim', 'full_data')}",
        """
SELECT date_id, CAST(count(*) AS BIGINT) AS n_rows FROM datetime_dim
WHERE date_id IN (SELECT date_id FROM datetime_dim WHERE stock_date > DATE '2024-01-10')
GROUP BY date_id HAVING count(*) > 1""",
    ),
    "fk_orphans_of_load": select(
        f"""{STAGED},{dims('full_data')},
loaded AS (SELECT * FROM full_data WHERE stock_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'),
{fact('loaded').lstrip()},{FIRST_STAGED},{dims('first_data', 'first_')}""",
        orphans("first_"),
    ),
    "unmatched_quotes": select(
        f"{STAGED},{FIRST_STAGED},{dims('first_data', 'first_')}", unmatched()
    ),
    "staging_replace": ALL_STAGED,
    "create_if_absent": measure_query("price_dim"),
    "write_many": select(F2, """
SELECT 'price_dim' AS "table", true AS ok, (SELECT count(*) FROM quotes_daily) AS n_rows
UNION ALL
SELECT 'broken' AS "table", false AS ok, CAST(NULL AS BIGINT) AS n_rows
UNION ALL
SELECT 'change_dim' AS "table", true AS ok, (SELECT count(*) FROM quotes_daily) AS n_rows"""),
    "copy_table": select(F1, """
SELECT code AS symbol, "date" AS trading_day, "close" AS closing FROM quotes_raw"""),
    "json_encode": RAW,
    "backfill": select(F1, f"""
SELECT {COLUMNS} FROM quotes_raw
WHERE "date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND code IN (SELECT {CUSTOMER} FROM customer)"""),
    "backfill_resumed": select(F1, f"""
SELECT {COLUMNS} FROM quotes_raw
WHERE "date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND code IN (SELECT {CUSTOMER} FROM customer)"""),
    "stream_decode": RAW,
    "stream_malformed": select(F1, f"""
SELECT code, "floor" = 'signup' AS bad_number FROM quotes_raw WHERE {REJECTED}"""),
    "stream_readable": select(
        F1, f"SELECT {COLUMNS} FROM quotes_raw WHERE NOT ({REJECTED})"
    ),
    "stream_foreachbatch": select(F1, f"""
SELECT CAST(row_number() OVER (ORDER BY {order_by(["date", "code"], QUOTE_NAMES)}) AS BIGINT)
  AS id, {STREAM_COLUMNS} FROM quotes_raw"""),
    "stream_restart_new_checkpoint": select(F1, f"""
SELECT CAST(r + k * n AS BIGINT) AS id, {STREAM_COLUMNS} FROM (
  SELECT *, row_number() OVER (ORDER BY {order_by(["date", "code"], QUOTE_NAMES)}) AS r, count(*) OVER () AS n
  FROM quotes_raw
) numbered, (VALUES (0), (1)) AS loads(k)"""),
    "stream_two_sinks": select(F1, f"""
SELECT 'table' AS sink, {COLUMNS} FROM quotes_raw
UNION ALL SELECT 'echo' AS sink, {COLUMNS} FROM quotes_raw"""),
    "stream_recreated_checkpoint": select(F1, f"""
SELECT CAST(r + k * n AS BIGINT) AS id, {STREAM_COLUMNS} FROM (
  SELECT *, row_number() OVER (ORDER BY {order_by(["date", "code"], QUOTE_NAMES)}) AS r, count(*) OVER () AS n
  FROM quotes_raw
) numbered, (VALUES (0), (1)) AS loads(k)"""),
    "stream_compacted": select(F1, f"SELECT {STREAM_COLUMNS}, true AS ids_dense FROM quotes_raw"),
    "stream_split_once": select(F1, """
SELECT code, CASE WHEN "floor" NOT IN ('error', 'signup') THEN "basicPrice" END AS "basicPrice",
  CASE "floor" WHEN 'error' THEN 'bad_json' WHEN 'signup' THEN 'bad_field' ELSE 'quote' END AS route
FROM quotes_raw"""),
}
