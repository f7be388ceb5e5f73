"""DuckDB SQL computing the same result as each query in ``catalog.py``.

Tables are the driver's views (``orders``, ``events`` ...).  Rounding uses
``round_even`` on the scaled double (Spark: ``rint``); money sums run on
decimals so neither engine depends on addition order.
"""

from __future__ import annotations

from .catalog import (ASOF_PRIORITY, ASOF_REGION, ASOF_STATUS, ASOF_YEAR_DAYS, DOCS_PER_REPORT, EVENT_RULES, FALLBACK_PRIORITY,
                      FALLBACK_STATUS, PART_FOOTER, PART_RULES, RECORDS_PER_ENVELOPE, RUN_DATE, SECTION_FOOTER_WORD, SECTION_PHRASES,
                      SINGLE_FACET_OFFSET, SINGLE_FACET_ROWS, SINGLE_FACET_STATUS, TWO_REGIONS,
                      part_cells_sql, part_report_sql)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_EVENT_RULES_VALUES = ", ".join(
    f"({p}, {_q(t)}, {_q(c)}, {_q(s)}, {_q(tf)})" for p, t, c, s, tf in EVENT_RULES)
_EVENT_COLS = ",\n  ".join(f"max(v) FILTER (WHERE col = {_q(c)}) AS {c}" for _, _, c, _, _ in EVENT_RULES)

RULE_PIVOT = f"""
WITH rules(position, event_type, col, src, tf) AS (VALUES {_EVENT_RULES_VALUES}),
ev AS (
  SELECT CAST(e.ts AS DATE) AS day, r.col, e.event_id, r.tf,
         CASE WHEN r.src = 'value' THEN e.value
              ELSE CAST(json_extract_string(e.props, '$.k') AS DOUBLE) END AS raw
  FROM events e JOIN rules r ON e.event_type = r.event_type),
v AS (
  SELECT day, col, event_id,
         CASE WHEN tf = 'reciprocal' THEN (CASE WHEN raw <> 0 THEN 1.0 / raw ELSE raw END)
              ELSE raw END AS v
  FROM ev),
last AS (
  SELECT day, col, v FROM (
    SELECT *, row_number() OVER (PARTITION BY day, col ORDER BY event_id DESC) AS rn FROM v)
  WHERE rn = 1)
SELECT day,
  {_EVENT_COLS}
FROM last GROUP BY day
"""

STAMPED_PIVOT = f"""
SELECT DATE '{RUN_DATE}' AS as_of, '{RUN_DATE.replace("-", "")}_' || strftime(day, '%Y%m%d') AS run_key,
       CAST(DATE '{RUN_DATE}' - day AS INTEGER) AS age_days, p.*
FROM ({RULE_PIVOT}) p WHERE day < DATE '{RUN_DATE}'
"""

ASOF_YEAR = f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_date FROM orders),
u AS (SELECT DISTINCT o_custkey, o_date FROM o WHERE o_orderpriority = {_q(ASOF_PRIORITY)} AND isodow(o_date) <= 5),
f AS (SELECT o.o_orderkey, max(u.o_date) AS found_date
      FROM o JOIN u ON u.o_custkey = o.o_custkey AND u.o_date <= o.o_date AND o.o_date - u.o_date < {ASOF_YEAR_DAYS}
      GROUP BY 1)
SELECT o.o_orderkey, o.o_custkey, o.o_date, found_date, CAST(o.o_date - found_date AS INTEGER) AS "offset"
FROM o LEFT JOIN f USING (o_orderkey)
"""

_PHRASE_VALUES = ", ".join(f"({i}, {_q(p)})" for i, p in enumerate(SECTION_PHRASES))

SECTION_EXTRACT = f"""
WITH phrases(position, phrase) AS (VALUES {_PHRASE_VALUES}),
split AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_no,
         unnest(parts) AS line
  FROM split),
heads AS (
  SELECT l.doc_id, p.phrase, min(l.line_no) AS header_line
  FROM lines l JOIN phrases p ON contains(l.line, p.phrase)
  GROUP BY l.doc_id, p.phrase),
bounds AS (
  SELECT h.doc_id, h.phrase, h.header_line, min(l.line_no) AS footer_line
  FROM heads h JOIN lines l
    ON l.doc_id = h.doc_id AND l.line_no > h.header_line
   AND contains(l.line, {_q(SECTION_FOOTER_WORD)})
  GROUP BY h.doc_id, h.phrase, h.header_line)
SELECT b.doc_id, b.phrase, l.line_no, l.line
FROM bounds b JOIN lines l
  ON l.doc_id = b.doc_id AND l.line_no > b.header_line AND l.line_no < b.footer_line
"""

SECTION_EXTRACT_SPLIT = SECTION_EXTRACT.replace(
    "FROM documents", f"""FROM (
  SELECT CAST(floor(doc_id / {DOCS_PER_REPORT}) AS BIGINT) AS doc_id,
         string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id, text) || chr(10) AS text
  FROM documents WHERE doc_id IS NOT NULL GROUP BY 1)""").replace("SELECT b.doc_id,", "SELECT b.doc_id AS report,")

SECTION_STATUS = f"""
WITH phrases(position, phrase) AS (VALUES {_PHRASE_VALUES}),
split AS (SELECT doc_id, string_split_regex(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_no,
         unnest(parts) AS line
  FROM split),
heads AS (
  SELECT l.doc_id, p.phrase, min(l.line_no) AS header_line
  FROM lines l JOIN phrases p ON contains(l.line, p.phrase)
  GROUP BY l.doc_id, p.phrase),
bounds AS (
  SELECT h.doc_id, h.phrase, min(l.line_no) AS footer_line
  FROM heads h JOIN lines l
    ON l.doc_id = h.doc_id AND l.line_no > h.header_line
   AND contains(l.line, {_q(SECTION_FOOTER_WORD)})
  GROUP BY h.doc_id, h.phrase)
SELECT d.doc_id, p.phrase, h.header_line, b.footer_line, b.footer_line IS NOT NULL AS found
FROM documents d CROSS JOIN phrases p
LEFT JOIN heads h ON h.doc_id = d.doc_id AND h.phrase = p.phrase
LEFT JOIN bounds b ON b.doc_id = d.doc_id AND b.phrase = p.phrase
"""

RAGGED_PAD = r"""
WITH t AS (
  SELECT p_partkey,
         string_split_regex(regexp_replace(
           concat_ws(' ', p_name, p_brand, p_type, repeat(p_brand || ' ', 3 + p_size % 6)),
           '^\s+|\s+$', '', 'g'), '\s+') AS t
  FROM part),
p AS (
  SELECT p_partkey, t,
    CASE len(t)
      WHEN 8 THEN list_concat(t[1:7], [''], t[8:8], ['', ''])
      WHEN 9 THEN list_concat(t[1:7], [''], t[8:8], [''], t[9:9])
      WHEN 10 THEN list_concat(t[1:8], [''], t[9:10])
      ELSE t END AS padded
  FROM t)
SELECT p_partkey,
  CAST(len(t) AS INTEGER) AS n_tokens,
  padded[1] AS mth_strike, padded[2] AS daily_open, padded[3] AS daily_high,
  padded[4] AS daily_low, padded[5] AS daily_last, padded[6] AS sett,
  array_to_string(padded, ',') AS padded_csv,
  len(t) NOT IN (8, 9, 10, 11) AS is_irregular
FROM p
"""


def _num_default(expr: str) -> str:
    m = f"regexp_extract({expr}, '[-+]?(\\d+\\.?\\d*|\\.\\d+)', 0)"
    m = f"regexp_replace({m}, '^([-+]?)\\.', '\\10.')"
    return f"TRY_CAST(NULLIF({m}, '') AS DOUBLE)"


def _num_parity(expr: str) -> str:
    s = f"regexp_replace({expr}, '^\\.', '0.')"
    return f"TRY_CAST(NULLIF(regexp_extract({s}, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE)"


_SHAPES = {
    "brand": "p_brand",
    "name": "p_name",
    "dot": "'.' || CAST(p_size AS VARCHAR)",
    "neg": "'-' || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey AS VARCHAR)",
    "negdot": "'-.' || CAST(p_size AS VARCHAR)",
    "suffix": "CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey AS VARCHAR) || 'A'",
}

CLEAN_NUMERIC = "SELECT p_partkey,\n  " + ",\n  ".join(
    f"{_num_default(e)} AS {n}_default, {_num_parity(e)} AS {n}_parity"
    for n, e in _SHAPES.items()) + "\nFROM part"

_CUSTOMER_SHAPES = {
    "name": "c_name",
    "segment": "c_mktsegment",
    "dotkey": "'.' || CAST(c_custkey AS VARCHAR)",
    "negmix": "'-' || CAST(c_nationkey AS VARCHAR) || '.' || CAST(c_custkey AS VARCHAR)",
    "plus": "'+' || CAST(c_nationkey AS VARCHAR) || 'x' || CAST(c_custkey AS VARCHAR)",
}

CLEAN_NUMERIC_CUSTOMER = "SELECT c_custkey,\n  " + ",\n  ".join(
    f"{_num_default(e)} AS {n}_default, {_num_parity(e)} AS {n}_parity"
    for n, e in _CUSTOMER_SHAPES.items()) + "\nFROM customer"

JSON_UNWRAP = """
SELECT event_id,
  CAST(ts AS DATE) AS period,
  'U' || CAST(user_id AS VARCHAR) AS duoarea,
  event_type AS area_name,
  value,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
"""

_ENVELOPE_STATUS = """CASE WHEN envelope % 13 = 1 THEN 'empty' WHEN envelope % 7 = 3 THEN 'unreadable'
       WHEN envelope % 11 = 5 THEN 'no_data' ELSE 'ok' END"""
_ENVELOPE = f"CAST(floor(event_id / {RECORDS_PER_ENVELOPE}) AS BIGINT)"

ENVELOPE_AUDIT = f"""
SELECT envelope, {_ENVELOPE_STATUS} AS status,
       CAST(CASE WHEN {_ENVELOPE_STATUS} = 'ok' THEN n ELSE 0 END AS BIGINT) AS n_records
FROM (SELECT {_ENVELOPE} AS envelope, count(*) AS n FROM events GROUP BY 1)
"""

ENVELOPE_RECORDS = f"""
SELECT envelope, event_id, event_type AS area_name, value
FROM (SELECT {_ENVELOPE} AS envelope, * FROM events) WHERE {_ENVELOPE_STATUS} = 'ok'
"""

FACET_TOPN = """
SELECT o_orderstatus, o_orderkey, o_orderdate, o_totalprice, rn FROM (
  SELECT o_orderstatus, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_orderstatus
                                 ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC)
              AS INTEGER) AS rn
  FROM orders)
WHERE rn <= 12
"""

FIRST_PER_GROUP = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
"""

DEDUP_LAST = """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1
"""

CONCAT_TAGGED = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'customer' AS tag FROM customer
UNION ALL
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS mktsegment, 'supplier' AS tag FROM supplier
"""


def _monthly(grain_cols: str, grain_select: str, region_filter: str) -> str:
    return f"""
geo AS (
  SELECT n.n_nationkey, n.n_regionkey, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey {region_filter}),
ordered AS (
  SELECT date_trunc('month', CAST(o.o_orderdate AS DATE)) AS month, {grain_select},
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS output_value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY ALL),
shipped AS (
  SELECT date_trunc('month', CAST(l.l_shipdate AS DATE)) AS month, {grain_select},
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))
                  * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS input_value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY ALL),
util AS (
  SELECT CAST(a.month AS DATE) AS month, {", ".join(f"a.{c}" for c in grain_cols.split(", "))},
         a.output_value, b.input_value,
         round_even(b.input_value / a.output_value * 100 * 100, 0) / 100 AS percent_utilization
  FROM ordered a JOIN shipped b
    ON a.month IS NOT DISTINCT FROM b.month
   AND {" AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in grain_cols.split(", "))})"""


RATIO_JOIN = "WITH" + _monthly(
    "nationkey, regionkey",
    "g.n_nationkey AS nationkey, g.n_regionkey AS regionkey", "") + """
SELECT month, nationkey, regionkey, output_value, input_value, percent_utilization FROM util
"""

_TWO = ", ".join(_q(r) for r in TWO_REGIONS)
_TWO_LABELS = [r.replace(" ", "") for r in TWO_REGIONS]

WIDE_TWO_AREAS = "WITH" + _monthly(
    "region", "g.r_name AS region", f"WHERE r.r_name IN ({_TWO})") + """
SELECT month AS "Date",
""" + ",\n".join(
    f"  max(percent_utilization) FILTER (WHERE replace(region, ' ', '') = {_q(lab)}) AS \"{lab}\""
    for lab in _TWO_LABELS) + """
FROM util GROUP BY month
"""

_SPINE = """
bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS {col} FROM bounds)"""

FALLBACK_WEEK = "WITH" + _SPINE.format(col="day") + f""",
fri AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
  FROM orders
  WHERE o_orderstatus = {_q(FALLBACK_STATUS)} AND o_orderpriority = {_q(FALLBACK_PRIORITY)}
    AND isodow(CAST(o_orderdate AS DATE)) = 5
  GROUP BY 1),
cand AS (
  SELECT day, r.rk AS fallback_rank,
         CAST(day - CAST((isodow(day) - 1 + 3) % 7 AS INTEGER) - 7 * r.rk AS DATE) AS friday
  FROM spine, (VALUES (0), (1)) r(rk)),
hit AS (
  SELECT c.day, c.friday, c.fallback_rank, f.n_orders, f.total_price,
         row_number() OVER (PARTITION BY c.day ORDER BY c.fallback_rank) AS pick
  FROM cand c JOIN fri f ON f.d = c.friday)
SELECT day, friday, CAST(fallback_rank AS INTEGER) AS fallback_rank, n_orders, total_price
FROM hit WHERE pick = 1
"""

FALLBACK_WEEK_PARITY = "WITH" + _SPINE.format(col="day") + f""",
fri AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n_orders,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
  FROM orders
  WHERE o_orderstatus = {_q(FALLBACK_STATUS)} AND o_orderpriority = {_q(FALLBACK_PRIORITY)}
    AND isodow(CAST(o_orderdate AS DATE)) = 5
  GROUP BY 1)
SELECT s.day, f.d AS friday, CAST(0 AS INTEGER) AS fallback_rank, f.n_orders, f.total_price
FROM spine s
JOIN fri f ON f.d = CAST(s.day - CAST((isodow(s.day) - 1 + 3) % 7 AS INTEGER) - 7 AS DATE)
"""

ASOF_LOOKBACK = "WITH" + _SPINE.format(col="as_of") + f""",
inv AS (
  SELECT DISTINCT CAST(o.o_orderdate AS DATE) AS report_date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderstatus = {_q(ASOF_STATUS)} AND o.o_orderpriority = {_q(ASOF_PRIORITY)}
    AND c.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = {ASOF_REGION})),
trials AS (
  SELECT s.as_of, t.i,
         t.i + CASE isodow(s.as_of - t.i) WHEN 7 THEN 4 WHEN 6 THEN 2 ELSE 0 END AS ref_off,
         CASE WHEN isodow(s.as_of - t.i) <= 5 THEN t.i END AS corr_off
  FROM spine s, (SELECT CAST(range AS INTEGER) AS i FROM range(0, 7)) t),
corr AS (
  SELECT t.as_of, min(t.corr_off) AS off FROM trials t
  JOIN inv ON inv.report_date = t.as_of - t.corr_off
  GROUP BY t.as_of),
ref AS (
  SELECT t.as_of, arg_min(t.ref_off, t.i) AS off FROM trials t
  JOIN inv ON inv.report_date = t.as_of - t.ref_off
  GROUP BY t.as_of)
SELECT s.as_of,
  CAST(s.as_of - c.off AS DATE) AS corrected_found_date, CAST(c.off AS INTEGER) AS corrected_offset,
  CAST(s.as_of - r.off AS DATE) AS reference_found_date, CAST(r.off AS INTEGER) AS reference_offset
FROM spine s LEFT JOIN corr c ON c.as_of = s.as_of LEFT JOIN ref r ON r.as_of = s.as_of
"""

REPORT_KEY = """
SELECT o_orderkey,
  concat_ws('-', strftime(o_orderdate, '%Y%m%d'), o_orderpriority) AS report_key,
  strftime(o_orderdate, '%Y-%m-%d') AS iso_date,
  replace(o_orderpriority, ' ', '') || '_' || strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') || '.txt'
    AS file_name
FROM orders
"""


def _week_end(d: str) -> str:
    return f"CAST({d} + CAST((4 - (isodow({d}) - 1) + 7) % 7 AS INTEGER) AS DATE)"


_TWO_COLS = ",\n".join(
    f"  max(u.percent_utilization) FILTER (WHERE replace(u.region, ' ', '') = {_q(lab)}) AS \"{lab}\""
    for lab in _TWO_LABELS)

WEEKLY_UTILIZATION = f"""
WITH geo AS (
  SELECT n.n_nationkey, n.n_regionkey, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_name IN ({_TWO})),
ordered AS (
  SELECT {_week_end("CAST(o.o_orderdate AS DATE)")} AS period, g.r_name AS region,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS output_value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY ALL),
shipped AS (
  SELECT {_week_end("CAST(l.l_shipdate AS DATE)")} AS period, g.r_name AS region,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))
                  * (1 - CAST(l.l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS input_value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN geo g ON c.c_nationkey = g.n_nationkey
  GROUP BY ALL),
util AS (
  SELECT a.period, a.region,
         round_even(b.input_value / a.output_value * 100 * 100, 0) / 100 AS percent_utilization
  FROM ordered a JOIN shipped b
    ON a.period IS NOT DISTINCT FROM b.period AND a.region IS NOT DISTINCT FROM b.region),
weeks AS (SELECT DISTINCT period FROM util WHERE region IN ({_TWO})),
{_SPINE.format(col="as_of").strip()},
cand AS (
  SELECT as_of, r.rk,
         CAST(as_of - CAST((isodow(as_of) - 1 + 3) % 7 AS INTEGER) - 7 * r.rk AS DATE) AS d
  FROM spine, (VALUES (0), (1)) r(rk)),
pick AS (
  SELECT as_of, d FROM (
    SELECT c.as_of, c.d, row_number() OVER (PARTITION BY c.as_of ORDER BY c.rk) AS pn
    FROM cand c JOIN weeks w ON w.period = c.d)
  WHERE pn = 1)
SELECT p.as_of, p.d AS "Date",
{_TWO_COLS}
FROM pick p JOIN util u ON u.period = p.d AND u.region IN ({_TWO})
GROUP BY p.as_of, p.d
"""

_PART_RULE_VALUES = ", ".join(
    f"({p}, {_q(ph)}, {_q(c)}, {_q(pr)}, {_q(tf)})" for p, ph, c, pr, tf in PART_RULES)
_PART_COLS = ",\n  ".join(
    f"max(month) FILTER (WHERE col = {_q(c)}) AS {c}_month, max(v) FILTER (WHERE col = {_q(c)}) AS {c}, "
    f"bool_or(irr) FILTER (WHERE col = {_q(c)}) AS {c}_irregular"
    for _, _, c, _, _ in PART_RULES)
_TRIM = "regexp_replace(l.line, '^\\s+|\\s+$', '', 'g')"

REPORT_SETTLEMENT = f"""
WITH rules(position, phrase, col, price, tf) AS (VALUES {_PART_RULE_VALUES}),
split AS (SELECT p_partkey AS doc_id, string_split({part_report_sql()}, chr(10)) AS parts
          FROM (SELECT *, {part_cells_sql()} AS cells FROM part)),
lines AS (
  SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_no,
         unnest(parts) AS line
  FROM split),
heads AS (
  SELECT l.doc_id, p.phrase, min(l.line_no) AS header_line
  FROM lines l JOIN rules p ON contains(l.line, p.phrase)
  GROUP BY l.doc_id, p.phrase),
bounds AS (
  SELECT h.doc_id, h.phrase, h.header_line, min(l.line_no) AS footer_line
  FROM heads h JOIN lines l
    ON l.doc_id = h.doc_id AND l.line_no > h.header_line
   AND contains(l.line, {_q(PART_FOOTER)})
  GROUP BY h.doc_id, h.phrase, h.header_line),
firsts AS (
  SELECT b.doc_id, b.phrase, min(l.line_no) AS first_line
  FROM bounds b JOIN lines l
    ON l.doc_id = b.doc_id AND l.line_no > b.header_line AND l.line_no < b.footer_line
   AND {_TRIM} <> ''
  GROUP BY b.doc_id, b.phrase),
tok AS (
  SELECT f.doc_id, f.phrase, string_split_regex({_TRIM}, '\\s+') AS t
  FROM firsts f JOIN lines l ON l.doc_id = f.doc_id AND l.line_no = f.first_line),
nums AS (
  SELECT doc_id, phrase, t[1] AS month,
         {_num_default("t[6]")} AS sett, {_num_default("t[5]")} AS last,
         len(t) NOT IN (8, 9, 10, 11) AS irr FROM tok),
val AS (
  SELECT n.doc_id, r.col, r.tf, n.month, n.irr,
         CASE WHEN r.price = 'settlement' THEN n.sett ELSE n.last END AS raw
  FROM nums n JOIN rules r ON r.phrase = n.phrase),
v AS (
  SELECT doc_id, col, month, irr,
         CASE WHEN tf = 'reciprocal' THEN (CASE WHEN raw <> 0 THEN 1.0 / raw ELSE raw END)
              ELSE raw END AS v
  FROM val)
SELECT doc_id AS p_partkey,
  {_PART_COLS}
FROM v GROUP BY doc_id
"""

LATEST_PULL_RATIO = f"""
WITH pulls AS (
  SELECT o_orderkey, o_orderkey % 2 AS odd, date_trunc('month', CAST(o_orderdate AS DATE))::DATE AS period,
         CASE WHEN c_nationkey % 6 <> 0 THEN 'N' || c_nationkey END AS duoarea, c_mktsegment AS area_name,
         o_totalprice AS value, CAST(o_orderdate AS DATE) AS pull_date
  FROM orders JOIN customer ON o_custkey = c_custkey),
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY odd, period, duoarea, area_name
                                              ORDER BY pull_date DESC, o_orderkey DESC) AS rn FROM pulls)
  WHERE rn = 1)
SELECT a.period, a.duoarea, a.area_name, a.value AS output_value, b.value AS input_value,
       CASE WHEN a.value <> 0 THEN round_even(b.value / a.value * 100 * 100, 0) / 100 END AS percent_utilization
FROM last a JOIN last b ON a.odd = 1 AND b.odd = 0 AND a.period IS NOT DISTINCT FROM b.period
  AND a.duoarea IS NOT DISTINCT FROM b.duoarea AND a.area_name IS NOT DISTINCT FROM b.area_name
"""

SERIES_QUARANTINE = """
SELECT event_id, CASE WHEN event_id % 10 NOT IN (1, 9) THEN CAST(ts AS DATE) END AS period,
  CASE WHEN event_id % 10 NOT IN (0, 1, 2, 9) THEN value END AS value,
  CASE event_id % 10 WHEN 1 THEN strftime(ts, '%Y-%m-%d') || '|n/a'
       WHEN 9 THEN 'not-a-date' || CASE WHEN value IS NULL THEN '' ELSE '|' || CAST(value AS VARCHAR) END END AS bad_text
FROM events
"""

FACET_SINGLE = f"""
SELECT o_orderstatus, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
FROM orders WHERE o_orderstatus = {_q(SINGLE_FACET_STATUS)}
ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC
LIMIT {SINGLE_FACET_ROWS} OFFSET {SINGLE_FACET_OFFSET}
"""

ORACLE_SQL = {
    "asof_year": ASOF_YEAR,
    "stamped_pivot": STAMPED_PIVOT,
    "rule_pivot": RULE_PIVOT,
    "section_extract": SECTION_EXTRACT,
    "section_extract_lines": SECTION_EXTRACT,
    "section_extract_split": SECTION_EXTRACT_SPLIT,
    "section_status": SECTION_STATUS,
    "ragged_pad": RAGGED_PAD,
    "clean_numeric": CLEAN_NUMERIC,
    "clean_numeric_customer": CLEAN_NUMERIC_CUSTOMER,
    "json_unwrap": JSON_UNWRAP,
    "envelope_audit": ENVELOPE_AUDIT,
    "envelope_records": ENVELOPE_RECORDS,
    "facet_topn": FACET_TOPN,
    "first_per_group": FIRST_PER_GROUP,
    "dedup_last": DEDUP_LAST,
    "concat_tagged": CONCAT_TAGGED,
    "ratio_join": RATIO_JOIN,
    "wide_two_areas": WIDE_TWO_AREAS,
    "fallback_week": FALLBACK_WEEK,
    "fallback_week_parity": FALLBACK_WEEK_PARITY,
    "asof_lookback": ASOF_LOOKBACK,
    "report_key": REPORT_KEY,
    "weekly_utilization": WEEKLY_UTILIZATION,
    "report_settlement": REPORT_SETTLEMENT,
    "report_settlement_lines": REPORT_SETTLEMENT,
    "facet_single": FACET_SINGLE,
    "latest_pull_ratio": LATEST_PULL_RATIO,
    "stored_pull_ratio": LATEST_PULL_RATIO,
    "series_quarantine": SERIES_QUARANTINE,
}
