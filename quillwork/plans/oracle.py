"""The SQL twin of each query, for checking results on the same tables."""

from __future__ import annotations

from quillwork.functions.fixed import (
    ACCESS_LOG_PATTERN,
    PALETTE,
    RGB_TO_XYZ,
    WHITE_XYZ,
)

SPACE = (
    r" \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
PUNCT = r"!-/:-@\[-`{-~"


def _words(table: str, separators: str, word: str) -> str:
    return (
        f"SELECT {word} AS word, count(*) AS count FROM ("
        f"SELECT unnest(string_split_regex(text, '[{separators}]+')) AS w FROM {table}"
        f") WHERE w <> '' GROUP BY 1"
    )


PAGE_VIEWS = """
SELECT strftime(ts, '%Y%m%d-%H') AS hour,
       CASE WHEN event_type = 'error' THEN 'fr' ELSE 'en' END AS language,
       CASE event_type WHEN 'view' THEN 'Main_Page' WHEN 'signup' THEN 'Special:Signup'
            ELSE event_type || '_' || user_id END AS title,
       CAST(floor(value) AS BIGINT) AS views
FROM events
"""
CONTENT = f"""
v AS (SELECT * FROM ({PAGE_VIEWS})
      WHERE language = 'en' AND title <> 'Main_Page' AND NOT starts_with(title, 'Special:'))
"""
TIES = f"""
WITH {CONTENT}
SELECT v.hour, v.title, v.views
FROM v JOIN (SELECT hour, max(views) AS m FROM v GROUP BY hour) b
  ON v.hour = b.hour AND v.views = b.m
"""
ARGMAX = f"""
WITH {CONTENT}
SELECT hour, views, title FROM (
  SELECT *, row_number() OVER (PARTITION BY hour ORDER BY views DESC, title DESC) AS rn FROM v
) WHERE rn = 1
"""

COMMENTS = """
SELECT c_mktsegment AS subreddit, CAST(round(c_acctbal * 100) AS BIGINT) - 440000 AS score,
       c_name AS author FROM customer
"""
RELATIVE = f"""
WITH c AS ({COMMENTS}),
m AS (SELECT subreddit, avg(score) AS mean FROM c GROUP BY 1 HAVING avg(score) > 0)
SELECT round(c.score / m.mean, 6) AS relative_score, c.author
FROM c JOIN m ON c.subreddit = m.subreddit
"""

OBSERVATIONS = """
SELECT (CASE WHEN user_id % 2 = 0 THEN 'CA' ELSE 'US' END) || user_id AS station,
       strftime(ts, '%Y%m%d') AS date, upper(event_type) AS observation,
       CAST(floor(value * 10) AS INT) AS value,
       CASE WHEN CAST(regexp_extract(props, '"k": *(\\d+)', 1) AS INT) >= 95 THEN 'X' END AS qflag
FROM events
"""
RANGES = f"""
o AS (SELECT * FROM ({OBSERVATIONS}) WHERE qflag IS NULL),
r AS (SELECT lo.date, lo.station, (hi.value - lo.value) / 10.0::DOUBLE AS range
      FROM o lo JOIN o hi ON lo.date = hi.date AND lo.station = hi.station
      WHERE lo.observation = 'VIEW' AND hi.observation = 'CLICK')
"""
DAILY_RANGE = f"""
WITH {RANGES}
SELECT r.date, r.station, r.range
FROM r JOIN (SELECT date, max(range) AS m FROM r GROUP BY date) b
  ON r.date = b.date AND r.range = b.m
"""

SERIES = """
s AS (SELECT user_id AS station, CAST(ts AS DATE) AS date,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS tmax
      FROM events GROUP BY 1, 2),
p AS (SELECT t.station, t.date, t.tmax, y.tmax AS yesterday_tmax
      FROM s t JOIN s y ON t.station = y.station AND y.date = t.date - INTERVAL 1 DAY)
"""
LAGGED = f"""
WITH {SERIES}
SELECT station, date, CAST(dayofyear(date) AS INT) AS day_of_yr,
       round(tmax, 6) AS tmax, round(yesterday_tmax, 6) AS yesterday_tmax FROM p
"""

GAPPY = f"""
WITH {SERIES},
g AS (SELECT station, date, CAST(dayofyear(date) AS DOUBLE) AS season_day,
             CAST(station % 60 + 20 AS DOUBLE) AS latitude,
             CAST(station % 120 - 60 AS DOUBLE) AS longitude,
             CASE WHEN station % 13 <> 4 THEN CAST(station * 7 % 900 AS DOUBLE) END AS elevation,
             CASE WHEN (station + day(date)) % 17 <> 3 THEN tmax END AS tmax FROM s)
"""

LOG_LINES = """
SELECT 'user' || user_id || '.example.com - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') ||
       ' -0400] "GET /' || event_type || '/' || event_id || ' HTTP/1.0" 200 ' ||
       CASE WHEN event_type = 'error' THEN '-'
            ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS line
FROM events
"""
PARSED = f"""
q AS (SELECT line, regexp_extract(line, '{ACCESS_LOG_PATTERN}', 1) AS host,
             CAST(regexp_extract(line, '{ACCESS_LOG_PATTERN}', 4) AS BIGINT) AS bytes,
             strptime(regexp_extract(line, '{ACCESS_LOG_PATTERN}', 2), '%d/%b/%Y:%H:%M:%S')
               AS date_time,
             regexp_extract(line, '{ACCESS_LOG_PATTERN}', 3) AS r_path
      FROM ({LOG_LINES}) WHERE regexp_matches(line, '{ACCESS_LOG_PATTERN}'))
"""


def _sums(source: str) -> str:
    return f"""
m AS (SELECT count(*) AS n, CAST(sum(x) AS DOUBLE) AS sum_x, CAST(sum(y) AS DOUBLE) AS sum_y,
             CAST(sum(x * x) AS DOUBLE) AS sum_xx, CAST(sum(y * y) AS DOUBLE) AS sum_yy,
             CAST(sum(x * y) AS DOUBLE) AS sum_xy FROM {source})
SELECT n, sum_x, sum_y, sum_xx, sum_yy, sum_xy,
       round((n * sum_xy - sum_x * sum_y) / (sqrt(n * sum_xx - sum_x * sum_x)
             * sqrt(n * sum_yy - sum_y * sum_y)), 6) AS r,
       round(power((n * sum_xy - sum_x * sum_y) / (sqrt(n * sum_xx - sum_x * sum_x)
             * sqrt(n * sum_yy - sum_y * sum_y)), 2), 6) AS r2
FROM m
"""


FIT = """
SELECT round(regr_slope(value, event_id), 6) AS slope_beta,
       round(regr_intercept(value, event_id), 6) AS intercept_alpha FROM events
"""

CUSTOMERS = """
c AS (SELECT c_custkey AS custid,
             CASE n_regionkey WHEN 1 THEN 'BC' WHEN 2 THEN 'ON' ELSE 'QC' END AS province,
             lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || substring(c_mktsegment, 1, 1)
               || substring(c_name, 16, 3) AS postalcode
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""
AREA = f"""
{CUSTOMERS},
vp AS (SELECT DISTINCT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || 'M' AS vp
       FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1),
a AS (SELECT c.custid, c.province, CASE WHEN vp.vp IS NOT NULL THEN 1 ELSE 0 END AS in_area
      FROM c LEFT JOIN vp ON substring(c.postalcode, 1, 3) = vp.vp)
"""
BOUGHT = """
b AS (SELECT o_custkey AS custid, l_partkey AS amenid,
             CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def _unique(table: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", 'unique {key}' AS \"check\", count(*) AS offenders, "
        f"CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM "
        f"(SELECT {key}, count(*) AS n FROM {table} "
        f"WHERE {' AND '.join(f'{k} IS NOT NULL' for k in key.split(','))} "
        f"GROUP BY {key} HAVING count(*) > 1)"
    )


def _present(table: str, column: str) -> str:
    return (
        f"SELECT '{table}', 'not null {column}', CASE WHEN count(*) > 0 THEN 1 ELSE 0 END, count(*) "
        f"FROM {table} WHERE {column} IS NULL"
    )


def _referenced(table: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT '{table}', '{column} in {parent}.{key}', count(DISTINCT {column}), count(*) "
        f"FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
    )


VISITS = (
    "(SELECT CASE WHEN o_orderkey % 101 <> 7 THEN o_orderkey END AS visit, "
    "CASE WHEN o_orderkey % 53 <> 5 THEN o_custkey END AS custid FROM orders) AS visits"
)
DQ = " UNION ALL ".join([
    _unique("customer", "c_custkey"),
    _present("customer", "c_custkey"),
    _present("customer", "c_name"),
    _referenced("customer", "c_nationkey", "nation", "n_nationkey"),
    _unique("orders", "o_orderkey"),
    _present("orders", "o_orderkey"),
    _referenced("orders", "o_custkey", "customer", "c_custkey"),
    _unique("lineitem", "l_orderkey,l_linenumber"),
    _present("lineitem", "l_orderkey"),
    _present("lineitem", "l_linenumber"),
    _present("lineitem", "l_shipdate"),
    _referenced("lineitem", "l_orderkey", "orders", "o_orderkey"),
    _referenced("lineitem", "l_partkey", "part", "p_partkey"),
    _referenced("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    _unique("nation", "n_nationkey"),
    _present("nation", "n_nationkey"),
    _referenced("nation", "n_regionkey", "region", "r_regionkey"),
    _unique("documents", "doc_id"),
    _present("documents", "doc_id"),
    _present("documents", "text"),
    _referenced("documents", "doc_id", "labels", "doc_id"),
    _unique("visits", "visit").replace("FROM visits", f"FROM {VISITS}"),
    _present("visits", "visit").replace("FROM visits", f"FROM {VISITS}"),
    _referenced("visits", "custid", "customer", "c_custkey").replace("FROM visits", f"FROM {VISITS}"),
])

PATHS = """
WITH RECURSIVE e AS (
  SELECT DISTINCT 'c' || o_custkey AS src, 'p' || l_partkey AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem
  UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
  UNION SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer
),
walk AS (
  SELECT 'c0' AS node, 0 AS d
  UNION
  SELECT e.dst, w.d + 1 FROM walk w JOIN e ON w.node = e.src WHERE w.d < 6
),
near AS (SELECT node, min(d) AS distance FROM walk GROUP BY node),
best AS (
  SELECT n.node, min(p.node) AS parent, n.distance
  FROM near n LEFT JOIN e ON e.dst = n.node AND n.distance > 0
  LEFT JOIN near p ON p.node = e.src AND p.distance = n.distance - 1
  WHERE n.distance = 0 OR p.node IS NOT NULL
  GROUP BY n.node, n.distance
)
"""

COLOURS_RAW = """
SELECT p_partkey, CAST(p_partkey * 37 % 256 AS INT) AS R, CAST(p_partkey * 101 % 256 AS INT) AS G,
       CAST(p_partkey * 197 % 251 AS INT) AS B FROM part
"""
PALETTE_ROWS = ", ".join(f"('{w}', {r}, {g}, {b})" for w, r, g, b in PALETTE)
COLOURS = f"""
raw AS ({COLOURS_RAW}),
pal(word, pr, pg, pb) AS (VALUES {PALETTE_ROWS}),
col AS (
  SELECT p_partkey, R, G, B, word FROM (
    SELECT raw.*, pal.word, row_number() OVER (PARTITION BY p_partkey ORDER BY
      (R - pr) * (R - pr) + (G - pg) * (G - pg) + (B - pb) * (B - pb), pal.word) AS rn
    FROM raw, pal) WHERE rn = 1)
"""


def _linear(c: str) -> str:
    u = f"({c} / 255.0::DOUBLE)"
    return (
        f"CASE WHEN {u} > 0.04045 THEN power(({u} + 0.055::DOUBLE) / 1.055::DOUBLE, 2.4::DOUBLE) "
        f"ELSE {u} / 12.92::DOUBLE END"
    )


def _response(c: str) -> str:
    return (
        f"CASE WHEN {c} > 0.008856 THEN power({c}, 1.0::DOUBLE / 3.0::DOUBLE) "
        f"ELSE {c} * 7.787::DOUBLE + 16.0::DOUBLE / 116.0::DOUBLE END"
    )


def _over_white(i: int) -> str:
    r, g, b = RGB_TO_XYZ[i]
    return f"(r * {r}::DOUBLE + g * {g}::DOUBLE + b * {b}::DOUBLE) / {WHITE_XYZ[i]}::DOUBLE"


LAB = f"""
WITH {COLOURS},
lin AS (SELECT *, {_linear('R')} AS lr, {_linear('G')} AS lg, {_linear('B')} AS lb FROM col),
xyz AS (SELECT p_partkey, {_over_white(0)} AS x, {_over_white(1)} AS y, {_over_white(2)} AS z
        FROM (SELECT p_partkey, lr AS r, lg AS g, lb AS b FROM lin)),
f AS (SELECT p_partkey, {_response('x')} AS fx, {_response('y')} AS fy, {_response('z')} AS fz
      FROM xyz)
SELECT col.p_partkey, R, G, B, word, round(fy * 116 - 16, 6) AS labL,
       round((fx - fy) * 500, 6) AS labA, round((fy - fz) * 200, 6) AS labB
FROM col JOIN f ON col.p_partkey = f.p_partkey
"""
HSV = f"""
WITH {COLOURS},
u AS (SELECT *, R / 255.0::DOUBLE AS r1, G / 255.0::DOUBLE AS g1, B / 255.0::DOUBLE AS b1 FROM col),
d AS (SELECT *, greatest(r1, g1, b1) AS mx, greatest(r1, g1, b1) - least(r1, g1, b1) AS dl FROM u),
h AS (SELECT *, CASE WHEN dl = 0 THEN 0 WHEN r1 = mx THEN (g1 - b1) / dl
                     WHEN g1 = mx THEN (b1 - r1) / dl + 2
                     ELSE (r1 - g1) / dl + 4 END AS hh FROM d)
SELECT p_partkey, R, G, B, word, round((hh + CASE WHEN hh < 0 THEN 6 ELSE 0 END) / 6, 6) AS H,
       round(CASE WHEN dl = 0 THEN 0 ELSE dl / mx END, 6) AS S, round(mx, 6) AS V
FROM h
"""


def _inverse() -> list[list[float]]:
    import numpy as np

    return np.linalg.inv(np.array(RGB_TO_XYZ)).tolist()


def _back(c: str) -> str:
    return (
        f"CASE WHEN {c} * {c} * {c} > 0.008856 THEN {c} * {c} * {c} "
        f"ELSE ({c} - 16.0::DOUBLE / 116.0::DOUBLE) / 7.787::DOUBLE END"
    )


def _shown(i: int, name: str) -> str:
    x, y, z = _inverse()[i]
    linear = f"(x * ({x!r})::DOUBLE + y * ({y!r})::DOUBLE + z * ({z!r})::DOUBLE)"
    curve = (
        f"CASE WHEN {linear} > 0.04045::DOUBLE / 12.92::DOUBLE "
        f"THEN power({linear}, 1.0::DOUBLE / 2.4::DOUBLE) * 1.055::DOUBLE - 0.055::DOUBLE "
        f"ELSE {linear} * 12.92::DOUBLE END"
    )
    return f"round(least(greatest({curve}, 0), 1) * 255, 4) AS {name}"


RGB_BACK = f"""
WITH pts AS (SELECT p_partkey, CAST(p_partkey % 101 AS DOUBLE) AS labL,
                    CAST(p_partkey * 13 % 201 - 100 AS DOUBLE) AS labA,
                    CAST(p_partkey * 29 % 201 - 100 AS DOUBLE) AS labB FROM part),
f0 AS (SELECT *, (labL + 16) / 116 AS fy FROM pts),
f AS (SELECT *, labA / 500 + fy AS fx, greatest(fy - labB / 200, 0) AS fz FROM f0),
xyz AS (SELECT p_partkey, labL, labA, labB, ({_back('fx')}) * {WHITE_XYZ[0]}::DOUBLE AS x,
               ({_back('fy')}) * {WHITE_XYZ[1]}::DOUBLE AS y,
               ({_back('fz')}) * {WHITE_XYZ[2]}::DOUBLE AS z FROM f)
SELECT p_partkey, labL, labA, labB, {_shown(0, 'R')}, {_shown(1, 'G')}, {_shown(2, 'B')} FROM xyz
"""

MOMENTS = (
    "SELECT count(*) AS n, CAST(sum(event_id) AS DOUBLE) AS sum_x, "
    "round(sum(value), 1) AS sum_y, CAST(sum(event_id * event_id) AS DOUBLE) AS sum_xx, "
    "round(sum(value * value), 1) AS sum_yy, round(sum(event_id * value), 1) AS sum_xy FROM events"
)
MAXIMA = (
    f"SELECT station, date, value / 10.0::DOUBLE AS tmax FROM ({OBSERVATIONS}) "
    "WHERE qflag IS NULL AND starts_with(station, 'CA') AND observation = 'CLICK'"
)
STORES = (
    "WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS st, "
    "sum(o_totalprice) AS t FROM orders GROUP BY 1, 2) SELECT a.date, round(a.t, 2) AS urgent, "
    "round(b.t, 2) AS low FROM s a JOIN s b ON a.date = b.date "
    "WHERE a.st = '1-URGENT' AND b.st = '5-LOW'"
)
FIVE_DAYS = (
    "SELECT CAST(o_orderdate AS DATE) AS pdate, "
    "round(avg(CAST(o_totalprice AS DECIMAL(12,2))), 4) AS avg FROM orders "
    "WHERE date_part('month', o_orderdate) = 8 AND date_part('day', o_orderdate) IN (1, 2, 3, 4, 5) "
    "GROUP BY 1"
)

ORACLE: dict[str, str] = {
    "word_count": _words("documents", PUNCT + SPACE, "lower(w)"),
    "word_count_plain": _words("documents", SPACE, "w"),
    "word_count_lines": "SELECT word || ' ' || count AS value FROM ("
    + _words("conversations", PUNCT + SPACE, "lower(w)") + ")",
    "max_per_key": f"WITH {CONTENT} SELECT hour, max(views) AS views FROM v GROUP BY hour",
    "argmax_per_key": ARGMAX,
    "argmax_per_key_window": ARGMAX,
    "argmax_ties": TIES,
    "argmax_ties_window": TIES,
    "filename_hour": "SELECT strftime(ts, '%Y%m%d-%H') AS hour, count(*) AS rows, "
    "max(value) AS value FROM events GROUP BY 1",
    "json_ledger": "SELECT CASE event_id % 20 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'blank line' "
    "WHEN 2 THEN 'not an object' WHEN 3 THEN 'wrong type' WHEN 4 THEN 'no event_id' ELSE 'kept' END "
    "AS outcome, count(*) AS rows FROM events GROUP BY 1",
    "page_view_ledger": "SELECT CASE event_id % 10 WHEN 0 THEN 'number of fields' WHEN 1 THEN "
    "'wrong type' ELSE 'kept' END AS outcome, count(*) AS rows, CAST(sum(CASE WHEN event_id % 10 > 1 "
    "THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS views FROM events GROUP BY 1",
    "text_files_word_count": _words("documents", SPACE, "w"),
    "gzip_comment_means": f"SELECT subreddit, round(avg(score), 6) AS mean FROM ({COMMENTS}) GROUP BY 1",
    "csv_maxima": MAXIMA,
    "tab_separated_maxima": f"WITH {CONTENT} SELECT hour, max(views) AS views FROM v GROUP BY hour",
    "json_array_means": "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1",
    "sign_directories": "SELECT CASE WHEN c_acctbal > 0 THEN 'positive' ELSE 'negative' END AS sign, "
    "c_mktsegment, count(*) AS rows FROM customer WHERE contains(c_mktsegment, 'E') GROUP BY 1, 2",
    "store_comparison_files": STORES,
    "adjacency_degrees": "SELECT 'p' || l_partkey AS dst, count(*) AS edges, "
    "count(DISTINCT l_orderkey) AS sources FROM lineitem GROUP BY 1",
    "warehouse_tables": f"WITH {CUSTOMERS} SELECT province, count(*) AS purchases, "
    "round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT) % 9000000) AS DOUBLE) / 100, 2) AS amount "
    "FROM orders JOIN c ON o_custkey = custid GROUP BY 1",
    "saved_model_scores": f"WITH {SERIES} SELECT count(*) AS rows, 0 AS differ FROM p",
    "model_as_columns": f"WITH {SERIES} SELECT count(*) AS rows, 0 AS differ FROM p",
    "five_day_external": FIVE_DAYS,
    "holiday_external": "SELECT CAST(o_orderdate AS DATE) AS pdate, count(*) AS purchases, "
    "round(avg(CAST(o_totalprice AS DECIMAL(12,2))), 4) AS avg FROM orders "
    "WHERE strftime(o_orderdate, '%m-%d') = '12-25' GROUP BY 1",
    "clustered_range": "SELECT l_returnflag, count(*) AS rows, CAST(sum(CAST(round(l_extendedprice * 100) "
    "AS BIGINT)) AS BIGINT) AS cents FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-04-01' "
    "AND l_shipdate < TIMESTAMP '1996-07-01' GROUP BY 1",
    "published_table": "SELECT o_orderstatus, o_orderpriority, count(*) AS rows, "
    "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1, 2",
    "batched_inserts": "SELECT o_orderstatus, count(*) AS rows, count(DISTINCT o_orderkey) AS keys, "
    "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1",
    "ordered_segments": "SELECT *, row_number() OVER (ORDER BY cents DESC, c_mktsegment, c_nationkey) "
    "AS position FROM (SELECT c_mktsegment, c_nationkey, count(*) AS customers, "
    "CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS cents FROM customer GROUP BY 1, 2)",
    "ordered_days": "SELECT *, row_number() OVER (ORDER BY CASE WHEN dayofweek(day) IN (0, 6) THEN 0 "
    "WHEN strftime(day, '%m-%d') = '12-25' THEN 0 ELSE 1 END, month(day), orders DESC, day) AS position "
    "FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)",
    "stream_restart": MOMENTS,
    "area_view_permanent": f"WITH {AREA} SELECT custid, in_area FROM a",
    "group_mean": "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1",
    "json_group_mean": "SELECT event_type, round(avg(CAST(regexp_extract(props, '\"k\": *(\\d+)', 1) "
    "AS INT)), 6) AS mean FROM events GROUP BY 1",
    "filter_split": "SELECT c_mktsegment, c_acctbal, c_name, CASE WHEN c_acctbal > 0 THEN 'positive' "
    "ELSE 'negative' END AS sign FROM customer WHERE contains(c_mktsegment, 'E')",
    "relative_score": RELATIVE,
    "relative_score_broadcast": RELATIVE,
    "relative_score_top": RELATIVE + " ORDER BY relative_score DESC, author LIMIT 10",
    "tmax_etl": MAXIMA,
    "daily_range": DAILY_RANGE,
    "daily_range_sql": DAILY_RANGE,
    "station_ranges": f"WITH {RANGES} SELECT r.date, r.station, r.range, count(*) AS pairs "
    "FROM r JOIN (SELECT date, station, max(range) AS m FROM r GROUP BY 1, 2) b "
    "ON r.date = b.date AND r.station = b.station AND r.range = b.m GROUP BY 1, 2, 3",
    "lagged_feature": LAGGED,
    "lagged_feature_window": LAGGED,
    "store_comparison": STORES,
    "calendar_features": "SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS store, "
    "o_totalprice AS sales, round(o_totalprice / nullif(o_custkey % 7, 0), 6) AS sales_per_staff, "
    "strftime(o_orderdate, '%m-%d') IN ('01-01', '12-25') AS is_holiday, "
    "dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders",
    "parse_log": f"WITH {PARSED} SELECT host, sha256(line) AS id, bytes, date_time, r_path FROM q",
    "log_quality": f"SELECT count(*) FILTER (WHERE regexp_matches(line, '{ACCESS_LOG_PATTERN}')) AS "
    f"accepted, count(*) FILTER (WHERE NOT regexp_matches(line, '{ACCESS_LOG_PATTERN}')) AS rejected "
    f"FROM ({LOG_LINES})",
    "log_host_correlation": f"WITH {PARSED}, h AS (SELECT CAST(count(*) AS HUGEINT) AS x, "
    "sum(bytes) AS y FROM q GROUP BY host)," + _sums("h"),
    "host_correlation": "SELECT count(*) AS n, round(corr(x, y), 6) AS r, "
    "round(corr(x, y) * corr(x, y), 6) AS r2 FROM "
    "(SELECT count(*) AS x, sum(value) AS y FROM events GROUP BY user_id)",
    "moments": "WITH p AS (SELECT CAST(event_id AS HUGEINT) AS x, "
    "CAST(round(value * 100) AS HUGEINT) AS y FROM events)," + _sums("p"),
    "linear_fit": FIT,
    "stream_regression": FIT,
    "stream_moments": MOMENTS,
    "star_avg_by_method": f"WITH {CUSTOMERS} SELECT o_orderpriority AS payment_method, "
    "round(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) "
    "AS average_amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN c ON o_custkey = c.custid WHERE province = 'ON' GROUP BY 1",
    "area_view": f"WITH {AREA} SELECT custid, in_area FROM a",
    "segment_three_way": f"WITH {AREA}, {BOUGHT} "
    "SELECT in_area = 0 AND province = 'BC' AS from_province_only, in_area = 1 AS from_area, "
    "count(*) AS count, round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS average, "
    "round(median(CAST(amount AS DOUBLE)), 6) AS median "
    "FROM b JOIN a ON b.custid = a.custid GROUP BY 1, 2",
    "ilike_semi": f"WITH {AREA}, {BOUGHT} SELECT in_area, "
    "round(CAST(sum(amount) AS DOUBLE) / count(*), 6) AS avg FROM b JOIN a ON b.custid = a.custid "
    "WHERE amenid IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY' "
    "AND CASE WHEN p_brand <> 'Brand#1' THEN p_name END ILIKE '%RING%') GROUP BY 1",
    "five_day_avg": FIVE_DAYS,
    "dq_checks": DQ,
    "dq_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem "
    "GROUP BY 1, 2 HAVING count(*) > 1",
    "shortest_paths": PATHS + "SELECT node, parent, distance FROM best",
    "shortest_path_rounds": PATHS + ", its AS (SELECT unnest(range(0, (SELECT max(distance) FROM near))) "
    "AS iter) SELECT CAST(iter AS INT) AS iter, distance, count(*) AS nodes FROM best JOIN its "
    "ON distance <= iter + 1 GROUP BY 1, 2",
    "shortest_path_route": PATHS + ", back AS (SELECT node, parent, distance FROM best "
    "WHERE node = 'c1' UNION ALL SELECT b.node, b.parent, b.distance FROM best b JOIN back k "
    "ON b.node = k.parent) SELECT distance AS step, node FROM back",
    "rgb_to_lab": LAB,
    "rgb_to_hsv": HSV,
    "rgb_to_lab_sql": LAB,
    "rgb_to_hsv_sql": HSV,
    "lab_to_rgb": RGB_BACK,
    "colour_palette": f"WITH {COLOURS} SELECT col.word, count(*) AS rows, pr AS showR, pg AS showG, "
    "pb AS showB FROM col JOIN pal ON col.word = pal.word GROUP BY ALL",
    "label_index": "SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) "
    "AS label, p_type FROM part GROUP BY p_type",
    "hash_split": "SELECT CASE WHEN (c_custkey % 2147483648) * 2654435761 % 100 < 75 THEN 'train' "
    "ELSE 'validation' END AS part, c_mktsegment, count(*) AS rows FROM customer GROUP BY 1, 2",
    "vector_assembly": GAPPY + "SELECT station, date, season_day AS v0, latitude AS v1, longitude AS v2, "
    "elevation AS v3, round(tmax, 6) AS v4 FROM g WHERE elevation IS NOT NULL AND tmax IS NOT NULL",
    "model_row_counts": GAPPY + "SELECT CASE WHEN elevation IS NULL THEN 'no elevation' "
    "WHEN tmax IS NULL THEN 'no tmax' ELSE 'kept' END AS outcome, count(*) AS rows FROM g GROUP BY 1",
    "log_ids": f"WITH {PARSED} SELECT count(*) AS rows, count(*) AS ids FROM q",
    "regression_metrics": f"WITH {SERIES} SELECT count(*) AS n, "
    "round(sqrt(avg(power(tmax - yesterday_tmax, 2))), 6) AS rmse, "
    "round(1 - avg(power(tmax - yesterday_tmax, 2)) / var_pop(tmax), 6) AS r2 FROM p",
    "classification_accuracy": "SELECT count(*) AS n, round(avg(CASE WHEN quality = 1 - toxic "
    "THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM labels "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL",
}
