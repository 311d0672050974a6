"""The same results in plain SQL over the benchmark tables, for comparison."""

from __future__ import annotations

from weirhouse.plans.catalog import AS_OF_MS, HOUR_MS, NEAR_MS, WITHIN_MS

DAY_MS = 24 * HOUR_MS


def _text(ms: str) -> str:
    """Epoch milliseconds as UTC+8 text."""
    return f"strftime(make_timestamp(({ms} + {8 * HOUR_MS}) * 1000), '%Y-%m-%d %H:%M:%S')"


_EVENTS = """
ev AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts, 'm' || user_id AS mid, 'v' || (user_id % 3) AS vc,
         'ch' || (event_id % 4) AS ch, 'ar' || (user_id % 5) AS ar,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
         event_type AS page_id,
         CASE event_type WHEN 'signup' THEN NULL WHEN 'view' THEN '' ELSE 'home' END AS last_page_id,
         CAST(round(value * 100) AS BIGINT) AS during_time,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
  FROM events)"""

# The logs that parse, with the new-visitor flag corrected.
_FIXED = f"""{_EVENTS},
good AS (SELECT * FROM ev WHERE NOT (page_id = 'error' AND k % 2 = 1)),
fixed AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND
             row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) = 1 THEN '1' ELSE '0' END AS is_new)
  FROM good)"""


def _json(*pairs: tuple[str, str]) -> str:
    """SQL text of a JSON object; a null value leaves its key out."""
    cells = ", ".join(f"""'"{k}":' || ({v})""" for k, v in pairs)
    return "'{' || concat_ws(',', " + cells + ") || '}'"


def _quoted(c: str) -> str:
    return f"""'"' || {c} || '"'"""


_COMMON = _json(*[(c, _quoted(c)) for c in ("mid", "vc", "ch", "ar", "is_new")])
_START = '{\\"entry\\":\\"icon\\"}'
_START_LINE = _json(("common", _COMMON), ("start", f"""'"{_START}"'"""), ("ts", "ts"))


def _display(n: int, with_page: bool) -> str:
    page = [("page_id", _quoted("page_id"))] if with_page else []
    return _json(("item", _quoted(f"(k + {n})")), ("order", f"""'"{n}"'"""), *page)


_PAGE_LINE = _json(
    ("common", _COMMON),
    (
        "page",
        _json(
            ("page_id", _quoted("page_id")),
            ("last_page_id", _quoted("last_page_id")),
            ("during_time", "during_time"),
        ),
    ),
    (
        "displays",
        "CASE WHEN page_id = 'click' THEN '[' || " + _display(1, True) + " || ',' || " + _display(2, True) + " || ']' END",
    ),
    ("ts", "ts"),
)


def _visits(source: str, within_ms: int = WITHIN_MS) -> str:
    """CTEs ``uv`` and ``uj`` over the page rows of ``source``."""
    return f"""
uv AS (
  SELECT * FROM {source}
  QUALIFY row_number() OVER (PARTITION BY mid, (ts + {8 * HOUR_MS}) // {DAY_MS} ORDER BY ts, seq) = 1),
nxt AS (
  SELECT *, lead(ts) OVER (PARTITION BY mid ORDER BY ts, seq) AS next_ts,
         lead(coalesce(last_page_id, '') = '') OVER (PARTITION BY mid ORDER BY ts, seq) AS next_entry
  FROM {source}),
uj AS (
  SELECT * FROM nxt
  WHERE coalesce(last_page_id, '') = ''
    AND (next_ts IS NULL OR next_entry OR next_ts - ts >= {within_ms}))"""


def _measures(source: str) -> str:
    dims = "ch, ar, is_new, vc"
    return f"""
measures AS (
  SELECT {dims}, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum, ts FROM uv
  UNION ALL SELECT {dims}, 0, 0, 0, 1, 0, ts FROM uj
  UNION ALL SELECT {dims}, 0, 1, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 0, during_time, ts
  FROM {source})"""


def _sums(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


_ALL_MEASURES = ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")


def _stats(with_ts: bool = True) -> str:
    size = 6 * HOUR_MS
    last = ", max(ts) AS ts" if with_ts else ""
    return f"""
SELECT {_text(f'(ts // {size}) * {size}')} AS stt, {_text(f'(ts // {size} + 1) * {size}')} AS edt,
       vc, ch, ar, is_new, {_sums(*_ALL_MEASURES)}{last}
FROM measures GROUP BY ts // {size}, vc, ch, ar, is_new"""


_PAGE_STATS = f"WITH {_EVENTS}, {_visits('ev')}, {_measures('ev')}"

_ORDER_TEXT = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
_SHIP_TEXT = "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"
_PAID = "(o_orderdate + to_seconds(o_orderkey % 1200))"
_PAID_TEXT = f"strftime({_PAID}, '%Y-%m-%d %H:%M:%S')"

_WIDE_ORDER = f"""
pairs AS (
  SELECT * FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  WHERE epoch_ms(l_shipdate) - epoch_ms(o_orderdate) BETWEEN {-NEAR_MS} AND {NEAR_MS}),
narrow AS (
  SELECT l_orderkey * 10 + l_linenumber AS detail_id, o_orderkey AS order_id, l_partkey AS sku_id,
         l_extendedprice AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
         'sku ' || l_partkey AS sku_name, o_custkey % 25 AS province_id, o_orderstatus AS order_status,
         o_custkey AS user_id, o_totalprice AS total_amount, 0.0::DOUBLE AS activity_reduce_amount,
         NULL::DOUBLE AS coupon_reduce_amount, o_totalprice AS original_total_amount,
         5.0::DOUBLE AS feight_fee, NULL::DOUBLE AS split_feight_fee,
         NULL::DOUBLE AS split_activity_amount, NULL::DOUBLE AS split_coupon_amount,
         l_extendedprice AS split_total_amount, NULL::VARCHAR AS expire_time,
         {_ORDER_TEXT} AS create_time, NULL::VARCHAR AS operate_time,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
  FROM pairs)"""

# birthday midnight in UTC+8
_BORN_MS = f"(epoch_ms(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER)) - {8 * HOUR_MS})"
_AGE = f"CAST(({AS_OF_MS} - {_BORN_MS}) // {365 * DAY_MS} AS BIGINT)"


def _with_dims(facts: str) -> str:
    return f"""
SELECT f.*, pn.n_name AS province_name, CAST(pn.n_regionkey AS VARCHAR) AS province_area_code,
       'CN-' || pn.n_nationkey AS province_iso_code, 'X-' || pn.n_nationkey AS province_3166_2_code,
       {_AGE} AS user_age,
       CASE WHEN c_custkey IS NULL THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS user_gender,
       CAST(p_size AS BIGINT) AS spu_id,
       CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS tm_id, p_partkey % 7 AS category3_id,
       s_name AS spu_name, tn.n_name AS tm_name, r_name AS category3_name
FROM {facts} f
LEFT JOIN customer ON c_custkey = f.user_id
LEFT JOIN nation pn ON pn.n_nationkey = f.province_id
LEFT JOIN part ON p_partkey = f.sku_id
LEFT JOIN supplier ON s_suppkey = p_size
LEFT JOIN nation tn ON tn.n_nationkey = CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT)
LEFT JOIN region ON r_regionkey = p_partkey % 7"""


_PAYMENT_WIDE = f"""
WITH {_WIDE_ORDER}, wide AS ({_with_dims('narrow')})
SELECT o_orderkey + 1000000 AS payment_id, 'order ' || o_orderkey AS subject,
       o_orderpriority AS payment_type, {_PAID_TEXT} AS payment_create_time,
       NULL::VARCHAR AS callback_time,
       wide.* EXCLUDE (expire_time, operate_time, create_date, create_hour, create_time, total_amount),
       round(o_totalprice - 1, 2) AS total_amount, create_time AS order_create_time
FROM orders JOIN wide ON o_orderkey = order_id
WHERE epoch_ms(CAST(create_time AS TIMESTAMP)) - epoch_ms({_PAID}) BETWEEN -900000 AND 5000"""

_GONE = "(o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"
_CHANGES = f"""
changes AS (
  SELECT 'shop' AS database, 'order_info' AS "tableName",
         CASE WHEN {_GONE} THEN 'delete' WHEN o_orderstatus = 'P' THEN 'read'
              WHEN o_orderstatus = 'F' THEN 'update' ELSE 'insert' END AS type,
         CASE WHEN {_GONE} THEN '{{}}' ELSE {_json(
             ('id', _quoted('o_orderkey')), ('status', _quoted('o_orderstatus')), ('user_id', _quoted('o_custkey')))} END AS data,
         CASE WHEN {_GONE} OR o_orderstatus = 'F' THEN {_json(
             ('id', _quoted('o_orderkey')), ('status', "'\"new\"'"))} ELSE '{{}}' END AS before,
         o_orderkey AS seq,
         {_json(('id', _quoted('o_orderkey')), ('status', _quoted('o_orderstatus')))} AS short
  FROM orders
  UNION ALL
  SELECT 'shop', 'user_info', 'insert', {_json(
      ('id', _quoted('c_custkey')), ('name', _quoted('c_name')), ('seg', _quoted('c_mktsegment')))}, '{{}}', c_custkey,
      {_json(('id', _quoted('c_custkey')), ('name', _quoted('c_name')))}
  FROM customer
  UNION ALL
  SELECT 'shop', 'sku_info', 'read', {_json(
      ('id', _quoted('p_partkey')), ('name', _quoted('p_name')))}, '{{}}', p_partkey, NULL FROM part
  UNION ALL
  SELECT 'shop', 'spu_info', 'insert', {_json(
      ('id', _quoted('s_suppkey')), ('name', _quoted('s_name')))}, '{{}}', s_suppkey, NULL FROM supplier)"""

_ROUTE = f"""
WITH {_CHANGES}
SELECT CASE type WHEN 'insert' THEN 'dwd_order_info' ELSE 'dwd_order_update' END AS topic,
       CASE type WHEN 'insert' THEN data ELSE short END AS value
FROM changes WHERE "tableName" = 'order_info' AND type IN ('insert', 'update')"""

def _arrived(together: str = "64", behind: int = 40) -> str:
    """CTE ``judged``: page records in deliveries, with the watermark they met."""
    return f"""
{_EVENTS}, arrived AS (
  SELECT *, CAST(seq // {together} + CASE WHEN k % 7 = 0 THEN k % {behind} ELSE 0 END AS BIGINT) AS step FROM ev
), marked AS (
  SELECT *, max(ts) OVER (ORDER BY step RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {2 * DAY_MS} AS watermark FROM arrived
), judged AS (
  SELECT *, coalesce((ts // {HOUR_MS} + 1) * {HOUR_MS} <= watermark, false) AS late FROM marked
)"""


_LATE_WINDOWS = f"""
SELECT {_text(f'(ts // {HOUR_MS}) * {HOUR_MS}')} AS stt, {_text(f'(ts // {HOUR_MS} + 1) * {HOUR_MS}')} AS edt, ch,
       0::BIGINT AS uv_ct, count(*) AS pv_ct, count(*) FILTER (WHERE last_page_id IS NULL) AS sv_ct,
       0::BIGINT AS uj_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum, max(ts) AS ts
FROM judged WHERE NOT late GROUP BY ts // {HOUR_MS}, ch"""


def _sequence(source: str, steps: tuple[str, ...], within_ms: int) -> str:
    """Starts of strictly consecutive records that meet ``steps``, or wait in vain for the next one."""
    n = len(steps)
    ahead = ", ".join(
        f"lead(ts, {k}) OVER w AS t{k}, " + f"lead({steps[k]}, {k}) OVER w AS m{k}" for k in range(1, n)
    )
    late = [f"(t{k} IS NULL OR t{k} - ts >= {within_ms})" for k in range(1, n)]
    met = [f"m{k}" for k in range(1, n)]
    cases = " ".join(f"WHEN {' AND '.join([*(f'NOT {x}' for x in late[:k]), *met[:k], late[k]])} THEN {k + 1}" for k in range(n - 1))
    whole = " AND ".join([*(f"NOT {x}" for x in late), *met])
    return f"""
SELECT seq, mid, ts, CASE WHEN steps = {n} THEN 'match' ELSE 'timeout' END AS outcome, CAST(steps AS BIGINT) AS steps
FROM (
  SELECT *, CASE WHEN {whole} THEN {n} {cases} END AS steps
  FROM (SELECT *, {ahead}, {steps[0]} AS starts FROM {source} WINDOW w AS (PARTITION BY mid ORDER BY ts, seq))
  WHERE starts
) WHERE steps IS NOT NULL"""


_ENTRY = "(coalesce(last_page_id, '') = '')"

_RULED = f"""
{_EVENTS}, {_CHANGES}, messages AS (
  SELECT seq, page_id = 'error' AS deletes, k,
    ['order_info', 'user_info', 'sku_info', 'spu_info'] AS names, ['insert', 'update', 'read'][seq % 3 + 1] AS operation,
    ['hbase', 'kafka', 'kafka', 'clickhouse', 'kafka'][k % 5 + 1] AS kind,
    ['id,status,name', 'id,user_id,seg'][seq % 2 + 1] AS cols
  FROM ev
), versions AS (
  SELECT names[k % 4 + 1] AS source, operation, seq AS at, deletes AS removed, kind, 'sink_' || seq AS sink, string_split(cols, ',') AS cols
  FROM messages
  UNION ALL
  SELECT names[(k + 1) % 4 + 1], operation, seq, true, NULL, NULL, NULL FROM messages WHERE seq % 11 = 0 AND NOT deletes
), cells AS (
  SELECT 'order_info' AS source, o_orderkey AS seq, 'id' AS name, CAST(o_orderkey AS VARCHAR) AS cell, 1 AS n FROM orders
  UNION ALL SELECT 'order_info', o_orderkey, 'status', o_orderstatus, 2 FROM orders
  UNION ALL SELECT 'order_info', o_orderkey, 'user_id', CAST(o_custkey AS VARCHAR), 3 FROM orders
  UNION ALL SELECT 'user_info', c_custkey, 'id', CAST(c_custkey AS VARCHAR), 1 FROM customer
  UNION ALL SELECT 'user_info', c_custkey, 'name', c_name, 2 FROM customer
  UNION ALL SELECT 'user_info', c_custkey, 'seg', c_mktsegment, 3 FROM customer
  UNION ALL SELECT 'sku_info', p_partkey, 'id', CAST(p_partkey AS VARCHAR), 1 FROM part
  UNION ALL SELECT 'sku_info', p_partkey, 'name', p_name, 2 FROM part
  UNION ALL SELECT 'spu_info', s_suppkey, 'id', CAST(s_suppkey AS VARCHAR), 1 FROM supplier
  UNION ALL SELECT 'spu_info', s_suppkey, 'name', s_name, 2 FROM supplier
), ruled AS (
  SELECT c."tableName", c.type, c.seq, v.kind, v.sink, v.cols, coalesce(v.removed, true) AS none
  FROM (SELECT * FROM changes WHERE data <> '{{}}') c
  ASOF LEFT JOIN versions v ON c."tableName" = v.source AND c.type = v.operation AND c.seq >= v.at
)"""

_DIM_UPSERT = """
SELECT CAST(coalesce(c_custkey, o_custkey) AS VARCHAR) AS id, any_value(c_name) AS name,
       CAST(max(o_orderkey) AS VARCHAR) AS last_order,
       coalesce(max_by(o_orderpriority, o_orderkey) FILTER (WHERE o_orderstatus <> 'F'),
                any_value(c_mktsegment)) AS urgent
FROM customer FULL JOIN orders ON c_custkey = o_custkey
GROUP BY coalesce(c_custkey, o_custkey)"""

_FLAT = ("mid", "page_id", "last_page_id")

ORACLES: dict[str, str] = {
    "page_split": f"""
WITH {_FIXED}
SELECT seq, mid, is_new, page_id, last_page_id, during_time,
       CASE WHEN page_id = 'click' THEN 2::BIGINT ELSE 0::BIGINT END AS shown, ts
FROM fixed WHERE page_id <> 'error'""",
    "start_split": f"""
WITH {_FIXED}
SELECT seq, mid, is_new, '{{"entry":"icon"}}' AS start, ts FROM good WHERE page_id = 'error'""",
    "display_explode": f"""
WITH {_EVENTS}
SELECT seq, CAST(k + n AS VARCHAR) AS item, CAST(n AS VARCHAR) AS "order", page_id
FROM ev, (VALUES (1), (2)) t(n) WHERE page_id = 'click'""",
    "dirty_logs": f"""
WITH {_EVENTS}, lines AS (SELECT k, {_START_LINE} AS line FROM ev WHERE page_id = 'error' AND k % 2 = 1)
SELECT CASE k % 3 WHEN 0 THEN '[' || line || ']' WHEN 1 THEN line || ' tail'
       ELSE substring(line, 1, 20) END AS value
FROM lines""",
    "parse_or_drop": f"WITH {_FIXED} SELECT mid, ts FROM good",
    "parse_strict": f"""
SELECT o_orderkey AS id, o_custkey % 25 AS province_id, o_orderstatus AS order_status, o_custkey AS user_id,
       o_totalprice AS total_amount, 0.0::DOUBLE AS activity_reduce_amount,
       NULL::DOUBLE AS coupon_reduce_amount, o_totalprice AS original_total_amount,
       5.0::DOUBLE AS feight_fee, NULL::VARCHAR AS expire_time, {_ORDER_TEXT} AS create_time,
       NULL::VARCHAR AS operate_time
FROM orders""",
    "new_visitor_fix": f"""
WITH {_EVENTS}
SELECT seq, mid, CASE WHEN is_new = '1' AND row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) = 1
       THEN '1' ELSE '0' END AS is_new, ts
FROM ev""",
    "split_to_topics": f"""
WITH {_FIXED}
SELECT 'dwd_start_log' AS topic, {_START_LINE} AS value FROM fixed WHERE page_id = 'error'
UNION ALL SELECT 'dwd_page_log', {_PAGE_LINE} FROM fixed WHERE page_id <> 'error'
UNION ALL SELECT 'dwd_display_log', {_display(1, True)} FROM fixed WHERE page_id = 'click'
UNION ALL SELECT 'dwd_display_log', {_display(2, True)} FROM fixed WHERE page_id = 'click'""",
    "record_passthrough": f"""
WITH {_EVENTS},
rich AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND
             row_number() OVER (PARTITION BY mid, is_new ORDER BY ts, seq) = 1 THEN '1' ELSE '0' END AS is_new,
           CAST(k AS VARCHAR) AS k, CAST(ts AS VARCHAR) AS ts, CAST(during_time AS VARCHAR) AS during_time),
         k AS n, 'os' || (k % 3) AS os, CAST(k % 7 AS VARCHAR) AS code
  FROM ev)
SELECT 'dwd_start_log' AS topic, mid, is_new, os, k AS uid, ts, 'icon' AS entry, k AS loading, code,
       NULL AS page_item, NULL AS during_time, NULL AS item, NULL AS x, NULL AS shown_on, NULL AS first_x, NULL AS first_on
FROM rich WHERE page_id = 'error'
UNION ALL
SELECT 'dwd_page_log', mid, is_new, os, k, ts, NULL, NULL, code, k, during_time, NULL, NULL, NULL,
       CASE WHEN page_id = 'click' THEN '1' END, CASE WHEN page_id = 'click' THEN page_id END
FROM rich WHERE page_id <> 'error'
UNION ALL
SELECT 'dwd_display_log', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       CAST(n + x AS VARCHAR), CAST(x AS VARCHAR), page_id, NULL, NULL
FROM rich, (VALUES (1), (2)) t(x) WHERE page_id = 'click'""",
    "entry_pages": f"""
WITH {_EVENTS}
SELECT seq, CAST(coalesce(last_page_id, '') = '' AS BIGINT) AS entry,
       CAST(last_page_id IS NULL AS BIGINT) AS session
FROM ev""",
    "unique_visit_day": f"""
WITH {_EVENTS}, {_visits('ev')}
SELECT seq, mid, ts, {_text('ts')} AS at FROM uv""",
    "unique_visit_literal": f"""
WITH {_EVENTS},
dense AS (
  SELECT seq, mid, ts // 3600 AS ts, coalesce(last_page_id, '') = '' AS entry,
         row_number() OVER (PARTITION BY mid ORDER BY ts // 3600, seq) = 1 AS first_ever
  FROM ev),
opened AS (
  SELECT *, max(CAST(entry OR first_ever AS INTEGER)) OVER (
           PARTITION BY mid, ts // 1000 ORDER BY ts, seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM dense)
SELECT seq, mid, ts FROM opened WHERE entry OR coalesce(before, 0) = 0""",
    "unique_visit_literal_ttl": f"""
WITH RECURSIVE {_EVENTS}, dense AS (
  SELECT seq, mid, ts // 3600 AS ts, {_ENTRY} AS entry, row_number() OVER (PARTITION BY mid ORDER BY ts // 3600, seq) AS nth FROM ev
), folded AS (
  SELECT mid, nth, seq, ts, true AS passes, ts AS state FROM dense WHERE nth = 1
  UNION ALL
  SELECT d.mid, d.nth, d.seq, d.ts, d.entry OR d.ts - f.state >= 20000 OR d.ts // 1000 <> f.state // 1000,
    CASE WHEN d.entry OR d.ts - f.state >= 20000 THEN d.ts ELSE f.state END
  FROM folded f JOIN dense d ON d.mid = f.mid AND d.nth = f.nth + 1
)
SELECT seq, mid, ts FROM folded WHERE passes""",
    "pattern_bounce": f"WITH {_EVENTS} {_sequence('ev', (_ENTRY, _ENTRY), WITHIN_MS)}",
    "pattern_three_steps": f"""
WITH {_EVENTS} {_sequence('ev', ("(page_id = 'view')", "(page_id = 'click')", "(page_id = 'purchase')"), 2 * DAY_MS)}""",
    "late_rows": f"WITH {_arrived()} SELECT seq, mid, ts, step, watermark FROM judged WHERE late",
    "late_windows": f"WITH {_arrived()} {_LATE_WINDOWS}",
    "stream_late_windows": f"WITH {_arrived('((SELECT count(*) FROM events) // 3)', 3)} {_LATE_WINDOWS}",
    "bounce": f"WITH {_EVENTS}, {_visits('ev')} SELECT seq, mid, ts FROM uj",
    "bounce_ten_seconds": f"WITH {_EVENTS}, {_visits('ev', 10_000)} SELECT seq, mid, ts FROM uj",
    "visitor_measures": f"""
{_PAGE_STATS}
SELECT ch, ar, is_new, vc, {', '.join(f'CAST({m} AS BIGINT) AS {m}' for m in _ALL_MEASURES)}, ts FROM measures""",
    "page_windows": f"""
WITH {_EVENTS}
SELECT {_text(f'(ts // {HOUR_MS}) * {HOUR_MS}')} AS stt, {_text(f'(ts // {HOUR_MS} + 1) * {HOUR_MS}')} AS edt, ch,
       0::BIGINT AS uv_ct, count(*) AS pv_ct, count(*) FILTER (WHERE last_page_id IS NULL) AS sv_ct,
       0::BIGINT AS uj_ct, CAST(sum(during_time) AS BIGINT) AS dur_sum, max(ts) AS ts
FROM ev GROUP BY ts // {HOUR_MS}, ch""",
    "visitor_stats": _PAGE_STATS + _stats(),
    "visitor_stats_from_logs": f"""
WITH {_FIXED}, shown AS (SELECT * FROM fixed WHERE page_id <> 'error'), {_visits('shown')}, {_measures('shown')}
{_stats()}""",
    "stats_sink_rows": _PAGE_STATS + _stats(with_ts=False),
    "time_format": f"""
WITH {_EVENTS}
SELECT seq, {_text('ts')} AS from_millis, {_text('ts')} AS from_seconds, ts // 1000 * 1000 AS ms FROM ev""",
    "order_times": f"""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o_orderdate, '%H') AS create_hour, epoch_ms(o_orderdate) - {8 * HOUR_MS} AS create_ts
FROM orders""",
    "date_parts": f"""
SELECT o_orderkey + 1000000 AS id, strftime({_PAID}, '%Y-%m-%d') AS create_date,
       strftime({_PAID}, '%H') AS create_hour
FROM orders""",
    "user_age": f'SELECT CAST(c_custkey AS VARCHAR) AS "ID", {_AGE} AS age FROM customer',
    "record_json": f"""
WITH {_EVENTS}
SELECT {_json(*[(c, _quoted(c)) for c in _FLAT], ('during_time', 'during_time'), ('ts', 'ts'))} AS value FROM ev""",
    "order_wide_interval": f"WITH {_WIDE_ORDER} SELECT * FROM narrow",
    "dim_enrich": f"""
WITH facts AS (
  SELECT l_orderkey AS order_id, l_orderkey * 10 + l_linenumber AS id, l_partkey AS sku_id,
         o_custkey AS user_id, o_custkey % 25 AS province_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
{_with_dims('facts')}""",
    "order_wide": f"WITH {_WIDE_ORDER} {_with_dims('narrow')}",
    "payment_wide": _PAYMENT_WIDE,
    "payment_orders": f"""
SELECT o_orderkey + 1000000 AS payment_id, o_orderkey AS order_id, round(o_totalprice - 1, 2) AS total_amount,
       {_PAID_TEXT} AS payment_create_time, {_ORDER_TEXT} AS order_create_time
FROM orders WHERE epoch_ms(o_orderdate) - epoch_ms({_PAID}) BETWEEN -900000 AND 5000""",
    "cdc_normalize": f"WITH {_CHANGES} SELECT * EXCLUDE (short) FROM changes",
    "cdc_typed_cells": """
WITH o AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS price FROM orders)
SELECT 'dwd_order_info' AS topic,
  '{"id":' || o_orderkey || ',"price":' || regexp_replace(regexp_replace(price, '0+$', ''), '[.]$', '') ||
  ',"price_text":"' || price || '","open":' || (CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END) ||
  ',"more":{"keys":[' || o_custkey || ',null],"priority":"' || o_orderpriority || '"}}' AS value FROM o""",
    "cdc_types": """
SELECT 'order_info' AS "tableName", unnest(['id', 'price', 'price_text', 'open', 'more']) AS "column",
  unnest(['BIGINT', 'DECIMAL', 'STRING', 'BOOLEAN', 'OBJECT<keys: ARRAY<BIGINT>, priority: STRING>']) AS type
FROM (SELECT 1 FROM orders LIMIT 1)""",
    "cdc_drop_empty": f"""WITH {_CHANGES} SELECT "tableName", type, seq FROM changes WHERE data <> '{{}}'""",
    "cdc_route": _ROUTE,
    "cdc_route_store": f"""
WITH {_CHANGES}
SELECT 'dim_user_info' AS "sinkTable", 'id' AS "sinkPk", type, short AS data
FROM changes WHERE "tableName" = 'user_info' AND type = 'insert'""",
    "cdc_unrouted": f"""
WITH {_CHANGES}
SELECT "tableName", type, CASE "tableName" WHEN 'spu_info' THEN 'sink type clickhouse' ELSE 'no rule' END AS reason,
       count(*) AS changes
FROM changes
WHERE data <> '{{}}' AND NOT ("tableName" = 'order_info' AND type IN ('insert', 'update'))
  AND "tableName" <> 'user_info'
GROUP BY "tableName", type""",
    "cdc_route_as_of": f"""
WITH {_RULED}
SELECT r."tableName", r.type, r.seq, any_value(kind) AS "sinkType", any_value(sink) AS "sinkTable",
  '{{' || string_agg('"' || name || '":"' || cell || '"', ',' ORDER BY n) || '}}' AS data
FROM ruled r JOIN cells c ON c.source = r."tableName" AND c.seq = r.seq AND list_contains(cols, name)
WHERE NOT none GROUP BY r."tableName", r.type, r.seq""",
    "cdc_unrouted_as_of": f"""
WITH {_RULED}
SELECT "tableName", type, count(*) AS changes FROM ruled WHERE none GROUP BY "tableName", type""",
    "rule_upkeep": f"""
WITH {_EVENTS},
last AS (
  SELECT * FROM ev
  QUALIFY row_number() OVER (PARTITION BY mid, k % 2 ORDER BY seq DESC) = 1)
SELECT 't' || mid AS "sourceTable", CASE WHEN k % 2 = 0 THEN 'insert' ELSE 'update' END AS "operateType",
       'kafka' AS "sinkType", 'dwd_' || seq AS "sinkTable", 'id,name' AS "sinkColumns"
FROM last WHERE NOT (page_id = 'error' AND k % 3 = 0)""",
    "dim_upsert": _DIM_UPSERT,
    "dim_upsert_store": _DIM_UPSERT,
    "dim_tables_of_rules": f"""
WITH {_EVENTS}, said AS (
  SELECT seq, 'dim_t' || seq % 4 AS table_name, CASE WHEN seq % 4 = 0 THEN 'code' ELSE 'id' END AS key,
    ['name', page_id, 'c' || k % 9] || CASE WHEN k % 2 = 0 THEN ['code'] ELSE [] END AS cols FROM ev
), named AS (
  SELECT table_name, key, seq, unnest(list_append(cols, key)) AS column_name, unnest(range(1, len(cols) + 2)) AS i FROM said
), first AS (
  SELECT table_name, column_name, min((seq, i)) AS place, bool_or(column_name = key) AS is_key FROM named GROUP BY ALL
)
SELECT table_name, column_name, row_number() OVER (PARTITION BY table_name ORDER BY place) - 1 AS place,
       CAST(is_key AS BIGINT) AS is_key FROM first""",
    "camel_names": """
SELECT CAST(c_custkey AS VARCHAR) AS "cCustkey", c_name AS "cName", c_mktsegment AS "cMktsegment" FROM customer""",
    "stream_cdc_route": _ROUTE,
    "stream_dim_upsert": "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer",
}

# A stream over the whole table ends at the batch result.
for _name in (
    "new_visitor_fix unique_visit_day unique_visit_literal unique_visit_literal_ttl bounce pattern_three_steps"
    " visitor_stats order_wide payment_wide"
).split():
    ORACLES[f"stream_{_name}"] = ORACLES[_name]
ORACLES["stream_visitor_chain"] = ORACLES["visitor_stats"]
