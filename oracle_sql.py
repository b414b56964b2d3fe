"""The registered queries in DuckDB SQL, from the same tables.

Every statement builds the raw lines from the tables, decodes them, and computes the result in plain SQL.
"""

from __future__ import annotations

INTEGER = r"'^[+-]?[0-9]+$'"
DECIMAL = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
LEADING_TIME = r"'^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})([^0-9].*)?$'"
PADDED = "'%Y-%m-%d %H:%M:%S'"
UNPADDED = "'%Y-%-m-%-d %-H:%M:%S'"
MILLIS = "'%Y-%m-%d %H:%M:%S.%g'"
SALES = "('1001', '1002', '1004')"
DAY = 86_400_000_000
HOUR = 3_600_000_000
MINUTE = 60_000_000
SECOND = 1_000_000


def _long(f: str) -> str:
    return f"CASE WHEN regexp_matches({f}, {INTEGER}) THEN TRY_CAST({f} AS BIGINT) END"


def _int(f: str) -> str:
    return f"CASE WHEN regexp_matches({f}, {INTEGER}) THEN TRY_CAST({f} AS INTEGER) END"


def _money(f: str) -> str:
    return f"CASE WHEN regexp_matches({f}, {DECIMAL}) THEN TRY_CAST({f} AS DECIMAL(18,2)) END"


def _double(f: str) -> str:
    return f"CASE WHEN regexp_matches({f}, {DECIMAL}) THEN TRY_CAST({f} AS DOUBLE) END"


def _time(f: str) -> str:
    return f"try_strptime(regexp_extract({f}, {LEADING_TIME}, 1), '%Y-%m-%d %H:%M:%S')"


def _text(ts: str) -> str:
    return f"strftime({ts}, {PADDED})"


def _us_text(us: str) -> str:
    return f"strftime(make_timestamp({us}), {PADDED})"


def _percent(part: str, whole: str) -> str:
    tenths = f"((2000 * {part} + {whole}) // (2 * {whole}))"
    return f"CAST({tenths} // 10 AS VARCHAR) || '.' || CAST({tenths} % 10 AS VARCHAR) || '%'"


def _money_text(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(38,2)) AS VARCHAR)"


REJECTED_ORDERS = """SELECT arrival, value, CASE WHEN short THEN 'short' WHEN amount IS NULL THEN 'bad_number'
  ELSE 'bad_time' END AS reason FROM order_parsed
  WHERE short OR amount IS NULL OR create_time IS NULL OR operation_time IS NULL"""

ORDER_LINES = f"""
order_lines AS (
  SELECT o_orderkey AS arrival, CAST(o_orderdate AS TIMESTAMP) AS arrival_ts,
    CASE WHEN o_orderkey % 97 = 3 THEN 'bad,' || CAST(o_orderkey AS VARCHAR)
    ELSE concat_ws(',', CAST(o_orderkey AS VARCHAR), c_name, 'tel-' || CAST(c_custkey AS VARCHAR),
      CASE WHEN o_orderkey % 101 = 5 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END,
      CASE o_orderpriority WHEN '1-URGENT' THEN '1001' WHEN '2-HIGH' THEN '1002' WHEN '3-MEDIUM' THEN '1004'
        WHEN '4-NOT SPECIFIED' THEN '1003' ELSE CASE WHEN o_orderstatus = 'O' THEN '1005' ELSE '1006' END END,
      CAST(o_custkey AS VARCHAR), 'addr', 'note', 'trade', 'body',
      strftime(CAST(o_orderdate AS TIMESTAMP), {UNPADDED}),
      strftime(CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400), {UNPADDED}),
      CAST(c_nationkey AS VARCHAR), '5') END AS value
  FROM orders JOIN customer ON o_custkey = c_custkey
),
order_fields AS (
  SELECT arrival, arrival_ts, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM order_lines
),
order_parsed AS (
  SELECT arrival, arrival_ts, value, len(f) <= 11 AS short, {_long("f[1]")} AS id, f[2] AS consignee,
    f[3] AS consignee_tel, {_money("f[4]")} AS amount, f[5] AS status, f[6] AS user_id,
    {_time("f[11]")} AS create_time, {_time("f[12]")} AS operation_time, f[-1] AS freight
  FROM order_fields
),
o AS (
  SELECT * FROM order_parsed
  WHERE NOT short AND id IS NOT NULL AND amount IS NOT NULL AND create_time IS NOT NULL AND operation_time IS NOT NULL
)"""

DETAIL_LINES = f"""
detail_numbered AS (
  SELECT l_orderkey * 100 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS arrival, lineitem.*
  FROM lineitem
),
detail_lines AS (
  SELECT arrival, CAST(l_shipdate AS TIMESTAMP) AS arrival_ts,
    CASE WHEN arrival % 89 = 7 THEN 'bad'
    ELSE concat_ws(',', CAST(arrival AS VARCHAR), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), 'sku',
      CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
      strftime(CAST(l_shipdate AS TIMESTAMP), {PADDED})) END AS value
  FROM detail_numbered
),
detail_fields AS (
  SELECT arrival, arrival_ts, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM detail_lines
),
detail_parsed AS (
  SELECT arrival, arrival_ts, value, len(f) <= 6 AS short, f[1] AS detail_id, {_long("f[2]")} AS order_id,
    f[3] AS sku_id, {_money("f[5]")} AS price, {_int("f[6]")} AS num, {_time("f[7]")} AS create_time
  FROM detail_fields
),
d AS (
  SELECT * FROM detail_parsed
  WHERE NOT short AND order_id IS NOT NULL AND price IS NOT NULL AND num IS NOT NULL AND create_time IS NOT NULL
)"""

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
_TS = "CAST(ts AS TIMESTAMP)"

CHANGE_LINES = f"""
change_lines AS (
  SELECT event_id AS arrival, {_TS} AS arrival_ts,
    CASE WHEN event_id % 83 = 9 THEN 'bad,' || CAST(event_id AS VARCHAR)
    ELSE concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), '0000',
      CASE event_type WHEN 'error' THEN '预警' WHEN 'view' THEN '运行' WHEN 'click' THEN '待机'
        WHEN 'signup' THEN '离线' WHEN 'purchase' THEN '维修' END,
      {_text(_TS)}, 'x', CAST({_K} AS VARCHAR)) END AS value
  FROM events
),
change_fields AS (
  SELECT arrival, arrival_ts, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM change_lines
),
change_parsed AS (
  SELECT arrival, arrival_ts, value, len(f) <= 4 AS short, f[2] AS machine_id, f[4] AS status,
    {_time("f[5]")} AS start_time, {_int("f[-1]")} AS flag
  FROM change_fields
),
c AS (
  SELECT * FROM change_parsed WHERE NOT short AND start_time IS NOT NULL AND flag IS NOT NULL
)"""

PRODUCE_LINES = f"""
produce_lines AS (
  SELECT event_id AS arrival, {_TS} AS arrival_ts,
    concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), '0000', {_text(_TS)}, {_text(_TS)},
      {_text(_TS)}, '11560', '1900-01-01 00:00:00', '184962', CAST({_K} % 2 AS VARCHAR)) AS value
  FROM events
),
produce_fields AS (
  SELECT arrival, arrival_ts, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM produce_lines
),
p AS (
  SELECT arrival, arrival_ts, f[2] AS machine_id, f[-1] AS passed FROM produce_fields WHERE len(f) > 1
)"""

ENVIRONMENT_LINES = f"""
environment_lines AS (
  SELECT event_id AS arrival, {_TS} AS arrival_ts,
    CASE WHEN event_id % 79 = 11 THEN 'x,y'
    ELSE concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), 'a', 'b', 'c',
      CASE WHEN event_id % 73 = 5 THEN ' ' || CAST(CAST("value" AS DECIMAL(10,2)) AS VARCHAR) || ' '
        ELSE CAST(CAST("value" AS DECIMAL(10,2)) AS VARCHAR) END, 'd') END AS value
  FROM events
),
environment_fields AS (
  SELECT arrival, arrival_ts, value, string_split(regexp_replace(value, ',+$', ''), ',') AS f FROM environment_lines
),
environment_parsed AS (
  SELECT arrival, arrival_ts, value, len(f) <= 5 AS short, f[2] AS machine_id, {_double("f[6]")} AS temperature
  FROM environment_fields
),
e AS (
  SELECT * FROM environment_parsed WHERE NOT short AND temperature IS NOT NULL
)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(ctes) + "\n"


ORDERS, DETAILS, CHANGES = _with(ORDER_LINES), _with(DETAIL_LINES), _with(CHANGE_LINES)
PRODUCE, ENVIRONMENT = _with(PRODUCE_LINES), _with(ENVIRONMENT_LINES)

SKU_SUMS = """
sku_sums AS (
  SELECT sku_id AS key, sum(num) AS quantity, sum(price * num) AS amount FROM d GROUP BY sku_id HAVING count(*) >= 2
)"""
USER_SPEND = f"""
user_spend AS (
  SELECT user_id || ':' || consignee AS key, sum(amount) AS amount FROM o WHERE status IN {SALES} GROUP BY 1
)"""


def _top_text(table: str, column: str, value: str, k: int, name: str) -> str:
    return f"""SELECT '{name}' AS key, '[' || string_agg(key || ':' || {value}, ',' ORDER BY {column} DESC, key) || ']'
    AS value FROM (SELECT key, {column} FROM {table} ORDER BY {column} DESC, key LIMIT {k}) HAVING count(*) = {k}"""


TOP_USERS = _top_text("user_spend", "amount", _money_text("amount"), 2, "top2userconsumption")
TOP_SKU_QUANTITY = _top_text("sku_sums", "quantity", "CAST(quantity AS VARCHAR)", 3, "top3itemamount")
TOP_SKU_AMOUNT = _top_text("sku_sums", "amount", _money_text("amount"), 3, "top3itemconsumption")

KPI_ROWS = f"""
last_cancel AS (SELECT max(arrival) AS cut FROM o WHERE status = '1003'),
totals AS (
  SELECT sum(amount) FILTER (status IN {SALES}) AS sales_total, sum(amount) FILTER (status = '1006') AS refund_total,
    count(*) FILTER (status IN {SALES}) AS sales, count(*) FILTER (status = '1005') AS refund_requests,
    count(*) FILTER (status = '1003') AS cancels,
    count(*) FILTER (arrival <= (SELECT cut FROM last_cancel)) AS orders_at_cancel
  FROM o
),
kpi_rows AS (
  SELECT 'totalprice' AS key, {_money_text("sales_total")} AS value FROM totals WHERE sales_total IS NOT NULL
  UNION ALL SELECT 'totalrefundordercount', {_money_text("refund_total")} FROM totals WHERE refund_total IS NOT NULL
  UNION ALL SELECT 'totalcount', CAST(sales AS VARCHAR) FROM totals WHERE sales > 0
  UNION ALL SELECT 'refundcountminute', CAST(refund_requests AS VARCHAR) FROM totals WHERE refund_requests > 0
  UNION ALL SELECT 'cancelrate', {_percent("cancels", "orders_at_cancel")} FROM totals WHERE cancels > 0
)"""


def _running(statuses: str, value: str, name: str) -> str:
    return f"""{ORDERS} SELECT arrival, id, {value} AS {name} FROM o WHERE status IN {statuses}"""


def _running_sum(statuses: str) -> str:
    return _running(statuses, _money_text("sum(amount) OVER (ORDER BY arrival ROWS UNBOUNDED PRECEDING)"), "total")


def _running_count(statuses: str) -> str:
    return _running(statuses, "row_number() OVER (ORDER BY arrival)", "orders")


def _sku_running(value: str, name: str) -> str:
    return f"""{DETAILS} SELECT arrival, sku_id, events, {value} AS {name} FROM (
      SELECT arrival, sku_id, row_number() OVER w AS events, sum(num) OVER w AS quantity, sum(price * num) OVER w AS
      amount FROM d WINDOW w AS (PARTITION BY sku_id ORDER BY arrival ROWS UNBOUNDED PRECEDING)) WHERE events >= 2"""


def _tumbling(source: str, size: int, count: str = "count(*)", condition: str = "true") -> str:
    return f"""
window_counts AS (
  SELECT machine_id, epoch_us(arrival_ts) // {size} * {size} AS window_start,
    epoch_us(arrival_ts) // {size} * {size} + {size} AS window_end, {count} AS cnt
  FROM {source} WHERE {condition} GROUP BY ALL
)"""


WINDOW_COLUMNS = f"machine_id, {_us_text('window_start')} AS window_start, {_us_text('window_end')} AS window_end, cnt"
IS_PASSED = "passed = '1'"
IS_FLAGGED = "status = '预警' AND flag % 2 = 0"


def _produce_filtered(size: int) -> str:
    return _with(PRODUCE_LINES, _tumbling("p", size, condition=IS_PASSED)) + f"SELECT {WINDOW_COLUMNS} FROM window_counts"


def _produce_conditional(size: int) -> str:
    counts = _tumbling("p", size, f"count(*) FILTER ({IS_PASSED})")
    return _with(PRODUCE_LINES, counts) + f"SELECT {WINDOW_COLUMNS} FROM window_counts"


def _produce_latest(size: int) -> str:
    return _with(PRODUCE_LINES, _tumbling("p", size, condition=IS_PASSED)) + """SELECT 'totalproduce' AS key,
      machine_id AS field, CAST(arg_max(cnt, window_end) AS VARCHAR) AS value FROM window_counts GROUP BY machine_id"""


def _produce_rowkey(size: int) -> str:
    end = f"strftime(make_timestamp(window_end), {MILLIS})"
    return _with(PRODUCE_LINES, _tumbling("p", size, condition=IS_PASSED)) + f"""SELECT machine_id || '-' || {end}
      AS row_key, machine_id, CAST(cnt AS VARCHAR) AS total_produce FROM window_counts"""


def _warning_tumbling(size: int, columns: str) -> str:
    return _with(CHANGE_LINES, _tumbling("c", size, condition=IS_FLAGGED)) + f"SELECT {columns} FROM window_counts"


def _warning_sliding(size: int, slide: int, columns: str) -> str:
    return _with(
        CHANGE_LINES,
        f"""
sliding AS (
  SELECT machine_id, epoch_us(arrival_ts) // {slide} * {slide} - k * {slide} + {size} AS window_end, count(*) AS cnt
  FROM c, range({size // slide}) AS r(k) WHERE status = '预警' GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, machine_id) AS place FROM sliding
)""",
    ) + f"SELECT {columns} FROM ranked WHERE place = 1"


def _join(size: int) -> str:
    return _with(
        ORDER_LINES,
        DETAIL_LINES,
        f"""
joined AS (
  SELECT o.id, epoch_us(o.arrival_ts) // {size} AS w, o.amount, d.num, o.arrival AS o_arrival, d.arrival AS d_arrival
  FROM o JOIN d ON o.id = d.order_id AND epoch_us(o.arrival_ts) // {size} = epoch_us(d.arrival_ts) // {size}
  WHERE o.status IN {SALES}
)""",
    )


JOIN_CELLS = f"id, {_money_text('amount')} AS orderprice, CAST(num AS VARCHAR) AS orderdetailcount"


def _join_all(size: int) -> str:
    return _join(size) + f"SELECT {JOIN_CELLS} FROM joined"


def _join_latest(size: int, columns: str = JOIN_CELLS) -> str:
    return _join(size) + f"""SELECT {columns} FROM (SELECT *, row_number() OVER
      (PARTITION BY id ORDER BY w DESC, o_arrival DESC, d_arrival DESC) AS place FROM joined) WHERE place = 1"""


def _holds(lines: str, readings: str, hold: int, columns: str) -> str:
    return _with(
        lines,
        f"""
readings AS ({readings}),
numbered AS (SELECT machine_id, t, m, row_number() OVER (PARTITION BY machine_id ORDER BY t, arrival) AS rn FROM readings),
walk(machine_id, rn, start, last, alert, alert_last) AS (
  SELECT machine_id, rn, CASE WHEN m THEN t END, CASE WHEN m THEN t END, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.machine_id, n.rn,
    CASE WHEN NOT n.m THEN NULL WHEN w.start IS NULL OR n.t > w.start + {hold} THEN n.t ELSE w.start END,
    CASE WHEN n.m THEN n.t END,
    CASE WHEN n.t > w.start + {hold} THEN w.start + {hold} END,
    CASE WHEN n.t > w.start + {hold} THEN w.last END
  FROM walk w JOIN numbered n ON n.machine_id = w.machine_id AND n.rn = w.rn + 1
),
ends AS (SELECT machine_id, max(rn) AS rn FROM numbered GROUP BY machine_id),
alerts AS (
  SELECT machine_id, alert, alert_last AS last FROM walk WHERE alert IS NOT NULL
  UNION ALL
  SELECT machine_id, start + {hold}, last FROM walk JOIN ends USING (machine_id, rn)
  WHERE start IS NOT NULL AND start + {hold} < (SELECT max(t) FROM readings)
)""",
        recursive=True,
    ) + f"SELECT {columns} FROM alerts"


WARNING_READINGS = "SELECT machine_id, epoch_us(start_time) AS t, status = '预警' AS m, arrival FROM c"
TEMPERATURE_READINGS = "SELECT machine_id, epoch_us(arrival_ts) AS t, temperature > 38 AS m, arrival FROM e"


def _message(seconds: int) -> str:
    return f"{_us_text('last')} || ':设备' || machine_id || '连续{seconds}秒为预警状态请尽快处理！'"


def _warning_holds(hold: int) -> str:
    columns = f"machine_id, {_us_text('alert')} AS alert_time, {_message(hold // SECOND)} AS message"
    return _holds(CHANGE_LINES, WARNING_READINGS, hold, columns)


def _temperature_holds(hold: int) -> str:
    columns = f"machine_id, alert AS alert_us, last AS last_match_us"
    return _holds(ENVIRONMENT_LINES, TEMPERATURE_READINGS, hold, columns)


# A machine's state changes are decoded without the start time here.
TRANSITIONS = f"""
previous AS (
  SELECT arrival, arrival_ts, machine_id, status, lag(status) OVER (PARTITION BY machine_id ORDER BY arrival) AS previous
  FROM c
),
transitions AS (
  SELECT arrival, machine_id, previous, row_number() OVER (PARTITION BY machine_id ORDER BY arrival) AS changes,
    {_text("arrival_ts")} AS change_time
  FROM previous WHERE status = '运行' AND previous <> '运行'
)"""

JOIN_ROW_CELLS = f"""CAST(id AS VARCHAR) AS row_key, CAST(id AS VARCHAR) AS id, {_money_text("amount")} AS orderprice,
  CAST(num AS VARCHAR) AS orderdetailcount"""
ORDER_CELLS = f"""CAST(id AS VARCHAR) AS row_key, CAST(id AS VARCHAR) AS id, consignee, {_money_text("amount")}
  AS final_total_amount, status AS order_status, user_id,
  {_text("date_trunc('day', create_time)")} AS create_time,
  {_text("date_trunc('day', operation_time)")} AS operation_time"""

REASONS = f"""
reasons AS (
  SELECT CASE WHEN short THEN 'short' WHEN id IS NULL OR amount IS NULL THEN 'bad_number'
    WHEN create_time IS NULL OR operation_time IS NULL THEN 'bad_time' END AS reason FROM order_parsed
  UNION ALL
  SELECT CASE WHEN short THEN 'short' WHEN order_id IS NULL OR price IS NULL OR num IS NULL THEN 'bad_number'
    WHEN create_time IS NULL THEN 'bad_time' END FROM detail_parsed
  UNION ALL
  SELECT CASE WHEN short THEN 'short' WHEN flag IS NULL THEN 'bad_number' WHEN start_time IS NULL THEN 'bad_time' END
  FROM change_parsed
  UNION ALL
  SELECT CASE WHEN short THEN 'short' WHEN temperature IS NULL THEN 'bad_number' END FROM environment_parsed
)"""


def oracle_sql() -> dict[str, str]:
    found = {
        "read_lines": f"SELECT event_id AS arrival, props AS value, epoch_us({_TS}) AS arrival_us FROM events",
        "decode_orders": f"""{ORDERS} SELECT arrival, id, consignee, consignee_tel, {_money_text("amount")} AS amount,
          status, user_id, {_text("create_time")} AS create_time, {_text("operation_time")} AS operation_time, freight
          FROM o""",
        "decode_orders_date_only": f"""{ORDERS} SELECT arrival, id, {_text("date_trunc('day', create_time)")}
          AS create_time, {_text("date_trunc('day', operation_time)")} AS operation_time FROM o""",
        "decode_order_details": f"""{DETAILS} SELECT arrival, detail_id, order_id, sku_id, {_money_text("price")}
          AS price, num, {_text("create_time")} AS create_time FROM d""",
        "decode_produce": f"{PRODUCE} SELECT arrival, machine_id, passed FROM p",
        "decode_produce_strict": f"{PRODUCE} SELECT arrival, machine_id, passed FROM p",
        "decode_changes": f"""{CHANGES} SELECT arrival, machine_id, status, {_text("start_time")} AS start_time, flag
          FROM c""",
        "decode_environment": f"{ENVIRONMENT} SELECT arrival, machine_id, temperature FROM e",
        "decode_rejects": _with(ORDER_LINES, DETAIL_LINES, CHANGE_LINES, ENVIRONMENT_LINES, REASONS)
        + "SELECT reason, count(*) AS lines FROM reasons WHERE reason IS NOT NULL GROUP BY reason",
        "event_time_max": f"""{ORDERS} SELECT arrival, id, {_text("greatest(create_time, operation_time)")}
          AS event_time FROM o""",
        "filter_sales_orders": f"{ORDERS} SELECT arrival, id, status FROM o WHERE status IN {SALES}",
        "filter_passed": f"{PRODUCE} SELECT arrival, machine_id FROM p WHERE {IS_PASSED}",
        "filter_flagged_warning": f"{CHANGES} SELECT arrival, machine_id, flag FROM c WHERE {IS_FLAGGED}",
        "filter_warning": f"{CHANGES} SELECT arrival, machine_id FROM c WHERE status = '预警'",
        "route_orders": f"""{ORDERS} SELECT arrival, id, CASE WHEN status IN {SALES} THEN 'sales'
          WHEN status = '1003' THEN 'cancelled' WHEN status = '1005' THEN 'refund_requested' ELSE 'refunded' END
          AS route FROM o WHERE status IN ('1001', '1002', '1003', '1004', '1005', '1006')""",
        "cancelled_orders": f"""{ORDERS} SELECT id, consignee, consignee_tel, {_money_text("amount")} AS amount, freight
          FROM o WHERE status = '1003'""",
        "running_sales_total": _running_sum(SALES),
        "running_refund_total": _running_sum("('1006')"),
        "running_order_count": _running_count(SALES),
        "running_refund_requests": _running_count("('1005')"),
        "running_cancel_rate": f"""{ORDERS} SELECT arrival, id, {_percent("cancels", "orders")} AS cancel_rate FROM (
          SELECT arrival, id, status, sum(CASE WHEN status = '1003' THEN 1 ELSE 0 END) OVER w AS cancels,
          count(*) OVER w AS orders FROM o WINDOW w AS (ORDER BY arrival ROWS UNBOUNDED PRECEDING))
          WHERE status = '1003'""",
        "order_kpis_latest": _with(ORDER_LINES, KPI_ROWS) + "SELECT key, value FROM kpi_rows",
        "user_spend": _with(ORDER_LINES, USER_SPEND) + f"SELECT key, {_money_text('amount')} AS value FROM user_spend",
        "sku_running_quantity": _sku_running("CAST(quantity AS BIGINT)", "quantity"),
        "sku_running_amount": _sku_running(_money_text("amount"), "amount"),
        "top2_users": _with(ORDER_LINES, USER_SPEND) + TOP_USERS,
        "top3_sku_quantity": _with(DETAIL_LINES, SKU_SUMS) + TOP_SKU_QUANTITY,
        "top3_sku_amount": _with(DETAIL_LINES, SKU_SUMS) + TOP_SKU_AMOUNT,
        "produce_count_filtered": _produce_filtered(5 * MINUTE),
        "produce_count_filtered_daily": _produce_filtered(DAY),
        "produce_count_conditional": _produce_conditional(5 * MINUTE),
        "produce_count_conditional_daily": _produce_conditional(DAY),
        "produce_latest_window": _produce_latest(5 * MINUTE),
        "produce_latest_window_daily": _produce_latest(DAY),
        "produce_rowkey": _produce_rowkey(5 * MINUTE),
        "produce_rowkey_daily": _produce_rowkey(DAY),
        "warning_count_tumbling": _warning_tumbling(
            3 * MINUTE, f"machine_id, cnt, {_us_text('window_end')} AS window_end"
        ),
        "warning_count_tumbling_daily": _warning_tumbling(
            DAY, f"machine_id, cnt, {_us_text('window_end')} AS window_end"
        ),
        "warning_top_sliding": _warning_sliding(
            3 * MINUTE, MINUTE, f"{_us_text('window_end')} AS window_end, machine_id, cnt"
        ),
        "warning_top_sliding_daily": _warning_sliding(
            3 * DAY, DAY, f"{_us_text('window_end')} AS window_end, machine_id, cnt"
        ),
        "order_detail_window_join": _join_all(30 * DAY),
        "order_detail_window_join_1s": _join_all(SECOND),
        "order_detail_latest": _join_latest(30 * DAY),
        "hold_alerts_status": _warning_holds(30 * SECOND),
        "hold_alerts_status_6h": _warning_holds(6 * HOUR),
        "hold_alerts_threshold": _temperature_holds(3 * MINUTE),
        "hold_alerts_threshold_6h": _temperature_holds(6 * HOUR),
        "transitions_to_running": _with(CHANGE_LINES, TRANSITIONS)
        + "SELECT arrival, machine_id, previous, changes, change_time FROM transitions",
        "sink_kv_set": _with(ORDER_LINES, DETAIL_LINES, KPI_ROWS, USER_SPEND, SKU_SUMS)
        + f"""SELECT key, value FROM kpi_rows UNION ALL ({TOP_USERS}) UNION ALL ({TOP_SKU_QUANTITY})
          UNION ALL ({TOP_SKU_AMOUNT})""",
        "sink_kv_hset": _warning_sliding(
            3 * DAY,
            DAY,
            f"'warning_last3min_everymin_out' AS key, {_us_text('window_end')} AS field, machine_id AS value",
        ),
        "sink_row_upsert": _join_latest(30 * DAY, JOIN_ROW_CELLS),
        "cancelled_orders_upsert": f"""{ORDERS} SELECT {ORDER_CELLS} FROM (SELECT *, row_number() OVER
          (PARTITION BY id ORDER BY arrival DESC) AS place FROM o WHERE status = '1003') WHERE place = 1""",
        "sink_jdbc_append_order_info": f"""{ORDERS} SELECT CAST(id AS VARCHAR) AS id, consignee, consignee_tel,
          {_money_text("amount")} AS amount, freight FROM o WHERE status = '1003'""",
        "sink_jdbc_append_warnings": _warning_tumbling(
            DAY, f"machine_id, CAST(cnt AS VARCHAR) AS cnt, {_us_text('window_end')} AS window_end"
        ),
        "sink_jdbc_append_transitions": _with(CHANGE_LINES, TRANSITIONS)
        + "SELECT machine_id, previous AS last_status, CAST(changes AS VARCHAR) AS changes, change_time FROM transitions",
        "sink_row_upsert_temperature": _holds(
            ENVIRONMENT_LINES,
            TEMPERATURE_READINGS,
            6 * HOUR,
            f"DISTINCT machine_id || '-' || {_us_text('alert')} AS row_key, machine_id, "
            f"{_us_text('alert')} AS out_warning_time",
        ),
        "stream_order_rates": _with(ORDER_LINES, KPI_ROWS)
        + "SELECT key, value FROM kpi_rows WHERE key IN ('totalcount', 'refundcountminute', 'cancelrate')",
        "stream_top_users": _with(ORDER_LINES, USER_SPEND) + TOP_USERS,
        "stream_top_sku_amount": _with(DETAIL_LINES, SKU_SUMS) + TOP_SKU_AMOUNT,
        "stream_warning_counts": _warning_tumbling(
            DAY, f"machine_id, CAST(cnt AS VARCHAR) AS cnt, {_us_text('window_end')} AS window_end"
        ),
        "stream_warning_top": _warning_sliding(
            3 * DAY,
            DAY,
            f"'warning_last3min_everymin_out' AS key, {_us_text('window_end')} AS field, machine_id AS value",
        ),
        "stream_transitions": _with(CHANGE_LINES, TRANSITIONS)
        + "SELECT machine_id, previous AS last_status, CAST(changes AS VARCHAR) AS changes, change_time FROM transitions",
        "stream_transitions_late": _with(CHANGE_LINES, TRANSITIONS)
        + "SELECT machine_id, previous AS last_status, CAST(changes AS VARCHAR) AS changes, change_time FROM transitions",
        "stream_warning_held": _holds(
            CHANGE_LINES,
            WARNING_READINGS,
            6 * HOUR,
            f"'warning30sMachine' AS key, machine_id AS field, arg_max({_message(21600)}, alert) AS value",
        )
        + " GROUP BY machine_id",
        "stream_rejects": _with(ENVIRONMENT_LINES)
        + """SELECT arrival, value, CASE WHEN short THEN 'short' ELSE 'bad_number' END AS reason FROM environment_parsed
          WHERE short OR temperature IS NULL""",
        "stream_order_join": _join_latest(30 * DAY, JOIN_ROW_CELLS),
        "read_lines_text": _with(CHANGE_LINES, TRANSITIONS) + "SELECT machine_id, previous, changes FROM transitions",
        "hold_alerts_status_6h_split": _warning_holds(6 * HOUR),
        "hold_alerts_threshold_6h_split": _temperature_holds(6 * HOUR),
        "transitions_to_running_split": _with(CHANGE_LINES, TRANSITIONS)
        + "SELECT arrival, machine_id, previous, changes, change_time FROM transitions",
        "sku_running_amount_split": _sku_running(_money_text("amount"), "amount"),
        "stream_top_sku_quantity": _with(DETAIL_LINES, SKU_SUMS) + TOP_SKU_QUANTITY,
    }
    found["stream_order_join_late"] = found["stream_order_join"]
    found["stream_order_rejects"] = _with(ORDER_LINES) + REJECTED_ORDERS
    found["stream_read_lines_text"] = _with(CHANGE_LINES, TRANSITIONS) + (
        "SELECT machine_id, previous, CAST(changes AS VARCHAR) AS changes FROM transitions"
    )
    # The same sequences, made batch by batch.
    for name in (
        "running_sales_total", "running_refund_total", "running_order_count", "running_refund_requests",
        "running_cancel_rate", "sku_running_quantity", "sku_running_amount",
    ):
        found[f"stream_{name}"] = found[name]
    found["cancelled_orders_upsert_merged"] = found["cancelled_orders_upsert"]
    return found
