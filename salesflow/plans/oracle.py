"""SQL that gives each registered query's result on the same tables, written independently."""

from __future__ import annotations


def _orders(key: str = "o_custkey", scale: int = 1) -> str:
    return f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS SalesId, CAST({key} AS VARCHAR) AS ProductName,
           o_orderdate AS SalesDateTime, CAST(floor(o_totalprice * {scale}) AS INTEGER) AS amount,
           o_orderdate AS EventProcessingTime, o_orderkey AS arrival
    FROM orders"""


_EVENTS = """
    SELECT CAST(event_id AS VARCHAR) AS SalesId, event_type AS ProductName, ts AS SalesDateTime,
           CAST(round(value) AS INTEGER) AS amount, ts AS EventProcessingTime, event_id AS arrival
    FROM events"""

_WRAP = "CAST(({0} + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"
_INT = "CAST({0} AS INTEGER)"


def _passed(sales: str, order: str = "arrival") -> str:
    return f"""
    WITH sales AS ({sales}),
    clocked AS (
        SELECT *, max(EventProcessingTime) OVER (
            PARTITION BY ProductName ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
        FROM sales),
    passed AS (SELECT * FROM clocked WHERE clock IS NULL OR EventProcessingTime > clock)"""


def _running(sales: str, narrow: str = _INT, order: str = "arrival") -> str:
    total = f"""sum(amount) OVER (PARTITION BY ProductName ORDER BY {order}
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    return f"""{_passed(sales, order)}
    SELECT SalesId, ProductName, SalesDateTime, {narrow.format(total)} AS TotalSalesAmount,
           EventProcessingTime
    FROM passed"""


def _snapshot(sales: str) -> str:
    return f"""{_passed(sales)}
    SELECT ProductName, max(EventProcessingTime) AS last_time,
           CAST(sum(amount) AS INTEGER) AS total
    FROM passed GROUP BY ProductName"""


def _windows(
    size: str,
    sales: str = _EVENTS,
    time: str = "EventProcessingTime",
    narrow: str = _INT,
    wait: str | None = None,
    columns: str = "SalesId, ProductName, WindowStartTime, SalesAmount, WindowEndTime",
) -> str:
    bucket = f"time_bucket(INTERVAL {size}, {time}, TIMESTAMP '1970-01-01')"
    clock = f"(SELECT max({time}) - INTERVAL {wait} FROM sales)"
    closed = f"WHERE WindowEndTime <= {clock}" if wait else ""
    return f"""
    WITH sales AS ({sales}),
    buckets AS (
        SELECT ProductName, {bucket} AS WindowStartTime, sum(amount) AS total
        FROM sales GROUP BY ALL),
    rows_out AS (
        SELECT md5(concat_ws('~', ProductName, epoch_us(WindowStartTime))) AS SalesId, ProductName,
               WindowStartTime, {narrow.format("total")} AS SalesAmount,
               WindowStartTime + INTERVAL {size} AS WindowEndTime
        FROM buckets)
    SELECT {columns} FROM rows_out {closed}"""


_LATE = f"""
    WITH sales AS ({_EVENTS}),
    batched AS (
        SELECT *, (CAST(floor(epoch(EventProcessingTime)) AS BIGINT) + arrival * 7919 % 7200)
               // 21600 AS batch
        FROM sales),
    peaks AS (SELECT batch, max(EventProcessingTime) AS peak FROM batched GROUP BY batch),
    clocks AS (
        SELECT batch, max(peak) OVER (
            ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
        FROM peaks),
    marked AS (
        SELECT SalesId, ProductName, EventProcessingTime, amount,
               coalesce(time_bucket(INTERVAL 30 SECONDS, EventProcessingTime) + INTERVAL 30 SECONDS
                        <= clock - INTERVAL 10 SECONDS, false) AS late
        FROM batched JOIN clocks USING (batch))"""

_HELD_BACK = f"""
    WITH events_in AS ({_EVENTS}),
    clock AS (
        SELECT max(EventProcessingTime) - INTERVAL 10 SECONDS AS late
        FROM events_in WHERE arrival % 50 <> 0)
    SELECT events_in.* FROM events_in, clock
    WHERE arrival % 50 <> 0
          OR time_bucket(INTERVAL 30 SECONDS, EventProcessingTime, TIMESTAMP '1970-01-01')
             + INTERVAL 30 SECONDS > late"""

_TWO_RUNS = f"""
    WITH events_in AS ({_EVENTS}),
    first_clock AS (SELECT max(EventProcessingTime) - INTERVAL 10 SECONDS AS c1 FROM events_in WHERE arrival % 50 <> 0),
    last_clock AS (SELECT max(EventProcessingTime) - INTERVAL 10 SECONDS AS c2 FROM events_in),
    timed AS (
        SELECT *, arrival % 50 = 0 AS held, time_bucket(INTERVAL 30 SECONDS, EventProcessingTime, TIMESTAMP '1970-01-01') AS start,
               time_bucket(INTERVAL 30 SECONDS, EventProcessingTime, TIMESTAMP '1970-01-01') + INTERVAL 30 SECONDS AS over
        FROM events_in, first_clock, last_clock)"""

ORACLE = {
    "land_sales": f"""
    SELECT SalesId, ProductName, SalesDateTime, amount AS SalesAmount, EventProcessingTime
    FROM ({_orders()})""",
    "sales_lines": f"""
    SELECT arrival, 'SalesId: ' || SalesId || ', ProductName: ' || ProductName
           || ', SalesDateTime: ' || strftime(SalesDateTime, '%Y-%m-%d %H:%M:%S')
           || ', SalesAmount: ' || amount
           || ', EventProcessingTime: ' || strftime(EventProcessingTime, '%Y-%m-%d %H:%M:%S')
           AS line
    FROM ({_orders()})""",
    "decode_sales_json": f"""
    SELECT SalesId, ProductName, SalesDateTime, amount AS SalesAmount, EventProcessingTime
    FROM ({_orders()})""",
    "decode_quarantine": """
    SELECT o_orderkey AS arrival,
           CASE WHEN o_orderkey % 97 = 0 THEN 'corrupt' WHEN o_orderkey % 101 = 0 THEN 'empty'
                ELSE 'good' END AS reason
    FROM orders
    WHERE NOT (o_orderkey % 103 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 0)""",
    "decode_refused_fields": """
    SELECT arrival, reason,
           CASE WHEN reason = 'good' THEN CASE WHEN arrival % 23 = 0 THEN 0
                ELSE CAST(floor(o_totalprice) AS INTEGER) END END AS SalesAmount
    FROM (SELECT o_orderkey AS arrival, o_totalprice,
                 CASE WHEN o_orderkey % 7 = 0 THEN 'bad_amount'
                      WHEN o_orderkey % 11 = 0 THEN 'bad_time'
                      WHEN o_orderkey % 13 = 0 THEN 'null_key'
                      WHEN o_orderkey % 17 = 0 THEN 'null_time'
                      WHEN o_orderkey % 19 = 0 THEN 'unknown_field'
                      ELSE 'good' END AS reason
          FROM orders)""",
    "monotone_gate": f"{_passed(_orders())} SELECT SalesId, ProductName FROM passed",
    "dedupe_running_total": _running(_orders()),
    "dedupe_running_total_skewed": _running(_orders("o_orderpriority")),
    "dedupe_running_total_wrapped": _running(_orders("o_orderpriority", 4000), _WRAP),
    "dedupe_running_total_in_order": _running(_EVENTS, _WRAP),
    "dedupe_running_total_bigint": _running(
        _orders("o_orderpriority", 4000), "CAST({0} AS BIGINT)"
    ),
    "dedupe_running_total_topic": _running(_orders(), order="arrival // 8, 7 - arrival % 8"),
    "product_state_snapshot": _snapshot(_orders()),
    "product_state_snapshot_skewed": _snapshot(_orders("o_orderpriority")),
    "event_time_totals": _windows("30 SECONDS"),
    "event_time_totals_hourly": _windows("1 HOUR", narrow=_WRAP),
    "event_time_totals_wrapped": _windows(
        "365 DAYS", _orders("o_orderpriority", 100), narrow=_WRAP
    ),
    "event_time_totals_emitted": _windows(
        "30 SECONDS",
        columns="SalesId, ProductName, WindowEndTime AS WindowStartTime, SalesAmount,"
        " true AS emitted_after_end",
    ),
    "event_time_closed_windows": _windows("30 SECONDS", wait="10 SECONDS"),
    "event_time_allowed_lateness": _windows("30 SECONDS", wait="129610 SECONDS"),
    "event_time_late_dropped": _windows(
        "30 SECONDS", f"{_LATE} SELECT * FROM marked WHERE NOT late"
    ),
    "late_data_audit": f"""{_LATE}
    SELECT ProductName, count(*) FILTER (WHERE late) AS late_rows,
           count(*) FILTER (WHERE NOT late) AS on_time_rows
    FROM marked GROUP BY ProductName""",
    "late_rows": f"{_LATE} SELECT SalesId, late FROM marked",
    "processing_time_totals": _windows(
        "30 SECONDS",
        f"SELECT *, EventProcessingTime + to_seconds(arrival % 25) AS arrived FROM ({_EVENTS})",
        time="arrived",
    ),
    "table_readback": f"""
    SELECT ProductName, count(*) AS sales, CAST(sum(amount) AS BIGINT) AS amount,
           max(EventProcessingTime) AS last_sale
    FROM ({_orders()}) GROUP BY ProductName""",
    "stream_running_total": _running(_orders()),
    "stream_processing_time_totals": f"""
    SELECT ProductName, {_WRAP.format("sum(amount)")} AS amount, true AS aligned,
           true AS windows_once, true AS ids_once
    FROM ({_EVENTS}) GROUP BY ProductName""",
    "stream_event_time_totals": _windows("30 SECONDS", wait="10 SECONDS"),
    "land_with_quarantine": f"""
    SELECT CASE WHEN reason = 'good' THEN SalesId END AS SalesId,
           CASE WHEN reason = 'good' THEN amount END AS SalesAmount, reason
    FROM (SELECT *, CASE WHEN arrival % 97 = 0 THEN 'corrupt' WHEN arrival % 101 = 0 THEN 'empty'
                         WHEN arrival % 103 = 0 THEN 'no record' ELSE 'good' END AS reason
          FROM ({_orders()}))
    WHERE reason <> 'no record'""",
    "stream_resumed": _running(_orders()),
    "stream_event_time_totals_batches": _windows("30 SECONDS", wait="10 SECONDS"),
    "stream_late_dropped": _windows("30 SECONDS", _HELD_BACK, wait="10 SECONDS"),
    "stream_late_records": f"""{_TWO_RUNS}
    SELECT ProductName, SalesId, CAST(amount AS BIGINT) AS amount FROM timed WHERE held AND over <= c1
    UNION ALL
    SELECT ProductName, NULL, CAST(sum(amount) AS BIGINT) FROM timed
    WHERE NOT (held AND over <= c1) AND over <= c2 GROUP BY ProductName""",
    "stream_late_counted": f"{_TWO_RUNS} SELECT count(*) AS late_rows FROM timed WHERE held AND over <= c1",
    "stream_refires": f"""{_TWO_RUNS},
    fired AS (
        SELECT ProductName, start, over, sum(amount) AS total FROM timed
        WHERE NOT held AND over <= c1 GROUP BY ALL
        UNION ALL
        SELECT ProductName, start, over, sum(amount) AS total FROM timed
        WHERE over <= c1 AND over + INTERVAL 1 DAY > c1 GROUP BY ALL HAVING bool_or(held)
        UNION ALL
        SELECT ProductName, start, over, sum(amount) AS total FROM timed
        WHERE over > c1 AND over <= c2 GROUP BY ALL)
    SELECT md5(concat_ws('~', ProductName, epoch_us(start))) AS SalesId, ProductName, start AS WindowStartTime,
           CAST(total AS INTEGER) AS SalesAmount, over AS WindowEndTime
    FROM fired""",
    "stream_state_snapshot": _snapshot(_orders()),
    "stream_totals_beside_quarantine": f"""
    WITH marked AS (
        SELECT *, CASE WHEN arrival % 97 = 0 THEN 'corrupt' WHEN arrival % 101 = 0 THEN 'empty'
                       WHEN arrival % 103 = 0 THEN 'no record' ELSE 'good' END AS kind
        FROM ({_orders()})),
    clock AS (SELECT max(EventProcessingTime) - INTERVAL 10 SECONDS AS c FROM marked WHERE kind = 'good')
    SELECT kind, count(*) AS n FROM marked WHERE kind <> 'no record' GROUP BY kind
    UNION ALL
    SELECT 'window amount', CAST(sum(amount) AS BIGINT) FROM marked, clock
    WHERE kind = 'good' AND time_bucket(INTERVAL 30 DAYS, EventProcessingTime, TIMESTAMP '1970-01-01') + INTERVAL 30 DAYS <= c""",
}
