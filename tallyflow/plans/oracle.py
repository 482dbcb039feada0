"""Independent DuckDB SQL for every registered batch query.

Written directly against the driver's tables (views ``orders``,
``lineitem``, ``events``), not generated from the Spark plans. Sums are
taken over BIGINT cents and cast back from HUGEINT; money is divided once,
at the end; truncation is spelled ``trunc`` because DuckDB's cast rounds,
and milliseconds are ``epoch_us // 1000`` because ``epoch_ms`` rounds.
"""

from __future__ import annotations

from tallyflow.constants import DEFAULT_TEAM
from tallyflow.sources.tables import REDELIVERY_OFFSET

ORDERS_V = """SELECT o_orderkey AS order_id, epoch_us(o_orderdate) // 1000 AS create_time_ms,
       o_totalprice AS total_price, CAST(o_orderkey % 2 AS INTEGER) AS platform,
       o_orderstatus AS order_status
FROM orders"""

PAYMENTS_LI = """SELECT l_orderkey AS order_id, l_extendedprice AS pay_amount,
       CAST(l_linenumber % 4 AS INTEGER) AS pay_source,
       CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS pay_platform,
       epoch_us(l_shipdate) // 1000 AS create_time_ms
FROM lineitem"""

ORDERS_EV = """SELECT event_id AS arrival, user_id AS order_id, epoch_us(ts) // 1000 AS create_time_ms,
       CAST(event_id % 2 AS INTEGER) AS platform
FROM events WHERE event_type = 'signup'"""

PAYMENTS_V = """SELECT event_id AS arrival, user_id AS order_id, value AS pay_amount,
       CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 ELSE 3 END AS pay_source,
       CAST((event_id % 3) % 2 AS INTEGER) AS pay_platform, epoch_us(ts) // 1000 AS create_time_ms
FROM events WHERE event_type <> 'signup'"""


def _norm(src: str) -> str:
    return (
        "SELECT *, CAST(CAST(pay_amount AS DECIMAL(18,2)) * 100 AS BIGINT) AS amount_cents, "
        f"create_time_ms // 60000 AS minute FROM {src}"
    )


def _redelivered(src: str) -> str:
    return f"SELECT * FROM {src} UNION ALL SELECT * REPLACE (arrival + {REDELIVERY_OFFSET} AS arrival) FROM {src}"


WITH_ALL = f"""WITH orders_v AS ({ORDERS_V}),
payments_li AS ({PAYMENTS_LI}),
orders_ev AS ({ORDERS_EV}),
payments_v AS ({PAYMENTS_V}),
pay_li AS ({_norm('payments_li')}),
pay_v AS ({_norm('payments_v')}),
pay_re AS ({_norm('(' + _redelivered('payments_v') + ')')}),
first_ev AS (SELECT order_id, arg_min(platform, arrival) AS platform, min(arrival) AS first_arrival
             FROM orders_ev GROUP BY order_id),
first_v AS (SELECT order_id, arg_min(platform, create_time_ms) AS platform FROM orders_v GROUP BY order_id)
"""


def _q(body: str) -> str:
    return WITH_ALL + body


def _turnover(pay: str, first: str, distinct: bool) -> str:
    src = (
        f"(SELECT DISTINCT order_id, amount_cents, pay_source, pay_platform, minute FROM {pay})"
        if distinct
        else pay
    )
    return f"""SELECT f.platform, p.minute, CAST(SUM(p.amount_cents) AS BIGINT) AS turnover_cents,
       CAST(SUM(p.amount_cents) AS DOUBLE) / 100.0 AS turnover
FROM {src} p JOIN {first} f ON p.order_id = f.order_id
GROUP BY f.platform, p.minute"""


_DEVICE = """SELECT minute,
       CAST(SUM(CASE WHEN pay_platform = 0 THEN amount_cents ELSE 0 END) AS BIGINT) AS pc_cents,
       CAST(SUM(CASE WHEN pay_platform <> 0 THEN amount_cents ELSE 0 END) AS BIGINT) AS wl_cents
FROM pay_v GROUP BY minute"""

_CUMULATIVE = f"""SELECT minute, pc_cents, wl_cents,
       CAST(SUM(pc_cents) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_pc_cents,
       CAST(SUM(wl_cents) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_wl_cents
FROM ({_DEVICE})"""

_RATIO = f"""SELECT minute, cum_pc_cents, cum_wl_cents,
       CAST(cum_wl_cents AS DOUBLE) / CAST(cum_pc_cents AS DOUBLE) AS ratio
FROM ({_CUMULATIVE}) WHERE cum_pc_cents <> 0"""

# Runs of consecutive minutes per device: minute - row_number() is constant
# inside a run (gaps-and-islands).
_RESET_TMPL = """, per AS (
  SELECT CASE WHEN pay_platform = 0 THEN 0 ELSE 1 END AS device, minute, SUM(amount_cents) AS cents
  FROM {src} GROUP BY 1, 2),
runs AS (
  SELECT device, minute, cents,
         minute - ROW_NUMBER() OVER (PARTITION BY device ORDER BY minute) AS island
  FROM per),
tot AS (
  SELECT device, minute,
         CAST(SUM(cents) OVER (PARTITION BY device, island ORDER BY minute
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run_cents
  FROM runs),
pc AS (SELECT minute, run_cents AS pc_run FROM tot WHERE device = 0),
wl AS (SELECT minute, run_cents AS wl_run FROM tot WHERE device = 1)
SELECT COALESCE(pc.minute, wl.minute) AS minute, pc.pc_run, wl.wl_run,
       CASE WHEN pc.pc_run IS NULL THEN 1.7976931348623157e308
            ELSE CAST(COALESCE(wl.wl_run, 0) AS DOUBLE) / CAST(pc.pc_run AS DOUBLE) END AS ratio
FROM pc FULL OUTER JOIN wl ON pc.minute = wl.minute"""
_RESET = _RESET_TMPL.format(src="pay_v")

_MIXED = """SELECT CASE WHEN event_type = 'signup'
                 THEN CASE WHEN event_id % 2 = 0 THEN 'taobao_orders' ELSE 'tmall_orders' END
                 ELSE 'pay' END AS topic,
            event_id AS arrival, user_id AS order_id, props
     FROM events"""

_METRICS = f""", turnover AS ({_turnover('pay_v', 'first_ev', True)}),
ratio AS ({_RATIO}),
metrics AS (
  SELECT CASE WHEN platform = 0 THEN 'platformTaobao_' ELSE 'platformTmall_' END
         || '{DEFAULT_TEAM}_' || CAST(minute * 60 AS VARCHAR) AS key, turnover AS value FROM turnover
  UNION ALL
  SELECT 'ratio_{DEFAULT_TEAM}_' || CAST(minute * 60 AS VARCHAR) AS key, ratio AS value FROM ratio)
"""


def _changed(src: str) -> str:
    """D2 as a CTE named ``changed``."""
    return f""", f AS (
  SELECT arrival, order_id, minute, amount_cents, pay_platform,
         CAST(amount_cents AS BIGINT) | (CAST(pay_source AS BIGINT) << 10)
         | (CAST(pay_platform AS BIGINT) << 11) | CAST(minute AS BIGINT) AS fingerprint
  FROM {src}),
l AS (SELECT *, LAG(fingerprint) OVER (PARTITION BY order_id ORDER BY arrival) AS prev FROM f),
changed AS (SELECT arrival, order_id, minute, amount_cents, pay_platform, fingerprint FROM l
            WHERE prev IS NULL OR prev <> fingerprint)"""


def _ratio_keys(event_type: str) -> str:
    return (
        f"SELECT 'ratio_{DEFAULT_TEAM}_' || CAST((epoch_us(ts) // 1000 // 60000) * 60 AS VARCHAR) AS key "
        f"FROM events WHERE event_type = '{event_type}'"
    )


ORACLE_SQL: dict[str, str] = {
    "payments_normalised": _q(
        "SELECT order_id, amount_cents, pay_source, pay_platform, minute, minute * 60 AS minute_s FROM pay_li"
    ),
    "payments_truncated": _q(
        """SELECT order_id, CAST(trunc(pay_amount * 100) AS BIGINT) AS amount_cents, pay_source, pay_platform,
       create_time_ms // 60000 AS minute FROM payments_li"""
    ),
    "decoded_payments": _q(
        """SELECT arrival, order_id, pay_source,
       CASE pay_source WHEN 0 THEN 'alipay' WHEN 1 THEN 'voucher' WHEN 2 THEN 'unionpay' WHEN 3 THEN 'other' END AS source_label,
       pay_platform, CASE WHEN pay_platform = 0 THEN 'pc' ELSE 'wireless' END AS device_label
FROM payments_v"""
    ),
    "topic_routing": _q(
        f""", mixed AS ({_MIXED})
SELECT arrival, order_id, topic,
       CASE topic WHEN 'taobao_orders' THEN 0 WHEN 'tmall_orders' THEN 1 END AS platform,
       CASE topic WHEN 'taobao_orders' THEN 'taobao' WHEN 'tmall_orders' THEN 'tmall' END AS platform_name
FROM mixed"""
    ),
    "drop_end_markers": _q(
        f""", mixed AS ({_MIXED})
SELECT topic, arrival, CAST(octet_length(encode(props)) AS INTEGER) AS body_bytes, TRUE AS complete FROM mixed"""
    ),
    "delimited_orders": _q("SELECT arrival, order_id, create_time_ms, platform FROM orders_ev"),
    "exact_arith": _q(
        """, d AS (
  SELECT l_orderkey, l_linenumber,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_tax AS DECIMAL(18,2)) AS t,
         CAST(l_discount AS DECIMAL(18,2)) AS dc, CAST(l_quantity AS DECIMAL(18,2)) AS q
  FROM lineitem),
i AS (SELECT *, CAST(p * 100 AS HUGEINT) AS pi, CAST(q * 100 AS HUGEINT) AS qi FROM d)
SELECT l_orderkey AS order_id, l_linenumber AS line,
       CAST(p + t AS DOUBLE) AS sum_v,
       CAST(p - dc AS DOUBLE) AS diff_v,
       CAST(p * dc AS DOUBLE) AS prod_v,
       CAST((2 * pi * 10000000000 + qi) // (2 * qi) AS DOUBLE) / 10000000000.0 AS quot_v,
       CAST(round(p * dc, 2) AS DOUBLE) AS rounded_v
FROM i"""
    ),
    # p * 1e6 and dc * 1e-8: their sum and difference differ from p * 1e6 by
    # far less than half a unit of a double, their product is p * dc / 100.
    "exact_arith_wide": _q(
        """, d AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) AS pi,
         CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS HUGEINT) AS di
  FROM lineitem)
SELECT l_orderkey AS order_id, l_linenumber AS line, CAST(pi * 10000 AS DOUBLE) AS sum_v,
       CAST(pi * 10000 AS DOUBLE) AS diff_v, CAST(pi * di AS DOUBLE) / 1000000.0 AS prod_v
FROM d"""
    ),
    "rejected_payments": _q(
        """SELECT arrival, order_id, pay_amount - CAST(20 AS DOUBLE) AS pay_amount, 'negative' AS reason
FROM payments_v WHERE pay_amount - CAST(20 AS DOUBLE) < 0"""
    ),
    "delimited_check": _q(
        "SELECT CAST(COUNT(*) AS BIGINT) AS declared, CAST(COUNT(*) AS BIGINT) AS found, TRUE AS ok FROM orders_ev"
    ),
    "fingerprints": _q(
        """SELECT arrival, order_id,
       CAST(amount_cents AS BIGINT) | (CAST(pay_source AS BIGINT) << 10) | (CAST(pay_platform AS BIGINT) << 11)
       | CAST(minute AS BIGINT) AS fingerprint
FROM pay_v"""
    ),
    "positive_payments": _q("SELECT arrival, order_id, pay_amount FROM payments_v WHERE pay_amount > 0"),
    "order_reconciliation": _q(
        """, paid AS (SELECT order_id, CAST(SUM(amount_cents) AS BIGINT) AS paid_cents, COUNT(*) AS n_payments
             FROM pay_li GROUP BY order_id),
tot AS (SELECT order_id, CAST(CAST(total_price AS DECIMAL(18,2)) * 100 AS BIGINT) AS total_cents FROM orders_v)
SELECT t.order_id, t.total_cents, COALESCE(p.paid_cents, 0) AS paid_cents,
       CAST(COALESCE(p.n_payments, 0) AS BIGINT) AS n_payments,
       t.total_cents - COALESCE(p.paid_cents, 0) AS diff_cents
FROM tot t LEFT JOIN paid p ON t.order_id = p.order_id
WHERE t.total_cents - COALESCE(p.paid_cents, 0) <> 0"""
    ),
    "matched_payments": _q(
        """SELECT p.arrival, p.order_id, p.amount_cents, p.pay_source, p.pay_platform, p.minute, f.platform
FROM pay_v p JOIN first_ev f ON p.order_id = f.order_id"""
    ),
    "platform_payments": _q(
        """SELECT p.arrival, p.order_id, p.amount_cents, f.platform
FROM pay_v p JOIN first_ev f ON p.order_id = f.order_id WHERE f.platform = 1"""
    ),
    "first_orders": _q("SELECT order_id, platform, first_arrival FROM first_ev"),
    "pending_payments": _q(
        """SELECT order_id, amount_cents, pay_source, pay_platform, minute FROM pay_li p
WHERE NOT EXISTS (SELECT 1 FROM orders_v o WHERE o.order_id = p.order_id AND o.order_status <> 'P')"""
    ),
    "set_matched": _q(
        """, s AS (SELECT order_id, MIN(platform) AS platform FROM orders_ev GROUP BY order_id)
SELECT p.arrival, p.order_id, p.amount_cents, s.platform FROM pay_v p JOIN s ON p.order_id = s.order_id"""
    ),
    "arrived_matched": _q(
        """, s AS (SELECT order_id, platform, MIN(arrival) AS seen FROM orders_ev GROUP BY order_id, platform)
SELECT p.arrival, p.order_id, p.amount_cents, s.platform
FROM pay_v p JOIN s ON p.order_id = s.order_id AND p.arrival > s.seen"""
    ),
    "distinct_payments": _q(
        "SELECT DISTINCT order_id, amount_cents, pay_source, pay_platform, minute FROM pay_re"
    ),
    "changed_payments": _q(_changed("pay_re") + "\nSELECT * FROM changed"),
    "wireless_pc_ratio_reset_changed": _q(_changed("pay_v") + _RESET_TMPL.format(src="changed")),
    "platform_minute_turnover": _q(_turnover("pay_li", "first_v", True)),
    "platform_minute_turnover_events": _q(_turnover("pay_re", "first_ev", True)),
    "device_minute_turnover": _q(_DEVICE),
    "minute_turnover_nodedup": _q(_turnover("pay_re", "first_ev", False)),
    "minutes_seen": _q(
        "SELECT COUNT(DISTINCT minute) AS minutes, 181 AS expected, COUNT(DISTINCT minute) >= 181 AS complete FROM pay_v"
    ),
    "cumulative_turnover": _q(_CUMULATIVE),
    "wireless_pc_ratio": _q(_RATIO),
    "wireless_pc_ratio_reset": _q(_RESET),
    "metrics_rows": _q(_METRICS + "SELECT key, value FROM metrics"),
    "lookup_metrics": _q(
        _METRICS + f"SELECT key, value FROM metrics WHERE key IN ({_ratio_keys('purchase')})"
    ),
    "remove_metrics": _q(
        _METRICS + f"SELECT key, value FROM metrics WHERE key NOT IN ({_ratio_keys('error')})"
    ),
    "stream_turnover": _q(_METRICS + "SELECT key, value FROM metrics WHERE key NOT LIKE 'ratio%'"),
    "stream_upsert": _q(_METRICS + "SELECT key, value FROM metrics WHERE key NOT LIKE 'ratio%'"),
    "stream_ratio": _q(_METRICS + "SELECT key, value FROM metrics WHERE key LIKE 'ratio%'"),
}

# Streaming D2 must equal batch D2 on the same (redelivered) feed.
ORACLE_SQL["stream_changed_payments"] = ORACLE_SQL["changed_payments"]
ORACLE_SQL["stream_matched_payments"] = ORACLE_SQL["matched_payments"]
ORACLE_SQL["stream_live_matched"] = ORACLE_SQL["matched_payments"]
ORACLE_SQL["stream_pending_payments"] = ORACLE_SQL["pending_payments"]
ORACLE_SQL["stream_arrived_matched"] = ORACLE_SQL["arrived_matched"]

# Append mode publishes a minute once the watermark (newest minute start
# minus 6 minutes) reaches the end of its window: minutes up to newest - 7.
ORACLE_SQL["stream_closed_minutes"] = _q(
    ", t AS (" + _turnover("pay_v", "first_ev", True) + ")\n"
    "SELECT platform, minute, turnover_cents, turnover FROM t WHERE minute <= (SELECT MAX(minute) FROM t) - 7"
)
for _name in ("stream_snapshot_full", "stream_snapshot_changed"):
    ORACLE_SQL[_name] = ORACLE_SQL["stream_turnover"]
# Late payments count from the newest matched minute - 5 on.
ORACLE_SQL["stream_late"] = _q(
    f""", newest AS (SELECT MAX(p.minute) AS m FROM pay_v p JOIN first_ev f ON p.order_id = f.order_id),
late AS ({_norm('(SELECT * REPLACE (pay_amount + CAST(0.01 AS DOUBLE) AS pay_amount) FROM payments_v)')}),
both_v AS (SELECT * FROM pay_v UNION ALL SELECT late.* FROM late, newest WHERE minute >= m - 5),
turnover AS ({_turnover('both_v', 'first_ev', True)})
SELECT CASE WHEN platform = 0 THEN 'platformTaobao_' ELSE 'platformTmall_' END
       || '{DEFAULT_TEAM}_' || CAST(minute * 60 AS VARCHAR) AS key, turnover AS value FROM turnover"""
)
ORACLE_SQL["stream_metrics"] = ORACLE_SQL["metrics_rows"]
# Streaming W3 publishes the batch W3 ratio of every minute under its key.
ORACLE_SQL["stream_ratio_reset"] = _q(
    _RESET_TMPL.format(src="pay_v").replace(
        "\nSELECT COALESCE(pc.minute, wl.minute) AS minute,",
        ",\nw3 AS (SELECT COALESCE(pc.minute, wl.minute) AS minute,",
    )
    + f")\nSELECT 'ratio_{DEFAULT_TEAM}_' || CAST(minute * 60 AS VARCHAR) AS key, ratio AS value FROM w3"
)
