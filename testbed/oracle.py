"""The SQL side: the same feeds and tables as ``adapters.py``, as named subqueries.

``sql("a", "b", body="SELECT ...")`` puts the needed subqueries in front of a body.
"""

from __future__ import annotations


def text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def day(expression: str) -> str:
    return f"CAST(CAST({expression} AS DATE) AS VARCHAR)"


def moment(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def seconds(expression: str) -> str:
    return f"CAST(floor(epoch({expression})) AS BIGINT)"


def count_if(predicate: str) -> str:
    return f"CAST(SUM(CASE WHEN {predicate} THEN 1 ELSE 0 END) AS BIGINT)"


def latest(source: str, key: str, order: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {order}) AS rank_ "
        f"FROM {source}) WHERE rank_ = 1"
    )


FRAME = "RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW"


def features(source: str) -> str:
    """Seven-day features of approved payments, with segment and category joined."""
    return f"""
    SELECT w.*, m.category, c.risk_segment, txn_count_7d > 12 AS high_velocity,
           w.amount > 4 * w.avg_amount_7d AS amount_spike
    FROM (
        SELECT payment_id, customer_id, merchant_id, amount, transaction_date, dt,
               COUNT(*) OVER frame AS txn_count_7d, SUM(amount) OVER frame AS amount_7d,
               AVG(amount) OVER frame AS avg_amount_7d,
               s - LAG(s) OVER (PARTITION BY customer_id ORDER BY s, payment_id) AS seconds_since_prev
        FROM (SELECT *, {seconds("transaction_date")} AS s FROM {source} WHERE status = 'approved')
        WINDOW frame AS (PARTITION BY customer_id ORDER BY s {FRAME})
    ) w
    LEFT JOIN merchants m ON w.merchant_id = m.merchant_id
    LEFT JOIN customers c ON w.customer_id = c.customer_id"""


def _children(prefix: str, entity: str, day_column: str, extra: str = "") -> str:
    ids = " || '-' || ".join(text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return f"""
    SELECT '{prefix}' || {ids} AS {entity}_id,
           'P' || {text("l_orderkey")} || '-' || {text("l_linenumber")} AS payment_id,
           l_extendedprice AS amount, l_shipdate AS {day_column}, l_shipdate AS updated_at,
           CAST(l_shipdate AS DATE) AS dt, l_quantity, l_linenumber, l_discount {extra}
    FROM lineitem WHERE l_returnflag = 'R'"""


def _checked(source: str, days: int) -> str:
    """Children with their payment, looked up from ``days`` before the day they came in."""
    return f"""
    SELECT r.*, p.payment_id IS NOT NULL AS payment_found, COALESCE(r.amount > p.amount, FALSE) AS exceeds
    FROM {source} r LEFT JOIN payments p ON r.payment_id = p.payment_id AND p.dt >= r.dt - {days}"""



def _validation(prefix: str, source: str) -> dict[str, tuple[tuple[str, ...], str]]:
    """Typing and all checks of a payment feed, under names with a prefix."""
    return {
        f"{prefix}typed": ((source,), rf"""
    SELECT * REPLACE (
               CASE WHEN isnan(TRY_CAST(amount AS DOUBLE)) THEN NULL ELSE TRY_CAST(amount AS DOUBLE) END AS amount,
               CASE WHEN regexp_matches(transaction_date, '^\s*\d{{4}}-\d{{1,2}}-\d{{1,2}}')
                    THEN TRY_CAST(transaction_date AS TIMESTAMP) END AS transaction_date,
               CAST(updated_at AS TIMESTAMP) AS updated_at,
               COALESCE(currency, 'COP') AS currency),
           amount AS raw_amount, transaction_date AS raw_date, currency AS raw_currency
    FROM {source}"""),
        f"{prefix}dated": ((f"{prefix}typed",), f"""
    SELECT *, CAST(transaction_date AS DATE) AS dt FROM {prefix}typed"""),
        f"{prefix}reasoned": ((f"{prefix}dated", "known"), f"""
    SELECT d.*, concat_ws(',',
        CASE WHEN trim(COALESCE(customer_id, '')) = '' THEN 'customer_id:missing' END,
        CASE WHEN trim(COALESCE(raw_amount, '')) = '' THEN 'amount:missing' WHEN amount IS NULL
             THEN 'amount:invalid_type' WHEN amount < 0.01 THEN 'amount:below_min' END,
        CASE WHEN payment_method NOT IN ('card', 'pse', 'wallet', 'transfer')
             THEN 'payment_method:not_allowed' END,
        CASE WHEN transaction_date IS NULL THEN 'transaction_date:invalid_type' END,
        CASE WHEN currency NOT IN ('COP', 'USD') THEN 'currency:not_allowed' END) AS contract_reasons,
        CASE WHEN merchant_id NOT IN (SELECT merchant_id FROM known) THEN 'merchant_id:unknown' END AS merchant_reason,
        CASE WHEN dt < ingest_date - 7 THEN 'late:out_of_window' END AS late_reason
    FROM {prefix}dated d"""),
        f"{prefix}validated": ((f"{prefix}reasoned",), f"""
    SELECT *, concat_ws(',', NULLIF(contract_reasons, ''), merchant_reason, late_reason) AS reasons
    FROM {prefix}reasoned"""),
    }


def _landed_children(entity: str, prefix: str, of_type: str, from_k: int, days: int, extra: str = "") -> str:
    return f"""
    SELECT '{prefix}' || {text("event_id")} AS {entity}_id, 'E' || {text("event_id")} AS payment_id,
           CASE WHEN k = 88 THEN value * 2 + 1 ELSE value END AS amount,
           ts + INTERVAL {days} DAY AS {entity}_date, CAST(ts + INTERVAL {days} DAY AS DATE) AS dt {extra}
    FROM numbered WHERE event_type = '{of_type}' AND k >= {from_k}"""


def _landed_accepted(source: str, days: int) -> str:
    return f"""
    SELECT c.*, p.payment_id IS NOT NULL AS payment_found
    FROM {source} c LEFT JOIN landed_payments p ON c.payment_id = p.payment_id AND p.dt >= c.dt - {days}
    WHERE c.amount >= 0.01 AND COALESCE(c.amount <= p.amount, TRUE)"""


# name: (subqueries it needs, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    # ------------------------------------------------------------- dimensions
    "merchants": ((), f"""
    SELECT 'M' || {text("s_suppkey")} AS merchant_id, s_name AS name,
           CASE n_regionkey WHEN 0 THEN 'retail' WHEN 1 THEN 'food' WHEN 2 THEN 'transport'
                            WHEN 3 THEN 'marketplace' WHEN 4 THEN 'services' END AS category,
           n_name AS city, CASE WHEN s_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status,
           TIMESTAMP '1995-01-01 00:00:00' AS updated_at, s_acctbal
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey"""),
    "customers": ((), f"""
    SELECT 'C' || {text("c_custkey")} AS customer_id,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'CE' WHEN 'FURNITURE' THEN 'NIT' WHEN 'MACHINERY' THEN 'PP'
                             ELSE 'CC' END AS document_type,
           {text("c_custkey")} AS document_number, n_name AS city,
           CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_segment,
           TIMESTAMP '1995-01-01 00:00:00' AS created_at, TIMESTAMP '1995-01-01 00:00:00' AS updated_at
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""),
    # ------------------------------------------------------------------- shop
    "payment_versions": ((), f"""
    SELECT 'P' || {text("l_orderkey")} || '-' || {text("l_linenumber")} AS payment_id,
           'C' || {text("o_custkey")} AS customer_id, 'M' || {text("l_suppkey")} AS merchant_id,
           l_extendedprice AS amount,
           CASE o_orderpriority WHEN '2-HIGH' THEN 'pse' WHEN '3-MEDIUM' THEN 'wallet'
                                WHEN '4-NOT SPECIFIED' THEN 'transfer' ELSE 'card' END AS payment_method,
           o_orderdate AS transaction_date,
           CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'N' THEN 'pending' ELSE 'declined' END AS status,
           l_shipdate AS updated_at,
           CASE WHEN l_tax >= 0.07 THEN 'USD' WHEN l_tax >= 0.01 THEN 'COP' END AS currency,
           CASE o_orderstatus WHEN 'F' THEN 'app' WHEN 'O' THEN 'web' ELSE 'pos' END AS channel,
           CAST(o_orderdate AS DATE) AS dt, CAST(l_shipdate AS DATE) AS ingest_day, l_partkey, l_suppkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "payments": (("payment_versions",), latest(
        "payment_versions", "payment_id", "updated_at DESC, l_partkey DESC, l_suppkey DESC"
    )),
    "refund_versions": ((), _children("R", "refund", "refund_date")),
    "refunds_checked": (("refund_versions", "payments"), _checked("refund_versions", 30)),
    "refunds": (("refunds_checked",), "SELECT * FROM refunds_checked WHERE NOT exceeds"),
    "chargeback_versions": ((), _children("B", "chargeback", "chargeback_date", """,
           CASE l_linenumber WHEN 1 THEN 'fraud' WHEN 2 THEN 'not_received' WHEN 3 THEN 'duplicate'
                             WHEN 4 THEN 'not_as_described' ELSE 'other' END AS reason""")
        + " AND l_discount >= 0.09"),
    "chargebacks_checked": (("chargeback_versions", "payments"), _checked("chargeback_versions", 60)),
    "chargebacks": (("chargebacks_checked",), "SELECT * FROM chargebacks_checked WHERE NOT exceeds"),
    "features": (("payments", "merchants", "customers"), features("payments")),
    "fct_payments": (("payments", "merchants", "customers", "features"), """
    SELECT p.payment_id, p.customer_id, p.merchant_id, m.category AS merchant_category, c.risk_segment,
           p.payment_method, p.channel, p.status, COALESCE(p.currency, 'COP') AS currency, p.amount,
           CASE WHEN p.currency = 'USD' THEN p.amount * 4000 ELSE p.amount END AS amount_cop,
           p.transaction_date, p.dt AS transaction_day, COALESCE(f.high_velocity, FALSE) AS flag_high_velocity,
           COALESCE(f.amount_spike, FALSE) AS flag_amount_spike, p.updated_at
    FROM payments p
    LEFT JOIN merchants m ON p.merchant_id = m.merchant_id
    LEFT JOIN customers c ON p.customer_id = c.customer_id
    LEFT JOIN features f ON p.payment_id = f.payment_id"""),
    "fct_refunds": (("refunds", "payments"), """
    SELECT r.refund_id, r.payment_id, r.amount, r.refund_date, r.dt AS refund_day, r.payment_found,
           CASE WHEN p.currency = 'USD' THEN r.amount * 4000 ELSE r.amount END AS amount_cop,
           p.amount AS payment_amount, p.dt AS payment_day
    FROM refunds r LEFT JOIN payments p ON r.payment_id = p.payment_id"""),
    "fct_chargebacks": (("chargebacks", "payments"), """
    SELECT b.chargeback_id, b.payment_id, b.reason, b.amount, b.chargeback_date, b.dt AS chargeback_day,
           b.payment_found,
           CASE WHEN p.currency = 'USD' THEN b.amount * 4000 ELSE b.amount END AS amount_cop,
           p.merchant_id, p.customer_id, p.dt AS payment_day, date_diff('day', p.dt, b.dt) AS days_to_chargeback
    FROM chargebacks b LEFT JOIN payments p ON b.payment_id = p.payment_id"""),
    "daily_payments": (("fct_payments",), f"""
    SELECT transaction_day AS fecha, COUNT(*) AS pagos, {count_if("status = 'approved'")} AS pagos_aprobados,
           ROUND(SUM(CASE WHEN status = 'approved' THEN amount_cop ELSE 0 END), 2) AS tpv_cop,
           COUNT(DISTINCT customer_id) AS clientes_activos
    FROM fct_payments GROUP BY transaction_day"""),
    "daily_refunds": (("fct_refunds",), """
    SELECT refund_day AS fecha, COUNT(*) AS devoluciones, ROUND(SUM(amount_cop), 2) AS devoluciones_cop
    FROM fct_refunds GROUP BY refund_day"""),
    "daily_chargebacks": (("fct_chargebacks",), """
    SELECT chargeback_day AS fecha, COUNT(*) AS contracargos, ROUND(SUM(amount_cop), 2) AS contracargos_cop
    FROM fct_chargebacks GROUP BY chargeback_day"""),
    "indicadores": (("daily_payments", "daily_refunds", "daily_chargebacks"), """
    SELECT p.fecha, p.pagos, p.pagos_aprobados,
           CAST(p.pagos_aprobados AS DOUBLE) / NULLIF(p.pagos, 0) AS tasa_aprobacion, p.tpv_cop,
           p.tpv_cop / NULLIF(p.pagos_aprobados, 0) AS ticket_promedio_cop, p.clientes_activos,
           COALESCE(d.devoluciones, 0) AS devoluciones, COALESCE(d.devoluciones_cop, 0) AS devoluciones_cop,
           COALESCE(d.devoluciones_cop, 0) / NULLIF(p.tpv_cop, 0) AS tasa_devolucion,
           COALESCE(c.contracargos, 0) AS contracargos,
           COALESCE(c.contracargos_cop, 0) / NULLIF(p.tpv_cop, 0) AS tasa_contracargos
    FROM daily_payments p
    LEFT JOIN daily_refunds d ON p.fecha = d.fecha
    LEFT JOIN daily_chargebacks c ON p.fecha = c.fecha"""),
    # ------------------------------------------------------------------- feed
    "numbered": ((), "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events"),
    "feed": (("numbered",), f"""
    SELECT 'E' || {text("event_id")} AS payment_id,
           CASE WHEN k = 97 THEN '  ' WHEN k = 96 THEN NULL ELSE 'C' || {text("user_id")} END AS customer_id,
           'M' || {text("k")} AS merchant_id,
           CASE WHEN k = 99 THEN 'mil pesos' WHEN k = 98 THEN '-' || {text("value")} WHEN k = 95 THEN 'NaN'
                ELSE {text("value")} END AS amount,
           CASE event_type WHEN 'view' THEN 'card' WHEN 'click' THEN 'pse' WHEN 'purchase' THEN 'wallet'
                WHEN 'signup' THEN 'transfer' ELSE CASE WHEN k < 10 THEN 'crypto' ELSE 'card' END
           END AS payment_method,
           CASE WHEN k = 94 THEN strftime(ts, '%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
               AS transaction_date,
           CASE event_type WHEN 'error' THEN 'declined' WHEN 'signup' THEN 'pending' ELSE 'approved' END AS status,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at,
           CASE WHEN k < 20 THEN 'USD' WHEN k < 30 THEN NULL WHEN k = 93 THEN 'EUR' WHEN k = 92 THEN ''
                ELSE 'COP' END AS currency,
           CASE event_type WHEN 'view' THEN 'web' WHEN 'click' THEN 'app' WHEN 'purchase' THEN 'pos' END AS channel,
           CAST(ts AS DATE) + CASE WHEN k = 91 THEN 10 WHEN k BETWEEN 85 AND 90 THEN 2 ELSE 0 END AS ingest_date,
           k, ts, event_type
    FROM numbered"""),
    "event_payments": (("numbered",), f"""
    SELECT 'E' || {text("event_id")} AS payment_id, 'C' || {text("user_id")} AS customer_id,
           'M' || {text("k")} AS merchant_id, value AS amount, ts AS transaction_date,
           CASE event_type WHEN 'error' THEN 'declined' WHEN 'signup' THEN 'pending' ELSE 'approved' END AS status,
           CAST(ts AS DATE) AS dt
    FROM numbered"""),
    "event_features": (("event_payments", "merchants", "customers"), features("event_payments")),
    # ---------------------------------------------------------------- run log
    "task_runs": (("numbered",), f"""
    SELECT 'R' || strftime(ts, '%Y%m%d%H') AS run_id,
           CASE event_type WHEN 'view' THEN 'bronze.payments' WHEN 'click' THEN 'silver.payments'
                WHEN 'purchase' THEN 'silver.refunds' WHEN 'signup' THEN 'features' ELSE 'publish' END AS task,
           CASE event_type WHEN 'view' THEN 'bronze' WHEN 'click' THEN 'silver' WHEN 'purchase' THEN 'silver'
                WHEN 'signup' THEN 'features' ELSE 'publish' END AS stage,
           {day("ts")} AS ingest_date,
           ROW_NUMBER() OVER (PARTITION BY strftime(ts, '%Y%m%d%H'), event_type ORDER BY ts, event_id) AS attempt,
           CASE WHEN k < 10 THEN 'failed' WHEN k < 12 THEN 'running' ELSE 'success' END AS status,
           ts AS started_at, CASE WHEN k < 10 OR k >= 12 THEN value END AS duration_s,
           k * 10 AS rows_read, k * 9 AS rows_written, k AS rows_quarantined, k,
           CASE WHEN k < 10 OR k >= 12 THEN value
                ELSE epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(ts) END AS spent
    FROM numbered"""),
    "runs": (("numbered",), f"""
    SELECT run_id, day_, started_at, status, CASE WHEN status <> 'running' THEN end_ END AS finished_at FROM (
        SELECT 'R' || strftime(ts, '%Y%m%d%H') AS run_id, {day("ts")} AS day_, MIN(ts) AS started_at, MAX(ts) AS end_,
               CASE WHEN MAX(k) = 99 THEN 'failed' WHEN MIN(k) = 0 THEN 'running' ELSE 'success' END AS status
        FROM numbered GROUP BY 1, 2)"""),
    "summaries": (("runs", "task_runs"), """
    SELECT r.run_id,
           CASE WHEN r.status = 'running'
                 AND epoch(TIMESTAMP '2024-01-31 00:00:00') - GREATEST(epoch(r.started_at), t.until_) > 1800
                THEN 'interrupted' ELSE r.status END AS status,
           r.started_at, r.finished_at, GREATEST(epoch(r.started_at), t.until_) AS last_, t.*
    FROM runs r LEFT JOIN (
        SELECT run_id AS task_run_id, MAX(epoch(started_at) + spent) AS until_,
               SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failures,
               SUM(CASE WHEN stage = 'bronze' THEN spent END) AS bronze_s,
               SUM(CASE WHEN stage = 'silver' THEN spent END) AS silver_s,
               SUM(CASE WHEN stage = 'features' THEN spent END) AS features_s,
               SUM(CASE WHEN stage = 'publish' THEN spent END) AS publish_s
        FROM task_runs GROUP BY run_id) t ON r.run_id = t.task_run_id"""),
    "units": (("task_runs",), """
    SELECT t.*, f.status, f.rows_read, f.rows_written, f.rows_quarantined
    FROM (SELECT run_id, task, stage, ingest_date, COUNT(*) AS attempts,
                 SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failed_attempts,
                 SUM(CASE WHEN status = 'running' THEN 1 ELSE 0 END) AS running_attempts, SUM(spent) AS seconds_
          FROM task_runs GROUP BY run_id, task, stage, ingest_date) t
    JOIN (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_id, task, ingest_date
                                                      ORDER BY attempt DESC) AS rank_ FROM task_runs)
          WHERE rank_ = 1) f
      ON t.run_id = f.run_id AND t.task = f.task AND t.ingest_date = f.ingest_date"""),
    "stages": (("summaries", "units"), """
    SELECT run_id, stage, position, run_status, expected, COALESCE(units, 0) AS units, COALESCE(done, 0) AS done,
           COALESCE(failed, 0) AS failed, COALESCE(retries, 0) AS retries, COALESCE(running, 0) AS running,
           COALESCE(rows_read, 0) AS rows_read, COALESCE(rows_written, 0) AS rows_written,
           COALESCE(rows_quarantined, 0) AS rows_quarantined
    FROM (
        SELECT s.run_id, s.status AS run_status, w.stage, w.position, w.expected
        FROM summaries s, (VALUES ('bronze', 0, 5), ('silver', 1, 5), ('features', 2, 1), ('dbt', 3, 1),
                                  ('publish', 4, 1)) AS w(stage, position, expected)
    ) wanted LEFT JOIN (
        SELECT run_id AS unit_run_id, stage AS unit_stage, COUNT(*) AS units,
               SUM(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS done,
               SUM(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failed,
               SUM(failed_attempts) AS retries, SUM(running_attempts) AS running,
               SUM(CASE WHEN status = 'success' THEN rows_read END) AS rows_read,
               SUM(CASE WHEN status = 'success' THEN rows_written END) AS rows_written,
               SUM(CASE WHEN status = 'success' THEN rows_quarantined END) AS rows_quarantined
        FROM units GROUP BY run_id, stage
    ) had ON run_id = unit_run_id AND stage = unit_stage"""),
}

PARTS |= {"known": (("merchants",), "SELECT merchant_id FROM merchants WHERE s_acctbal >= 0")}
PARTS |= _validation("", "feed") | _validation("landed_", "landed")

# ------------------------------------------------- landing files and what becomes of them
PARTS |= {
    # The first version has no currency and channel before the 15th; some lines are sent twice;
    # a pending payment is resolved a day later; some lines are cut off.
    "landed_lines": (("feed",), f"""
    SELECT *, event_type = 'error' AND k = 50 AS cut_off FROM (
        SELECT * REPLACE (CASE WHEN ingest_date >= DATE '2024-01-15' THEN currency END AS currency,
                          CASE WHEN ingest_date >= DATE '2024-01-15' THEN channel END AS channel) FROM (
            SELECT * FROM feed
            UNION ALL SELECT * FROM feed WHERE k = 60
            UNION ALL SELECT * REPLACE ('approved' AS status,
                strftime(ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at,
                ingest_date + 1 AS ingest_date) FROM feed WHERE status = 'pending' AND k >= 30))"""),
    "landed": (("landed_lines",), "SELECT * EXCLUDE (cut_off) FROM landed_lines WHERE NOT cut_off"),
    "landed_payments": (("landed_validated",), latest(
        "(SELECT * FROM landed_validated WHERE reasons = '')", "payment_id", "updated_at DESC, ingest_date DESC",
    )),
    "landed_customers": (("customers",), """
    SELECT * REPLACE (CASE WHEN risk_segment <> 'low' THEN TIMESTAMP '2024-01-10 00:00:00'
                           ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at) FROM customers"""),
    "refund_lines": (("numbered",), _landed_children("refund", "R", "purchase", 50, 3)),
    "landed_refunds": (("refund_lines", "landed_payments"), _landed_accepted("refund_lines", 30)),
    "chargeback_lines": (("numbered",), _landed_children("chargeback", "B", "click", 80, 5, """,
           CASE WHEN k < 85 THEN 'fraud' WHEN k < 90 THEN 'duplicate' ELSE 'other' END AS reason""")),
    "landed_chargebacks": (("chargeback_lines", "landed_payments"), _landed_accepted("chargeback_lines", 60)),
    "landed_features": (("landed_payments", "merchants", "customers"), features("landed_payments")),
    "landed_fact": (("landed_payments", "merchants", "customers", "landed_features"), """
    SELECT p.payment_id, p.customer_id, p.merchant_id, m.category AS merchant_category, c.risk_segment,
           p.payment_method, p.channel, p.status, p.currency, p.amount,
           CASE WHEN p.currency = 'USD' THEN p.amount * 4000 ELSE p.amount END AS amount_cop,
           p.transaction_date, p.dt AS transaction_day, COALESCE(f.high_velocity, FALSE) AS flag_high_velocity,
           COALESCE(f.amount_spike, FALSE) AS flag_amount_spike
    FROM landed_payments p
    LEFT JOIN merchants m ON p.merchant_id = m.merchant_id
    LEFT JOIN customers c ON p.customer_id = c.customer_id
    LEFT JOIN landed_features f ON p.payment_id = f.payment_id"""),
    "landed_kpis": (("landed_fact", "landed_refunds", "landed_chargebacks"), f"""
    SELECT p.*, CAST(pagos_aprobados AS DOUBLE) / pagos AS tasa_aprobacion,
           p.tpv_cop / NULLIF(p.pagos_aprobados, 0) AS ticket_promedio_cop,
           COALESCE(devoluciones, 0) AS devoluciones, COALESCE(devoluciones_cop, 0) AS devoluciones_cop,
           ROUND(COALESCE(devoluciones_cop, 0) / NULLIF(p.tpv_cop, 0), 6) AS tasa_devolucion,
           COALESCE(contracargos, 0) AS contracargos,
           ROUND(COALESCE(contracargos_cop, 0) / NULLIF(p.tpv_cop, 0), 6) AS tasa_contracargos
    FROM (SELECT transaction_day AS fecha, COUNT(*) AS pagos, {count_if("status = 'approved'")} AS pagos_aprobados,
                 ROUND(SUM(CASE WHEN status = 'approved' THEN amount_cop ELSE 0 END), 2) AS tpv_cop,
                 COUNT(DISTINCT customer_id) AS clientes_activos FROM landed_fact GROUP BY 1) p
    LEFT JOIN (SELECT r.dt, COUNT(*) AS devoluciones,
                      ROUND(SUM(CASE WHEN q.currency = 'USD' THEN r.amount * 4000 ELSE r.amount END), 2)
                          AS devoluciones_cop
               FROM landed_refunds r LEFT JOIN landed_payments q ON r.payment_id = q.payment_id GROUP BY 1) d
        ON p.fecha = d.dt
    LEFT JOIN (SELECT b.dt, COUNT(*) AS contracargos,
                      ROUND(SUM(CASE WHEN q.currency = 'USD' THEN b.amount * 4000 ELSE b.amount END), 2)
                          AS contracargos_cop
               FROM landed_chargebacks b LEFT JOIN landed_payments q ON b.payment_id = q.payment_id GROUP BY 1) c
        ON p.fecha = c.dt"""),
    "landing_counts": (("landed_lines", "customers", "known", "refund_lines", "chargeback_lines"), f"""
    SELECT 'payments' AS entity, {day("ingest_date")} AS ingest_date, COUNT(*) AS rows FROM landed_lines GROUP BY 2
    UNION ALL SELECT 'customers', '2024-01-01', COUNT(*) FROM customers
    UNION ALL SELECT 'customers', '2024-01-10', COUNT(*) FROM customers WHERE risk_segment <> 'low'
    UNION ALL SELECT 'merchants', '2024-01-01', COUNT(*) FROM known
    UNION ALL SELECT 'refunds', {day("dt")}, COUNT(*) FROM refund_lines GROUP BY 2
    UNION ALL SELECT 'chargebacks', {day("dt")}, COUNT(*) FROM chargeback_lines GROUP BY 2"""),
}


def sql(*needed: str, body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for other in PARTS[name][0]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needed:
        add(name)
    if not order:
        return body
    parts = ",\n".join(f"{name} AS ({PARTS[name][1]}\n)" for name in order)
    return f"WITH {parts}\n{body}"
