"""Published datasets: renamed facts, customers, and the daily financial indicators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Published columns, as (source, published) names.
PAGOS = (
    ("payment_id", "id_pago"), ("customer_id", "id_cliente"), ("merchant_id", "id_comercio"),
    ("merchant_category", "categoria_comercio"), ("payment_method", "medio_pago"), ("channel", "canal"),
    ("status", "estado"), ("currency", "moneda"), ("amount", "monto"), ("amount_cop", "monto_cop"),
    ("transaction_date", "fecha_transaccion"), ("transaction_day", "fecha"),
    ("flag_high_velocity", "alerta_velocidad"), ("flag_amount_spike", "alerta_monto"),
)
CLIENTES = (
    ("customer_id", "id_cliente"), ("document_type", "tipo_documento"), ("document_number", "numero_documento"),
    ("city", "ciudad"), ("risk_segment", "segmento_riesgo"), ("created_day", "fecha_vinculacion"),
    ("updated_at", "actualizado_en"),
)
CONTRACARGOS = (
    ("chargeback_id", "id_contracargo"), ("payment_id", "id_pago"), ("merchant_id", "id_comercio"),
    ("customer_id", "id_cliente"), ("reason", "motivo"), ("amount", "monto"), ("chargeback_day", "fecha"),
    ("payment_day", "fecha_pago"), ("days_to_chargeback", "dias_hasta_contracargo"),
)
GOLD_SCHEMAS = {
    "clientes_gold": (
        "id_cliente string, tipo_documento string, numero_documento string, ciudad string, segmento_riesgo string, "
        "fecha_vinculacion date, actualizado_en timestamp"
    ),
    "pagos_gold": (
        "id_pago string, id_cliente string, id_comercio string, categoria_comercio string, medio_pago string, "
        "canal string, estado string, moneda string, monto double, monto_cop double, fecha_transaccion timestamp, "
        "fecha date, alerta_velocidad boolean, alerta_monto boolean"
    ),
    "contracargos_gold": (
        "id_contracargo string, id_pago string, id_comercio string, id_cliente string, motivo string, monto double, "
        "fecha date, fecha_pago date, dias_hasta_contracargo int"
    ),
    "indicadores_financieros": (
        "fecha date, pagos bigint, pagos_aprobados bigint, tasa_aprobacion double, tpv_cop double, "
        "ticket_promedio_cop double, clientes_activos bigint, devoluciones bigint, devoluciones_cop double, "
        "tasa_devolucion double, contracargos bigint, tasa_contracargos double"
    ),
}
GOLD_DATASETS = ("clientes_gold", "pagos_gold", "contracargos_gold", "indicadores_financieros")

# Columns a reader of each dataset counts on.
REQUIRED_COLUMNS = {
    "pagos_gold": ("id_pago", "id_cliente", "monto", "monto_cop", "estado", "medio_pago", "moneda"),
    "clientes_gold": ("id_cliente", "numero_documento", "tipo_documento", "segmento_riesgo"),
    "contracargos_gold": ("id_contracargo", "id_pago", "motivo", "monto", "dias_hasta_contracargo"),
    "indicadores_financieros": (
        "fecha", "pagos", "pagos_aprobados", "tasa_aprobacion", "tasa_devolucion", "tasa_contracargos",
    ),
}
# Datasets that grow by day, and the column that says which.
DATED = {"pagos_gold": "fecha", "contracargos_gold": "fecha", "indicadores_financieros": "fecha"}


def _publish(rows: DataFrame, names: tuple[tuple[str, str], ...]) -> DataFrame:
    return rows.select(*[F.col(source).alias(published) for source, published in names])


def pagos_gold(fct_payments: DataFrame) -> DataFrame:
    return _publish(fct_payments, PAGOS)


def clientes_gold(dim_customers: DataFrame) -> DataFrame:
    return _publish(dim_customers.withColumn("created_day", F.col("created_at").cast("date")), CLIENTES)


def contracargos_gold(fct_chargebacks: DataFrame) -> DataFrame:
    return _publish(fct_chargebacks, CONTRACARGOS)


def daily_payments(fct_payments: DataFrame) -> DataFrame:
    """Counts, approvals, processed value and active customers per day.

    The distinct count first reduces to (day, customer), so neither a busy day nor a hot
    customer gathers its rows in one task.
    """
    approved = F.col("status") == "approved"
    return fct_payments.groupBy(F.col("transaction_day").alias("fecha")).agg(
        F.count(F.lit(1)).alias("pagos"),
        F.count_if(approved).alias("pagos_aprobados"),
        F.sum(F.when(approved, F.col("amount_cop")).otherwise(0.0)).alias("tpv_cop"),
        F.count_distinct("customer_id").alias("clientes_activos"),
    )


def daily_refunds(fct_refunds: DataFrame) -> DataFrame:
    return fct_refunds.groupBy(F.col("refund_day").alias("fecha")).agg(
        F.count(F.lit(1)).alias("devoluciones"), F.sum("amount_cop").alias("devoluciones_cop"),
    )


def daily_chargebacks(fct_chargebacks: DataFrame) -> DataFrame:
    return fct_chargebacks.groupBy(F.col("chargeback_day").alias("fecha")).agg(
        F.count(F.lit(1)).alias("contracargos"), F.sum("amount_cop").alias("contracargos_cop"),
    )


def indicadores_financieros(
    fct_payments: DataFrame, fct_refunds: DataFrame, fct_chargebacks: DataFrame,
) -> DataFrame:
    """One row per payment day.  Rates are NULL where their base is zero."""
    def ratio(part: str, whole: str):
        return F.try_divide(F.col(part).cast("double"), F.col(whole))

    return (
        daily_payments(fct_payments)
        .join(daily_refunds(fct_refunds), "fecha", "left")
        .join(daily_chargebacks(fct_chargebacks), "fecha", "left")
        .na.fill(0, ["devoluciones", "devoluciones_cop", "contracargos", "contracargos_cop"])
        .select(
            "fecha",
            "pagos",
            "pagos_aprobados",
            ratio("pagos_aprobados", "pagos").alias("tasa_aprobacion"),
            "tpv_cop",
            ratio("tpv_cop", "pagos_aprobados").alias("ticket_promedio_cop"),
            "clientes_activos",
            "devoluciones",
            "devoluciones_cop",
            ratio("devoluciones_cop", "tpv_cop").alias("tasa_devolucion"),
            "contracargos",
            ratio("contracargos_cop", "tpv_cop").alias("tasa_contracargos"),
        )
    )


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``dataset, rows`` for each published dataset."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows")
        for name, df in datasets.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def snapshot_as_of(dataset: DataFrame, day, column: str = "fecha") -> DataFrame:
    """The dataset as it was published when ``day`` was its last day."""
    return dataset.where(F.col(column) <= F.lit(day).cast("date"))


def missing_columns(datasets: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Columns a reader counts on that a published dataset lacks (schema only, no job)."""
    return {
        name: [c for c in columns if c not in datasets[name].columns]
        for name, columns in REQUIRED_COLUMNS.items()
        if name in datasets
    }
