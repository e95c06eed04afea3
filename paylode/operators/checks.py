"""Data tests as aggregates: one pass per table for row predicates, one per key or relation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylode.contracts import PAYMENT_STATUSES, RISK_SEGMENTS


@dataclass(frozen=True)
class RowCheck:
    """Fails for every row where ``failing`` holds."""

    test: str
    table: str
    failing: Column
    severity: str = "error"


@dataclass(frozen=True)
class UniqueCheck:
    """Fails for every value of ``column`` that occurs more than once."""

    test: str
    table: str
    column: str
    severity: str = "error"


@dataclass(frozen=True)
class RelationCheck:
    """Fails for every row whose ``column`` is set but not found in ``to``.``field``."""

    test: str
    table: str
    column: str
    to: str
    field: str
    severity: str = "error"


Check = RowCheck | UniqueCheck | RelationCheck


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(f"not_null_{table}_{column}", table, F.col(column).isNull())


def accepted_values(table: str, column: str, values: Sequence[str]) -> RowCheck:
    return RowCheck(f"accepted_values_{table}_{column}", table, ~F.col(column).isin(*values))


def unique(table: str, column: str) -> UniqueCheck:
    return UniqueCheck(f"unique_{table}_{column}", table, column)


def relationship(table: str, column: str, to: str, field: str, severity: str = "error") -> RelationCheck:
    return RelationCheck(f"relationships_{table}_{column}", table, column, to, field, severity)


def outside_unit(column: str) -> Column:
    return ~F.col(column).between(0, 1)


def row_failures(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All predicates of a table counted in one pass, then turned into one row per test."""
    counted = df.agg(*[F.count_if(check.failing).alias(f"c{i}") for i, check in enumerate(checks)])
    lines = [
        F.struct(
            F.lit(check.test).alias("test"), F.lit(check.severity).alias("severity"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, check in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*lines)))


def _one_per_test(counted: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``failures`` of one count as a row for each of the tests that it answers."""
    lines = [F.struct(F.lit(c.test).alias("test"), F.lit(c.severity).alias("severity"), F.col("failures")) for c in checks]
    return counted.select(F.inline(F.array(*lines)))


def unique_failures(df: DataFrame, *checks: UniqueCheck) -> DataFrame:
    """Values that occur twice, counted once for all ``checks``: the same column, under whatever name."""
    column = checks[0].column
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return _one_per_test(counted.agg(F.count_if(F.col("_n") > 1).alias("failures")), checks)


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    keys = parent.select(F.col(field).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def relation_failures(child: DataFrame, parent: DataFrame, check: RelationCheck) -> DataFrame:
    return orphans(child, check.column, parent, check.field).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(check.test).alias("test"), F.lit(check.severity).alias("severity"), "failures"
    )


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], renamed: Mapping[str, str] | None = None,
) -> DataFrame:
    """``test, severity, failures`` for every check.

    ``renamed`` names tables that are another table's rows under other column names: a key is counted once
    for both.
    """
    by_table: dict[str, list[RowCheck]] = {}
    by_key: dict[str, list[UniqueCheck]] = {}
    results = []
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        elif isinstance(check, UniqueCheck):
            origin = (renamed or {}).get(check.table, check.table)
            # The first is the origin's own, whose column name counts.
            by_key.setdefault(origin, []).insert(0 if check.table == origin else len(by_key.get(origin, [])), check)
        else:
            results.append(relation_failures(tables[check.table], tables[check.to], check))
    results += [unique_failures(tables[group[0].table], *group) for group in by_key.values()]
    results += [row_failures(tables[table], group) for table, group in by_table.items()]
    report = results[0]
    for more in results[1:]:
        report = report.unionByName(more)
    return report


# Published datasets that have a mart's rows under other names.
RENAMED = {"pagos_gold": "fct_payments", "clientes_gold": "dim_customers", "contracargos_gold": "fct_chargebacks"}

# The identifying column of each mart and published dataset.
KEYS = {
    "dim_customers": "customer_id",
    "dim_merchants": "merchant_id",
    "fct_payments": "payment_id",
    "fct_refunds": "refund_id",
    "fct_chargebacks": "chargeback_id",
    "clientes_gold": "id_cliente",
    "pagos_gold": "id_pago",
    "contracargos_gold": "id_contracargo",
    "indicadores_financieros": "fecha",
}


def mart_checks() -> list[Check]:
    """The tests of the marts and the published datasets: 23 generic and 3 of their own."""
    checks: list[Check] = [unique(table, column) for table, column in KEYS.items()]
    checks += [not_null(table, column) for table, column in KEYS.items()]
    checks += [
        not_null("fct_payments", "amount"),
        accepted_values("dim_customers", "risk_segment", RISK_SEGMENTS),
        accepted_values("fct_payments", "status", PAYMENT_STATUSES),
        relationship("fct_payments", "merchant_id", "dim_merchants", "merchant_id"),
        # A refund may come in before its payment.
        relationship("fct_refunds", "payment_id", "fct_payments", "payment_id", severity="warn"),
        RowCheck("no_future_payments", "fct_payments", F.col("updated_at") < F.col("transaction_date")),
        RowCheck(
            "rates_between_0_and_1",
            "indicadores_financieros",
            outside_unit("tasa_aprobacion") | outside_unit("tasa_devolucion") | outside_unit("tasa_contracargos"),
        ),
        RowCheck("refund_not_exceeding_payment", "fct_refunds", F.col("amount") > F.col("payment_amount")),
    ]
    return checks
