"""Contract exposure, value cycles, consumption and payment schedules."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.functions.numbers import EXACT_SUM, exact_sum
from ledgerspan.operators.allocate import allocate
from ledgerspan.operators.reshape import monthly_schedule, unpivot_years
from ledgerspan.plans.staging.amendments import RENEWAL
from ledgerspan.plans.staging.companies import YEARS


def base_year(start: Column | str) -> Column:
    """Year of the contract start, clamped to the years with figures."""
    year = F.year(F.col(start) if isinstance(start, str) else start)
    return F.least(F.greatest(year, F.lit(YEARS[0])), F.lit(YEARS[-1])).cast("bigint")


def annual_limits(companies: DataFrame, factor: float) -> DataFrame:
    rows = unpivot_years(companies, ["cnpj"], {"faturamento": "revenue"}, YEARS)
    limit = (F.col("revenue").cast("decimal(20,2)") * F.lit(factor).cast("decimal(6,4)")).cast("decimal(18,2)")
    return rows.select(F.col("cnpj").alias("supplier_cnpj"), "financial_year", limit.alias("annual_limit"))


def exposure(companies: DataFrame, contracts: DataFrame, factor: float) -> DataFrame:
    """Annual limit, used exposure and remaining capacity per supplier and year."""
    used = contracts.groupBy("supplier_cnpj", base_year("validity_start_date").alias("financial_year")).agg(
        exact_sum("original_value").alias("used_exposure")
    )
    rows = annual_limits(companies, factor).join(used, ["supplier_cnpj", "financial_year"], "left")
    spent = F.coalesce("used_exposure", F.lit(0).cast(EXACT_SUM))
    return rows.select(
        "supplier_cnpj", "financial_year", "annual_limit", spent.alias("used_exposure"),
        (F.col("annual_limit") - spent).cast(EXACT_SUM).alias("remaining_capacity"),
    )


def contract_cycles(contracts: DataFrame, amendments: DataFrame) -> DataFrame:
    """Base cycle (up to the day before the first renewal) plus one cycle per amendment.

    `cycle_number` 0 is the base; amendments keep their sequence, which is unique per contract.
    """
    first = (
        amendments.where(F.col("amendment_type") == RENEWAL)
        .groupBy(F.col("contract_id").alias("__contract"))
        .agg(F.min("validity_start_date").alias("__first"))
    )
    base = contracts.join(first, F.col("contract_id") == F.col("__contract"), "left").select(
        "contract_id",
        F.lit(0).cast("bigint").alias("cycle_number"),
        F.col("validity_start_date").alias("cycle_start"),
        F.coalesce(F.date_sub("__first", 1), F.col("validity_end_date")).alias("cycle_end"),
        F.col("original_value").cast("decimal(18,2)").alias("cycle_value"),
    )
    events = amendments.join(contracts.select("contract_id"), "contract_id", "left_semi").select(
        "contract_id",
        F.col("amendment_sequence").cast("bigint").alias("cycle_number"),
        F.col("validity_start_date").alias("cycle_start"),
        F.col("validity_end_date").alias("cycle_end"),
        F.col("amendment_value").cast("decimal(18,2)").alias("cycle_value"),
    )
    return base.unionByName(events)


def allocate_consumption(cycles: DataFrame, contracts: DataFrame, limit: Column) -> DataFrame:
    """Consumed value (total minus balance) spread over the cycles already started at `limit`."""
    consumed = contracts.select(
        F.col("contract_id").alias("__contract"),
        (F.col("total_value") - F.col("balance_value")).cast("decimal(18,2)").alias("consumed_value"),
    )
    rows = cycles.join(consumed, F.col("contract_id") == F.col("__contract")).drop("__contract")
    return allocate(
        rows,
        "contract_id",
        "consumed_value",
        "cycle_value",
        ["cycle_number"],
        eligible=F.col("cycle_start") <= limit,
        out="allocated_value",
    )


def run_rate(cycles: DataFrame, consumption: DataFrame, snapshot: date, reference: date) -> DataFrame:
    """Expected consumption between two dates: daily rate of active cycles, capped by capacity.

    `consumption` has contract_id and consumed_value.
    """
    start, end = F.col("cycle_start"), F.col("cycle_end")
    days = F.greatest(F.datediff(end, start) + 1, F.lit(1))
    active = (start <= F.lit(reference)) & (end > F.lit(snapshot))
    rate = F.when(active, F.col("cycle_value").cast("double") / days).otherwise(0.0)
    capacity = F.when(start <= F.lit(reference), F.col("cycle_value"))
    elapsed = max((reference - snapshot).days, 0)
    totals = cycles.groupBy("contract_id").agg(
        F.sum(rate).alias("daily_rate"), exact_sum(capacity).alias("capacity")
    )
    left = F.greatest(F.col("capacity") - F.col("consumed_value"), F.lit(0).cast(EXACT_SUM))
    rows = totals.join(consumption, "contract_id").withColumn("remaining_capacity", left.cast(EXACT_SUM))
    increment = F.least(F.col("daily_rate") * elapsed, F.col("remaining_capacity").cast("double"))
    return rows.select("contract_id", "daily_rate", "remaining_capacity", increment.alias("increment"))


def payment_schedule(cycles: DataFrame) -> DataFrame:
    return monthly_schedule(cycles, "cycle_start", "cycle_end", "due_date")


def payment_balance_check(contracts: DataFrame, payments: DataFrame) -> DataFrame:
    """Do the payments of each expired contract add up to total minus balance?"""
    paid = payments.groupBy("contract_id").agg(exact_sum("payment_value").alias("paid_value"))
    rows = contracts.where(F.col("contract_status") == "vencido").join(paid, "contract_id", "left")
    expected = (F.col("total_value") - F.col("balance_value")).cast(EXACT_SUM)
    total = F.coalesce("paid_value", F.lit(0).cast(EXACT_SUM))
    return rows.select(
        "contract_id", expected.alias("expected_value"), total.alias("paid_value"),
        (total == expected).alias("is_reconciled"),
    )


def elapsed_share(contracts: DataFrame, reference: date) -> DataFrame:
    """Elapsed fraction of each contract, expected balance share and expired flag."""
    start, end, today = F.col("validity_start_date"), F.col("validity_end_date"), F.lit(reference)
    days = F.greatest(F.datediff(end, start), F.lit(1))
    gone = F.least(F.greatest(F.datediff(today, start), F.lit(0)), days)
    share = gone.cast("double") / days
    return contracts.select(
        "contract_id",
        share.alias("elapsed_fraction"),
        (1 - share).alias("expected_balance_share"),
        (end < today).alias("is_expired"),
    )


def renewal_cycles(contracts: DataFrame, months: str, reference: date) -> DataFrame:
    """Twelve-month renewal cycles from the contract start; cycles after the reference are dropped."""
    start, end = F.col("validity_start_date"), F.col("validity_end_date")
    count = F.greatest(F.floor((F.col(months) - 1) / 12), F.lit(1)).cast("int")
    rows = contracts.withColumn("cycle_number", F.explode(F.sequence(F.lit(1), count)))
    cycle_start = F.add_months(start, F.col("cycle_number") * 12)
    cycle_end = F.least(F.date_sub(F.add_months(start, (F.col("cycle_number") + 1) * 12), 1), end)
    return rows.select(
        "contract_id",
        F.col("cycle_number").cast("bigint").alias("cycle_number"),
        cycle_start.alias("cycle_start"),
        cycle_end.alias("cycle_end"),
    ).where(F.col("cycle_start") <= F.lit(reference))
