"""VW1-VW4, VW7, VW8, K01-K05, D01-D08, D10, D11 and the aggregates, joins and sorts they use.

They read the curated adapters: direct projections of the test tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.registry import query
from ledgerspan.functions.numbers import exact_sum, safe_ratio
from ledgerspan.operators.intervals import overlapped_periods
from ledgerspan.operators.lookup import calendar_dates
from ledgerspan.operators.ordering import dense_positions, dense_rank_desc
from ledgerspan.plans.analytics import dashboards as D, kpis as K, views as V

CATEGORY = "category_key category_code category_name category_macro_group category_group category_family"
VIEW_COLUMNS = {
    "vw_suppliers": "supplier_key supplier_cnpj supplier_legal_name supplier_hierarchy company_size economic_activity economic_group_key economic_group_legal_name parent_supplier_key financial_scenario",
    "vw_contracts": f"contract_key contract_id contract_name contract_type contract_status final_risk original_value:n total_value:n balance_value:n supplier_key supplier_legal_name economic_group_key {CATEGORY} validity_start_date:d validity_end_date:d",
    "vw_spending": f"spending_key payment_id payment_value:n cost_center payment_date:d contract_key contract_id contract_status supplier_key supplier_legal_name economic_group_key {CATEGORY}",
    "vw_renewals": f"renewal_key amendment_id amendment_sequence amendment_type is_renewal amendment_value:n contract_key contract_id supplier_key supplier_legal_name {CATEGORY} validity_start_date:d validity_end_date:d",
    "vw_rfi": "rfi_key risk_assessment_id assessment_date:d last_approval_date:d expiration_date:d homologation_result homologation_status financial_risk labor_risk credit_rating final_risk interest_to_revenue_ratio revenue_trend net_margin labor_cases_index supplier_key supplier_cnpj supplier_legal_name economic_group_key",
}
FINANCIALS = (
    "financial_snapshot_key financial_year financial_period_end_date:d gross_revenue total_cost payroll_cost gross_profit debt_interest net_income"
    " gross_margin net_margin supplier_key supplier_cnpj supplier_legal_name supplier_hierarchy economic_group_key economic_group_legal_name"
)
# Sums of doubles depend on the order of addition: compare them at a fixed number of places.
ROUNDED = {"annualized_contract_value": 2, "financial_dependency_ratio": 6, "revenue_to_contract_coverage_ratio": 6}
ROUNDED_SQL = ", ".join(f"round({c}, {n}) AS {c}" for c, n in ROUNDED.items())


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in ROUNDED.items() if c in df.columns})


def view(spark, sf, name: str) -> DataFrame:
    return V.VIEWS[name](A.Curated(spark, sf))


def view_entry(key: str, name: str) -> None:
    @query(key, O.sql(f"SELECT {O.show(VIEW_COLUMNS[name])} FROM {name}"))
    def build(spark, sf):
        return view(spark, sf, name)


for _key, _name in (
    ("vw1_suppliers", "vw_suppliers"), ("vw2_contracts", "vw_contracts"), ("vw3_spending", "vw_spending"),
    ("vw4_renewals", "vw_renewals"), ("vw7_rfi", "vw_rfi"),
):
    view_entry(_key, _name)


@query("vw8_supplier_financials", O.sql(f"SELECT {O.show(FINANCIALS)}, {ROUNDED_SQL} FROM vw_supplier_financials"))
def vw8(spark, sf):
    return rounded(view(spark, sf, "vw_supplier_financials"))


def dec(c: str) -> str:
    return f"coalesce(sum(CAST({c} AS DECIMAL(38,2))), 0)"


K01_SQL = f"""SELECT supplier_legal_name, category_macro_group, count(*) AS contract_count, CAST({dec('total_value')} AS DOUBLE) AS contracted_value,
  CAST({dec('balance_value')} AS DOUBLE) AS contract_balance_value, CAST({dec('total_value - balance_value')} AS DOUBLE) AS consumed_contract_value,
  CAST({dec('total_value - balance_value')} AS DOUBLE) / nullif(CAST({dec('total_value')} AS DOUBLE), 0) AS consumption_percentage
FROM vw_contracts GROUP BY supplier_legal_name, category_macro_group"""


@query("k01_consumption", O.sql(K01_SQL))
def k01(spark, sf):
    return K.consumption(view(spark, sf, "vw_contracts"))


BAND = O.lit(A.AS_OF)
K02_BAND = (
    f"CASE WHEN validity_end_date < DATE {BAND} THEN 'expired' WHEN validity_end_date <= DATE {BAND} + INTERVAL 30 DAY THEN 'expires_in_30_days'"
    f" WHEN validity_end_date <= DATE {BAND} + INTERVAL 60 DAY THEN 'expires_in_60_days'"
    f" WHEN validity_end_date <= DATE {BAND} + INTERVAL 90 DAY THEN 'expires_in_90_days' ELSE 'outside_renewal_window' END AS expiry_status"
)
K02_SQL = f"SELECT contract_id, contract_name, supplier_legal_name, contract_status, CAST(validity_end_date AS VARCHAR) AS validity_end_date, CAST(total_value AS DOUBLE) AS total_value, CAST(balance_value AS DOUBLE) AS balance_value, date_diff('day', DATE {BAND}, validity_end_date) AS days_to_expiry, {K02_BAND} FROM vw_contracts"


@query("k02_contract_expiry", O.sql(K02_SQL))
def k02(spark, sf):
    return K.expiry(view(spark, sf, "vw_contracts"), A.context(spark, sf))


TOTALS = f"SELECT economic_group_key, supplier_legal_name, {dec('payment_value')} AS total_spending FROM vw_spending GROUP BY 1, 2"
K03_SQL = f"""SELECT economic_group_key, supplier_legal_name, CAST(total_spending AS DOUBLE) AS total_spending,
  CAST(total_spending AS DOUBLE) / nullif(CAST(p.portfolio AS DOUBLE), 0) AS spending_concentration_ratio,
  dense_rank() OVER (ORDER BY total_spending DESC) AS spending_rank
FROM totals CROSS JOIN (SELECT sum(total_spending) AS portfolio FROM totals) p"""


@query("k03_spend_concentration", O.sql(K03_SQL, totals=TOTALS))
def k03(spark, sf):
    return K.concentration(view(spark, sf, "vw_spending"))


K04_COLUMNS = "supplier_key supplier_cnpj supplier_legal_name economic_group_key assessment_date:d expiration_date:d homologation_result homologation_status financial_risk labor_risk credit_rating final_risk interest_to_revenue_ratio revenue_trend net_margin labor_cases_index"


def latest(spark, sf) -> DataFrame:
    return K.latest_risk(view(spark, sf, "vw_rfi"))


@query("k04_latest_risk", O.sql(f"SELECT {O.show(K04_COLUMNS)} FROM latest_risk"))
def k04(spark, sf):
    return latest(spark, sf)


@query("k05_financial_dependency", O.sql(f"SELECT financial_year, supplier_key, supplier_cnpj, supplier_legal_name, economic_group_key, gross_revenue, total_cost, gross_profit, net_income, {ROUNDED_SQL} FROM vw_supplier_financials"))
def k05(spark, sf):
    return rounded(K.dependency(view(spark, sf, "vw_supplier_financials")))


# ---- dashboard
@query("d01_monthly_spending", O.sql(f"SELECT CAST(CAST(date_trunc('month', payment_date) AS DATE) AS VARCHAR) AS payment_month, CAST({dec('payment_value')} AS DOUBLE) AS total_spending, count(*) AS payment_count FROM vw_spending GROUP BY 1"))
def d01(spark, sf):
    return D.monthly_spending(view(spark, sf, "vw_spending"))


def d02_sql(level: str) -> str:
    return f"""SELECT coalesce(c.{level}, s.{level}) AS {level}, CAST(coalesce(v, 0) AS DOUBLE) AS contracted_value, CAST(coalesce(p, 0) AS DOUBLE) AS total_spending
FROM (SELECT {level}, {dec('total_value')} AS v FROM vw_contracts GROUP BY 1) c
FULL JOIN (SELECT {level}, {dec('payment_value')} AS p FROM vw_spending GROUP BY 1) s ON c.{level} = s.{level}"""


def level_entry(level: str) -> None:
    @query(f"d02_mix_by_{level}", O.sql(d02_sql(level)))
    def build(spark, sf):
        return D.level_mix(view(spark, sf, "vw_contracts"), view(spark, sf, "vw_spending"), level)


for _level in ("category_macro_group", "category_family"):
    level_entry(_level)
FLAGS = "SELECT contract_key, bool_or(is_renewal) AS r, bool_or(NOT is_renewal) AS t FROM vw_renewals GROUP BY 1"


@query(
    "d03_contract_table",
    O.sql(
        f"SELECT contract_id, supplier_legal_name, category_name, CAST(balance_value AS DOUBLE) AS balance_value, final_risk, {O.show('validity_start_date:d validity_end_date:d')},"
        f" coalesce(r, false) AS has_renewal, coalesce(t, false) AS has_top_up FROM vw_contracts c LEFT JOIN ({FLAGS}) f ON c.contract_key = f.contract_key"
    ),
)
def d03(spark, sf):
    return D.contract_table(view(spark, sf, "vw_contracts"), view(spark, sf, "vw_renewals"))


@query("d04_action_card", O.sql(f"SELECT expiry_status, count(*) AS contract_count FROM (SELECT {K02_BAND} FROM vw_contracts) WHERE expiry_status <> 'outside_renewal_window' GROUP BY 1"))
def d04(spark, sf):
    return D.action_card(view(spark, sf, "vw_contracts"), A.context(spark, sf))


LEVELS = ", ".join(D.LEVELS)


@query("d05_drill_hierarchy", O.sql(f"SELECT {LEVELS}, CAST(grouping_id({LEVELS}) AS BIGINT) AS level_id, count(*) AS contract_count, CAST({dec('total_value')} AS DOUBLE) AS contracted_value FROM vw_contracts GROUP BY ROLLUP ({LEVELS})"))
def d05(spark, sf):
    return D.drill_hierarchy(view(spark, sf, "vw_contracts"))


@query(
    "d06_top_contracts",
    O.sql(
        "SELECT contract_id, CAST(total_value AS DOUBLE) AS total_value, CAST(balance_value AS DOUBLE) AS balance_value, coalesce(r, false) AS has_renewal, coalesce(t, false) AS has_top_up"
        f" FROM (SELECT * FROM vw_contracts ORDER BY total_value DESC, contract_id LIMIT 20) c LEFT JOIN ({FLAGS}) f ON c.contract_key = f.contract_key"
    ),
)
def d06(spark, sf):
    return D.top_contracts(view(spark, sf, "vw_contracts"), view(spark, sf, "vw_renewals"))


@query(
    "d06_top_suppliers",
    O.sql(
        f"""SELECT t.supplier_key, t.supplier_legal_name, CAST(total_spending AS DOUBLE) AS total_spending, r.final_risk, r.homologation_status,
  round(f.financial_dependency_ratio, 6) AS financial_dependency_ratio
FROM (SELECT supplier_key, supplier_legal_name, {dec('payment_value')} AS total_spending FROM vw_spending GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20) t
LEFT JOIN latest_risk r ON t.supplier_key = r.supplier_key
LEFT JOIN (SELECT * FROM vw_supplier_financials WHERE financial_year = 2000) f ON t.supplier_key = f.supplier_key"""
    ),
)
def d06s(spark, sf):
    financials = view(spark, sf, "vw_supplier_financials")
    return rounded(D.top_suppliers(view(spark, sf, "vw_spending"), latest(spark, sf), financials, 2000))


@query("d07_category_dimension", O.sql(f"SELECT DISTINCT {O.show(CATEGORY)} FROM vw_contracts"))
def d07(spark, sf):
    return D.category_dimension(view(spark, sf, "vw_contracts"))


@query(
    "d08_supplier_profile",
    O.sql(
        f"""SELECT s.supplier_key, s.supplier_legal_name, s.economic_group_key, s.economic_group_legal_name, r.final_risk, r.homologation_status,
  CAST(coalesce(p.v, 0) AS DOUBLE) AS total_spending, coalesce(c.n, 0) AS contract_count, CAST(coalesce(c.v, 0) AS DOUBLE) AS contracted_value
FROM vw_suppliers s LEFT JOIN latest_risk r ON s.supplier_key = r.supplier_key
LEFT JOIN (SELECT supplier_key, {dec('payment_value')} AS v FROM vw_spending GROUP BY 1) p ON s.supplier_key = p.supplier_key
LEFT JOIN (SELECT supplier_key, count(*) AS n, {dec('total_value')} AS v FROM vw_contracts GROUP BY 1) c ON s.supplier_key = c.supplier_key"""
    ),
)
def d08(spark, sf):
    frames = [view(spark, sf, v) for v in ("vw_suppliers", "vw_contracts", "vw_spending")]
    return D.supplier_profile(*frames, latest(spark, sf))


@query("d10_profit_composition", O.sql("SELECT financial_snapshot_key, financial_year, total_cost, gross_profit, net_income, gross_revenue, abs(total_cost + gross_profit - gross_revenue) <= 0.01 AS is_recomposed FROM vw_supplier_financials"))
def d10(spark, sf):
    return D.profit_composition(view(spark, sf, "vw_supplier_financials"))


@query("d11_risk_alerts", O.sql("SELECT supplier_key, homologation_status, final_risk, homologation_status <> 'ativa' AS is_approval_inactive, final_risk = 'alto' AS is_high_risk FROM latest_risk"))
def d11(spark, sf):
    return D.risk_alerts(latest(spark, sf))


# ---- the joins, aggregates and sorts of the views and KPIs, one by one
@query("j07_inner_dimension_join", O.sql("SELECT c.contract_id, s.supplier_legal_name, k.category_name FROM dim_contract c JOIN dim_supplier s ON c.supplier_key = s.supplier_key JOIN dim_category k ON c.category_key = k.category_key"))
def j07(spark, sf):
    t = A.Curated(spark, sf)
    rows = t["dim_contract"].join(t["dim_supplier"].select("supplier_key", "supplier_legal_name"), "supplier_key")
    return rows.join(t["dim_category"].select("category_key", "category_name"), "category_key").select(
        "contract_id", "supplier_legal_name", "category_name"
    )


@query("j08_role_played_calendar", O.sql(f"SELECT risk_assessment_id, {O.show('assessment_date:d last_approval_date:d expiration_date:d')} FROM vw_rfi"))
def j08(spark, sf):
    roles = {
        "assessment_calendar_key": "assessment_date",
        "last_approval_calendar_key": "last_approval_date",
        "expiration_calendar_key": "expiration_date",
    }
    rows = A.Curated(spark, sf)["fact_rfi"].select("risk_assessment_id", *roles)
    return calendar_dates(rows, A.calendar(spark, sf), roles).drop(*roles)


def dated_contracts(spark, sf) -> DataFrame:
    roles = {"validity_start_calendar_key": "start_date", "validity_end_calendar_key": "end_date"}
    return calendar_dates(A.Curated(spark, sf)["dim_contract"], A.calendar(spark, sf), roles, "inner")


@query(
    "j09_interval_overlap",
    O.sql(
        "SELECT c.supplier_key, p.financial_year, count(*) AS active_contracts FROM (SELECT DISTINCT financial_year, financial_period_calendar_key FROM fact_supplier_financial) p"
        " JOIN dim_calendar d ON p.financial_period_calendar_key = d.calendar_key, dim_contract c"
        " JOIN dim_calendar a ON c.validity_start_calendar_key = a.calendar_key JOIN dim_calendar b ON c.validity_end_calendar_key = b.calendar_key"
        " WHERE a.calendar_date <= d.calendar_date AND b.calendar_date >= date_trunc('year', d.calendar_date) GROUP BY 1, 2"
    ),
)
def j09(spark, sf):
    periods = V.fiscal_periods(A.Curated(spark, sf))
    active = overlapped_periods(dated_contracts(spark, sf), "start_date", "end_date", periods)
    return active.groupBy("supplier_key", F.col("period_year").alias("financial_year")).agg(
        F.count("*").alias("active_contracts")
    )


@query("j10_composite_left_join", O.sql("SELECT f.financial_snapshot_key, round(a.annualized_contract_value, 2) AS annualized_contract_value FROM fact_supplier_financial f LEFT JOIN annualized a ON f.supplier_key = a.supplier_key AND f.financial_year = a.financial_year"))
def j10(spark, sf):
    t = A.Curated(spark, sf)
    rows = t["fact_supplier_financial"].join(V.annualized_contracts(t), ["supplier_key", "financial_year"], "left")
    return rounded(rows.select("financial_snapshot_key", "annualized_contract_value"))


@query("j11_one_row_relation", O.sql(f"SELECT contract_id, date_diff('day', validity_end_date, DATE {BAND}) AS days_since_end FROM vw_contracts"))
def j11(spark, sf):
    as_of = A.context(spark, sf).scalar()
    return view(spark, sf, "vw_contracts").select(
        "contract_id", F.datediff(as_of, "validity_end_date").cast("bigint").alias("days_since_end")
    )


@query("j12_grouped_left_join", O.sql("SELECT c.contract_id, coalesce(n, 0) AS payment_count FROM dim_contract c LEFT JOIN (SELECT contract_key, count(*) AS n FROM fact_spending GROUP BY 1) p ON c.contract_key = p.contract_key"))
def j12(spark, sf):
    t = A.Curated(spark, sf)
    counts = t["fact_spending"].groupBy("contract_key").agg(F.count("*").alias("n"))
    return t["dim_contract"].join(counts, "contract_key", "left").select(
        "contract_id", F.coalesce("n", F.lit(0)).alias("payment_count")
    )


@query("a01_supplier_sums", O.sql(K01_SQL))
def a01(spark, sf):
    consumed = F.col("total_value") - F.col("balance_value")
    rows = view(spark, sf, "vw_contracts").groupBy("supplier_legal_name", "category_macro_group").agg(
        F.count("*").alias("contract_count"),
        exact_sum("total_value").alias("contracted_value"),
        exact_sum("balance_value").alias("contract_balance_value"),
        exact_sum(consumed).alias("consumed_contract_value"),
    )
    ratio = safe_ratio(F.col("consumed_contract_value"), F.col("contracted_value"))
    return rows.withColumn("consumption_percentage", ratio)


@query("a02_group_supplier_sum", O.sql("SELECT economic_group_key, supplier_legal_name, CAST(total_spending AS DOUBLE) AS total_spending FROM totals", totals=TOTALS))
def a02(spark, sf):
    return K.spending_by_supplier(view(spark, sf, "vw_spending"))


@query("a03_portfolio_sum", O.sql(f"SELECT CAST({dec('payment_value')} AS DOUBLE) AS portfolio_spending FROM vw_spending"))
def a03(spark, sf):
    return view(spark, sf, "vw_spending").agg(exact_sum("payment_value").alias("portfolio_spending"))


@query("a04_annualized_value", O.sql("SELECT supplier_key, financial_year, round(annualized_contract_value, 2) AS annualized_contract_value FROM annualized"))
def a04(spark, sf):
    return rounded(V.annualized_contracts(A.Curated(spark, sf)))


@query("w03_latest_row", O.sql("SELECT supplier_key, risk_assessment_id, CAST(assessment_date AS VARCHAR) AS assessment_date FROM latest_risk"))
def w03(spark, sf):
    rows = K.latest_per_key(view(spark, sf, "vw_rfi"), ["supplier_key"], "assessment_date", "risk_assessment_id")
    return rows.select("supplier_key", "risk_assessment_id", "assessment_date")


@query("w04_dense_rank", "SELECT l_orderkey, l_linenumber, l_extendedprice, dense_rank() OVER (ORDER BY l_extendedprice DESC) AS price_rank FROM lineitem")
def w04(spark, sf):
    rows = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return dense_rank_desc(rows, "l_extendedprice", "price_rank")


def ordered(key: str, sql_body: str, order_sql: str, columns: str, build_rows, order, **extra) -> None:
    """A sort, made visible by the position of each row."""
    shown = ", ".join(columns.split())

    @query(key, O.sql(f"SELECT {shown}, row_number() OVER (ORDER BY {order_sql}) AS position FROM ({sql_body})", **extra))
    def build(spark, sf):
        return dense_positions(build_rows(spark, sf).select(*columns.split()), *order())


desc, asc = (lambda c: F.col(c).desc_nulls_last()), (lambda c: F.col(c).asc_nulls_last())
SEVERITY = "CASE final_risk WHEN 'alto' THEN 3 WHEN 'medio' THEN 2 WHEN 'baixo' THEN 1 ELSE 0 END"
ordered("o01_value_desc_then_name", K01_SQL, "contracted_value DESC, supplier_legal_name, category_macro_group", "supplier_legal_name category_macro_group contracted_value", k01, lambda: [desc("contracted_value"), asc("supplier_legal_name"), asc("category_macro_group")])
ordered("o02_multi_key_asc", K02_SQL, "validity_end_date, contract_id", "contract_id validity_end_date", k02, lambda: [asc("validity_end_date"), asc("contract_id")])
ordered("o03_desc_nulls_last", "SELECT financial_year, supplier_key, round(financial_dependency_ratio, 6) AS financial_dependency_ratio FROM vw_supplier_financials", "financial_year DESC, financial_dependency_ratio DESC NULLS LAST, supplier_key", "financial_year supplier_key financial_dependency_ratio", k05, lambda: [desc("financial_year"), desc("financial_dependency_ratio"), asc("supplier_key")])
ordered("o04_ordinal_case", "SELECT * FROM latest_risk", f"{SEVERITY} DESC, supplier_legal_name, supplier_key", "supplier_key supplier_legal_name final_risk", k04, lambda: [F.expr(SEVERITY).desc(), asc("supplier_legal_name"), asc("supplier_key")])
ordered("o05_status_then_name", "SELECT contract_status, contract_id FROM vw_contracts", "contract_status DESC, contract_id", "contract_status contract_id", lambda s, d: view(s, d, "vw_contracts"), lambda: [F.col("contract_status").desc(), asc("contract_id")])
