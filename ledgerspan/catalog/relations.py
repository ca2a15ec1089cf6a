"""Joins, windows, aggregates and set operators, each on whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.batch import Batch
from ledgerspan.catalog.curated import INDEX
from ledgerspan.catalog.registry import query
from ledgerspan.functions.numbers import exact_sum
from ledgerspan.operators import lookup as L, reshape as R, uniqueness as U
from ledgerspan.operators.intervals import flag_contained
from ledgerspan.plans import quality as Q
from ledgerspan.plans.curated.calendar import covered_dates
from ledgerspan.plans.curated.categories import category_codes
from ledgerspan.plans.curated.suppliers import with_head_office_count
from ledgerspan.plans.rollforward import highest_number
from ledgerspan.plans.staging import companies

LINE = ("l_orderkey", "l_linenumber")


@query("j01_membership_flag", "SELECT l_orderkey, l_linenumber, l_suppkey IN (SELECT s_suppkey FROM (SELECT * REPLACE (CASE WHEN s_suppkey % 9 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS s_suppkey) FROM supplier)) AS is_known FROM lineitem")
def j01(spark, sf):
    shifted = A.shifted(spark, sf, "supplier", "s_suppkey")
    rows = A.table(spark, sf, "lineitem").select(*LINE, "l_suppkey")
    return L.flag_member(rows, "l_suppkey", shifted, "s_suppkey", "is_known").drop("l_suppkey")


@query("j02_head_office_self_join", O.sql("SELECT cnpj, hierarquia, head_num_total_func AS head_staff, head_capital_social AS head_capital FROM f_companies"))
def j02(spark, sf):
    rows = companies.with_head_office(companies.normalize_companies(A.raw(spark, sf, "companies")))
    return rows.select(
        "cnpj", "hierarquia", F.col("__head.num_total_func").alias("head_staff"),
        F.col("__head.capital_social").alias("head_capital"),
    )


@query("j03_many_to_one_lookup", "SELECT o_orderkey, c_mktsegment AS segment FROM orders LEFT JOIN (SELECT * REPLACE (CASE WHEN c_custkey % 9 = 4 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey) FROM customer) ON o_custkey = c_custkey")
def j03(spark, sf):
    customers = A.shifted(spark, sf, "customer", "c_custkey")
    rows = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return L.lookup(rows, customers, "o_custkey", "c_custkey", {"c_mktsegment": "segment"}, check=True).drop("o_custkey")


@query(
    "j04_three_way_lookup",
    "SELECT l_orderkey, l_linenumber, o_orderstatus AS status, s_name AS supplier_name, p_type AS part_type FROM lineitem"
    " LEFT JOIN (SELECT * REPLACE (CASE WHEN o_orderkey % 9 = 4 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey) FROM orders) ON l_orderkey = o_orderkey"
    " LEFT JOIN (SELECT * REPLACE (CASE WHEN s_suppkey % 9 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS s_suppkey) FROM supplier) ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey",
)
def j04(spark, sf):
    rows = A.table(spark, sf, "lineitem").select(*LINE, "l_suppkey", "l_partkey")
    orders = A.shifted(spark, sf, "orders", "o_orderkey")
    rows = L.lookup(rows, orders, "l_orderkey", "o_orderkey", {"o_orderstatus": "status"})
    shifted = A.shifted(spark, sf, "supplier", "s_suppkey")
    rows = L.lookup(rows, shifted, "l_suppkey", "s_suppkey", {"s_name": "supplier_name"})
    rows = L.lookup(rows, A.table(spark, sf, "part"), "l_partkey", "p_partkey", {"p_type": "part_type"})
    return rows.drop("l_suppkey", "l_partkey")


SPAN = "CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS e"


@query(
    "j05_interval_containment",
    f"WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, {SPAN} FROM lineitem)"
    " SELECT l_orderkey, l_linenumber, CAST(s AS VARCHAR) AS s, l_returnflag = 'A' AND EXISTS (SELECT 1 FROM x r WHERE r.l_suppkey = a.l_suppkey AND r.l_returnflag = 'R'"
    " AND r.s <= a.s AND r.e >= a.e) AS is_inside FROM x a",
)
def j05(spark, sf):
    rows = A.table(spark, sf, "lineitem").selectExpr(*LINE, "l_suppkey", "l_returnflag", *SPAN.split(", ", 1))
    flagged = flag_contained(
        rows, "l_suppkey", "s", "e",
        inner=F.col("l_returnflag") == "A", outer=F.col("l_returnflag") == "R", flag="is_inside",
    )
    return flagged.select(*LINE, "s", "is_inside")


@query("j06_calendar_roles", O.sql(f"SELECT l_orderkey, l_linenumber, a.calendar_key AS ship_calendar_key, b.calendar_key AS due_calendar_key FROM (SELECT l_orderkey, l_linenumber, {SPAN} FROM lineitem) LEFT JOIN dim_calendar a ON s = a.calendar_date LEFT JOIN dim_calendar b ON e = b.calendar_date"))
def j06(spark, sf):
    rows = A.table(spark, sf, "lineitem").selectExpr(
        *LINE, "CAST(l_shipdate AS DATE) AS ship_date", "CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) AS due_date"
    )
    return L.calendar_roles(rows, A.calendar(spark, sf), ["ship_date", "due_date"]).drop("ship_date", "due_date")


@query(
    "j14_key_set_comparison",
    "SELECT count(x.k) AS expected_count, count(y.k) AS actual_count, count(*) FILTER (x.k IS NOT NULL AND y.k IS NOT NULL) AS common_count FROM"
    " (SELECT DISTINCT l_suppkey AS k FROM lineitem) x FULL JOIN (SELECT DISTINCT s_suppkey AS k FROM (SELECT * REPLACE (CASE WHEN s_suppkey % 9 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS s_suppkey) FROM supplier)) y ON x.k = y.k",
)
def j14(spark, sf):
    expected = A.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("key"))
    actual = A.shifted(spark, sf, "supplier", "s_suppkey").select(F.col("s_suppkey").alias("key"))
    return R.key_set_comparison(expected, actual)


# ---- aggregates
@query("a06_exact_total", O.sql("SELECT CAST(coalesce(sum(CAST(payment_value AS DECIMAL(38,2))), 0) AS VARCHAR) AS total FROM n_payments"))
def a06(spark, sf):
    from ledgerspan.plans.staging.payments import normalize_payments

    total = exact_sum("payment_value").cast("string").alias("total")
    return normalize_payments(A.raw(spark, sf, "payments")).agg(total)


@query("a07_head_offices_per_root", O.sql("SELECT cnpj8, count(*) AS head_offices FROM n_companies WHERE hierarquia = 'Matriz' GROUP BY 1"))
def a07(spark, sf):
    rows = companies.normalize_companies(A.raw(spark, sf, "companies")).where(F.col("hierarquia") == "Matriz")
    return rows.groupBy("cnpj8").agg(F.count("*").alias("head_offices"))


@query("a09_date_bounds", O.sql(f"SELECT {O.show('lo:d hi:d')} FROM cal_bounds"))
def a09(spark, sf):
    return covered_dates(Batch(spark, sf).all_staged(), with_load_date=True)


@query("a10_row_counts", O.sql("SELECT 'dim_contract' AS entity, (SELECT count(*) FROM stg_contracts) AS source_row_count, count(*) FILTER (curated_validation_errors = '') AS fact_row_count, count(*) FILTER (curated_validation_errors <> '') AS exception_row_count, true AS is_reconciled FROM res_contract"))
def a10(spark, sf):
    batch = Batch(spark, sf)
    rejected = batch.contracts().where("curated_validation_errors <> ''")
    return Q.coverage("dim_contract", batch.staged("contracts"), batch.dim_contract(), rejected)


@query("a11_distinct_keys", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem")
def a11(spark, sf):
    rows = A.table(spark, sf, "lineitem")
    return rows.agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders"))


@query("a12_highest_number", O.sql("SELECT coalesce(max(try_cast(regexp_extract(coalesce(\"Cód_Pagamento\", ''), '([0-9]+)$', 1) AS BIGINT)), 0) AS highest_number FROM raw_payments"))
def a12(spark, sf):
    return highest_number(A.raw(spark, sf, "payments"), "Cód_Pagamento")


# ---- windows and duplicates
@query("w01_repeated_keys", "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_repeated FROM lineitem")
def w01(spark, sf):
    rows = A.table(spark, sf, "lineitem").select(*LINE, "l_partkey")
    return U.flag_repeated(rows, LINE, "is_repeated", salt_on=["l_partkey"])


@query("w02_conditional_count", O.sql("SELECT cnpj, cnpj8, count(*) FILTER (hierarquia = 'Matriz') OVER (PARTITION BY cnpj8) AS head_offices FROM n_companies"))
def w02(spark, sf):
    rows = with_head_office_count(companies.normalize_companies(A.raw(spark, sf, "companies")))
    return rows.select("cnpj", "cnpj8", F.col("__offices").alias("head_offices"))


W05 = "SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type <> 'error'"


@query("w05_latest_after_filter", f"SELECT user_id, event_id FROM ({W05}) WHERE r = 1")
def w05(spark, sf):
    rows = A.table(spark, sf, "events").where("event_type <> 'error'")
    return U.latest_per_key(rows, ["user_id"], "ts", "event_id").select("user_id", "event_id")


@query("w06_unambiguous_keys", "SELECT l_orderkey * 10 + l_linenumber AS line_id, max(l_partkey) AS l_partkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY 1 HAVING count(*) = 1")
def w06(spark, sf):
    rows = A.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_partkey", "l_quantity"
    )
    return U.drop_ambiguous(rows, "line_id", ["l_partkey", "l_quantity"])


@query("w07_distinct_codes", "SELECT DISTINCT p_name FROM part WHERE p_name <> ''")
def w07(spark, sf):
    return U.distinct_sorted(A.table(spark, sf, "part"), "p_name")


# ---- sets and shapes
@query("u01_union_all_columns", O.sql("SELECT CAST(d AS VARCHAR) AS day, count(*) AS n FROM (SELECT validity_start_date AS d FROM n_contracts UNION ALL SELECT validity_end_date FROM n_contracts UNION ALL SELECT risk_evaluation_date FROM n_contracts) WHERE d IS NOT NULL GROUP BY 1"))
def u01(spark, sf):
    from ledgerspan.plans.staging.contracts import normalize_contracts

    rows = normalize_contracts(A.raw(spark, sf, "contracts"))
    days = R.stack_columns(rows, ["validity_start_date", "validity_end_date", "risk_evaluation_date"], "day")
    return days.groupBy("day").agg(F.count("*").alias("n"))


@query("u02_union_distinct", O.sql("SELECT category_code FROM cat_codes"))
def u02(spark, sf):
    batch = Batch(spark, sf)
    return category_codes(batch.staged("contracts"), batch.staged("payments"))


@query("u03_append", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders UNION ALL SELECT l_orderkey, l_extendedprice, NULL FROM lineitem")
def u03(spark, sf):
    current = A.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = A.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice")
    )
    return R.append(current, new)


MEASURES = {"faturamento": "gross_revenue", "custo": "total_cost", "custo_folha": "payroll_cost", "lucro_bruto": "gross_profit", "juros_divida": "debt_interest", "lucro_liquido": "net_income"}


@query(
    "u04_unpivot_years",
    O.sql(
        " UNION ALL ".join(
            f"SELECT cnpj, CAST({y} AS BIGINT) AS financial_year, {', '.join(f'{s}_{y} AS {t}' for s, t in MEASURES.items())} FROM n_companies"
            for y in A.YEARS
        )
    ),
)
def u04(spark, sf):
    rows = companies.normalize_companies(A.raw(spark, sf, "companies"))
    return R.unpivot_years(rows, ["cnpj"], MEASURES, A.YEARS)


@query("u06_date_spine", "SELECT CAST(CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS day FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem)")
def u06(spark, sf):
    days = A.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return R.date_spine(R.date_bounds(days, ["day"]), "day")


@query("u07_subset_test", "SELECT count(*) AS orphans, count(*) = 0 AS is_subset FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM (SELECT * REPLACE (CASE WHEN s_suppkey % 9 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS s_suppkey) FROM supplier))")
def u07(spark, sf):
    parents = A.shifted(spark, sf, "supplier", "s_suppkey")
    missing = L.orphans(A.table(spark, sf, "lineitem"), "l_suppkey", parents, "s_suppkey")
    return missing.agg(F.count("*").alias("orphans"), (F.count("*") == 0).alias("is_subset"))


@query("u08_exception_union", O.sql("SELECT entity, business_key_type, count(*) AS n FROM exc_index GROUP BY ALL", **INDEX))
def u08(spark, sf):
    index = Q.exception_index(Batch(spark, sf).rejected(), A.BATCH_ID)
    return index.groupBy("entity", "business_key_type").agg(F.count("*").alias("n"))


@query("u09_key_remap", "SELECT l_orderkey, l_linenumber, 'S-' || s_name AS supplier_code FROM lineitem LEFT JOIN (SELECT * REPLACE (CASE WHEN s_suppkey % 9 = 4 THEN -1 - s_suppkey ELSE s_suppkey END AS s_suppkey) FROM supplier) ON l_suppkey = s_suppkey")
def u09(spark, sf):
    mapping = A.shifted(spark, sf, "supplier", "s_suppkey").select(
        F.col("s_suppkey").cast("string").alias("old"), F.concat(F.lit("S-"), "s_name").alias("new")
    )
    rows = A.table(spark, sf, "lineitem").select(*LINE, F.col("l_suppkey").cast("string").alias("supplier_code"))
    return L.remap(rows, "supplier_code", mapping, "old", "new")
