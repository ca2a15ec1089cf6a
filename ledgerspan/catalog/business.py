"""Business rules on tables.

Contracts, amendments and payments are moved 25 years ahead here, to the years of the risk
assessments and company figures, so that lookups by date have all outcomes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.registry import query
from ledgerspan.functions.text import prefixed_key
from ledgerspan.plans import exposure as X, rollforward as W, scoring as S
from ledgerspan.plans.staging.companies import normalize_companies

SHIFT = 9131
REF, SNAPSHOT = date(2024, 6, 30), date(2023, 12, 31)
REF_SQL, SNAPSHOT_SQL = f"DATE '{REF}'", f"DATE '{SNAPSHOT}'"

_start = f"(CAST(o_orderdate AS DATE) + CAST({SHIFT} AS INT))"
_ship = f"(CAST(l_shipdate AS DATE) + CAST({SHIFT} AS INT))"
TABLES = {
    "portfolio": {
        "table": "orders",
        "columns": {
            "contract_id": A.CONTRACT_ID,
            "supplier_cnpj": A.cnpj(A.ORDER_SUPPLIER),
            "contract_status": "CASE o_orderstatus WHEN 'O' THEN 'ativo' WHEN 'F' THEN 'vencido' ELSE 'encerrado' END",
            "validity_start_date": _start,
            "validity_end_date": A.days_after(_start, "30 + o_orderkey % 1500"),
            "risk_evaluation_date": "CAST(NULL AS DATE)",
            "final_risk": A.choose("o_orderkey", ["baixo", "medio", "alto"]),
            "closure_reason": "CAST(NULL AS STRING)",
            "original_value": A.cents(f"{A.cents('o_totalprice')} * 0.8"),
            "total_value": A.cents("o_totalprice"),
            "balance_value": A.cents(f"{A.cents('o_totalprice')} * CAST(o_orderkey % 10 AS DECIMAL(2,0)) * 0.1"),
            "months": A.big("6 + o_orderkey % 60"),
        },
    },
    "events_log": {
        "table": "lineitem",
        "columns": {
            "contract_id": A.LINE_CONTRACT_ID,
            "amendment_type": "CASE WHEN l_returnflag = 'R' THEN 'renovacao' ELSE 'aporte' END",
            "validity_start_date": _ship,
            "validity_end_date": A.days_after(_ship, "10 * CAST(l_quantity AS INT)"),
            "amendment_value": A.cents("l_extendedprice"),
            "amendment_sequence": A.big("(l_linenumber * 1000000 + l_partkey) * 100 + l_quantity"),
        },
    },
    "paid": {
        "table": "lineitem",
        "columns": {"contract_id": A.LINE_CONTRACT_ID, "payment_value": A.cents("l_extendedprice")},
    },
    "assessments": {
        "table": "events",
        "columns": {
            "risk_assessment_id": f"('RSK' || {A.padded('event_id', 9)})",
            "supplier_cnpj": A.cnpj(A.EVENT_SUPPLIER),
            "assessment_date": A._assessed,
            "expiration_date": f"CASE WHEN event_type <> 'error' THEN {A._expires} END",
            "homologation_result": "CASE WHEN event_type <> 'error' THEN 'aprovada' ELSE 'reprovada' END",
            "homologation_status": "CASE WHEN event_type = 'error' THEN 'negada' WHEN event_id % 3 = 0 THEN 'expirada' ELSE 'ativa' END",
            "final_risk": "CASE WHEN event_type = 'error' THEN 'alto' WHEN value > 60 THEN 'medio' ELSE 'baixo' END",
        },
    },
}
CTES = {n: O.select(t["columns"], t["table"], t.get("where")) for n, t in TABLES.items()}


def load(spark, sf, name: str) -> DataFrame:
    return A._project(A.table(spark, sf, TABLES[name]["table"]), TABLES[name])


def osql(body: str, **extra: str) -> str:
    return O.sql(body, **CTES, **extra)


def inputs(spark, sf) -> DataFrame:
    return S.risk_inputs(normalize_companies(A.raw(spark, sf, "companies")))


INPUTS = " UNION ALL ".join(
    f"SELECT cnpj, CAST({y} AS BIGINT) AS financial_year, cenario_financeiro, juros_divida_{y} / nullif(faturamento_{y}, 0) AS interest_to_revenue_ratio, "
    + ("0.0::DOUBLE" if y == 2022 else f"faturamento_{y} / nullif(faturamento_{y - 1}, 0) - 1")
    + f" AS revenue_trend, lucro_liquido_{y} / nullif(faturamento_{y}, 0) AS net_margin,"
    " CAST(processos_trabalhistas AS DOUBLE) / greatest(CAST(num_total_func AS DOUBLE), 1) * 100 AS labor_cases_index FROM n_companies"
    for y in A.YEARS
)
SCORED = """SELECT *, CASE WHEN financial_points >= 4 THEN 'Alto' WHEN financial_points >= 2 THEN 'Médio' ELSE 'Baixo' END AS financial_risk,
  CASE WHEN labor_cases_index > 8 THEN 'Alto' WHEN labor_cases_index > 3 THEN 'Médio' ELSE 'Baixo' END AS labor_risk,
  ['AAA','AA','A','BBB','BB','B','CCC','CC'][CAST(financial_points AS INTEGER) + 1] AS credit_rating
FROM (SELECT *, CAST((CASE WHEN interest_to_revenue_ratio >= 0.045 THEN 2 WHEN interest_to_revenue_ratio >= 0.025 THEN 1 ELSE 0 END)
  + (CASE WHEN revenue_trend <= -0.08 THEN 2 WHEN revenue_trend <= 0 THEN 1 ELSE 0 END)
  + (CASE WHEN net_margin <= 0.03 THEN 2 WHEN net_margin <= 0.08 THEN 1 ELSE 0 END)
  + (CASE WHEN cenario_financeiro = 'Em decadência' THEN 1 ELSE 0 END) AS BIGINT) AS financial_points FROM inputs)"""
FINAL = "CASE WHEN 'Alto' IN (financial_risk, labor_risk) THEN 'Alto' WHEN 'Médio' IN (financial_risk, labor_risk) THEN 'Médio' ELSE 'Baixo' END"
SCORING = {"inputs": INPUTS, "scored": SCORED}
FOUR = ", ".join(
    f"round_even({c} * 10000, 0) / 10000 AS {c}"
    for c in ("interest_to_revenue_ratio", "revenue_trend", "net_margin", "labor_cases_index")
)


@query("r01_risk_inputs", osql(f"SELECT cnpj, financial_year, cenario_financeiro, {FOUR} FROM inputs", **SCORING))
def r01(spark, sf):
    return S.rounded_inputs(inputs(spark, sf))


@query("r02_financial_risk", osql("SELECT cnpj, financial_year, financial_points, financial_risk FROM scored", **SCORING))
def r02(spark, sf):
    return S.score(inputs(spark, sf)).select("cnpj", "financial_year", "financial_points", "financial_risk")


@query("r03_labor_risk", osql("SELECT cnpj, financial_year, labor_risk FROM scored", **SCORING))
def r03(spark, sf):
    return S.score(inputs(spark, sf)).select("cnpj", "financial_year", "labor_risk")


@query("r04_credit_rating", osql("SELECT cnpj, financial_year, credit_rating FROM scored", **SCORING))
def r04(spark, sf):
    return S.score(inputs(spark, sf)).select("cnpj", "financial_year", "credit_rating")


@query(
    "r05_approval_outcome",
    osql(
        f"""SELECT cnpj, financial_year, final_risk, CASE WHEN final_risk <> 'Alto' THEN 'Aprovada' ELSE 'Reprovada' END AS homologation_result,
  CASE WHEN final_risk <> 'Alto' THEN (financial_year + 3) || '-12-31' END AS expiration_date,
  CASE WHEN final_risk = 'Alto' THEN 'Negada' WHEN make_date(financial_year + 3, 12, 31) < {REF_SQL} THEN 'Expirada' ELSE 'Ativa' END AS homologation_status
FROM (SELECT *, {FINAL} AS final_risk FROM scored)""",
        **SCORING,
    ),
)
def r05(spark, sf):
    rows = S.approval_outcome(S.score(inputs(spark, sf)), REF)
    return rows.select("cnpj", "financial_year", "final_risk", "homologation_result", "expiration_date", "homologation_status")


@query(
    "r06_size_and_stage_bands",
    "SELECT o_orderkey, CASE WHEN o_totalprice * 30 < 360000 THEN 'Microempresa' WHEN o_totalprice * 30 < 3600000 THEN 'Pequeno' WHEN o_totalprice * 30 < 10000000 THEN 'Médio' ELSE 'Grande' END AS company_size,"
    " CASE WHEN o_orderkey % 60 <= 7 THEN 'Jovem' WHEN o_orderkey % 60 <= 15 THEN 'Em crescimento' WHEN o_orderkey % 60 <= 35 THEN 'Madura' ELSE 'Consolidada' END AS company_stage FROM orders",
)
def r06(spark, sf):
    return A.table(spark, sf, "orders").select(
        "o_orderkey",
        S.company_size(F.col("o_totalprice") * 30).alias("company_size"),
        S.company_stage(F.col("o_orderkey") % 60).alias("company_stage"),
    )


AS_OF = """SELECT p.contract_id, p.validity_start_date, a.risk_assessment_id, a.assessment_date, a.homologation_result, a.final_risk AS assessed_risk,
  row_number() OVER (PARTITION BY p.contract_id ORDER BY CASE WHEN year(a.assessment_date) = year(p.validity_start_date) THEN 0 ELSE 1 END,
    a.assessment_date DESC, a.risk_assessment_id DESC) AS r
FROM portfolio p LEFT JOIN assessments a ON p.supplier_cnpj = a.supplier_cnpj
  AND (year(a.assessment_date) = year(p.validity_start_date) OR a.assessment_date <= p.validity_start_date)"""


def as_of_entry(name: str) -> None:
    body = "SELECT contract_id, risk_assessment_id AS as_of_assessment_id, CAST(assessment_date AS VARCHAR) AS as_of_assessment_date, homologation_result AS as_of_result, assessed_risk AS as_of_final_risk FROM as_of WHERE r = 1"

    @query(name, osql(body, as_of=AS_OF))
    def build(spark, sf):
        rows = load(spark, sf, "portfolio").select("contract_id", "supplier_cnpj", "validity_start_date")
        found = W.risk_as_of(rows, load(spark, sf, "assessments"), "validity_start_date")
        return found.drop("supplier_cnpj", "validity_start_date")


as_of_entry("j15_as_of_lookup")
as_of_entry("r07_risk_at_contract_start")

LIMITS = " UNION ALL ".join(
    f"SELECT cnpj AS supplier_cnpj, CAST({y} AS BIGINT) AS financial_year, CAST(CAST(faturamento_{y} AS DECIMAL(20,2)) * 0.1500 AS DECIMAL(18,2)) AS annual_limit FROM n_companies WHERE cnpj <> ''"
    for y in A.YEARS
)


@query(
    "r08_exposure",
    osql(
        """SELECT l.supplier_cnpj, l.financial_year, CAST(annual_limit AS DOUBLE) AS annual_limit, CAST(coalesce(u, 0) AS DOUBLE) AS used_exposure,
  CAST(annual_limit - coalesce(u, 0) AS DOUBLE) AS remaining_capacity FROM limits l LEFT JOIN (SELECT supplier_cnpj,
    least(greatest(year(validity_start_date), 2022), 2026) AS y, sum(CAST(original_value AS DECIMAL(38,2))) AS u FROM portfolio GROUP BY 1, 2) x
  ON l.supplier_cnpj = x.supplier_cnpj AND l.financial_year = x.y""",
        limits=LIMITS,
    ),
)
def r08(spark, sf):
    return X.exposure(normalize_companies(A.raw(spark, sf, "companies")), load(spark, sf, "portfolio"), 0.15)


CYCLES = """SELECT p.contract_id, CAST(0 AS BIGINT) AS cycle_number, p.validity_start_date AS cycle_start, coalesce(f - 1, p.validity_end_date) AS cycle_end,
  p.original_value AS cycle_value FROM portfolio p LEFT JOIN (SELECT contract_id, min(validity_start_date) AS f FROM events_log WHERE amendment_type = 'renovacao' GROUP BY 1) e
  ON p.contract_id = e.contract_id
UNION ALL SELECT e.contract_id, amendment_sequence, e.validity_start_date, e.validity_end_date, amendment_value FROM events_log e WHERE contract_id IN (SELECT contract_id FROM portfolio)"""


def cycles(spark, sf) -> DataFrame:
    return X.contract_cycles(load(spark, sf, "portfolio"), load(spark, sf, "events_log"))


@query("r09_contract_cycles", osql(f"SELECT {O.show('contract_id cycle_number cycle_start:d cycle_end:d cycle_value:n')} FROM cycles", cycles=CYCLES))
def r09(spark, sf):
    return cycles(spark, sf)


ALLOCATED = f"""SELECT contract_id, cycle_number, exceeds, CASE WHEN NOT usable THEN 0 WHEN rn = n THEN amount - coalesce(sum(share) OVER (PARTITION BY contract_id, usable, last_flag), 0) ELSE share END AS cents
FROM (SELECT *, rn = n AS is_last, 1 AS last_flag, CASE WHEN usable AND rn < n THEN (2 * CAST(amount AS HUGEINT) * weight + total) // (2 * total) ELSE 0 END AS share
FROM (SELECT *, ok AND amount > 0 AND total > 0 AND NOT exceeds AS usable FROM (SELECT *, amount > total + 1 AS exceeds,
  row_number() OVER (PARTITION BY contract_id, ok ORDER BY cycle_number) AS rn, count(*) OVER (PARTITION BY contract_id, ok) AS n
FROM (SELECT c.contract_id, c.cycle_number, c.cycle_start <= {REF_SQL} AS ok, CAST((p.total_value - p.balance_value) * 100 AS BIGINT) AS amount,
  CASE WHEN c.cycle_start <= {REF_SQL} THEN CAST(c.cycle_value * 100 AS BIGINT) ELSE 0 END AS weight,
  CAST(sum(CASE WHEN c.cycle_start <= {REF_SQL} THEN CAST(c.cycle_value * 100 AS BIGINT) ELSE 0 END) OVER (PARTITION BY c.contract_id) AS HUGEINT) AS total
FROM cycles c JOIN portfolio p ON c.contract_id = p.contract_id))))"""


@query("r10_allocation", osql("SELECT contract_id, cycle_number, CAST(cents AS DOUBLE) / 100 AS allocated_value, exceeds AS allocated_value_exceeds FROM allocated", cycles=CYCLES, allocated=ALLOCATED))
def r10(spark, sf):
    rows = X.allocate_consumption(cycles(spark, sf), load(spark, sf, "portfolio"), F.lit(REF))
    return rows.select("contract_id", "cycle_number", "allocated_value", "allocated_value_exceeds")


@query(
    "r11_run_rate",
    osql(
        f"""SELECT contract_id, round(rate, 6) AS daily_rate, CAST(remaining AS DOUBLE) AS remaining_capacity, round(least(rate * {(REF - SNAPSHOT).days}, CAST(remaining AS DOUBLE)), 2) AS increment
FROM (SELECT t.contract_id, rate, greatest(capacity - (total_value - balance_value), 0) AS remaining FROM (SELECT contract_id,
  sum(CASE WHEN cycle_start <= {REF_SQL} AND cycle_end > {SNAPSHOT_SQL} THEN CAST(cycle_value AS DOUBLE) / greatest(date_diff('day', cycle_start, cycle_end) + 1, 1) ELSE 0 END) AS rate,
  coalesce(sum(CASE WHEN cycle_start <= {REF_SQL} THEN CAST(cycle_value AS DECIMAL(38,2)) END), 0) AS capacity FROM cycles GROUP BY 1) t JOIN portfolio p ON t.contract_id = p.contract_id)""",
        cycles=CYCLES,
    ),
)
def r11(spark, sf):
    consumed = load(spark, sf, "portfolio").select(
        "contract_id", (F.col("total_value") - F.col("balance_value")).alias("consumed_value")
    )
    rows = X.run_rate(cycles(spark, sf), consumed, SNAPSHOT, REF)
    return rows.withColumns({"daily_rate": F.round("daily_rate", 6), "increment": F.round("increment", 2)})


@query(
    "r12_payment_schedule",
    osql(
        "SELECT contract_id, CAST(due AS VARCHAR) AS due_date FROM (SELECT contract_id, validity_start_date, validity_end_date, CAST(date_trunc('month', validity_start_date) + to_months(CAST(i AS INTEGER)) AS DATE)"
        " + CAST(list_min(list_append(list_transform(range(0, i + 1), lambda j: day(last_day(CAST(date_trunc('month', validity_start_date) + to_months(CAST(j AS INTEGER)) AS DATE)))), day(validity_start_date))) AS INTEGER) - 1 AS due, i"
        " FROM (SELECT *, unnest(range(0, date_diff('month', validity_start_date, greatest(validity_start_date, validity_end_date)) + 2)) AS i FROM portfolio)) WHERE i = 0 OR due <= validity_end_date"
    ),
)
def r12(spark, sf):
    rows = load(spark, sf, "portfolio").select(
        "contract_id", F.col("validity_start_date").alias("cycle_start"), F.col("validity_end_date").alias("cycle_end")
    )
    return X.payment_schedule(rows).select("contract_id", "due_date")


@query(
    "r13_payment_balance_check",
    osql(
        "SELECT p.contract_id, CAST(total_value - balance_value AS DOUBLE) AS expected_value, CAST(coalesce(v, 0) AS DOUBLE) AS paid_value, coalesce(v, 0) = total_value - balance_value AS is_reconciled"
        " FROM portfolio p LEFT JOIN (SELECT contract_id, sum(CAST(payment_value AS DECIMAL(38,2))) AS v FROM paid GROUP BY 1) x ON p.contract_id = x.contract_id WHERE contract_status = 'vencido'"
    ),
)
def r13(spark, sf):
    return X.payment_balance_check(load(spark, sf, "portfolio"), load(spark, sf, "paid"))


@query(
    "r14_elapsed_share",
    osql(
        f"""SELECT contract_id, gone / days AS elapsed_fraction, 1 - gone / days AS expected_balance_share, validity_end_date < {REF_SQL} AS is_expired FROM (SELECT *,
  CAST(greatest(date_diff('day', validity_start_date, validity_end_date), 1) AS DOUBLE) AS days,
  CAST(least(greatest(date_diff('day', validity_start_date, {REF_SQL}), 0), greatest(date_diff('day', validity_start_date, validity_end_date), 1)) AS DOUBLE) AS gone FROM portfolio)"""
    ),
)
def r14(spark, sf):
    return X.elapsed_share(load(spark, sf, "portfolio"), REF)


@query(
    "r15_renewal_cycles",
    osql(
        f"""SELECT contract_id, n AS cycle_number, CAST(cycle_start AS VARCHAR) AS cycle_start, CAST(least(CAST(validity_start_date + to_months(CAST(12 * (n + 1) AS INTEGER)) AS DATE) - 1, validity_end_date) AS VARCHAR) AS cycle_end
FROM (SELECT *, CAST(validity_start_date + to_months(CAST(12 * n AS INTEGER)) AS DATE) AS cycle_start FROM (SELECT *, unnest(generate_series(1, greatest(1, (months - 1) // 12))) AS n FROM portfolio))
WHERE cycle_start <= {REF_SQL}"""
    ),
)
def r15(spark, sf):
    return X.renewal_cycles(load(spark, sf, "portfolio"), "months", REF)


CURRENT = f"""SELECT s.supplier_cnpj, a.homologation_result, a.assessment_date, a.final_risk AS assessed_risk, row_number() OVER (PARTITION BY s.supplier_cnpj
  ORDER BY CASE WHEN year(a.assessment_date) = {REF.year} THEN 0 ELSE 1 END, a.assessment_date DESC, a.risk_assessment_id DESC) AS r
FROM (SELECT DISTINCT supplier_cnpj FROM portfolio) s LEFT JOIN assessments a ON s.supplier_cnpj = a.supplier_cnpj
  AND (year(a.assessment_date) = {REF.year} OR a.assessment_date <= {REF_SQL})"""


@query(
    "r16_close_unapproved",
    osql(
        f"""SELECT contract_id, CASE WHEN closed THEN 'encerrado' ELSE contract_status END AS contract_status,
  CAST(CASE WHEN closed THEN {REF_SQL} - 1 ELSE validity_end_date END AS VARCHAR) AS validity_end_date,
  CAST(CASE WHEN closed THEN assessment_date ELSE risk_evaluation_date END AS VARCHAR) AS risk_evaluation_date,
  CASE WHEN closed THEN coalesce(assessed_risk, final_risk) ELSE final_risk END AS final_risk,
  CASE WHEN closed THEN 'Homologação negada por risco final alto' ELSE closure_reason END AS closure_reason
FROM (SELECT p.*, c.assessment_date, c.assessed_risk, contract_status <> 'encerrado' AND validity_end_date >= {REF_SQL} AND coalesce(c.homologation_result <> 'aprovada', true) AS closed
  FROM portfolio p LEFT JOIN (SELECT * FROM latest_now WHERE r = 1) c ON p.supplier_cnpj = c.supplier_cnpj)""",
        latest_now=CURRENT,
    ),
)
def r16(spark, sf):
    rows = W.close_unapproved(load(spark, sf, "portfolio"), load(spark, sf, "assessments"), REF)
    return rows.select("contract_id", "contract_status", "validity_end_date", "risk_evaluation_date", "final_risk", "closure_reason")


@query("r17_expire_assessments", osql(f"SELECT risk_assessment_id, CASE WHEN homologation_result = 'aprovada' AND expiration_date < {REF_SQL} - 1000 THEN 'expirada' ELSE homologation_status END AS homologation_status FROM assessments"))
def r17(spark, sf):
    from datetime import timedelta

    rows = W.expire_assessments(load(spark, sf, "assessments"), REF - timedelta(days=1000))
    return rows.select("risk_assessment_id", "homologation_status")


@query("r17_expire_contracts", osql(f"SELECT contract_id, CASE WHEN contract_status = 'ativo' AND validity_end_date < {REF_SQL} THEN 'vencido' ELSE contract_status END AS contract_status FROM portfolio"))
def r17c(spark, sf):
    return W.expire_contracts(load(spark, sf, "portfolio"), REF).select("contract_id", "contract_status")


@query("r18_reassessment_candidates", osql("SELECT supplier_cnpj, risk_assessment_id, CAST(assessment_date AS VARCHAR) AS assessment_date FROM (SELECT *, row_number() OVER (PARTITION BY supplier_cnpj ORDER BY assessment_date DESC, risk_assessment_id DESC) AS r FROM assessments WHERE homologation_result = 'aprovada' AND homologation_status = 'expirada') WHERE r = 1"))
def r18(spark, sf):
    rows = W.reassessment_candidates(load(spark, sf, "assessments"))
    return rows.select("supplier_cnpj", "risk_assessment_id", "assessment_date")


@query(
    "r19_append_with_new_ids",
    "SELECT 'CS' || lpad(CAST(m + row_number() OVER (ORDER BY c_custkey) AS VARCHAR), CAST(greatest(8, length(CAST(m + row_number() OVER (ORDER BY c_custkey) AS VARCHAR))) AS INT), '0') AS contract_id, 'NEW-' || c_custkey AS old_contract_id FROM customer, (SELECT max(o_orderkey) AS m FROM orders)",
)
def r19(spark, sf):
    current = load(spark, sf, "portfolio").select("contract_id")
    new = A.table(spark, sf, "customer").select("c_custkey", prefixed_key("NEW-", "c_custkey").alias("contract_id"))
    return W.renumber(new, current, "contract_id", "CS", 8, "c_custkey").select("contract_id", "old_contract_id")


@query(
    "r19_remapped_amendments",
    "SELECT o_orderkey, 'CS' || lpad(CAST(m + r AS VARCHAR), CAST(greatest(8, length(CAST(m + r AS VARCHAR))) AS INT), '0') AS contract_id FROM orders LEFT JOIN (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS r"
    " FROM (SELECT * REPLACE (CASE WHEN c_custkey % 9 = 4 THEN -1 - c_custkey ELSE c_custkey END AS c_custkey) FROM customer)) ON o_custkey = c_custkey, (SELECT max(o_orderkey) AS m FROM orders)",
)
def r19m(spark, sf):
    current = load(spark, sf, "portfolio").select("contract_id")
    new = A.shifted(spark, sf, "customer", "c_custkey").select("c_custkey", prefixed_key("NEW-", "c_custkey").alias("contract_id"))
    renumbered = W.renumber(new, current, "contract_id", "CS", 8, "c_custkey")
    events = A.table(spark, sf, "orders").select("o_orderkey", prefixed_key("NEW-", "o_custkey").alias("contract_id"))
    return W.remap_amendments(events, renumbered)
