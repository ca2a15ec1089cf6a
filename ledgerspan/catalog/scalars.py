"""Column functions over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspan.catalog import adapters as A, oracle as O
from ledgerspan.catalog.registry import query
from ledgerspan.functions import dates as D, numbers as N, text as T
from ledgerspan.operators.lookup import calendar_roles
from ledgerspan.plans.curated.categories import cost_center_of

BLANK_CHARS = "' ' || chr(9) || chr(10) || chr(13)"


@query("f01_digits_only", f"SELECT l_orderkey, l_linenumber, {O.digits(A.dotted(A.cnpj('l_suppkey')))} AS cnpj FROM lineitem")
def f01(spark, sf):
    dotted = F.expr(A.dotted(A.cnpj("l_suppkey")))
    return A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", T.digits_only(dotted).alias("cnpj"))


@query("f02_code", O.sql('SELECT "Cód_Contrato" AS source_code, ' + O.blank_code('"Cód_Contrato"') + " AS contract_id FROM raw_contracts"))
def f02(spark, sf):
    rows = A.raw(spark, sf, "contracts")
    return rows.select(F.col("Cód_Contrato").alias("source_code"), T.code("Cód_Contrato").alias("contract_id"))


@query(
    "f03_enum_slug",
    O.sql(
        "SELECT part_slug, priority_slug, count(*) AS n FROM ("
        f"SELECT {O.slug('p_name')} AS part_slug, {O.slug('o_orderpriority')} AS priority_slug"
        " FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL"
        f" UNION ALL SELECT {O.slug(chr(34) + 'Escopo' + chr(34))}, {O.slug(chr(34) + 'Tipo_Contrato' + chr(34))}, count(*) FROM raw_contracts GROUP BY ALL"
    ),
)
def f03(spark, sf):
    lines = A.table(spark, sf, "lineitem").select("l_partkey", "l_orderkey")
    parts = A.table(spark, sf, "part").select("p_partkey", T.enum_slug("p_name").alias("part_slug"))
    orders = A.table(spark, sf, "orders").select("o_orderkey", T.enum_slug("o_orderpriority").alias("priority_slug"))
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    labels = A.raw(spark, sf, "contracts").select(
        T.enum_slug("Escopo").alias("part_slug"), T.enum_slug("Tipo_Contrato").alias("priority_slug")
    )
    counted = lambda df: df.groupBy("part_slug", "priority_slug").agg(F.count("*").alias("n"))
    return counted(joined).unionByName(counted(labels))


@query("f04_trim", f"SELECT doc_id, md5(trim(text, {BLANK_CHARS})) AS trimmed, CAST(length(trim(text, {BLANK_CHARS})) AS BIGINT) AS n FROM documents")
def f04(spark, sf):
    trimmed = T.strip("text")
    return A.table(spark, sf, "documents").select(
        "doc_id", F.md5(trimmed).alias("trimmed"), F.length(trimmed).cast("bigint").alias("n")
    )


@query("f05_blank_to_null", O.sql("SELECT nullif(trim(\"Motivo_Encerramento\"), '') AS closure_reason, count(*) AS n FROM raw_contracts GROUP BY ALL"))
def f05(spark, sf):
    reason = T.strip_to_null("Motivo_Encerramento").alias("closure_reason")
    return A.raw(spark, sf, "contracts").groupBy(reason).agg(F.count("*").alias("n"))


@query("f06_trim_upper", O.sql('SELECT upper(trim("Rating_Credito")) AS rating, count(*) AS n FROM raw_risk GROUP BY ALL'))
def f06(spark, sf):
    return A.raw(spark, sf, "risk").groupBy(T.strip_upper("Rating_Credito").alias("rating")).agg(F.count("*").alias("n"))


@query("f07_group_root", f"SELECT s_suppkey, substr({A.cnpj('s_suppkey')}, 1, 8) AS cnpj8 FROM supplier")
def f07(spark, sf):
    return A.table(spark, sf, "supplier").select("s_suppkey", T.group_root(F.expr(A.cnpj("s_suppkey"))).alias("cnpj8"))


@query(
    "f08_lenient_date",
    O.sql(
        "SELECT source_text, CAST(parsed AS VARCHAR) AS parsed, count(*) AS n FROM ("
        + " UNION ALL ".join(
            f'SELECT {c} AS source_text, {O.lenient_date(c)} AS parsed FROM {t}'
            for c, t in (('"Vigência Inicio"', "raw_contracts"), ('"Data_Avaliacao_Risco"', "raw_contracts"), ('"Vigência_Inicio"', "raw_amendments"))
        )
        + ") GROUP BY ALL"
    ),
)
def f08(spark, sf):
    sides = [
        A.raw(spark, sf, source).select(F.col(c).alias("source_text"), D.lenient_date(c).alias("parsed"))
        for source, c in (
            ("contracts", "Vigência Inicio"), ("contracts", "Data_Avaliacao_Risco"), ("amendments", "Vigência_Inicio")
        )
    ]
    rows = sides[0].unionByName(sides[1]).unionByName(sides[2])
    return rows.groupBy("source_text", "parsed").agg(F.count("*").alias("n"))


@query(
    "f09_lenient_number",
    O.sql(
        'SELECT "CNPJ" AS cnpj, try_cast("Processos_Trabalhistas" AS BIGINT) AS cases, try_cast("Capital_Social" AS DOUBLE) AS capital,'
        ' try_cast("Faturamento_2024" AS DOUBLE) AS revenue FROM raw_companies'
    ),
)
def f09(spark, sf):
    return A.raw(spark, sf, "companies").select(
        F.col("CNPJ").alias("cnpj"),
        N.lenient_bigint("Processos_Trabalhistas").alias("cases"),
        N.lenient_double("Capital_Social").alias("capital"),
        N.lenient_double("Faturamento_2024").alias("revenue"),
    )


@query("f10_money", O.sql('SELECT "Nome_Contrato" AS name, CAST(try_cast("Valor_Total" AS DECIMAL(18,2)) AS DOUBLE) AS total, CAST(try_cast("Saldo" AS DECIMAL(18,2)) AS DOUBLE) AS balance FROM raw_contracts'))
def f10(spark, sf):
    return A.raw(spark, sf, "contracts").select(
        F.col("Nome_Contrato").alias("name"), N.money("Valor_Total").alias("total"), N.money("Saldo").alias("balance")
    )


@query(
    "f11_full_match",
    O.sql(
        "SELECT p.payment_id, "
        f"{O.full('p.payment_id', 'PAG[0-9]{8}')} AS is_payment_id, {O.full('p.contract_id', 'CS[0-9]{8}')} AS is_contract_id, "
        f"{O.full('p.supplier_cnpj', '[0-9]{14}')} AS is_cnpj, {O.full('p.supplier_cnpj8', '[0-9]{8}')} AS is_root, "
        f"{O.full('p.cost_center', 'CC-[0-9]{3}')} AS is_cost_center, {O.full('p.payment_id', 'RSK[0-9]{9}')} AS is_risk_id FROM n_payments p"
    ),
)
def f11(spark, sf):
    from ledgerspan.plans.staging.payments import normalize_payments

    rows = normalize_payments(A.raw(spark, sf, "payments"))
    checks = {
        "is_payment_id": ("payment_id", T.PAYMENT_ID_FORMAT),
        "is_contract_id": ("contract_id", T.CONTRACT_ID_FORMAT),
        "is_cnpj": ("supplier_cnpj", T.CNPJ_FORMAT),
        "is_root": ("supplier_cnpj8", T.CNPJ_ROOT_FORMAT),
        "is_cost_center": ("cost_center", T.COST_CENTER_FORMAT),
        "is_risk_id": ("payment_id", T.RISK_ID_FORMAT),
    }
    return rows.select("payment_id", *[T.matches(c, p).alias(n) for n, (c, p) in checks.items()])


@query("f12_amendment_id", O.sql("SELECT amendment_id, count(*) AS n FROM n_amendments GROUP BY ALL"))
def f12(spark, sf):
    from ledgerspan.plans.staging.amendments import normalize_amendments

    return normalize_amendments(A.raw(spark, sf, "amendments")).groupBy("amendment_id").agg(F.count("*").alias("n"))


@query("f13_highest_risk", O.sql("SELECT financial_risk, labor_risk, expected_risk, count(*) AS n FROM f_risk GROUP BY ALL"))
def f13(spark, sf):
    from ledgerspan.plans.staging.risk import normalize_risk

    rows = normalize_risk(A.raw(spark, sf, "risk"))
    expected = N.highest_risk("financial_risk", "labor_risk").alias("expected_risk")
    return rows.groupBy("financial_risk", "labor_risk", expected).agg(F.count("*").alias("n"))


MONTHS = "['janeiro','fevereiro','marco','abril','maio','junho','julho','agosto','setembro','outubro','novembro','dezembro']"
DAYS = "['segunda-feira','terca-feira','quarta-feira','quinta-feira','sexta-feira','sabado','domingo']"
CALENDAR_SQL = f"""CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS calendar_key, CAST(d AS VARCHAR) AS calendar_date,
  CAST(year(d) AS BIGINT) AS calendar_year, CAST((month(d) - 1) // 6 + 1 AS BIGINT) AS calendar_semester, CAST(quarter(d) AS BIGINT) AS calendar_quarter,
  year(d) || '-T' || quarter(d) AS year_quarter, CAST(month(d) AS BIGINT) AS calendar_month, {MONTHS}[month(d)] AS month_name,
  strftime(d, '%Y-%m') AS year_month, CAST(week(d) AS BIGINT) AS calendar_week, CAST(day(d) AS BIGINT) AS day_of_month,
  CAST(isodow(d) AS BIGINT) AS day_of_week, {DAYS}[isodow(d)] AS day_name, isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start,
  d = last_day(d) AS is_month_end, (month(d) = 1 AND day(d) = 1) AS is_year_start, (month(d) = 12 AND day(d) = 31) AS is_year_end"""


@query("f14_calendar_attributes", f"SELECT {CALENDAR_SQL}, n FROM (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)")
def f14(spark, sf):
    days = A.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d")).agg(F.count("*").alias("n"))
    return days.select(*[c.alias(n) for n, c in D.calendar_attributes("d").items()], "n")


@query(
    "f15_category_label",
    "SELECT code, upper(substr(replace(code, '_', ' '), 1, 1)) || lower(substr(replace(code, '_', ' '), 2)) AS label, n"
    f" FROM (SELECT {O.slug('p_name')} AS code, count(*) AS n FROM part GROUP BY 1)",
)
def f15(spark, sf):
    codes = A.table(spark, sf, "part").groupBy(T.enum_slug("p_name").alias("code")).agg(F.count("*").alias("n"))
    return codes.select("code", T.category_label("code").alias("label"), "n")


@query("f16_safe_ratio", "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_tax, 0) AS ratio FROM lineitem")
def f16(spark, sf):
    ratio = N.safe_ratio(F.col("l_extendedprice"), F.col("l_tax")).alias("ratio")
    return A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", ratio)


LINES_ORDERS = "lineitem JOIN orders ON l_orderkey = o_orderkey"


@query("f17_days_between", f"SELECT l_orderkey, l_linenumber, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS days FROM {LINES_ORDERS}")
def f17(spark, sf):
    lines, orders = A.table(spark, sf, "lineitem"), A.table(spark, sf, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = D.days_between(F.to_date("o_orderdate"), F.to_date("l_shipdate"))
    return joined.select("l_orderkey", "l_linenumber", days.alias("days"))


@query("f18_add_days", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS d30, CAST(CAST(o_orderdate AS DATE) + 90 AS VARCHAR) AS d90 FROM orders")
def f18(spark, sf):
    day = F.to_date("o_orderdate")
    return A.table(spark, sf, "orders").select("o_orderkey", F.date_add(day, 30).alias("d30"), F.date_add(day, 90).alias("d90"))


@query("f19_year_start", "SELECT CAST(CAST(date_trunc('year', o_orderdate) AS DATE) AS VARCHAR) AS year_start, count(*) AS n FROM orders GROUP BY 1")
def f19(spark, sf):
    start = D.year_start(F.to_date("o_orderdate")).alias("year_start")
    return A.table(spark, sf, "orders").groupBy(start).agg(F.count("*").alias("n"))


BAND = (
    "CASE WHEN {d} < {t} THEN 'expired' WHEN {d} <= {t} + 30 THEN 'expires_in_30_days' WHEN {d} <= {t} + 60 THEN 'expires_in_60_days'"
    " WHEN {d} <= {t} + 90 THEN 'expires_in_90_days' ELSE 'outside_renewal_window' END"
)


@query("f20_expiry_band", f"SELECT {BAND.format(d='CAST(o_orderdate AS DATE)', t=f'DATE {O.lit(A.AS_OF)}')} AS band, count(*) AS n FROM orders GROUP BY 1")
def f20(spark, sf):
    band = D.expiry_band(F.to_date("o_orderdate"), F.lit(A.AS_OF).cast("date")).alias("band")
    return A.table(spark, sf, "orders").groupBy(band).agg(F.count("*").alias("n"))


@query("f21_null_to_zero", O.sql('SELECT "CNPJ" AS cnpj, coalesce(try_cast("Faturamento_2024" AS DOUBLE), 0) AS revenue FROM raw_companies'))
def f21(spark, sf):
    revenue = N.or_zero(N.lenient_double("Faturamento_2024")).alias("revenue")
    return A.raw(spark, sf, "companies").select(F.col("CNPJ").alias("cnpj"), revenue)


@query(
    "f22_calendar_keys",
    # every ninth order lies a thousand years off the calendar, so that misses show
    O.sql(
        "SELECT o_orderkey, c.calendar_key AS order_calendar_key FROM orders LEFT JOIN dim_calendar c"
        " ON CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 9 = 4 THEN 365250 ELSE 0 END AS INTEGER) = c.calendar_date"
    ),
)
def f22(spark, sf):
    off = F.when(F.col("o_orderkey") % 9 == 4, 365250).otherwise(0)
    rows = A.table(spark, sf, "orders").select("o_orderkey", F.date_add(F.to_date("o_orderdate"), off).alias("order_date"))
    return calendar_roles(rows, A.calendar(spark, sf), ["order_date"]).drop("order_date")


COSTS = " ".join(
    f"WHEN {O.lit(k)} THEN {O.lit(v)}"
    for k, v in {
        "Aquisição de Equipamentos": "CC-100", "Consultoria": "CC-200", "Licença de Software": "CC-300",
        "Manutenção e Suporte": "CC-400", "Outsourcing de TI": "CC-500", "Serviços de Logística": "CC-600",
        "Treinamento e Capacitação": "CC-700", "Serviços de Infraestrutura": "CC-800",
    }.items()
)


@query("j13_static_lookup", O.sql(f'SELECT "Categoria" AS label, CASE "Categoria" {COSTS} END AS cost_center, count(*) AS n FROM raw_payments GROUP BY ALL'))
def j13(spark, sf):
    rows = A.raw(spark, sf, "payments")
    center = cost_center_of(F.col("Categoria")).alias("cost_center")
    return rows.groupBy(F.col("Categoria").alias("label"), center).agg(F.count("*").alias("n"))
