"""Operators against brute force on small random data, with one key holding most of the rows."""

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F
from pytest import mark, raises

from ledgerspan.functions.numbers import lenient_bigint, lenient_double, money
from ledgerspan.functions.dates import lenient_date
from ledgerspan.functions.text import category_label, enum_slug, matches, strip
from ledgerspan.operators.allocate import allocate
from ledgerspan.operators.intervals import as_of_in_year, flag_contained
from ledgerspan.operators.lookup import AmbiguousKeyError, assert_unique, flag_member
from ledgerspan.operators.ordering import dense_positions, dense_rank_desc
from ledgerspan.operators.reshape import append, key_set_comparison, monthly_schedule
from ledgerspan.operators.uniqueness import drop_ambiguous, flag_repeated, latest_per_key

DAY = date(2024, 1, 1)


def one_column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in rows.select("i", expression("v").alias("x")).orderBy("i").collect()]


def test_text_functions(spark):
    assert one_column(spark, [" a ", "\ta\n", "　á　", "", None], strip) == ["a", "a", "á", "", None]
    assert one_column(spark, ["Licença de Software", " Médio ", "ü-x", None, "__"], enum_slug) == [
        "licenca_de_software", "medio", "x", "", "",
    ]
    assert one_column(spark, ["categoria_NOVA_x"], category_label) == ["Categoria nova x"]
    assert one_column(spark, ["CS00000001", "CS00000001\n", "xCS00000001", None], lambda c: matches(c, r"CS\d{8}")) == [
        True, False, False, False,
    ]


def test_lenient_parsers(spark):
    assert one_column(spark, ["1.5", " 2 ", "1d", "NaN", "Infinity", "0x1p3", "1e3", "", None, "-.5"], lenient_double) == [
        1.5, 2.0, None, None, None, None, 1000.0, None, None, -0.5,
    ]
    assert one_column(spark, ["12", "12.0", "12.5", "muitos", None], lenient_bigint) == [12, 12, None, None, None]
    assert one_column(spark, ["1.005", "1e2", "x"], money) == [Decimal("1.01"), Decimal("100.00"), None]
    texts = ["2024-02-29", "2023-02-29", "2024-02-29 10:00:00", "2024-02-29T10:00", "2024", "29/02/2024", "2024-02-29 x", None]
    expected = [date(2024, 2, 29), None, date(2024, 2, 29), date(2024, 2, 29), None, None, None, None]
    assert one_column(spark, texts, lenient_date) == expected


@mark.parametrize("most_hot", [1_000, 1, 0])
def test_repeated_keys_with_and_without_hot_keys(spark, most_hot):
    random.seed(1)
    keys = ["hot"] * 300 + [f"k{random.randint(0, 200)}" for _ in range(300)] + [None, None, "", ""]
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    flagged = flag_repeated(rows, ["k"], "again", exempt=F.col("k") == "", salt_on=["i"], most_hot=most_hot).collect()
    counts = Counter(keys)
    assert len(flagged) == len(keys)
    assert all(r.again == (r.k != "" and counts[r.k] > 1) for r in flagged)


def test_drop_ambiguous_and_latest(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in drop_ambiguous(rows, "k", ["v"]).collect()] == [("b", 3)]
    assert sorted(tuple(r) for r in latest_per_key(rows, ["k"], "v").collect()) == [("a", 2), ("b", 3)]


def test_contained_intervals(spark):
    random.seed(2)
    rows = []
    for i in range(500):
        start = random.randint(0, 60)
        key = "hot" if i % 3 else f"k{i % 7}"
        rows.append((i, key, random.choice("RAX"), DAY + timedelta(start), DAY + timedelta(start + random.randint(-2, 20))))
    df = spark.createDataFrame(rows, "i int, k string, t string, s date, e date")
    usable = F.col("s") <= F.col("e")
    out = flag_contained(
        df, "k", "s", "e", inner=usable & (F.col("t") == "A"), outer=usable & (F.col("t") == "R"), flag="inside"
    )
    expected = {
        i: t == "A" and s <= e and any(k2 == k and t2 == "R" and s2 <= e2 and s2 <= s and e2 >= e for _, k2, t2, s2, e2 in rows)
        for i, k, t, s, e in rows
    }
    got = {r.i: r.inside for r in out.collect()}
    assert got == expected and len(set(expected.values())) == 2


def test_as_of_prefers_the_year_of_the_event(spark):
    random.seed(3)
    facts = [(f"f{i}", random.choice("abc"), date(random.randint(2019, 2024), random.randint(1, 12), 1)) for i in range(25)]
    events = [(i, random.choice("abcd"), date(random.randint(2018, 2025), random.randint(1, 12), 15)) for i in range(200)]
    out = as_of_in_year(
        spark.createDataFrame(events, "i int, k string, d date"),
        spark.createDataFrame(facts, "id string, fk string, fd date"),
        key="k", event_date="d", fact_key="fk", fact_date="fd", tie="id", columns={"id": "found"},
    )

    def brute(k, d):
        own = [(fd, i) for i, fk, fd in facts if fk == k]
        pick = [x for x in own if x[0].year == d.year] or [x for x in own if x[0] <= d]
        return max(pick)[1] if pick else None

    assert {r.i: r.found for r in out.collect()} == {i: brute(k, d) for i, k, d in events}


@mark.parametrize("most_hot", [1_000, 1, 0])
def test_allocation_adds_up_to_the_cent(spark, most_hot):
    rows = [("c1", n, Decimal("100.00"), Decimal(w), True) for n, w in ((0, "33.33"), (1, "33.33"), (2, "40.01"))]
    rows += [("c2", 0, Decimal("10.00"), Decimal("5.00"), True), ("c2", 1, Decimal("10.00"), Decimal("9.00"), False)]
    rows += [("c3", 0, Decimal("1.00"), Decimal("2.00"), False), ("c4", 0, Decimal("0.00"), Decimal("2.00"), True)]
    df = spark.createDataFrame(rows, "k string, n int, amount decimal(18,2), w decimal(18,2), ok boolean")
    out = allocate(df, "k", "amount", "w", ["n"], eligible=F.col("ok"), out="part", most_hot=most_hot).collect()
    got = {(r.k, r.n): (r.part, r.part_exceeds) for r in out}
    assert sum(got["c1", n][0] for n in range(3)) == Decimal("100.00")
    assert got["c1", 0] == (Decimal("31.25"), False)
    assert got["c2", 0] == (Decimal("0.00"), True) and got["c3", 0][0] == 0 and got["c4", 0] == (Decimal("0.00"), False)


def test_positions_and_ranks_are_global(spark):
    random.seed(4)
    values = [random.randint(0, 50) for _ in range(500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(7)
    ranks = {r.i: r.rank for r in dense_rank_desc(df, "v", "rank").collect()}
    order = {v: n + 1 for n, v in enumerate(sorted(set(values), reverse=True))}
    assert ranks == {i: order[v] for i, v in enumerate(values)}
    placed = dense_positions(df, F.col("v").asc(), F.col("i").asc()).collect()
    assert [r.i for r in sorted(placed, key=lambda r: r.position)] == [i for _, i in sorted((v, i) for i, v in enumerate(values))]
    assert sorted(r.position for r in placed) == list(range(1, 501))


def test_lookup_guard_and_membership(spark):
    dim = spark.createDataFrame([("a",), ("a",)], "k string")
    with raises(AmbiguousKeyError, match="a"):
        assert_unique(dim, "k", "dim")
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = {r.k: r.known for r in flag_member(rows, "k", dim, "k", "known").collect()}
    assert got == {"a": True, "b": False, None: False}


def test_schedules_and_sets(spark):
    rows = spark.createDataFrame(
        [("a", date(2024, 1, 31), date(2024, 4, 30)), ("b", date(2024, 5, 1), date(2024, 4, 1))], "k string, s date, e date"
    )
    got = sorted((r.k, r.due) for r in monthly_schedule(rows, "s", "e", "due").collect())
    assert got == [
        ("a", date(2024, 1, 31)), ("a", date(2024, 2, 29)), ("a", date(2024, 3, 29)), ("a", date(2024, 4, 29)),
        ("b", date(2024, 5, 1)),
    ]
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    right = spark.createDataFrame([("b",), ("c",)], "key string")
    assert tuple(key_set_comparison(left, right).first()) == (2, 2, 1)
    assert append(left, right.withColumn("x", F.lit(1))).columns == ["key", "x"]


def test_long_numbers_are_not_cut(spark):
    import duckdb

    from ledgerspan.catalog.adapters import CONTRACT_ID, PAYMENT_ID

    expressions = [PAYMENT_ID, CONTRACT_ID]
    lines = [(10_000_001, 2, 10_000_001), (10_000_000, 1, 123_456_789), (7, 3, 7)]
    frame = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, o_orderkey long")
    got = [tuple(r) for r in frame.selectExpr(*expressions).collect()]
    values = ", ".join(f"({a}, {b}, {c})" for a, b, c in lines)
    sql = f"SELECT {', '.join(expressions)} FROM (VALUES {values}) t(l_orderkey, l_linenumber, o_orderkey)"
    assert got == duckdb.sql(sql.replace("STRING", "VARCHAR")).fetchall()
    assert got == [("PAG100000012", "CS10000001"), ("PAG100000001", "CS123456789"), ("PAG00000073", "CS00000007")]


def test_monthly_steps_follow_the_date_before(spark):
    from ledgerspan.operators.reshape import monthly_schedule

    rows = [("a", date(2023, 1, 31), date(2023, 5, 1)), ("b", date(2024, 5, 15), date(2024, 4, 1)), ("c", date(2023, 12, 30), date(2024, 3, 29))]
    got = monthly_schedule(spark.createDataFrame(rows, "k string, a date, b date"), "a", "b", "due").orderBy("k", "due").collect()
    assert [(r.k, r.due.isoformat()) for r in got] == [
        ("a", "2023-01-31"), ("a", "2023-02-28"), ("a", "2023-03-28"), ("a", "2023-04-28"), ("b", "2024-05-15"),
        ("c", "2023-12-30"), ("c", "2024-01-30"), ("c", "2024-02-29"), ("c", "2024-03-29"),
    ]
