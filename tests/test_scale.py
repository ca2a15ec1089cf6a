"""What keeps the cost of the batch in step with its tables."""

from ledgerspan.catalog import adapters as A
from ledgerspan.session import tune

SF = "/root/testdata/sf0.001"


def test_raw_rows_are_read_from_the_table_and_long_expressions_worked_out_once(spark):
    rows = A.raw(tune(spark), SF, "payments")
    assert rows.inputFiles()[0].endswith("/lineitem.parquet")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # each of the two CNPJ takes two paddings, the other two columns one each; five times as many before
    assert plan.count("lpad(") <= 8
    plain = A._project(A.table(spark, SF, "lineitem"), {"columns": {"CNPJ": A.RAW["payments"]["columns"]["CNPJ"]}})
    assert sorted(r[0] for r in rows.select("CNPJ").collect()) == sorted(r[0] for r in plain.collect())


def test_joins_of_small_partitions_need_no_sort(spark):
    tune(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = A.table(spark, SF, "lineitem"), A.table(spark, SF, "orders")
        joined = left.join(right, left["l_orderkey"] == right["o_orderkey"])
        assert joined.count() == left.count()
        joined.collect()
        assert "ShuffledHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_slugs_and_ids_equal_their_plain_forms(spark):
    import random

    from pyspark.sql import functions as F

    from ledgerspan.functions.numbers import amendment_id
    from ledgerspan.functions.text import ACCENTED, UNACCENTED, enum_slug

    rng = random.Random(3)
    letters = list("aAzZ09 __-./çÇãÃÉéıİßΣσς\t\n\u00a0ñü\u0301\U0001f642")
    texts = [None, "", " ", "_", *letters, *["".join(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(3_000)]]
    numbers = [None, 0.0, 1.0, 9999.0, 10000.0, -5.0, -12345.0, 1.5, 1e12, float("nan"), -0.0]
    rows = spark.createDataFrame([(t, numbers[i % len(numbers)]) for i, t in enumerate(texts)], "t string, n double")
    folded = F.translate(F.lower("t"), ACCENTED, UNACCENTED)
    slug = F.coalesce(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))
    usable = (F.col("t") != "") & F.col("n").isNotNull() & (F.col("n") % 1 == 0)
    name = F.coalesce(F.when(usable, F.format_string("AMD-%s-%04d", "t", F.col("n").cast("bigint"))), F.lit(""))
    assert rows.where(~slug.eqNullSafe(enum_slug("t")) | ~name.eqNullSafe(amendment_id("t", "n"))).count() == 0
    # a text that is a slug but for blanks meets no replacement by regular expression
    plan = rows.select(enum_slug("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan
