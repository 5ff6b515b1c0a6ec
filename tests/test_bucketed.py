"""Stars over bucketed tables."""

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import joins as jn


@pytest.fixture
def tables(spark):
    base = spark.range(500).select(F.date_add(F.lit("2020-01-03").cast("date"), (7 * F.col("id")).cast("int")).alias("date"), "id")
    one = {f"t{k}": base.filter(F.col("id") % (k + 2) != 0).select("date", (F.col("id") * (k + 1)).alias(f"v{k}")) for k in range(6)}
    return {"base": base, **one, "nothing": base.filter("false").select("date", F.col("id").alias("none")), "gap": base.limit(3).select(F.lit(None).cast("date").alias("date"), F.col("id").alias("lost"))}


SETS = {"few": ["t0", "t1"], "all": ["t0", "t1", "t2", "t3", "t4", "t5", "nothing", "gap"]}


def test_same_rows_and_no_exchange(spark, tables):
    known = spark.catalog.listTables()
    made = jn.bucketed(tables, ["date"], rows_per_task=100)
    assert spark.catalog.listTables() == known
    stars, plain = jn.star_joins(made["base"], made, SETS, ["date"]), jn.star_joins(tables["base"], tables, SETS, ["date"])
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in SETS:
            plan = stars[name]._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and plan.count("SortMergeJoin") == len(SETS[name])
            assert "Exchange" in plain[name]._jdf.queryExecution().executedPlan().toString()
            assert sorted(stars[name].collect(), key=str) == sorted(plain[name].collect(), key=str)
        assert stars["all"].rdd.getNumPartitions() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_small_tables_are_one_bucket(spark, tables):
    made = jn.bucketed(tables, ["date"])
    assert jn.bucketed({"base": tables["base"]}, ["date"], rows_per_task=100, rows_bound=1_000)["base"].select(F.input_file_name()).distinct().count() == 10
    assert made["t0"].rdd.getNumPartitions() == 1 and made["base"].count() == 500 and made["nothing"].count() == 0
