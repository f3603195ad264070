import pytest
from pyspark.sql import functions as F

from helpers import rows
from starmill.operators.joins import count_orphans, hot_keys, lookup_join, salted_join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, some have none, some are unknown."""
    n = F.col("id")
    key = (F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).when(n % 70 == 2, "unknown")
           .otherwise(F.concat(F.lit("k"), n % 900)))
    return spark.range(6000).select(n.alias("row"), key.alias("key"))


@pytest.fixture(scope="module")
def lookup(spark):
    cold = spark.range(900).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
    return cold.union(spark.createDataFrame([("hot", -1), ("unused", -2)], "key string, value long"))


def test_hot_keys_are_found(skewed):
    assert hot_keys(skewed, ["key"], share=0.1) == {"key": ["hot"]}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast_rows", [0, 10_000])
def test_lookup_join_gives_the_plain_join(skewed, lookup, how, broadcast_rows):
    joined = lookup_join(skewed, lookup, "key", how, spread="row", broadcast_rows=broadcast_rows)
    assert rows(joined, "row", "key", "value") == rows(skewed.join(lookup, "key", how), "row", "key", "value")


def test_only_a_counted_small_side_is_broadcast(spark, skewed, lookup):
    plan = lookup_join(skewed, lookup, "key", spread="row")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan
    plan = lookup_join(skewed, lookup, "key", spread="row", right_rows=10**9)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan and "_salt" in plan


def test_hot_and_missing_keys_are_spread(skewed, lookup):
    salted = salted_join(skewed.withColumnRenamed("key", "k"), lookup.withColumnRenamed("key", "k"), "k", "left",
                         ["hot"], "row", salts=16)
    assert salted.count() == 6000
    salt = F.pmod(F.xxhash64("row"), F.lit(16))
    assert skewed.where("key = 'hot'").select(salt).distinct().count() == 16


def test_orphans_count_missing_and_unknown_keys(skewed, lookup):
    expected = skewed.join(lookup, "key", "left_anti").count()
    assert count_orphans(skewed, lookup, "key").first()[0] == expected > 0
    assert count_orphans(skewed.limit(0), lookup, "key").first()[0] == 0


def test_a_wide_lookup_is_not_broadcast(spark):
    """Rows alone do not tell: a lookup of few but wide rows takes the shuffle join."""
    left = spark.range(100).select(F.col("id").alias("sale_key"), (F.col("id") % 10).alias("k"))
    wide = spark.range(10).select(F.col("id").alias("k"), *[F.lit("x").alias(f"c{i}") for i in range(8)])
    plan = lambda rows: lookup_join(left, wide, "k", spread="sale_key", right_rows=rows, hot=[])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan(1000).lower() and "broadcast" not in plan(400_000).lower()


def test_a_lookup_of_unknown_size_is_counted(spark, monkeypatch):
    counted = []
    wide = spark.range(10).select(F.col("id").alias("k"))
    monkeypatch.setattr(type(wide), "count", lambda self: counted.append(1) or 10)
    lookup_join(spark.range(5).select(F.col("id").alias("k"), F.col("id").alias("sale_key")), wide, "k", spread="sale_key")
    assert counted == [1]
