"""Attributes as numbers: lookups without a shuffle, groups of lines by one."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import rows
from starmill.operators import joins
from starmill.operators.joins import block_join, key_blocks, numbered_values, with_number, with_values
from starmill.plans import aggregates as agg
from starmill.plans import lattice, summaries, warehouse
from test_shuffles import plan_of, small_star


def goods(spark):
    a = F.when(F.col("id") % 3 != 0, F.concat(F.lit("c"), F.col("id") % 3))
    return spark.range(1, 5001).select(F.col("id").alias("k"), a.alias("a"), (F.col("id") % 5).cast("string").alias("b")).where("k % 7 != 0")


def test_blocks_look_up_like_an_inner_join(spark):
    blocks, values = key_blocks(goods(spark), "k", ["a", "b"])
    lines = spark.range(-3000, 9000).select(F.col("id").alias("k"), F.lit(1).alias("x")).union(
        spark.createDataFrame([(None, 1), (1 << 60, 1), (1, 2)], "k long, x int"))
    found = with_values(block_join(lines, blocks, "k", "n"), values, "n").select("k", "x", "a", "b")
    want = lines.join(goods(spark), "k")
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    assert values.where("a IS NULL").count() == 5


def test_blocks_are_refused_where_a_join_would_differ(spark):
    assert key_blocks(goods(spark).where("k < 0"), "k", ["a"]) is None
    assert key_blocks(goods(spark).union(goods(spark).where("k = 1")), "k", ["a"]) is None  # a repeated key
    assert key_blocks(goods(spark).withColumn("k", F.col("k") * 1000), "k", ["a"]) is None  # sparse
    assert key_blocks(goods(spark).withColumn("k", F.col("k") - 10), "k", ["a"]) is None  # negative
    assert key_blocks(goods(spark).withColumn("a", F.col("k").cast("string") * 3), "k", ["a", "b"]) is not None
    assert numbered_values(spark.range(11), ["id"], 10) is None


def test_numbers_stand_for_values_nulls_included(spark):
    data = spark.createDataFrame([("x", None, 1), (None, None, 2), ("x", "y", 3), ("x", None, 4)], "a string, b string, n int")
    values = numbered_values(data, ["a", "b"])
    numbered = with_number(data, values, "no")
    assert values.count() == 3 and numbered.columns == ["n", "no"]
    assert rows(with_values(numbered, values, "no").select("a", "b", "n")) == rows(data)


@pytest.fixture(params=["small", "blocks", "many values"])
def star(request, spark, monkeypatch):
    if request.param == "blocks":
        monkeypatch.setattr(warehouse, "BROADCAST_ROWS", 2)
    if request.param == "many values":
        for module in (warehouse, lattice):
            monkeypatch.setattr(module, "numbered_values", lambda *_: None)
        monkeypatch.setattr(joins, "numbered_values", lambda *_: None)
    return small_star(spark)


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^\n]*)", plan_of(df, "executedPlan"))


def test_the_monthly_summary_is_that_of_the_lines(spark, star):
    fact = star.fact.where("customer_key < 40 OR month_key > 202401")
    joined = fact.join(star.product, "product_key").join(star.location, "location_key").join(star.date, "date_key")
    want = joined.groupBy(*agg.MONTHLY_KEYS).agg(
        F.count_distinct("customer_key"), F.count("sale_key"), F.sum("quantity"), F.sum("gross_amount"), F.sum("discount_amount"),
        F.sum("net_amount"), F.sum("net_amount").cast("double") / F.count("net_amount"))
    found = agg.monthly_sales(star, fact)
    assert rows(found) == rows(want) and [t for _, t in found.dtypes] == [t for _, t in want.dtypes]
    assert rows(summaries.monthly_view(summaries.monthly_state(star, fact)).select(*found.columns)) == rows(found)


def test_lines_move_once_and_without_text(spark, star):
    state = lattice._state(star, lattice.fact_source(star), lattice.Shape("day", ("date_key", "brand", "category", "region"), sets=True))
    want = star.fact.join(star.product, "product_key").join(star.location, "location_key").groupBy(
        "date_key", "brand", "category", "region").agg(F.count(F.lit(1)), F.sum("net_amount"), F.sort_array(F.collect_set("customer_key")))
    found = state.select("date_key", "brand", "category", "region", "transactions", "net",
                         F.sort_array(F.transform("positions", lambda p: (p + 1).cast("long"))))
    assert rows(found) == rows(want)
    moved = [e for e in exchanges(state) if "_slot" in e]
    assert len(moved) == 1 and len([e for e in exchanges(state) if "_block" not in e]) == 1
    if star._coded and all(star._coded.values()):
        assert not re.search(r"category|brand|region", moved[0])
    coarse = lattice.fold_state(state.localCheckpoint(), ["month_key", "category", "region"], True)
    assert len(exchanges(coarse)) == 1
    again = star.fact.join(star.product, "product_key").join(star.location, "location_key").groupBy("month_key", "category", "region").agg(
        F.count(F.lit(1)), F.sum("net_amount"), F.count_distinct("customer_key"))
    assert rows(coarse.select("month_key", "category", "region", "transactions", "net", F.size("positions").cast("long"))) == rows(again)


def test_a_shape_is_written_where_its_groups_were_made(spark, tmp_path, star, monkeypatch):
    shapes = [lattice.Shape("day", ("date_key", "category", "region"), sets=True), lattice.Shape("month", ("month_key", "category"), sets=True),
              lattice.Shape("store", ("date_key", "location_key"))]
    plain, plans = lattice.write_table, []
    monkeypatch.setattr(lattice, "write_table", lambda df, *a, **b: plans.append(b.get("gathered", False)) or plain(df, *a, **b))
    load = {"top": 599, "first_key": 0, "months": [202401, 202402, 202403]}
    lattice.sync_lattice(star, str(tmp_path), shapes, load)
    assert all(plans) and len(plans) == 3
    found = lattice.open_lattice(star, str(tmp_path), shapes, load)
    ask = lattice.Request(("unique_customers", "total_sales"), ("category",))
    want = star.fact.join(star.product, "product_key").groupBy("category").agg(F.count_distinct("customer_key"), F.sum("net_amount"))
    assert rows(found.answer(ask)) == rows(want)
