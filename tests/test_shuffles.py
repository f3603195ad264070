"""What moves over a shuffle: no more than the results need."""

import re
from datetime import date

from pyspark.sql import functions as F

from helpers import fact_frame, raw_table, rows, sale
from starmill.operators import dimensions as dims
from starmill.operators.fact import resolve_sales
from starmill.operators.joins import salted_join
from starmill.operators.ledger import Ledger
from starmill.plans import aggregates as agg
from starmill.plans import lattice, summaries
from starmill.plans.changes import as_of
from starmill.plans.warehouse import Star


def plan_of(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def small_star(spark, sizes=None):
    data = [(i, 1 + i % 50, 1 + i % 4, 1 + i % 3, date(2024, 1 + i % 3, 1 + i % 20), 5 + i) for i in range(600)]
    days = dims.build_date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31))
    people = spark.createDataFrame([(n, f"C{n}", f"N{n}", "Town", "S") for n in range(1, 51)],
                                   "customer_key long, customer_id string, full_name string, city string, state string")
    goods = spark.createDataFrame([(n, f"P{n}", f"n{n}", "ab"[n % 2], None if n == 4 else "s", "B") for n in range(1, 5)],
                                  "product_key long, product_id string, product_name string, category string, subcategory string, brand string")
    places = spark.createDataFrame([(n, f"L{n}", f"s{n}", "W" if n < 3 else None, "X") for n in range(1, 4)],
                                   "location_key long, location_id string, store_name string, region string, state string")
    return Star(fact=fact_frame(spark, data), customer=people, product=goods, location=places, date=days,
                rows=sizes or {"customer": 50, "product": 4, "location": 3, "date": 366})


def test_a_summary_is_folded_from_its_state_without_moving_sets(spark, monkeypatch):
    monkeypatch.setattr(summaries, "POSITIONS", 10)
    star = small_star(spark)
    fact = star.fact.where("customer_key < 9 OR month_key > 202401")
    state = summaries.with_bitmaps(summaries.monthly_state(star, fact)).localCheckpoint()
    assert state.where("bitmap IS NOT NULL").count() and state.where("bitmap IS NULL").count()
    view, want = summaries.monthly_view(state, once=True), agg.monthly_sales(star, fact)
    assert rows(view.select(*want.columns)) == rows(want)
    assert "positions" not in " ".join(re.findall(r"Exchange [^\n]*|collect_list[^\n]*|Generate [^\n]*", plan_of(view, "executedPlan")))
    assert plan_of(view).count("Aggregate") == 1 and "Repartition" not in plan_of(view)


def test_the_first_load_reads_the_fact_once_for_the_monthly_summary(spark, tmp_path, monkeypatch):
    star, read = small_star(spark), []
    build = summaries.monthly_state
    monkeypatch.setattr(summaries, "monthly_state", lambda *a: read.append(1) or build(*a))
    monkeypatch.setattr(agg, "monthly_sales", None)
    summaries.sync_summaries(star, str(tmp_path), {"top": 599, "first_key": 0, "months": [202401, 202402, 202403]})
    stored = spark.read.parquet(f"{tmp_path}/mv_monthly_sales")
    monkeypatch.undo()
    want = agg.monthly_sales(star)
    assert read == [1] and not hasattr(summaries, "monthly_sales")
    assert rows(stored.select(*want.columns)) == rows(want)


def test_dates_travel_as_text_only_where_written_otherwise(spark):
    written = ["2024-01-05", " 2024-01-05", "2024-1-5", "2024-01-05 00:00:00", "no date", None, "2024-02-30", "0001-01-01"]
    people = spark.createDataFrame([("CUST1", 1)], "customer_id string, customer_key long")
    goods = spark.createDataFrame([("PROD1", 1)], "product_id string, product_key long")
    places = spark.createDataFrame([("LOC1", 1)], "location_id string, location_key long")
    days = dims.build_date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31))
    sales = raw_table(spark, "sales", [sale(i, sale_date=d) for i, d in enumerate(written)])
    found = resolve_sales(sales, {"customer": people, "product": goods, "location": places}, days, F.lit(None).cast("timestamp"))
    got = {r["sale_id"]: (r["sale_date"], r["date_key"]) for r in found.collect()}
    assert [got[f"SALE{i}"][0] for i in range(len(written))] == written
    assert got["SALE0"][1] == 20240105 and got["SALE4"][1] is None and got["SALE7"][1] is None


def test_a_salt_may_come_from_all_columns(spark):
    left = spark.range(300).select((F.col("id") % 2).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    found = salted_join(left, right, "k", "inner", [0], F.struct("k", "id"))
    assert found.columns == ["k", "id", "v"] and found.count() == 300 and found.where("v = 'a'").count() == 150


def test_large_dimensions_are_joined_before_the_text_of_the_others(spark):
    star = small_star(spark, {"customer": 10**9, "product": 10**9, "location": 3, "date": 366})
    found = agg.sales_enriched(star)
    assert found.columns[:5] == ["customer_key", "location_key", "product_key", "date_key", "sale_key"]
    assert found.columns[-8:] == ["brand", "location_id", "store_name", "region", "state", "customer_id", "full_name", "customer_state"]
    joins = re.findall(r"Join Inner, \((\w+_key)#", plan_of(found).replace("((", "("))
    assert joins == ["date_key", "location_key", "product_key", "customer_key"]  # the last is the first to run
    assert found.count() == 600


def test_sets_of_positions_fold_in_one_pass(spark):
    star = small_star(spark)
    fine = lattice.Shape("fine", ("month_key", "category", "subcategory", "region"), sets=True)
    state = lattice._state(star, lattice.fact_source(star), fine).localCheckpoint()
    coarse = lattice.fold_state(state, ["month_key", "region"], True)
    assert plan_of(coarse).count("Aggregate") == 1 and "Union" not in plan_of(coarse)
    got = {(r["month_key"], r["region"]): (r["transactions"], r["net"], sorted(r["positions"])) for r in coarse.collect()}
    line = star.fact.join(star.location, "location_key").groupBy("month_key", "region").agg(
        F.count("*").alias("n"), F.sum("net_amount").alias("net"), F.sort_array(F.collect_set(F.col("customer_key").cast("int") - 1)).alias("who"))
    assert got == {(r["month_key"], r["region"]): (r["n"], r["net"], r["who"]) for r in line.collect()}
    halves = lattice.large_as_bitmaps(state.where("month_key = 202401"), ["month_key", "category", "subcategory", "region"])
    both = lattice.fold_state(halves.withColumn("bitmap", F.lit(None).cast("binary")).unionByName(state.where("month_key > 202401")), ["region"], True)
    assert sum(r["transactions"] for r in both.collect()) == 600


def test_unknown_lines_meet_the_ledger_by_the_key_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "id string, status string, n long"
    stored = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "y", 3), (None, "x", 4)], kind)
    stored.write.parquet(path)
    book = Ledger(spark, path, "id", ("status",), number="n")
    book.ensure(spark.read.parquet(path))
    lines = spark.createDataFrame([("a", "x", 5), ("a", "y", 6), ("b", "y", 7), ("c", "x", 8), (None, "x", 9), ("a", None, 10)], kind)
    found = book.unknown(lines)
    assert rows(found, "n") == [(10,), (6,), (8,), (9,)]
    assert "LeftSemi" not in plan_of(found)
    joins = re.findall(r"(?:SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[([^\]]*)\]", plan_of(found, "executedPlan"))
    assert joins and all("status" not in keys for keys in joins)


def test_the_bins_may_come_from_a_cheaper_table(spark):
    history = spark.createDataFrame([("A", "x", date(2024, 1, 1), date(2024, 6, 1)), ("A", "y", date(2024, 6, 1), None)],
                                    "id string, city string, valid_from date, valid_to date")
    data = [("A", date(2024, 5, 31)), ("A", date(2024, 6, 1)), ("A", date(2023, 1, 1)), ("B", date(2024, 6, 1)), ("A", None)]
    days = spark.createDataFrame([(d,) for _, d in data] + [(date(2030, 1, 1),)], "sold date")
    facts = spark.createDataFrame(data, "id string, sold date")
    spent = spark.sparkContext.accumulator(0)
    counted = facts.rdd.map(lambda r: (spent.add(1), r)[1]).toDF(facts.schema)
    found = as_of(counted, "sold", history, "id", days=days)
    assert spent.value == 0  # the facts, which may be a join, are not computed for their days
    assert rows(found, "id", "sold", "city") == rows(as_of(facts, "sold", history, "id"), "id", "sold", "city")
    assert {(r["sold"], r["city"]) for r in found.collect() if r["id"] == "A" and r["sold"]} == {
        (date(2024, 5, 31), "x"), (date(2024, 6, 1), "y"), (date(2023, 1, 1), None)}
