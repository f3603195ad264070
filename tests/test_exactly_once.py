"""Loads that die at any point and are repeated: every sale counts once, and a table is there, old or new."""

import random
import shutil
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, customer, fact_frame, location, product, raw_table, rows, sale, write_raw
from starmill.operators import folders, ledger, sinks
from starmill.plans import aggregates as agg
from starmill.plans import pipeline, summaries
from starmill.plans.warehouse import DIM_TABLES, Star, open_star, read_sales_lines
from starmill.schemas import CURATED, text_schema
from starmill.sources import raw
from starmill.streaming import sales_stream

OPTIONS = {"as_of": AS_OF, "calendar_start": date(2024, 1, 1), "calendar_end": date(2024, 12, 31), "append": True}
CUSTOMERS, PRODUCTS, LOCATIONS = [customer(i) for i in range(4)], [product(1), product(2, category="toys")], [location(1), location(2, region="west")]


class Died(Exception):
    pass


def die(*_args, **_kwargs):
    raise Died


def sales(n, first=0):
    rnd = random.Random(first)
    return [sale(i, customer_id=f"CUST{rnd.randint(0, 3)}", product_id=f"PROD{rnd.randint(1, 2)}", location_id=f"LOC{rnd.randint(1, 2)}",
                 sale_date=f"2024-{rnd.randint(1, 4):02d}-{rnd.randint(1, 28):02d}", quantity=str(rnd.randint(1, 9))) for i in range(first, first + n)]


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("dims")
    source, target = str(root / "raw"), str(root / "warehouse")
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, sales(1))
    return target, pipeline.run_pipeline(spark, source, target, **{**OPTIONS, "append": False}).rows


@pytest.fixture()
def load(spark, dims, tmp_path):
    """Loads a batch: the fact, then the summaries, as a run does; the dimensions are there."""
    target = str(tmp_path / "warehouse")
    for name in DIM_TABLES.values():
        shutil.copytree(f"{dims[0]}/{name}", f"{target}/{name}")

    def run(batch, append=True):
        raw_table(spark, "sales", batch).coalesce(1).write.mode("overwrite").parquet(f"{target}/arrived")
        done = pipeline.load_fact(spark, spark.read.parquet(f"{target}/arrived"), target, F.current_timestamp(), dims[1], append)
        pipeline.sync_summaries(open_star(spark, target, dims[1]), target, done)
        return done

    run.target = target
    return run


def check_summaries(spark, target, lines):
    star = open_star(spark, target)
    assert star.fact.count() == lines == star.fact.select("sale_key").distinct().count() == star.fact.select("sale_id").distinct().count()
    for name, fresh in (("mv_monthly_sales", agg.monthly_sales(star)), ("mv_customer_summary", agg.customer_summary(star))):
        stored = sinks.read_table(spark, f"{target}/{name}")
        assert rows(stored.select(*sorted(stored.columns))) == rows(fresh.select(*sorted(stored.columns))), name


# Where a run dies: the module and the name of the step.
STEPS = {"before the summaries": (pipeline, "sync_summaries"),
         "before the state": (summaries, "_write_load"),
         "between state and summary": (summaries, "_derive_months"), "in the customer summary": (summaries, "merge_customer_summary"),
         "while months are replaced": (summaries, "replace_partitions"), "while lines move in": (folders, "move_all"),
         "before lines are complete": (ledger.Ledger, "_write")}


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_died_is_made_up_for(spark, load, monkeypatch, step):
    load(sales(30))
    batch = [*sales(20, 100), *sales(5)]
    with monkeypatch.context() as patch, pytest.raises(Died):
        patch.setattr(*STEPS[step], die)
        load(batch)
    assert load(batch)["fact"] == (20 if step == "before lines are complete" else 0)
    check_summaries(spark, load.target, 50)


def test_a_stream_that_died_is_made_up_for(spark, load, tmp_path, monkeypatch):
    target, arriving, checkpoint = load.target, str(tmp_path / "arriving"), str(tmp_path / "checkpoint")
    load(sales(10), append=False)

    def ingest(batch):
        raw_table(spark, "sales", batch).coalesce(1).write.mode("append").option("header", True).csv(arriving)
        stream = sales_stream.read_stream(spark, arriving, text_schema("sales"), fmt="csv")
        sales_stream.load_sales_stream(stream, target, checkpoint).awaitTermination()

    with monkeypatch.context() as patch, pytest.raises(Exception, match="Died"):
        patch.setattr(sales_stream, "sync_summaries", die)
        ingest(sales(7, 200))
    ingest(sales(4, 300))
    check_summaries(spark, target, 21)


def test_a_replaced_fact_is_a_new_generation(spark, tmp_path):
    """Sale keys begin again: neither ledger nor summaries go on from the old ones; a rebuild takes today's attributes."""
    source, target = str(tmp_path / "raw"), str(tmp_path / "warehouse")
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, sales(30))
    pipeline.run_pipeline(spark, source, target, **OPTIONS)
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, sales(12, 400))
    pipeline.run_pipeline(spark, source, target, **{**OPTIONS, "append": False})
    check_summaries(spark, target, 12)
    write_raw(spark, source, CUSTOMERS, [product(1, category="other"), product(2)], LOCATIONS, sales(15, 400))
    assert pipeline.run_pipeline(spark, source, target, **OPTIONS).rows["fact"] == 3
    star = open_star(spark, target)
    summaries.sync_summaries(star, target, rebuild=True)
    check_summaries(spark, target, 15)


def test_sets_of_customers_add_up(spark, monkeypatch):
    """Few customers as positions, many as bitmaps, over several buckets: added up in any cut they are those of one pass."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        product_key = rnd.choice([1, 1, 1, 2, 3])
        who = rnd.randint(1, 700) if product_key == 1 else rnd.choice([5, 40_000, 100_000, rnd.randint(1, 30)])
        data.append((i, who, product_key, 1, date(2024, rnd.randint(1, 2), rnd.randint(1, 9)), Decimal(rnd.randint(1, 99))))
    fact = fact_frame(spark, data)
    products = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "x")], "product_key long, category string, subcategory string")
    places = spark.createDataFrame([(1, "w", "s")], "location_key long, region string, state string")
    days = fact.select("date_key").distinct().select("date_key", F.lit(2024).cast("short").alias("year"),
                                                     F.floor(F.col("date_key") / 100 % 100).cast("short").alias("month"), F.lit("m").alias("month_name"))
    star = Star(fact=fact, customer=products, product=products, location=places, date=days, rows={"product": 3, "location": 1, "date": 18})
    monkeypatch.setattr(summaries, "POSITIONS", 100)
    parts = [summaries.monthly_state(star, fact.where(F.col("sale_key") % 3 == k)) for k in range(3)]
    parts = [summaries.with_bitmaps(p) for p in parts[:2]] + parts[2:]
    kinds = parts[0].agg(F.count("positions"), F.count("bitmap"), F.max(F.size("positions"))).first()
    assert min(kinds) > 0 and kinds[2] <= 100
    want = agg.monthly_sales(star)
    several = summaries.add_up(parts[0].unionByName(parts[1])).unionByName(parts[2])
    for states in (parts[0].unionByName(parts[1]).unionByName(parts[2]), several):
        view = summaries.monthly_view(states)
        assert rows(view.select(*want.columns)) == rows(want)


def test_many_loads_are_folded(spark, load, monkeypatch):
    monkeypatch.setattr(summaries, "MOST_LOADS", 2)
    monkeypatch.setattr(summaries, "POSITIONS", 1)
    for k in range(3):
        load(sales(6, 50 * k))
        assert len(summaries._loads(spark, f"{load.target}/mv_monthly_state")) <= 2
    check_summaries(spark, load.target, 18)


def test_an_append_opens_no_older_sale(spark, load):
    """The ledger's scan has a bucket and an id filter and opens the hit buckets; a summary's batch opens the new months only."""
    target = load.target
    load(sales(200))
    book = ledger.Ledger(spark, f"{target}/sales_lines", "sale_id", ("status",), number="sale_key")
    batch = spark.createDataFrame([("SALE3",), ("SALE150",), ("NEW",), (None,)], "sale_id string")
    found = book.known(batch)
    assert rows(found) == [("SALE150", "accepted"), ("SALE3", "accepted")]
    hit = {r[0] for r in batch.where("sale_id IS NOT NULL").select(ledger.bucket_of(F.col("sale_id"))).collect()}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(sale_id" in plan.replace(" ", "")
    every, scan = len(folders.children(spark, f"{target}/sales_lines__keys")), found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() <= len(hit) < every / 4
    assert book.top == read_sales_lines(spark, target).agg(F.max("sale_key")).first()[0]
    many = spark.range(2000).select(F.concat(F.lit("SALE"), "id").alias("sale_id"))
    assert book.known(many).count() == 200


def test_a_failing_write_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    broken = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table(broken, path)
    assert sinks.read_table(spark, path).count() == 5
    done = []

    def stops(spark, source, goal, whole=folders.rename):
        done.append(goal)
        if len(done) == stop:
            raise Died
        whole(spark, source, goal)

    for stop, expected in ((1, 5), (2, 7)):  # before the old table is put aside, and before the new one comes in
        done.clear()
        with monkeypatch.context() as patch, pytest.raises(Died):
            patch.setattr(folders, "rename", stops)
            sinks.write_table(spark.range(7), path)
        assert sinks.read_table(spark, path).count() == expected
    folders.rename(spark, path, f"{path}{folders.OLD}")  # nothing new is ready: the old one comes back
    assert sinks.read_table(spark, path).count() == 7 and sinks.write_table(spark.range(9), path)["rows"] == 9
    assert folders.children(spark, str(tmp_path)) == ["t"] and sinks.read_table(spark, path).count() == 9


def test_a_repeated_bulk_load_replaces_its_own_files(spark, tmp_path):
    target, quarantine = str(tmp_path / "fact"), str(tmp_path / "bad")
    rnd = random.Random(1)
    frames = {n: fact_frame(spark, [(100 * n + i, 1, 1, 1, date(2024, 1, 1), Decimal(rnd.randint(1, 9))) for i in range(10 + n)]) for n in (1, 2)}
    for n, df in frames.items():
        sinks.export_csv(df.select(*CURATED["sales_fact"].names), f"{tmp_path}/csv/{n}")
    for n in (1, 2, 2, 1):
        raw.bulk_load(spark, f"{tmp_path}/csv/{n}", "sales_fact", CURATED["sales_fact"], target, quarantine, F.current_timestamp(), append=True)
    assert spark.read.parquet(target).count() == 23
    raw.bulk_load(spark, f"{tmp_path}/csv/1", "sales_fact", CURATED["sales_fact"], target, quarantine, F.current_timestamp())
    assert spark.read.parquet(target).count() == 11
