from datetime import date
from decimal import Decimal

import pytest

from helpers import AS_OF, customer, location, product, raw_table, rows, sale, write_raw
from starmill.operators.sinks import register_table
from starmill.plans import aggregates as agg
from starmill.plans.health import job_health, read_run_log
from starmill.plans.checks import catalog_statistics
from starmill.plans.pipeline import require_folders, run_gated, run_pipeline
from starmill.plans.rules import DataQualityError
from starmill.plans.warehouse import open_star, read_rejects
from starmill.schemas import RAW, text_schema
from starmill.streaming import sales_stream

OPTIONS = {"as_of": AS_OF, "calendar_start": date(2024, 1, 1), "calendar_end": date(2024, 12, 31)}
CUSTOMERS = [customer(1), customer(2), customer(2, created_date="2020-01-01"), customer(3)]
PRODUCTS = [product(1), product(2, category="toys")]
LOCATIONS = [location(1), location(2, region="west")]
SALES = [sale(1), sale(2, sale_date="2024-02-10", customer_id="CUST2", product_id="PROD2", location_id="LOC2"),
         sale(3, sale_date="2024-02-11"), sale(4, customer_id="CUST9"), sale(5, sale_date="?")]


@pytest.fixture()
def folders(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "warehouse")
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, SALES)
    return source, target


def keys(star):
    return {d: dict(rows(getattr(star, d), f"{d}_id", f"{d}_key")) for d in ("customer", "product", "location")}


def check_star(spark, result, target):
    assert result.rows == {"customer": 3, "product": 2, "location": 2, "date": 366, "fact": 3, "rejects": 2}
    assert rows(read_rejects(spark, target), "sale_id", "reject_reason", "customer_id") == [
        ("SALE4", "customer_key", "CUST9"), ("SALE5", "date_key", "CUST1")]
    assert rows(agg.monthly_trend(result.star), "month_name", "unique_customers", "total_revenue") == [
        ("February", 2, Decimal("39.00")), ("January", 1, Decimal("19.50"))]
    summary = spark.read.parquet(f"{target}/mv_customer_summary")
    assert rows(summary, "customer_id", "total_purchases", "lifetime_value") == [
        ("CUST1", 2, Decimal("39.00")), ("CUST2", 1, Decimal("19.50")), ("CUST3", 0, None)]


def test_gated_run_from_text_files(spark, folders, tmp_path):
    source, target = folders
    export = str(tmp_path / "export")
    check_star(spark, run_gated(spark, *folders, csv_export=export, publish_to="mart", **OPTIONS), target)
    assert spark.read.option("header", True).csv(f"{export}/sales_fact").count() == 3
    assert spark.table("mart.sales_fact").count() == 3 and spark.table("mart.product_dim").count() == 2
    assert {r.table_name: r.row_count for r in catalog_statistics(spark, "mart").collect()} == {
        "customer_dim": 3, "date_dim": 366, "location_dim": 2, "product_dim": 2, "sales_fact": 3, "sales_lines": 5,
        "mv_monthly_sales": 3, "mv_customer_summary": 3}
    ddl = spark.sql("SHOW CREATE TABLE mart.customer_dim").first()[0]
    assert "'starmill.required' = 'customer_key,customer_id'" in ddl and "DEFAULT true" in ddl and "One row per customer" in ddl
    with pytest.raises(DataQualityError, match="returns"):
        require_folders(spark, source, ["sales", "returns"])


def test_catalog_tables_give_the_same(spark, folders, tmp_path):
    source, target = str(tmp_path / "raw2"), folders[1]
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, SALES, fmt="parquet")
    spark.sql("CREATE DATABASE IF NOT EXISTS landing")
    with pytest.raises(DataQualityError, match="sales"):
        run_gated(spark, source, target, database="landing", **OPTIONS)
    for t in RAW:
        register_table(spark, f"landing.{t}", f"{source}/{t}", text_schema(t))
    check_star(spark, run_pipeline(spark, source, target, database="landing", **OPTIONS), target)


def test_second_run_keeps_keys_and_replaces(spark, folders):
    source, target = folders
    first = keys(run_pipeline(spark, *folders, **OPTIONS).star)
    write_raw(spark, source, [customer(0), *CUSTOMERS], [product(9), *PRODUCTS], LOCATIONS, SALES)
    second = run_pipeline(spark, *folders, **OPTIONS)
    after = keys(second.star)
    assert all(after[d].items() >= first[d].items() for d in first)
    assert after["customer"]["CUST0"] == 4 and after["product"]["PROD9"] == 3
    assert second.rows["fact"] == 3 and open_star(spark, target).fact.count() == 3


def test_appended_batches_are_replay_safe(spark, folders):
    source, target = folders
    run_pipeline(spark, *folders, append=True, **OPTIONS)
    write_raw(spark, source, [*CUSTOMERS, customer(9)], PRODUCTS, LOCATIONS, [*SALES, sale(6, sale_date="2024-03-01")])
    for expected in (2, 0):  # SALE6 is new and SALE4's customer has come; then nothing is
        assert run_pipeline(spark, *folders, append=True, **OPTIONS).rows["fact"] == expected
    star = open_star(spark, target)
    fact = star.fact
    assert rows(spark.read.parquet(f"{target}/mv_customer_summary")) == rows(agg.customer_summary(star))
    monthly = spark.read.parquet(f"{target}/mv_monthly_sales")
    assert rows(monthly.select(*sorted(monthly.columns))) == rows(agg.monthly_sales(star).select(*sorted(monthly.columns)))
    assert [r[0] for r in rows(fact, "sale_id")] == ["SALE1", "SALE2", "SALE3", "SALE4", "SALE6"]
    assert fact.select("sale_key").distinct().count() == 5
    assert read_rejects(spark, target).count() == 2


def test_runs_are_logged_also_when_they_fail(spark, folders, tmp_path):
    source, target = folders
    run_pipeline(spark, *folders, **OPTIONS)
    with pytest.raises(Exception):
        run_pipeline(spark, str(tmp_path / "nothing"), target, **OPTIONS)
    health = job_health(read_run_log(spark, target)).first()
    assert (health.job_name, health.last_run_status, health.success_rate) == ("raw_to_curated", "FAILED", 50.0)
    assert health.avg_duration_minutes > 0


def test_streamed_sales_reach_the_fact_once(spark, folders, tmp_path):
    source, target = folders
    run_pipeline(spark, *folders, **OPTIONS)
    arriving, checkpoint = str(tmp_path / "arriving"), str(tmp_path / "checkpoint")
    for batch in ([SALES[0], sale(7)], [sale(7), sale(8, sale_date="2024-04-01"), sale(9, location_id=None)]):
        raw_table(spark, "sales", batch).coalesce(1).write.mode("append").option("header", True).csv(arriving)
        stream = sales_stream.read_stream(spark, arriving, text_schema("sales"), fmt="csv")
        sales_stream.load_sales_stream(stream, target, checkpoint).awaitTermination()
    fact = open_star(spark, target).fact
    assert [r[0] for r in rows(fact, "sale_id")] == ["SALE1", "SALE2", "SALE3", "SALE7", "SALE8"]
    assert fact.select("sale_key").distinct().count() == 5
    assert read_rejects(spark, target).where("reject_reason = 'location_key'").count() == 1


def test_empty_sales(spark, folders, tmp_path):
    source, target = folders
    write_raw(spark, source, CUSTOMERS, PRODUCTS, LOCATIONS, [])
    result = run_pipeline(spark, *folders, **OPTIONS)
    assert (result.rows["fact"], result.rejected_sales) == (0, 0)
    assert result.star.fact.count() == 0 and read_rejects(spark, target).count() == 0
