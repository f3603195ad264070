from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import customer, fact_frame, location, product, raw_table, rows, sale
from starmill.operators import dimensions as dims
from starmill.plans import checks, rules
from starmill.plans.health import data_freshness, job_health, recent_errors
from starmill.plans.warehouse import Star
from starmill.schemas import CURATED


def broken(spark, table, *data, regions=rules.REGIONS):
    report = rules.rule_report(raw_table(spark, table, list(data)), rules.raw_rules(table, regions), table)
    return {(r.column_name, r.rule): r.violations for r in report.where("NOT passed").collect()}


def test_clean_rows_break_nothing(spark):
    assert broken(spark, "customers", customer(1), customer(2)) == {}
    assert broken(spark, "products", product(1)) == {}
    assert broken(spark, "locations", location(1)) == {}
    assert broken(spark, "sales", sale(1), sale(2)) == {}


def test_customer_rules(spark):
    assert broken(spark, "customers", customer(1, customer_id="C1"), customer(2), customer(2), customer(3, email="a@b"),
                  customer(4, first_name=""), customer(5, last_name="x" * 101), customer(6, state="N"),
                  customer(7, created_date="soon"), customer(8, customer_id=None), customer(9, phone=None, state=None)) == {
        ("customer_id", "pattern"): 1, ("customer_id", "unique"): 1, ("email", "pattern"): 1, ("first_name", "length_1_100"): 1,
        ("last_name", "length_1_100"): 1, ("state", "length_2_50"): 1, ("created_date", "type"): 1, ("customer_id", "not_null"): 1}


def test_product_rules(spark):
    assert broken(spark, "products", product(1, unit_price="-0.01"), product(2, unit_price="100000.00"), product(3, cost="-1.00"),
                  product(4, unit_price=None), product(5, product_name="x" * 256), product(6, unit_price="99999.99", cost=None)) == {
        ("unit_price", "at_least_0"): 1, ("unit_price", "less_than_100000"): 1, ("cost", "at_least_0"): 1,
        ("unit_price", "not_null"): 1, ("product_name", "length_1_255"): 1}


def test_location_regions(spark):
    assert broken(spark, "locations", location(1, region="MARS"), location(2, region=None)) == {("region", "allowed_value"): 1}
    assert broken(spark, "locations", location(1, region="MARS"), regions=("MARS",)) == {}


def test_quantity_bound_of_raw_sales_excludes_10000(spark):
    got = broken(spark, "sales", *[sale(i, quantity=q) for i, q in enumerate(["0", "-1", "1", "9999", "10000", "10001", "x"])])
    assert got == {("quantity", "more_than_0"): 2, ("quantity", "less_than_10000"): 2, ("quantity", "type"): 1}


def star_of(spark, data):
    fact = fact_frame(spark, data)
    def keyed(name, table):
        return spark.range(1, 6).select(
            F.col("id").alias(f"{name}_key"), F.concat(F.lit("X"), "id").alias(f"{name}_id"),
            F.lit(1).cast("decimal(10,2)").alias("unit_price"), F.lit(1).cast("decimal(10,2)").alias("cost"),
            F.lit(1).cast("decimal(5,2)").alias("margin"), F.lit("a@x.org").alias("email"))
    return Star(fact=fact, customer=keyed("customer", "customer_dim"), product=keyed("product", "product_dim"),
                location=keyed("location", "location_dim"), date=dims.build_date_dimension(spark, date(2024, 1, 1), date(2024, 1, 31)))


DAY = date(2024, 1, 5)


def test_quantity_bound_of_the_suite_includes_10000(spark):
    fact = fact_frame(spark, [(i, 1, 1, 1, DAY, 5) for i in range(4)])
    quantities = F.element_at(F.array(*[F.lit(q) for q in (0, 1, 10000, 10001)]), (F.col("sale_key") + 1).cast("int"))
    out = {(r.expectation, r.column_name): r.unexpected for r in rules.run_suite(fact.withColumn("quantity", quantities)).collect()}
    assert out[("between", "quantity")] == 2 and out[("unique", "sale_key")] == 0


def test_suite_on_an_empty_table_and_on_a_missing_column(spark):
    empty = fact_frame(spark, [])
    failed = rules.run_suite(empty).where("NOT success").collect()
    assert [r.expectation for r in failed] == ["row_count_at_least"] and not rules.suite_passed(empty)
    missing = rules.run_suite(fact_frame(spark, [(1, 1, 1, 1, DAY, 5)]).drop("net_amount")).where("NOT success").collect()
    assert {(r.expectation, r.column_name) for r in missing} == {("column_exists", "net_amount"), ("between", "net_amount")}
    assert rules.suite_passed(fact_frame(spark, [(1, 1, 1, 1, DAY, 5)]))


def test_validation_reports_all_failures_at_once(spark):
    df = raw_table(spark, "sales", [sale(1, customer_id="x", quantity="0"), sale(2), sale(3, sale_id=None)])
    with pytest.raises(rules.DataQualityError) as error:
        rules.validate_raw_data(df, "sales")
    assert len(error.value.report) == 3
    assert rows(error.value.cases, "row_id", "column_name", "rule", "value") == [
        ("SALE1", "customer_id", "pattern", "x"), ("SALE1", "quantity", "more_than_0", "0"),
        (None, "sale_id", "not_null", None)]


def raw_tables(spark, sales):
    return {"customers": raw_table(spark, "customers", [customer(1)]), "products": raw_table(spark, "products", [product(1)]),
            "locations": raw_table(spark, "locations", [location(1)]), "sales": raw_table(spark, "sales", sales)}


def test_integrity(spark):
    assert checks.run_all_checks(raw_tables(spark, [sale(1)]))
    bad = raw_tables(spark, [sale(i, customer_id=f"CUST{i}") for i in range(1, 9)] + [sale(9, customer_id=None)])
    report = {r.column_name: r for r in checks.cross_table_integrity(bad).collect()}
    assert report["customer_id"].invalid_ids == 7 and report["customer_id"].sample_ids == "CUST2,CUST3,CUST4,CUST5,CUST6"
    assert report["product_id"].passed
    with pytest.raises(rules.DataQualityError, match="customer_id"):
        checks.check_integrity(bad)
    with pytest.raises(rules.DataQualityError, match="sales"):
        checks.run_all_checks(bad)


GOOD = [(1, 1, 1, 1, DAY, 5), (2, 2, 2, 2, DAY, 7)]
BAD = [*GOOD, (3, 99, 1, 1, DAY, -4), (4, None, 2, 1, DAY, 0), (4, 1, 1, 1, date(2024, 3, 1), 1)]


def test_reports_on_good_and_bad_facts(spark):
    good, bad = star_of(spark, GOOD), star_of(spark, BAD)
    assert dict(rows(checks.orphan_checks(bad.fact, bad))) == {
        "Orphaned Customers": 2, "Orphaned Products": 0, "Orphaned Locations": 0, "Orphaned Dates": 1}
    assert checks.null_key_verdict(good.fact).first().null_check == "PASS"
    assert checks.null_key_verdict(bad.fact).first().null_rows == 1
    assert checks.null_key_profile(bad.fact).first().null_customers == 1
    assert dict(rows(checks.anomaly_counts(bad.fact)))["Zero Sales Amount"] == 1
    verdict = {r.check_name: r.violations for r in checks.quality_verdict(bad.fact, bad, date(2024, 1, 4)).collect()}
    assert verdict == {"Null Foreign Keys": 1, "Negative Values": 1, "Future Dates": 4, "Orphaned Records": 2}
    passed = checks.quality_verdict(good.fact, good, date(2024, 1, 31)).collect()
    assert {r.overall_status for r in passed} == {"PASSED"}
    assert dict(rows(checks.business_rules(bad), "rule", "violations"))["unique sales_fact.sale_key"] == 1
    assert checks.business_rules(good).where("NOT passed").count() == 0
    assert dict(rows(checks.calendar_validity(bad), "check_name", "violations"))["covers_fact"] == 1


def test_counts_are_zero_not_null_on_an_empty_fact(spark):
    empty = star_of(spark, [])
    assert tuple(checks.negative_values(empty.fact).first()) == (0, 0, True)
    assert tuple(checks.future_dates(empty, DAY).first()) == (0, True)
    assert {r.orphan_count for r in checks.orphan_checks(empty.fact, empty).collect()} == {0}
    assert checks.table_counts_wide(empty).first().sales_transactions == 0
    assert checks.quality_verdict(empty.fact, empty, DAY).first().overall_status == "PASSED"


def test_calendar_gap_and_repeat(spark):
    star = star_of(spark, GOOD)
    holes = star.date.where("day <> 7").unionByName(star.date.where("day = 9"))
    broken_star = Star(fact=star.fact, customer=star.customer, product=star.product, location=star.location, date=holes)
    found = dict(rows(checks.calendar_validity(broken_star), "check_name", "violations"))
    assert found == {"unique": 1, "gap_free": 1, "covers_fact": 0}


def test_curated_rules_and_constraints(spark):
    star = star_of(spark, BAD)
    report = {(r.column_name, r.rule): r.violations for r in rules.rule_report(
        star.fact, rules.curated_rules("sales_fact"), "sales_fact").where("NOT passed").collect()}
    assert report == {("customer_key", "not_null"): 1, ("sale_key", "unique"): 1, ("net_amount", "at_least_0"): 1,
                      ("gross_amount", "at_least_0"): 1}
    assert rules.validate_curated_data(star.customer, "customer_dim")
    assert rules.rule_report(star.fact, rules.constraints("sales_fact"), "sales_fact").where("NOT passed").count() == 3
    assert [f.name for f in CURATED["sales_fact"] if not f.nullable][0] == "sale_key"


def test_profile_exact_and_sketched(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), ("a", 3)], "s string, n int")
    assert rows(checks.column_profile(df, "t"), "column_name", "null_count", "distinct_count", "min_value", "max_value") == [
        ("n", 1, 2, "1", "3"), ("s", 0, 2, "a", "b")]
    assert rows(checks.column_profile(df, "t", exact=False), "column_name", "distinct_count") == [("n", 2), ("s", 2)]


def test_job_health(spark):
    log = [("etl", i, s, datetime(2024, 1, i), m) for i, s, m in (
        (1, "FAILED", 60.0), (2, "SUCCEEDED", 10.0), (3, "FAILED", 2.0), (4, "SUCCEEDED", 3.0), (5, "SUCCEEDED", 5.0), (6, "RUNNING", None))]
    runs = spark.createDataFrame(log, "job_name string, run_id long, state string, started_on timestamp, minutes double")
    jobs = spark.createDataFrame([("etl",), ("new",)], "job_name string")
    out = {r.job_name: r for r in job_health(runs, jobs=jobs).collect()}
    assert (out["etl"].last_run_status, out["etl"].success_rate, out["etl"].avg_duration_minutes) == ("RUNNING", 60.0, 5.0)
    assert (out["new"].last_run_status, out["new"].last_run_time, out["new"].success_rate) == ("NO_RUNS", None, 0.0)


def test_freshness_and_recent_errors(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("b", datetime(2023, 12, 31, 23)), ("b", datetime(2023, 12, 1))], "k string, t timestamp")
    got = {r.k: (float(r.age_hours), r.status) for r in data_freshness(df, "t", now, 24, "k").collect()}
    assert got == {"a": (24.0, "FRESH"), "b": (25.0, "STALE")}
    assert data_freshness(df.limit(0), "t", now).first().status == "NO_DATA"
    errors = spark.createDataFrame([(i, datetime(2024, 1, 1, 23, 10 * i)) for i in range(6)], "i int, t timestamp")
    assert [r.i for r in recent_errors(errors, "t", F.lit("2024-01-02 00:20:00").cast("timestamp")).collect()] == [5, 4, 3]
