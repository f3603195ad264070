"""Integrity checks and quality reports over raw tables and over the star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.fact import KEYS
from starmill.operators.joins import count_orphans
from starmill.plans.rules import (
    DataQualityError, REGIONS, constraints, duplicate_counts, long_form, raw_rules, rule_report, union_all,
    validate_raw_data)
from starmill.plans.warehouse import Star
from starmill.schemas import NATURAL_KEYS, SURROGATE_KEYS

SAMPLE = 5
INTEGRITY = (("customers", "customer_id"), ("products", "product_id"), ("locations", "location_id"))

# Texts that the reports' readers look for.
NULL_KEYS_FOUND = "FAIL: Null keys found in sales_fact"
NULL_KEYS_NONE = "PASS"
ORPHAN_LABELS = {"customer": "Orphaned Customers", "product": "Orphaned Products", "location": "Orphaned Locations",
                 "date": "Orphaned Dates"}
NEGATIVE_QUANTITY, NEGATIVE_PRICE = "Negative Quantities", "Negative Prices"
ZERO_SALE, GROSS_BELOW_NET = "Zero Sales Amount", "Gross < Net (Invalid)"
CHECK_NAMES = ("Null Foreign Keys", "Negative Values", "Future Dates", "Orphaned Records")
SUMMARY_COLUMNS = {"customer_dim": "customers", "product_dim": "products", "location_dim": "locations",
                   "date_dim": "dates", "sales_fact": "sales_transactions"}


def table_row_counts(star: Star) -> DataFrame:
    return union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
                      for name, df in star.tables().items()])


def catalog_statistics(spark: SparkSession, database: str) -> DataFrame:
    """Row count of every table of a catalog database, by name; an empty report for an empty database."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    empty = spark.createDataFrame([], "schema_name string, table_name string, row_count long")
    counts = [spark.table(f"{database}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(database).alias("schema_name"), F.lit(n).alias("table_name"), "row_count") for n in names]
    return union_all([empty, *counts]).orderBy("table_name")


def table_counts_wide(star: Star) -> DataFrame:
    """All counts in one row."""
    counts = table_row_counts(star)
    picked = [F.max(F.when(F.col("table_name") == t, F.col("row_count"))).alias(n) for t, n in SUMMARY_COLUMNS.items()]
    return counts.agg(*picked).select(F.lit("Summary").alias("description"), *SUMMARY_COLUMNS.values())


_PLURAL = {"customer_key": "customers", "product_key": "products", "location_key": "locations", "date_key": "dates"}


def null_key_profile(fact: DataFrame) -> DataFrame:
    """Rows, and valid and missing keys per dimension, in one pass."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(k).alias(f"valid_{n}") for k, n in _PLURAL.items()],
        *[F.count_if(F.col(k).isNull()).alias(f"null_{n}") for k, n in _PLURAL.items()])


def _any_key_missing() -> Column:
    return F.greatest(*[F.col(k).isNull() for k in KEYS])


def null_key_verdict(fact: DataFrame) -> DataFrame:
    missing = F.count_if(_any_key_missing())
    return fact.agg(F.when(missing > 0, NULL_KEYS_FOUND).otherwise(NULL_KEYS_NONE).alias("null_check"),
                    missing.alias("null_rows"))


def orphan_checks(fact: DataFrame, star: Star) -> DataFrame:
    """Fact rows per dimension whose key is missing there."""
    return union_all([
        count_orphans(fact, getattr(star, d), f"{d}_key").select(F.lit(label).alias("check_type"), "orphan_count")
        for d, label in ORPHAN_LABELS.items()])


def unknown_ids(sales: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the sales that the lookup lacks (missing ids aside)."""
    used = sales.select(key).where(F.col(key).isNotNull()).distinct()
    return used.join(lookup.select(key), key, "left_anti")


def cross_table_integrity(raw: dict[str, DataFrame], sample: int = SAMPLE) -> DataFrame:
    """Per id: how many distinct unknown ids the sales hold, and the first few of them."""
    reports = []
    for table, key in INTEGRITY:
        unknown = unknown_ids(raw["sales"], raw[table], key)
        total = unknown.agg(F.count(F.lit(1)).alias("invalid_ids"))
        few = unknown.orderBy(key).limit(sample).agg(F.sort_array(F.collect_list(key)).alias("sample"))
        reports += [
            total.select(F.lit(key).alias("column_name"), "invalid_ids", F.lit(None).cast("string").alias("sample_ids")),
            few.select(F.lit(key).alias("column_name"), F.lit(None).cast("long").alias("invalid_ids"),
                       F.array_join("sample", ",").alias("sample_ids"))]
    merged = union_all(reports).groupBy("column_name").agg(
        F.max("invalid_ids").alias("invalid_ids"), F.max("sample_ids").alias("sample_ids"))
    return merged.withColumn("passed", F.col("invalid_ids") == 0)


def check_integrity(raw: dict[str, DataFrame]) -> bool:
    broken = cross_table_integrity(raw).where("NOT passed").collect()
    if broken:
        text = "; ".join(f"{r.invalid_ids} unknown {r.column_name}: {r.sample_ids}" for r in broken)
        raise DataQualityError(f"referential integrity violation: {text}", broken)
    return True


def run_all_checks(raw: dict[str, DataFrame], regions=REGIONS) -> bool:
    """Rules of the four raw tables, then integrity; raises on the first table that fails."""
    for table in ("customers", "products", "locations", "sales"):
        validate_raw_data(raw[table], table, regions)
    return check_integrity(raw)


def raw_rule_report(raw: dict[str, DataFrame], regions=REGIONS) -> DataFrame:
    return union_all([rule_report(raw[t], raw_rules(t, regions), t)
                      for t in ("customers", "products", "locations", "sales")])


def constraint_report(star: Star) -> DataFrame:
    return union_all([rule_report(df, constraints(t), t) for t, df in star.tables().items()])


def duplicate_keys(raw: dict[str, DataFrame], star: Star) -> DataFrame:
    """Repeated keys of the raw tables and of the star."""
    keys = {t: [NATURAL_KEYS[t], SURROGATE_KEYS[t]] for t in NATURAL_KEYS}
    keys |= {"date_dim": ["date_key", "date_value"], "sales_fact": ["sale_key", "sale_id"]}
    return union_all([duplicate_counts(raw[t], t, [k]) for t, k in (*INTEGRITY, ("sales", "sale_id"))]
                     + [duplicate_counts(df, t, keys[t]) for t, df in star.tables().items()])


def anomaly_counts(fact: DataFrame) -> DataFrame:
    """Odd amounts, in one pass; gross below net is only information: it holds whenever tax exceeds the discount."""
    odd = {
        NEGATIVE_QUANTITY: F.col("quantity") < 0,
        NEGATIVE_PRICE: F.col("unit_price") < 0,
        ZERO_SALE: F.col("net_amount") == 0,
        GROSS_BELOW_NET: F.col("gross_amount") < F.col("net_amount"),
    }
    counts = fact.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(odd.values())])
    return long_form(counts, [F.struct(F.lit(n).alias("anomaly_type"), F.col(f"c{i}").alias("anomalies"))
                              for i, n in enumerate(odd)])


def business_rules(star: Star) -> DataFrame:
    """The amounts follow their formulas exactly; no key of a stored table occurs twice."""
    fact = star.fact
    gross = F.col("quantity") * F.col("unit_price")
    net = F.col("gross_amount") - F.col("discount_amount") + F.col("tax_amount")
    counts = fact.agg(F.count_if(F.col("gross_amount") != gross).alias("g"),
                      F.count_if(F.col("net_amount") != net).alias("n"))
    formulas = long_form(counts, [
        F.struct(F.lit("gross = quantity * unit_price").alias("rule"), F.col("g").alias("violations")),
        F.struct(F.lit("net = gross - discount + tax").alias("rule"), F.col("n").alias("violations"))])
    keys = [*SURROGATE_KEYS.items(), ("date_dim", "date_key"), ("sales_fact", "sale_key")]
    unique = [duplicate_counts(star.tables()[t], t, [k]).select(
        F.lit(f"unique {t}.{k}").alias("rule"), F.col("duplicate_values").alias("violations")) for t, k in keys]
    return union_all([formulas, *unique]).withColumn("passed", F.col("violations") == 0)


def negative_values(fact: DataFrame) -> DataFrame:
    """Counts of negative quantities and of negative net amounts; 0 on an empty table."""
    counts = fact.agg(F.count_if(F.col("quantity") < 0).alias("negative_quantity"),
                      F.count_if(F.col("net_amount") < 0).alias("negative_amount"))
    return counts.withColumn("passed", (F.col("negative_quantity") == 0) & (F.col("negative_amount") == 0))


def future_dates(star: Star, as_of: date) -> DataFrame:
    """Fact rows dated after ``as_of``; only the days after it are looked up."""
    later = star.date.where(F.col("date_value") > F.lit(as_of)).select("date_key")
    hits = star.fact.join(F.broadcast(later), "date_key", "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("future_date_count")).withColumn("passed", F.col("future_date_count") == 0)


def quality_verdict(fact: DataFrame, star: Star, as_of: date) -> DataFrame:
    """One row per check (null keys, negative values, future dates, orphans) and the overall verdict on each."""
    dated = Star(fact=fact, customer=star.customer, product=star.product, location=star.location, date=star.date)
    orphans = orphan_checks(fact, star).where(F.col("check_type").isin(ORPHAN_LABELS["customer"], ORPHAN_LABELS["product"]))
    counts = (
        null_key_verdict(fact).select(F.col("null_rows").alias("violations")),
        negative_values(fact).select((F.col("negative_quantity") + F.col("negative_amount")).alias("violations")),
        future_dates(dated, as_of).select(F.col("future_date_count").alias("violations")),
        orphans.agg(F.sum("orphan_count").alias("violations")),
    )
    checks = union_all([df.select(F.lit(name).alias("check_name"), "violations") for name, df in zip(CHECK_NAMES, counts)])
    # Four rows: folded into one and unfolded again, so that the checks run once.
    folded = checks.agg(F.collect_list(F.struct("check_name", "violations")).alias("checks"),
                        F.max("violations").alias("worst"))
    return folded.select(
        F.when(F.col("worst") == 0, "PASSED").otherwise("FAILED").alias("overall_status"),
        F.inline("checks")).withColumn("passed", F.col("violations") == 0)


def calendar_validity(star: Star) -> DataFrame:
    """The date table is unique, has no gap and covers the dates of the fact."""
    shape = star.date.agg(
        (F.count(F.lit(1)) - F.count_distinct("date_value")).alias("u"),
        (F.date_diff(F.max("date_value"), F.min("date_value")) + 1 - F.count_distinct("date_value")).cast("long").alias("g"))
    rows = long_form(shape, [
        F.struct(F.lit("unique").alias("check_name"), F.col("u").alias("violations")),
        F.struct(F.lit("gap_free").alias("check_name"), F.col("g").alias("violations"))])
    covered = count_orphans(star.fact, star.date, "date_key").select(
        F.lit("covers_fact").alias("check_name"), F.col("orphan_count").alias("violations"))
    return union_all([rows, covered]).withColumn("passed", F.col("violations") == 0)


def column_profile(df: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value as text.

    Nulls and extremes take one pass without a shuffle.  Exact distinct counts
    go over (column, value) pairs that are folded up before the shuffle; with
    ``exact=False`` a sketch in the same pass replaces them.
    """
    names = df.columns
    parts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        parts += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.min(c).cast("string").alias(f"lo{i}"),
                  F.max(c).cast("string").alias(f"hi{i}")]
        if not exact:
            parts.append(F.approx_count_distinct(c).alias(f"d{i}"))
    shape = long_form(df.agg(*parts), [
        F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("row_count"), F.col(f"n{i}").alias("null_count"),
                 F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"),
                 *([] if exact else [F.col(f"d{i}").alias("distinct_count")]))
        for i, c in enumerate(names)])
    if exact:
        pairs = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in names])))
        distinct = (pairs.where(F.col("value").isNotNull()).groupBy("column_name", "value").agg(F.lit(1).alias("one"))
                    .groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")))
        shape = shape.join(F.broadcast(distinct), "column_name", "left").withColumn(
            "distinct_count", F.coalesce("distinct_count", F.lit(0)))
    share = F.col("null_count").cast("double") / F.col("row_count") * 100
    return shape.select(F.lit(table).alias("table_name"), "column_name", "row_count", "null_count",
                        share.alias("null_percent"), "distinct_count", "min_value", "max_value")
