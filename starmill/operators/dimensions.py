"""The four dimensions: cleaned, one row per natural key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.functions.calendar import calendar_columns
from starmill.functions.cleaning import digits_only, full_name, lower_trim, margin_percent, upper_trim
from starmill.schemas import CURATED, RAW, conform

VERSION = "source_modified"  # optional column: when the row's source file was written
CALENDAR_START = date(2020, 1, 1)
CALENDAR_END = date(2030, 12, 31)


def keep_latest(df: DataFrame, key: str, newest: list[str]) -> DataFrame:
    """One row per key: the first in descending order of ``newest``, then of every other column.

    The order is total over distinct rows, so the survivor does not depend on
    the layout.  Spark limits each group to one row before the shuffle.
    """
    rest = [c for c in df.columns if c != key and c not in newest]
    order = [F.col(c).desc_nulls_last() for c in [*newest, *rest]]
    ranked = df.withColumn("_row", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where("_row = 1").drop("_row")


def _typed(raw: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    extra = (VERSION,) if VERSION in raw.columns else ()
    return conform(raw, RAW[table], keep=extra), list(extra)


def clean_customers(raw: DataFrame, as_of: Column) -> DataFrame:
    """Customers by id; the latest creation date wins, a missing one counts as the run date."""
    df, version = _typed(raw, "customers")
    df = df.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        full_name("first_name", "last_name").alias("full_name"),
        lower_trim("email").alias("email"),
        digits_only("phone").alias("phone"),
        "address", "city", "state", "zip_code", "country",
        F.coalesce("created_date", as_of).alias("created_date"),
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        *version,
    )
    return keep_latest(df, "customer_id", ["created_date", *version]).drop(VERSION)


def clean_products(raw: DataFrame) -> DataFrame:
    """Products by id; the survivor must have a price of at least 0.

    The price is tested after the survivor is chosen: a bad latest version
    removes the product instead of reviving an older one.
    """
    df, version = _typed(raw, "products")
    df = df.where(F.col("product_id").isNotNull()).select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        upper_trim("category").alias("category"),
        upper_trim("subcategory").alias("subcategory"),
        "brand", "unit_price", "cost",
        F.coalesce("is_active", F.lit(True)).alias("is_active"),
        *version,
    )
    df = keep_latest(df, "product_id", version).where("unit_price >= 0")
    margin = margin_percent(F.col("unit_price"), F.col("cost")).try_cast("decimal(5,2)")
    return df.withColumn("margin", margin).drop(VERSION)


def clean_locations(raw: DataFrame) -> DataFrame:
    df, version = _typed(raw, "locations")
    df = df.where(F.col("location_id").isNotNull()).select(
        "location_id",
        F.trim("store_name").alias("store_name"),
        "address",
        F.trim("city").alias("city"),
        upper_trim("state").alias("state"),
        "zip_code",
        upper_trim("region").alias("region"),
        upper_trim("country").alias("country"),
        *version,
    )
    return keep_latest(df, "location_id", version).drop(VERSION)


def with_keys(cleaned: DataFrame, key_map: DataFrame, table: str, loaded_at: Column) -> DataFrame:
    """Attach the surrogate keys and the audit time; project to the stored contract."""
    contract = CURATED[table]
    natural = contract[1].name
    return conform(cleaned.join(key_map, natural).withColumn("etl_inserted_date", loaded_at), contract)


def build_date_dimension(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END,
                         loaded_at: Column | None = None) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias("_day"))
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    columns = [c.alias(name) for name, c in calendar_columns(F.col("_day")).items()]
    return conform(days.select(*columns, loaded_at.alias("etl_inserted_date")), CURATED["date_dim"])
