"""Small raw tables for the tests."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.schemas import RAW, text_schema

AS_OF = date(2024, 12, 31)


def raw_table(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    names = RAW[table].names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], text_schema(table))


def customer(n, **over) -> dict:
    return {"customer_id": f"CUST{n}", "first_name": "Ann", "last_name": f"Lee{n}", "email": f"a{n}@x.org",
            "phone": "555-0101", "address": "1 Road", "city": "Town", "state": "NY", "zip_code": "02101",
            "country": "USA", "created_date": "2023-01-15", "is_active": "true", **over}


def product(n, **over) -> dict:
    return {"product_id": f"PROD{n}", "product_name": f"Thing {n}", "category": "TOOLS", "subcategory": "SMALL",
            "brand": "B", "unit_price": "10.00", "cost": "4.00", "is_active": "true", **over}


def location(n, **over) -> dict:
    return {"location_id": f"LOC{n}", "store_name": f"Store {n}", "address": "2 Road", "city": "Town", "state": "NY",
            "zip_code": "02199", "region": "EAST", "country": "USA", **over}


def sale(n, **over) -> dict:
    return {"sale_id": f"SALE{n}", "customer_id": "CUST1", "product_id": "PROD1", "location_id": "LOC1",
            "sale_date": "2024-01-05", "quantity": "2", "unit_price": "10.00", "discount_amount": "1.00",
            "tax_amount": "0.50", **over}


def write_raw(spark: SparkSession, root: str, customers, products, locations, sales, fmt="csv") -> None:
    for table, rows in (("customers", customers), ("products", products), ("locations", locations), ("sales", sales)):
        df = raw_table(spark, table, rows).coalesce(1)
        (df.write.mode("overwrite").option("header", True).csv if fmt == "csv" else df.write.mode("overwrite").parquet)(
            f"{root}/{table}")


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def fact_frame(spark: SparkSession, data: list[tuple]) -> DataFrame:
    """(sale_key, customer_key, product_key, location_key, day, net) -> fact rows."""
    data = [(*row[:-1], Decimal(row[-1])) for row in data]
    df = spark.createDataFrame(
        data, "sale_key long, customer_key long, product_key long, location_key long, day date, net decimal(12,2)")
    key = F.date_format("day", "yyyyMMdd").cast("int")
    return df.select(
        "sale_key", F.concat(F.lit("S"), "sale_key").alias("sale_id"), "customer_key", "product_key", "location_key",
        key.alias("date_key"), F.lit(1).alias("quantity"), F.col("net").cast("decimal(10,2)").alias("unit_price"),
        F.col("net").alias("gross_amount"), F.lit(0).cast("decimal(10,2)").alias("discount_amount"),
        F.lit(0).cast("decimal(10,2)").alias("tax_amount"), F.col("net").alias("net_amount"),
        F.current_timestamp().alias("etl_inserted_date"), F.floor(key / 100).cast("int").alias("month_key"))
