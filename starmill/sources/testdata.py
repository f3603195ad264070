"""The driver's tables as raw customers, products, locations and sales.

The generated tables are clean, so defects are derived from the ids: padded
and mixed-case text, missing values, duplicates, unknown and missing ids,
unreadable dates and numbers.  All columns are text, as in a delimited file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join
from starmill.schemas import RAW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _text(df: DataFrame, raw: str) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in RAW[raw].names])


def _with_older_copy(df: DataFrame, key: str, n: int) -> DataFrame:
    """A second, older version of every ``n``-th row, marked by ``old``."""
    versions = F.when(every(key, n), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return df.withColumn("old", F.explode(versions))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    df = lookup_join(df, nation, "c_nationkey", spread="c_custkey")
    df = _with_older_copy(df.withColumn("k", F.col("c_custkey")), "k", 10)
    k, old = F.col("k"), F.col("old")
    name = F.split("c_name", "#")
    email = (F.when(every("k", 211), "invalid.address")
             .when(every("k", 3), F.concat(F.lit("  User"), k, F.lit("@Example.COM ")))
             .otherwise(F.concat(F.lit("user"), k, F.lit("@example.com"))))
    created = (F.when(old, F.lit("1989-06-01").cast("date")).when(every("k", 17), None)
               .otherwise(F.date_add(F.lit("1990-01-01").cast("date"), (k % 3000).cast("int"))))
    return _text(df.select(
        F.when(~every("k", 97), F.concat(F.lit("CUST"), k)).alias("customer_id"),
        F.when(~every("k", 13), name[0]).alias("first_name"),
        name[1].alias("last_name"),
        email.alias("email"),
        F.concat(F.lit("(555) 010-"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone"),
        F.concat(k, F.lit(" Main St")).alias("address"),
        F.when(old, "Old City").otherwise(F.concat(F.lit("City "), k % 50)).alias("city"),
        F.col("n_name").alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        F.lit("USA").alias("country"),
        created.alias("created_date"),
        F.when(~every("k", 7), ~every("k", 5)).alias("is_active"),
    ), "customers")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey"))
    df = _with_older_copy(df, "k", 20)
    old = F.col("old")
    price = F.col("p_retailprice").cast("decimal(10,2)")
    percent = (F.lit(40) + F.col("p_size") + F.when(every("k", 23), 80).otherwise(0)).cast("decimal(4,0)")
    cost = (price * percent * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")
    asked = (F.when(old, "1.00").when(every("k", 101), "-1.00").when(every("k", 107), "0.00")
             .when(every("k", 109), None).otherwise(price.cast("string")))
    return _text(df.select(
        F.when(~every("k", 103), F.concat(F.lit("PROD"), "k")).alias("product_id"),
        (F.when(old, F.concat(F.lit("old "), "p_name"))
         .when(every("k", 4), F.concat(F.lit("  "), "p_name", F.lit(" "))).otherwise(F.col("p_name"))).alias("product_name"),
        F.when(every("k", 3), F.concat(F.lit(" "), F.lower("p_type"))).otherwise(F.col("p_type")).alias("category"),
        F.concat(F.lit("Size "), F.floor((F.col("p_size") - 1) / 10)).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        asked.alias("unit_price"),
        F.when(~every("k", 19), cost).alias("cost"),
        F.when(~every("k", 11), ~every("k", 8)).alias("is_active"),
    ), "products")


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = table(spark, sf_dir, "nation").join(region, "n_regionkey").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name")
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    df = lookup_join(df, nation, "s_nationkey", spread="s_suppkey").withColumn("k", F.col("s_suppkey"))
    df = _with_older_copy(df, "k", 25)
    k, old = F.col("k"), F.col("old")
    store = (F.when(old, F.concat(F.lit("Zed "), "s_name"))
             .when(every("k", 3), F.concat(F.lit("  "), "s_name", F.lit(" "))).otherwise(F.col("s_name")))
    return _text(df.select(
        F.when(~every("k", 53), F.concat(F.lit("LOC"), k)).alias("location_id"),
        store.alias("store_name"),
        F.concat(k, F.lit(" Market Sq")).alias("address"),
        F.concat(F.lit(" City "), k % 20).alias("city"),
        F.when(every("k", 2), F.lower("n_name")).otherwise(F.col("n_name")).alias("state"),
        F.lpad((k % 100000).cast("string"), 5, "0").alias("zip_code"),
        (F.when(every("k", 29), "Unknown").when(every("k", 5), F.lower("r_name")).otherwise(F.col("r_name"))).alias("region"),
        F.lit(" usa").alias("country"),
    ), "locations")


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Both joins may shuffle the lines: amounts go as short decimals, and the line itself tells where to spread.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int").alias("l_quantity"),
        *[F.when(~every("l_orderkey", n), F.col(c).cast("decimal(4,2)")).alias(c) for c, n in (("l_discount", 5), ("l_tax", 7))])
    line = F.struct(*lines.columns)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.to_date("o_orderdate").alias("o_date"))
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"))
    df = lookup_join(lines, part, "l_partkey", spread=line)
    df = lookup_join(df, orders, "l_orderkey", spread=line, probe=lines)
    df = df.withColumn("k", F.col("l_orderkey"))
    quantity = (F.when(every("k", 251), -F.col("l_quantity")).when(every("k", 241), 0)
                .otherwise(F.col("l_quantity"))).cast("int")
    amount = quantity * F.col("price")
    buyer = F.when(every("o_custkey", 31), F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    customer = (F.when(every("k", 101), None).when(every("k", 89), "CUST999999999")
                .when(every("k", 83), F.concat(F.lit("cust"), buyer)).otherwise(F.concat(F.lit("CUST"), buyer)))
    product = F.when(every("k", 113), "PROD999999999").otherwise(F.concat(F.lit("PROD"), "l_partkey"))
    day = (F.when(every("k", 997), "not-a-date").when(every("k", 499), "1990-01-15")
           .otherwise(F.col("o_date").cast("string")))

    def share(column: str) -> Column:
        return (amount * F.col(column)).cast("decimal(10,2)")

    return _text(df.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("sale_id"),
        customer.alias("customer_id"),
        product.alias("product_id"),
        F.concat(F.lit("LOC"), "l_suppkey").alias("location_id"),
        day.alias("sale_date"),
        (F.when(every("k", 1009), "many").when(every("k", 307), F.concat(quantity, F.lit(".0")))
         .when(every("k", 311), F.concat(quantity, F.lit(".5"))).otherwise(quantity.cast("string"))).alias("quantity"),
        F.col("price").alias("unit_price"),
        share("l_discount").alias("discount_amount"),
        share("l_tax").alias("tax_amount"),
    ), "sales")


RAW_BUILDERS = {
    "customers": raw_customers, "products": raw_products, "locations": raw_locations, "sales": raw_sales,
}
