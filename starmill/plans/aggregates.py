"""Summary tables and the standard analytics queries over the star.

Facts are grouped by a dimension's key before the dimension is joined wherever
the measures allow it: the join then sees one row per key, and a hot key is
folded up on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import measures as m
from starmill.operators.groups import group_by_month, near_by_month
from starmill.operators.joins import with_values
from starmill.operators.sinks import replace_partitions
from starmill.plans.warehouse import Star

MONTHLY_KEYS = ["year", "month", "month_name", "category", "subcategory", "region", "state"]


def _months_of(star: Star, fact: DataFrame) -> DataFrame:
    return star.join(fact, "date", ["year", "month", "month_name"])


def monthly_sets(star: Star, fact: DataFrame) -> DataFrame:
    """Sums and customers of fact rows, by the keys of the monthly summary and the customers' bucket of 32,768 keys.

    What is shuffled, once, is the line's amounts and customer with numbers for the attributes; a set has 32,768 positions
    at most.  Lookups with too many values for numbers are joined: products come first, so that their shuffle carries no
    text of the others.
    """
    rows, values = fact, {}
    for dim, columns in (("product", ["category", "subcategory"]), ("location", ["region", "state"]), ("date", MONTHLY_KEYS[:3])):
        if (coded := star.code(rows, dim, columns, f"_{dim}")) is None:
            rows = star.join(rows, dim, columns)
        else:
            rows, values[f"_{dim}"] = coded
    month = ["_date"] if "_date" in values else MONTHLY_KEYS[:3]
    given = {c for known in values.values() for c in known.columns}
    others = [*[n for n in values if n != "_date"], *[c for c in MONTHLY_KEYS[3:] if c not in given], "bucket"]
    key, amounts = F.col("customer_key"), ["quantity", "gross_amount", "discount_amount", "net_amount"]
    rows = rows.withColumns({"bucket": F.bitmap_bucket_number(key), "position": F.bitmap_bit_position(key).cast("int")})
    rows = rows.select(*month, *others, "position", F.col("sale_key").isNotNull().alias("numbered"), *amounts)
    sets = group_by_month(
        near_by_month(rows, month, others), month, others, F.count_if("numbered").alias("transactions"), F.sum("quantity").alias("quantity"),
        F.sum("gross_amount").alias("gross"), m.total_discount().alias("discounts"), m.total_sales().alias("net"),
        F.count("net_amount").alias("nets"), F.collect_set("position").alias("positions"))
    for name, known in values.items():
        sets = with_values(sets, known, name)
    return sets


def monthly_sales(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Sales by month, category, subcategory, region and state."""
    sums = {"transactions": "total_transactions", "quantity": "total_quantity_sold", "gross": "total_gross_sales",
            "discounts": "total_discounts", "net": "total_net_sales"}
    sets = monthly_sets(star, star.fact if fact is None else fact)
    kinds = dict(sets.dtypes)  # of one sum over the fact: sums of sums do not widen
    return sets.groupBy(*MONTHLY_KEYS).agg(
        F.sum(F.size("positions")).alias("unique_customers"), *[F.sum(c).cast(kinds[c]).alias(n) for c, n in sums.items()],
        (F.sum("net").cast("double") / F.sum("nets")).alias("avg_transaction_value"))


def customer_summary(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """Purchases of every customer, also of those without any; of the whole fact or of the given rows."""
    def day(key):  # the key is the date itself, so lines need not meet the calendar
        return F.try_to_date(key.cast("string"), "yyyyMMdd")

    bought = (star.fact if fact is None else fact).groupBy("customer_key").agg(
        F.count("sale_key").alias("total_purchases"),
        F.sum("quantity").alias("total_items_purchased"),
        F.sum("net_amount").alias("lifetime_value"),
        m.average_sale().alias("avg_order_value"),
        day(F.max("date_key")).alias("last_purchase_date"),
        day(F.min("date_key")).alias("first_purchase_date"),
    )
    who = star.customer.select("customer_key", "customer_id", "full_name", "city", "state")
    return who.join(bought, "customer_key", "left").withColumn(
        "total_purchases", F.coalesce("total_purchases", F.lit(0)).cast("long"))


def buyers(star: Star, summary: DataFrame | None = None) -> DataFrame:
    """Customers who bought: from the stored customer ``summary``, or from the fact without one."""
    return (customer_summary(star) if summary is None else summary).where("total_purchases > 0")


def top_customers(star: Star, n: int = 10, summary: DataFrame | None = None) -> DataFrame:
    """The ``n`` customers with the highest lifetime value."""
    return (buyers(star, summary).select("customer_id", "full_name", "city", "state", "total_purchases", "lifetime_value")
            .orderBy(F.desc_nulls_last("lifetime_value"), "customer_id").limit(n))


def by_month(star: Star, dim: str, column: str) -> DataFrame:
    """Net sales by month and one attribute of a dimension: lines are folded by month and key before any join."""
    folded = star.fact.groupBy("month_key", f"{dim}_key").agg(F.sum("net_amount").alias("net"))
    months = star.date.select((F.col("year").cast("int") * 100 + F.col("month")).alias("month_key"),
                              "year", "month", "month_name").distinct()
    rows = star.join(folded.join(months, "month_key"), dim, [column], grouped=True)
    return rows.groupBy("year", "month", "month_name", column).agg(F.sum("net").alias("net"))


def monthly_trend(star: Star) -> DataFrame:
    return (_months_of(star, star.fact).groupBy("year", "month", "month_name").agg(
        m.unique_customers().alias("unique_customers"),
        F.sum("quantity").alias("units_sold"),
        m.total_sales().alias("total_revenue"),
        m.average_sale().alias("avg_transaction_value"),
    ).orderBy("year", "month").drop("month"))


def product_revenue(star: Star) -> DataFrame:
    """Units and revenue by category and product name."""
    sold = star.fact.groupBy("product_key").agg(F.sum("quantity").alias("units"), F.sum("net_amount").alias("net"))
    named = star.join(sold, "product", ["category", "product_name"], grouped=True)
    return named.groupBy("category", "product_name").agg(
        F.sum("units").alias("units_sold"), F.sum("net").alias("total_revenue"))


def top_products(star: Star, n: int = 20) -> DataFrame:
    """The ``n`` best products over all categories."""
    return product_revenue(star).orderBy(F.desc_nulls_last("total_revenue"), "category", "product_name").limit(n)


def top_products_per_category(star: Star, n: int = 3) -> DataFrame:
    best = Window.partitionBy("category").orderBy(F.desc_nulls_last("total_revenue"), "product_name")
    return product_revenue(star).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def regional_performance(star: Star) -> DataFrame:
    """Distinct customers, transactions and sales by region and state."""
    return star.join(star.fact, "location", ["region", "state"]).groupBy("region", "state").agg(
        m.unique_customers().alias("unique_customers"),
        m.transactions().alias("transactions"),
        m.total_sales().alias("total_sales"),
    ).orderBy(F.desc_nulls_last("total_sales"), "region", "state")


def weekend_vs_weekday(star: Star) -> DataFrame:
    per_day = star.fact.groupBy("date_key").agg(
        F.count("sale_key").alias("sales"), F.sum("net_amount").alias("net"), F.count("net_amount").alias("nets"))
    daily = star.join(per_day, "date", ["is_weekend"], grouped=True)
    label = F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday")
    return daily.groupBy(label.alias("day_type")).agg(
        F.sum("sales").alias("transactions"),
        F.sum("net").alias("total_sales"),
        (F.sum("net").cast("double") / F.sum("nets")).alias("avg_transaction"),
    ).orderBy("day_type")


def category_by_month(star: Star) -> DataFrame:
    return (by_month(star, "product", "category").withColumnRenamed("net", "revenue")
            .orderBy("year", "month", F.desc_nulls_last("revenue"), "category").drop("month"))


def sales_enriched(star: Star) -> DataFrame:
    """The model behind the dashboards: each sale with the attributes of its four dimensions.

    The dimensions that may be large come first, the one with the least text before the other: what a shuffle carries
    is the sale and few attributes.
    """
    attributes = {
        "date": ["date_value", "year", "quarter", "month", "month_name", "day", "is_weekend", "fiscal_year"],
        "product": ["product_id", "product_name", "category", "subcategory", "brand"],
        "location": ["location_id", "store_name", "region", "state"], "customer": ["customer_id", "full_name", "customer_state"]}
    # the customer's own state is not the store's
    customers = star.customer.select("customer_key", "customer_id", "full_name", F.col("state").alias("customer_state"))
    named = Star(fact=star.fact, customer=customers, product=star.product, location=star.location, date=star.date,
                 rows=star.rows, _hot=star._hot)
    rows = sales = star.fact.drop("etl_inserted_date")
    for dim in ("customer", "product", "location", "date"):
        rows = named.join(rows, dim, attributes[dim])
    order = ["customer_key", "location_key", "product_key", "date_key"]
    return rows.select(*order, *[c for c in sales.columns if c not in order], *[c for names in attributes.values() for c in names])


def merge_customer_summary(star: Star, stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The customer summary after a batch of new fact rows: counts and sums add up, first and last days extend."""
    kept = ["customer_key", "total_purchases", "total_items_purchased", "lifetime_value", "last_purchase_date", "first_purchase_date"]
    new = customer_summary(star, batch).where("total_purchases > 0").select(*kept)
    both = stored.where("total_purchases > 0").select(*kept).unionByName(new).groupBy("customer_key").agg(
        *[F.sum(c).alias(c) for c in kept[1:4]], F.max(kept[4]).alias(kept[4]), F.min(kept[5]).alias(kept[5]))
    # Every line of the fact has a net amount.
    mean = (F.col("lifetime_value").cast("double") / F.col("total_purchases")).alias("avg_order_value")
    who = star.customer.select("customer_key", "customer_id", "full_name", "city", "state")
    return who.join(both, "customer_key", "left").select(
        *who.columns, F.coalesce("total_purchases", F.lit(0)).cast("long").alias("total_purchases"), "total_items_purchased",
        F.col("lifetime_value").cast(stored.schema["lifetime_value"].dataType).alias("lifetime_value"), mean,
        "last_purchase_date", "first_purchase_date")


def refresh_monthly_sales(star: Star, batch: DataFrame, path: str) -> None:
    """Recompute the months that a batch of fact rows touches and replace only their partitions.

    Distinct customers cannot be added up, so a touched month is recomputed from
    the whole fact, of which no other month partition is read.
    """
    # At most one value per calendar month.
    months = [r["month_key"] for r in batch.select("month_key").distinct().collect()]
    touched = star.fact.where(F.col("month_key").isin(months))
    replace_partitions(monthly_sales(star, touched), path, ["year", "month"])
