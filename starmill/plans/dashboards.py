"""Datasets behind the dashboard pages: measures, rankings, trends, hierarchies, segments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import measures as m
from starmill.functions.calendar import date_key
from starmill.functions.cleaning import safe_ratio
from starmill.operators.ranking import rank_cuts, running_total, top_with_ties
from starmill.plans.aggregates import buyers, by_month, customer_summary, product_revenue, sales_enriched
from starmill.plans.warehouse import Star

VIP_SHARE, REGULAR_SHARE = (1, 10), (1, 2)


def _kpis() -> list[Column]:
    return [
        m.total_sales().alias("total_sales"),
        m.transactions().alias("total_transactions"),
        m.average_sale().alias("avg_transaction_value"),
        m.unique_customers().alias("unique_customers"),
        m.total_discount().alias("total_discount"),
        m.discount_rate().alias("discount_rate"),
    ]


def _daily(star: Star, columns: list[str]) -> DataFrame:
    """Net sales and transactions per selling day: as many rows as the calendar has days, at most."""
    per_day = star.fact.groupBy("date_key").agg(
        F.sum("net_amount").alias("net"), F.count("sale_key").alias("sales"))
    return star.join(per_day, "date", columns, grouped=True)


def _whole(*order: str):
    """A window over a whole small table; every use says what bounds the table."""
    window = Window.partitionBy(F.lit(1))
    return window.orderBy(*order) if order else window


def kpi_summary(star: Star) -> DataFrame:
    """The six headline measures over all sales, in one row."""
    return star.fact.agg(*_kpis())


_PERIODS = {"year": ["year"], "quarter": ["year", "quarter"], "month": ["year", "month"]}


def yoy_growth(star: Star, period: str = "month") -> DataFrame:
    """Net sales of each period against the same period a year earlier; growth 0 without a predecessor.

    ``period`` is year, quarter, month or day.  29 February is compared with
    28 February of the year before.
    """
    if period == "day":
        now = _daily(star, ["date_value"]).select("date_value", F.col("net").alias("current_sales"))
        before = now.select(F.col("date_value").alias("_day"), F.col("current_sales").alias("previous_sales"))
        both = now.join(before, F.add_months("date_value", -12) == F.col("_day"), "left").drop("_day")
        keys = ["date_value"]
    else:
        keys = _PERIODS[period]
        now = _daily(star, keys).groupBy(*keys).agg(F.sum("net").alias("current_sales"))
        before = now.withColumn("year", (F.col("year") + 1).cast("smallint")).withColumnRenamed(
            "current_sales", "previous_sales")
        both = now.join(before, keys, "left")
    growth = safe_ratio(F.col("current_sales") - F.col("previous_sales"), F.col("previous_sales"))
    return both.select(*keys, "current_sales", "previous_sales",
                       F.coalesce(growth, F.lit(0.0)).alias("yoy_growth")).orderBy(*keys)


def top10_products_total(star: Star, n: int = 10) -> DataFrame:
    """Net sales of the ``n`` best product names together, ties included."""
    by_name = product_revenue(star).groupBy("product_name").agg(F.sum("total_revenue").alias("revenue"))
    return top_with_ties(by_name, "revenue", n).agg(
        F.count(F.lit(1)).alias("products"), F.sum("revenue").alias("top_products_sales"))


def customer_ltv(star: Star, summary: DataFrame | None = None) -> DataFrame:
    """Lifetime value per customer who bought."""
    return buyers(star, summary).select("customer_id", F.col("lifetime_value").alias("customer_ltv"))


def sales_ma30(star: Star, days: int = 30) -> DataFrame:
    """Net sales of each calendar day up to the last sale, and their mean over the ``days``-day span that ends on the day.

    Days without sales don't count for the mean; a day whose whole span has none is left out.
    """
    sold = star.fact.groupBy("date_key").agg(F.sum("net_amount").alias("net"))
    days_sold = star.date.select("date_key", "date_value").join(sold, "date_key", "left")
    last = F.max(F.when(F.col("net").isNotNull(), F.col("date_value"))).over(_whole())
    daily = days_sold.withColumn("_last", last).where("date_value <= _last").withColumn("_n", F.unix_date("date_value"))
    # One row per calendar day.
    span = _whole("_n").rangeBetween(1 - days, 0)
    mean = F.sum("net").over(span).cast("double") / F.count("net").over(span)
    return (daily.select("date_value", F.col("net").alias("daily_sales"), mean.alias("sales_ma30"))
            .where("sales_ma30 IS NOT NULL").orderBy("date_value"))


def kpi_mom(star: Star) -> DataFrame:
    """The four headline cards per calendar month beside the month before; a month without sales shows as empty."""
    keys = ["year", "month"]
    seen = star.join(star.fact, "date", keys).groupBy(*keys).agg(*_kpis()[:4])
    months = star.date.select(*keys).distinct()
    names = ["total_sales", "total_transactions", "avg_transaction_value", "unique_customers"]
    # One row per calendar month.
    order = _whole(*keys)
    return months.join(seen, keys, "left").select(
        *keys, *names, *[F.lag(n).over(order).alias(f"previous_{n}") for n in names]).orderBy(*keys)


def trend_last_12m(star: Star, as_of: date, months: int = 12) -> DataFrame:
    """Monthly net sales of the ``months`` months up to that of ``as_of``; other fact partitions are not read."""
    first = as_of.year * 12 + as_of.month - months
    first_key, last_key = first // 12 * 100 + first % 12 + 1, as_of.year * 100 + as_of.month
    recent = star.fact.where(F.col("month_key").between(first_key, last_key))
    per_day = recent.groupBy("date_key").agg(F.sum("net_amount").alias("net"), F.count("sale_key").alias("sales"))
    rows = star.join(per_day, "date", ["year", "month", "month_name"], grouped=True)
    return rows.groupBy("year", "month", "month_name").agg(
        F.sum("net").alias("total_sales"), F.sum("sales").alias("transactions")).orderBy("year", "month")


def sales_by(star: Star, dim: str, column: str) -> DataFrame:
    """Net sales and transactions by one attribute of one dimension."""
    per_key = star.fact.groupBy(f"{dim}_key").agg(
        F.sum("net_amount").alias("net"), F.count("sale_key").alias("sales"))
    return (star.join(per_key, dim, [column], grouped=True).groupBy(column)
            .agg(F.sum("net").alias("total_sales"), F.sum("sales").alias("transactions"))
            .orderBy(F.desc_nulls_last("total_sales"), column))


def product_matrix_rollup(star: Star) -> DataFrame:
    """Category > subcategory > product with subtotals; ``level`` 0 is a product, 7 the grand total."""
    sold = star.fact.groupBy("product_key").agg(
        F.sum("quantity").alias("quantity"), F.sum("net_amount").alias("net"))
    named = star.join(sold, "product", ["category", "subcategory", "product_name"], grouped=True)
    # Fold up to the finest level first: the roll-up copies each row four times.
    named = named.groupBy("category", "subcategory", "product_name").agg(
        F.sum("quantity").alias("quantity"), F.sum("net").alias("net"))
    return named.rollup("category", "subcategory", "product_name").agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("quantity").alias("units_sold"), F.sum("net").alias("total_sales"))


def price_vs_volume(star: Star) -> DataFrame:
    """Mean selling price against units sold, per product."""
    sold = star.fact.groupBy("product_key").agg(
        m.mean("unit_price").alias("avg_price"), F.sum("quantity").alias("units_sold"),
        F.sum("net_amount").alias("total_sales"))
    return star.join(sold, "product", ["product_id", "product_name"], grouped=True).drop("product_key")


def category_waterfall(star: Star) -> DataFrame:
    """Each category's contribution and the running total, largest first."""
    rows = running_total(sales_by(star, "product", "category").drop("transactions"), "total_sales", "category")
    share = safe_ratio(F.col("total_sales"), F.col("grand_total"))
    return rows.select("category", "total_sales", "running_total", share.alias("share"))


def purchase_frequency_hist(star: Star, summary: DataFrame | None = None) -> DataFrame:
    """How many customers made how many purchases (0 included)."""
    everyone = customer_summary(star) if summary is None else summary
    return (everyone.groupBy(F.col("total_purchases").alias("purchases"))
            .agg(F.count(F.lit(1)).alias("customers")).orderBy("purchases"))


def customer_segments(star: Star, summary: DataFrame | None = None) -> DataFrame:
    """VIP (top 10 % by lifetime value), Regular (to 50 %) or Occasional; a customer without sales counts as 0.

    The ranking passes over the customers three times, so give it the stored
    customer ``summary``; without it the fact is aggregated each time.
    """
    summary = customer_summary(star) if summary is None else summary
    per_customer = summary.select("customer_id", F.coalesce("lifetime_value", F.lit(0)).alias("lifetime_value"))
    cuts = rank_cuts(per_customer, "lifetime_value", {"vip": VIP_SHARE, "regular": REGULAR_SHARE})
    value = F.col("lifetime_value")
    segment = (F.when(value >= F.lit(cuts["vip"]), "VIP").when(value >= F.lit(cuts["regular"]), "Regular")
               .otherwise("Occasional"))
    return per_customer.withColumn("segment", segment)


def customer_segment_summary(star: Star, summary: DataFrame | None = None) -> DataFrame:
    return customer_segments(star, summary).groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("lifetime_value").alias("total_ltv"),
        m.mean("lifetime_value").alias("avg_ltv"))


def rfm(star: Star, as_of: date, summary: DataFrame | None = None) -> DataFrame:
    """Recency in days, frequency and monetary value per customer who bought."""
    return buyers(star, summary).select("customer_id", F.date_diff(F.lit(as_of), "last_purchase_date").alias("recency_days"),
                         F.col("total_purchases").alias("frequency"), F.col("lifetime_value").alias("monetary"))


def store_performance(star: Star) -> DataFrame:
    """Transactions, distinct customers, revenue and mean ticket per store."""
    sold = star.fact.groupBy("location_key").agg(
        m.transactions().alias("transactions"), m.unique_customers().alias("unique_customers"),
        m.total_sales().alias("total_sales"), m.average_sale().alias("avg_ticket"))
    return star.join(sold, "location", ["location_id", "store_name", "state", "region"], grouped=True).drop("location_key")


def top_stores(star: Star, n: int = 10) -> DataFrame:
    sold = star.fact.groupBy("location_key").agg(m.total_sales().alias("total_sales"))
    named = star.join(sold, "location", ["location_id", "store_name"], grouped=True).drop("location_key")
    return named.orderBy(F.desc_nulls_last("total_sales"), "location_id").limit(n)


def regional_trend(star: Star) -> DataFrame:
    """Net sales by region and month."""
    return (by_month(star, "location", "region").select("region", "year", "month", F.col("net").alias("total_sales"))
            .orderBy("region", "year", "month"))


def slice_sales(star: Star, *, start: date | None = None, end: date | None = None, last_days: int | None = None,
                as_of: date | None = None, fiscal_year: int | None = None, categories: list[str] | None = None,
                brands: list[str] | None = None, regions: list[str] | None = None,
                states: list[str] | None = None) -> DataFrame:
    """The enriched sales under the page's slicers; a slicer that is not set lets everything through.

    A date range is also put on the fact's month partition, so that other months are not read.
    """
    if last_days is not None:
        if as_of is None:
            raise ValueError("last_days needs as_of")
        end, start = as_of, date.fromordinal(as_of.toordinal() - last_days + 1)
    fact = star.fact
    if start:
        fact = fact.where((F.col("month_key") >= start.year * 100 + start.month)
                          & (F.col("date_key") >= date_key(F.lit(start))))
    if end:
        fact = fact.where((F.col("month_key") <= end.year * 100 + end.month)
                          & (F.col("date_key") <= date_key(F.lit(end))))
    rows = sales_enriched(Star(fact=fact, customer=star.customer, product=star.product, location=star.location,
                               date=star.date, rows=star.rows))
    if fiscal_year is not None:
        rows = rows.where(F.col("fiscal_year") == fiscal_year)
    for column, chosen in (("category", categories), ("brand", brands), ("region", regions), ("state", states)):
        if chosen:
            rows = rows.where(F.col(column).isin(chosen))
    return rows


def sliced_kpis(star: Star, by: list[str], **slicers) -> DataFrame:
    """The headline measures under the slicers, by any attributes of the model."""
    return slice_sales(star, **slicers).groupBy(*by).agg(*_kpis())


def calendar_rollup(star: Star) -> DataFrame:
    """Year > month > day with subtotals; ``level`` 0 is a day, 7 the grand total."""
    daily = _daily(star, ["year", "month", "day"])
    return daily.rollup("year", "month", "day").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("net").alias("total_sales"),
        F.sum("sales").alias("transactions"))


def fiscal_year_sales(star: Star) -> DataFrame:
    return (_daily(star, ["fiscal_year"]).groupBy("fiscal_year")
            .agg(F.sum("net").alias("total_sales"), F.sum("sales").alias("transactions")).orderBy("fiscal_year"))


def seasonality_index(star: Star) -> DataFrame:
    """Mean net sales of a month of the year over the mean of all months."""
    monthly = _daily(star, ["year", "month"]).groupBy("year", "month").agg(F.sum("net").alias("net"))
    per_month = monthly.groupBy("month").agg(F.sum("net").alias("s"), F.count("net").alias("n"))
    # Twelve rows.
    overall = F.sum("s").over(_whole()).cast("double") / F.sum("n").over(_whole())
    mean = F.col("s").cast("double") / F.col("n")
    return per_month.select("month", mean.alias("avg_sales"), (mean / overall).alias("seasonality_index")).orderBy("month")


def seasonal_factors(star: Star) -> DataFrame:
    """Ratio of a month's net sales to its centred 2 x 12 month mean, averaged by month of the year, scaled to a sum of 12.

    A trend is in the centred mean and so not in the factors.  Months without six others on both sides in an
    unbroken row have no such mean and are left out; a month of the year that never has one gets none.
    """
    monthly = _daily(star, ["year", "month"]).groupBy("year", "month").agg(F.sum("net").alias("net"))
    return factors_of(monthly)


def factors_of(monthly: DataFrame) -> DataFrame:
    """Seasonal factors of ``year``, ``month``, ``net`` (decimal), a row for each month.

    Ratios are whole billionths, so that their sums don't depend on the order.
    """
    def whole(value: Column) -> Column:
        return F.floor(value + 0.5).cast("long")

    place = monthly.withColumn("at", (F.col("year") * 12 + F.col("month")).cast("long"))
    # As many rows as the calendar has months.
    window = _whole("at")
    around = place.select(
        "month", "net", F.count("net").over(window.rangeBetween(-6, 6)).alias("n"),
        (F.sum("net").over(window.rangeBetween(-6, 5)) + F.sum("net").over(window.rangeBetween(-5, 6))).alias("twice"))
    ratio = whole(F.try_divide(F.col("net").cast("double") * 24, F.col("twice").cast("double")) * 1e9)
    by_month = around.where("n = 13").groupBy("month").agg(F.sum(ratio).alias("s"), F.count(ratio).alias("years"))
    mean = whole(F.col("s").cast("double") / F.col("years"))
    # Twelve rows.
    means = by_month.where("years > 0").select("month", "years", mean.alias("mean"))
    total = F.sum("mean").over(_whole()).cast("double")
    known = F.count("mean").over(_whole())
    return means.select("month", "years", (F.col("mean") / 1e9).alias("mean_ratio"),
                        (F.col("mean").cast("double") * known / total).alias("seasonal_factor")).orderBy("month")


def _at_stores(star: Star, stores: DataFrame) -> DataFrame:
    chosen = Star(fact=star.fact, customer=star.customer, product=star.product, location=stores, date=star.date,
                  rows=star.rows, _hot=star._hot)
    return chosen.join(star.fact, "location", [], "left_semi")


def store_access(star: Star, mapping: DataFrame, user: str) -> DataFrame:
    """The fact rows that ``user`` may see by the (user_name, location_id) mapping."""
    mine = mapping.where(F.col("user_name") == user).select("location_id")
    return _at_stores(star, star.location.join(mine, "location_id", "left_semi"))


def region_access(star: Star, user: str) -> DataFrame:
    """The fact rows of the region that bears the user's name."""
    return _at_stores(star, star.location.where(F.col("region") == user))
