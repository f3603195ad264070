"""The sales fact: typed sales lines with the keys of the four dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starmill.functions.calendar import date_key, month_key
from starmill.operators.joins import BROADCAST_ROWS, hot_keys, lookup_join
from starmill.operators.keys import number_rows
from starmill.schemas import CURATED, RAW, conform

DIMENSIONS = ("customer", "product", "location")
ACCEPTED, REJECTED = "accepted", "rejected"
REJECT_IDS = ("customer_id", "product_id", "location_id", "sale_date")
KEYS = ("customer_key", "product_key", "location_key", "date_key")
AMOUNTS = ("quantity", "unit_price", "gross_amount", "net_amount")

# The stored form of all sales lines: accepted ones are the fact.
SALES_LINES = StructType(
    [StructField(f.name, f.dataType) for f in CURATED["sales_fact"] if f.name != "month_key"]
    + [StructField(c, StringType()) for c in (*REJECT_IDS, "reject_reason", "status")]
    + [StructField("month_key", IntegerType())])


def resolve_sales(raw_sales: DataFrame, dims: dict[str, DataFrame], date_dim: DataFrame, loaded_at: Column, *,
                  first_key: int = 0, dim_rows: dict[str, int] | None = None,
                  reject_out_of_calendar: bool = True, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every sales line with its keys, measures and (where a key or an amount is missing) ``reject_reason``.

    ``raw_sales`` is a read of files.  The lookups are broadcast or salted by size.  With ``reject_out_of_calendar=False`` a
    date outside the calendar keeps its key, only an unreadable date is missing.
    """
    return measured(keyed_sales(raw_sales, dims, date_dim, first_key=first_key, dim_rows=dim_rows,
                                reject_out_of_calendar=reject_out_of_calendar, broadcast_rows=broadcast_rows), loaded_at)


def keyed_sales(raw_sales: DataFrame, dims: dict[str, DataFrame], date_dim: DataFrame, *, first_key: int = 0,
                dim_rows: dict[str, int] | None = None, reject_out_of_calendar: bool = True,
                broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every sales line as delivered, typed, with the keys it has: what ``measured`` needs and no more."""
    dim_rows = dict(dim_rows or {})
    for name in DIMENSIONS:
        if dim_rows.get(name) is None:
            dim_rows[name] = dims[name].count()
    large = [f"{name}_id" for name in DIMENSIONS if dim_rows[name] > broadcast_rows]
    hot = hot_keys(raw_sales, large) if large else {}

    sales = number_rows(raw_sales, "sale_key", first_key)
    sale_date_text = F.col("sale_date").cast("string").alias("_sale_date_text")
    sales = conform(sales.select("*", sale_date_text), RAW["sales"], keep=("sale_key", "_sale_date_text"))
    # The joins carry the date, and its text only where it is written otherwise.
    written = F.col("sale_date").cast("string")
    sales = sales.withColumn("_sale_date_text", F.when(~F.col("_sale_date_text").eqNullSafe(written), F.col("_sale_date_text")))
    for name in DIMENSIONS:
        key = f"{name}_id"
        sales = lookup_join(sales, dims[name].select(key, f"{name}_key"), key, "left", spread="sale_key",
                            right_rows=dim_rows[name], hot=hot.get(key), broadcast_rows=broadcast_rows)
    sales = sales.withColumn("date_key", date_key(F.col("sale_date")))
    if reject_out_of_calendar:
        known = date_dim.select("date_key", F.col("date_key").alias("_known_date"))
        sales = lookup_join(sales, known, "date_key", "left", spread="sale_key", right_rows=dim_rows.get("date"),
                            broadcast_rows=broadcast_rows).withColumn("date_key", F.col("_known_date"))
    return sales.select(
        "sale_key", "sale_id", "customer_id", "product_id", "location_id", F.coalesce("_sale_date_text", written).alias("sale_date"),
        *KEYS, "quantity", "unit_price", "discount_amount", "tax_amount")


def _amounts() -> dict[str, Column]:
    zero = F.lit(0).cast("decimal(10,2)")
    discount = F.coalesce("discount_amount", zero)
    tax = F.coalesce("tax_amount", zero)
    gross = F.col("quantity") * F.col("unit_price")
    return {"gross_amount": gross.try_cast("decimal(12,2)"), "discount_amount": discount, "tax_amount": tax,
            "net_amount": (gross - discount + tax).try_cast("decimal(12,2)")}


def _missing() -> Column:
    """Names of the keys and amounts that a keyed line lacks.

    An amount is missing if it is unreadable or does not fit its type; such a line would be lost to every sum.
    """
    found = {c: F.col(c) for c in (*KEYS, *AMOUNTS)} | {n: c for n, c in _amounts().items() if n in AMOUNTS}
    return F.nullif(F.concat_ws(",", *[F.when(c.isNull(), F.lit(n)) for n, c in found.items()]), F.lit(""))


def measured(keyed: DataFrame, loaded_at: Column) -> DataFrame:
    """Keyed lines with their amounts, the audit time and the reason why a line is rejected."""
    amounts = {n: c.alias(n) for n, c in _amounts().items()}
    return keyed.select(
        "sale_key", "sale_id", "customer_id", "product_id", "location_id", "sale_date", *KEYS, "quantity", "unit_price",
        *amounts.values(), loaded_at.alias("etl_inserted_date"), _missing().alias("reject_reason"))


def by_month(keyed: DataFrame) -> DataFrame:
    """Keyed lines with their storage month, 0 for rejects, and without the ids that only rejects are stored with.

    This is what shuffles carry before a write; the amounts follow from it.
    """
    bad = _missing().isNotNull()
    ids = {c: F.when(bad, F.col(c)) for c in REJECT_IDS}
    return keyed.withColumn("month_key", F.when(~bad, month_key(F.col("date_key"))).otherwise(F.lit(0))).withColumns(ids)


def accepted(resolved: DataFrame) -> DataFrame:
    """Fact rows: all four keys and the amounts present."""
    rows = resolved.where("reject_reason IS NULL").withColumn("month_key", month_key(F.col("date_key")))
    return conform(rows, CURATED["sales_fact"])


def rejected(resolved: DataFrame) -> DataFrame:
    """Sales lines that miss a key or an amount, with the names of what is missing."""
    return resolved.where("reject_reason IS NOT NULL")


def by_status(resolved: DataFrame) -> DataFrame:
    """Fact rows and rejects as one table, so that one job stores both.

    The ids are kept for rejects only; a fact row has the keys instead.
    """
    bad = F.col("reject_reason").isNotNull()
    ids = [F.when(bad, F.col(c)).alias(c) for c in REJECT_IDS]
    fact = [f.name for f in CURATED["sales_fact"] if f.name != "month_key"]
    month = F.when(~bad, month_key(F.col("date_key"))).otherwise(F.lit(0))
    return resolved.select(*fact, *ids, "reject_reason", F.when(bad, REJECTED).otherwise(ACCEPTED).alias("status"),
                           month.alias("month_key"))


def build_sales_fact(raw_sales: DataFrame, customer_dim: DataFrame, product_dim: DataFrame,
                     location_dim: DataFrame, date_dim: DataFrame, loaded_at: Column | None = None,
                     **options) -> DataFrame:
    dims = {"customer": customer_dim, "product": product_dim, "location": location_dim}
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    return accepted(resolve_sales(raw_sales, dims, date_dim, loaded_at, **options))
