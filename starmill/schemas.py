"""Contracts of the raw and the curated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
# Wide enough to compare any amount as it is written.
WIDE = T.DecimalType(38, 10)
AMOUNT = T.DecimalType(12, 2)


def _table(*columns: tuple) -> T.StructType:
    fields = []
    for name, kind, *rest in columns:
        nullable = "required" not in rest
        comment = next((r for r in rest if r != "required"), None)
        fields.append(T.StructField(name, kind, nullable, {"comment": comment} if comment else None))
    return T.StructType(fields)


_S, _B, _D, _TS = T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()
_I, _L, _H = T.IntegerType(), T.LongType(), T.ShortType()

RAW = {
    "customers": _table(
        ("customer_id", _S, "required"), ("first_name", _S, "required"), ("last_name", _S, "required"),
        ("email", _S, "required"), ("phone", _S), ("address", _S), ("city", _S), ("state", _S),
        ("zip_code", _S), ("country", _S), ("created_date", _D), ("is_active", _B),
    ),
    "products": _table(
        ("product_id", _S, "required"), ("product_name", _S, "required"), ("category", _S, "required"),
        ("subcategory", _S), ("brand", _S), ("unit_price", PRICE, "required"), ("cost", PRICE), ("is_active", _B),
    ),
    "locations": _table(
        ("location_id", _S, "required"), ("store_name", _S, "required"), ("address", _S), ("city", _S, "required"),
        ("state", _S, "required"), ("zip_code", _S), ("region", _S), ("country", _S, "required"),
    ),
    "sales": _table(
        ("sale_id", _S, "required"), ("customer_id", _S, "required"), ("product_id", _S, "required"),
        ("location_id", _S, "required"), ("sale_date", _D, "required"), ("quantity", _I, "required"),
        ("unit_price", PRICE, "required"), ("discount_amount", PRICE), ("tax_amount", PRICE),
    ),
}

CURATED = {
    "customer_dim": _table(
        ("customer_key", _L, "required", "Surrogate key"), ("customer_id", _S, "required", "Natural key, one row each"),
        ("full_name", _S), ("email", _S), ("phone", _S, "Digits only"), ("address", _S), ("city", _S), ("state", _S),
        ("zip_code", _S), ("country", _S), ("created_date", _D), ("is_active", _B), ("etl_inserted_date", _TS),
    ),
    "product_dim": _table(
        ("product_key", _L, "required", "Surrogate key"), ("product_id", _S, "required", "Natural key, one row each"),
        ("product_name", _S), ("category", _S), ("subcategory", _S), ("brand", _S), ("unit_price", PRICE),
        ("cost", PRICE), ("margin", T.DecimalType(5, 2), "Percent: (unit_price - cost) / unit_price * 100"),
        ("is_active", _B), ("etl_inserted_date", _TS),
    ),
    "location_dim": _table(
        ("location_key", _L, "required", "Surrogate key"), ("location_id", _S, "required", "Natural key, one row each"),
        ("store_name", _S), ("address", _S), ("city", _S), ("state", _S), ("zip_code", _S), ("region", _S),
        ("country", _S), ("etl_inserted_date", _TS),
    ),
    "date_dim": _table(
        ("date_key", _I, "required", "yyyyMMdd"), ("date_value", _D, "required"), ("year", _H), ("quarter", _H),
        ("month", _H), ("month_name", _S), ("day", _H), ("day_of_week", _H, "1 = Sunday"), ("day_name", _S),
        ("week_of_year", _H, "ISO week"), ("is_weekend", _B), ("fiscal_year", _H, "Starts in July"),
        ("etl_inserted_date", _TS),
    ),
    "sales_fact": _table(
        ("sale_key", _L, "required", "Surrogate key"), ("sale_id", _S, "Natural key of the sale line"),
        ("customer_key", _L, "required"), ("product_key", _L, "required"), ("location_key", _L, "required"),
        ("date_key", _I, "required"), ("quantity", _I, "required"), ("unit_price", PRICE, "required"),
        ("gross_amount", AMOUNT, "required", "quantity * unit_price"), ("discount_amount", PRICE),
        ("tax_amount", PRICE), ("net_amount", AMOUNT, "required", "gross - discount + tax"),
        ("etl_inserted_date", _TS), ("month_key", _I, "yyyyMM, storage partition"),
    ),
}

NATURAL_KEYS = {
    "customer_dim": "customer_id", "product_dim": "product_id", "location_dim": "location_id",
}
SURROGATE_KEYS = {
    "customer_dim": "customer_key", "product_dim": "product_key", "location_dim": "location_key",
}
# The sort keys that the tables declare.
SORT_KEYS = {
    "customer_dim": ["customer_id", "created_date"],
    "product_dim": ["category", "subcategory", "product_id"],
    "location_dim": ["region", "state", "city"],
    "date_dim": ["date_key"],
    "sales_fact": ["date_key", "customer_key"],
}
# The defaults that the tables declare.
DEFAULTS = {"is_active": "true", "etl_inserted_date": "current_timestamp()", "discount_amount": "0", "tax_amount": "0"}
TABLE_COMMENTS = {
    "customer_dim": "One row per customer; the latest version of each",
    "product_dim": "One row per product, by category and subcategory",
    "location_dim": "One row per store, by region, state and city",
    "date_dim": "One row per calendar day",
    "sales_fact": "One row per sale line",
    "mv_monthly_sales": "Sales by month, category, subcategory, region and state",
    "mv_customer_summary": "Purchases and lifetime value of every customer",
}


def text_schema(table: str) -> T.StructType:
    """The raw table as a text file delivers it: every column a string."""
    return T.StructType([T.StructField(f.name, _S) for f in RAW[table]])


def coerce(column: Column, kind: T.DataType) -> Column:
    """Convert without raising: a value that does not fit becomes null.

    A whole number may be written with decimals ("2.0"); a fraction is no whole number.
    """
    if isinstance(kind, T.DateType):
        return F.try_to_date(column.cast("string"))
    if isinstance(kind, T.IntegralType):
        number = column.try_cast(WIDE)
        return F.when(number == F.floor(number), number.try_cast(kind))
    return column.try_cast(kind)


def conform(df: DataFrame, contract: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the contract's columns and types, in order."""
    kinds = dict(df.dtypes)
    columns = [
        F.col(f.name) if kinds[f.name] == f.dataType.simpleString() else coerce(F.col(f.name), f.dataType).alias(f.name)
        for f in contract
    ]
    return df.select(*columns, *keep)
