"""Declarative column rules, evaluated as one aggregation per table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.schemas import CURATED, RAW, WIDE
from starmill.sources.raw import coercion_failure

# Id and e-mail formats, allowed regions, bounds.
CUSTOMER_ID = r"^CUST\d+$"
PRODUCT_ID = r"^PROD\d+$"
LOCATION_ID = r"^LOC\d+$"
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"
REGIONS = ("NORTH", "SOUTH", "EAST", "WEST", "CENTRAL")
PRICE_BELOW = 100_000
QUANTITY_BELOW = 10_000
QUANTITY_AT_MOST = 10_000


class DataQualityError(Exception):
    """Rules were broken; ``report`` lists them, ``cases`` is a DataFrame of the failing values."""

    def __init__(self, message: str, report: list, cases: DataFrame | None = None):
        super().__init__(message)
        self.report = report
        self.cases = cases


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where ``broken`` is true; null does not break it."""

    column: str
    name: str
    broken: Column


@dataclass(frozen=True)
class Unique:
    """No two rows share a value of the column; missing values do not count."""

    column: str
    name: str = "unique"


def required(column: str) -> Rule:
    return Rule(column, "not_null", F.col(column).isNull())


def matches(column: str, pattern: str) -> Rule:
    """The pattern's classes hold for letters and digits of every script."""
    return Rule(column, "pattern", ~F.col(column).rlike(f"(?U){pattern}"))


def length_between(column: str, low: int, high: int) -> Rule:
    return Rule(column, f"length_{low}_{high}", ~F.length(column).between(low, high))


def one_of(column: str, allowed) -> Rule:
    return Rule(column, "allowed_value", ~F.col(column).isin(*allowed))


def at_least(column: str, bound, kind=WIDE) -> Rule:
    return Rule(column, f"at_least_{bound}", F.col(column).try_cast(kind) < bound)


def more_than(column: str, bound, kind=WIDE) -> Rule:
    return Rule(column, f"more_than_{bound}", F.col(column).try_cast(kind) <= bound)


def less_than(column: str, bound, kind=WIDE) -> Rule:
    return Rule(column, f"less_than_{bound}", F.col(column).try_cast(kind) >= bound)


def at_most(column: str, bound, kind=WIDE) -> Rule:
    return Rule(column, f"at_most_{bound}", F.col(column).try_cast(kind) > bound)


def converts(table: str) -> list[Rule]:
    """Every column that is not text must convert to the contract's type."""
    return [Rule(f.name, "type", coercion_failure(table, f.name))
            for f in RAW[table] if not isinstance(f.dataType, T.StringType)]


def raw_rules(table: str, regions=REGIONS) -> list:
    not_null = [required(f.name) for f in RAW[table] if not f.nullable]
    specific = {
        "customers": lambda: [
            matches("customer_id", CUSTOMER_ID), length_between("first_name", 1, 100),
            length_between("last_name", 1, 100), matches("email", EMAIL), length_between("state", 2, 50),
            Unique("customer_id")],
        "products": lambda: [
            matches("product_id", PRODUCT_ID), length_between("product_name", 1, 255), at_least("unit_price", 0),
            less_than("unit_price", PRICE_BELOW), at_least("cost", 0), Unique("product_id")],
        "locations": lambda: [
            matches("location_id", LOCATION_ID), one_of("region", regions), Unique("location_id")],
        "sales": lambda: [
            matches("customer_id", CUSTOMER_ID), matches("product_id", PRODUCT_ID),
            matches("location_id", LOCATION_ID), more_than("quantity", 0), less_than("quantity", QUANTITY_BELOW),
            at_least("unit_price", 0), at_least("discount_amount", 0), at_least("tax_amount", 0)],
    }
    return [*not_null, *converts(table), *specific[table]()]


def curated_rules(table: str) -> list:
    """Rules of the curated tables: what the load must deliver."""
    if table == "customer_dim":
        return [required("customer_key"), at_least("customer_key", 0), Unique("customer_key"),
                required("customer_id"), Unique("customer_id"), matches("email", EMAIL)]
    if table == "sales_fact":
        return [*[required(c) for c in ("sale_key", "customer_key", "product_key", "location_key", "date_key",
                                        "quantity", "gross_amount", "net_amount")],
                at_least("sale_key", 0), Unique("sale_key"), more_than("quantity", 0),
                at_least("gross_amount", 0), at_least("net_amount", 0)]
    return []


def constraints(table: str) -> list:
    """NOT NULL and CHECK constraints of the stored tables."""
    checks = {
        "product_dim": lambda: [
            at_least("unit_price", 0), at_least("cost", 0),
            # A margin beyond the stored type is kept as null.
            Rule("margin", "fits_type", (F.col("unit_price") > 0) & F.col("cost").isNotNull() & F.col("margin").isNull())],
        "date_dim": lambda: [
            Rule("quarter", "between_1_4", ~F.col("quarter").between(1, 4)),
            Rule("month", "between_1_12", ~F.col("month").between(1, 12)),
            Rule("day", "between_1_31", ~F.col("day").between(1, 31)),
            Rule("day_of_week", "between_1_7", ~F.col("day_of_week").between(1, 7))],
        "sales_fact": lambda: [more_than("quantity", 0), at_least("gross_amount", 0), at_least("net_amount", 0)],
    }
    not_null = [required(f.name) for f in CURATED[table] if not f.nullable]
    return [*not_null, *checks.get(table, lambda: [])()]


def repeated_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values of ``columns`` that occur more than once, with their number of rows."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def duplicate_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: table_name, column_name, repeated values, rows beyond the first of each.

    One scan and one shuffle for all columns: (column, value) pairs are folded up before they move.
    """
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])))
    repeated = repeated_values(pairs.where("value IS NOT NULL"), ["column_name", "value"]).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("duplicate_values"), F.sum(F.col("rows") - 1).cast("long").alias("surplus_rows"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return every.join(F.broadcast(repeated), "column_name", "left").select(  # a row for each column
        F.lit(table).alias("table_name"), "column_name", F.coalesce("duplicate_values", F.lit(0)).alias("duplicate_values"),
        F.coalesce("surplus_rows", F.lit(0)).alias("surplus_rows"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def long_form(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    """Turn the columns of a one-row aggregate into one row per entry (a struct)."""
    return one_row.select(F.inline(F.array(*entries)))


def rule_report(df: DataFrame, rules: list, table: str) -> DataFrame:
    """table_name, column_name, rule, violations, passed: all row rules in one pass, uniqueness in one more."""
    row_rules = [r for r in rules if isinstance(r, Rule)]
    counts = df.agg(*[F.count_if(r.broken).alias(f"r{i}") for i, r in enumerate(row_rules)])
    reports = [long_form(counts, [
        F.struct(F.lit(table).alias("table_name"), F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"),
                 F.col(f"r{i}").alias("violations")) for i, r in enumerate(row_rules)])] if row_rules else []
    if unique := [r for r in rules if isinstance(r, Unique)]:
        reports.append(duplicate_counts(df, table, [r.column for r in unique]).select(
            "table_name", "column_name", F.lit(unique[0].name).alias("rule"), F.col("duplicate_values").alias("violations")))
    return union_all(reports).withColumn("passed", F.col("violations") == 0)


def failure_cases(df: DataFrame, rules: list, table: str, row_id: str) -> DataFrame:
    """One row per broken row rule: table_name, row_id, column_name, rule, failing value."""
    cases = F.array_compact(F.array(*[
        F.when(r.broken, F.struct(F.lit(r.column).alias("column_name"), F.lit(r.name).alias("rule"),
                                  F.col(r.column).cast("string").alias("value")))
        for r in rules if isinstance(r, Rule)]))
    return df.select(F.lit(table).alias("table_name"), F.col(row_id).alias("row_id"), F.inline(cases))


def validate(df: DataFrame, rules: list, table: str, row_id: str, sample: int = 5) -> bool:
    """Evaluate all rules, then raise with the broken ones and a few failing values, or return True."""
    broken = rule_report(df, rules, table).where("NOT passed").collect()
    if not broken:
        return True
    cases = failure_cases(df, rules, table, row_id)
    lines = [f"{r.table_name}.{r.column_name} {r.rule}: {r.violations}" for r in broken]
    shown = [str(r.asDict()) for r in cases.limit(sample).collect()]
    raise DataQualityError(f"{table} breaks {len(broken)} rules\n" + "\n".join(lines + shown), broken, cases)


def validate_raw_data(df: DataFrame, table: str, regions=REGIONS) -> bool:
    first = RAW[table].names[0]
    return validate(df, raw_rules(table, regions), table, first)


def validate_curated_data(df: DataFrame, table: str) -> bool:
    return validate(df, curated_rules(table), table, CURATED[table].names[0])


# The suite that is run on the fact, as (expectation, column, arguments).
FACT_SUITE = [
    ("column_exists", "customer_key", {}),
    ("column_exists", "product_key", {}),
    ("column_exists", "net_amount", {}),
    ("not_null", "customer_key", {}),
    ("not_null", "product_key", {}),
    ("not_null", "date_key", {}),
    ("between", "quantity", {"low": 1, "high": QUANTITY_AT_MOST}),
    ("between", "net_amount", {"low": 0}),
    ("unique", "sale_key", {}),
    ("row_count_at_least", None, {"low": 1}),
]


def run_suite(df: DataFrame, suite: list = FACT_SUITE) -> DataFrame:
    """expectation, column_name, unexpected (rows, or 1 for a failed table-level one), success."""
    measured, entries, extra = [], [], []
    for i, (kind, column, args) in enumerate(suite):
        name = f"e{i}"
        present = column is None or column in df.columns
        if kind == "column_exists" or not present:
            measured.append(F.lit(0 if present else 1).cast("long").alias(name))
        elif kind == "not_null":
            measured.append(F.count_if(F.col(column).isNull()).alias(name))
        elif kind == "between":
            outside = F.lit(False)
            if args.get("low") is not None:
                outside = outside | (F.col(column) < args["low"])
            if args.get("high") is not None:
                outside = outside | (F.col(column) > args["high"])
            measured.append(F.count_if(outside).alias(name))
        elif kind == "row_count_at_least":
            measured.append(F.when(F.count(F.lit(1)) >= args["low"], 0).otherwise(1).cast("long").alias(name))
        elif kind == "unique":
            extra.append(repeated_values(df.where(F.col(column).isNotNull()), [column]).agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("unexpected"))
                         .select(F.lit(i).alias("position"), F.lit(kind).alias("expectation"),
                                 F.lit(column).alias("column_name"), "unexpected"))
            continue
        else:
            raise ValueError(f"unknown expectation {kind}")
        entries.append(F.struct(F.lit(i).alias("position"), F.lit(kind).alias("expectation"),
                                F.lit(column).cast("string").alias("column_name"), F.col(name).alias("unexpected")))
    rows = union_all([long_form(df.agg(*measured), entries), *extra])
    return rows.withColumn("success", F.col("unexpected") == 0)


def suite_passed(df: DataFrame, suite: list = FACT_SUITE) -> bool:
    return run_suite(df, suite).agg(F.bool_and("success")).first()[0]
