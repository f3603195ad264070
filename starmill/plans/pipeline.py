"""The whole job: raw tables -> dimensions -> fact -> summary tables."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmill.operators import dimensions as dims
from starmill.operators.fact import ACCEPTED, KEYS, REJECTED, SALES_LINES, by_month, by_status, keyed_sales, measured
from starmill.operators.keys import allocate_keys
from starmill.operators.ledger import GENERATION, Ledger
from starmill.operators.sinks import (
    analyze_table, export_csv, one_per_key, quoted, read_or_empty, read_table, register_table, write_table)
from starmill.plans.checks import null_key_verdict
from starmill.plans.rules import DataQualityError
from starmill.plans.summaries import sync_summaries
from starmill.plans.warehouse import DIM_TABLES, SALES_FOLDER, TABLES, Star, open_star
from starmill.schemas import CURATED, DEFAULTS, NATURAL_KEYS, RAW, SORT_KEYS, SURROGATE_KEYS, TABLE_COMMENTS
from starmill.session import side_by_side
from starmill.sources.files import folder_report, missing_tables
from starmill.sources.raw import read_catalog, read_raw

log = logging.getLogger("starmill")


@dataclass
class PipelineResult:
    star: Star
    rows: dict[str, int] = field(default_factory=dict)
    rejected_sales: int = 0


def load_dimension(spark: SparkSession, cleaned: DataFrame, ids: DataFrame, table: str, target: str,
                   loaded_at: Column) -> int:
    """Give new members a key, then replace the stored dimension.  Returns its row count.

    ``ids`` holds the members' natural ids, repeated or not.
    """
    natural, surrogate = NATURAL_KEYS[table], SURROGATE_KEYS[table]
    map_path = f"{target}/keys/{table}"
    contract = StructType([f for f in CURATED[table] if f.name in (natural, surrogate)])
    known = read_or_empty(spark, map_path, contract)
    write_table(allocate_keys(ids, natural, surrogate, known).select(*contract.names), map_path, "append")
    keyed = dims.with_keys(cleaned, read_table(spark, map_path), table, loaded_at)
    return write_table(keyed, f"{target}/{table}", sort_by=SORT_KEYS[table])["rows"]


def load_dimensions(spark: SparkSession, raw: dict[str, DataFrame], target: str, as_of: Column, loaded_at: Column,
                    calendar_start: date, calendar_end: date) -> dict[str, int]:
    customers, locations = dims.clean_customers(raw["customers"], as_of), dims.clean_locations(raw["locations"])
    products = dims.clean_products(raw["products"])
    # Every customer and location id makes a member, so the raw id column is enough; products also need a price.
    cleaned = {
        "customer_dim": (customers, raw["customers"]),
        "product_dim": (products, products),
        "location_dim": (locations, raw["locations"]),
    }
    calendar = dims.build_date_dimension(spark, calendar_start, calendar_end, loaded_at).coalesce(1)
    loads = {t.removesuffix("_dim"): partial(load_dimension, spark, df, ids, t, target, loaded_at)
             for t, (df, ids) in cleaned.items()}
    loads["date"] = lambda: write_table(calendar, f"{target}/date_dim")["rows"]
    return side_by_side(spark, loads)


def load_fact(spark: SparkSession, raw_sales: DataFrame, target: str, loaded_at: Column, rows: dict[str, int],
              append: bool = False, reject_out_of_calendar: bool = True) -> dict:
    """Load the fact (replace, or append without replays) and quarantine what misses a key, in one job.

    The stored dimensions are read back, so each is computed once.  An append keeps one line per sale_id of a
    batch, an accepted one before a rejected one; lines without a sale_id cannot be told apart and all stay.  A ledger of the
    ids tells which are known and where the sale keys go on; the stored lines are not read.  Gives back the
    counts, the first and the highest sale key, and the months written.
    """
    stored = {d: read_table(spark, f"{target}/{d}_dim") for d in ("customer", "product", "location")}
    path = f"{target}/{SALES_FOLDER}"
    first, ledger = 0, None
    if append:
        ledger = Ledger(spark, path, "sale_id", ("status",), number="sale_key")
        ledger.ensure(read_or_empty(spark, path, SALES_LINES))
        first = ledger.top + 1
    lines = by_month(keyed_sales(raw_sales, stored, read_table(spark, f"{target}/date_dim"), first_key=first, dim_rows=rows,
                                 reject_out_of_calendar=reject_out_of_calendar))
    # Months are few: one value for each month of the calendar.
    seen = {"rejects": F.count("reject_reason"), "months": F.collect_set(F.when(F.col("status") == ACCEPTED, F.col("month_key")))}
    partitions, order = ["status", "month_key"], SORT_KEYS["sales_fact"]

    def whole(keyed: DataFrame) -> DataFrame:
        """All stored columns, made after the last shuffle: a month, 0 for rejects, has one status."""
        return by_status(measured(keyed.hint("rebalance", "month_key"), loaded_at))

    if ledger:
        once = one_per_key(lines, "sale_id", [(F.col("month_key") == 0).asc(), F.col("sale_key").asc()])
        new = ledger.unknown(once.withColumn("status", F.when(F.col("month_key") == 0, REJECTED).otherwise(ACCEPTED)), batch=raw_sales)
        written = ledger.append(whole(new), partitions, order, gathered=True, **seen)
    else:
        written = write_table(whole(lines), path, "overwrite", partitions, order, notes={GENERATION: uuid.uuid4().hex},
                              gathered=True, **seen, top=F.max("sale_key"))
    top = first - 1 if written["top"] is None else written["top"]
    return {"fact": written["rows"] - written["rejects"], "rejects": written["rejects"], "first_key": first, "top": top,
            "months": sorted(written["months"])}


def publish(spark: SparkSession, database: str, target: str) -> None:
    """Declare the stored tables in the catalog, with their comments, and collect statistics.

    The fact is a view on the accepted sales lines.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in DIM_TABLES.values():
        register_table(spark, f"{database}.{table}", f"{target}/{table}", CURATED[table], TABLE_COMMENTS[table], defaults=DEFAULTS)
        analyze_table(spark, f"{database}.{table}")
    register_table(spark, f"{database}.{SALES_FOLDER}", f"{target}/{SALES_FOLDER}", SALES_LINES,
                   "Sales lines; status tells fact rows from rejects", ["status", "month_key"])
    # Statistics of what queries join and filter on.
    analyze_table(spark, f"{database}.{SALES_FOLDER}", [*KEYS, "sale_key", "net_amount", "month_key"])
    for summary, partitions in (("mv_monthly_sales", ["year", "month"]), ("mv_customer_summary", [])):
        schema = read_table(spark, f"{target}/{summary}").schema
        register_table(spark, f"{database}.{summary}", f"{target}/{summary}", schema, TABLE_COMMENTS[summary], partitions)
        analyze_table(spark, f"{database}.{summary}")
    columns = ", ".join(f.name + (f" COMMENT {quoted(f.metadata['comment'])}" if f.metadata else "") for f in CURATED["sales_fact"])
    spark.sql(f"""CREATE OR REPLACE VIEW {database}.sales_fact ({columns}) COMMENT {quoted(TABLE_COMMENTS["sales_fact"])} AS
        SELECT {", ".join(CURATED["sales_fact"].names)} FROM {database}.{SALES_FOLDER} WHERE status = '{ACCEPTED}'""")


def require_folders(spark: SparkSession, root: str, folders: list[str]) -> None:
    """Stop unless every folder holds data."""
    lacking = [r["folder"] for r in folder_report(spark, root, folders).where("NOT passed").collect()]
    if lacking:
        raise DataQualityError(f"no data below {root} in {', '.join(sorted(lacking))}", lacking)


def run_gated(spark: SparkSession, source: str, target: str, **options) -> PipelineResult:
    """The daily run: raw files or catalog tables are there, build, stored tables are there, no key of the fact is missing."""
    if database := options.get("database"):
        if lacking := missing_tables(spark, database, list(RAW)):
            raise DataQualityError(f"no table {', '.join(lacking)} in {database}", lacking)
    else:
        require_folders(spark, source, list(RAW))
    result = run_pipeline(spark, source, target, **options)
    require_folders(spark, target, [*DIM_TABLES.values(), SALES_FOLDER])
    verdict = null_key_verdict(result.star.fact).first()
    if verdict["null_rows"]:
        raise DataQualityError(verdict["null_check"], [verdict])
    return result


def record_run(spark: SparkSession, target: str, job: str, state: str, started: datetime,
               completed: datetime | None) -> None:
    """One line in the run log that the job-health report reads."""
    row = [(job, state, started, completed)]
    run = spark.createDataFrame(row, "job_name string, state string, started_on timestamp, completed_on timestamp")
    run.coalesce(1).write.mode("append").parquet(f"{target}/run_log")


def read_sources(spark: SparkSession, source: str, fmt: str, database: str | None) -> dict[str, DataFrame]:
    """The four raw tables, from the catalog if a database is named, else from folders below ``source``."""
    if database:
        return {t: read_catalog(spark, database, t) for t in RAW}
    return {t: read_raw(spark, f"{source}/{t}", t, fmt, with_version=t in ("products", "locations")) for t in RAW}


def run_pipeline(spark: SparkSession, source: str, target: str, *, database: str | None = None,
                 as_of: date | None = None, calendar_start: date = dims.CALENDAR_START,
                 calendar_end: date = dims.CALENDAR_END, fmt: str = "csv", append: bool = False,
                 reject_out_of_calendar: bool = True, csv_export: str | None = None, publish_to: str | None = None,
                 job_name: str = "raw_to_curated") -> PipelineResult:
    """Read the four raw tables, build the star below ``target``, note the run.

    ``as_of`` is the run date that stands in for a missing creation date.
    ``publish_to`` names a catalog database in which the stored tables are declared and analyzed.
    """
    started = datetime.now(timezone.utc)
    run_date = F.lit(as_of or started.date())
    loaded_at = F.lit(started)
    state = "FAILED"
    try:
        raw = read_sources(spark, source, fmt, database)
        rows = load_dimensions(spark, raw, target, run_date, loaded_at, calendar_start, calendar_end)
        loaded = load_fact(spark, raw["sales"], target, loaded_at, rows, append, reject_out_of_calendar)
        star = open_star(spark, target, rows)
        sync_summaries(star, target, loaded)
        loaded = {n: loaded[n] for n in ("fact", "rejects")}
        if csv_export:
            for table in TABLES:
                export_csv(star.tables()[table], f"{csv_export}/{table}")
        if publish_to:
            publish(spark, publish_to, target)
        for table, n in {**rows, **loaded}.items():
            log.info("%s: %s rows", table, n)
        if loaded["rejects"]:
            log.warning("%s sales lines miss a dimension key or an amount", loaded["rejects"])
        state = "SUCCEEDED"
        return PipelineResult(star, {**rows, **loaded}, loaded["rejects"])
    except Exception:
        log.exception("%s failed", job_name)
        raise
    finally:
        record_run(spark, target, job_name, state, started, datetime.now(timezone.utc))
