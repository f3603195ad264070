"""Every job and query of the package over the driver's tables, by name.

A query gets the session and the folder of the tables.  The tables are first
stored once as raw tables, and from these as the star; both are kept for the
session, in the shared work folder.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.operators import dimensions as dims
from starmill.operators import compaction, sinks
from starmill.operators.fact import accepted, rejected, resolve_sales
from starmill.operators.keys import allocate_keys
from starmill.operators.ledger import append_new
from starmill.plans import aggregates as agg
from starmill.plans import changes, checks, health, lattice, rules, summaries
from starmill.plans import dashboards as dash
from starmill.plans.lattice import Request, Shape
from starmill.plans.pipeline import load_fact, publish, run_pipeline
from starmill.plans.warehouse import DIM_TABLES, SALES_FOLDER, TABLES, Star, open_star, read_rejects, read_sales_lines
from starmill.schemas import CURATED, NATURAL_KEYS, RAW, SORT_KEYS, SURROGATE_KEYS
from starmill.session import side_by_side, work_folder
from starmill.sources import files, raw, testdata
from starmill.streaming import sales_stream

# The driver's orders lie in these years.
CALENDAR = (date(1995, 1, 1), date(2001, 12, 31))
RUN_DATE = date(2001, 12, 31)
AS_OF = date(2001, 6, 30)
LATEST_MONTH = date(2001, 7, 31)
NOW = "2024-01-30 12:00:00"
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SLICE = {"start": date(1997, 3, 5), "end": date(1999, 7, 9), "brands": ["Brand#2", "Brand#3", "Brand#5", "Brand#7"]}
KPIS = ("total_sales", "total_transactions", "avg_transaction_value", "unique_customers", "total_discount", "discount_rate")
# From fine to coarse; each is built from one before it where it can be.
SHAPES = [
    Shape("day_brand_state", ("date_key", "brand", "category", "region", "state"), sets=True),
    Shape("month_brand_state", ("month_key", "brand", "category", "region", "state"), sets=True),
    Shape("state", ("region", "state"), sets=True),
    Shape("day_store", ("date_key", "location_key")),
]
_SLICED = Request(KPIS, ("region", "category"), {"brand": SLICE["brands"]}, SLICE["start"], SLICE["end"])


class Workspace:
    """Raw tables and star of one folder of driver tables, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = f"{work_folder(spark)}/{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}-{uuid.uuid4().hex[:8]}"

    def new_folder(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, name: str) -> DataFrame:
        return testdata.table(self.spark, self.sf_dir, name)

    @cached_property
    def landing(self) -> str:
        def store(name):
            sinks.write_table(testdata.RAW_BUILDERS[name](self.spark, self.sf_dir), f"{self.root}/raw/{name}", in_place=True)

        side_by_side(self.spark, {name: partial(store, name) for name in testdata.RAW_BUILDERS})
        return f"{self.root}/raw"

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {t: raw.read_raw(self.spark, f"{self.landing}/{t}", t, "parquet") for t in RAW}

    @cached_property
    def star(self) -> Star:
        return run_pipeline(self.spark, self.landing, self.warehouse, as_of=RUN_DATE, calendar_start=CALENDAR[0],
                            calendar_end=CALENDAR[1], fmt="parquet").star

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"

    @cached_property
    def lattice(self) -> lattice.Lattice:
        lattice.sync_lattice(self.star, self.warehouse, SHAPES)
        return lattice.open_lattice(self.star, self.warehouse, SHAPES)

    def stored(self, name: str) -> DataFrame:
        self.star
        return sinks.read_table(self.spark, f"{self.warehouse}/{name}")

    @property
    def rejects(self) -> DataFrame:
        self.star
        return read_rejects(self.spark, self.warehouse)

    @property
    def all_lines(self) -> DataFrame:
        """Fact rows and rejects, with the keys they have."""
        self.star
        return read_sales_lines(self.spark, self.warehouse)


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, sf_dir)
    return _workspaces[key]


def plain(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike: decimals as doubles, dates and times as text."""
    columns = []
    for f in df.schema:
        kind = f.dataType
        if isinstance(kind, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(kind, T.DateType):
            columns.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            columns.append(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(columns)


QUERIES: dict[str, Callable[[Workspace], DataFrame]] = {}


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop("etl_inserted_date", "month_key")


def _as_text(tables: dict[str, DataFrame]) -> DataFrame:
    """All rows of several tables: the table's name, and the columns joined by bars."""
    parts = []
    for name, df in tables.items():
        df = df.select([c for c in CURATED[name].names if c not in ("etl_inserted_date", "month_key", "sale_key")])
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
        parts.append(df.select(F.lit(name).alias("table_name"), text.alias("row_text")))
    return rules.union_all(parts)


# --- sources -----------------------------------------------------------------


@query
def scan_raw_tables(w: Workspace) -> DataFrame:
    """Rows and present ids of the four raw tables, read under their contracts."""
    return rules.union_all([
        df.agg(F.count(F.lit(1)).alias("row_count"), F.count(df.columns[0]).alias("id_count"))
        .select(F.lit(t).alias("table_name"), "row_count", "id_count") for t, df in w.raw.items()])


@query
def schema_drift(w: Workspace) -> DataFrame:
    """The contracts against the schemas found in text files of all raw tables, which are read whole."""
    root = w.new_folder("csv_raw")

    def found(table: str, df: DataFrame) -> DataFrame:
        sinks.export_csv(df, f"{root}/{table}")
        return raw.schema_drift(w.spark, f"{root}/{table}", table)

    return rules.union_all(list(side_by_side(w.spark, {t: partial(found, t, df) for t, df in w.raw.items()}).values()))


@query
def bulk_load_with_error_budget(w: Workspace) -> DataFrame:
    """The five stored tables and the raw sales as text, loaded under their typed contracts; bad lines go to the quarantine.

    The fact is appended in two loads; its report adds them up.
    """
    root = w.new_folder("bulk")
    total = w.raw["sales"].count()

    def load(table: str, df: DataFrame, contract, part: str = "all", max_errors: int = 0) -> dict:
        sinks.export_csv(df, f"{root}/csv/{table}-{part}")
        return raw.bulk_load(w.spark, f"{root}/csv/{table}-{part}", table, contract, f"{root}/loaded/{table}", f"{root}/quarantine",
                             F.current_timestamp(), max_errors, append=part != "all")

    tables = w.star.tables()
    fact, early = tables.pop("sales_fact"), F.col("month_key") <= 199912
    jobs = {t: partial(load, t, df, CURATED[t]) for t, df in tables.items()}
    jobs["sales"] = partial(load, "sales", w.raw["sales"], RAW["sales"], max_errors=total // 20)
    reports = list(side_by_side(w.spark, jobs).values())
    reports += [load("sales_fact", fact.where(c), CURATED["sales_fact"], part) for part, c in (("early", early), ("late", ~early))]
    counts = ["rows_read", "rows_loaded", "rows_rejected"]
    schema = "table_name string, rows_read long, rows_loaded long, rows_rejected long"
    stored = sinks.read_table(w.spark, f"{root}/loaded/sales_fact").count()
    if stored != sum(r["rows_loaded"] for r in reports if r["table_name"] == "sales_fact"):
        raise raw.LoadError(f"the appended fact holds {stored} rows")
    return w.spark.createDataFrame(reports, schema).groupBy("table_name").agg(*[F.sum(c).alias(c) for c in counts])


@query
def recent_load_errors(w: Workspace) -> DataFrame:
    """Error events of the hour before a given time, newest first."""
    errors = w.table("events").where("event_type = 'error'").select("event_id", "ts", "user_id", "value")
    return health.recent_errors(errors, "ts", F.lit(NOW).cast("timestamp_ntz"))


@query
def input_gate(w: Workspace) -> DataFrame:
    """Raw and curated folders: present and not empty."""
    w.star
    landing = files.folder_report(w.spark, w.landing, list(RAW)).withColumn("stage", F.lit("raw"))
    curated = files.folder_report(w.spark, w.warehouse, [*TABLES[:4], SALES_FOLDER]).withColumn("stage", F.lit("curated"))
    return landing.unionByName(curated).select("stage", "folder", "present", "passed")


# --- build -------------------------------------------------------------------


def _keyed(w: Workspace, table: str) -> DataFrame:
    source = {"customer_dim": "customers", "product_dim": "products", "location_dim": "locations"}[table]
    df = w.raw[source]
    cleaned = {"customer_dim": lambda: dims.clean_customers(df, F.lit(RUN_DATE)),
               "product_dim": lambda: dims.clean_products(df),
               "location_dim": lambda: dims.clean_locations(df)}[table]()
    ids = cleaned if table == "product_dim" else df
    keys = allocate_keys(ids, NATURAL_KEYS[table], SURROGATE_KEYS[table])
    return _no_audit(dims.with_keys(cleaned, keys, table, F.current_timestamp()))


@query
def customer_dim(w: Workspace) -> DataFrame:
    return _keyed(w, "customer_dim")


@query
def product_dim(w: Workspace) -> DataFrame:
    return _keyed(w, "product_dim")


@query
def location_dim(w: Workspace) -> DataFrame:
    return _keyed(w, "location_dim")


@query
def date_dim(w: Workspace) -> DataFrame:
    """The calendar of the years in which there are orders."""
    span = w.table("orders").agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")).first()
    calendar = dims.build_date_dimension(w.spark, date(span["lo"], 1, 1), date(span["hi"], 12, 31))
    return _no_audit(calendar)


def _resolved(w: Workspace) -> DataFrame:
    lookups = {"customer": w.star.customer, "product": w.star.product, "location": w.star.location}
    return resolve_sales(w.raw["sales"], lookups, w.star.date, F.current_timestamp(), dim_rows=w.star.rows)


@query
def sales_fact(w: Workspace) -> DataFrame:
    return _no_audit(accepted(_resolved(w))).drop("sale_key")


@query
def sales_fact_rejects(w: Workspace) -> DataFrame:
    return rejected(_resolved(w)).select("sale_id", "customer_id", "product_id", "location_id", "sale_date", "reject_reason")


@query
def surrogate_key_map(w: Workspace) -> DataFrame:
    """Keys of all customers in two loads: those with odd account balances join in the second."""
    ids = w.table("customer").select(
        F.concat(F.lit("CUST"), "c_custkey").alias("customer_id"),
        (F.col("c_acctbal") < 0).alias("late"))
    path = w.new_folder("key_map")
    first = allocate_keys(ids.where("NOT late"), "customer_id", "customer_key")
    sinks.write_table(first, path)
    known = sinks.read_table(w.spark, path)
    return known.unionByName(allocate_keys(ids, "customer_id", "customer_key", known))


@query
def sales_enriched(w: Workspace) -> DataFrame:
    return agg.sales_enriched(w.star).drop("sale_key", "month_key")


# --- sinks -------------------------------------------------------------------


@query
def curated_roundtrip(w: Workspace) -> DataFrame:
    """The five stored tables, exported as delimited text and read back under their contracts."""
    root = w.new_folder("curated_csv")

    def back(table: str, df: DataFrame) -> DataFrame:
        sinks.export_csv(df, f"{root}/{table}", compression="gzip")
        return w.spark.read.schema(CURATED[table]).option("header", True).option("escape", '"').csv(f"{root}/{table}")

    return _as_text(side_by_side(w.spark, {t: partial(back, t, df) for t, df in w.star.tables().items()}))


@query
def load_replace(w: Workspace) -> DataFrame:
    """The four dimensions loaded twice by replacement: still one row per member."""
    root = w.new_folder("replaced")

    def load(table: str, df: DataFrame) -> DataFrame:
        for _ in range(2):
            sinks.write_table(df, f"{root}/{table}", sort_by=SORT_KEYS[table])
        return sinks.read_table(w.spark, f"{root}/{table}")

    return _as_text({t: load(t, df) for t, df in w.star.tables().items() if t != "sales_fact"})


@query
def load_append_idempotent(w: Workspace) -> DataFrame:
    """The fact appended in two overlapping batches, the second one twice and with repeated lines; totals per month."""
    path = w.new_folder("fact_append")
    fact = w.star.fact
    early = fact.where(F.col("month_key") <= 199912)
    for batch in (early, fact.unionByName(fact.where("product_key % 5 = 0")), fact):
        append_new(batch, path, "sale_id", ["month_key"])
    return sinks.read_table(w.spark, path).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("net_amount").alias("net_amount"))


@query
def mv_monthly_sales(w: Workspace) -> DataFrame:
    return agg.monthly_sales(w.star)


@query
def mv_customer_summary(w: Workspace) -> DataFrame:
    return agg.customer_summary(w.star)


@query
def mv_refresh_incremental(w: Workspace) -> DataFrame:
    """The monthly summary's sums and sets of the sales to mid 2001, and those of a later batch, added up: no sale is read twice."""
    folder = w.new_folder("mv_monthly_state")
    cut = F.col("date_key") <= 20010615
    for number, part in enumerate((cut, ~cut)):
        state = summaries.monthly_state(w.star, w.star.fact.where(part))
        sinks.write_table(state, f"{folder}/from={number}", partition_by=["year", "month"])
    return summaries.monthly_view(summaries.read_state(w.spark, folder).drop("from"))


@query
def mv_after_failed_append(w: Workspace) -> DataFrame:
    """The stored monthly summary after two appends of which the second died before the summaries and was repeated."""
    target, loaded_at = w.new_folder("failed_append"), F.lit(NOW).cast("timestamp")
    for dim, table in DIM_TABLES.items():
        sinks.write_table(getattr(w.star, dim), f"{target}/{table}")
    sales, late = w.raw["sales"], F.pmod(F.xxhash64("sale_id"), F.lit(2)) == 1
    for batch, dies in ((sales.where(~late), False), (sales.where(late), True), (sales.where(late), False)):
        load = load_fact(w.spark, batch, target, loaded_at, w.star.rows, append=True)
        if not dies:
            summaries.sync_summaries(open_star(w.spark, target, w.star.rows), target, load)
    return sinks.read_table(w.spark, f"{target}/mv_monthly_sales")


@query
def mv_customer_merge(w: Workspace) -> DataFrame:
    """The customer summary of the sales to mid 2001, then brought up to date from a later batch alone."""
    path = w.new_folder("mv_customers")
    cut = F.col("date_key") <= 20010615
    sinks.write_table(agg.customer_summary(w.star, w.star.fact.where(cut)), path)
    return agg.merge_customer_summary(w.star, sinks.read_table(w.spark, path), w.star.fact.where(~cut))


@query
def catalog_statistics(w: Workspace) -> DataFrame:
    """Rows of the tables that are published in the catalog."""
    database = f"published_{uuid.uuid4().hex[:8]}"
    w.star
    publish(w.spark, database, w.warehouse)
    return checks.catalog_statistics(w.spark, database).drop("schema_name")


@query
def compact_sorted(w: Workspace) -> DataFrame:
    """The five stored tables rewritten in files sorted by their declared keys."""
    root = w.new_folder("sorted")

    def compact(table: str, df: DataFrame) -> DataFrame:
        sinks.compact_sorted(df, f"{root}/{table}", SORT_KEYS[table])
        return sinks.read_table(w.spark, f"{root}/{table}")

    return _as_text({t: compact(t, df) for t, df in w.star.tables().items()})


@query
def compact_small_files(w: Workspace) -> DataFrame:
    """The fact loaded in five parts, its small files then merged month by month; totals per month."""
    path, part = w.new_folder("small_files"), F.pmod(F.xxhash64("sale_id"), F.lit(5))
    for i in range(5):
        sinks.write_table(w.star.fact.where(part == i), path, "append", ["month_key"], gathered=True)
    compaction.compact_small_files(w.spark, path, ["month_key"], SORT_KEYS["sales_fact"])
    return sinks.read_table(w.spark, path).groupBy("month_key").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("net_amount").alias("net_amount"))


# --- analytics ---------------------------------------------------------------

for _build in (agg.monthly_trend, agg.top_products, agg.top_products_per_category,
               agg.regional_performance, agg.weekend_vs_weekday, agg.category_by_month,
               dash.kpi_summary, dash.yoy_growth, dash.top10_products_total, dash.sales_ma30,
               dash.kpi_mom, dash.product_matrix_rollup, dash.price_vs_volume, dash.category_waterfall,
               dash.store_performance, dash.top_stores, dash.regional_trend, dash.calendar_rollup,
               dash.fiscal_year_sales, dash.seasonality_index, dash.seasonal_factors,
               checks.table_row_counts, checks.table_counts_wide, checks.constraint_report, checks.calendar_validity):
    QUERIES[_build.__name__] = lambda w, build=_build: build(w.star)


for _build in (agg.top_customers, dash.customer_ltv, dash.purchase_frequency_hist):
    QUERIES[_build.__name__] = lambda w, build=_build: build(w.star, summary=w.stored("mv_customer_summary"))


@query
def top20_customers(w: Workspace) -> DataFrame:
    return agg.top_customers(w.star, 20, w.stored("mv_customer_summary"))


@query
def customer_segments(w: Workspace) -> DataFrame:
    return dash.customer_segments(w.star, w.stored("mv_customer_summary"))


@query
def customer_segment_summary(w: Workspace) -> DataFrame:
    return dash.customer_segment_summary(w.star, w.stored("mv_customer_summary"))


@query
def yoy_growth_daily(w: Workspace) -> DataFrame:
    return dash.yoy_growth(w.star, "day")


@query
def trend_last_12m(w: Workspace) -> DataFrame:
    return dash.trend_last_12m(w.star, LATEST_MONTH)


@query
def sales_by_category(w: Workspace) -> DataFrame:
    return dash.sales_by(w.star, "product", "category")


@query
def sales_by_state(w: Workspace) -> DataFrame:
    return dash.sales_by(w.star, "location", "state")


@query
def rfm(w: Workspace) -> DataFrame:
    return dash.rfm(w.star, RUN_DATE, w.stored("mv_customer_summary"))


@query
def sliced_sales(w: Workspace) -> DataFrame:
    return dash.sliced_kpis(w.star, ["region", "category"], **SLICE)


@query
def sliced_sales_from_lattice(w: Workspace) -> DataFrame:
    """``sliced_sales`` from stored group-bys: whole months from the monthly one, the days at both ends from the daily one."""
    return w.lattice.answer(_SLICED)


@query
def kpi_summary_from_lattice(w: Workspace) -> DataFrame:
    return w.lattice.answer(Request(KPIS))


@query
def regional_performance_from_lattice(w: Workspace) -> DataFrame:
    found = w.lattice.answer(Request(("unique_customers", "total_transactions", "total_sales"), ("region", "state")))
    return found.withColumnRenamed("total_transactions", "transactions")


@query
def regional_trend_from_lattice(w: Workspace) -> DataFrame:
    return w.lattice.answer(Request(("total_sales",), ("region", "year", "month")))


@query
def fiscal_year_sales_from_lattice(w: Workspace) -> DataFrame:
    found = w.lattice.answer(Request(("total_sales", "total_transactions"), ("fiscal_year",)))
    return found.withColumnRenamed("total_transactions", "transactions")


@query
def lattice_after_failed_append(w: Workspace) -> DataFrame:
    """``sliced_sales`` from group-bys kept over two appends, of which the second died before them and was repeated."""
    target, loaded_at = w.new_folder("lattice_append"), F.lit(NOW).cast("timestamp")
    for dim, table in DIM_TABLES.items():
        sinks.write_table(getattr(w.star, dim), f"{target}/{table}")
    sales, late = w.raw["sales"], F.pmod(F.xxhash64("sale_id"), F.lit(2)) == 1
    for batch, dies in ((sales.where(~late), False), (sales.where(late), True), (sales.where(late), False)):
        load = load_fact(w.spark, batch, target, loaded_at, w.star.rows, append=True)
        star = open_star(w.spark, target, w.star.rows)
        if not dies:
            lattice.sync_lattice(star, target, SHAPES[:2], load)
    return lattice.open_lattice(star, target, SHAPES[:2], load).answer(_SLICED)


@query
def rls_store_filter(w: Workspace) -> DataFrame:
    """Sales per store that one store manager may see; the stores are dealt out to managers by nation."""
    mapping = w.star.location.select(F.lower(F.regexp_replace("state", "NATION_", "manager_")).alias("user_name"), "location_id")
    seen = dash.store_access(w.star, mapping, "manager_7").groupBy("location_key").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("net_amount").alias("net_amount"))
    return w.star.join(seen, "location", ["location_id"], grouped=True).drop("location_key")


@query
def rls_region_filter(w: Workspace) -> DataFrame:
    """Totals of the region that a regional manager may see."""
    return dash.region_access(w.star, "ASIA").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("net_amount").alias("net_amount"))


# --- quality and health ------------------------------------------------------


@query
def orphan_checks(w: Workspace) -> DataFrame:
    """Over all sales lines, the rejected ones included."""
    return checks.orphan_checks(w.all_lines, w.star)


@query
def cross_table_ri(w: Workspace) -> DataFrame:
    return checks.cross_table_integrity(w.raw)


@query
def null_key_profile(w: Workspace) -> DataFrame:
    return checks.null_key_profile(w.all_lines)


@query
def null_key_verdict(w: Workspace) -> DataFrame:
    return checks.null_key_verdict(w.all_lines)


@query
def anomaly_counts(w: Workspace) -> DataFrame:
    return checks.anomaly_counts(w.star.fact)


@query
def raw_rule_report(w: Workspace) -> DataFrame:
    return checks.raw_rule_report(w.raw, REGIONS)


@query
def curated_rule_report(w: Workspace) -> DataFrame:
    return rules.union_all([rules.rule_report(w.star.tables()[t], rules.curated_rules(t), t)
                            for t in ("customer_dim", "sales_fact")])


@query
def duplicate_keys(w: Workspace) -> DataFrame:
    return checks.duplicate_keys(w.raw, w.star)


@query
def failure_cases(w: Workspace) -> DataFrame:
    return rules.union_all([rules.failure_cases(df, rules.raw_rules(t, REGIONS), t, RAW[t].names[0])
                            for t, df in w.raw.items()])


@query
def expectation_suite(w: Workspace) -> DataFrame:
    return rules.run_suite(w.star.fact)


@query
def business_rule_check(w: Workspace) -> DataFrame:
    return checks.business_rules(w.star)


@query
def negative_values(w: Workspace) -> DataFrame:
    return checks.negative_values(w.star.fact)


@query
def future_dates(w: Workspace) -> DataFrame:
    return checks.future_dates(w.star, AS_OF)


@query
def quality_verdict(w: Workspace) -> DataFrame:
    return checks.quality_verdict(w.all_lines, w.star, AS_OF)


@query
def data_freshness(w: Workspace) -> DataFrame:
    """Age of the newest event, by type of event."""
    return health.data_freshness(w.table("events"), "ts", F.lit(NOW).cast("timestamp_ntz"), 24, "event_type")


@query
def job_health(w: Workspace) -> DataFrame:
    """The events as a run log: the user is the job, an error is a failed run, a signup an unfinished one."""
    kind = F.col("event_type")
    state = F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").otherwise("SUCCEEDED")
    log = w.table("events").select(
        F.col("user_id").alias("job_name"), F.col("event_id").alias("run_id"), state.alias("state"),
        F.col("ts").alias("started_on"), F.when(kind != "signup", F.col("value").cast("decimal(18,2)")).alias("minutes"))
    return health.job_health(log)


@query
def column_profile(w: Workspace) -> DataFrame:
    """All columns of the five stored tables, but the load time, the storage month and the running number of a sale."""
    return rules.union_all([checks.column_profile(_no_audit(df).drop("sale_key"), t) for t, df in w.star.tables().items()])


# --- change data and streams -------------------------------------------------


@query
def cdc_merge(w: Workspace) -> DataFrame:
    """The orders' customers as a change feed: each order is a change of the customer's last order; some lack the flag."""
    stored = w.table("customer").select("c_custkey", F.col("c_mktsegment").alias("last_order"))
    feed = w.table("orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("last_order"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus") == "P").alias("deleted"), F.col("o_orderkey").alias("version"))
    return changes.merge_changes(stored, feed, "c_custkey", "version", "deleted")


@query
def scd2_customer(w: Workspace) -> DataFrame:
    """History of each customer's order priority, one version per day."""
    versions = w.table("orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    return changes.customer_history(versions, "o_custkey", "day", ["o_orderpriority"])


@query
def cdc_merge_buckets(w: Workspace) -> DataFrame:
    """``cdc_merge`` on a table in buckets, as two feeds: the older half of the orders, then the newer one, which comes twice."""
    path = w.new_folder("customers-in-buckets")
    changes.create_buckets(w.table("customer").select("c_custkey", F.col("c_mktsegment").alias("last_order")), path, "c_custkey", 64)
    feed = w.table("orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("last_order"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus") == "P").alias("deleted"), F.col("o_orderkey").alias("version"))
    half = w.table("orders").agg(F.avg("o_orderkey")).first()[0] or 0.0
    newer = feed.where(F.col("version") > half)
    for part in (feed.where(F.col("version") <= half), newer, newer):
        changes.merge_into_buckets(w.spark, path, part, "version", "deleted")
    return changes.read_buckets(w.spark, path)


@query
def scd2_late_versions(w: Workspace) -> DataFrame:
    """The history of order priorities where every fifth order comes after the history was built."""
    versions = w.table("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderpriority")
    late = F.col("o_orderkey") % 5 == 0
    history = changes.customer_history(versions.where(~late), "o_custkey", "day", ["o_orderpriority"])
    return changes.insert_versions(history, versions.where(late), "o_custkey", "day", ["o_orderpriority"])


@query
def shipments_as_of(w: Workspace) -> DataFrame:
    """Shipments by the order priority that the customer had on the day of shipping."""
    orders = w.table("orders").select("o_orderkey", "o_custkey")
    lines = w.table("lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("shipped"))
    facts = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "shipped")
    history = scd2_customer(w).drop("is_current")
    return changes.as_of(facts, "shipped", history, "o_custkey", days=lines).groupBy(F.col("o_orderpriority").alias("priority_when_shipped")).agg(
        F.count(F.lit(1)).alias("shipments"), F.count_distinct("o_custkey").alias("customers"))


@query
def stream_sales(w: Workspace) -> DataFrame:
    """Purchases, taken from the events as a stream and appended without replays."""
    events = w.table("events")
    stream = sales_stream.read_stream(w.spark, w.sf_dir, events.schema, files="events.parquet")
    target = w.new_folder("stream_sales")
    bought = stream.where("event_type = 'purchase'").select("event_id", "ts", "user_id", "value")
    sales_stream.append_stream(bought, "event_id", target, f"{target}_checkpoint").awaitTermination()
    return w.spark.read.parquet(target)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(QUERIES[name](workspace(spark, sf_dir)))
