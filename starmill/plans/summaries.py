"""The stored summaries, kept in step with the fact: each sale counts exactly once, whatever failed before.

Every summary notes through which ``sale_key`` it includes the fact, and which generation of the fact
(a replaced fact is a new one).  An update always takes the lines beyond that mark, so a run that
died after the fact load is made up for by the next one, and a repeated update finds nothing to do.

The monthly summary adds up: its state has sums and, for the distinct customers, sets of the dense
``customer_key`` per 32,768 keys: their positions or, where there are many, a bitmap.  Each load adds
one folder of its own sums and sets; the summary's months are folded from these folders, and no
older sale is read.  Many folders are folded into one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.operators import folders
from starmill.operators.sinks import read_table, replace_partitions, write_table
from starmill.plans.aggregates import MONTHLY_KEYS, customer_summary, merge_customer_summary, monthly_sets
from starmill.plans.warehouse import SALES_FOLDER, Star
from starmill.session import side_by_side

# A set with more positions in one bucket than this is stored as a bitmap (4 KB).
POSITIONS = 512
# Folders of loads that are folded into one.
MOST_LOADS = 16
THROUGH, APPLIED, GENERATION = "_through", "_applied", "_generation"
SUMS = ["transactions", "quantity", "gross", "discounts", "net"]
_SET = [*MONTHLY_KEYS, "bucket"]
_STATE = ("month_name string, category string, subcategory string, region string, state string, transactions long, quantity long,"
          " gross decimal(22,2), discounts decimal(20,2), net decimal(22,2), bucket long, positions array<int>, bitmap binary,"
          " `from` long, year smallint, month smallint")


# --- sums and sets that add up ------------------------------------------------


def monthly_state(star: Star, fact: DataFrame) -> DataFrame:
    """Sums and customers of fact rows, by the keys of the monthly summary and the customers' bucket."""
    return _narrow(monthly_sets(star, fact).drop("nets")).withColumn("bitmap", F.lit(None).cast("binary"))


def _narrow(sums: DataFrame) -> DataFrame:
    """Sums in the types that one sum over the fact has, so that sums of sums do not widen from load to load."""
    kinds = {"transactions": "long", "quantity": "long", "gross": "decimal(22,2)", "discounts": "decimal(20,2)", "net": "decimal(22,2)"}
    return sums.withColumns({n: F.col(n).cast(kind) for n, kind in kinds.items()})


def _sums() -> list[Column]:
    return [F.sum(n).alias(n) for n in SUMS]


def with_bitmaps(state: DataFrame) -> DataFrame:
    """A state whose large sets are bitmaps of 4 KB."""
    large = F.size("positions") > POSITIONS
    positions = state.where(large).select(*_SET, F.explode(F.col("positions").cast("array<bigint>")).alias("position"))
    bitmaps = positions.groupBy(*_SET).agg(F.bitmap_construct_agg("position").alias("bitmap"))
    sums = state.where(large).select(*_SET, *SUMS)
    whole = bitmaps.unionByName(sums, allowMissingColumns=True).groupBy(*_SET).agg(
        F.first("bitmap", ignorenulls=True).alias("bitmap"), *_sums())
    return state.where(F.col("bitmap").isNotNull() | ~large).unionByName(_narrow(whole), allowMissingColumns=True)


def add_up(states: DataFrame) -> DataFrame:
    """One state from the rows of several: sums are added, positions united; bitmaps, if any are there, are or-ed.

    All rows of a group come together once; they are few, one for each load and bucket.
    """
    near = states.repartition(*MONTHLY_KEYS)
    united = F.array_distinct(F.flatten(F.collect_list("positions"))).alias("positions")
    if states.where("bitmap IS NOT NULL").isEmpty():
        return _narrow(near.groupBy(*_SET).agg(*_sums(), united)).withColumn("bitmap", F.lit(None).cast("binary"))
    marked = near.withColumn("_large", F.max(F.col("bitmap").isNotNull()).over(Window.partitionBy(*_SET)))
    small = marked.where("NOT _large").groupBy(*_SET).agg(*_sums(), united)
    large = marked.where("_large")
    positions = large.select(*_SET, F.explode(F.col("positions").cast("array<bigint>")).alias("position"))
    bitmaps = positions.groupBy(*_SET).agg(F.bitmap_construct_agg("position").alias("bitmap")).unionByName(
        large.where("bitmap IS NOT NULL").select(*_SET, "bitmap")).unionByName(large.select(*_SET, *SUMS), allowMissingColumns=True)
    whole = bitmaps.groupBy(*_SET).agg(F.bitmap_or_agg("bitmap").alias("bitmap"), *_sums())
    return _narrow(small.unionByName(whole, allowMissingColumns=True))


def monthly_view(states: DataFrame, once: bool = False) -> DataFrame:
    """The monthly summary of a state, or of several together.

    ``once``: each group and bucket has one row, as in the state of one load; then the sets move nowhere, only their sizes are read.
    """
    customers = F.coalesce(F.bitmap_count("bitmap"), F.size("positions").cast("long"))
    names = {"transactions": "total_transactions", "quantity": "total_quantity_sold", "gross": "total_gross_sales",
             "discounts": "total_discounts", "net": "total_net_sales"}
    summed = (states if once else add_up(states)).groupBy(*MONTHLY_KEYS).agg(F.sum(customers).alias("unique_customers"), *_sums())
    return _narrow(summed).withColumnsRenamed(names).withColumn(
        "avg_transaction_value", F.col("total_net_sales").cast("double") / F.col("total_transactions"))


# --- stored, with their marks -------------------------------------------------


def _loads(spark: SparkSession, folder: str) -> dict[str, int]:
    """Folders of a state by name, in order, and through which sale each goes."""
    names = [n for n in folders.children(spark, folder) if n.startswith("from=")]
    return {n: int(folders.read_note(spark, f"{folder}/{n}", THROUGH)) for n in names}


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a stored state, with the months as partitions; ``from`` is the load."""
    return spark.read.schema(_STATE).parquet(folders.settle(spark, folder))


def _store(state: DataFrame, path: str, through: int, gathered: bool = False) -> None:
    """Write a state, which may lie by month, and its mark.  Only where a set is large is it read again, to make bitmaps."""
    spark, parts = state.sparkSession, ["year", "month"]
    largest = write_table(state, path, partition_by=parts, in_place=True, gathered=gathered, largest=F.max(F.size("positions")))["largest"]
    if largest and largest > POSITIONS:
        folders.remove(spark, f"{path}__sets")
        folders.rename(spark, path, f"{path}__sets")
        sets = spark.read.schema(_STATE).parquet(f"{path}__sets").drop("from")
        write_table(with_bitmaps(sets), path, partition_by=parts, in_place=True)
        folders.remove(spark, f"{path}__sets")
    folders.write_note(spark, path, THROUGH, str(through))


def _write_load(state: DataFrame, folder: str, first: int, through: int) -> None:
    """Add the state of a load, which lies by month and may be empty, to a stored one in one step."""
    spark, draft = state.sparkSession, f"{folder}__load"
    _store(state, draft, through, gathered=True)
    folders.rename(spark, draft, f"{folder}/from={first:020d}")


def replace_state(state: DataFrame, folder: str, through: int, generation: str = "", gathered: bool = False) -> None:
    """A stored state that consists of one load; ``gathered``: its rows lie by month."""
    spark, new = state.sparkSession, folders.beside(folder)
    folders.remove(spark, new)
    _store(state, f"{new}/from={0:020d}", through, gathered)
    folders.write_note(spark, new, GENERATION, generation)
    folders.switch(spark, folder)


def extend_state(star: Star, fact: DataFrame, folder: str, through: int) -> None:
    """Add the sales of ``fact`` beyond the state's mark, through ``through``; older sales are not read."""
    spark = fact.sparkSession
    mark = max(_loads(spark, folders.settle(spark, folder)).values())
    if through <= mark:
        return
    batch = fact.where(F.col("sale_key") > mark)
    _write_load(monthly_state(star, batch), folder, mark + 1, through)
    if len(_loads(spark, folder)) > MOST_LOADS:
        replace_state(add_up(read_state(spark, folder).drop("from")), folder, through, folders.read_note(spark, folder, GENERATION) or "")


def _month(year: Column, month: Column) -> Column:
    return year.cast("int") * 100 + month.cast("int")


def _derive_months(spark: SparkSession, folder: str, view: str, generation: str) -> None:
    """Fold the months of loads that the summary does not include yet, all of them if it is of another generation."""
    loads = _loads(spark, folder)
    applied = folders.read_note(spark, folders.settle(spark, view), APPLIED)
    before = int(applied.split(" ")[1]) if applied and applied.split(" ")[0] == generation else None
    note, state = f"{generation} {max(loads.values())}", read_state(spark, folder).drop("from")
    if applied == note:
        return
    if before is None:
        write_table(monthly_view(state, once=len(loads) == 1), view, partition_by=["year", "month"], notes={APPLIED: note})
        return
    new = [int(n.removeprefix("from=")) for n, through in loads.items() if through > before]
    month, states = _month(F.col("year"), F.col("month")), read_state(spark, folder)
    # At most one value per calendar month.
    months = [r[0] for r in states.where(F.col("from").isin(new)).select(month).distinct().collect()]
    replace_partitions(monthly_view(state.where(month.isin(months))), view, ["year", "month"])
    folders.write_note(spark, view, APPLIED, note)


def sync_summaries(star: Star, target: str, load: dict | None = None, rebuild: bool = False) -> None:
    """Bring both stored summaries in step with the fact.

    ``load`` is what ``load_fact`` gave back: where nothing is missing before it, only the months it wrote are opened.  Attributes are
    those of the time of the load; ``rebuild`` takes today's.  Each summary is in step by itself, so a run may
    die at any point and be repeated.
    """
    spark = star.fact.sparkSession
    generation = folders.read_note(spark, f"{target}/{SALES_FOLDER}", GENERATION) or "first"
    top = load["top"] if load else star.fact.agg(F.max("sale_key")).first()[0]
    top = -1 if top is None else top

    def beyond(mark: int) -> DataFrame:
        rows = star.fact.where(F.col("sale_key") > mark)
        if load and load["first_key"] <= mark + 1:
            rows = rows.where(F.col("month_key").isin(load["months"]))
        return rows

    def monthly() -> None:
        folder, view = f"{target}/mv_monthly_state", f"{target}/mv_monthly_sales"
        if rebuild or folders.read_note(spark, folders.settle(spark, folder), GENERATION) != generation:
            if folders.exists(spark, folders.settle(spark, view)):
                folders.write_note(spark, view, APPLIED, "none -1")
            # The fact is read for the state only; the summary is folded from the state.
            replace_state(monthly_state(star, star.fact), folder, top, generation, gathered=True)
        else:
            extend_state(star, beyond(max(_loads(spark, folder).values())), folder, top)
        _derive_months(spark, folder, view, generation)

    def customers() -> None:
        path = folders.settle(spark, f"{target}/mv_customer_summary")
        applied = (folders.read_note(spark, path, APPLIED) or "none -1").split(" ")
        note = {APPLIED: f"{generation} {top}"}
        if rebuild or applied[0] != generation:
            write_table(customer_summary(star), path, notes=note)
        elif int(applied[1]) < top:
            merged = merge_customer_summary(star, read_table(spark, path), beyond(int(applied[1])))
            write_table(merged, path, notes=note)

    side_by_side(spark, {"mv_monthly_sales": monthly, "mv_customer_summary": customers})
