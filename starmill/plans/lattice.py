"""A lattice of stored group-bys of the fact, and requests answered from the smallest ones that will do.

A shape names the columns of a stored group-by: attributes of dimensions, or keys, from which every attribute
of the dimension can be looked up.  Sums add up to any coarser group; distinct customers do too, as sets of the dense
``customer_key`` per 32,768 keys (positions, or a bitmap where there are many; a row may have both, its set is the union).
A shape is built from the smallest one that is finer, and only the finest from the fact.

A request is answered from the summary with the fewest rows that has its columns and measures.  A range of days is cut
into whole months and what is left at both ends: the months come from a monthly summary, the ends from a daily one
or, without one, from the few months of the fact.  A summary that is not in step with the fact is passed over, so an
answer is that of the fact, but for attributes, which a summary has as they were at the load.

Every load adds a folder of its own sums and sets with the mark through which sale it goes, in one step; many
folders are folded into one.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.cleaning import safe_ratio
from starmill.operators import folders
from starmill.operators.groups import group_by_month, near_by_month
from starmill.operators.joins import lookup_join, numbered_values, with_number, with_values
from starmill.operators.sinks import read_table, write_table
from starmill.plans.aggregates import MONTHLY_KEYS
from starmill.plans.summaries import APPLIED, GENERATION, MOST_LOADS, POSITIONS, SUMS, THROUGH
from starmill.plans.warehouse import SALES_FOLDER, Star

# Which attributes a key gives.  Every table that has date_key has month_key.
ATTRIBUTES = {
    "month_key": ("year", "quarter", "month", "month_name"),
    "date_key": ("date_value", "year", "quarter", "month", "month_name", "day", "is_weekend", "fiscal_year"),
    "product_key": ("product_id", "product_name", "category", "subcategory", "brand"),
    "location_key": ("location_id", "store_name", "region", "state"),
    "customer_key": ("customer_id", "full_name", "customer_state"),
}
_CALENDAR = set(ATTRIBUTES["date_key"])
_KINDS = {"transactions": "long", "quantity": "long", "gross": "decimal(22,2)", "discounts": "decimal(20,2)", "net": "decimal(22,2)"}
_SETS = ["positions", "bitmap"]
_DAY, _MONTH, _SCHEMA = "date_key", "month_key", "_schema"
# Each measure by the sums it takes; unique_customers takes sets.
MEASURES = {
    "total_sales": (("net",), lambda: F.col("net")),
    "total_transactions": (("transactions",), lambda: F.coalesce("transactions", F.lit(0))),
    "units_sold": (("quantity",), lambda: F.col("quantity")),
    "gross_sales": (("gross",), lambda: F.col("gross")),
    "total_discount": (("discounts",), lambda: F.col("discounts")),
    "avg_transaction_value": (("net", "transactions"), lambda: F.try_divide(F.col("net").cast("double"), F.col("transactions"))),
    "discount_rate": (("discounts", "gross"), lambda: safe_ratio(F.col("discounts"), F.col("gross"))),
    "unique_customers": ((), lambda: F.coalesce("customers", F.lit(0))),
}


@dataclass(frozen=True)
class Shape:
    """A stored group-by: its columns, and whether it has sets of customers."""

    name: str
    grain: tuple[str, ...]
    sets: bool = False


@dataclass(frozen=True)
class Request:
    """Measures by attributes (or keys), of the rows whose attributes are among the chosen ones, from day to day."""

    measures: tuple[str, ...]
    by: tuple[str, ...] = ()
    where: dict[str, list] = field(default_factory=dict)
    start: date | None = None
    end: date | None = None

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.by, *self.where]))

    @property
    def sums(self) -> list[str]:
        taken = {s for m in self.measures for s in MEASURES[m][0]}
        return [s for s in SUMS if s in taken]

    @property
    def sets(self) -> bool:
        return "unique_customers" in self.measures


@dataclass(frozen=True)
class Source:
    """A table that can answer requests: columns of its grain, sums, and sets if it has them.

    ``dated`` tables lack sales outside the calendar, which the fact has unless a column of the calendar is asked for.
    """

    name: str
    table: DataFrame
    grain: tuple[str, ...]
    rows: int | None
    sums: tuple[str, ...] = tuple(SUMS)
    sets: bool = False
    dated: bool = False

    def key_of(self, column: str) -> str | None:
        """The column itself, or the key that gives it; None if neither is there."""
        if column in self.grain:
            return column
        return next((k for k, given in ATTRIBUTES.items() if k in self.grain and column in given), None)

    def answers(self, request: Request, also: Iterable[str] = ()) -> bool:
        asked = [*request.columns, *also]
        return (all(self.key_of(c) for c in asked) and set(request.sums) <= set(self.sums)
                and (self.sets or not request.sets) and (not self.dated or any(c in _CALENDAR for c in request.columns)))


@dataclass(frozen=True)
class Part:
    """What a source contributes to an answer: all of it, or what lies between two months or days, as keys."""

    source: Source
    column: str | None = None
    between: tuple[int, int] | None = None


# --- rows, sums and sets ------------------------------------------------------


def _sum(names: Iterable[str]) -> list[Column]:
    """Sums in the types of one sum over the fact, so that sums of sums do not widen."""
    return [F.sum(n).cast(_KINDS[n]).alias(n) for n in names]


def fact_source(star: Star) -> Source:
    """The fact itself: a row for each line, with the line's customer as a set of one."""
    key = F.col("customer_key")
    table = star.fact.select(
        "sale_key", *ATTRIBUTES, F.lit(1).cast("long").alias("transactions"), F.col("quantity").cast("long").alias("quantity"),
        F.col("gross_amount").alias("gross"), F.col("discount_amount").alias("discounts"), F.col("net_amount").alias("net"),
        F.bitmap_bucket_number(key).alias("bucket"), F.array(F.bitmap_bit_position(key).cast("int")).alias("positions"),
        F.lit(None).cast("binary").alias("bitmap"))
    return Source("sales_fact", table, tuple(ATTRIBUTES), None, sets=True)


def _with_columns(star: Star, source: Source, rows: DataFrame, columns: list[str], grouped: bool) -> DataFrame:
    """Look up the columns that the source has by key only."""
    wanted: dict[str, list[str]] = {}
    for c in columns:
        if (key := source.key_of(c)) != c:
            wanted.setdefault(key, []).append(c)
    for key, names in wanted.items():
        if key == _MONTH:
            months = star.date.select((F.col("year").cast("int") * 100 + F.col("month")).alias(_MONTH), *names).distinct()
            rows = lookup_join(rows, months, _MONTH, spread=_MONTH, right_rows=star.rows.get("date"), hot=[])
        elif key == "customer_key":  # the customer's own state is not the store's
            people = star.customer.withColumnRenamed("state", "customer_state")
            named = Star(star.fact, people, star.product, star.location, star.date, star.rows, star._hot)
            rows = named.join(rows, "customer", names, grouped=grouped)
        else:
            rows = star.join(rows, key.removesuffix("_key"), names, grouped=grouped)
    return rows


def _united(by: list[str], rows: DataFrame, *others: DataFrame) -> DataFrame:
    """A row for each group from the columns that each table has of it; keys may be null, so this is no join."""
    for more in others:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.groupBy(*by).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rows.columns if c not in by])


def line_state(star: Star, source: Source, keys: list[str], sets: bool) -> DataFrame:
    """Sums, and sets if wanted, of lines, by keys and attributes.

    Where a dimension's attributes have few values, lines go by their number: no shuffle for the lookup, and no text in the
    one that brings a group together.  With a month among the keys the groups lie by it.
    """
    rows, values, wanted = source.table, {}, {}
    for c in keys:
        if (key := source.key_of(c)) != c:
            wanted.setdefault(key, []).append(c)
    for key, names in wanted.items():
        dim = key.removesuffix("_key")
        if key in ("product_key", "location_key") and (coded := star.code(rows, dim, names, f"_{dim}")) is not None:
            rows, values[f"_{dim}"] = coded
        else:
            rows = _with_columns(star, source, rows, names, False)
    given = {c for known in values.values() for c in known.columns}
    by = [*[c for c in keys if c not in given], *values, *(["bucket"] if sets else [])]
    position, summed = F.col("positions")[0].alias("position"), [n for n in SUMS if n != "transactions"]
    rows = rows.select(*by, *([position] if sets else []), *summed)
    folded = _grouped(rows, by, F.count(F.lit(1)).alias("transactions"), *_sum(summed),
                      *([F.collect_set("position").alias("positions")] if sets else []))
    for name, known in values.items():
        folded = with_values(folded, known, name)
    return folded.select(*keys, *(["bucket"] if sets else []), *SUMS, *(["positions", F.lit(None).cast("binary").alias("bitmap")] if sets else []))


def _grouped(rows: DataFrame, by: list[str], *aggregates: Column) -> DataFrame:
    if _MONTH not in by:
        return rows.groupBy(*by).agg(*aggregates)
    others = [c for c in by if c != _MONTH]
    return group_by_month(near_by_month(rows, [_MONTH], others), [_MONTH], others, *aggregates)


def fold_state(rows: DataFrame, keys: list[str], sets: bool) -> DataFrame:
    """Sums, and sets if wanted, by coarser keys.  A set has 32,768 positions in a bucket at most, however many rows it comes from.

    With a month among the keys the groups lie by it.
    """
    text = [f.name for f in rows.select(*keys).schema if isinstance(f.dataType, T.StringType)]
    values = numbered_values(rows, text) if text else None
    if values is not None:
        rows = with_number(rows, values, "_text")
    columns, keys = keys, [*[k for k in keys if k not in text], "_text"] if values is not None else keys
    folded = _folded(rows, keys, sets)
    return (folded if values is None else with_values(folded, values, "_text")).select(
        *columns, *(["bucket"] if sets else []), *SUMS, *(_SETS if sets else []))


def _folded(rows: DataFrame, keys: list[str], sets: bool) -> DataFrame:
    if not sets:
        return _grouped(rows.select(*keys, *SUMS), keys, *_sum(SUMS))
    by = [*keys, "bucket"]
    if rows.where("bitmap IS NOT NULL").isEmpty():  # one pass too: a row comes once for each position, its sums with the first
        near, others = rows.select(*by, *SUMS, "positions"), [c for c in by if c != _MONTH]
        if _MONTH in by:
            near = near_by_month(near, [_MONTH], others)
        ones = near.select(*[c for c in near.columns if c != "positions"], F.posexplode_outer("positions").alias("at", "position"))
        first = F.coalesce("at", F.lit(0)) == 0
        sums = [F.sum(F.when(first, F.col(n))).cast(_KINDS[n]).alias(n) for n in SUMS]
        sums += [F.collect_set("position").alias("positions")]
        folded = group_by_month(ones, [_MONTH], others, *sums) if _MONTH in by else ones.groupBy(*by).agg(*sums)
        return folded.withColumn("bitmap", F.lit(None).cast("binary"))
    positions = rows.select(*by, F.explode("positions").alias("position")).groupBy(*by).agg(F.collect_set("position").alias("positions"))
    bitmaps = rows.where("bitmap IS NOT NULL").groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    united = _united(by, rows.groupBy(*by).agg(*_sum(SUMS)), positions, bitmaps)
    return united.hint("rebalance", _MONTH) if _MONTH in by else united


def large_as_bitmaps(state: DataFrame, keys: list[str]) -> DataFrame:
    """A state whose sets of many positions are bitmaps of 4 KB."""
    by, large = [*keys, "bucket"], F.coalesce(F.size("positions"), F.lit(0)) > POSITIONS
    many = state.where(large)
    numbers = many.select(*by, F.explode(F.col("positions").cast("array<bigint>")).alias("position"))
    bitmaps = numbers.groupBy(*by).agg(F.bitmap_construct_agg("position").alias("bitmap")).unionByName(
        many.where("bitmap IS NOT NULL").select(*by, "bitmap")).groupBy(*by).agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return state.where(~large).unionByName(_united(by, many.select(*by, *SUMS), bitmaps), allowMissingColumns=True)


def count_customers(rows: DataFrame, by: list[str]) -> DataFrame:
    """Distinct customers of the sets of each group."""
    near = [*by, "bucket"]
    numbers = rows.select(*near, F.explode(F.col("positions").cast("array<bigint>")).alias("position"))
    bitmaps = numbers.groupBy(*near).agg(F.bitmap_construct_agg("position").alias("bitmap"))
    whole = bitmaps.unionByName(rows.where("bitmap IS NOT NULL").select(*near, "bitmap")).groupBy(*near).agg(
        F.bitmap_or_agg("bitmap").alias("bitmap"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))


# --- stored -------------------------------------------------------------------


def _folder(target: str, shape: Shape) -> str:
    return f"{target}/lattice/{shape.name}"


def _loads(spark: SparkSession, folder: str) -> list[str]:
    return [n for n in folders.children(spark, folder) if n.startswith("from=")]


def _mark(spark: SparkSession, folder: str) -> tuple[str, int] | None:
    """Generation of the fact and highest sale key of a stored shape."""
    generation = folders.read_note(spark, folders.settle(spark, folder), GENERATION)
    through = [int(folders.read_note(spark, f"{folder}/{n}", THROUGH)) for n in _loads(spark, folder)]
    return (generation, max(through)) if generation and through else None


def _stored(spark: SparkSession, target: str, shape: Shape) -> Source:
    """A stored shape; its rows are counted from file footers."""
    folder = folders.settle(spark, _folder(target, shape))
    schema = T.StructType.fromJson(json.loads(folders.read_note(spark, folder, _SCHEMA)))
    table = spark.read.schema(schema).parquet(folder).drop("from")
    grain = shape.grain if _DAY not in shape.grain else (*shape.grain, _MONTH)
    return Source(shape.name, table, grain, table.count(), sets=shape.sets)


def _state(star: Star, source: Source, shape: Shape) -> DataFrame:
    keys = list(dict.fromkeys([*shape.grain, *([_MONTH] if _DAY in shape.grain else [])]))
    if source.rows is None:
        return line_state(star, source, keys, shape.sets)
    return fold_state(_with_columns(star, source, source.table, keys, True), keys, shape.sets)


def _write(state: DataFrame, path: str, shape: Shape, through: int) -> None:
    """Write a state, which lies by month, and its mark.  Only where a set is large is it read again, to make bitmaps."""
    spark, parts = state.sparkSession, [_MONTH] if {_DAY, _MONTH} & set(shape.grain) else None
    folders.remove(spark, path)
    if not shape.sets:
        write_table(state, path, partition_by=parts, in_place=True, gathered=True)
    else:
        largest = write_table(state, f"{path}__sets", partition_by=parts, in_place=True, gathered=True,
                              largest=F.max(F.size("positions")))["largest"]
        if largest and largest > POSITIONS:
            sets = spark.read.schema(state.schema).parquet(f"{path}__sets")
            keys = [c for c in sets.columns if c not in (*SUMS, *_SETS, "bucket")]
            write_table(large_as_bitmaps(sets, keys), path, partition_by=parts, in_place=True)
            folders.remove(spark, f"{path}__sets")
        else:
            folders.rename(spark, f"{path}__sets", path)
    folders.write_note(spark, path, THROUGH, str(through))


def _replace(state: DataFrame, folder: str, shape: Shape, through: int, generation: str) -> None:
    """A stored shape that consists of one load; the old one stays until it stands."""
    spark, new = state.sparkSession, folders.beside(folder)
    folders.remove(spark, new)
    _write(state, f"{new}/from={0:020d}", shape, through)
    folders.write_note(spark, new, GENERATION, generation)
    folders.write_note(spark, new, _SCHEMA, state.schema.json())
    folders.switch(spark, folder)


def _fact_mark(star: Star, target: str, load: dict | None) -> tuple[str, int]:
    spark = star.fact.sparkSession
    generation = folders.read_note(spark, folders.settle(spark, f"{target}/{SALES_FOLDER}"), GENERATION) or "first"
    top = load["top"] if load else star.fact.agg(F.max("sale_key")).first()[0]
    return generation, -1 if top is None else top


def sync_lattice(star: Star, target: str, shapes: list[Shape], load: dict | None = None) -> None:
    """Bring the stored shapes in step with the fact.  ``shapes`` go from fine to coarse.

    ``load`` is what ``load_fact`` gave back; without it the highest sale key is read from the fact.  A shape of
    another generation is built anew, from the smallest finer one that is in step; else the sales beyond its
    mark are added, and older ones are not read.  A run may die at any point and be repeated.
    """
    spark, (generation, top) = star.fact.sparkSession, _fact_mark(star, target, load)
    fact, built = fact_source(star), []
    for shape in shapes:
        folder = _folder(target, shape)
        mark = _mark(spark, folder)
        if mark is None or mark[0] != generation:
            columns = Request((), shape.grain)
            finer = [s for s in built if s.answers(columns) and (s.sets or not shape.sets)]
            _replace(_state(star, min(finer, key=lambda s: s.rows, default=fact), shape), folder, shape, top, generation)
        elif mark[1] < top:
            new = F.col("sale_key") > mark[1]
            if load and load["first_key"] <= mark[1] + 1:
                new = new & F.col(_MONTH).isin(load["months"])
            late = Source(fact.name, fact.table.where(new), fact.grain, None, sets=True)
            draft = f"{folder}__load"
            _write(_state(star, late, shape), draft, shape, top)
            folders.rename(spark, draft, f"{folder}/from={mark[1] + 1:020d}")
            if len(_loads(spark, folder)) > MOST_LOADS:
                _replace(_state(star, _stored(spark, target, shape), shape), folder, shape, top, generation)
        built.append(_stored(spark, target, shape))


# --- requests -----------------------------------------------------------------


def _next_month(day: date) -> date:
    return date(day.year + day.month // 12, day.month % 12 + 1, 1)


def _day_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


_FIRST, _LAST = date(1, 2, 1), date(9999, 11, 30)  # so that a month's neighbours are dates


def cut_range(start: date, end: date) -> tuple[tuple[int, int] | None, list[tuple[int, int]]]:
    """The whole months of a range, first and last as keys, and the spans of days left over, at most two."""
    first = start if start.day == 1 else _next_month(start)
    after = end + timedelta(days=1)
    beyond = after if after.day == 1 else date(end.year, end.month, 1)
    if start > end:
        return None, [(_day_key(start), _day_key(end))]
    if first >= beyond:  # no whole month: one span within a month or over a month's end
        return None, [(_day_key(start), _day_key(end))]
    last = beyond - timedelta(days=1)
    spans = [(start, first - timedelta(days=1)), (beyond, end)]
    months = (first.year * 100 + first.month, last.year * 100 + last.month)
    return months, [(_day_key(a), _day_key(b)) for a, b in spans if a <= b]


class Lattice:
    """The summaries of a star that are in step with its fact, and the answers they give."""

    def __init__(self, star: Star, sources: list[Source]):
        self.star, self.sources, self.fact = star, sources, fact_source(star)

    def _smallest(self, request: Request, also: Iterable[str] = ()) -> Source:
        return min((s for s in self.sources if s.answers(request, also)), key=lambda s: (s.rows, s.name), default=self.fact)

    def parts(self, request: Request) -> list[Part]:
        """Where an answer comes from."""
        if request.start is None and request.end is None:
            return [Part(self._smallest(request))]
        start, end = max(request.start or _FIRST, _FIRST), min(request.end or _LAST, _LAST)
        months, spans = cut_range(start, end)
        fine, coarse = self._smallest(request, [_DAY]), self._smallest(request, [_MONTH])
        if months is None or coarse is fine:
            return [Part(fine, _DAY, (_day_key(start), _day_key(end)))]
        return [Part(coarse, _MONTH, months), *[Part(fine, _DAY, span) for span in spans]]

    def _rows(self, part: Part, request: Request) -> DataFrame:
        source, rows = part.source, part.source.table
        if part.between:
            low, high = part.between
            if part.column == _DAY:  # and the months, by which tables are stored
                rows = rows.where(F.col(_MONTH).between(low // 100, high // 100))
            rows = rows.where(F.col(part.column).between(low, high))
        measured = [*request.sums, *(["bucket", *_SETS] if request.sets else [])]
        keys = list(dict.fromkeys(source.key_of(c) for c in request.columns))
        grouped = source.rows is not None
        if not grouped and not request.sets and len(keys) <= 2:  # lines fold up well before they meet a dimension
            rows, grouped = rows.groupBy(*keys).agg(*_sum(request.sums)), True
        rows = _with_columns(self.star, source, rows, request.columns, grouped)
        for column, chosen in request.where.items():
            rows = rows.where(F.col(column).isin(chosen))
        return rows.select(*request.by, *measured)

    def answer(self, request: Request) -> DataFrame:
        """The request's measures, a row for each group; one row, with counts of 0, if there is nothing to group by."""
        parts, by = [self._rows(p, request) for p in self.parts(request)], list(request.by)
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        # A group is there if it has rows, whatever is measured.
        folded = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *_sum(request.sums))
        if request.sets:
            folded = _united(by, folded, count_customers(rows, by))
        return folded.select(*by, *[MEASURES[m][1]().alias(m) for m in request.measures])


def _standing(star: Star, target: str, mark: tuple[str, int]) -> list[Source]:
    """The two summaries that every run stores, and the state of the monthly one, as far as they are in step."""
    spark, note, found = star.fact.sparkSession, f"{mark[0]} {mark[1]}", []
    month = (F.col("year").cast("int") * 100 + F.col("month")).alias(_MONTH)
    names = {"transactions": "total_transactions", "quantity": "total_quantity_sold", "gross": "total_gross_sales",
             "discounts": "total_discounts", "net": "total_net_sales"}
    if folders.read_note(spark, folders.settle(spark, f"{target}/mv_monthly_sales"), APPLIED) == note:
        stored = read_table(spark, f"{target}/mv_monthly_sales")
        table = stored.select(*MONTHLY_KEYS, month, *[F.col(c).alias(n) for n, c in names.items()])
        found.append(Source("mv_monthly_sales", table, (*MONTHLY_KEYS, _MONTH), stored.count(), dated=True))
    state = f"{target}/mv_monthly_state"
    if _mark(spark, state) == mark:
        stored = read_table(spark, state)
        table = stored.select(*MONTHLY_KEYS, month, *SUMS, "bucket", *_SETS)
        found.append(Source("mv_monthly_state", table, (*MONTHLY_KEYS, _MONTH), stored.count(), sets=True, dated=True))
    if folders.read_note(spark, folders.settle(spark, f"{target}/mv_customer_summary"), APPLIED) == note:
        stored = read_table(spark, f"{target}/mv_customer_summary")
        table = stored.where("total_purchases > 0").select(
            "customer_key", F.col("total_purchases").alias("transactions"), F.col("total_items_purchased").alias("quantity"),
            F.col("lifetime_value").alias("net"))
        found.append(Source("mv_customer_summary", table, ("customer_key",), stored.count(), ("transactions", "quantity", "net")))
    return found


def open_lattice(star: Star, target: str, shapes: list[Shape], load: dict | None = None) -> Lattice:
    """The stored shapes and summaries that are in step with the fact; the others are passed over."""
    spark, mark = star.fact.sparkSession, _fact_mark(star, target, load)
    stored = [_stored(spark, target, s) for s in shapes if _mark(spark, _folder(target, s)) == mark]
    return Lattice(star, [*stored, *_standing(star, target, mark)])
