"""The stored star schema, opened for queries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.fact import ACCEPTED, REJECTED, SALES_LINES
from starmill.operators.folders import settle
from starmill.operators.joins import BROADCAST_ROWS, block_join, hot_keys, is_small, key_blocks, lookup_join, numbered_values, with_number
from starmill.operators.sinks import read_table
from starmill.schemas import CURATED

DIM_TABLES = {"customer": "customer_dim", "product": "product_dim", "location": "location_dim", "date": "date_dim"}
SALES_FOLDER = "sales_lines"
TABLES = [*DIM_TABLES.values(), "sales_fact"]


@dataclass(frozen=True)
class Star:
    """The fact and its four dimensions; ``rows`` holds the row counts noted when they were loaded."""

    fact: DataFrame
    customer: DataFrame
    product: DataFrame
    location: DataFrame
    date: DataFrame
    rows: dict[str, int] = field(default_factory=dict)
    _hot: dict[str, list] = field(default_factory=dict, repr=False)
    _coded: dict[tuple, tuple | None] = field(default_factory=dict, repr=False)

    def hot(self, key: str) -> list:
        """The fact's hot values of a key, looked for once per star."""
        if key not in self._hot:
            self._hot[key] = hot_keys(self.fact, [key])[key]
        return self._hot[key]

    def tables(self) -> dict[str, DataFrame]:
        return {**{t: getattr(self, d) for d, t in DIM_TABLES.items()}, "sales_fact": self.fact}

    def join(self, left: DataFrame, dim: str, columns: list[str], how: str = "inner",
             grouped: bool = False) -> DataFrame:
        """Add ``columns`` of a dimension to rows that hold its key.

        The lookup is pruned to these columns.  It is broadcast only if its noted
        row count is small; beyond that, fact rows take the salted join, while
        ``grouped`` rows (one per dimension key, or nearly) take a plain one.
        """
        key = f"{dim}_key"
        lookup = getattr(self, dim).select(key, *columns)
        if grouped and self.rows.get(dim) is None:
            return left.join(lookup, key, how)
        if grouped:
            return lookup_join(left, lookup, key, how, spread=key, right_rows=self.rows[dim], hot=[])
        rows = self.rows[dim] if dim in self.rows else lookup.count()
        hot = self.hot(key) if rows > BROADCAST_ROWS else []
        return lookup_join(left, lookup, key, how, spread="sale_key", right_rows=rows, hot=hot)


    def code(self, rows: DataFrame, dim: str, columns: list[str], name: str) -> tuple[DataFrame, DataFrame] | None:
        """Fact rows with a number, ``name``, for the values of a dimension's ``columns``, and the values of the numbers.

        Rows without a member go, as in ``join``.  No shuffle, however large the dimension; None where its columns have too
        many distinct values for that, and ``join`` is to be used.
        """
        key = f"{dim}_key"
        lookup = getattr(self, dim).select(key, *columns)
        if (dim, *columns) not in self._coded:
            count = self.rows[dim] if self.rows.get(dim) is not None else lookup.count()
            if is_small(lookup.schema, count, BROADCAST_ROWS):
                values = numbered_values(lookup, columns)
                found = None if values is None else (None, values)
            else:
                found = key_blocks(lookup, key, columns)
            self._coded[(dim, *columns)] = found
        if (found := self._coded[(dim, *columns)]) is None:
            return None
        blocks, values = found
        if blocks is not None:
            return block_join(rows, blocks, key, name), values
        return rows.join(F.broadcast(with_number(lookup, values, name)), key), values


def read_sales_lines(spark: SparkSession, root: str) -> DataFrame:
    """Accepted and rejected sales lines, told apart by ``status``."""
    return spark.read.schema(SALES_LINES).parquet(settle(spark, f"{root}/{SALES_FOLDER}"))


def _sales_lines(spark: SparkSession, root: str, status: str) -> DataFrame:
    return read_sales_lines(spark, root).where(F.col("status") == status)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return _sales_lines(spark, root, ACCEPTED).select(*CURATED["sales_fact"].names)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Quarantined sales lines, with the ids as delivered and the names of the missing keys."""
    return _sales_lines(spark, root, REJECTED).drop("status", "month_key")


def open_star(spark: SparkSession, root: str, rows: dict[str, int] | None = None) -> Star:
    dims = {d: read_table(spark, f"{root}/{t}") for d, t in DIM_TABLES.items()}
    return Star(fact=read_fact(spark, root), rows=dict(rows or {}), **dims)
