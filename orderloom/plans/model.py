"""The tables of the model as a graph: who is made from whom, in what order, and by month.

A table names its parents and is built from their written copies, so each is computed
once, however many others read it.  Tables whose rows of a month follow from that month's
rows of their parents lie in month folders, and a change in some months rewrites those
folders only; all others are written anew.

Rows come to their month once, on the way into the first table in month folders.  Tables
made row by row from tables that lie so are written where they are read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "order_month"
AT_ONCE = 4  # tables that are written at the same time
CODEC = "zstd"  # texts and hashes take half the room
# Shuffle files go when their table is written.  A task keeps a file open per month, so that
# lines are not sorted, and spilled, to come to their folders; past so many months it sorts.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "32",
}


@dataclass(frozen=True)
class Table:
    """``build`` gets the parents' frames in order.  ``month_of`` names the time column of a
    table in month folders; its parents are sources or in month folders as well.
    ``row_by_row``: made from one parent without a shuffle, each row from one row of the
    same month."""

    name: str
    parents: tuple[str, ...]
    build: Callable[..., DataFrame]
    month_of: str | None = None
    row_by_row: bool = False


@dataclass(frozen=True)
class Source:
    """A frame from outside; ``month_of`` names its time column, if it has months."""

    frame: DataFrame
    month_of: str | None = None


def month_text(column: str):
    return F.date_format(column, "yyyy-MM")


def _to_months(frame: DataFrame, column: str) -> DataFrame:
    """A month is one task, unless it is large: then adaptive execution splits it."""
    return frame.withColumn(MONTH, month_text(column)).hint("rebalance", MONTH).drop(MONTH)


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@dataclass
class Model:
    tables: Sequence[Table]
    root: str
    _by_name: dict[str, Table] = field(init=False)

    def __post_init__(self) -> None:
        self._by_name = {t.name: t for t in self.tables}
        if len(self._by_name) != len(self.tables):
            raise ValueError("two tables of the model have the same name")

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def order(self, sources: Sequence[str]) -> list[Table]:
        """Parents before children, otherwise as given."""
        return [table for step in self.steps(sources) for table in step]

    def steps(self, sources: Sequence[str]) -> list[list[Table]]:
        """Tables that can be written at the same time, step by step; complains of what is
        missing or waits for itself."""
        done, waiting, found = set(sources), list(self.tables), []
        unknown = {p for t in waiting for p in t.parents} - done - set(self._by_name)
        if unknown:
            raise ValueError(f"no table or source is called {', '.join(sorted(unknown))}")
        while waiting:
            ready = [t for t in waiting if done.issuperset(t.parents)]
            if not ready:
                raise ValueError(f"tables wait for each other: {', '.join(t.name for t in waiting)}")
            found.append(ready)
            done.update(t.name for t in ready)
            waiting = [t for t in waiting if t.name not in done]
        return found

    def part(self, *names: str) -> Model:
        """The model of the named tables and all they are made from, in the same folder."""
        wanted, waiting = set(), list(names)
        while waiting:
            name = waiting.pop()
            if name in self._by_name and name not in wanted:
                wanted.add(name)
                waiting += self._by_name[name].parents
        return Model([t for t in self.tables if t.name in wanted], self.root)

    def _by_month(self, table: Table, sources: Mapping[str, Source]) -> bool:
        def has_months(name: str) -> bool:
            known = sources.get(name) or self._by_name[name]
            return known.month_of is not None

        return table.month_of is not None and all(has_months(p) for p in table.parents)

    def read(self, spark: SparkSession, name: str, months: Sequence[str] | None = None) -> DataFrame:
        """A written table, or some months of it: the others' folders are not opened."""
        found = spark.read.parquet(self.path(name))
        if months is not None:
            found = found.where(F.col(MONTH).isin(list(months)))
        return found.drop(MONTH)

    def write(self, spark: SparkSession, sources: Mapping[str, Source], months: Sequence[str] | None = None) -> None:
        """Write all tables, or bring them up to date after a change in some months.

        A month that has no rows any more loses its folder.
        """
        for month in months or ():
            if not re.fullmatch(r"\d{4}-\d\d", month):
                raise ValueError(f"a month is written as 2024-05, not {month}")
        def write_one(table: Table) -> None:
            some = months if months is not None and self._by_month(table, sources) else None
            parents = [self._parent(spark, sources, p, some) for p in table.parents]
            in_months = table.row_by_row and self._by_month(table, sources)
            if in_months and table.parents[0] in sources:
                parents = [_to_months(parents[0], sources[table.parents[0]].month_of)]
            frame = table.build(*parents)
            if table.month_of is None:
                frame.write.mode("overwrite").option("compression", CODEC).parquet(self.path(table.name))
            else:
                self._write_months(spark, table, frame, some, in_months)

        with _settings(spark, WRITING), ThreadPool(AT_ONCE) as pool:
            for step in self.steps(list(sources)):
                pool.map(inheritable_thread_target(spark)(write_one), step)

    def _parent(self, spark, sources: Mapping[str, Source], name: str, months) -> DataFrame:
        if name not in sources:
            return self.read(spark, name, months)
        source = sources[name]
        if months is None:
            return source.frame
        return source.frame.where(month_text(source.month_of).isin(list(months)))

    def _write_months(self, spark, table: Table, frame: DataFrame, months, in_months: bool) -> None:
        (
            (frame if in_months else _to_months(frame, table.month_of))
            .withColumn(MONTH, F.coalesce(month_text(table.month_of), F.lit("none")))
            .write.mode("overwrite")
            .option("compression", CODEC)
            .option("partitionOverwriteMode", "static" if months is None else "dynamic")
            .partitionBy(MONTH)
            .parquet(self.path(table.name))
        )
        if months is not None:
            self._drop_empty(spark, table.name, frame.select(month_text(table.month_of)), months)

    def _drop_empty(self, spark, name: str, written: DataFrame, months: Sequence[str]) -> None:
        present = {row[0] for row in written.distinct().collect()}  # at most the months asked for
        for month in set(months) - present:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/{MONTH}={month}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
