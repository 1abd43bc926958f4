"""Data checks.  Each check is one report row: check, table, column, failing rows, sample.

``failing_rows`` 0 means the check holds.  The checks of a table run as Spark jobs and
only the one-row results come together.  ``run_checks`` runs many rules over many tables
in few passes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.scratch import stage

AT_ONCE = 4  # tables that are written at the same time


def _row(df: DataFrame, check: str, table: str, column: str, count: Column, sample: Column) -> DataFrame:
    return df.agg(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        count.alias("failing_rows"),
        sample.cast("string").alias("sample"),
    )


def unique(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Keys that occur more than once; nulls are not compared."""
    name = ", ".join(columns)
    text = F.concat_ws(", ", *[F.col(c).cast("string") for c in columns])
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = (
        df.where(present).groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
    )
    return _row(repeated, "unique", table, name, F.count("*"), F.min(text))


def not_null(df: DataFrame, table: str, *columns: str, key: str | None = None) -> DataFrame:
    """All columns in one pass; the sample is the least ``key`` of a row with a null."""
    shown = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    aggregates, entries = [], []
    for i, c in enumerate(columns):
        missing = F.col(c).isNull()
        aggregates += [
            F.count_if(missing).alias(f"_n{i}"), F.min(F.when(missing, shown)).alias(f"_s{i}")
        ]
        entries.append(
            F.struct(
                F.lit("not_null").alias("check"),
                F.lit(table).alias("table"),
                F.lit(c).alias("column"),
                F.col(f"_n{i}").alias("failing_rows"),
                F.col(f"_s{i}").alias("sample"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence) -> DataFrame:
    wrong = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return _row(wrong, "accepted_values", table, column, F.count("*"), F.min(column))


def relationship(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose key the parent table lacks; null keys are not compared.

    Rows are counted per key before the join, so a frequent key is one row in it.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("_n")
    )
    known = parent.select(F.col(parent_column).alias("_key"))
    orphans = keys.join(known, "_key", "left_anti")
    return _row(
        orphans, "relationships", table, column, F.coalesce(F.sum("_n"), F.lit(0)), F.min("_key")
    )


def must_be_empty(df: DataFrame, table: str, name: str) -> DataFrame:
    """Any frame of offending rows."""
    return _row(df, name, table, "", F.count("*"), F.lit(None))


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


# ---------------------------------------------------------------- fused checks


@dataclass(frozen=True)
class Rule:
    """One check of a table.  ``columns`` is what is checked; a relationship names its
    ``parent`` table and column, accepted values their ``values``, a rule of one's own an
    SQL ``failing`` condition."""

    kind: str
    table: str
    columns: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    values: tuple = ()
    failing: str = ""
    key: str = ""

    @property
    def keyed(self) -> bool:
        return self.kind in ("unique", "relationships")


def _keyed_entries(name: str, df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame | None:
    """(rule, hash, child, parent, key): an entry per row and keyed rule the table has a
    part in; a 64-bit hash stands for the key."""
    entries = []

    def entry(number: int, columns: Sequence[str], child: int, parent: int) -> None:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        text = F.concat_ws(", ", *[F.col(c).cast("string") for c in columns])
        made = F.struct(
            F.lit(number).alias("rule"),
            F.xxhash64(text).alias("hash"),
            F.lit(child).cast("long").alias("child"),
            F.lit(parent).cast("long").alias("parent"),
            text.alias("key"),
        )
        entries.append(F.when(present, made))

    for number, rule in rules:
        if rule.table == name:
            entry(number, rule.columns, 1, 0)
        if rule.kind == "relationships" and rule.parent == name:
            entry(number, [rule.parent_column], 0, 1)
    if not entries:
        return None
    return df.select(F.inline(F.array(*entries))).where("rule is not null")


def _all_entries(tables: Mapping[str, DataFrame], rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    entries = [_keyed_entries(name, df, rules) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, [e for e in entries if e is not None])


def _keyed_counts(tables: Mapping[str, DataFrame], rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """One aggregate for all unique and relationship checks; samples of failing keys are
    looked up only for the rules, and in the tables, that have any."""
    entries = _all_entries(tables, rules)
    uniques = [n for n, r in rules if r.kind == "unique"]
    is_unique = F.col("rule").isin(uniques) if uniques else F.lit(False)
    groups = entries.groupBy("rule", "hash").agg(
        F.sum("child").alias("child"), F.sum("parent").alias("parent")
    )
    wrong = F.when(is_unique, F.col("child") > 1).otherwise((F.col("parent") == 0))
    rows = F.when(is_unique, 1).otherwise(F.col("child"))
    failing = stage(groups.where(wrong).select("rule", "hash", rows.alias("failing_rows")), "failing")
    counts = failing.groupBy("rule").agg(F.sum("failing_rows").alias("failing_rows"))
    found = {row[0] for row in failing.select("rule").distinct().collect()}  # at most the rules
    if not found:
        return counts.withColumn("sample", F.lit(None).cast("string"))
    # numbers come in their own order, unique checks in that of the text, as alone
    number = F.when(~is_unique, F.col("key").try_cast("double"))
    least = F.min(F.struct(number.alias("number"), F.col("key").alias("text")))["text"]
    own = {name: df for name, df in tables.items() if any(n in found and r.table == name for n, r in rules)}
    again = _all_entries(own, [(n, r) for n, r in rules if n in found])
    shown = again.where("child = 1").join(failing.select("rule", "hash"), ["rule", "hash"], "left_semi")
    samples = shown.groupBy("rule").agg(least.alias("sample"))
    return counts.join(F.broadcast(samples), "rule", "left")  # a row per rule


def _row_counts(df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """One aggregate for all checks that look at single rows."""
    aggregates, entries = [], []
    for number, rule in rules:
        column = F.col(rule.columns[0]) if rule.columns else F.lit(None)
        shown = F.col(rule.key) if rule.key else F.lit(None)
        if rule.kind == "not_null":
            fails = column.isNull()
        elif rule.kind == "accepted_values":
            fails, shown = column.isNotNull() & ~column.isin(list(rule.values)), column
        else:
            fails = F.coalesce(F.expr(rule.failing), F.lit(False))
        aggregates += [
            F.count_if(fails).alias(f"_n{number}"),
            F.min(F.when(fails, shown)).cast("string").alias(f"_s{number}"),
        ]
        entries.append(
            F.struct(
                F.lit(number).alias("rule"),
                F.col(f"_n{number}").alias("failing_rows"),
                F.col(f"_s{number}").alias("sample"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))


def run_checks(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """All rules as report rows, each table derived once.

    The columns that rules of a table name are written once.  All checks of single rows of
    a table are one aggregate over them, and the unique and relationship checks of all
    tables are one aggregate over their keys, which meet per task before the shuffle; a
    key held by a third of the rows is one entry per task in it.
    """
    numbered = list(enumerate(rules))
    used: dict[str, set[str]] = {}
    for _, rule in numbered:
        columns = used.setdefault(rule.table, set())
        columns.update(rule.columns)
        if rule.key:
            columns.add(rule.key)
        if rule.kind == "relationships":
            used.setdefault(rule.parent, set()).add(rule.parent_column)
    # a rule of one's own may name any column
    own = {rule.table for _, rule in numbered if rule.failing}
    def write(name: str) -> tuple[str, DataFrame]:
        wanted = tables[name] if name in own else tables[name].select(*sorted(used[name]))
        return name, stage(wanted, f"checked-{name}")

    spark = next(iter(tables.values())).sparkSession
    with ThreadPool(AT_ONCE) as pool:
        narrow = dict(pool.map(inheritable_thread_target(spark)(write), list(used)))
    parts = []
    for name, df in narrow.items():
        mine = [(n, r) for n, r in numbered if r.table == name and not r.keyed]
        if mine:
            parts.append(_row_counts(df, mine))
    keyed = [(n, r) for n, r in numbered if r.keyed]
    if keyed:
        parts.append(_keyed_counts(narrow, keyed))
    names = [(n, r.kind, r.table, ", ".join(r.columns)) for n, r in numbered]
    listed = spark.createDataFrame(names, "rule int, check string, table string, column string")
    counted = reduce(DataFrame.unionAll, parts)  # a row per rule
    return listed.join(F.broadcast(counted), "rule", "left").select(
        "check", "table", "column", F.coalesce("failing_rows", F.lit(0)).alias("failing_rows"), "sample"
    )
