"""Data-quality checks: a check is a query for offending rows and passes when there are none.

Checks of one table are counted together: the groups that ``unique`` needs also carry the NULL
counts, so a view with a costly plan is evaluated once, not once per check. Keys and values are
grouped before anything else, which reduces them before the shuffle.
"""

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One declared check on a column of a table."""

    kind: str  # unique | not_null | accepted_values | relationships
    layer: str
    table: str
    column: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None  # table and column that the key has to occur in

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def repeated_keys(rows: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once. NULL is no key."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def missing(rows: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return rows.where(F.col(column).isNull())


def unexpected_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their number of rows. NULL is not compared."""
    return rows.where(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_parents(rows: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Keys that the parent table lacks, with their number of rows. NULL refers to nothing."""
    keys = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parents.select(F.col(parent_column).alias("_known"))
    return keys.join(known, F.col(column) == F.col("_known"), "left_anti")


def columns_of(tables: Mapping[str, DataFrame], name: str, *wanted: str) -> DataFrame:
    """Some columns of a table; tables that can be planned for less are."""
    of = getattr(tables, "columns", None)
    return of(name, *wanted) if of else tables[name].select(*wanted)


def offending(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The offending rows, keys or values of one check."""
    if check.kind == "not_null":
        return missing(tables[check.table], check.column)
    rows = columns_of(tables, check.table, check.column)
    if check.kind == "unique":
        return repeated_keys(rows, check.column)
    if check.kind == "accepted_values":
        return unexpected_values(rows, check.column, check.values)
    if check.kind == "relationships":
        table, column = check.parent
        return missing_parents(rows, check.column, columns_of(tables, table, column), column)
    raise ValueError(f"unknown kind of check: {check.kind}")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def as_failures(name: str, offenders: DataFrame, number: Column | None = None) -> DataFrame:
    """One row: the check and how many offenders it has."""
    failures = F.count(F.lit(1)) if number is None else F.coalesce(F.sum(number), F.lit(0))
    return offenders.agg(failures.cast("bigint").alias("failures")).select(F.lit(name).alias("check_name"), "failures")


def _together(rows: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of the NULL checks of a table and of at most one check that needs groups."""
    grouped = next((check for check in checks if check.kind != "not_null"), None)
    columns = {check.name: check.column for check in checks if check.kind == "not_null"}
    nulls = [F.count_if(F.col(column).isNull()).alias(name) for name, column in columns.items()]
    if grouped is None:
        counts = rows.agg(*nulls)
    else:
        value, n_rows = F.col("_value"), F.col("_n_rows")
        groups = rows.groupBy(F.col(grouped.column).alias("_value")).agg(F.count(F.lit(1)).alias("_n_rows"), *nulls)
        bad = n_rows > 1 if grouped.kind == "unique" else ~value.isin(*grouped.values)
        counts = groups.agg(
            F.count_if(value.isNotNull() & bad).alias(grouped.name),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in columns],
        )
    pairs = [F.struct(F.lit(c.name).alias("check_name"), F.col(c.name).alias("failures")) for c in checks]
    return counts.select(F.inline(F.array(*pairs)))


def failures_of(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check, ``check_name`` and ``failures``, whether it fails or not.

    Failures are rows, except for repeated keys and unexpected values, which count once each.
    """
    parts = []
    for table in dict.fromkeys(check.table for check in checks):
        own = [check for check in checks if check.table == table]
        in_groups = [check for check in own if check.kind in ("unique", "accepted_values")]
        joined = [check for check in own if check.kind == "relationships"]
        shared = [check for check in own if check.kind == "not_null"] + in_groups[:1]
        if shared:
            parts.append(_together(columns_of(tables, table, *{check.column for check in shared}), shared))
        parts += [_together(columns_of(tables, table, check.column), [check]) for check in in_groups[1:]]
        parts += [as_failures(check.name, offending(check, tables), F.col("n_rows")) for check in joined]
    return union_all(parts)


def flag_shares(rows: DataFrame, table: str, flags: Sequence[str]) -> DataFrame:
    """Share of rows that carry each flag, all flags in one scan."""
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(flag)).alias(flag) for flag in flags])
    return shares(counts, table, flags)


def shares(counts: DataFrame, table: str, flags: Sequence[str]) -> DataFrame:
    """The same from one row with ``n_rows`` and the number of flagged rows under each flag's name."""
    pairs = [F.struct(F.lit(flag).alias("flag"), F.col(flag).alias("flagged")) for flag in flags]
    return counts.select(F.lit(table).alias("table_name"), "n_rows", F.inline(F.array(*pairs))).withColumn(
        "share", F.when(F.col("n_rows") > 0, F.col("flagged").cast("double") / F.col("n_rows"))
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows per table and whether there are any. Files answer this from their footers."""
    return union_all(
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") > 0).alias("is_ready")
        )
        for name, rows in tables.items()
    )
