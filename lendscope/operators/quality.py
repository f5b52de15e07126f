"""Key, reference and not-null rules as violation rows (table, rule, key, rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions.numbers import count_if


def _text(columns: list[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]
    return F.concat_ws("|", *parts)


def unique_violations(frame: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Keys held by more than one row."""
    rule = "unique(" + ",".join(keys) + ")"
    return (
        frame.groupBy(*keys)
        .agg(F.count("*").alias("rows"))
        .filter(F.col("rows") > 1)
        .select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), _text(keys).alias("key"), "rows")
    )


def reference_violations(
    frame: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, parent_column: str
) -> DataFrame:
    """Values without a parent row; NULL refers to nothing and passes.

    Values are counted before the join, so a value with very many rows is one
    row there.
    """
    used = frame.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_ref")).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_column).alias("_ref"))
    return used.join(known, "_ref", "left_anti").select(
        F.lit(table).alias("table_name"),
        F.lit(f"{column} -> {parent_table}.{parent_column}").alias("rule"),
        F.col("_ref").cast("string").alias("key"),
        "rows",
    )


def null_violations(frame: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows per required column that are NULL, in one pass over the table."""
    counts = frame.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot([], columns, "column", "rows")
        .filter(F.col("rows") > 0)
        .select(
            F.lit(table).alias("table_name"),
            F.lit("not null").alias("rule"),
            F.col("column").alias("key"),
            "rows",
        )
    )


def rule_report(
    tables: dict[str, DataFrame],
    unique: dict[str, tuple[str, ...]],
    references: dict[str, tuple[tuple[str, str, str], ...]],
    required: dict[str, tuple[str, ...]],
) -> DataFrame:
    """(table, rule, rows checked, rows in breach) for every rule.

    Keys and references are counted per value before they are compared, and a
    table's required columns in one pass.
    """
    reports = []
    layout = "table_name", "rule", "rows_checked", "violations"

    def summed(values: DataFrame, table: str, rule: str, bad: Column) -> DataFrame:
        total = F.coalesce(F.sum("rows"), F.lit(0))
        breached = F.coalesce(F.sum(F.when(bad, F.col("rows"))), F.lit(0))
        return values.agg(total.alias("rows_checked"), breached.alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "rows_checked", "violations"
        )

    def counted(table: str, column: str) -> DataFrame:
        return tables[table].groupBy(F.col(column).alias("_ref")).agg(F.count("*").alias("rows"))

    for table, columns in unique.items():
        for column in columns:
            reports.append(summed(counted(table, column), table, f"unique({column})", F.col("rows") > 1))
    for table, links in references.items():
        for column, parent, parent_column in links:
            known = tables[parent].select(F.col(parent_column).alias("_ref"), F.lit(True).alias("_known"))
            used = counted(table, column).join(known, "_ref", "left")
            bad = F.col("_ref").isNotNull() & F.col("_known").isNull()
            reports.append(summed(used, table, f"{column} -> {parent}.{parent_column}", bad))
    for table, columns in required.items():
        nulls = tables[table].agg(F.count("*").alias("rows_checked"), *[count_if(F.col(c).isNull()).alias(c) for c in columns])
        rows = nulls.unpivot("rows_checked", list(columns), "rule", "violations")
        named = rows.withColumn("table_name", F.lit(table)).withColumn("rule", F.concat(F.lit("not null "), "rule"))
        reports.append(named.select(*layout))
    return reduce(DataFrame.unionByName, reports).select(*layout)


def all_violations(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
