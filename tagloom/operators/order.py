"""Global positions and running totals without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range, about.
RANGE = 200_000


def ranges(df: DataFrame, *order: str, rows: int | None = None) -> DataFrame:
    """df dealt by ranges of the order columns, with `__r`: the range, increasing with the order.

    Spark samples the cut points over whole values, whatever their type or common beginnings; equal rows share a range.
    """
    n = df.count() if rows is None else rows
    parts = max(1, -(-n // RANGE))
    return df.repartitionByRange(parts, *order).withColumn("__r", F.spark_partition_id())


def global_row_number(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """df with `row`, the position in the order of the columns, which must tell rows apart; and the number of rows.

    Ranges are written once, counted, and numbered each on its own; the counts are a row for RANGE rows.
    """
    from tagloom.plans.session import checkpointed

    dealt = checkpointed(ranges(df, *order))
    counts = dealt.groupBy("__r").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    counts = checkpointed(counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    total = counts.agg(F.sum("__n").alias("n")).first()["n"] or 0
    place = F.row_number().over(Window.partitionBy("__r").orderBy(*order))
    return dealt.join(counts.drop("__n"), "__r").withColumn("row", (F.col("__before") + place).cast("long")).drop("__r", "__before"), total


def running(df: DataFrame, order: list, value: str, *, add: dict[str, str]) -> DataFrame:
    """df with running totals over the whole order: names of `add` to "count" or "sum" (of value), current row included; and `total`.

    order: columns of df (ascending). Each range sums on its own; earlier ranges' sums come from a row for each range.
    """
    from tagloom.plans.session import checkpointed

    dealt = checkpointed(ranges(df, *order))
    per = dealt.groupBy("__r").agg(F.count("*").alias("__n"), F.sum(value).alias("__s"))
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__nb"), F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__sb"), F.sum("__s").over(Window.partitionBy()).alias("total"))
    inner = Window.partitionBy("__r").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    exprs = {"count": F.col("__nb") + F.count("*").over(inner), "sum": F.col("__sb") + F.sum(value).over(inner)}
    return dealt.join(per, "__r").withColumns({name: exprs[kind] for name, kind in add.items()}).drop("__r", "__nb", "__sb")
