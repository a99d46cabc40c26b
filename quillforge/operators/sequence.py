"""Carrying values along an order without putting a whole group into one task.

A group (a bank, a sheet) may hold a large share of all rows.  Its rows are
cut into chunks by their first order column; each chunk is ordered by itself,
the last value of every chunk is one small row, and what the chunks before
left is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4_096


def with_last(rows: DataFrame, value: Column, within: list[str], order: list[str], out: str, inclusive: bool = True) -> DataFrame:
    """Adds ``out``: the last non-null ``value`` up to (or before) each row of its group.

    ``order`` starts with a number; nulls come first.
    """
    rows = rows.withColumns({"_chunk": F.floor(F.coalesce(F.col(order[0]).cast("bigint"), F.lit(-1)) / CHUNK), "_value": value})
    local = Window.partitionBy(*within, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    ends = rows.groupBy(*within, "_chunk").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(*within).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*(F.col(c).alias(f"_e_{c}") for c in within), F.col("_chunk").alias("_e_chunk"), F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    on = F.col("_chunk") == F.col("_e_chunk")
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    joined = rows.withColumn("_local", F.last("_value", ignorenulls=True).over(local)).join(ends, on, "left")
    return joined.withColumn(out, F.coalesce("_local", "_carry")).drop("_chunk", "_value", "_local", "_carry", "_e_chunk", *(f"_e_{c}" for c in within))
