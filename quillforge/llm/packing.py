"""Filling fixed-capacity containers by minimum bin slack.

Items are spread by hash over windows of about ``WINDOW`` items.  In a window
the remaining items are a multiset of lengths.  For each container the largest
remaining item is placed first; a bitset subset-sum (one integer, bit s set if
the sum s can be reached) over the other lengths and their counts finds the
sum closest to the remaining capacity, and the count of each length is read
back from the stored bitsets.  An item longer than the capacity is cut into
full containers and one rest, which is packed like any other item.

Windows have a bounded size and are independent, so the work is linear in the
corpus; each window leaves at most one badly filled container.

Defined cases: an item of size 0 or null (an empty or null text) takes no
space and gets the container id null; equal sizes are placed by id; repeated
ids are separate items; an empty table gives an empty result; further columns
are not touched.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillforge.session import ship

CAPACITY = 2048
WINDOW = 4096


def best_fill(lengths: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """(length, count) whose sum is the largest possible up to ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length, count in lengths:
        if length > room:
            continue
        before, left, chunk = reach, min(count, room // length), 1
        while left:  # counts in powers of two
            take = min(chunk, left)
            reach |= (reach << (take * length)) & mask
            left -= take
            chunk *= 2
        steps.append((length, count, before))
        if reach >> room:
            break
    total, out = reach.bit_length() - 1, []
    for length, count, before in reversed(steps):
        used = 0
        while not (before >> total) & 1:
            total -= length
            used += 1
        if used:
            out.append((length, used))
    return out


def pack(sizes: list[int], capacity: int) -> list[int]:
    """The container number of each item; every size is between 1 and the capacity."""
    where: dict[int, list[int]] = {}
    for i in sorted(range(len(sizes)), key=lambda i: (sizes[i], i), reverse=True):
        where.setdefault(sizes[i], []).append(i)
    lengths = list(where)  # longest first
    out, bin_no = [0] * len(sizes), 0
    while lengths:
        first = lengths[0]
        out[where[first].pop()] = bin_no
        rest = [(n, len(where[n])) for n in lengths if where[n]]
        for n, used in best_fill(rest, capacity - first):
            for _ in range(used):
                out[where[n].pop()] = bin_no
        lengths = [n for n in lengths if where[n]]
        bin_no += 1
    return out


def containers(items: DataFrame, key: str = "doc_id", size: str = "n_tokens", capacity: int = CAPACITY, window: int = WINDOW) -> DataFrame:
    """``key, piece, start, n_tokens, container_id``: one row per piece of an item."""
    ship(items.sparkSession)
    kind = items.schema[key].dataType.simpleString()
    base = items.select(key, F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("n"))
    pieces = base.select(
        key,
        F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("n") - 1, F.lit(0)), F.lit(capacity).cast("bigint"))).alias("piece", "start"),
        "n",
    ).select(key, "piece", "start", F.least(F.col("n") - F.col("start"), F.lit(capacity)).cast("bigint").alias("n_tokens"))
    n_windows = max(1, -(-pieces.count() // window))
    # The window follows from the item alone: how rows lie in files, and a task run again, change nothing.  Rows that repeat an
    # item are alike, so they are counted and numbered; the numbers of a great many are spread before they become rows again.
    counted = pieces.groupBy(key, "piece", "start", "n_tokens").agg(F.count("*").alias("copies"))
    runs = counted.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(window).cast("bigint"))))
    copy = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + window, F.col("copies")) - 1))
    pieces = runs.withColumn("copy", copy).select(key, "piece", "start", "n_tokens", F.pmod(F.xxhash64(key, "piece", "copy"), F.lit(n_windows)).alias("window"))
    # Windows stay apart: partitions of windows are not merged by their few bytes.
    settings = items.sparkSession
    tasks = 4 * max(int(settings.conf.get("spark.sql.shuffle.partitions")), settings.sparkContext.defaultParallelism)
    pieces = pieces.repartition(min(n_windows, tasks), "window")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "piece", "n_tokens"], kind="stable", ignore_index=True)
        full = (pdf["n_tokens"] > 0).to_numpy()
        ids = pd.array([None] * len(pdf), dtype="Int64")
        ids[full] = pack(pdf.loc[full, "n_tokens"].tolist(), capacity)
        w = int(pdf["window"].iloc[0]) if len(pdf) else 0
        return pdf.assign(container_id=ids * n_windows + w)[[key, "piece", "start", "n_tokens", "container_id"]]

    schema = f"{key} {kind}, piece int, start bigint, n_tokens bigint, container_id bigint"
    return pieces.groupBy("window").applyInPandas(run, schema)


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Containers, tokens, unused space and the least possible number of containers."""
    bins = packed.filter(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.sum("n_tokens").alias("used"))
    return bins.agg(
        F.count("*").alias("containers"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.lit(capacity) - F.col("used")), F.lit(0)).alias("unused"),
        F.coalesce(F.max("used"), F.lit(0)).alias("fullest"),
        F.ceil(F.coalesce(F.sum("used"), F.lit(0)) / F.lit(capacity)).cast("bigint").alias("least_containers"),
    )
