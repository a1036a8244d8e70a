"""Sharding by longest-processing-time scheduling, with groups that must stay together.

A group is all rows of equal text; its size is the sum of theirs. Groups, sorted by size, go one by one to the
least-loaded shard through a heap. What the schedule needs of the groups is how many there are of each size, so the driver
gets that histogram: sizes that differ add up, so there are fewer than the square root of twice all bytes of them, at any
number of groups. Equal sizes are scheduled together: many equal items on a heap fill the shards like water, which is
computed in closed form and has the same outcome.

The schedule says for each size which ranks go to which shard. Groups are ranked within their size, rows within their
shard, both in slices (a hash decides; one slice for each SLICE_ROWS and for each 1/PARTS of all), so no task numbers
an unbounded set: a slice's first number is a running sum over a table of slices, of sizes + PARTS + groups / SLICE_ROWS
rows, or shards + PARTS + rows / SLICE_ROWS. Groups of at least 1/PARTS of all rows, PARTS at most, are broadcast to their rows;
the other groups are joined.

Result: one row per row: doc_id, size, text_crc32, law ("bytes"), shard, slot, grown_shard (null: another
shard count is another schedule). size is the text's UTF-8 bytes plus 16; a null text has none, its crc32
is that of no bytes, and null texts are a group apart from empty ones. Repeated rows and null ids each
have a slot of their own. Equal texts are told by their SHA-256. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from doclattice.session import materialize

SHARDS = 40
#: Rows that a task numbers on average.
SLICE_ROWS = 1_000_000
#: A slice is at most this part of all, on average.
PARTS = 1024
OVERHEAD = 16
#: Rows of a table that is broadcast, at most.
BROADCAST_ROWS = 1 << 17


def fill(loads: list[int], size: int, n: int) -> list[int]:
    """How many of n items of one size each shard gets, as they go one by one to the least-loaded shard, ties to the smaller number."""
    got = [0] * len(loads)
    if n <= 4 * len(loads):
        heap = [(load, s) for s, load in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(n):
            load, s = heap[0]
            got[s] += 1
            heapq.heapreplace(heap, (load + size, s))
        return got
    # Items start at loads below the level; count(level) of them.
    count = lambda level: sum(max(0, -((load - level) // size)) for load in loads)
    low, high = min(loads), max(loads) + size * (n + 1)
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if count(middle) <= n else (low, middle)
    got = [max(0, -((load - low) // size)) for load in loads]
    # The rest start at the level itself.
    rest = n - sum(got)
    for s, load in enumerate(loads):
        if rest and load + got[s] * size == low:
            got[s] += 1
            rest -= 1
    return got


def lpt(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, list[int], list[int]]]:
    """For each (size, groups), largest first: the first rank of each run of ranks, and the run's shard."""
    loads = [0] * shards
    out = []
    for size, n in sorted(histogram, reverse=True):
        got = fill(loads, size, n)
        loads = [load + size * g for load, g in zip(loads, got, strict=True)]
        taken = [s for s in range(shards) if got[s]]
        firsts = np.cumsum([0, *(got[s] for s in taken[:-1])]).tolist()
        out.append((size, firsts, taken))
    return out


def looked_up(rows: DataFrame, table: pd.DataFrame, schema: str, keys: list[str]) -> DataFrame:
    """rows joined with a table of the driver's: broadcast up to BROADCAST_ROWS rows, a plain join beyond."""
    made = rows.sparkSession.createDataFrame(table if len(table) else [], schema)
    return rows.join(F.broadcast(made) if len(table) <= BROADCAST_ROWS else made, keys)


def ranked(rows: DataFrame, keys: list[str], spread: list[str], slice_rows: int) -> tuple[DataFrame, pd.DataFrame]:
    """rows with `rank`, gapless from 0 within the keys, and the number of rows of each key. spread: columns that tell rows apart."""
    of_keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in keys)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n")).toPandas()
    if not len(sizes):
        return rows.withColumn("rank", F.lit(0).cast("long")), sizes
    each = max(1, min(slice_rows, int(sizes["n"].sum()) // PARTS))
    sizes["slices"] = -(-sizes["n"] // each)
    sliced = looked_up(rows, sizes[[*keys, "slices"]], f"{of_keys}, slices long", keys).withColumn("slice", F.pmod(F.xxhash64(*spread), F.col("slices"))).drop("slices")
    parts = sliced.groupBy(*keys, "slice").agg(F.count("*").alias("n")).toPandas().sort_values([*keys, "slice"])
    parts["before"] = parts.groupby(keys)["n"].cumsum() - parts["n"]
    within = sliced.withColumn("rank", F.row_number().over(Window.partitionBy(*keys, "slice").orderBy(*spread)))
    placed = looked_up(within, parts[[*keys, "slice", "before"]], f"{of_keys}, slice long, before long", [*keys, "slice"])
    return placed.withColumn("rank", (F.col("before") + F.col("rank") - 1).cast("long")).drop("slice", "before"), sizes


def shard_rows(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)), F.lit(b"")).alias("same"),
        F.monotonically_increasing_id().alias("place"),
    )
    rows = materialize(rows, "sized")
    groups = materialize(rows.groupBy("same").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    numbered, histogram = ranked(groups, ["bytes"], ["same"], slice_rows)
    plan = lpt([(int(r.bytes), int(r.n)) for r in histogram.itertuples()], shards)
    table = pd.DataFrame(plan, columns=["bytes", "firsts", "shards"])
    run = F.size(F.filter("firsts", lambda first: first <= F.col("rank"))) - 1
    homes = materialize(looked_up(numbered, table, "bytes long, firsts array<long>, shards array<int>", ["bytes"]).select("same", "n", F.get("shards", run).alias("shard")), "homes")
    total = rows.count()
    common = homes.where(F.col("n") * PARTS >= total).select("same", "shard")
    housed = rows.join(F.broadcast(common), "same", "left")
    rare = housed.where("shard is null").drop("shard").join(homes.where(F.col("n") * PARTS < total).select("same", "shard"), "same")
    housed = materialize(housed.where("shard is not null").unionByName(rare).drop("same"), "housed")
    placed, _ = ranked(housed, ["shard"], ["place"], slice_rows)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
