"""Agreement between two labelling runs, usage roll-up, attempts, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclattice.functions.text import canonical_sha256


def signature(annotations: Column) -> Column:
    """Order-free multiset of (move, sorted steps)."""
    return F.array_sort(F.transform(annotations, lambda a: F.struct(a["move"].alias("move"), F.array_sort(a["steps"]).alias("steps"))))


def compare_units(left: DataFrame, right: DataFrame, key: list[str], value: str = "signature") -> DataFrame:
    """Per key: on which sides it is and whether values agree. Null keys (plain blocks have no row) match each other."""
    one = left.select(*key, F.col(value).alias("__l"), F.lit(True).alias("__in_l"))
    two = right.select(*[F.col(k).alias(f"__key_{k}") for k in key], F.col(value).alias("__r"), F.lit(True).alias("__in_r"))
    both = one.join(two, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in key], "full_outer")
    shown = [F.when(F.col("__in_l").isNotNull(), F.col(k)).otherwise(F.col(f"__key_{k}")).alias(k) for k in key]
    on = lambda side: F.coalesce(side, F.lit(False))
    return both.select(*shown, on("__in_l").alias("in_left"), on("__in_r").alias("in_right"), (on("__in_l") & on("__in_r") & F.col("__l").eqNullSafe(F.col("__r"))).alias("matched"))


def agreement(units: DataFrame, group: list[str]) -> DataFrame:
    """Sums and the micro ratio; a unit on one side only counts as a mismatch."""
    count = lambda c: F.count_if(c).alias
    out = units.groupBy(*group).agg(F.count("*").alias("total"), count(F.col("matched"))("matched"), count(F.col("in_left") & ~F.col("in_right"))("left_only"), count(F.col("in_right") & ~F.col("in_left"))("right_only"))
    return out.withColumn("agreement", F.col("matched") / F.col("total"))


def last_valid(attempts: DataFrame, key: list[str], attempt: str, valid: str, most: int = 3) -> DataFrame:
    """Of each key the first valid attempt of the first `most`; keys without one are absent."""
    return attempts.where(F.col(valid) & (F.col(attempt) <= most)).groupBy(*key).agg(F.min(attempt).alias("attempt"))


def usage(calls: DataFrame, key: list[str], payload: str) -> DataFrame:
    """Sums of the integer leaves of JSON usage objects, by key and name."""
    parsed = calls.select(*key, F.explode(F.from_json(payload, "map<string,string>")).alias("name", "value"))
    whole = parsed.where(F.rlike("value", F.lit(r"^-?\d+$")))
    return whole.groupBy(*key, "name").agg(F.sum(F.col("value").cast("long")).alias("total"), F.count("*").alias("n"))


def with_attempt_rank(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    return rows.withColumn("attempt", F.row_number().over(Window.partitionBy(*key).orderBy(order)))


def freeze(documents: DataFrame, frozen: DataFrame | None, payload: str = "payload") -> DataFrame:
    """New snapshots: content hashes that aren't frozen yet, one row each. Snapshots are written once and never changed."""
    named = documents.withColumn("snapshot_id", canonical_sha256(payload)).where("snapshot_id is not null")
    new = named if frozen is None else named.join(frozen.select("snapshot_id"), "snapshot_id", "left_anti")
    return new.groupBy("snapshot_id").agg(F.first(payload).alias(payload))


def tampered(snapshots: DataFrame, payload: str = "payload") -> DataFrame:
    """Snapshots whose content no longer has their hash."""
    return snapshots.where(~canonical_sha256(payload).eqNullSafe(F.col("snapshot_id")))
