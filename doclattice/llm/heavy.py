"""Frequent n-grams of a whole corpus by mergeable Misra-Gries summaries.

Each task counts its n-grams exactly, subtracts the (K+1)-th largest count (1 at least) and sends what
stays positive: at most K rows a task. Sums of such summaries miss a count by at most N/(K+1) plus one a
task, N being all occurrences. What is kept has a summed count over N/K, so there are fewer than K
n-grams: that bound holds at any size of the corpus, and is why the table may be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclattice.session import materialize

#: K above. 2**17 hashes and counts are 2 MB.
HEAVY_MAX = 1 << 17
#: Occurrences that a task counts before it folds them into its summary.
FOLD_AT = 1_000_000


def _fold(parts: list[np.ndarray], keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new, n = np.unique(np.concatenate(parts), return_counts=True)
    both, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
    total = np.bincount(inverse, np.concatenate([counts, n]), len(both)).astype(np.int64)
    least = 1 if len(both) <= HEAVY_MAX else max(1, int(np.partition(total, -HEAVY_MAX - 1)[-HEAVY_MAX - 1]))
    total -= least
    return both[total > 0], total[total > 0]


def heavy_hitters(docs: DataFrame, columns: list[str], occurrences: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the frequent n-grams in ascending order, their counts, and N. occurrences yields arrays of hashes for a batch of the columns."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, parts, held, n = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0, 0
        for batch in batches:
            for found in occurrences(batch):
                parts.append(found)
                held += len(found)
                n += len(found)
                if held >= FOLD_AT:
                    keys, counts = _fold(parts, keys, counts)
                    parts, held = [], 0
        if parts:
            keys, counts = _fold(parts, keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keys, np.uint64(0)).view(np.int64)), pa.array(np.append(counts, 0)), pa.array(np.append(np.zeros(len(keys), np.int64), n))], ["key", "n", "seen"])

    sums = docs.select(*columns).mapInArrow(count, "key long, n long, seen long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))
    # The total sits in one row; with it the bound N/K is applied before anything reaches the driver.
    sums = materialize(sums, "heavy", small=True)
    total = sums.agg(F.sum("seen")).first()[0] or 0
    rows = sums.where((F.col("n") > total / HEAVY_MAX) & (F.col("n") > 1)).select("key", "n").toPandas()
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order], int(total)
