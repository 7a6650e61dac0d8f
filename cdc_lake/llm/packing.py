"""Packing of documents into batches of a token budget, by optimal length buckets.

A bucket pads its documents to its boundary. The boundaries that pad least over the whole
corpus come from dynamic programming on the global histogram of lengths; a bucket's batches
then hold as many documents as the budget allows. Places in a bucket are dealt by counts per
(bucket, lane) and a running number inside each lane, so no task holds a whole bucket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import renamed, restored, stored

#: Tokens of a batch, padding included.
BUDGET = 16_384
BUCKETS = 16
#: Rows of a lane, about.
LANE_ROWS = 20_000


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` upper bounds that minimise padding, the greatest length last.

    ``lengths`` ascend. The cost of a bucket from i to j is ``lengths[j]`` times its rows less
    their tokens; tokens are the same for every choice, so padded sizes are compared. Optimal
    cuts move right with j, so each layer is solved by divide and conquer.
    """
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    size = np.asarray(lengths, np.float64)
    cost = size * rows[1:]  # one bucket for lengths 0..j
    cuts = []
    for _ in range(min(buckets, n) - 1):
        better, cut = cost.copy(), np.zeros(n, np.int64)
        spans = [(0, n - 1, 0, n - 1)]
        while spans:
            low, high, first, last = spans.pop()
            if low > high:
                continue
            j = (low + high) // 2
            starts = np.arange(max(first, 1), min(last, j) + 1)  # the last bucket is start..j
            best = first
            if len(starts):
                costs = cost[starts - 1] + size[j] * (rows[j + 1] - rows[starts])
                k = int(costs.argmin())
                best = int(starts[k])
                better[j], cut[j] = costs[k], best
            spans += [(low, j - 1, first, best), (j + 1, high, best, last)]
        cuts.append(np.where(better < cost, cut, 0))
        cost = np.minimum(better, cost)
    bounds, j = [], n - 1
    for cut in reversed(cuts):
        bounds.append(int(lengths[j]))
        if not cut[j]:
            break
        j = cut[j] - 1
    else:
        bounds.append(int(lengths[j]))
    return sorted(set(bounds))


def pack(sized: DataFrame, budget: int = BUDGET, buckets: int = BUCKETS, key: str = "doc_id", length: str = "n_tokens") -> DataFrame:
    """Columns of ``sized`` and ``bucket_len, batch_id, slot, padding``; a row per row.

    A batch is a number inside its bucket: (``bucket_len``, ``batch_id``) names it, ``slot``
    counts from 0. A document longer than ``budget`` is a batch of its own, padded by nothing;
    null lengths count as 0, and empty documents are padded like others. Rows of equal key
    get different places. An empty table gives an empty result. Other columns may have any
    names; one named like a result gives way to it.

    The driver holds the histogram: one row per length up to ``budget``.
    """
    made = ["bucket_len", "batch_id", "slot", "padding"]
    sized, names = renamed(sized)
    key, size = names[key], F.coalesce(F.col(names[length]), F.lit(0)).cast("long")
    histogram = sized.where(size <= budget).groupBy(size.alias("_size")).agg(F.count("*").alias("_rows")).orderBy("_size").toPandas()
    bounds = boundaries(histogram["_size"].to_numpy(), histogram["_rows"].to_numpy(), buckets)
    total = int(histogram["_rows"].sum()) + sized.where(size > budget).count()
    bucket = F.lit(None).cast("long")
    for bound in reversed(bounds):
        bucket = F.when(size <= bound, F.lit(bound).cast("long")).otherwise(bucket)
    rows = sized.withColumn("_size", size).withColumn("_bucket", F.coalesce(bucket, "_size"))  # longer ones by their length

    lanes = max(1, total // LANE_ROWS)
    dealt = rows.withColumn("_lane", F.pmod(F.xxhash64(key, "_size"), F.lit(lanes)).cast("int"))
    held = dealt.groupBy("_bucket", "_lane").agg(F.count("*").alias("_rows"))
    before = held.withColumn("_before", F.sum("_rows").over(Window.partitionBy("_bucket").orderBy("_lane")) - F.col("_rows"))
    before = stored(before.select("_bucket", "_lane", "_before"), "lanes")
    placed = dealt.withColumn("_nth", F.row_number().over(Window.partitionBy("_bucket", "_lane").orderBy(key, "_size")) - 1)
    placed = placed.join(before, ["_bucket", "_lane"]).withColumn("_place", F.col("_nth") + F.col("_before"))
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest("_bucket", F.lit(1))), F.lit(1)).cast("long")
    return placed.select(
        *restored(names, made), F.col("_bucket").alias("bucket_len"), F.floor(F.col("_place") / capacity).alias("batch_id"),
        F.pmod("_place", capacity).cast("long").alias("slot"), (F.col("_bucket") - F.col("_size")).alias("padding"),
    )
