"""Packing by optimal length buckets: padding-minimal boundaries from the global histogram, then token-budget batches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets, and padded tokens a batch may hold.
BUCKETS, BUDGET = 16, 65_536
#: Lengths are exact up to twice this and rounded up to 1/GRID of their power of two above, so the histogram is bounded: at most
#: GRID * 63 lengths exist.
GRID = 128
#: Slices in which the documents of a bucket are numbered.
SLICES = 1_024


def rounded_up(length: Column) -> Column:
    """The length on the grid, at least 1: exact up to 2 * GRID, then GRID steps in each power of two. Whole-number arithmetic."""
    n = F.greatest(length.cast("bigint"), F.lit(1).cast("bigint"))
    bits = F.length(F.bin(n - 1))  # n - 1 < 2^bits
    shift = F.greatest(bits - GRID.bit_length(), F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    last = n + step - 1
    return last - F.pmod(last, step)


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` ranges over sorted lengths that make the total of (bound - length) * count least.

    Dynamic programming over (bucket, last length): cost of a range is bound * documents - tokens, from prefix sums. Of equal
    splits the one with the smaller bounds is taken.
    """
    h = len(lengths)
    if not h:
        return []
    docs = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    best = lengths * docs[1:]  # one bucket: padded tokens up to each length; the tokens themselves are the same for every split
    cut = np.zeros((min(buckets, h), h), np.int64)
    for k in range(1, len(cut)):
        new = best.copy()
        for j in range(k, h):
            tried = best[k - 1 : j] + lengths[j] * (docs[j + 1] - docs[k : j + 1])
            i = int(tried.argmin())
            if tried[i] < new[j]:
                new[j], cut[k, j] = tried[i], i + k
        best = new
    out, j = [], h - 1
    for k in range(len(cut) - 1, -1, -1):
        out.append(int(lengths[j]))
        if cut[k, j]:
            j = int(cut[k, j]) - 1
        elif k == 0:
            break
        else:
            out.pop()  # this bucket is not used
    return sorted(set(out))


def pack(docs: DataFrame, length: Column, keep: tuple[str, ...] = ("doc_id",), buckets: int = BUCKETS, budget: int = BUDGET, slices: int = SLICES) -> DataFrame:
    """Per row: the ``keep`` columns, length, bucket (from 0), bucket_length, batch (within the bucket, from 0), slot (within the batch).

    The padded size of a batch, its documents times bucket_length, is within ``budget``; a document longer than the budget makes a batch of its own.
    A null or zero length counts as 1 in the padding. Batches are full but for the last of each bucket. The order within a bucket is
    by slice, then by the ``keep`` columns; repeated rows get places of their own. An empty table gives no rows. Other columns are not read.
    Documents of a bucket are numbered by slices of a hash, with the slices' counts summed up, so no bucket is ever in one task.
    """
    named = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], F.coalesce(length.cast("bigint"), F.lit(0).cast("bigint")).alias("length"))
    sized = named.withColumn("grid", rounded_up(F.col("length")))
    histogram = sized.groupBy("grid").agg(F.count("*").alias("n")).toPandas().sort_values("grid")
    bounds = boundaries(histogram["grid"].to_numpy(np.int64), histogram["n"].to_numpy(np.int64), buckets) or [1]
    literal = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    keys = [F.col(f"k{i}") for i in range(len(keep))]
    placed = sized.withColumn("bucket", F.size(F.filter(literal, lambda b: b < F.col("grid")))).withColumn("slice", F.pmod(F.xxhash64(*keys, "length"), F.lit(slices)).cast("int"))
    # At most buckets * slices rows: their running sums are one small window, and they are small enough to broadcast.
    counts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("slice")) - F.col("n")
    counts = counts.select("bucket", "slice", before.alias("before"))
    own = Window.partitionBy("bucket", "slice").orderBy(*keys, "length")
    numbered = placed.withColumn("at", F.row_number().over(own) - 1).join(F.broadcast(counts), ["bucket", "slice"])
    bound = F.element_at(literal, F.col("bucket") + 1)
    room = F.greatest((F.lit(budget) / bound).cast("bigint"), F.lit(1).cast("bigint"))
    place = F.col("before") + F.col("at")
    return numbered.select(
        *[k.alias(c) for k, c in zip(keys, keep)], "length", "bucket", bound.alias("bucket_length"),
        ((place - F.pmod(place, room)) / room).cast("bigint").alias("batch"), F.pmod(place, room).alias("slot"),
    )
