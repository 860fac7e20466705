"""Sharding by a minimax contiguous partition.

Documents with equal texts form one atomic group; groups stand in the order of their first doc_id. The smallest shard
capacity that lets a greedy cut end within the given number of shards is found by binary search; the cuts of that greedy
pass are the shards. The search never sees the list of groups: the driver holds a bounded sketch of the running sums
(for each of at most CELLS ranges the smallest and the largest sum that occurs), decides what the sketch can decide, and
asks Spark for finer ranges where it can't, until the capacity and all cuts are exact.

Nulls: a null text counts as the empty text (size 1). Null doc_ids come first. Repeated rows are rows of their own.
An empty table gives no rows. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.common import join_to_key, running_totals, stored, table, with_offsets

CELLS = 16_384


class Sketch:
    """Sorted, disjoint ranges of running sums; of each, the smallest and the largest sum that occurs."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high, self.total = low, high, int(high[-1]) if len(high) else 0

    def last_at_most(self, t: int) -> tuple[int, int]:
        """Bounds of the largest running sum <= t."""
        i = int(np.searchsorted(self.low, t, side="right")) - 1
        if i < 0:
            return 0, 0
        high = int(self.high[i])
        return (high, high) if t >= high else (int(self.low[i]), t)

    def greedy(self, capacity: int, shards: int, best: bool) -> list[int]:
        """Ends of the shards, as far right as they can be (best) or must be."""
        ends, p = [], 0
        for _ in range(shards):
            p = self.last_at_most(p + capacity)[best]
            ends.append(p)
        return ends

    def capacity(self, shards: int, best: bool) -> int:
        """Smallest capacity whose greedy cut reaches the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if self.greedy(mid, shards, best)[-1] >= self.total else (mid + 1, high)
        return low

    def open_ranges(self, shards: int) -> tuple[list[int] | None, np.ndarray]:
        """The exact cuts, or None and which ranges have to be split for them."""
        c_low, c_high = self.capacity(shards, True), self.capacity(shards, False)
        low, high = self.greedy(c_low, shards, False), self.greedy(c_high, shards, True)
        if c_low == c_high and low == high:
            return low, np.zeros(0, bool)
        touched = np.zeros(len(self.low), bool)
        for a, b in zip([0, *low[:-1]], [0, *high[:-1]], strict=True):
            touched |= (self.low <= b + c_high) & (self.high >= a + c_low)
        return None, touched & (self.low < self.high)


def minimax_cuts(ends: DataFrame, column: str, shards: int, cells: int = CELLS) -> list[int]:
    """Running sums at which the shards end. ``ends`` has the running sum of every atomic group in ``column``."""
    end = F.col(column)
    first = ends.agg(F.min(end), F.max(end)).first()
    if first[0] is None:
        return [0] * shards
    sketch = Sketch(np.array([first[0]], np.int64), np.array([first[1]], np.int64))
    while True:
        cuts, split = sketch.open_ranges(shards)
        if cuts is not None:
            return cuts
        spans: list[list[int]] = []
        for i in np.flatnonzero(split):
            if spans and spans[-1][2] == i - 1:
                spans[-1][1:] = [int(sketch.high[i]), int(i)]
            else:
                spans.append([int(sketch.low[i]), int(sketch.high[i]), int(i)])
        width = -(-sum(b - a + 1 for a, b, _ in spans) // cells)
        cell, offset = F.lit(None).cast("long"), 0
        for a, b, _ in spans:
            cell = F.when(end.between(a, b), F.floor((end - a) / width) + offset).otherwise(cell)
            offset += (b - a) // width + 1
        found = ends.select(end.alias("e"), cell.alias("cell")).filter("cell is not null").groupBy("cell").agg(F.min("e").alias("a"), F.max("e").alias("b")).orderBy("a").collect()
        low = np.concatenate([sketch.low[~split], np.array([r["a"] for r in found], np.int64)])
        high = np.concatenate([sketch.high[~split], np.array([r["b"] for r in found], np.int64)])
        order = np.argsort(low, kind="stable")
        sketch = Sketch(low[order], high[order])


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot (gapless in its shard, by doc_id),
    shard_bytes_end (the running sum at which the document's group ends)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key"),
        ), "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"), F.count("*").alias("copies"))
    ends = running_totals(groups, ["first_id", "key"], "bytes", "shard_bytes_end")
    cuts = minimax_cuts(ends, "shard_bytes_end", shards)
    shard = sum((F.when(F.col("shard_bytes_end") > c, 1).otherwise(0) for c in cuts[:-1]), F.lit(0)).cast("int")
    keys = ends.select("key", "copies", "shard_bytes_end", shard.alias("shard"))
    placed = join_to_key(rows, keys, "key", "copies", rows.count()).drop("copies")

    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("key")]
    dealt = placed.select("doc_id", "size", "text_crc32", "key", "shard", "shard_bytes_end").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*dealt.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_slot", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken, part = np.zeros(shards, np.int64), TaskContext.get().partitionId()
        for b in batches:
            at, slot = b.column(4).to_numpy(zero_copy_only=False), np.zeros(b.num_rows, np.int64)
            for s in np.unique(at):
                mine = np.flatnonzero(at == s)
                slot[mine] = taken[s] + np.arange(len(mine))
                taken[s] += len(mine)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(slot)], names=schema.names)

    local = stored(dealt.mapInArrow(number, schema), "slots")
    per_part = local.groupBy("_part", "shard").agg(F.count("*").alias("n")).collect()
    return with_offsets(local, per_part, "_slot", "slot", "shard").select("doc_id", "size", "text_crc32", "shard", "slot", "shard_bytes_end")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "shard_bytes_end")
