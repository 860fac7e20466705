"""Following a chain: raw events by block with a cursor, and the tail of new ids (STR-1 to STR-7, SNK-4, SNK-6, JN-10, SRC-4, SRC-6).

Events lie in files; the stream of ``blocks`` goes through them by the heads of the chains. ``foreachBatch`` writes rows whose key
isn't there yet, and then the cursor.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from muster.ship import ship
from muster.streaming.blocks import MOST, BlockSource

#: What names an event. (Fixed values.)
KEY = ["chain", "tx_hash", "log_index"]
#: Blocks of one partition of the events.
BUCKET = 100_000
EVENT = "chain string, tx_hash string, log_index int, block long, event_name string, payload string"


def resume_from(cursor: int | None, deploy_block: int) -> int:
    """STR-4: the block after the cursor, or the registry's first one."""
    return max(deploy_block, 0) if cursor is None else cursor + 1


def appended(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """SNK-4: the rows of ``new`` whose key isn't in ``old``, each key once."""
    return new.dropDuplicates(key).join(old.select(*key), key, "left_anti")


def raised(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """SNK-6: cursors that never go back."""
    return old.unionByName(new).groupBy(key).agg(F.max(value).alias(value))


def earliest(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """SRC-6: the first event of each id."""
    rest = [c for c in events.columns if c not in (key, *order)]
    return events.groupBy(key).agg(F.min(F.struct(*order, *rest)).alias("e")).select(key, *(F.col(f"e.{c}").alias(c) for c in (*order, *rest)))


@dataclass
class Follower:
    """STR-1 to STR-4: events and cursors under ``root``, driven by the heads of the chains.

    ``confirmations``: how deep a block must lie; ``deploy``: the first block of each chain; ``most``: blocks of a batch beyond its first.
    A batch writes its new events and then its cursors, so that one that is run again after a failure changes nothing. Events lie by
    chain and bucket of blocks, and a batch is compared with the buckets that it falls into, not with all history."""

    spark: SparkSession
    root: str
    confirmations: int = 0
    deploy: dict[str, int] = field(default_factory=dict)
    most: int = MOST

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def events(self) -> DataFrame:
        """All events that were written; none lies above its chain's cursor unless its batch was stopped before the cursor."""
        return self._read("events", f"{EVENT}, bucket long").drop("bucket").join(F.broadcast(self.cursors()), "chain").filter(F.col("block") <= F.col("cursor")).drop("cursor")

    def cursors(self) -> DataFrame:
        """The highest block of each chain that was read whole."""
        return self._read("cursors", "chain string, cursor long").groupBy("chain").agg(F.max("cursor").alias("cursor"))

    def take(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Write a batch's new events (rows with ``upto`` are marks of ranges that were read), then how far its chains were read."""
        batch = batch.persist()
        try:
            bucket = (F.col("block") - F.pmod("block", F.lit(BUCKET))).alias("bucket")
            rows = batch.filter("upto is null").select(*KEY, "block", "event_name", "payload", bucket)
            old = self._read("events", f"{EVENT}, bucket long").join(F.broadcast(batch.select("chain", bucket).distinct()), ["chain", "bucket"], "left_semi")
            appended(old, rows, KEY).write.partitionBy("chain", "bucket").mode("append").parquet(f"{self.root}/events")
            batch.filter("upto is not null").groupBy("chain").agg(F.max("upto").alias("cursor")).coalesce(1).write.mode("append").parquet(f"{self.root}/cursors")
        finally:
            batch.unpersist()

    def follow(self, path: str, heads: str) -> None:
        """Read as far as the heads allow, a batch after the other, and stop; the next call goes on where this one ended.

        ``path``: a folder of Parquet files of events; ``heads``: one of rows (chain, head)."""
        ship(self.spark)
        self.spark.dataSource.register(BlockSource)
        options = {"path": path, "heads": heads, "cursors": f"{self.root}/cursors", "confirmations": self.confirmations, "most": self.most, "deploy": json.dumps(self.deploy)}
        stream = self.spark.readStream.format("blocks").options(**options).load()
        query = stream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.root}/checkpoint").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()


@dataclass
class TailPlan:
    """STR-5: the ids to look at now, where the cursor goes, and how many are left for later."""

    ids: DataFrame
    next_cursor: int | None
    remaining: int


def plan_new_ids(spark: SparkSession, known: int | None, head: int | None, cap: int) -> TailPlan:
    """STR-5, SRC-4, SRT-7: ids above what is known up to the head, ``cap`` at most, ascending.

    Without a head nothing happens; without anything known the head is adopted and no id is looked at; the cursor never goes back."""
    if head is None:
        return TailPlan(spark.range(0), None, 0)
    if known is None:
        return TailPlan(spark.range(0), head, 0)
    if known >= head:
        return TailPlan(spark.range(0), known, 0)
    last = min(head, known + max(cap, 0))
    return TailPlan(spark.range(known + 1, last + 1), last, head - last)


def high_water(census: DataFrame, cursors: DataFrame, chain: str) -> int | None:
    """AGG-10: the highest id that a finished run or the cursor knows."""
    ids = census.filter(F.col("chain") == chain).agg(F.max("agent_id").alias("x")).unionByName(cursors.filter(F.col("chain") == chain).agg(F.max("cursor").alias("x")))
    return ids.agg(F.max("x")).first()[0]


def read_until_failure(results: DataFrame, known: int) -> tuple[DataFrame, int]:
    """STR-6: of a tick's results (agent_id, ok, ...), those below the first id that failed, and the cursor after them."""
    failed = results.filter(~F.col("ok")).agg(F.min("agent_id")).first()[0]
    good = results if failed is None else results.filter(F.col("agent_id") < failed)
    return good, good.agg(F.coalesce(F.max("agent_id"), F.lit(known))).first()[0]


def superseded(tail: DataFrame, snapshots: DataFrame) -> DataFrame:
    """STR-7, JN-10: ``tail`` with ``superseded_by`` set for agents that a finished run (chain, agent_id, run) has; a row that was
    superseded before keeps the run."""
    first = snapshots.groupBy("chain", "agent_id").agg(F.min("run").alias("_run"))
    out = tail.join(first, ["chain", "agent_id"], "left")
    return out.withColumn("superseded_by", F.coalesce("superseded_by", "_run")).select(*tail.columns)


def winning_gateway(attempts: str = "attempts"):
    """SRC-10: of ordered attempts (gateway, http_status, error), the first with a 2xx answer; null if all failed."""
    return F.get(F.filter(attempts, lambda a: a["error"].isNull() & a["http_status"].between(200, 299)), 0)
