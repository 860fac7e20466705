"""Queries that write and read: archives, run stores and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.plans import census
from muster.sources import archive
from muster.sources.runs import RunStore
from muster.streaming.follow import Follower
from muster.streaming.tail import stream_dedup

census.QUERIES.setdefault("checks_all", ("checks", "select run_no, agent_id, rung, status, evidence from checks"))
census.QUERIES.setdefault("snapshots_all", ("snapshots", "select run_no, agent_id, owner from snapshots"))


def export_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive.nested(census.run("snapshots_all", spark, sf_dir), census.run("checks_all", spark, sf_dir))
    return rows.select("run_no", "agent_id", "owner", F.to_json("checks").alias("checks"))


def import_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archive as JSON, read it again: the same checks."""
    path = archive.new_path(spark, "archive")
    archive.write_archive(archive.nested(census.run("snapshots_all", spark, sf_dir), census.run("checks_all", spark, sf_dir)), path)
    return archive.read_archive(spark, path).select("run_no", "agent_id", "owner", "rung", "status", "evidence")


def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1, SNK-8, LIF-8, LIF-10: what readers see of four runs: 0 was published, and a republication of it stopped after one table,
    1 was replaced by its rungs 2 and 4, 2 by no checks at all, and 3 wasn't read completely."""
    store = RunStore(spark, archive.new_path(spark, "runs"))
    checks, snapshots = census.run("checks_all", spark, sf_dir), census.run("snapshots_all", spark, sf_dir)

    def tables(run: int, cond: str = "true") -> dict[str, DataFrame]:
        of = F.col("run_no") == run % 3
        return {"checks": checks.filter(of).filter(cond).drop("run_no"), "snapshots": snapshots.filter(of).drop("run_no")}

    for run in range(4):
        store.publish(str(run), tables(run), complete=run < 3, chain="c")
    store._write("0", "checks", tables(0, "rung = 1")["checks"])  # and no row that names it
    store.publish("1", tables(1, "rung in (2, 4)"))
    store.put("2", "checks", checks.limit(0).drop("run_no"))
    seen = store.table("checks", "agent_id long, rung int, status string").select("run", F.lit("checks").alias("kind"), "agent_id", "rung", "status")
    return seen.unionByName(store.table("snapshots", "agent_id long").select("run", F.lit("snapshots").alias("kind"), "agent_id", F.lit(None).cast("int").alias("rung"), F.lit(None).cast("string").alias("status")))


#: Chains of stream_follow: first head, last head, confirmations 3 for all; "quiet" has no events, and "late" is deployed at block 700.
HEADS = {"c0": (400, 1600), "c1": (900, 903), "c2": (2, 2), "late": (650, 1100), "quiet": (100, 1800)}


def stream_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-1, STR-2, STR-4, SRC-8: cursors and events of five chains whose heads move twice; 1,500 blocks, batches of 501."""
    path = archive.new_path(spark, "chain")
    of = F.when(F.col("event_id") % 50 == 0, "late").otherwise(F.concat(F.lit("c"), F.col("user_id") % 3))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        of.alias("chain"), F.md5(F.col("event_id").cast("string")).alias("tx_hash"), F.lit(0).alias("log_index"), (F.col("event_id") % 1500).cast("long").alias("block"),
        F.col("event_type").alias("event_name"), F.col("props").alias("payload"),
    )
    events.repartitionByRange("block").write.parquet(f"{path}/events")
    follower = Follower(spark, f"{path}/out", confirmations=3, deploy={"late": 700})
    for k in range(2):
        spark.createDataFrame([(c, h[k]) for c, h in HEADS.items()], "chain string, head long").write.mode("append").parquet(f"{path}/heads")
        follower.follow(f"{path}/events", f"{path}/heads")
    kept = follower.events().groupBy("chain").agg(F.count("*").alias("n"), F.countDistinct("tx_hash").alias("distinct_n"), F.max("block").alias("last_block"))
    none = F.lit(0).cast("long")
    return follower.cursors().join(kept, "chain", "left").select("chain", "cursor", F.coalesce("n", none).alias("n"), F.coalesce("distinct_n", none).alias("distinct_n"), "last_block")


def _census(body: str) -> str:
    return census.full_text(body, "checks snapshots", True)


QUERIES = {"export_nested": export_nested, "import_roundtrip": import_roundtrip, "stream_dedup": stream_dedup, "publish_replace": publish_replace, "stream_follow": stream_follow}
ORACLE_SQL = {
    "publish_replace": _census("select cast(run_no as varchar) as run, 'checks' as kind, agent_id, rung, status from checks where run_no = 0 or run_no = 1 and rung in (2, 4) union all select cast(run_no as varchar), 'snapshots', agent_id, null, null from snapshots"),
    "stream_follow": f"""with heads(chain, head, first) as (values {', '.join(f"('{c}', {h[1]}, {700 if c == 'late' else 0})" for c, h in HEADS.items())}),
        e as (select case when event_id % 50 = 0 then 'late' else 'c' || (user_id % 3) end as chain, event_id, event_id % 1500 as block from events),
        c as (select chain, greatest(head - 3, 0) as cursor, first from heads where greatest(head - 3, 0) >= first)
        select c.chain, cast(cursor as bigint) as cursor, count(event_id) as n, count(distinct event_id) as distinct_n, max(block) as last_block from c left join e on e.chain = c.chain and block between first and cursor group by c.chain, cursor""",
    "import_roundtrip": census.text("checks_all", True).replace("select run_no, agent_id, rung, status, evidence from checks", ", s as (" + census.VIEWS["snapshots"].replace("{events}", "events") + ") select c.run_no, c.agent_id, owner, rung, status, evidence from checks c join s on s.run_no = c.run_no and s.agent_id = c.agent_id"),
    "stream_dedup": "select user_id, event_type, count(*) as n from (select distinct event_id, user_id, event_type from events) x group by user_id, event_type",
}
