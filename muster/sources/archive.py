"""Archives of a run: one JSON document per agent with its checks nested (SNK-2), and back (SRC-14)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "run_no int, agent_id long, owner long, checks array<struct<rung:int,status:string,evidence:string>>"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, or a local one where it is unset (tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return place or tempfile.mkdtemp(prefix="muster-", dir="/tmp")


def nested(snapshots: DataFrame, checks: DataFrame) -> DataFrame:
    """One row per snapshot with its checks in the order of their rungs; agents without checks have an empty array."""
    each = checks.groupBy("run_no", "agent_id").agg(F.array_sort(F.collect_list(F.struct("rung", "status", "evidence"))).alias("checks"))
    none = F.array().cast("array<struct<rung:int,status:string,evidence:string>>")
    return snapshots.join(each, ["run_no", "agent_id"], "left").withColumn("checks", F.coalesce("checks", none))


def write_archive(rows: DataFrame, path: str) -> None:
    rows.write.partitionBy("run_no").json(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(run_no, agent_id, owner, rung, status, evidence) of an archive, by an explicit schema."""
    return spark.read.schema(SCHEMA).json(path).select("run_no", "agent_id", "owner", F.inline("checks"))


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` in the shared folder and read it again."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
