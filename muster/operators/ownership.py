"""Who owned an agent when (AGG-38): transfers of agents against payments to them.

``moves``: (agent, block, log_index, owner), a row for each registry transfer, the mint first. ``payments``: (agent, block, payer, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from muster.operators.ordered import as_of


def holdings(moves: DataFrame) -> DataFrame:
    """agent, minted (block), transfers (after the mint), owner (now) and acquired (the block since which it has been this owner's)."""
    move = F.struct("block", "log_index", "owner")
    each = moves.groupBy("agent").agg(F.min(move).alias("first"), F.max(move).alias("last"), (F.count("*") - 1).alias("transfers"))
    return each.select("agent", F.col("first.block").alias("minted"), "transfers", F.col("last.owner").alias("owner"), F.col("last.block").alias("acquired"))


def owned_payments(payments: DataFrame, moves: DataFrame) -> DataFrame:
    """``payments`` with owner_then (null before the mint), owner, minted, acquired and ``standing``, the first that holds:

    pre_mint (before the agent was there), by_owner_then (the payer owned it at that time), before_acquisition (under an earlier
    owner), by_owner (the payer owns it now), and external."""
    rows = as_of(payments, moves.withColumn("owner_then", F.col("owner")), ["agent"], "block", ["log_index"], ["owner_then"], holdings(moves).drop("transfers"))
    standing = F.when(F.col("block") < F.col("minted"), "pre_mint").when(F.col("payer") == F.col("owner_then"), "by_owner_then").when(F.col("block") < F.col("acquired"), "before_acquisition")
    return rows.withColumn("standing", standing.when(F.col("payer") == F.col("owner"), "by_owner").otherwise("external"))


def exposure(payments: DataFrame, moves: DataFrame) -> DataFrame:
    """AGG-38: by standing, payments and agents that have one, and agents that have no other."""
    per = owned_payments(payments, moves).groupBy("agent", "standing").agg(F.count("*").alias("n"))
    per = per.withColumn("kinds", F.count("*").over(Window.partitionBy("agent")))
    return per.groupBy("standing").agg(F.sum("n").alias("payments"), F.count("*").alias("agents"), F.count(F.when(F.col("kinds") == 1, 1)).alias("agents_all"))
