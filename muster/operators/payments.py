"""Payments of a run: who reaches an address, which transfers count, and their summary (JN-11, JN-12, JN-13, JN-22, S-AUTH, VRD-12,
AGG-12, AGG-13, AGG-19).

Values are unsigned numbers of 128 bits as texts. Addresses are compared in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.functions.scalar import DEAD, ZERO
from muster.operators.sellers import MOST, digits

#: The first topic of an AuthorizationUsed event. (A fixed value.)
AUTHORIZED = "0x98de503528ee59b575ef0c0a2576a82497bfc029a5685b209e9ec333479b10a5"
LIMB = 18


def halves(value: Column) -> tuple[Column, Column]:
    """An amount's high and low digits (LIMB of them) as decimals, for no decimal holds 39; what is no amount counts as 0."""
    text = F.coalesce(digits(value), F.lit("0"))
    size = F.length(text)
    return F.when(size > LIMB, F.substring(text, F.lit(1), size - LIMB)).otherwise("0").cast("decimal(38,0)"), F.substring(text, -LIMB, LIMB).cast("decimal(38,0)")


def whole(high: Column, low: Column) -> Column:
    """The digits of high * 10**LIMB + low, at most 2**128 - 1."""
    total_high, total_low, unit = F.coalesce(high, F.lit(0)), F.coalesce(low, F.lit(0)), F.lit(10**LIMB).cast("decimal(38,0)")
    low_text = F.lpad(F.pmod(total_low, unit).cast("decimal(38,0)").cast("string"), LIMB, "0")
    carried = (total_high + F.floor(total_low / unit)).cast("decimal(38,0)").cast("string")
    out = F.regexp_replace(F.concat(carried, low_text), "^0+(?=[0-9])", "")
    over = (F.length(out) > len(MOST)) | ((F.length(out) == len(MOST)) & (out > MOST))
    return F.when(over, MOST).otherwise(out)


def exact_sum(value: Column) -> Column:
    """The sum of a group's amounts as digits, at most 2**128 - 1."""
    high, low = halves(value)
    return whole(F.sum(high), F.sum(low))


def authorizers(logs: DataFrame) -> DataFrame:
    """S-AUTH, JN-22: (token, tx_hash, authorizer) of the first authorization (by log_index) of each token in a transaction. ``logs``:
    (token, tx_hash, log_index, topics array<string>); the address is the last 20 bytes of the second topic."""
    used = logs.filter((F.lower(F.get("topics", F.lit(0))) == AUTHORIZED) & (F.size("topics") > 1))
    first = used.groupBy(F.lower("token").alias("token"), "tx_hash").agg(F.min(F.struct("log_index", F.get("topics", F.lit(1)).alias("topic"))).alias("f"))
    return first.select("token", "tx_hash", F.concat(F.lit("0x"), F.lower(F.right("f.topic", F.lit(40)))).alias("authorizer"))


def reached(transfers: DataFrame, targets: DataFrame, logs: DataFrame, owners: DataFrame) -> DataFrame:
    """JN-11, JN-12, JN-22: one row for each transfer and agent that its address belongs to.

    ``transfers``: (token, tx_hash, log_index, from, to, value_raw, block, is_contract); ``targets``: (address, agent_id, owner,
    mint_block), several agents may share an address; ``owners``: (owner) of the run. Adds direction, counterparty, authorizer,
    x402 and payer_is_owner."""
    moved = transfers.withColumns({"from": F.lower("from"), "to": F.lower("to"), "token": F.lower("token")})
    aimed = targets.select(F.lower("address").alias("address"), "agent_id", F.lower("owner").alias("agent_owner"), "mint_block")
    came = moved.join(aimed, F.col("to") == F.col("address")).withColumns({"direction": F.lit("in"), "counterparty": F.col("from")})
    went = moved.join(aimed, F.col("from") == F.col("address")).withColumns({"direction": F.lit("out"), "counterparty": F.col("to")})
    known = owners.select(F.lower("owner").alias("counterparty")).distinct().withColumn("_own", F.lit(True))
    out = came.unionByName(went).join(authorizers(logs), ["token", "tx_hash"], "left").join(known, "counterparty", "left")
    return out.withColumns({"x402": F.col("authorizer").isNotNull(), "payer_is_owner": F.coalesce("_own", F.lit(False))}).drop("_own")


def classified(rows: DataFrame) -> DataFrame:
    """VRD-12: ``exclusion``, why a transfer isn't counted (null if it is); the first rule that holds."""
    burns = lambda c: F.col(c).isin(ZERO, DEAD)
    rule = (
        F.when(F.col("direction") == "out", "outgoing").when(burns("counterparty") | burns("address"), "burn_address").when(F.col("counterparty") == F.col("address"), "self_transfer")
        .when(F.col("counterparty") == F.col("agent_owner"), "owner_funding").when(F.col("mint_block").isNull(), "mint_block_unknown").when(F.col("block") < F.col("mint_block"), "pre_mint")
    )
    return rows.withColumn("exclusion", rule)


def summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """AGG-12, AGG-13: for each group of ``by``: addresses and agents paid, agents all of whose paid addresses are shared, agents
    paid by authorization, transfers and value from contracts, other senders and senders that weren't read, and the contract
    share in percent (null while any sender is unread, or without value).

    ``rows``: (address, agent_id, exclusion, x402, is_contract, value_raw). An address is shared if several agents have rows with it,
    excluded ones as well."""
    contract, counted = F.col("is_contract"), F.col("exclusion").isNull()
    kinds = {"contract": contract, "eoa": ~contract, "unread": contract.isNull()}
    high, low = halves(F.col("value_raw"))
    rows = rows.select(*by, F.lower("address").alias("address"), "agent_id", "x402", "is_contract", counted.alias("counted"), high.alias("_h"), low.alias("_l"))
    # one row for each address and agent; everything else is summed from these
    of = {n: F.col("counted") & k for n, k in kinds.items()}
    sums = [F.sum(F.when(k, F.col(f"_{x}"))).alias(f"{x}_{n}") for n, k in of.items() for x in "hl"]
    each = rows.groupBy(*by, "address", "agent_id").agg(F.count(F.when(F.col("counted"), 1)).alias("n"), F.max(F.col("counted") & F.col("x402")).alias("x402"), *(F.count(F.when(k, 1)).alias(f"n_{n}") for n, k in of.items()), *sums)
    held = Window.partitionBy(*by, "address")
    first = F.row_number().over(held.orderBy(F.desc("n"), "agent_id")) == 1
    each = each.withColumns({"holders": F.count("agent_id").over(held), "first": first & (F.col("n") > 0)}).filter("n > 0")
    names = ["n", *(f"n_{n}" for n in kinds), *(f"{x}_{n}" for n in kinds for x in "hl")]
    agents = each.groupBy(*by, "agent_id").agg(F.bool_and(F.col("holders") > 1).alias("shared"), F.max("x402").alias("x402"), F.count(F.when(F.col("first"), 1)).alias("addresses"), *(F.sum(c).alias(c) for c in names))
    totals = agents.groupBy(*by).agg(
        F.sum("addresses").alias("addresses"), F.count("agent_id").alias("agents"), F.count(F.when(F.col("x402") & F.col("agent_id").isNotNull(), 1)).alias("x402_agents"), F.sum("n").alias("transfers"), *(F.sum(f"n_{n}").alias(f"n_{n}") for n in kinds),
        *(whole(F.sum(f"h_{n}"), F.sum(f"l_{n}")).alias(f"value_{n}") for n in kinds), F.count(F.when(F.col("shared"), 1)).alias("shared_agents"),
    )
    value = {n: F.col(f"value_{n}").cast("double") for n in kinds}
    pct = F.when(F.col("n_unread") == 0, value["contract"] * 100.0 / F.nullif(value["contract"] + value["eoa"], F.lit(0.0)))
    return totals.withColumns({"contract_pct": F.round(pct, 6)})


def with_senders(agents: DataFrame, registrations: DataFrame, senders: DataFrame) -> DataFrame:
    """JN-13: agents with the transaction that registered them and its sender; null where either wasn't read. A transaction with
    many registrations is looked up once."""
    return agents.join(registrations, "agent_id", "left").join(senders.dropDuplicates(["tx_hash"]), "tx_hash", "left")
