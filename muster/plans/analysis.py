"""Analysis queries over ordered data: ownership history, percentiles and cumulative shares, none of them with one task for a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators import ordered, ownership
from muster.plans import census

census.QUERIES.setdefault("transfer_values", ("transfers", "select verdict, payee, value_raw from transfers"))
census.QUERIES.setdefault("feedback_values", ("checks", "select run_no, cast($[json|evidence|k] as int) as k from checks"))
census.QUERIES.setdefault("host_counts", ("listings", "select host, count(*) as n from listings group by host"))
_DAYS = "date_diff('day', date '1992-01-01', {0}::date)"


def _day(column: str):
    return F.datediff(F.col(column).cast("date"), F.lit("1992-01-01").cast("date"))


def _moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agent for each customer, which each order hands to its clerk; the first one is the mint."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(F.col("o_custkey").cast("long").alias("agent"), _day("o_orderdate").cast("long").alias("block"), F.col("o_orderkey").cast("long").alias("log_index"), F.concat(F.lit("w"), F.col("o_orderkey") % 50).alias("owner"))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment to the supplier's number for each line; half of all lines go to agent 1."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    agent = F.when(F.col("l_orderkey") % 2 == 0, 1).otherwise(F.col("l_suppkey"))
    return lines.select(agent.cast("long").alias("agent"), _day("l_shipdate").cast("long").alias("block"), F.concat(F.lit("w"), F.col("l_partkey") % 50).alias("payer"), "l_orderkey", "l_linenumber")


def agents_transferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-38: agents that changed hands after their mint."""
    return ownership.holdings(_moves(spark, sf_dir)).filter("transfers > 0")


def payment_standing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-38: every payment with its owner at that time and its standing."""
    return ownership.owned_payments(_payments(spark, sf_dir), _moves(spark, sf_dir)).select("agent", "l_orderkey", "l_linenumber", "owner_then", "standing")


def ownership_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-38: how many payments and agents have each standing."""
    return ownership.exposure(_payments(spark, sf_dir), _moves(spark, sf_dir))


def paid_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-28: median and 90th percentile of transferred values by verdict."""
    return ordered.percentiles(census.run("transfer_values", spark, sf_dir), ["verdict"], "value_raw", {"median": 0.5, "p90": 0.9})


def feedback_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-21: percentiles, mean and range of the feedback values of a run."""
    rows = census.run("feedback_values", spark, sf_dir)
    rest = rows.groupBy("run_no").agg(F.min("k").alias("least"), F.max("k").alias("most"), F.round(F.avg("k"), 6).alias("mean"))
    return ordered.percentiles(rows, ["run_no"], "k", {"p50": 0.5, "p95": 0.95}).join(rest, "run_no")


def hosts_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-25, WIN-4: hosts by their endpoints, with their share and the share of all hosts so far."""
    hosts = census.run("host_counts", spark, sf_dir)
    total = hosts.agg(F.sum("n").alias("total"))
    rows = ordered.running_sum(hosts, [], [F.desc("n"), F.col("host")], "n", "so_far").crossJoin(F.broadcast(total))
    share = lambda c: F.round(F.col(c).cast("double") * 100 / F.col("total"), 6)
    return rows.select("host", "n", "so_far", share("n").alias("pct"), share("so_far").alias("cumulative_pct"))


_MOVES = f"m as (select o_custkey::bigint as agent, {_DAYS.format('o_orderdate')}::bigint as block, o_orderkey::bigint as log_index, 'w' || (o_orderkey % 50) as owner from orders)"
_STANDING = f"""{_MOVES}, p as (select case when l_orderkey % 2 = 0 then 1 else l_suppkey end::bigint as agent, {_DAYS.format('l_shipdate')}::bigint as block, 'w' || (l_partkey % 50) as payer, l_orderkey, l_linenumber from lineitem),
    last_of_day as (select agent, block, arg_max(owner, log_index) as owner from m group by agent, block),
    h as (select agent, min(block) as minted, max(block) as acquired from m group by agent),
    s as (select p.agent, l_orderkey, l_linenumber, p.block, payer, then_.owner as owner_then, now_.owner as owner, minted, acquired from p join h on h.agent = p.agent
        join last_of_day now_ on now_.agent = p.agent and now_.block = acquired asof left join last_of_day then_ on then_.agent = p.agent and then_.block <= p.block),
    st as (select *, case when block < minted then 'pre_mint' when payer = owner_then then 'by_owner_then' when block < acquired then 'before_acquisition' when payer = owner then 'by_owner' else 'external' end as standing from s)"""
QUERIES = {
    "agents_transferred": agents_transferred, "payment_standing": payment_standing, "ownership_exposure": ownership_exposure, "paid_medians": paid_medians,
    "feedback_percentiles": feedback_percentiles, "endpoint_kind_hosts_cumulative": hosts_cumulative,
}
ORACLE_SQL = {
    "agents_transferred": f"with {_MOVES}, r as (select *, row_number() over (partition by agent order by block, log_index) as k, row_number() over (partition by agent order by block desc, log_index desc) as back, count(*) over (partition by agent) as n from m) select a.agent, a.block as minted, a.n - 1 as transfers, b.owner, b.block as acquired from r a join r b on a.agent = b.agent where a.k = 1 and b.back = 1 and a.n > 1",
    "payment_standing": f"with {_STANDING} select agent, l_orderkey, l_linenumber, owner_then, standing from st",
    "ownership_exposure": f"with {_STANDING}, c as (select agent, standing, count(*) as n, count(*) over (partition by agent) as kinds from st group by agent, standing) select standing, cast(sum(n) as bigint) as payments, count(*) as agents, count(*) filter (where kinds = 1) as agents_all from c group by standing",
    "paid_medians": census.text("paid_medians", True),
    "feedback_percentiles": census.full_text("select run_no, percentile_cont(0.5) within group (order by k) as p50, percentile_cont(0.95) within group (order by k) as p95, min(k) as least, max(k) as most, round(avg(k), 6) as mean from (select run_no, cast($[json|evidence|k] as int) as k from checks) x group by run_no", "checks", True),
    "endpoint_kind_hosts_cumulative": census.full_text("select host, n, cast(sum(n) over w as bigint) as so_far, round(n * 100.0 / sum(n) over (), 6)::double as pct, round(cast(sum(n) over w as double) * 100 / sum(n) over (), 6) as cumulative_pct from (select host, count(*) as n from listings group by host) x window w as (order by n desc, host rows unbounded preceding)", "listings", True),
}
