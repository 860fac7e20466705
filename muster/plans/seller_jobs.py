"""The seller census as batch jobs over observations (seller-crawl, -probe, -settle and -delta of 2.12; AGG-6, AGG-17, SET-3, VRD-13, VRD-18).

Each job takes frames and returns frames; a RunStore writes them. A crawl whose pages weren't all read makes its run failed (LIF-8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators import sellers
from muster.operators.verdicts import DECLINED, PAYMENT

SELLER = ["pay_to", "host"]


def crawl(pages: DataFrame, catalog: str) -> dict[str, DataFrame]:
    """Catalog pages (body, fetched) to ``listings`` in scope, ``sellers``, ``rejected``, ``checks`` of rung 1, ``out_of_scope`` (by
    network), ``rejected_by_reason`` and ``complete`` (one row: whether every page was read)."""
    listings, read = sellers.catalog_listings(pages, catalog)
    inside = sellers.in_scope(F.col("network"))
    mine = listings.filter(inside)
    good, bad = sellers.population(mine)
    return {
        "listings": mine, "sellers": good, "rejected": bad, "checks": sellers.listed(good, mine).select(*SELLER, F.lit(1).alias("rung"), "status"),
        "out_of_scope": listings.filter(~inside).groupBy(sellers.canonical_network(F.col("network")).alias("network")).agg(F.count("*").alias("listings")),
        "rejected_by_reason": bad.groupBy("reason").agg(F.count("*").alias("listings")), "complete": read.agg(F.coalesce(F.bool_and(F.col("error").isNull()), F.lit(False)).alias("complete")),
    }


def probe(population: DataFrame, observations: DataFrame, claims: DataFrame, budget: int = sellers.HOST_BUDGET) -> DataFrame:
    """Rungs 2, 3 and 7 of each seller: (pay_to, host, rung, status, reason).

    ``observations``: one row (pay_to, host, resource, permitted, error, http_status, body) for each seller asked; ``claims``:
    (pay_to, resource, claim). Sellers beyond their host's budget are unprobed on rungs 2 and 3 and have no rung 7; it is judged
    only where a claim names the very resource that was asked."""
    over = sellers.host_budget(population, budget)
    seen = observations.join(over.select(*SELLER).distinct(), SELLER, "left_anti")
    asked = sellers.quotes(seen)
    permitted, error, code = F.col("permitted"), F.col("error"), F.col("http_status")
    stopped = ~permitted | error.isNotNull() | code.isin(*DECLINED)
    second = F.when(~permitted, "refused").when(error.isNotNull(), "error").when(code.isin(*DECLINED), "refused").otherwise("pass")
    third = F.when(stopped, "skipped").when((code == PAYMENT) & F.col("body").isNotNull() & F.col("reason").isNull(), "pass").otherwise("fail")
    why = F.when(stopped, "rung_2_not_pass").when(code != PAYMENT, F.concat(F.lit("http_"), code)).when(F.col("body").isNull(), "no_body").otherwise(F.col("reason"))
    rows = asked.select(*SELLER, "resource", F.when(third == "pass", F.col("quotes")).otherwise(F.array().cast(f"array<{sellers.QUOTE}>")).alias("quotes"), F.inline(F.array(
        F.struct(F.lit(2).alias("rung"), second.alias("status"), F.coalesce(error, F.when(second == "refused", "declined")).alias("reason")), F.struct(F.lit(3).alias("rung"), third.alias("status"), why.alias("reason")),
    )))
    seventh = sellers.consistent(rows.filter("rung = 3").drop("status", "reason").join(claims, ["pay_to", "resource"])).withColumn("rung", F.lit(7))
    columns = [*SELLER, "rung", "status", "reason"]
    return rows.select(*columns).unionByName(over.select(*columns)).unionByName(seventh.select(*columns))


def delta(before: DataFrame, after: DataFrame, catalogs: tuple[list, list]) -> DataFrame:
    """AGG-6: one row: sellers on both sides, appeared and disappeared, flips that count, and those left out because a side was
    refused, errored or unprobed (the first that holds, so that the four add up), and what else changed between the runs.

    ``before``, ``after``: (pay_to, host, rung, status); ``catalogs``: the catalogs that each run read."""
    pairs = before.withColumnRenamed("status", "was").join(after.withColumnRenamed("status", "now"), [*SELLER, "rung"]).filter("was <> now")
    has = lambda w: (F.col("was") == w) | (F.col("now") == w)
    kind = F.when(has("refused"), "refused").when(has("error"), "error").when(has("unprobed"), "unprobed").otherwise("counted")
    n = lambda w: F.count(F.when(kind == w, 1)).alias(w if w == "counted" else f"excluded_{w}")
    flips = pairs.agg(*(n(w) for w in ("counted", "refused", "error", "unprobed")))
    a, b = before.select(*SELLER).distinct().withColumn("b", F.lit(1)), after.select(*SELLER).distinct().withColumn("a", F.lit(1))
    sides = a.join(b, SELLER, "full").agg(F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("both"), F.count(F.when(F.col("b").isNull(), 1)).alias("appeared"), F.count(F.when(F.col("a").isNull(), 1)).alias("disappeared"))
    rungs = lambda df, name: df.agg(F.array_sort(F.collect_set("rung")).alias(name))
    out = flips.crossJoin(sides).crossJoin(rungs(before, "_x")).crossJoin(rungs(after, "_y"))
    return out.withColumns({"catalogs_changed": F.lit(sorted(set(catalogs[0])) != sorted(set(catalogs[1]))), "rungs_changed": F.col("_x") != F.col("_y")}).drop("_x", "_y")


def _observed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    from muster.functions.web import url_host
    from muster.plans.records import _PAYEE, _USDC, ANSWER, _table

    made = _table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url", f"{_PAYEE} as pay_to", "page_id % 23 > 0 as permitted", "case when page_id % 17 = 0 then 'timeout' end as error", "case when page_id % 13 = 0 then 429 when page_id % 7 = 0 then 200 else 402 end as http_status",
        f"case when page_id % 5 > 0 then encode({ANSWER}, 'UTF-8') end as body", f"named_struct('network', 'base', 'amount', cast(page_id % 250 * 997 as string), 'asset', lower('{_USDC}')) as claim",
    )
    named = made.withColumn("host", F.concat(url_host(F.col("url"))["value"], F.lit(":"), F.col("page_id") % 3)).filter("host is not null").withColumnRenamed("url", "resource")
    return named.select(*SELLER).distinct(), named, named.filter("page_id % 2 = 0").select("pay_to", "resource", "claim")


def seller_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by rung, status and reason of the pages taken as sellers."""
    out = probe(*_observed(spark, sf_dir), budget=8)
    return out.groupBy(F.col("rung").cast("long").alias("rung"), "status", "reason").agg(F.count("*").alias("n"))


def seller_flips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delta between runs 0 and 1 of the census views, agents taken as sellers."""
    from muster.plans import census

    view = lambda run: census.run_text(f"select cast(agent_id as string) as pay_to, 'h' as host, rung, case when agent_id % 7 = 0 and run_no = 1 then 'unprobed' else status end as status from checks where run_no = {run}", "checks", spark, sf_dir)
    return delta(view(0), view(1), (["a"], ["a", "b"]))


QUERIES = {"seller_probe": seller_probe, "seller_flips": seller_flips}
ORACLE_SQL = {}


def _flips_oracle() -> str:
    from muster.plans import census

    return census.full_text(""", x as (select agent_id, rung, status from checks where run_no = 0), y as (select agent_id, rung, case when agent_id % 7 = 0 then 'unprobed' else status end as status from checks where run_no = 1),
        p as (select x.status as w, y.status as n from x join y using (agent_id, rung) where x.status <> y.status), s as (select agent_id, max(a) as a, max(b) as b from (select agent_id, 1 as a, 0 as b from x union all select agent_id, 0, 1 from y) z group by 1)
        select count(*) filter (where not (w in ('refused', 'error', 'unprobed') or n in ('refused', 'error', 'unprobed'))) as counted, count(*) filter (where 'refused' in (w, n)) as excluded_refused, count(*) filter (where 'refused' not in (w, n) and 'error' in (w, n)) as excluded_error,
        count(*) filter (where 'refused' not in (w, n) and 'error' not in (w, n) and 'unprobed' in (w, n)) as excluded_unprobed, (select count(*) from s where a + b = 2) as "both", (select count(*) from s where a = 0) as appeared, (select count(*) from s where b = 0) as disappeared, true as catalogs_changed,
        (select list_sort(list(distinct rung)) from x) <> (select list_sort(list(distinct rung)) from y) as rungs_changed from p""", "checks", True)


ORACLE_SQL["seller_flips"] = _flips_oracle()
