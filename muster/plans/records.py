"""Queries over records made from the driver's tables: JSON documents and endpoints from ``part``, catalog pages and quotes from
``pages``, API calls over the census views. The DuckDB texts are written from the rules, not from the Spark plans.

The records are made by one SQL expression that both engines read; what is asked of them is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions import web
from muster.operators import documents, ladder, payments, sellers
from muster.plans import api, census, seller_jobs
from muster.sources.archive import new_path, stored
from muster.sources.postings import Postings
from muster.ship import ship

REGISTRY = "0x8004a169fb4a3325136eb29fa0ceb6d2e539a432"
#: A document of each part as JSON text, broken in several ways.
_ENTRY = {
    "match": "concat('{\"agentId\":', p_partkey % 40, ',\"agentRegistry\":\"eip155:', p_size % 6, ':" + REGISTRY.upper().replace("0X", "0x") + "\"}')",
    "other": "concat('{\"agentId\":\"', p_partkey % 50, '\",\"agentRegistry\":\"eip155:', p_size % 4, ':" + REGISTRY + "\"}')",
    "no_registry": "concat('{\"agentId\":', p_partkey % 40, '}')",
    "no_id": "concat('{\"agentId\":null,\"agentRegistry\":\"solana:1:abc\"}')",
    "short": "concat('{\"agentId\":', p_partkey % 40, '.0,\"agentRegistry\":\"eip155:1\"}')",
}
_SERVICE = {
    "web": "concat('{\"name\":\"web\",\"endpoint\":\"https://h', p_partkey % 30, '.example/a', p_partkey % 90, '\",\"version\":\"1\"}')",
    "mail": "'{\"name\":\"mail\",\"endpoint\":\"mailto:a@b.c\"}'",
    "wallet": "concat('{\"name\":\"agentWallet\",\"address\":\"0x', lpad(cast(p_partkey % 70 as varchar(9)), 40, '0'), '\",\"version\":\"2\"}')",
    "bad": "'{\"name\":\"agentWallet\",\"endpoint\":7}'",
}
BODY = f"""concat(
    case when p_partkey % 83 = 0 then '[' else '' end,
    '{{"type":"', p_brand, '"',
    case when p_size % 5 = 0 then '' when p_size % 5 = 1 then ',"name":null' when p_size % 5 = 2 then ',"name":12' else concat(',"name":" ', p_name, ' "') end,
    case when p_size % 7 = 0 then '' when p_size % 7 = 1 then ',"description":""' else concat(',"description":"', p_type, '"') end,
    case when p_size % 3 = 0 then '' else ',"image":"i"' end,
    case p_partkey % 8 when 0 then '' when 1 then ',"services":[]' when 2 then ',"services":{{"a":1}}' when 3 then concat(',"services":[', {_SERVICE['web']}, ',', {_SERVICE['mail']}, ']')
        when 4 then concat(',"services":null,"endpoints":[', {_SERVICE['wallet']}, ',', {_SERVICE['web']}, ']') when 5 then concat(',"endpoints":[', {_SERVICE['web']}, ']')
        when 6 then concat(',"services":[', {_SERVICE['mail']}, '],"endpoints":[', {_SERVICE['web']}, ']') else concat(',"services":[', {_SERVICE['wallet']}, ',', {_SERVICE['bad']}, ',', {_SERVICE['wallet']}, ']') end,
    case p_partkey % 9 when 0 then '' when 1 then ',"registrations":[]' when 2 then ',"registrations":"x"' when 3 then concat(',"registrations":[', {_ENTRY['match']}, ']')
        when 4 then concat(',"registrations":[', {_ENTRY['other']}, ',', {_ENTRY['match']}, ']') when 5 then concat(',"registrations":[', {_ENTRY['no_registry']}, ',', {_ENTRY['other']}, ']')
        when 6 then concat(',"registrations":[', {_ENTRY['no_id']}, ']') when 7 then concat(',"registrations":[', {_ENTRY['short']}, ',', {_ENTRY['short']}, ']') else concat(',"registrations":[', {_ENTRY['other']}, ']') end,
    case p_size % 4 when 0 then '' when 1 then ',"x402Support":true' when 2 then ',"x402Support":false' else ',"x402Support":"yes"' end,
    case when p_partkey % 53 = 0 then '}} trailing' when p_partkey % 59 = 0 then ',' else '}}' end,
    case when p_partkey % 83 = 0 then ']' else '' end)"""
#: What a probe of an endpoint's URL says, by its last digits.
_N = "cast($1 as int)"
PROBE = {
    "http_status": f"case when {_N} % 7 = 0 then null when {_N} % 5 = 0 then 404 when {_N} % 11 = 0 then 402 when {_N} % 13 = 0 then 429 else 200 end",
    "error": f"case when {_N} % 14 = 0 then 'robots_disallowed' when {_N} % 7 = 0 and {_N} % 3 = 0 then 'ssrf_blocked: 10.0.0.1' when {_N} % 7 = 0 and {_N} % 2 = 1 then 'timeout' end",
}
_DOCS = f"docs as (select p_partkey, p_partkey % 10 as owner, p_partkey % 40 as actual_id, p_size % 6 as chain, {BODY} as body from part)"
_GOOD = f"{_DOCS}, d as (select *, cast(body as json) as j, json_type(body) as t from docs where json_valid(body))"
_ARR = "case when json_type(j, '$.services') is not null and json_type(j, '$.services') <> 'NULL' then case when json_type(j, '$.services') = 'ARRAY' then json_extract(j, '$.services') end when json_type(j, '$.endpoints') = 'ARRAY' then json_extract(j, '$.endpoints') end"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey % 10 as owner", "p_partkey % 40 as actual_id", "p_size % 6 as chain", f"encode({BODY}, 'UTF-8') as body")
    return documents.with_document(made)


def parseable_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.parseable(documents.project_document(_docs(spark, sf_dir).withColumn("truncated", F.lit(False))))
    return out.select("p_partkey", "status", "reason", "doc_name", "doc_description", "doc_error")


def _conformant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.conformant(_docs(spark, sf_dir).filter("parse_error is null"))


def conformant_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _conformant(spark, sf_dir)
    return out.select("p_partkey", F.array_join("should", ",").alias("should"), F.array_join("may", ",").alias("may"), "services_status", "services_source")


def conformant_must(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformant(spark, sf_dir).select("p_partkey", "status", F.array_join("must", ",").alias("must"), F.col("registrations_checked").cast("long").alias("registrations_checked"))


def bound_best_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.bound(_docs(spark, sf_dir).filter("parse_error is null").withColumn("registry", F.lit(REGISTRY)), "actual_id", "chain", "registry")
    return out.select("p_partkey", "status", F.col("entry").cast("long").alias("entry"), F.col("score").cast("long").alias("score"), "declared_chain")


def declared_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.declared_endpoints(_docs(spark, sf_dir).filter("parse_error is null"))
    return out.select("p_partkey", F.col("index").cast("long").alias("index"), "name", "declared", "kind")


def _probes(endpoints: DataFrame) -> DataFrame:
    urls = endpoints.filter(F.col("kind").isin("http", "https")).select(F.col("declared").alias("url")).distinct()
    urls = urls.withColumn("n", F.regexp_extract("url", "([0-9]+)$", 1)).filter(F.col("n").cast("int") % 17 > 0)
    return urls.select("url", *(F.expr(e.replace("$1", "n")).alias(c) for c, e in PROBE.items()))


def live_from_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stored(_docs(spark, sf_dir).filter("parse_error is null").select("p_partkey", "doc"), "docs")  # parsed once
    endpoints = documents.declared_endpoints(docs)
    agents = docs.filter(documents.services(F.col("doc"))["entries"].isNotNull()).select("p_partkey")
    out = documents.live(agents, endpoints, _probes(endpoints), ["p_partkey"])
    return out.select("p_partkey", "status", "reason", "declared", "probeable", "probed", "live", "not_live", "refused", "our_error", "payment_gated")


def declared_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.declared_wallets(_docs(spark, sf_dir).filter("parse_error is null"))
    wallet = F.expr("case when p_partkey % 4 = 0 then null when p_partkey % 4 = 1 then concat('0x', repeat('0', 40)) else concat('0X', lpad(cast(p_partkey % 11 as string), 40, 'A')) end")
    frame = docs.select("p_partkey", "wallets", wallet.alias("verified_wallet"), F.expr("concat('0x', lpad(cast(p_partkey % 9 as string), 40, 'a'))").alias("owner"))
    return documents.payment_targets(frame).select("p_partkey", "basis", "address", F.col("declared_index").cast("long").alias("declared_index"), "ineligible")


def x402_by_wallet(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents.declared_wallets(_docs(spark, sf_dir).filter("parse_error is null"))
    return docs.groupBy(documents.payment_support(F.col("doc")).alias("x402"), (F.size("wallets") > 0).alias("wallet")).agg(F.count("*").alias("n"))


def document_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = _docs(spark, sf_dir).filter("parse_error is null").withColumn("shape", documents.shape(F.col("doc"))).filter("shape is not null")
    per = shaped.groupBy("owner", "shape").agg(F.count("*").alias("n"))
    return per.groupBy("owner").agg(F.count("*").alias("shapes"), F.max("n").alias("modal"), F.sum("n").alias("n")).withColumn("pct", F.round(F.col("modal").cast("double") * 100.0 / F.col("n"), 6))


# -- sellers -------------------------------------------------------------------------------------------------------

_USDC = "0x833589fcD6eDb6E08f4c7C32D4f71b54bdA02913"
_PAYEE = "concat('0x', lpad(cast(page_id % 37 as varchar(9)), 40, '0'))"
#: A catalog page with one item, and the answer of the item's endpoint.
_OFFER = f"concat('{{\"scheme\":\"exact\",\"network\":\"', case page_id % 4 when 0 then 'Base' when 1 then 'eip155:8453' when 2 then 'solana' else 'base-sepolia' end, '\",\"amount\":\"', page_id % 250 * 997, '\",\"asset\":\"{_USDC}\",\"payTo\":\"', {_PAYEE}, '\"}}')"
ITEM = f"""concat('{{"items":[', case when page_id % 19 = 0 then '{{"accepts":[]}}' else concat('{{"resource":"', url, '","accepts":[', {_OFFER}, case when page_id % 3 = 0 then concat(',', {_OFFER}) when page_id % 3 = 1 then ',{{"recipient":"0x00000000000000000000000000000000000000Ff","maxAmountRequired":5}}' else '' end, ']}}') end,
    '],"pagination":{{"total":', page_id, '}}}}', case when page_id % 31 = 0 then '!' else '' end)"""
_BID = "concat('{\"scheme\":\"exact\",\"network\":\"', case $i when 0 then 'base' when 1 then 'solana' else 'eip155:8453' end, '\",\"maxAmountRequired\":', case (page_id + $i) % 4 when 0 then concat('\"', page_id % 250 * 997, '\"') when 1 then cast(page_id * 1000 + $i as varchar(12)) when 2 then '\"1.5\"' else '\"99999999999999999999999999999999999999\"' end, ',\"asset\":\"', case when (page_id + $i) % 6 = 0 then '0x0000000000000000000000000000000000000001' else '" + _USDC + "' end, '\",\"payTo\":\"', case when (page_id + $i) % 5 = 0 then '0x00000000000000000000000000000000000000Ee' else " + _PAYEE + " end, '\"}')"
ANSWER = f"""case page_id % 12 when 0 then 'no json' when 1 then '{{"x":1}}' when 2 then '{{"accepts":[]}}' when 3 then '{{"accepts":[{{"scheme":"exact"}}]}}'
    else concat('{{"accepts":[', {_BID.replace('$i', '0')}, ',', {_BID.replace('$i', '1')}, ',', {_BID.replace('$i', '2')}, ']}}') end"""


def _catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    made = _table(spark, sf_dir, "pages").selectExpr("page_id", f"encode({ITEM}, 'UTF-8') as body")
    return sellers.catalog_listings(made, "bazaar")


def catalog_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)[0]


def catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)[1].select("page_id", "error", F.col("items_seen").cast("long").alias("items_seen"), F.col("items_unreadable").cast("long").alias("items_unreadable"), "total")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir, "pages").selectExpr("page_id", f"{_PAYEE} as pay_to", f"encode({ANSWER}, 'UTF-8') as body")
    return sellers.quotes(made)


def seller_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.array_join(F.transform("quotes", lambda q: F.concat_ws("/", q["network"], q["amount"], q["asset"])), ",")
    return _answers(spark, sf_dir).select("page_id", F.size("quotes").cast("long").alias("n"), shown.alias("quotes"), "reason", "missing")


def shop_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sellers.decide(_answers(spark, sf_dir))
    return out.select("page_id", "decision", F.col("index").cast("long").alias("index"), F.col("cents").cast("long").alias("cents"))


def seller_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    claim = F.expr(f"named_struct('network', case when page_id % 2 = 0 then 'Base' else 'solana' end, 'amount', case when page_id % 7 = 0 then null else cast(page_id % 250 * 997 as string) end, 'asset', lower('{_USDC}'))")
    return sellers.consistent(_answers(spark, sf_dir).withColumn("claim", claim)).select("page_id", "status", "reason")


def fnv_host_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-8: the five URLs of each host with the least FNV-1a hash (ties by URL) are probed."""
    from pyspark.sql import Window

    urls = _table(spark, sf_dir, "pages").select("url").distinct().withColumns({"host": web.probe_host(F.col("url")), "fnv": web.fnv1a(F.col("url"))})
    place = F.row_number().over(Window.partitionBy("host").orderBy("fnv", "url"))
    return urls.withColumn("place", place).filter("place <= 5").select("host", "url", "fnv", F.col("place").cast("long").alias("place"))


# -- payments and ladders ------------------------------------------------------------------------------------------

#: Transfers as rows of agents: every ninth payee belongs to a second agent; senders of some transfers weren't read.
PAID = """, paid as (select payee % 3 as token, $[text|payee] as address, agent as agent_id, verdict, x402, case when payer % 997 = 0 then null else to_contract end as is_contract, concat($[text|value_raw], '000000000000000000000000') as value_raw from transfers
    union all select payee % 3, $[text|payee], (payee + 1) % 97, verdict, x402, case when payer % 997 = 0 then null else to_contract end, concat($[text|value_raw], '000000000000000000000000') from transfers where payee % 9 = 0)"""
#: What was seen of each part's agent.
SEEN = {
    "owner": "case when p_partkey % 29 = 0 then concat('0x', repeat('0', 40)) else '0x1' end", "scheme": "case p_partkey % 6 when 0 then 'empty' when 1 then 'data' else 'http' end",
    "http_status": "case p_partkey % 7 when 0 then 404 when 1 then 402 when 2 then null else 200 end", "error": "case when p_partkey % 31 = 0 then 'timeout' end", "truncated": "p_partkey % 37 = 0", "has_reputation": "p_partkey % 11 > 0",
}


def paid_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = census.run_text(PAID + " select * from paid", "transfers", spark, sf_dir)
    return payments.summary(rows.withColumn("exclusion", F.when(F.col("verdict") != "counted", F.col("verdict"))), ["token"])


def ladder_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    made = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey", "p_partkey % 40 as agent_id", "p_size % 6 as chain_id", f"'{REGISTRY}' as registry", f"encode({BODY}, 'UTF-8') as body", *(f"{e} as {c}" for c, e in SEEN.items()),
        "case p_partkey % 3 when 0 then array_remove(array(''), '') when 1 then array('A', 'a') else array('A', 'b') end as authors",
    )
    out = ladder.assembled(made, ["p_partkey", "agent_id"])
    return out.select("p_partkey", F.col("rung").cast("long").alias("rung"), "status", F.col("skipped_because_rung").cast("long").alias("because_rung"), F.col("skipped_because_status").alias("because_status"))


# -- calls ---------------------------------------------------------------------------------------------------------


def census_tables(spark: SparkSession, sf_dir: str) -> api.Census:
    """The census views in the shape that the calls read; run 2 is still running for the tail's purposes."""
    view = lambda body, needs: census.run_text(body, needs, spark, sf_dir)
    chain = "cast(run_no % 2 as string) as chain"
    return api.Census(
        runs=view(f"select run_no as run, {chain}, 'finished' as status, started_at, finished_at, case when run_no < 2 then 'a' else 'b' end as checker, 1 as schema_version from runs", "runs"),
        snapshots=view(f"select run_no as run, {chain}, agent_id, concat('0x', cast(owner as string), 'Ab') as owner from snapshots", "snapshots"),
        documents=view("select run_no as run, agent_id, d.source as name, d.name as description from snapshots s join docs d on d.doc_id = s.agent_id", "snapshots docs"),
        checks=view("select run_no as run, agent_id, rung, status, evidence from checks", "checks"),
        tail=view(f"select {chain}, agent_id, concat('0x', cast(owner as string), 'Ab') as owner, timestamp '2024-02-01 00:00:00' as seen_at, cast(case when agent_id % 3 = 0 then 1 end as int) as superseded_by from snapshots where run_no = 2", "snapshots"),
        cursors=view(f"select {chain}, max(agent_id) as cursor from snapshots group by run_no % 2", "snapshots"),
        chains=spark.createDataFrame([("0", True), ("1", True), ("2", False), ("3", True)], "chain string, enabled boolean"),
    )


def _shown_rungs(out: DataFrame) -> DataFrame:
    return out.withColumn("rungs", F.array_join(F.transform("rungs", lambda r: F.concat_ws(":", r["rung"], r["status"])), ","))


def api_agents_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_rungs(api.agents(census_tables(spark, sf_dir), run=1, facets="2:pass, 3:pass", status="fail", limit=20, offset=2))


def api_agents_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_rungs(api.agents(census_tables(spark, sf_dir), run=1, q="src1", limit=500))


def api_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.search(census_tables(spark, sf_dir), "0x1", [2, 0, 2, 1]).withColumns({c: F.col(c).cast("long") for c in ("place", "item")})


def search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O-SEARCH by posting lists: index all runs, then ask as ``api_search`` does, and a page of agents of run 1."""
    c = census_tables(spark, sf_dir)
    c.postings = Postings(spark, new_path(spark, "postings"), "int")
    c.postings.add(c.snapshots.join(c.documents, ["run", "agent_id"], "left"))
    found = api.search(c, "0x1", [2, 0, 2, 1]).select(F.lit("search").alias("call"), F.col("place").cast("long").alias("place"), "run", "total", F.col("item").cast("long").alias("item"), "agent_id", "name")
    paged = api.agents(c, run=1, q="src1", limit=500)
    none = F.lit(None).cast("long")
    return found.unionByName(paged.select(F.lit("agents").alias("call"), none.alias("place"), F.lit(1).alias("run"), "total", none.alias("item"), "agent_id", "name"))


def api_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.tail(census_tables(spark, sf_dir), q="0x2", limit=10, offset=1).select("chain", "agent_id", "owner", "total")


def api_tail_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.tail_summary(census_tables(spark, sf_dir)).select("chain", "unswept", "cursor")


def api_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.array_join(F.transform("flips", lambda f: F.concat_ws(":", f["rung"], f["was"], f["now"], f["agents"])), ",")
    return api.delta(census_tables(spark, sf_dir), 2).withColumn("flips", shown)


def api_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.array_join(F.transform("statuses", lambda s: F.concat_ws(":", s["status"], s["agents"])), ",")
    return api.rates(census_tables(spark, sf_dir), 1).withColumn("statuses", shown)


def api_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api.findings(census_tables(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        parseable_flags, conformant_gaps, conformant_must, bound_best_entry, declared_endpoints, live_from_rows, declared_targets, x402_by_wallet, document_shapes, catalog_listings, catalog_pages,
        seller_quotes, shop_decide, seller_consistent, fnv_host_budget, paid_summary, ladder_assembly, api_agents_facets, api_agents_search, api_search, search_indexed, api_tail, api_tail_summary, api_delta, api_rates, api_findings,
    )
}
QUERIES["seller_probe"] = seller_jobs.seller_probe
