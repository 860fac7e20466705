"""Queries over replayed sources: archived fetches, boundaries by questions, quotas on a stream, SQL functions, and payments by address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.functions import session
from muster.operators import boundary, fetching, payments
from muster.plans import records, records_sql
from muster.ship import ship
from muster.sources.archive import new_path
from muster.sources.runs import RunStore, agent_documents
from muster.streaming.quotas import quota_stream
from muster.streaming.tail import drain

#: An archived hop for each page: some redirect to the next page by an absolute or a relative location, to themselves, or nowhere.
_DECADE = "cast(floor(page_id / 10) as bigint)"
_URL = f"concat('https://h', {_DECADE}, '.example/p/', page_id)"
_NEXT = f"concat('https://h', cast(floor((page_id + 1) / 10) as bigint), '.example/p/', page_id + 1)"
HOP = {
    "http_status": "case when page_id % 11 = 7 then null when page_id % 40 between 20 and 24 or page_id % 5 in (1, 2) or page_id % 17 = 4 or page_id % 19 = 8 then 302 when page_id % 5 = 3 then 404 else 200 end",
    "error": "case when page_id % 11 = 7 then 'timeout' end",
    "location": f"case when page_id % 19 = 8 then 'http:// nowhere' when page_id % 17 = 4 then concat('./', page_id) when page_id % 5 = 2 then concat('../p/./', page_id + 1) else {_NEXT} end",
    "address": "case when page_id % 23 = 5 then '10.1.2.3' else '93.184.216.34' end",
    "retry_after": "case when page_id % 3 = 0 then cast(page_id % 100 as string) end",
}


def fetch_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-9: every page's URL fetched from the archive."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    ship(spark)
    hops = pages.filter("page_id % 29 <> 3").selectExpr(f"{_URL} as url", *(f"{e} as {c}" for c, e in HOP.items()), "'text/html' as content_type", "encode(html, 'UTF-8') as body")
    robots = pages.selectExpr(f"concat('https://h', {_DECADE}, '.example') as origin").distinct().withColumn("text", F.when(F.col("origin").rlike("[05]\\.example$"), "User-agent: *\nDisallow: /p/"))
    out = fetching.fetched(pages.selectExpr("page_id", f"{_URL} as url"), hops, robots, "muster", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return out.select("page_id", "final_url", F.col("http_status").cast("long").alias("http_status"), F.col("redirects").cast("long").alias("redirects"), "error", "body_sha256", "retry_after_secs")


def find_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3: the highest id of each chain by doubling and bisection, orders of a customer's segment taken as ids of a chain."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    ids = orders.selectExpr("concat('c', o_orderkey % 7) as chain", "cast(floor(o_orderkey / 7) as bigint) as id").distinct()
    found = boundary.highest_ids(spark, [*(f"c{i}" for i in range(7)), "none"], boundary.by_table(ids))
    return found.select("chain", F.col("highest").cast("long").alias("highest"), "error")


def stream_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-9: events as hits of their users, 2 in 10 minutes and 20 in a day let through."""
    ship(spark)
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    hits = events.select(F.col("user_id").cast("string").alias("key"), F.col("event_id").cast("long").alias("id"), F.col("ts").cast("timestamp").alias("time"))
    return drain(quota_stream(hits, ((2, 600), (20, 86_400))), "quota").select("key", "id", "let_through")


def sql_run_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-2: the findings of a run as a table function of the session."""
    c = records.census_tables(spark, sf_dir)
    c.checks.createOrReplaceTempView("census_checks")
    c.snapshots.createOrReplaceTempView("census_snapshots")
    session.register_run_findings(spark, "census_checks", "census_snapshots", "int")
    return spark.sql("select finding, numerator, denominator from run_findings(1)")


def sql_document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-1: name, description and error of every document by a function of the session."""
    session.register_document_fields(spark)
    docs = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", f"encode({records.BODY}, 'UTF-8') as body")
    return spark.sql("select p_partkey, f.name as doc_name, f.description as doc_description, f.error as doc_error from (select p_partkey, document_fields(body) as f from {docs})", docs=docs)


def documents_at_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UDF-3: names and descriptions that a run store projects when bodies are written; a run is replaced by half its documents."""
    ship(spark)
    store = RunStore(spark, new_path(spark, "runs"), {"http_archive": ("agent_documents", agent_documents)})
    bodies = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("cast(p_partkey as bigint) as agent_id", f"encode({records.BODY}, 'UTF-8') as body")
    store.publish("a", {"http_archive": bodies}, chain="c")
    store.publish("b", {"http_archive": bodies}, chain="c")
    store.put("b", "http_archive", bodies.filter("agent_id % 2 = 0"))
    return store.table("agent_documents", "agent_id long, name string, description string, error string")


# -- payments by address -------------------------------------------------------------------------------------------


def _moved(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "supplier")}
    lines = read["lineitem"].join(read["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    address = lambda c: F.concat(F.lit("0x"), F.lpad(F.col(c).cast("string"), 40, "A"))
    suppliers = read["supplier"].select(F.col("s_suppkey").cast("long").alias("n"), address("s_suppkey").alias("address"), F.concat(F.lit("0x"), F.lpad((F.col("s_suppkey") % 90).cast("string"), 40, "a")).alias("owner"), F.when(F.col("s_suppkey") % 31 > 0, 365 + F.col("s_suppkey") % 1500).alias("mint_block"))
    both = F.explode(F.when(F.col("n") % 9 == 0, F.array("n", F.col("n") + 100_000)).otherwise(F.array("n"))).alias("agent_id")
    return {
        "transfers": lines.select(
            F.concat(F.lit("0xT"), F.col("l_linenumber") % 2).alias("token"), F.col("l_orderkey").cast("string").alias("tx_hash"), F.col("l_linenumber").alias("log_index"), address("o_custkey").alias("from"), address("l_suppkey").alias("to"),
            F.round(F.col("l_extendedprice") * 100).cast("long").cast("string").alias("value_raw"), F.datediff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("long").alias("block"), (F.col("l_suppkey") % 13 == 0).alias("is_contract"),
        ),
        "targets": suppliers.select("address", both, "owner", F.col("mint_block").cast("long").alias("mint_block")),
        "logs": read["lineitem"].filter("l_partkey % 5 = 0").select(F.concat(F.lit("0xt"), F.col("l_linenumber") % 2).alias("token"), F.col("l_orderkey").cast("string").alias("tx_hash"), F.col("l_linenumber").alias("log_index"), F.array(F.lit(payments.AUTHORIZED.upper().replace("0X", "0x")), F.concat(F.lit("0x"), F.lpad(F.col("l_partkey").cast("string"), 64, "B"))).alias("topics")),
        "owners": suppliers.select("owner"),
    }


def payments_reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-11, JN-12, JN-22, S-AUTH, VRD-12: every transfer by the agents that its addresses belong to, with its exclusion."""
    out = payments.classified(payments.reached(**_moved(spark, sf_dir)))
    return out.select(F.col("tx_hash"), F.col("log_index").cast("long").alias("log_index"), "agent_id", "direction", "counterparty", "authorizer", "x402", "payer_is_owner", "exclusion")


def payments_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-12, AGG-13 over the same rows: transfers and agents by direction and exclusion."""
    out = payments.classified(payments.reached(**_moved(spark, sf_dir)))
    return out.groupBy("direction", F.coalesce("exclusion", F.lit("counted")).alias("exclusion")).agg(F.count("*").alias("transfers"), F.count_distinct("agent_id").alias("agents"), F.count(F.when(F.col("x402"), 1)).alias("by_authorization"))


def registration_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JN-13: who sent the transaction that registered each agent; ten agents share one."""
    agents = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").cast("long").alias("agent_id"))
    tx = F.concat(F.lit("t"), F.floor(F.col("agent_id") / 10)).alias("tx_hash")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderkey % 4 > 0")
    senders = orders.select(F.concat(F.lit("t"), F.col("o_orderkey")).alias("tx_hash"), F.concat(F.lit("0x"), F.col("o_custkey")).alias("sender"))
    return payments.with_senders(agents, agents.filter("agent_id % 7 > 0").select("agent_id", tx), senders).select("agent_id", "tx_hash", "sender")


QUERIES = {f.__name__: f for f in (fetch_archive, find_boundary, documents_at_write, stream_quota, sql_run_findings, sql_document_fields, payments_reached, payments_counted, registration_senders)}


def _duck(text: str) -> str:
    return text.replace(" as string)", " as varchar)")


_ADDR = "'0x' || lpad(({0})::varchar, 40, 'a')"
_REACHED = f"""with s as (select s_suppkey as n, {_ADDR.format('s_suppkey')} as address, {_ADDR.format('s_suppkey % 90')} as owner, case when s_suppkey % 31 > 0 then 365 + s_suppkey % 1500 end as mint from supplier),
    t as (select address, n as agent_id, owner, mint from s union all select address, n + 100000, owner, mint from s where n % 9 = 0),
    m as (select l_orderkey as tx, l_linenumber as log, l_linenumber % 2 as token, {_ADDR.format('o_custkey')} as src, {_ADDR.format('l_suppkey')} as dst, date_diff('day', date '1992-01-01', l_shipdate::date) as block from lineitem join orders on l_orderkey = o_orderkey),
    a as (select l_orderkey as tx, l_linenumber % 2 as token, '0x' || right(lpad(arg_min(l_partkey, struct_pack(a := l_linenumber, b := lpad(l_partkey::varchar, 64, 'b')))::varchar, 64, 'b'), 40) as authorizer from lineitem where l_partkey % 5 = 0 group by 1, 2),
    r as (select m.*, t.*, 'in' as direction, src as counterparty from m join t on t.address = dst union all select m.*, t.*, 'out', dst from m join t on t.address = src),
    j as (select r.*, a.authorizer, r.counterparty in (select owner from s) as payer_is_owner from r left join a on a.tx = r.tx and a.token = r.token),
    c as (select *, case when direction = 'out' then 'outgoing' when counterparty = address then 'self_transfer' when counterparty = owner then 'owner_funding' when mint is null then 'mint_block_unknown' when block < mint then 'pre_mint' end as exclusion from j)"""
ORACLE_SQL = {
    "fetch_archive": _duck(f"""with recursive h as (select page_id, {', '.join(f'{e} as {c}' for c, e in HOP.items())}, sha256(html) as digest from pages where page_id % 29 <> 3),
        s as (select h.*, case when page_id % 19 = 8 then -1 when page_id % 17 = 4 then page_id else page_id + 1 end as next from h),
        w as (select page_id, page_id as spot, 0 as n from pages
            union all select w.page_id, s.next, n + 1 from w join s on s.page_id = w.spot where n < 3 and http_status = 302 and next >= 0 and address not like '10.%' and not (n = 0 and floor(w.spot / 10) % 5 = 0)),
        e as (select page_id, arg_max(spot, n) as spot, max(n) as n from w group by page_id),
        o as (select e.page_id, e.spot, e.n, s.*, case when s.address like '10.%' then 'ssrf_blocked: ' || s.address when e.n = 0 and floor(e.spot / 10) % 5 = 0 then 'robots_disallowed' when s.page_id is null then 'not_archived' when s.error is not null then s.error
            when http_status = 302 and e.n < 3 then 'bad_redirect_location' when http_status = 302 then 'too_many_redirects' end as stop from e left join s on s.page_id = e.spot)
        select page_id, case when ok then 'https://h' || floor(spot / 10)::bigint || '.example/p/' || spot end as final_url, case when ok then http_status end::bigint as http_status, n::bigint as redirects, stop as error, case when stop is null then digest end as body_sha256,
            case when ok then retry_after::bigint end as retry_after_secs from (select *, stop is null or stop = 'too_many_redirects' as ok from o)"""),
    "find_boundary": "select 'c' || (o_orderkey % 7) as chain, max(cast(floor(o_orderkey / 7) as bigint)) as highest, cast(null as varchar) as error from orders group by 1 union all select 'none', null, null",
    "sql_run_findings": f"select finding, numerator, denominator from ({records_sql.ORACLE_SQL['api_findings']}) where run = 1",
    "sql_document_fields": f"select p_partkey, doc_name, doc_description, doc_error from ({records_sql.ORACLE_SQL['parseable_flags']})",
    "documents_at_write": f"with x as (select p_partkey::bigint as agent_id, doc_name as name, doc_description as description, doc_error as error from ({records_sql.ORACLE_SQL['parseable_flags']})) select *, 'a' as run from x union all select *, 'b' from x where agent_id % 2 = 0",
    "payments_reached": f"{_REACHED} select tx::varchar as tx_hash, log::bigint as log_index, agent_id::bigint as agent_id, direction, counterparty, authorizer, authorizer is not null as x402, payer_is_owner, exclusion from c",
    "payments_counted": f"{_REACHED} select direction, coalesce(exclusion, 'counted') as exclusion, count(*) as transfers, count(distinct agent_id) as agents, count(authorizer) as by_authorization from c group by 1, 2",
    "registration_senders": "select s_suppkey::bigint as agent_id, r.tx as tx_hash, '0x' || o_custkey as sender from supplier left join (select s_suppkey as k, 't' || floor(s_suppkey / 10)::bigint as tx from supplier where s_suppkey % 7 > 0) r on k = s_suppkey left join orders on 't' || o_orderkey = r.tx and o_orderkey % 4 > 0",
}
