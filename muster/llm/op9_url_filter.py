"""URL filters with dated lists: a temporal join.

A list is a table of dated entries (level, key, action, since): from ``since`` on the action holds for the key, until the
key's next entry. Levels are ``host``, ``site`` (the last two labels of the host) and ``path`` (host and first path
segment); actions ``block``, ``allow`` and ``none`` (delisted). Entries become validity intervals by lead(); intervals of
one key are disjoint, so that an as-of lookup finds one entry at most. Every capture is joined as of its fetch time at
the three levels; the most specific level whose action isn't none decides.

DataFrame functions only. The list is broadcast if a count proves it small (MOST_BROADCAST entries); else the joins
shuffle, where AQE splits a hot host on the side of the captures, and a left outer join lets it.

Nulls: a null or unparsable URL has no host and gets verdict ``pass`` with null level; so has a null fetch time. Entries
with null key or time are ignored. Of entries of one key at one time, block wins over allow over none. Repeated captures
are kept. Empty tables: no captures give no rows, no entries give ``pass``. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.llm.common import table

MOST_BROADCAST = 100_000
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)"
SITE = r"([^.]+\.[^.]+)$"
SEGMENT = r"^[a-z][a-z0-9+.-]*://[^/?#]+(/[^/?#]*)"
LEVELS = ("path", "host", "site")


def url_keys(url: Column) -> dict[str, Column]:
    """Lookup keys by level; null where the URL has none."""
    low = F.lower(url)
    host = F.nullif(F.regexp_extract(low, HOST, 1), F.lit(""))
    segment = F.nullif(F.regexp_extract(low, SEGMENT, 1), F.lit(""))
    return {"host": host, "site": F.nullif(F.regexp_extract(host, SITE, 1), F.lit("")), "path": F.concat(host, segment)}


def validity(entries: DataFrame) -> DataFrame:
    """(level, key, action, since, until): intervals [since, until), open-ended where until is null."""
    strength = F.when(F.col("action") == "block", 0).when(F.col("action") == "allow", 1).otherwise(2)
    ranked = entries.filter("key is not null and since is not null").groupBy("level", "key", "since").agg(F.min_by("action", strength).alias("action"))
    return ranked.withColumn("until", F.lead("since").over(Window.partitionBy("level", "key").orderBy("since")))


def apply_lists(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetched_at", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``captures`` with host, verdict (block or pass), level, list_key and listed_since of the entry that decided; these replace
    columns of the same names."""
    spans = validity(entries)
    small = entries.limit(most_broadcast + 1).count() <= most_broadcast
    row = F.struct(*(F.col(f"`{c}`") for c in captures.columns)).alias("row")
    out = captures.select(row, F.col(time_col).alias("at"), *(key.alias(level) for level, key in url_keys(F.col(url_col)).items()))
    for level in LEVELS:
        side = spans.filter(F.col("level") == level).select("key", "action", "since", "until")
        side = (F.broadcast(side) if small else side).alias("e")
        match = (F.col(f"c.{level}") == F.col("e.key")) & (F.col("c.at") >= F.col("e.since")) & (F.col("e.until").isNull() | (F.col("c.at") < F.col("e.until")))
        out = out.alias("c").join(side, match, "left").select("c.*", F.col("e.action").alias(f"{level}_action"), F.col("e.since").alias(f"{level}_since"))
    decided = F.lit(None)
    for level in reversed(LEVELS):
        hit = F.struct(F.lit(level).alias("level"), F.col(level).alias("key"), F.col(f"{level}_action").alias("action"), F.col(f"{level}_since").alias("since"))
        decided = F.when(F.coalesce(F.col(f"{level}_action"), F.lit("none")) != "none", hit).otherwise(decided)
    out = out.withColumn("decided", decided)
    verdict = F.when(F.col("decided.action") == "block", "block").otherwise("pass")
    own = {"host": F.col("host"), "verdict": verdict, "level": F.col("decided.level"), "list_key": F.col("decided.key"), "listed_since": F.col("decided.since")}
    return out.select(*(F.col("row").getField(c).alias(c) for c in captures.columns if c not in own), *(c.alias(name) for name, c in own.items()))


def _bucket(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 4), 16, 10).cast("int")


def dated_list(pages: DataFrame) -> DataFrame:
    """A list made from the hosts and paths of the pages by a rule: which keys are listed, and when, follows from their md5."""
    keys = url_keys(F.col("url"))
    each = pages.select(F.explode(F.array(*(F.struct(F.lit(k).alias("level"), c.alias("key")) for k, c in keys.items()))).alias("k")).select("k.*").filter("key is not null").distinct()
    h = _bucket(F.col("key"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), h % 200)
    first = F.when(F.col("level") == "path", "allow").otherwise("block")
    history = F.array(
        F.struct(first.alias("action"), start.alias("since")),
        F.struct(F.lit("none").alias("action"), F.date_add(start, 60).alias("since")),
        F.struct(F.when(h % 2 == 0, "allow").otherwise("block").alias("action"), F.date_add(start, 90).alias("since")),
    )
    share = F.when(F.col("level") == "host", 3).when(F.col("level") == "site", 11).otherwise(7)
    return each.filter(h % share == 0).select("level", "key", F.explode(history).alias("e")).select("level", "key", "e.action", "e.since")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).alias("fetched_at"))
    return apply_lists(captures, dated_list(pages)).withColumns({c: F.col(c).cast("string") for c in ("fetched_at", "listed_since")})


def oracle() -> str:
    h = "('0x' || substring(md5(key), 1, 4))::int"
    levels = " ".join(
        f"left join spans as {x} on {x}.level = '{x}' and {x}.key = c.k_{x} and c.fetched_at >= {x}.since and ({x}.until is null or c.fetched_at < {x}.until)" for x in LEVELS
    )
    pick = lambda what: "case " + " ".join(f"when coalesce({x}.action, 'none') <> 'none' then {what.format(x)}" for x in LEVELS) + " end"
    return rf"""
    with u as (select page_id, url, date '2024-01-01' + (page_id % 300)::int as fetched_at, nullif(regexp_extract(lower(url), '{HOST}', 1), '') as k_host, nullif(regexp_extract(lower(url), '{SEGMENT}', 1), '') as seg from pages),
    c as (select *, nullif(regexp_extract(k_host, '{SITE}', 1), '') as k_site, k_host || seg as k_path from u),
    keys as (select 'host' as level, k_host as key from c union select 'site', k_site from c union select 'path', k_path from c),
    listed as (select *, {h} as h, date '2024-01-01' + ({h} % 200) as start from keys where key is not null and {h} % case level when 'host' then 3 when 'site' then 11 else 7 end = 0),
    entries as (select level, key, case level when 'path' then 'allow' else 'block' end as action, start as since from listed union all select level, key, 'none', start + 60 from listed
        union all select level, key, case when h % 2 = 0 then 'allow' else 'block' end, start + 90 from listed),
    spans as (select *, lead(since) over (partition by level, key order by since) as until from entries)
    select page_id, url, fetched_at::date::varchar as fetched_at, k_host as host, case when {pick('{}.action')} = 'block' then 'block' else 'pass' end as verdict, {pick("'{}'")} as level, {pick('{}.key')} as list_key,
        ({pick('{}.since')})::date::varchar as listed_since from c {levels}"""
