"""Fetches replayed from archived hops (SRC-9): redirects, robots, private addresses, the cap, the digest and Retry-After.

``requests``: (id, url). ``hops``: one row for each URL that was asked (a repeated one counts once, the first in any order): url, http_status, location, content_type,
retry_after, body, error, address (what the host resolved to). ``robots``: (origin, text). The rules and their order are those of a
live fetch: each hop's address is looked at, robots.txt only before the first one, and redirects are followed MOST_REDIRECTS times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import web

#: (A fixed value.)
MOST_REDIRECTS = 3
HTTP = r"^(?i)https?://[^/?#\s]+"


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def path_of(url: Column) -> Column:
    """The path of a URL, / if it has none."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit("")), F.lit("/"))


def without_dots(url: Column) -> Column:
    """``.`` and ``..`` taken out of a URL's path."""
    none = F.array().cast("array<string>")

    def step(kept: Column, part: Column) -> Column:
        return F.when(part == ".", kept).when(part == "..", F.when(F.size(kept) > 0, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(none)).otherwise(F.concat(kept, F.array(part)))

    parts = F.split(F.regexp_replace(F.regexp_replace(path_of(url), r"/(\.{1,2})$", "/$1/"), "^/", ""), "/", -1)
    return F.concat(origin(url), F.lit("/"), F.array_join(F.aggregate(parts, none, step), "/"), F.regexp_extract(url, r"([?#].*)$", 1))


def joined(base: Column, location: Column) -> Column:
    """Where a Location leads from a URL: absolute, with the scheme or the origin of the base, a query, or beside the base's path."""
    loc = F.trim(location)
    place = F.concat(origin(base), path_of(base))
    beside = F.concat(origin(base), F.regexp_replace(path_of(base), "[^/]*$", ""), loc)
    return (
        F.when(loc.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), loc).when(loc.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]*:", 0), loc)).when(loc.startswith("/"), without_dots(F.concat(origin(base), loc)))
        .when(loc.startswith("?"), F.concat(place, loc)).when(loc.startswith("#") | (loc == ""), F.concat(F.regexp_replace(base, "#.*$", ""), loc)).otherwise(without_dots(beside))
    )


def fetched(requests: DataFrame, hops: DataFrame, robots: DataFrame, agent: str, now: Column) -> DataFrame:
    """requests' columns, final_url, http_status, redirects, error, content_type, body, truncated, body_sha256 and retry_after_secs.

    Errors, the first that holds at a hop: ssrf_blocked, robots_disallowed, not_archived, what the hop says, bad_redirect_location,
    and too_many_redirects for a redirect that is left after the last one, as in a loop; it keeps its status, but has no digest."""
    at, moved = F.col("url"), F.col("http_status").between(300, 399)
    blocked = F.coalesce(~web.public_address(F.col("address")), F.lit(False))
    seen = hops.dropDuplicates(["url"]).withColumns({"_blocked": blocked, "_led": F.when(moved & F.col("error").isNull(), joined(at, F.col("location")))})
    seen = seen.select(
        at.alias("_at"), "http_status", "location", "content_type", "retry_after", "body", F.col("error").alias("_said"), "_blocked", "address", F.when(~F.col("_blocked") & F.col("_led").rlike(HTTP), F.col("_led")).alias("_next"),
    )
    rows = requests.withColumns({"_at": at, "_redirects": F.lit(0), "_origin": origin(at)})
    rows = rows.join(robots.select(F.col("origin").alias("_origin"), F.col("text").alias("_robots")), "_origin", "left")
    rows = rows.withColumn("_allowed", web.robots_allows(F.col("_robots"), path_of(at), agent)).drop("_robots", "_origin")
    # where a URL leads is known from its own row, so that following is a join of two columns
    leads = seen.filter("_next is not null").select("_at", "_next")
    for _ in range(MOST_REDIRECTS):
        rows = rows.join(leads, "_at", "left").withColumn("_next", F.when(F.col("_allowed"), F.col("_next")))
        rows = rows.withColumns({"_at": F.coalesce("_next", "_at"), "_redirects": F.col("_redirects") + F.col("_next").isNotNull().cast("int")}).drop("_next")
    rows = rows.join(seen, "_at", "left")
    left = F.col("_redirects") < MOST_REDIRECTS
    stop = (
        F.when(F.col("_blocked"), F.concat(F.lit("ssrf_blocked: "), F.col("address"))).when(~F.col("_allowed"), "robots_disallowed").when(F.col("_said").isNull() & F.col("http_status").isNull(), "not_archived")
        .when(F.col("_said").isNotNull(), F.col("_said")).when(moved & left & F.col("location").isNotNull(), "bad_redirect_location").when(moved, "too_many_redirects")
    )
    rows = rows.withColumn("_stop", stop)
    answered = F.col("_stop").isNull() | (F.col("_stop") == "too_many_redirects")
    cut = web.capped(F.col("body"))
    kept = lambda c: F.when(answered, c)
    return rows.select(
        *(c for c in requests.columns), kept(F.col("_at")).alias("final_url"), kept(F.col("http_status")).alias("http_status"), F.col("_redirects").alias("redirects"), F.col("_stop").alias("error"),
        kept(F.col("content_type")).alias("content_type"), kept(cut["body"]).alias("body"), kept(cut["truncated"]).alias("truncated"), F.when(F.col("_stop").isNull(), web.sha256_hex(cut["body"])).alias("body_sha256"),
        kept(web.retry_after(F.col("retry_after"), now)).alias("retry_after_secs"),
    )
