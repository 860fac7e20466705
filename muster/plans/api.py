"""The read calls of the census as functions that return DataFrames: runs, rates, findings, delta, agents, agent, search, tail,
tail_summary, validate, methodology (2.12 of the survey, with FLT-1 to FLT-12, SRT-1 to SRT-4, SET-5, SET-7, O-SEARCH, O-ID).

Arguments are checked before anything is planned (ValueError); an unknown run or agent is a LookupError. Filters are added only
where their argument is given. A page is cut first and joined to its rungs after.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.operators import documents
from muster.operators.verdicts import PARENT
from muster.sources.archive import stored
from muster.sources.postings import LEAST_SIMILAR, Postings, Question, texts, tokens, trigrams

#: Words and names of the ladder. (Fixed values.)
STATUSES = ("pass", "fail", "skipped", "error", "refused", "unclaimed", "unprobeable")
RUNGS = {1: "registered", 2: "resolvable", 3: "parseable", 4: "conformant", 5: "bound", 6: "live", 7: "attested"}
#: Pages, runs of a search, items of each, the least trigram similarity. (Fixed values.)
MOST_AGENTS, MOST_TAIL, MOST_RUNS, ITEMS, TAIL_HEAD = 500, 200, 16, 5, 10


@dataclass
class Census:
    """The tables that the calls read.

    ``runs``: run, chain, status, started_at, finished_at, checker, schema_version. ``snapshots``: run, chain, agent_id, owner.
    ``documents``: run, agent_id, name, description. ``checks``: run, agent_id, rung, status, evidence (JSON text).
    ``tail``: chain, agent_id, owner, seen_at, superseded_by. ``cursors``: chain, cursor. ``chains``: chain, enabled. ``postings``: lists of
    the runs that are searched, if there are any."""

    runs: DataFrame
    snapshots: DataFrame
    documents: DataFrame
    checks: DataFrame
    tail: DataFrame
    cursors: DataFrame
    chains: DataFrame
    postings: Postings | None = None


# -- arguments -----------------------------------------------------------------------------------------------------


def checked_rung(rung: int) -> int:
    """FLT-4."""
    if rung not in RUNGS:
        raise ValueError(f"rung {rung} is not one of 1 to 7")
    return rung


def checked_status(status: str) -> str:
    """FLT-4."""
    if status not in STATUSES:
        raise ValueError(f"status {status!r} is not one of {', '.join(STATUSES)}")
    return status


def parse_facets(text: str) -> list[tuple[int, str]]:
    """FLT-3: ``2:pass, 3:fail`` as pairs; empty parts are passed over."""
    out = []
    for part in filter(None, map(str.strip, text.split(","))):
        rung, colon, status = part.partition(":")
        if not colon or not rung.strip().lstrip("+-").isdigit():
            raise ValueError(f"facet {part!r} is not of the form rung:status")
        out.append((checked_rung(int(rung)), checked_status(status.strip())))
    return out


def parse_runs(runs: Sequence) -> list:
    """SET-5: the runs asked for, each once, in the order they were first named; at most MOST_RUNS."""
    out = list(dict.fromkeys(runs))
    if not 0 < len(out) <= MOST_RUNS:
        raise ValueError(f"between 1 and {MOST_RUNS} runs can be searched")
    return out


def as_id(q: str) -> int | None:
    """O-ID: a question that is an id: ASCII digits (after a plus, if any) of a number that a long holds."""
    found = re.fullmatch(r"\+?[0-9]+|-0+", q.strip(), re.ASCII)
    return None if found is None or int(found[0]) >= 1 << 63 else int(found[0])


def page(limit: int, offset: int, most: int) -> tuple[int, int]:
    """FLT-10."""
    return min(max(limit, 1), most), max(offset, 0)


# -- search --------------------------------------------------------------------------------------------------------


def similarity(name: Column, q: Question) -> Column:
    """Of a name and the question, by trigrams."""
    x = trigrams(name)
    return q.near(F.size(F.array_intersect(x, texts(q.trigrams))), F.size(x))


def matches(q: Question, name: Column, description: Column, owner: Column, near: Column) -> Column:
    """O-SEARCH: all of its tokens in name and description, or a similar name, or an owner that begins so."""
    held = F.array_union(tokens(name), tokens(description))
    every = F.size(F.array_except(texts(q.tokens), held)) == 0 if q.tokens else F.lit(False)
    return every | (near >= LEAST_SIMILAR) | F.coalesce(F.lower(owner).startswith(q.text.lower()), F.lit(False))


def found_by(c: Census, q: str, runs: Sequence, snapshots: DataFrame) -> DataFrame:
    """``snapshots`` that a question finds, with name and near: by the posting lists where there are some, else by a scan."""
    asked = Question.of(snapshots.sparkSession, q)
    if c.postings is not None:
        return snapshots.join(c.postings.candidates(asked, runs), ["run", "chain", "agent_id"])
    texts_of = c.documents.filter(F.col("run").isin(list(runs))).select("run", "agent_id", "name", "description")
    each = snapshots.join(texts_of, ["run", "agent_id"], "left").withColumn("_near", similarity(F.col("name"), asked))
    return each.filter(matches(asked, F.col("name"), F.col("description"), F.col("owner"), F.col("_near"))).select(*snapshots.columns, F.round("_near", 9).alias("near"))


def named(c: Census, rows: DataFrame, runs: Sequence) -> DataFrame:
    """A few rows (a page) with the names of their documents."""
    return rows.join(c.documents.filter(F.col("run").isin(list(runs))).join(F.broadcast(rows.select("run", "agent_id")), ["run", "agent_id"], "left_semi").select("run", "agent_id", "name"), ["run", "agent_id"], "left")


# -- runs ----------------------------------------------------------------------------------------------------------


def runs(c: Census, chain: str | None = None) -> DataFrame:
    """All runs, newest first."""
    out = c.runs if chain is None else c.runs.filter(F.col("chain") == chain)
    return out.orderBy(F.desc("started_at"), "run")


def finished(c: Census, chain: str | None = None, most: int | None = None) -> DataFrame:
    """FLT-6: finished runs, newest first."""
    out = runs(c, chain).filter("status = 'finished'")
    return out if most is None else out.limit(most)


def latest_run(c: Census, chain: str | None = None):
    """FLT-5: the finished run that was started last."""
    row = finished(c, chain, 1).first()
    if row is None:
        raise LookupError("no finished run")
    return row["run"]


def _known(c: Census, run) -> None:
    if c.runs.filter(F.col("run") == run).limit(1).count() == 0:
        raise LookupError(f"no run {run}")


def rates(c: Census, run) -> DataFrame:
    """AGG-1: one row for each rung, with an array of (status, agents)."""
    _known(c, run)
    counts = c.checks.filter(F.col("run") == run).groupBy("rung", "status").agg(F.count("*").alias("agents"))
    return counts.groupBy("rung").agg(F.array_sort(F.collect_list(F.struct("status", "agents"))).alias("statuses")).orderBy("rung")


def findings(c: Census, run=None) -> DataFrame:
    """AGG-2, UDF-2, LIF-5: run, finding, numerator, denominator and percent (null without denominator); of one run or all.

    One pass over the checks: a row per agent, then conditional counts."""
    if run is not None:
        _known(c, run)
    mine = lambda df: df if run is None else df.filter(F.col("run") == run)
    r = lambda n: F.max(F.when(F.col("rung") == n, F.col("status")))
    bare = F.max(F.when(F.col("rung") == 4, F.get_json_object("evidence", "$.services_status").isin("absent", "empty")))
    agents = mine(c.checks).groupBy("run", "agent_id").agg(*(r(n).alias(f"r{n}") for n in (2, 4, 5, 7)), bare.alias("bare"))
    n = lambda cond: F.count(F.when(cond, 1))
    judged, r2, r7 = F.col("r4") != "skipped", F.col("r2"), F.col("r7")
    per = agents.groupBy("run").agg(
        n(judged & F.col("bare")).alias("n1"), n(judged).alias("d1"), n(F.col("r5") == "unclaimed").alias("n2"), n(F.col("r4") == "pass").alias("d2"), n(r7 == "pass").alias("n3"),
        n((r7 == "pass") & (r2 == "pass")).alias("n4"), n((r7 == "pass") & r2.isNotNull()).alias("d4"), n((r7 != "pass") & (r2 == "pass")).alias("n5"), n((r7 != "pass") & r2.isNotNull()).alias("d5"),
    )
    per = per.join(mine(c.snapshots).groupBy("run").agg(F.count("*").alias("d3")), "run", "left").fillna(0, ["d3"])
    named = ("services_absent_or_empty", "registration_unclaimed", "attested", "attested_resolvable", "unattested_resolvable")
    rows = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(k).alias("finding"), F.col(f"n{i}").alias("numerator"), F.col(f"d{i}").alias("denominator")) for i, k in enumerate(named, 1)))
    out = per.select("run", F.inline(rows)).orderBy("run", "place")
    return out.select("run", "finding", "numerator", "denominator", (F.col("numerator").cast("double") * 100.0 / F.nullif("denominator", F.lit(0))).alias("percent"))


def delta(c: Census, run) -> DataFrame:
    """AGG-4 to AGG-7, WIN-7, VRD-18: what changed since the run before on the same chain. A first run has no delta (LookupError).

    Flips between ``refused`` or ``error`` and anything else are in ``flips`` only."""
    order = Window.partitionBy("chain").orderBy("started_at", "run")
    pair = c.runs.filter("status = 'finished'").withColumns({"previous": F.lag("run").over(order), "method_changed": F.coalesce((F.lag("checker").over(order) != F.col("checker")) | (F.lag("schema_version").over(order) != F.col("schema_version")), F.lit(False))})
    row = pair.filter((F.col("run") == run) & F.col("previous").isNotNull()).first()
    if row is None:
        raise LookupError(f"run {run} has no delta")
    sides = [c.checks.filter(F.col("run") == x).select("agent_id", "rung", "status") for x in (row["previous"], run)]
    before, after = sides
    pairs = before.withColumnRenamed("status", "was").join(after.withColumnRenamed("status", "now"), ["agent_id", "rung"]).filter("was <> now")
    flips = pairs.groupBy("rung", "was", "now").agg(F.count("*").alias("agents"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("agents"))), F.lit(0))
    two, refused = F.col("rung") == 2, (F.col("was") == "refused") | (F.col("now") == "refused")
    errored = ~refused & ((F.col("was") == "error") | (F.col("now") == "error"))
    settled = ~refused & ~errored
    summed = flips.agg(
        F.array_sort(F.collect_list(F.struct("rung", "was", "now", "agents"))).alias("flips"), n(two & settled & (F.col("now") == "pass")).alias("newly_resolving"),
        n(two & settled & (F.col("was") == "pass")).alias("stopped_resolving"), n(two & refused).alias("rung2_declined"), n(two & errored).alias("rung2_errored"),
    )
    ids = [s.select("agent_id").distinct() for s in sides]
    both = ids[0].withColumn("b", F.lit(1)).join(ids[1].withColumn("a", F.lit(1)), "agent_id", "full").agg(
        F.count("b").alias("agents_before"), F.count("a").alias("agents_after"), F.count(F.when(F.col("b").isNull(), 1)).alias("newly_registered"), F.count(F.when(F.col("a").isNull(), 1)).alias("disappeared")
    )
    return both.crossJoin(F.broadcast(summed)).select(F.lit(run).alias("run"), F.lit(row["previous"]).alias("previous_run"), F.lit(row["method_changed"]).alias("method_changed"), "*")


# -- agents --------------------------------------------------------------------------------------------------------


def _found(c: Census, run, chain=None, rung=None, status=None, facets: Sequence[tuple[int, str]] = ()) -> DataFrame:
    out = c.snapshots.filter(F.col("run") == run)
    out = out if chain is None else out.filter(F.col("chain") == chain)
    checks = c.checks.filter(F.col("run") == run)
    if rung is not None or status is not None:
        some = checks if rung is None else checks.filter(F.col("rung") == checked_rung(rung))
        some = some if status is None else some.filter(F.col("status") == checked_status(status))
        out = out.join(some.select("agent_id").distinct(), "agent_id", "left_semi")
    asked = sorted({(checked_rung(r), checked_status(s)) for r, s in facets})
    if asked:
        any_ = reduce(Column.__or__, ((F.col("rung") == r) & (F.col("status") == s) for r, s in asked))
        all_ = checks.filter(any_).groupBy("agent_id").agg(F.count_distinct("rung", "status").alias("n")).filter(F.col("n") == len(asked))
        out = out.join(all_.select("agent_id"), "agent_id", "left_semi")
    return out


def agents(c: Census, run=None, chain=None, rung: int | None = None, status: str | None = None, facets: str | Sequence[tuple[int, str]] = (), q: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """A page of agents of a run (the latest one if none is named): chain, agent_id, owner, name, rungs (array of rung, status)
    and the total of all pages. With ``q`` the most similar names come first, else the order is chain and id.

    What a question finds is written once, as ids, for the page and its total; the page is cut first and gets its names after."""
    run = latest_run(c, chain) if run is None else run
    limit, offset = page(limit, offset, MOST_AGENTS)
    found = _found(c, run, chain, rung, status, parse_facets(facets) if isinstance(facets, str) else facets)
    order = [F.col("chain"), F.col("agent_id")]
    if q is not None:
        found = stored(found_by(c, q, [run], found).select("run", "chain", "agent_id", "owner", "near"), "found")
        order.insert(0, F.desc("near"))
    else:
        found = found.withColumn("near", F.lit(0.0))
    cut = named(c, found.orderBy(*order).offset(offset).limit(limit), [run])
    rungs = c.checks.filter(F.col("run") == run).join(F.broadcast(cut.select("agent_id")), "agent_id", "left_semi").groupBy("agent_id").agg(F.array_sort(F.collect_list(F.struct("rung", "status"))).alias("rungs"))
    out = cut.join(rungs, "agent_id", "left").crossJoin(F.broadcast(found.agg(F.count("*").alias("total"))))
    return out.orderBy(*order).select("chain", "agent_id", "owner", "name", "rungs", "total")


def agents_tail(c: Census, chain=None, q: str | None = None) -> DataFrame:
    """What stands beside every page of agents: the newest TAIL_HEAD agents of the tail for the same chain and question."""
    return tail(c, chain, q, TAIL_HEAD)


def agent(c: Census, chain, agent_id: int, run=None) -> DataFrame:
    """An agent of one run, with its checks (``origin`` census): of ``run``, or else of the chain's latest finished one.

    Only where no run is named and that one doesn't have it, its unswept row of the tail answers (``origin`` tail); else LookupError.
    An older run never answers for the latest."""
    chain = str(chain).strip().lower()
    pinned = run is not None
    if not pinned:
        latest = finished(c, chain, 1).first()
        run = None if latest is None else latest["run"]
    have = c.snapshots.filter((F.col("run") == run) & (F.col("chain") == chain) & (F.col("agent_id") == agent_id))
    if run is not None and have.limit(1).count():
        checks = c.checks.filter((F.col("run") == run) & (F.col("agent_id") == agent_id)).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("rung", "status", "evidence"))).alias("checks"))
        names = c.documents.filter((F.col("run") == run) & (F.col("agent_id") == agent_id)).select("run", "name", "description")
        return have.join(names, "run", "left").join(checks, "run", "left").withColumn("origin", F.lit("census"))
    seen = c.tail.filter((F.col("chain") == chain) & (F.col("agent_id") == agent_id) & F.col("superseded_by").isNull())
    if pinned or seen.limit(1).count() == 0:
        raise LookupError(f"no agent {agent_id} on {chain}" + (f" in run {run}" if pinned else ""))
    return seen.withColumn("origin", F.lit("tail"))


def search(c: Census, q: str, asked: Sequence) -> DataFrame:
    """The ITEMS most similar agents of each run with the run's total, in the order of the runs asked for.

    What is found is written once, as ids; the totals and the items of all runs are read from it, and names are joined to the items."""
    order = parse_runs(asked)
    wanted = c.snapshots.sparkSession.createDataFrame(list(enumerate(order)), "place int, run " + dict(c.snapshots.dtypes)["run"])
    mine = c.snapshots.filter(F.col("run").isin(order)).select("run", "chain", "agent_id", "owner")
    found = stored(found_by(c, q, order, mine).select("run", "chain", "agent_id", "near"), "found")
    totals = found.groupBy("run").agg(F.count("*").alias("total"))
    place = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("near"), "chain", "agent_id"))
    top = named(c, found.withColumn("item", place).filter(F.col("item") <= ITEMS), order)
    return F.broadcast(wanted).join(totals, "run", "left").join(top.drop("chain", "near"), "run", "left").select("place", "run", F.coalesce("total", F.lit(0)).alias("total"), "item", "agent_id", "name").orderBy("place", "item")


# -- tail ----------------------------------------------------------------------------------------------------------


def tail(c: Census, chain=None, q: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """FLT-7, SRT-3, O-ID: agents seen but in no run yet, newest first. ``q``: an id, or the beginning of an owner."""
    limit, offset = page(limit, offset, MOST_TAIL)
    out = c.tail.filter("superseded_by is null")
    out = out if chain is None else out.filter(F.col("chain") == chain)
    if q is not None:
        own, number = F.lower("owner").startswith(q.strip().lower()), as_id(q)
        out = out.filter(own if number is None else own | (F.col("agent_id") == number))
    cut = out.orderBy(F.desc("seen_at"), "chain", "agent_id").offset(offset).limit(limit)
    return cut.crossJoin(F.broadcast(out.agg(F.count("*").alias("total")))).orderBy(F.desc("seen_at"), "chain", "agent_id")


def tail_summary(c: Census) -> DataFrame:
    """JN-7, AGG-9: every enabled chain with its unswept agents, the newest of them and its cursor."""
    per = c.tail.filter("superseded_by is null").groupBy("chain").agg(F.count("*").alias("unswept"), F.max("seen_at").alias("newest"))
    return c.chains.filter("enabled").select("chain").join(per, "chain", "left").join(c.cursors, "chain", "left").fillna(0, ["unswept"])


# -- drafts --------------------------------------------------------------------------------------------------------


def methodology() -> dict:
    """The rule lists."""
    special = ["services", "registrations", "services[].version"]
    return {"rungs": RUNGS, "depends_on": PARENT, "must": list(documents.MUST), "should": list(documents.SHOULD), "should_special": special, "may": list(documents.MAY), "statuses": list(STATUSES)}


def not_asked(asked: Column) -> Column:
    """SET-7: the rungs from 1 to 7 that weren't asked, in order."""
    return F.array_sort(F.array_except(F.sequence(F.lit(1), F.lit(7)), asked))


def validate(spark: SparkSession, bodies: DataFrame | bytes | str, intended: tuple[int, int, str] | None = None) -> DataFrame:
    """Rungs 3, 4 and, where ``intended`` (agent id, chain id, registry) is given, 5 of draft documents: one row for each draft
    and rung, with the ladder applied (a draft that doesn't parse has its later rungs skipped), and ``not_applicable``."""
    if not isinstance(bodies, DataFrame):
        raw = bodies.encode() if isinstance(bodies, str) else bodies
        bodies = spark.createDataFrame([(0, raw)], "draft long, body binary")
    parsed = documents.with_document(bodies)
    said = documents.parseable(parsed.withColumn("truncated", F.lit(False)))
    third = said.select("draft", F.lit(3).alias("rung"), "status", "reason", F.array().cast("array<string>").alias("gaps"))
    four = documents.conformant(parsed.withColumn("doc", F.coalesce("doc", F.parse_json(F.lit("null")))))
    open_ = F.col("parse_error").isNull()
    skipped = F.when(~open_, "skipped_because_rung_3")
    fourth = four.select("draft", F.lit(4).alias("rung"), F.when(open_, F.col("status")).otherwise("skipped").alias("status"), skipped.alias("reason"), F.when(open_, F.concat("must", "should")).otherwise(F.array().cast("array<string>")).alias("gaps"))
    out, asked = third.unionByName(fourth), [3, 4]
    if intended is not None:
        agent_id, chain_id, registry = intended
        five = documents.bound(four.withColumnRenamed("status", "fourth").withColumns({"_id": F.lit(agent_id), "_chain": F.lit(chain_id), "_registry": F.lit(registry)}), "_id", "_chain", "_registry")
        stopped = ~open_ | (F.col("fourth") != "pass")
        reason = F.when(~open_, "skipped_because_rung_3").when(F.col("fourth") != "pass", "skipped_because_rung_4")
        out = out.unionByName(five.select("draft", F.lit(5).alias("rung"), F.when(stopped, "skipped").otherwise(F.col("status")).alias("status"), reason.alias("reason"), F.array().cast("array<string>").alias("gaps")))
        asked.append(5)
    return out.withColumn("not_applicable", not_asked(F.array(*map(F.lit, asked)))).orderBy("draft", "rung")
