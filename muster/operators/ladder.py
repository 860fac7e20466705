"""Assembly of a run's checks from observations (VRD-1, VRD-2, VRD-3 to VRD-5, VRD-7, VRD-8, VRD-9, VRD-19; JN-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions.scalar import ZERO
from muster.functions.web import unicode_trim
from muster.operators import documents, verdicts


def unheld(owner: Column) -> Column:
    """VRD-19: whether an id is held by nobody, so that nothing more is asked."""
    return F.lower(unicode_trim(owner)) == ZERO


def run_ladder(checks: DataFrame, key: list[str]) -> DataFrame:
    """VRD-8 over long rows (*key, rung, status): ``status`` with stoppers applied, ``skipped_because_rung`` and ``_status`` of the
    original stopper. Rungs that a key doesn't have stay missing, and stop nothing."""
    wide = checks.groupBy(*key).agg(*(F.max(F.when(F.col("rung") == r, F.col("status"))).alias(f"r{r}") for r in range(1, 8)))
    names = {r: f"r{r}" for r in range(1, 8)}
    stops = wide.select("*", *(F.expr(verdicts.stopper(r, names)).alias(f"s{r}") for r in range(1, 8)))
    by = lambda s: F.coalesce(*(F.when(s == r, F.col(f"r{r}")) for r in range(1, 8)))
    rows = [F.struct(F.lit(r).alias("rung"), F.when(F.col(f"s{r}").isNotNull(), "skipped").otherwise(F.col(f"r{r}")).alias("status"), F.col(f"s{r}").alias("skipped_because_rung"), by(F.col(f"s{r}")).alias("skipped_because_status"), F.col(f"r{r}").isNotNull().alias("there")) for r in range(1, 8)]
    return stops.select(*key, F.inline(F.array(*rows))).filter("there").drop("there")


def assembled(observations: DataFrame, key: list[str]) -> DataFrame:
    """VRD-9: the rungs 1, 2, 3, 4, 5 and 7 of every observation, the ladder applied.

    ``observations``: (*key, owner, scheme, http_status, error, body, truncated, chain_id, registry, has_reputation, authors), key
    includes agent_id. A document that can't be read is judged as null on rungs 4 and 5, which the ladder then hides; rung 7 is asked
    only where rung 1 passes."""
    parsed = documents.with_document(observations.withColumn("body", F.when(~F.coalesce("truncated", F.lit(False)), F.col("body"))))
    null = F.parse_json(F.lit("null"))
    row = parsed.withColumn("doc", F.coalesce("doc", null))
    r1 = F.when(unheld(F.col("owner")), "fail").otherwise("pass")
    r2 = F.expr(verdicts.resolvable("scheme", "http_status", "error"))
    third = documents.parseable(row).withColumnRenamed("status", "r3").drop("reason")
    fourth = documents.conformant(third).withColumnRenamed("status", "r4")
    fifth = documents.bound(fourth, "agent_id", "chain_id", "registry").withColumnRenamed("status", "r5")
    distinct = F.size(F.array_distinct(F.transform("authors", F.lower)))
    r7 = F.when(r1 == "pass", F.when(~F.col("has_reputation"), "error").when(distinct > 0, "pass").otherwise("fail"))
    said = [(1, r1), (2, r2), (3, F.col("r3")), (4, F.col("r4")), (5, F.col("r5")), (7, r7)]
    each = fifth.select(*key, F.inline(F.array(*(F.struct(F.lit(r).alias("rung"), s.alias("status")) for r, s in said)))).filter(F.col("status").isNotNull())
    return run_ladder(each, key)


def candidates(snapshots: DataFrame, archive: DataFrame, checks: DataFrame, key: list[str]) -> DataFrame:
    """JN-2: every snapshot with its archived body and the status of its rung 4, null where there is none."""
    fourth = checks.filter("rung = 4").select(*key, F.col("status").alias("rung4"))
    return snapshots.join(archive.select(*key, "body"), key, "left").join(fourth, key, "left")
