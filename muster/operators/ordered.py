"""Ordered work without one task for a key: running sums, as-of joins and exact percentiles (AGG-21, AGG-25, AGG-28, AGG-38, WIN-4).

Rows are dealt by ranges of (key, order), so that a hot key lies in as many partitions as it needs, and written with the number of
their partition. A window then only sees one key's rows of one partition, and what comes before them is carried in from a table
with one row for each key and partition. Nulls of keys are keys, and come first in an order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.sources.archive import stored

PART = "_part"


def ranged(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` dealt by ranges of ``order``, with ``_part``: 0, 1, ... in that order. With their number given, parts aren't coalesced to
    a few large ones, of which a hot key would later have each in one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), label)


def with_carried(rows: DataFrame, carried: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Left (or inner) join by part and key, nulls equal."""
    names = [PART, *by]
    other = carried.withColumnsRenamed({c: f"_c{i}" for i, c in enumerate(names)})
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_c{i}")) for i, c in enumerate(names)))
    return rows.join(other, same, how).drop(*(f"_c{i}" for i in range(len(names))))


def before_parts(by: list[str]):
    """All parts of a key before this one."""
    return Window.partitionBy(*(by or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(df: DataFrame, by: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the key up to and including this one; ``order`` is total in a key."""
    rows = ranged(df, [*map(F.col, by), *order], "running")
    up_to = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_part = rows.groupBy(PART, *by).agg(F.sum(value).alias("_n"))
    carried = per_part.select(PART, *by, F.sum("_n").over(before_parts(by)).alias("_before"))
    return with_carried(rows.withColumn(out, F.sum(value).over(up_to)), carried, by).withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).drop("_before", PART)


def as_of(rows: DataFrame, history: DataFrame, by: list[str], at: str, tie: list[str], values: list[str], keyed: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``values`` of the last row of ``history`` (same ``by``) whose ``at`` isn't after theirs; nulls where there is none.

    ``tie``: columns of ``history`` that order its rows of one ``at``. ``keyed``: (``by``, ...), one row for each key, whose other
    columns come along; rows whose key isn't there (or null) go. It meets what is carried in, one row for each key and partition,
    so that a hot key's rows aren't joined in one task."""
    kept = [c for c in rows.columns if c not in (*by, at)]
    asks = rows.select(*by, at, F.lit(1).alias("_ask"), F.struct(*kept).alias("_row") if kept else F.lit(None).alias("_row"))
    knows = history.select(*by, at, F.lit(0).alias("_ask"), *(F.col(t).alias(f"_t{i}") for i, t in enumerate(tie)), F.struct(*values).alias("_value"))
    order = [at, "_ask", *(f"_t{i}" for i in range(len(tie)))]
    both = ranged(asks.unionByName(knows, allowMissingColumns=True), [*map(F.col, by), *map(F.col, order)], "as-of")
    seen = Window.partitionBy(PART, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("_known", F.last("_value", ignorenulls=True).over(seen)).filter("_ask = 1")
    ends = both.filter("_ask = 0").groupBy(PART, *by).agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    per_part = ends.unionByName(both.filter("_ask = 1").select(PART, *by).distinct(), allowMissingColumns=True).groupBy(PART, *by).agg(F.first("_last", ignorenulls=True).alias("_last"))
    carried = per_part.select(PART, *by, F.last("_last", ignorenulls=True).over(before_parts(by)).alias("_before"))
    more = [c for c in keyed.columns if c not in by] if keyed is not None else []
    if keyed is not None:
        carried = carried.join(keyed.select(*by, F.struct(*more).alias("_of")), by)
    found = with_carried(local, carried, by, "left" if keyed is None else "inner").withColumn("_value", F.coalesce("_known", "_before"))
    return found.select(*by, at, *(F.col(f"_row.{c}").alias(c) for c in kept), *(F.col(f"_value.{v}").alias(v) for v in values), *(F.col(f"_of.{c}").alias(c) for c in more))


def percentiles(df: DataFrame, by: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """``by`` and one column for each fraction: percentile_cont of the values that aren't null, by counts of equal values.

    The value at rank f * (n - 1) from 0, between the values on both sides of it."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_times"))
    ends = running_sum(counts, by, [F.col(value)], "_times", "_end")
    ends = stored(ends, "ranks")
    totals = ends.groupBy(*by).agg(F.max("_end").alias("_n"))
    names = [f"_k{i}" for i in range(len(by))]
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(k)) for c, k in zip(by, names, strict=True)), F.lit(True))
    rows = ends.join(totals.withColumnsRenamed(dict(zip(by, names, strict=True))), same).drop(*names)
    holds = lambda rank: (F.col("_end") > rank) & (F.col("_end") - F.col("_times") <= rank)
    at = {name: F.lit(f) * (F.col("_n") - 1) for name, f in fractions.items()}
    wanted = reduce(lambda a, b: a | b, (holds(F.floor(x)) | holds(F.ceil(x)) for x in at.values()))
    picked = rows.filter(wanted).groupBy(*by).agg(
        *(F.max(F.when(holds(side(x)), F.col(value).cast("double"))).alias(f"_{which}_{name}") for name, x in at.items() for which, side in (("low", F.floor), ("high", F.ceil))),
        *(F.max(x - F.floor(x)).alias(f"_part_{name}") for name, x in at.items()),
    )
    return picked.select(*by, *((F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n) for n in fractions))
