"""Running sums, as-of joins, percentiles and ownership against plain loops: hot keys over many partitions, nulls, ties, empty tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from muster.operators import ordered, ownership


@pytest.fixture(scope="module")
def rows():
    """A hot key with most rows, a null key, equal values."""
    rng = random.Random(5)
    return [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(40), i, rng.randrange(100)) for i in range(3000)]


@pytest.fixture(scope="module", autouse=True)
def many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_sums(spark, rows):
    frame = spark.createDataFrame(rows, "k string, at int, id int, v int")
    for by in (["k"], []):
        sums, want = defaultdict(int), {}
        for k, at, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
            sums[k if by else 0] += v
            want[i] = sums[k if by else 0]
        assert {r["id"]: r["s"] for r in ordered.running_sum(frame, by, [F.col("at"), F.col("id")], "v", "s").collect()} == want
    assert ordered.running_sum(frame.limit(0), ["k"], [F.col("at")], "v", "s").count() == 0


def test_a_hot_key_lies_in_many_parts(spark, rows):
    parts = ordered.ranged(spark.createDataFrame(rows, "k string, at int, id int, v int"), [F.col("k"), F.col("at"), F.col("id")], "t")
    per = [r["n"] for r in parts.filter("k = 'hot'").groupBy("_part").agg(F.count("*").alias("n")).collect()]
    assert len(per) > 5 and max(per) < 700


def test_as_of(spark, rows):
    rng = random.Random(6)
    history = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(-3, 45), j, f"o{j}") for j in range(60)]
    asked, known = spark.createDataFrame(rows, "k string, at int, id int, v int"), spark.createDataFrame(history, "k string, at int, j int, owner string")
    got = {r["id"]: (r["owner"], r["v"]) for r in ordered.as_of(asked, known, ["k"], "at", ["j"], ["owner"]).collect()}
    for k, at, i, v in rows:
        before = [h for h in history if h[0] == k and h[1] <= at]
        assert got[i] == (max(before, key=lambda h: (h[1], h[2]))[3] if before else None, v)
    assert ordered.as_of(asked, known.limit(0), ["k"], "at", ["j"], ["owner"]).filter("owner is null").count() == len(rows)
    assert ordered.as_of(asked.limit(0), known, ["k"], "at", ["j"], ["owner"]).count() == 0


def test_percentiles(spark, rows):
    frame = spark.createDataFrame([*rows, ("one", 0, -1, 7), ("none", 0, -2, None)], "k string, at int, id int, v int")
    got = {r["k"]: (r["low"], r["mid"], r["high"]) for r in ordered.percentiles(frame, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 0.95}).collect()}
    values = defaultdict(list)
    for k, _, _, v in rows:
        values[k].append(v)
    for k, vs in {**values, "one": [7]}.items():
        vs = sorted(vs)
        for found, f in zip(got[k], (0.0, 0.5, 0.95), strict=True):
            at = f * (len(vs) - 1)
            lo, hi = vs[int(at)], vs[min(int(at) + 1, len(vs) - 1)]
            assert abs(found - (lo + (hi - lo) * (at - int(at)))) < 1e-9
    assert "none" not in got


def test_standing_of_payments(spark):
    moves = [(1, 10, 0, "alice"), (1, 20, 0, "bob"), (1, 20, 1, "carol"), (2, 5, 0, "dave")]
    paid = [(1, 9, "x", "pre_mint"), (1, 10, "alice", "by_owner_then"), (1, 12, "carol", "before_acquisition"), (1, 19, "x", "before_acquisition"), (1, 20, "bob", "external"), (1, 21, "carol", "by_owner_then"), (2, 5, "dave", "by_owner_then"), (2, 6, "y", "external"), (3, 6, "y", None)]
    m, p = spark.createDataFrame(moves, "agent long, block long, log_index long, owner string"), spark.createDataFrame(paid, "agent long, block long, payer string, want string")
    got = ownership.owned_payments(p, m).collect()
    assert len(got) == 8 and all(r["standing"] == r["want"] for r in got)
    assert {(r["agent"], r["minted"], r["transfers"], r["owner"], r["acquired"]) for r in ownership.holdings(m).collect()} == {(1, 10, 2, "carol", 20), (2, 5, 0, "dave", 5)}
    assert {r["standing"]: (r["payments"], r["agents"], r["agents_all"]) for r in ownership.exposure(p, m).collect()} == {"pre_mint": (1, 1, 0), "by_owner_then": (3, 2, 0), "before_acquisition": (2, 1, 0), "external": (2, 2, 0)}


def test_payments_to_one_agent_are_in_many_tasks(spark):
    """Nearly all payments go to one agent; no join puts them in one partition (holdings too large to broadcast)."""
    moves = [(a, b, b, f"w{b % 5}") for a in range(20) for b in range(0, 400, 9)]
    m = spark.createDataFrame(moves, "agent long, block long, log_index long, owner string")
    p = spark.range(4000).selectExpr("case when id % 50 = 0 then id % 23 else 1 end as agent", "id % 397 as block", "concat('w', id % 7) as payer", "id")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ownership.owned_payments(p, m).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    per = defaultdict(int)
    for r in got:
        per[r["task"]] += 1
        then = [x for x in moves if x[0] == r["agent"] and x[1] <= r["block"]]
        assert r["owner_then"] == max(then, key=lambda x: x[1])[3] and (r["minted"], r["acquired"], r["owner"]) == (0, 396, "w1")
    assert len(got) == sum(a < 20 for a in ([i % 23 if i % 50 == 0 else 1 for i in range(4000)])) and max(per.values()) < len(got) / 2, per
