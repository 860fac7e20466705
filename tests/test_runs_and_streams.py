"""Run stores, archives, cursors and the tail."""

import json
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from muster.sources import runs
from muster.streaming import follow
from muster.streaming.blocks import COLUMNS


def checks(spark, *rows):
    return spark.createDataFrame(list(rows), "agent_id long, rung int, status string")


def test_a_run_shows_when_its_row_is_written(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    schema = "agent_id long, rung int, status string"
    store.open("a", "base", 10)
    store.put("a", "checks", checks(spark, (1, 1, "pass")))
    assert store.table("checks", schema).count() == 0 and store.table("checks", schema, unfinished=True).count() == 1
    store.open("a", "base", 99)
    assert store.pin("a") == 10
    ids = spark.createDataFrame([(1,), (2,)], "agent_id long")
    assert [r[0] for r in store.remaining(ids, "a", "checks", schema, "agent_id").collect()] == [2]
    store.publish("a", {"checks": checks(spark, (1, 1, "pass"), (2, 1, "fail"))})
    store.publish("b", {"checks": checks(spark, (3, 1, "pass"))}, complete=False)
    assert sorted(r["agent_id"] for r in store.table("checks", schema).collect()) == [1, 2]
    store.publish("a", {"checks": checks(spark, (5, 1, "pass"))})
    assert [r["agent_id"] for r in store.table("checks", schema).collect()] == [5]
    store.restamp("a", "c2", 8)
    assert {(r["run"], r["status"], r["checker"]) for r in store.runs().collect()} == {("a", "finished", "c2"), ("b", "failed", None)}
    with pytest.raises(LookupError):
        store.exportable("b")
    assert store.exportable("a").first()["unreadable"] is None
    with pytest.raises(ValueError, match="lost"):
        store._state("c", status="lost")


CHECKS = "agent_id long, rung int, status string"


def rows_of(store, name="checks"):
    return sorted((r["run"], r["agent_id"], r["status"]) for r in store.table(name, CHECKS).collect())


def test_a_republication_that_stops_shows_the_old_run_whole(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    store.publish("a", {"checks": checks(spark, (1, 1, "pass")), "more": checks(spark, (1, 2, "pass"))})
    broken = checks(spark, (9, 1, "fail")).filter(F.raise_error(F.lit("stopped")).isNull())
    with pytest.raises(Exception, match="stopped"):
        store.publish("a", {"checks": checks(spark, (8, 1, "fail")), "more": broken})
    assert rows_of(store) == [("a", 1, "pass")] and rows_of(store, "more") == [("a", 1, "pass")] and store.runs().first()["status"] == "finished"
    assert store.vacuum("checks") == 1 and rows_of(store) == [("a", 1, "pass")]
    store.publish("a", {"checks": checks(spark, (8, 1, "fail"))}, only=True)
    assert rows_of(store) == [("a", 8, "fail")] and rows_of(store, "more") == []


def test_an_empty_replacement_empties(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    store.publish("a", {"checks": checks(spark, (1, 1, "pass"))})
    store.publish("b", {"checks": checks(spark, (2, 1, "pass"))})
    store.put("a", "checks", checks(spark, (1, 1, "pass")).limit(0))
    assert rows_of(store) == [("b", 2, "pass")]
    store.put("a", "checks", checks(spark, (3, 1, "pass")))
    assert rows_of(store) == [("a", 3, "pass"), ("b", 2, "pass")]


def test_only_versions_that_count_are_read(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    for k in range(4):
        store.publish("a", {"checks": checks(spark, (k, 1, "pass"))})
    plan = store.table("checks", CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert rows_of(store) == [("a", 3, "pass")] and "dynamicpruning" in plan


def test_a_running_run_is_added_to_and_resumed(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    store.open("a", "base", 5)
    store.add("a", "checks", checks(spark, (1, 1, "pass")))
    store.add("a", "checks", checks(spark, (2, 1, "pass")))
    ids = spark.createDataFrame([(1,), (2,), (3,)], "agent_id long")
    assert [r[0] for r in store.remaining(ids, "a", "checks", CHECKS, "agent_id").collect()] == [3] and rows_of(store) == []
    store.publish("a", {})
    assert len(rows_of(store)) == 2
    with pytest.raises(ValueError, match="not running"):
        store.add("a", "checks", checks(spark, (4, 1, "pass")))


def test_projections_are_published_with_their_table(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path), {"http_archive": ("agent_documents", runs.agent_documents)})
    bodies = lambda *rows: spark.createDataFrame(list(rows), "agent_id long, body binary")
    shown = lambda: sorted((r["run"], r["agent_id"], r["name"], r["error"]) for r in store.table("agent_documents", "agent_id long, name string, description string, error string").collect())
    store.publish("a", {"http_archive": bodies((1, b'{"name":"One"}'), (2, b"{"), (3, None))})
    assert shown() == [("a", 1, "One", None), ("a", 2, None, "bad_json"), ("a", 3, None, "no_body")]
    store.put("a", "http_archive", bodies((4, b'{"name":"Four"}')))
    assert shown() == [("a", 4, "Four", None)]
    store.put("a", "http_archive", bodies((4, b"{}")).limit(0))
    assert shown() == []
    with pytest.raises(Exception, match="stopped"):
        store.publish("a", {"http_archive": bodies((5, b"{}")), "checks": checks(spark, (1, 1, "pass")).filter(F.raise_error(F.lit("stopped")).isNull())})
    assert shown() == []


def test_heartbeats_and_stalled_runs(spark, tmp_path):
    store, at = runs.RunStore(spark, str(tmp_path)), lambda s: datetime(2024, 1, 1, 10) + timedelta(seconds=s)
    for run, beat in (("quiet", 0), ("alive", 500), ("starting", None), ("done", 0)):
        store.open(run, "base", 1, started_at=at(-100))
        if beat is not None:
            store.beat(run, at(beat))
    store.publish("done", {})
    store.beat("done", at(900))
    assert sorted(r["run"] for r in store.stalled(at(901)).collect()) == ["quiet"]
    assert sorted(r["run"] for r in store.stalled(at(900)).collect()) == []
    assert sorted(r["run"] for r in store.stalled(at(3501)).collect()) == ["alive", "quiet", "starting"]
    assert store.end_stalled(at(901)) == 1 and store.end_stalled(at(901)) == 0
    assert {r["run"]: (r["status"], r["end_reason"]) for r in store.runs().collect()} == {"quiet": ("stalled", "nothing written for 900 s"), "alive": ("running", None), "starting": ("running", None), "done": ("finished", None)}


def test_a_wrong_schema_is_not_read_as_empty(spark, tmp_path):
    store = runs.RunStore(spark, str(tmp_path))
    (tmp_path / "log").write_text("not a folder of Parquet files")
    with pytest.raises(Exception, match="(?i)parquet"):
        store.runs().collect()


def test_import_rules(spark, tmp_path):
    folder = tmp_path / "archive"
    (folder / "base").mkdir(parents=True)
    manifest = {"run_id": "r1", "chain": "base", "chain_id": 8453, "started_at": "2024-01-01T00:00:00Z", "finished_at": None, "pinned_block": 5, "checker_version": "x", "schema_version": 1, "unreadable": 3}
    (folder / "manifest.json").write_text(json.dumps(manifest))
    with pytest.raises(ValueError, match="no agents"):
        runs.read_archive(spark, str(folder))
    for i in (2, 1):
        (folder / "base" / f"{i}.json").write_text(json.dumps({"agent_id": i, "owner": "o", "agent_uri": "u", "checks": [{"rung": 1, "status": "pass", "evidence": {"k": i}}], "http_status": 200 if i == 1 else None, "body_sha256": "ab"}, indent=1))
    store = runs.RunStore(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], "chain string, chain_id long, enabled boolean")
    chains = runs.import_archive(store, str(folder), none)
    assert [tuple(r) for r in chains.collect()] == [("base", 8453, False)]
    row = store.runs().first()
    assert (row["status"], row["agent_count"], row["pinned_block"], row["unreadable"], row["checker"]) == ("unknown", 2, 5, 3, "x")
    assert sorted((r["agent_id"], json.loads(r["evidence"])["k"]) for r in store.table("checks", runs.CHECKS, unfinished=True).collect()) == [(1, 1), (2, 2)]
    assert sorted((r["agent_id"], r["http_status"], r["body_sha256"]) for r in store.table("http_archive", runs.FETCHES, unfinished=True).collect()) == [(1, 200, "ab"), (2, None, "ab")]
    with pytest.raises(ValueError, match="replace"):
        runs.import_archive(store, str(folder), chains)
    with pytest.raises(ValueError, match="has id"):
        runs.import_archive(store, str(folder), chains.withColumn("chain_id", F.lit(1).cast("long")), replace=True)
    assert runs.import_archive(store, str(folder), chains, replace=True).count() == 1
    (folder / "base" / "manifest.json").write_text("{}")
    with pytest.raises(ValueError, match="2 manifests"):
        runs.read_archive(spark, str(folder))


def test_rung_replacement_and_progress(spark):
    old = spark.createDataFrame([("r", 1, 6, "pass"), ("r", 2, 6, "pass"), ("r", 2, 1, "pass")], "run string, agent_id long, rung int, status string")
    new = spark.createDataFrame([("r", 1, 6, "fail"), ("r", 2, 6, None)], "run string, agent_id long, rung int, status string")
    assert sorted((r["agent_id"], r["rung"], r["status"]) for r in runs.replaced_rung(old, 6, new).collect()) == [(1, 6, "fail"), (2, 1, "pass")]
    before = spark.createDataFrame([(1, True, None), (2, False, "e")], "id long, ok boolean, error string")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert sorted(r["id"] for r in runs.to_ask(ids, before).collect()) == [2, 3]
    after = runs.progress(before, spark.createDataFrame([(2, None), (3, "x" * 3000)], "id long, error string"))
    assert {r["id"]: (r["ok"], len(r["error"] or "")) for r in after.collect()} == {1: (True, 0), 2: (True, 0), 3: (False, 2000)}
    a = spark.createDataFrame([("r1", 5), ("r2", 7)], "run string, n long")
    b = spark.createDataFrame([("r1", 5), ("r2", 8)], "run string, n long")
    assert [r["run"] for r in runs.recomputed(a, b).collect()] == ["r2"] and runs.recomputed(a, b, dry=False).count() == 2


@pytest.mark.parametrize(
    "known, head, cap, ids, cursor, left",
    [(60000, 60000, 500, [], 60000, 0), (60000, 60003, 500, [60001, 60002, 60003], 60003, 0), (1000, 11000, 500, list(range(1001, 1501)), 1500, 9500), (None, 59997, 500, [], 59997, 0), (42, None, 500, [], None, 0), (60010, 60000, 500, [], 60010, 0), (7, 9, 500, [8, 9], 9, 0)],
)
def test_tail_plan(spark, known, head, cap, ids, cursor, left):
    plan = follow.plan_new_ids(spark, known, head, cap)
    assert ([r[0] for r in plan.ids.orderBy("id").collect()], plan.next_cursor, plan.remaining) == (ids, cursor, left)


def test_reading_stops_at_the_first_failure(spark):
    rows = spark.createDataFrame([(8, True), (9, False), (10, True)], "agent_id long, ok boolean")
    good, cursor = follow.read_until_failure(rows, 7)
    assert [r["agent_id"] for r in good.collect()] == [8] and cursor == 8
    assert follow.read_until_failure(rows.filter("agent_id = 9"), 7)[1] == 7
    assert follow.resume_from(None, 12) == 12 and follow.resume_from(20, 12) == 21


@pytest.fixture
def chain(spark, tmp_path):
    """Functions that put events and heads down, and a follower over them."""
    for name in ("in", "heads"):
        (tmp_path / name).mkdir()

    def put(name, *rows):
        pq.write_table(pa.Table.from_pylist([dict(zip(COLUMNS, r, strict=True)) for r in rows], pa.schema(list(COLUMNS.items()))), tmp_path / "in" / name)

    def head(name, **heads):
        pq.write_table(pa.table({"chain": list(heads), "head": list(heads.values())}), tmp_path / "heads" / name)

    def follower(**given):
        return follow.Follower(spark, str(tmp_path / "out"), **given)

    return put, head, follower, lambda f: f.follow(str(tmp_path / "in"), str(tmp_path / "heads"))


def state(f):
    return {r["chain"]: r["cursor"] for r in f.cursors().collect()}, sorted((r["chain"], r["tx_hash"]) for r in f.events().collect())


def test_the_cursor_follows_the_head(chain):
    put, head, follower, go = chain
    put("1.parquet", ("base", "t1", 0, 1, "e", "p"), ("base", "t2", 0, 100, "e", "p"), ("base", "t2", 0, 100, "e", "p"), ("other", "u1", 0, 3, "e", "p"))
    head("1.parquet", base=101, quiet=40)
    f = follower(confirmations=2)
    go(f)
    assert state(f) == ({"base": 99, "quiet": 38}, [("base", "t1")])
    head("2.parquet", base=102)
    go(f)  # nothing new happened, but the head is deeper
    assert state(f) == ({"base": 100, "quiet": 38}, [("base", "t1"), ("base", "t2")])
    go(follower(confirmations=2))
    assert state(f) == ({"base": 100, "quiet": 38}, [("base", "t1"), ("base", "t2")])
    assert f._read("events", follow.EVENT).count() == 2


def test_batches_are_capped_and_start_at_the_deploy_block(chain):
    put, head, follower, go = chain
    put("1.parquet", *(("base", f"t{b}", 0, b, "e", "p") for b in range(90, 130)))
    head("1.parquet", base=120, early=3)
    f = follower(deploy={"base": 100, "early": 50}, most=9)
    go(f)
    assert state(f)[0] == {"base": 120} and [t for _, t in state(f)[1]] == sorted(f"t{b}" for b in range(100, 121))
    assert sorted(r["cursor"] for r in f._read("cursors", "chain string, cursor long").collect()) == [109, 119, 120]


def test_a_batch_that_is_run_again_changes_nothing_and_a_lost_checkpoint_loses_nothing(spark, chain, tmp_path):
    put, head, follower, go = chain
    put("1.parquet", ("base", "t1", 0, 1, "e", "p"), ("base", "t2", 0, 4, "e", "p"))
    head("1.parquet", base=2)
    f = follower()
    go(f)
    rows = [("base", "t1", 0, 1, "e", "p", None), ("base", None, None, 2, None, None, 2)]
    f.take(spark.createDataFrame(rows, "chain string, tx_hash string, log_index int, block long, event_name string, payload string, upto long"))
    assert f._read("events", follow.EVENT).count() == 1
    (tmp_path / "out" / "checkpoint").rename(tmp_path / "gone")
    head("1.parquet", base=4)
    go(follower())
    assert state(f) == ({"base": 4}, [("base", "t1"), ("base", "t2")])


def test_an_event_above_the_cursor_of_a_stopped_batch_is_not_shown(spark, chain):
    put, head, follower, go = chain
    f = follower()
    rows = [("base", "t1", 0, 1, "e", "p", None), ("base", None, None, 1, None, None, 1)]
    kind = "chain string, tx_hash string, log_index int, block long, event_name string, payload string, upto long"
    f.take(spark.createDataFrame(rows, kind))
    f.take(spark.createDataFrame([("base", "t2", 0, 2, "e", "p", None)], kind))
    assert state(f) == ({"base": 1}, [("base", "t1")])


def test_supersession_and_gateways(spark):
    tail = spark.createDataFrame([("c", 1, None), ("c", 2, "old"), ("c", 3, None)], "chain string, agent_id long, superseded_by string")
    swept = spark.createDataFrame([("c", 1, "r2"), ("c", 1, "r1"), ("c", 2, "r2")], "chain string, agent_id long, run string")
    assert {r["agent_id"]: r["superseded_by"] for r in follow.superseded(tail, swept).collect()} == {1: "r1", 2: "old", 3: None}
    tries = spark.createDataFrame([([("g1", None, "timeout"), ("g2", 404, None), ("g3", 200, None), ("g4", 200, None)],), ([("g1", 500, None)],)], "attempts array<struct<gateway:string,http_status:int,error:string>>")
    assert [r[0] for r in tries.select(follow.winning_gateway()["gateway"]).collect()] == ["g3", None]
    assert follow.high_water(swept.withColumn("chain", F.lit("c")), spark.createDataFrame([("c", 9)], "chain string, cursor long"), "c") == 9
    assert [tuple(r) for r in follow.earliest(spark.createDataFrame([(1, 5, "b"), (1, 3, "a")], "id int, block int, x string"), "id", ["block"]).collect()] == [(1, 3, "a")]
