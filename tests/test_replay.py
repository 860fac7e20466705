"""Archived fetches, boundaries, quotas, session functions, and hostile documents."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from muster.functions import session, web
from muster.operators import boundary, documents, fetching
from muster.streaming import quotas

HOPS = [
    ("http://a/1", 301, "http://a/2", None, b"", None), ("http://a/2", 302, "3?x=1", None, b"", None), ("http://a/3?x=1", 307, "//b/4", None, b"", None), ("http://b/4", 200, None, "120", b"body", None),
    ("http://a/0", 302, "/1", None, b"", None), ("http://loop/", 302, "", None, b"", None), ("http://c/", 200, None, None, b"x" * (web.BODY_CAP + 5), None), ("http://d/x/y/z", 302, "../.././w", None, b"", None), ("http://d/w", 404, None, None, b"no", None),
    ("http://e/", 302, "ftp://x/", None, b"", None), ("http://f/", 302, None, None, b"stay", None), ("http://g/", None, None, None, None, "timeout"), ("http://in/", 200, None, None, b"secret", None), ("http://h/", 302, "http://in/", None, b"", None), ("http://r/p/1", 200, None, None, b"r", None),
]


def test_archived_fetches(spark):
    hops = spark.createDataFrame([(u, s, loc, ra, body, err, "10.0.0.1" if u == "http://in/" else "93.184.216.34") for u, s, loc, ra, body, err in HOPS], "url string, http_status int, location string, retry_after string, body binary, error string, address string").withColumn("content_type", F.lit("text/plain"))
    robots = spark.createDataFrame([("http://r", "User-agent: *\nDisallow: /p")], "origin string, text string")
    urls = ["http://a/1", "http://a/0", "http://loop/", "http://c/", "http://d/x/y/z", "http://e/", "http://f/", "http://g/", "http://in/", "http://h/", "http://r/p/1", "http://none/", "http://a/1"]
    got = fetching.fetched(spark.createDataFrame(list(enumerate(urls)), "id int, url string"), hops, robots, "muster", F.lit("2024-01-01").cast("timestamp")).orderBy("id").collect()
    assert [(r["error"], r["http_status"], r["redirects"], r["final_url"]) for r in got] == [
        (None, 200, 3, "http://b/4"), ("too_many_redirects", 307, 3, "http://a/3?x=1"), ("too_many_redirects", 302, 3, "http://loop/"), (None, 200, 0, "http://c/"), (None, 404, 1, "http://d/w"), ("bad_redirect_location", None, 0, None),
        ("too_many_redirects", 302, 0, "http://f/"), ("timeout", None, 0, None), ("ssrf_blocked: 10.0.0.1", None, 0, None), ("ssrf_blocked: 10.0.0.1", None, 1, None), ("robots_disallowed", None, 0, None), ("not_archived", None, 0, None), (None, 200, 3, "http://b/4"),
    ]
    assert got[0]["retry_after_secs"] == 120 and got[0]["body_sha256"] == "230d8358dc8e8890b4c58deeb62912ee2f20357ae92a5cc861b98e68fe31acb5"
    assert got[3]["truncated"] and len(got[3]["body"]) == web.BODY_CAP and got[1]["body_sha256"] is None and not got[0]["truncated"]


@pytest.mark.parametrize("base, location, want", [
    ("http://a/b/c?q#f", "d", "http://a/b/d"), ("http://a/b/c", "./d/../e?x", "http://a/b/e?x"), ("http://a", "d", "http://a/d"), ("http://a/b/", "..", "http://a/"), ("http://a/b", "../../../x", "http://a/x"),
    ("https://a/b", "//c/d", "https://c/d"), ("http://a/b?x=1", "?y=2", "http://a/b?y=2"), ("http://a/b?x=1#old", "#new", "http://a/b?x=1#new"), ("http://a/b", "HTTPS://c", "HTTPS://c"), ("http://a/b/c/", ".", "http://a/b/c/"),
])
def test_joined_locations(spark, base, location, want):
    assert spark.range(1).select(fetching.joined(F.lit(base), F.lit(location))).first()[0] == want


def test_boundaries(spark):
    rows = [("dense", i) for i in range(1000)] + [("one", 0)] + [("hole", i) for i in range(64) if i != 5] + [("gap", i) for i in [*range(10), *range(12, 40)]]
    found = boundary.highest_ids(spark, ["dense", "one", "hole", "none", "gap", "dense"], boundary.by_table(spark.createDataFrame(rows, "chain string, id long")))
    got = {r["chain"]: (None if r["highest"] is None else int(r["highest"]), r["error"], r["steps"]) for r in found.collect()}
    assert got["dense"][:2] == (999, None) and got["one"][:2] == (0, None) and got["hole"][:2] == (63, None) and got["none"] == (None, None, 1) and len(got) == 5
    assert got["gap"][0] in (9, 39) and got["dense"][2] <= 2 * 11 + 2


def test_a_border_that_moves_and_answers_that_fail_are_errors(spark):
    calls = []

    def moving(questions):
        """Id 9 appears while the border is checked."""
        calls.append(1)
        last = questions.count() > 1
        return questions.withColumn("there", F.when(F.col("chain") == "broken", F.when(F.col("id") < 4, True)).otherwise(F.col("id") <= (9 if last else 8)))

    got = {r["chain"]: (r["highest"], r["error"]) for c in (["moves"], ["broken"]) for r in boundary.highest_ids(spark, c, moving).collect()}
    assert got == {"moves": (None, "boundary_check_failed"), "broken": (None, "unreadable")}
    always = boundary.highest_ids(spark, ["big"], lambda q: q.withColumn("there", F.lit(True))).first()
    assert always["error"] == "overflow" and always["highest"] is None


def test_quotas_equal_a_loop(spark, tmp_path):
    rng, rows, at = random.Random(4), [], 0
    for i in range(400):
        at += rng.choice([0, 1, 5, 40, 300])
        rows.append((rng.choice("aab"), i, 1_700_000_000 + at))
    limits = ((2, 60), (5, 600))
    for k in range(4):
        (tmp_path / f"{k}.json").write_text("\n".join(json.dumps({"key": r[0], "id": r[1], "s": r[2]}) for r in rows[k * 100 : k * 100 + 100]))
        os.utime(tmp_path / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # the order in which files are taken
    stream = spark.readStream.schema("key string, id long, s long").option("maxFilesPerTrigger", 1).json(str(tmp_path))
    out = quotas.quota_stream(stream.select("key", "id", F.timestamp_seconds("s").alias("time")), limits)
    query = out.writeStream.format("memory").queryName("quotas").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r["id"]: (r["let_through"], r["wait_us"]) for r in spark.table("quotas").collect()}
    hits = {}
    for key, i, s in rows:
        times, waits = hits.setdefault(key, []), []
        for limit, seconds in limits:
            inside = [t for t in times if s - t < seconds]
            if len(inside) >= limit:
                waits.append(seconds - (s - inside[len(inside) - limit]))
        assert got[i] == (not waits, max(waits) * 1_000_000 if waits else None), i
        if not waits:
            times.append(s)
    assert len(got) == 400 and 50 < sum(x for x, _ in got.values()) < 350


def test_session_functions(spark):
    session.register_document_fields(spark)
    bodies = [b'{"name":" a ","description":""}', b'{"name":1}', b"[1]", b"{", b"\xff", None, b'{"name":"x","agentId":' + b"9" * 1200 + b"}"]
    docs = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "id int, body binary")
    got = spark.sql("select id, f.* from (select id, document_fields(body) as f from {docs}) order by id", docs=docs).collect()
    assert [tuple(r)[1:] for r in got] == [("a", None, None), (None, None, None), (None, None, "not_an_object"), (None, None, "bad_json"), (None, None, "bad_utf8"), (None, None, "no_body"), (None, None, "bad_json")]


@pytest.mark.parametrize("text, error, shown", [
    ("9" * 400, "bad_json", None), ("9" * 1200, "bad_json", None), ("-" + "9" * 5000, "bad_json", None), ("1" + "0" * 308, None, "1e+308"), ("18446744073709551615", None, "18446744073709551615"), ("18446744073709551616", None, "1.8446744073709552e+19"),
    ("-9223372036854775808", None, "-9223372036854775808"), ("-9223372036854775809", None, "-9.223372036854775808e+18"), ("0." + "1" * 5000, None, None), ("1e-5000", None, None),
])
def test_hostile_numbers_are_judged_and_never_stop_a_job(spark, text, error, shown):
    out, said = documents.strict_parse(f'{{"a":{text}}}'.encode())
    assert said == error and (shown is None or float(json.loads(out)["a"]) == float(shown))
    rows = [(1, f'{{"name":"n","agentId":{text}}}'.encode()), (2, b'{"name":"good"}')]
    got = documents.parseable(documents.project_document(documents.with_document(spark.createDataFrame(rows, "id int, body binary").withColumn("truncated", F.lit(False))))).orderBy("id").collect()
    assert [(r["status"], r["doc_name"]) for r in got] == [("fail", None) if error else ("pass", "n"), ("pass", "good")]


def test_large_integers_are_no_agent_ids(spark):
    rows = [("18446744073709551615",), ("18446744073709551616",), ('"18446744073709551616"',), ("7",)]
    docs = documents.with_document(spark.createDataFrame([(i, f'{{"agentId":{t}}}'.encode()) for i, (t,) in enumerate(rows)], "id int, body binary"))
    assert [r[0] and int(r[0]) for r in docs.orderBy("id").select(documents.unsigned(F.col("doc"), "agentId")).collect()] == [18446744073709551615, None, None, 7]


def test_packed_bodies_are_unpacked_up_to_the_cap():
    bomb = gzip.compress(b"\0" * (64 << 20))
    assert len(bomb) < 100_000 and len(web.unpacked(bomb)) == web.BODY_CAP + 1
    assert web.unpacked(gzip.compress(b"one") + gzip.compress(b" two")) == b"one two" and web.unpacked(gzip.compress(b"")) == b""
    for bad in (b"no gzip", gzip.compress(b"long text here")[:-12]):
        with pytest.raises(Exception):
            web.unpacked(bad)


def test_nul_in_json_keys_and_values(spark):
    texts = ['{"a\\u0000b":["x\\u0000",{"c":"\\\\u0000"}]}', '{"a":"\\\\\\u0000"}', '{"a":1}']
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(web.escape_nul_json(F.col("t"))).collect()]

    def escaped(v):
        if isinstance(v, str):
            return v.replace("\0", "\\u0000")
        if isinstance(v, list):
            return [escaped(x) for x in v]
        return {escaped(k): escaped(x) for k, x in v.items()} if isinstance(v, dict) else v

    assert [json.loads(g) for g in got] == [escaped(json.loads(t)) for t in texts]
