"""Queries over records against DuckDB, and the operators behind them case by case."""

import duckdb
import pytest
from pyspark.sql import functions as F

from muster.functions import web
from muster.operators import documents, sellers, verdicts
from muster.plans import api, records, records_sql
from muster.sources.postings import Postings

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def shown(rows):
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(records_sql.ORACLE_SQL))
def test_query_equals_oracle(spark, duck, name):
    want = duck.execute(records_sql.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    rows = want.fetchall()
    got = records.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names) and (rows or name in ("api_agents_facets", "api_tail"))
    assert shown(got.select(*names).collect()) == shown(rows)


@pytest.mark.parametrize(
    "body, error",
    [
        (b'{"a":1}', None), (b'\xef\xbb\xbf{"a":1}', None), (b"\xff", "bad_utf8"), (b'{"a":1} junk', "bad_json"), (b'{"a":1,}', "bad_json"), (b'{"a":NaN}', "bad_json"), (b'{"a":1e400}', "bad_json"),
        (b'{"a":"\\ud800"}', "bad_json"), (b"", "bad_json"), (None, "no_body"), (b"[" * 200 + b"]" * 200, "bad_json"), (b"[" * 128 + b"]" * 128, None), (b'"text"', None), (b"{'a':1}", "bad_json"),
    ],
)
def test_strict_parse(body, error):
    assert documents.strict_parse(body)[1] == error


def test_last_of_repeated_keys_counts_and_a_bom_is_kept_on_request():
    assert documents.strict_parse(b'{"a":1,"a":2}') == ('{"a": 2}', None)
    assert documents.strict_parse(b'\xef\xbb\xbf{}', strip_bom=False)[1] == "bad_json"


def docs(spark, *texts):
    return documents.with_document(spark.createDataFrame([(i, bytearray(t.encode())) for i, t in enumerate(texts)], "id int, body binary"))


def test_projection_takes_strings_only(spark):
    got = documents.project_document(docs(spark, '{"name":" a ","description":""}', '{"name":1}', "[1]", "x")).orderBy("id").collect()
    assert [(r["doc_name"], r["doc_description"], r["doc_error"]) for r in got] == [("a", None, None), (None, None, None), (None, None, "not_an_object"), (None, None, "bad_json")]


def test_conformance_cases(spark):
    whole = '{"type":"t","name":"n","description":"d","image":"i","services":[{"name":"a","version":"1"}],"registrations":[{"agentId":1,"agentRegistry":"x"}]'
    got = documents.conformant(docs(spark, whole + "}", whole + ',"services":null,"endpoints":[{}]}', '{"registrations":[{"agentId":null},{}]}', "[]", '{"services":{}}')).orderBy("id").collect()
    assert (got[0]["status"], got[0]["should"], got[0]["may"]) == ("pass", [], ["x402Support", "active", "supportedTrust"])
    assert (got[1]["services_source"], got[1]["should"]) == ("endpoints", ["services[].version"])
    assert (got[2]["status"], got[2]["must"]) == ("fail", ["registrations[0].agentId", "registrations[0].agentRegistry", "registrations[1].agentId", "registrations[1].agentRegistry"])
    assert got[3]["should"] == ["type", "name", "description", "image", "services", "registrations"] and got[4]["services_status"] == "empty"


@pytest.mark.parametrize(
    "entries, status, entry",
    [
        ('[{"agentId":7,"agentRegistry":"eip155:5:0xAB"}]', "pass", 0), ('[{"agentId":"7","agentRegistry":"eip155:5:0xab"}]', "pass", 0), ('[{"agentId":7.0,"agentRegistry":"eip155:5:0xab"}]', "fail", 0),
        ('[{"agentId":8,"agentRegistry":"eip155:5:0xab"},{"agentId":7,"agentRegistry":"eip155:5:0xab"}]', "pass", 1), ('[{"agentId":8,"agentRegistry":"eip155:5:0xab"},{"agentId":7,"agentRegistry":"eip155:6:0xab"}]', "fail", 0),
        ('[{"agentId":7,"agentRegistry":"eip155:5"}]', "fail", 0), ('[{"agentId":7,"agentRegistry":"solana:5:0xab"}]', "fail", 0), ("[]", "unclaimed", None), ('"x"', "unclaimed", None), ("null", "unclaimed", None), ('[{"agentId":-7,"agentRegistry":5}]', "fail", 0),
    ],
)
def test_bound(spark, entries, status, entry):
    frame = docs(spark, '{"registrations":' + entries + "}").withColumns({"a": F.lit(7).cast("long"), "c": F.lit(5).cast("long"), "r": F.lit("0xAb")})
    got = documents.bound(frame, "a", "c", "r").first()
    assert (got["status"], got["entry"]) == (status, entry)


def test_live_needs_an_asked_endpoint(spark):
    agents = spark.createDataFrame([(i,) for i in range(6)], "id int")
    ends = [(1, "https://a", "https"), (2, "https://b", "https"), (3, "mailto:x", "email"), (4, "https://c", "https"), (4, "https://a", "https"), (5, " https://d ", "https")]
    probes = [("https://a", 404, None), ("https://c", 402, None), ("https://d", None, "robots_disallowed")]
    got = documents.live(agents, spark.createDataFrame(ends, "id int, declared string, kind string"), spark.createDataFrame(probes, "url string, http_status int, error string"), ["id"]).collect()
    assert {r["id"]: (r["status"], r["reason"]) for r in got} == {0: ("unprobeable", "no_services_declared"), 1: ("fail", None), 3: ("unprobeable", "no_probeable_endpoint"), 4: ("pass", None), 5: ("refused", None)}


def test_payment_targets(spark):
    a, dead = "0x" + "ab" * 20, "0x" + "0" * 36 + "dEaD"
    rows = [(1, [a, a.upper().replace("0X", "0X"), "junk ", dead], None, "o"), (2, [], "0x" + "0" * 40, "o"), (3, [a], a, a.upper().replace("0X", "0x"))]
    got = documents.payment_targets(spark.createDataFrame(rows, "id int, wallets array<string>, verified_wallet string, owner string")).collect()
    assert sorted((r["id"], r["basis"], r["address"], r["declared_index"], r["ineligible"]) for r in got if r["id"] == 1) == [(1, "declared_wallet", dead.lower(), 3, "burn_address"), (1, "declared_wallet", a, 0, None), (1, "declared_wallet", "junk", 2, "no_declared_address")]
    assert {(r["id"], r["basis"], r["ineligible"]) for r in got if r["id"] > 1} == {(2, "verified_wallet", "wallet_unset"), (2, "declared_wallet", "no_declared_address"), (3, "verified_wallet", "wallet_equals_owner"), (3, "declared_wallet", None)}


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first()["x"]


def test_addresses_and_hosts(spark):
    assert one(spark, web.normal_address, "\t0X" + "AB" * 20 + " ") == "0x" + "ab" * 20 and one(spark, web.normal_address, "0x12") is None
    assert tuple(one(spark, web.pay_to, "0X" + "ab" * 20)) == (None, "malformed_address") and tuple(one(spark, web.pay_to, " 0x" + "AB" * 20)) == ("0x" + "ab" * 20, None)
    assert tuple(one(spark, web.pay_to, "0x" + "0" * 40)) == (None, "zero_address")
    assert tuple(one(spark, lambda c: web.pay_to(c, "solana"), "1" * 40)) == (None, "zero_address")
    for url, want in (("HTTPS://U:p@Ex.ORG:443/x", ("ex.org", None)), ("http://ex.org:8080", ("ex.org:8080", None)), ("ftp://ex.org", (None, "unsupported_scheme")), ("nothing", (None, "malformed_url")), ("https://bücher.example/", ("xn--bcher-kva.example", None))):
        assert tuple(one(spark, web.url_host, url)) == want, url
    for url, want in (("https://user@Host:8443/p?q", "host"), ("http://[2001:DB8::1]:80/", "2001:db8::1"), ("host/x", "host"), ("https://h:x/", "h:x")):
        assert one(spark, web.probe_host, url) == want


def test_uris(spark):
    import base64
    import gzip

    packed = base64.b64encode(gzip.compress(b"{}")).decode()
    cases = {
        "data:,a%20b%zz+": (b"a b%zz+", "plain", None, None), "data:application/json;base64,e30=": (b"{}", "base64", None, None), "data:;base64,e30": (b"{}", "base64", None, None),
        'data:;base64,{"a":1}': (b'{"a":1}', "base64_claimed_but_raw_json", None, None), f"data:;enc=GZIP;base64,{packed}": (b"{}", "compressed", "gzip", None), "data:;enc=br;base64,e30=": (None, None, "br", "unsupported_compression"),
        "data:;base64,***": (None, None, None, "malformed"), "data:nocomma": (None, None, None, "malformed"),
    }
    assert {u: web.decode_data_uri(u) for u in cases} == cases
    for uri, want in ((" ", "empty"), ("https://x.y", "http"), ('{"a":1}', "data"), ("ipfs://Qm/x", "ipfs"), ("ftp://x", "unsupported"), ("undefined/agents/1", "unsupported"), ("data:;enc=br;base64,e30=", "compressed"), ("data:x", "unsupported")):
        assert one(spark, web.resolve, uri)["scheme"] == want, uri
    assert one(spark, web.ipfs_path, "ipfs:////Qm/x") == "Qm/x" and one(spark, web.ipfs_path, "ipfs://") is None


def test_robots():
    text = "User-agent: other\nDisallow: /o\n\nuser-agent: Bot\nUser-agent: x\nDisallow: /b # why\nAllow: /\nUser-agent: *\nDisallow: /all\nDisallow:"
    assert web.robots_rules(text, "bot") == ["/b", "/all"] and web.robots_rules(text, "none") == ["/all"] and web.robots_rules("", "bot") == []


def test_network_and_headers(spark):
    for ip, want in (("8.8.8.8", True), ("10.1.1.1", False), ("100.64.0.1", False), ("100.128.0.1", True), ("::ffff:127.0.0.1", False), ("2606:4700::1", True), ("fe80::1", False), ("no", None), ("169.254.169.254", False)):
        assert one(spark, web.public_address, ip) == want, ip
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for header, want in (("120", 120), ("Mon, 01 Jan 2024 00:01:00 GMT", 60), ("Sun, 31 Dec 2023 00:00:00 GMT", 0), ("soon", None)):
        assert one(spark, lambda c: web.retry_after(c, now), header) == want, header
    assert tuple(one(spark, lambda c: web.capped(c, 3), bytearray(b"abcd"), "binary")) == (bytearray(b"abc"), True)
    assert one(spark, web.escape_nul, "a\x00b") == "a\\u0000b"
    for text, want in (("", "cbf29ce484222325"), ("a", "af63dc4c8601ec8c"), ("foobar", "85944171f73967e8"), ("é", None)):
        h = 0xCBF29CE484222325
        for b in text.encode():
            h = (h ^ b) * 0x100000001B3 % (1 << 64)
        assert one(spark, web.fnv1a, text) == (want or f"{h:016x}") == f"{h:016x}"


def test_cents_and_choice(spark):
    for amount, want in (("0", 0), ("1", 1), ("10000", 1), ("10001", 2), (str(2**128 - 1), None), ("9" * 37, None)):
        assert one(spark, lambda c: sellers.cents_of(c, 6), amount) == want, amount
    usdc = sellers.ASSETS[0][1]
    quote = lambda amount, network="base", asset=usdc: ("exact", network, amount, asset, "p", None, None)
    cases = [([], "no_quote", None), ([quote("1", "solana")], "out_of_scope_network", None), ([quote("200000"), quote("90000"), quote("90000")], "buy", 1), ([quote("200000"), quote("1", asset="0x1")], "over_cap", None), ([quote("1", asset="0x1")], "unpriced", None), ([quote("100000", "EIP155:8453")], "buy", 0)]
    rows = spark.createDataFrame([(i, q) for i, (q, _, _) in enumerate(cases)], f"id int, quotes array<{sellers.QUOTE}>")
    assert [(r["decision"], r["index"]) for r in sellers.decide(rows).orderBy("id").collect()] == [c[1:] for c in cases]


def test_text_expression_of_cents_is_strict(spark):
    from muster.functions.scalar import cents, column

    for amount, want in (("1.5", None), ("-5", None), ("9" * 38, None), ("10001", 2), ("", None), ("0", 0), ("000", 0)):
        assert one(spark, lambda c: column(cents("v")), amount) == want, amount


def test_population_merges_case_and_ports(spark):
    a = "0x" + "ab" * 20
    rows = [("x", a, "https://h.org/1", "base"), ("y", a.upper().replace("0X", "0x"), "https://H.org:443/2", "base"), ("x", "0x" + "0" * 40, "bad", "base"), ("x", a, "ftp://h.org", "base")]
    good, bad = sellers.population(spark.createDataFrame(rows, "catalog string, pay_to string, resource string, network string"))
    assert [tuple(r) for r in good.collect()] == [(a, "h.org", ["x", "y"], ["https://H.org:443/2", "https://h.org/1"])]
    assert sorted(r["reason"] for r in bad.collect()) == ["unsupported_scheme", "zero_address"]
    one_row = sellers.listed(good, spark.createDataFrame([(*r, "5", a) for r in rows], "catalog string, pay_to string, resource string, network string, claimed_amount string, claimed_asset string")).first()
    assert one_row["resource_count"] == 2 and [c["claims"][0]["claimed_amount"] for c in one_row["claims"]] == ["5", "5"]
    assert sellers.exclusive_to(good, "x").count() == 0 and sorted(r["rung"] for r in sellers.host_budget(good, 0).collect()) == [2, 3]


def test_settlement_excludes_us_first(spark):
    some = spark.createDataFrame([("0xA",), ("0xB",), ("0xC",)], "pay_to string")
    moves = spark.createDataFrame([("0xa", "0xUS", 1), ("0xA", "0xa", 2), ("0xA", "0xp", 5), ("0xA", "0xP", 9), ("0xb", "0xb", 3)], "pay_to string, payer string, block long")
    got = {r["pay_to"]: r for r in sellers.settled(some, moves, "0xus").collect()}
    assert (got["0xA"]["status"], got["0xA"]["payments"], got["0xA"]["payers"], got["0xA"]["first_block"], got["0xA"]["last_block"], got["0xA"]["excluded_ours"], got["0xA"]["excluded_self"]) == ("pass", 2, 1, 5, 9, 1, 1)
    assert (got["0xB"]["status"], got["0xB"]["reason"]) == ("fail", "no_settlement_in_window") and got["0xC"]["payments"] == 0


@pytest.mark.parametrize(
    "row, want",
    [
        ((None, "fail", None, "pass", "pass", None, None), [None, "fail", None, "pass", "pass", None, None]), (("pass", None, "fail", "pass", "pass", "pass", "pass"), ["pass", None, "fail", "skipped", "skipped", "skipped", "pass"]),
        (("fail", "pass", None, "pass", "fail", "pass", "pass"), ["fail", "skipped", None, "pass", "fail", "pass", "skipped"]), (("pass", "pass", "pass", None, "pass", "error", None), ["pass", "pass", "pass", None, "pass", "error", None]),
        (("pass", "fail", "pass", "pass", "pass", "pass", "pass"), ["pass", "fail", "skipped", "skipped", "skipped", "skipped", "pass"]), (("pass", "pass", "pass", "pass", "fail", "pass", None), ["pass", "pass", "pass", "pass", "fail", "pass", None]),
    ],
)
def test_sparse_ladders(spark, row, want):
    frame = spark.createDataFrame([row], ", ".join(f"r{r} string" for r in range(1, 8)))
    w = {r: f"r{r}" for r in range(1, 8)}
    assert list(frame.selectExpr(*(f"{verdicts.laddered(r, w)} as l{r}" for r in range(1, 8))).first()) == want


def test_words_that_only_look_like_robots(spark):
    frame = spark.createDataFrame([("robotsXfoo",), ("robots_x",)], "e string")
    assert [r[0] for r in frame.selectExpr(verdicts.resolvable("'http'", "cast(null as int)", "e")).collect()] == ["error", "refused"]


def test_arguments_are_checked(spark):
    assert api.parse_facets(" 2:pass,, 7:fail") == [(2, "pass"), (7, "fail")] and api.parse_runs([3, 1, 3]) == [3, 1] and api.page(900, -4, 500) == (500, 0)
    for bad in ("2", "9:pass", "x:pass", "2:good"):
        with pytest.raises(ValueError):
            api.parse_facets(bad)
    with pytest.raises(ValueError):
        api.parse_runs([])
    c = records.census_tables(spark, SF)
    for call in (lambda: api.rates(c, 99), lambda: api.delta(c, 0), lambda: api.agent(c, "0", -5)):
        with pytest.raises(LookupError):
            call()
    assert api.agents(c, run=1, facets=[(2, "pass"), (2, "pass")]).count() == api.agents(c, run=1, facets="2:pass").count()
    assert api.latest_run(c) == 2 and [r["run"] for r in api.finished(c, "0").collect()] == [2, 0]
    known = c.snapshots.filter("chain = '0'").first()["agent_id"]
    assert api.agent(c, " 0 ", known).first()["origin"] == "census"


def small_census(spark):
    """Two finished runs and one that runs; agent 1 was in the older run only, 2 in both, 3 and 4 in the tail, 5 superseded."""
    frame = spark.createDataFrame
    return api.Census(
        runs=frame([("old", "base", "finished", 1), ("new", "base", "finished", 2), ("now", "base", "running", 3)], "run string, chain string, status string, started_at int"),
        snapshots=frame([("old", "base", 1, "0xA"), ("old", "base", 2, "0xB"), ("new", "base", 2, "0xB"), ("now", "base", 3, "0xC")], "run string, chain string, agent_id long, owner string"),
        documents=frame([("new", 2, "Two", "second")], "run string, agent_id long, name string, description string"),
        checks=frame([("new", 2, 1, "pass", "{}"), ("old", 2, 1, "fail", "{}")], "run string, agent_id long, rung int, status string, evidence string"),
        tail=frame([("base", 3, "0xC", 10, None), ("base", 4, "0x12", 11, None), ("base", 5, "0xC", 12, "new"), ("other", 7, "0xD", 13, None)], "chain string, agent_id long, owner string, seen_at int, superseded_by string"),
        cursors=frame([("base", 5)], "chain string, cursor long"), chains=frame([("base", True)], "chain string, enabled boolean"),
    )


def test_an_agent_is_answered_from_the_latest_run_the_named_run_or_the_tail(spark):
    c = small_census(spark)
    assert (lambda r: (r["run"], r["origin"], r["name"], r["checks"][0]["status"]))(api.agent(c, "BASE", 2).first()) == ("new", "census", "Two", "pass")
    assert (lambda r: (r["run"], r["name"], r["checks"][0]["status"]))(api.agent(c, "base", 2, run="old").first()) == ("old", None, "fail")
    assert api.agent(c, "base", 1, run="old").first()["run"] == "old"
    assert api.agent(c, "base", 3).first()["origin"] == "tail" and api.agent(c, "other", 7).first()["origin"] == "tail"
    for args in (("base", 1), ("base", 5), ("base", 3, "new"), ("base", 2, "none"), ("other", 2)):
        with pytest.raises(LookupError):
            api.agent(c, *args)


def test_the_tail_is_asked_by_id_or_owner(spark):
    c = small_census(spark)
    ids = lambda q: [r["agent_id"] for r in api.tail(c, "base", q).collect()]
    assert ids("4") == [4] and ids(" +3 ") == [3] and ids("0XC") == [3] and ids("0x") == [4, 3]
    for q in ("\u00b2", "99999999999999999999", "9223372036854775808", "\u0663", "-3", "3.0", "1_0"):
        assert ids(q) == []
    assert [r["agent_id"] for r in api.agents_tail(c).collect()] == [7, 4, 3] and api.TAIL_HEAD == 10
    assert (api.as_id("9223372036854775807"), api.as_id("-0"), api.as_id("007")) == (9223372036854775807, 0, 7)


def test_posting_lists_find_what_a_scan_finds(spark, tmp_path):
    words = ["Alpha agent", "alpha beta", "Bêta gamma 12", "", None, "agentic alpha", "gamma-alpha", "x"]
    rows = [(f"r{i % 3}", "base", i, f"0x{i % 7:x}Ab" if i % 11 else None, words[i % 8], words[(i // 8) % 8]) for i in range(400)]
    agents = spark.createDataFrame(rows, "run string, chain string, agent_id long, owner string, name string, description string")
    snapshots, texts = agents.select("run", "chain", "agent_id", "owner"), agents.select("run", "agent_id", "name", "description").filter("name is not null")
    held = Postings(spark, str(tmp_path / "lists"))
    held.add(snapshots.join(texts, ["run", "agent_id"], "left").filter("run <> 'r1'"))
    held.add(snapshots.join(texts, ["run", "agent_id"], "left").filter("run = 'r1'"))
    scan = api.Census(None, snapshots, texts, None, None, None, None)
    lists = api.Census(None, snapshots, texts, None, None, None, None, held)
    for q in ("alpha", "ALPHA beta", "agent", "bêta", "0x1", "0X3a", "nothing", "", "gamma alpha agent", "12 !!", "?", "alph"):
        for asked in (["r1"], ["r2", "r0"]):
            found = [sorted(map(tuple, api.found_by(c, q, asked, snapshots.filter(F.col("run").isin(asked))).select("run", "chain", "agent_id", "owner", "near").collect()), key=str) for c in (scan, lists)]
            assert found[0] == found[1], (q, asked)
            assert list(map(tuple, api.search(scan, q, asked).collect())) == list(map(tuple, api.search(lists, q, asked).collect()))


def test_a_question_reads_its_own_keys(spark, tmp_path):
    agents = spark.range(20_000).selectExpr("'r' as run", "'base' as chain", "id as agent_id", "concat('0x', id) as owner", "concat('name', id) as name", "'d' as description")
    held = Postings(spark, str(tmp_path / "lists"))
    held.add(agents)
    lists = held.lists("token", ["r"]).filter(F.col("key").isin(["name77"]))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(key, [name77])]" in plan.replace("IsNotNull(key), ", "") or "EqualTo(key,name77)" in plan
    assert "PartitionFilters" in plan and lists.count() == 1


def test_drafts(spark):
    got = {r["rung"]: (r["status"], r["gaps"], r["not_applicable"]) for r in api.validate(spark, '{"registrations":[{"agentId":7,"agentRegistry":"eip155:1:0xab"}]}', (7, 1, "0xAB")).collect()}
    assert got[3][0] == got[4][0] == got[5][0] == "pass" and got[4][1] == ["type", "name", "description", "image", "services"] and got[3][2] == [1, 2, 6, 7]
    assert [(r["rung"], r["status"]) for r in api.validate(spark, "nonsense", (7, 1, "0xAB")).collect()] == [(3, "fail"), (4, "skipped"), (5, "skipped")]
