"""Every census query against DuckDB on the smallest tables, and verdict rules row by row."""

import duckdb
import pytest

from muster.functions.scalar import address, column, endpoint_kind, format_units, network
from muster.operators import verdicts
from muster.plans import census

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


@pytest.mark.parametrize("name", sorted(census.QUERIES))
def test_query_equals_oracle(spark, duck, name):
    got = census.run(name, spark, SF)
    want = duck.execute(census.text(name, duck=True))
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert shown(got.select(*names).collect()) == shown(want.fetchall())


def judged(spark, expression, **row):
    kinds = ", ".join(f"cast({v if v is not None else 'null'} as {k}) as {c}" for c, (k, v) in row.items())
    return spark.sql(f"select {kinds}").select(column(expression).alias("x")).first()[0]


@pytest.mark.parametrize(
    "scheme, code, error, status, reason",
    [
        ("empty", None, None, "fail", "no_uri"), ("unsupported", None, None, "fail", "unsupported_scheme"), ("data", None, None, "pass", None), ("data", None, "gzip", "error", "bad_data_uri"),
        ("http", 200, None, "pass", None), ("http", 402, None, "refused", "payment_required"), ("http", 429, None, "refused", "declined"), ("http", 403, None, "fail", "http_status"),
        ("http", 503, None, "refused", "declined"), ("http", None, "robots_disallowed", "refused", "robots"), ("http", None, "ssrf_blocked: x", "fail", "ssrf_blocked"), ("http", None, "timeout", "error", "transport"), ("http", None, None, "error", "no_response"),
    ],
)
def test_resolvable(spark, scheme, code, error, status, reason):
    row = {"s": ("string", f"'{scheme}'"), "c": ("int", code), "e": ("string", f"'{error}'" if error else None)}
    assert judged(spark, verdicts.resolvable("s", "c", "e"), **row) == status
    assert judged(spark, verdicts.resolvable_reason("s", "c", "e"), **row) == reason


def test_ladder_names_the_original_stopper_and_missing_rungs_stop_nothing(spark):
    w = {r: f"r{r}" for r in range(1, 8)}
    row = {f"r{r}": ("string", v) for r, v in enumerate(["'pass'", "'fail'", "'pass'", "'pass'", "'pass'", None, "'pass'"], 1)}
    assert [judged(spark, verdicts.laddered(r, w), **row) for r in range(1, 8)] == ["pass", "fail", "skipped", "skipped", "skipped", None, "pass"]
    assert judged(spark, verdicts.stopper(5, w), **row) == 2


@pytest.mark.parametrize("raw, decimals, want", [("1027924000000", 6, "1027924"), ("1", 18, "0.000000000000000001"), ("0010", 1, "1"), ("0", 6, "0"), ("x1", 6, None), ("", 6, None)])
def test_format_units(spark, raw, decimals, want):
    assert judged(spark, format_units("v", decimals), v=("string", f"'{raw}'")) == want


def test_scalars(spark):
    assert judged(spark, address("v"), v=("string", "' 0X" + "AB" * 20 + "'")) == "0x" + "ab" * 20
    assert judged(spark, address("v"), v=("string", "'0x" + "zz" * 20 + "'")) is None
    assert judged(spark, network("v"), v=("string", "'EIP155:8453'")) == "eip155:8453"
    for v, want in (("'https://x'", "https"), ("'a@b.c'", "email"), ("'eip155:1:0xab'", "caip10"), ("' '", "other"), (None, "missing")):
        assert judged(spark, endpoint_kind("v"), v=("string", v)) == want


def test_plans_have_no_cartesian_products(spark):
    for name in ("findings", "flips", "transfer_classify", "payment_summary"):
        plan = census.run(name, spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["import_roundtrip", "stream_dedup"])
def test_job_equals_oracle(spark, duck, name):
    from muster.plans import jobs

    want = duck.execute(jobs.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert shown(jobs.QUERIES[name](spark, SF).select(*names).collect()) == shown(want.fetchall())


def test_export_keeps_agents_without_checks(spark):
    from muster.plans import jobs

    assert jobs.export_nested(spark, SF).count() == census.run("snapshots_all", spark, SF).count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 15
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
