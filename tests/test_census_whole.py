"""format_units and contract_share cover all transfers."""

from pyspark.sql import functions as F

from muster.plans import census

SF = "/root/testdata/sf0.001"


def test_format_units_shows_every_transfer(spark):
    transfers = sum(r["n"] for r in census.run("transfer_classify", spark, SF).collect())
    assert census.run("format_units", spark, SF).count() == transfers > 5000


def test_contract_share_equals_brute_force(spark, monkeypatch):
    monkeypatch.setitem(census.QUERIES, "all_transfers", ("transfers", "select * from transfers"))
    want: dict = {}
    for r in census.run("all_transfers", spark, SF).collect():
        if r["verdict"] == "counted":
            mine = want.setdefault(r["agent"], [0, 0, False])
            mine[0] += r["value_raw"] * r["to_contract"]
            mine[1] += r["value_raw"]
            mine[2] |= r["payer"] % 100 == 0
    got = {r["agent"]: r["pct"] for r in census.run("contract_share", spark, SF).collect()}
    assert got.keys() == want.keys()
    for agent, (part, whole, hidden) in want.items():
        assert got[agent] is None if hidden else abs(float(got[agent]) - 100 * part / whole) < 1e-5


def test_contract_share_has_payees_of_any_id(spark, tmp_path):
    """Every supplier id is raised by 50, so that no payee is below 20."""
    for t in ("customer", "orders"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    for t, c in (("supplier", "s_suppkey"), ("lineitem", "l_suppkey")):
        spark.read.parquet(f"{SF}/{t}.parquet").withColumn(c, F.col(c) + 50).write.parquet(f"{tmp_path}/{t}.parquet")
    assert census.run("contract_share", spark, str(tmp_path)).count() > 0


def test_trigrams_of_a_long_text_take_one_pass(spark, tmp_path):
    """A text of a million characters beside short ones; lowering it again for each of its places would take hours."""
    long = "Und der Die " + " ".join(f"{i:x}" for i in range(200_000))
    rows = [(1, "und der die"), (2, long), (3, None), (4, ""), (5, "x\nDer\U0001f600a")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'' as source", "'' as lang").write.parquet(f"{tmp_path}/documents.parquet")

    def grams(text: str) -> set[str]:
        padded = f"  {text.lower()} "
        return {padded[i : i + 3] for i in range(len(text) + 1)}

    asked = grams("und der die")
    want = {i: round(len(grams(t) & asked) / len(grams(t) | asked), 6) for i, t in rows if t}
    assert len(long) > 10**6
    assert {r["doc_id"]: r["sim"] for r in census.run("search_trigram_topk", spark, str(tmp_path)).collect()} == want
