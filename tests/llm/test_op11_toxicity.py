"""op11_toxicity: held-out accuracy, features against plain loops, odd and empty rows."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from muster.llm.op11_toxicity import FEATURES, NEAR, SECOND, Reader, op11_toxicity, score_toxicity

SF = "/root/testdata/sf0.01"
TERMS = [("wscum", 2.0), ("widiot", 3.0), ("wtrash", 1.5), ("bworth", 1.0), ("btrash", 2.5)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def auc(pairs):
    """The share of (toxic, clean) pairs that the score puts in order, ties half."""
    good, bad = np.array([s for s, t in pairs if t]), np.sort([s for s, t in pairs if not t])
    return float(np.mean((np.searchsorted(bad, good, "left") + np.searchsorted(bad, good, "right")) / 2 / len(bad)))


@pytest.fixture(scope="module")
def scored(spark):
    return op11_toxicity(spark, "/root/testdata/sf0.1").collect()


def test_held_out_accuracy(spark, scored):
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet("/root/testdata/sf0.1/documents.parquet").count()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)
    tested = [(r["score"], label[r["doc_id"]]) for r in scored if r["held_out"] and r["doc_id"] in label]
    said = [t for s, t in tested if s >= 0.5]
    assert auc(tested) > 0.93 and np.mean(said) > 0.9 and sum(said) > 0.75 * sum(t for _, t in tested)
    # calibrated: where a score of x is given, about x of the labels are 1
    low, high = [t for s, t in tested if s < 0.2], [t for s, t in tested if s > 0.8]
    assert np.mean(low) < 0.1 and np.mean(high) > 0.8


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end as toxic")
    plain = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels, trees=5).collect()}
    other = {r["doc_id"]: r["score"] for r in score_toxicity(docs.selectExpr("doc_id", "text", "'x' as lang", "'y' as toxic", "1 as score", "2 as hits"), turned, trees=5).collect()}
    assert plain.keys() == other.keys() and all(abs(plain[k] - other[k]) < 1e-9 for k in plain)


def plain(text):
    """Some features by loops over words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    cores = [w.lower().strip("".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»“”„’‘…–—¿¡") for w in words]
    hits = [i for i, c in enumerate(cores) if c in ("scum", "idiot", "trash")]
    begins = [c for c in cores if c.startswith(("worth", "trash"))]
    second = [i for i, c in enumerate(cores) if c in SECOND]
    near = [i for i in hits if any(abs(i - j) <= NEAR for j in second)]
    per = 100 / max(1, len(words))
    return {"hits": len(hits) * per, "begins": len(begins) * per, "second": len(second) * per, "near_hits": near and len(near) * per or 0.0, "exclamations": text.count("!") * per, "capital_words": sum(w.isupper() and len(w) > 1 for w in words) / max(1, len(words)), "distinct": len(set(words)) / max(1, len(words))}


def test_features_equal_loops():
    texts = ["", "You are an idiot! SCUM, worthless trashy", "nothing here at all", " idiot a b c d e f g you h\nTRASH!!", "straße ÉTÉ ich dich scum", "x" * 3000, "idiot " * 2000 + "you"]
    got = Reader(TERMS).features(pa.array(texts))
    for row, text in zip(got, texts, strict=True):
        for name, value in plain(text).items():
            assert abs(row[FEATURES.index(name)] - value) < 1e-9, (text[:30], name)


def test_disguised_words():
    row = Reader(TERMS).features(pa.array(["what an 1d10t and $cum and i.d.i.o.t he is", "a model 404 and 3 more", "i d i o t"]))
    hidden, apart = FEATURES.index("disguised_hits"), FEATURES.index("apart")
    assert row[0][hidden] > 25 and row[1][hidden] == 0 and row[2][apart] == 100


ODD = [(1, None), (2, ""), (3, "   "), (None, "no id"), (4, "word " * 300_000), (5, "idiot"), (5, "idiot")]


def test_odd_rows_and_too_few_labels(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        got = score_toxicity(docs, given).collect()
        assert len(got) == len(ODD) and len({r["score"] for r in got}) == 1 and [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    assert score_toxicity(docs.limit(0), labels).count() == 0


def test_odd_rows_with_fitted_trees(spark):
    """Texts are scored by what they hold: repeated rows alike, and null, empty and blank texts alike."""
    pick = random.Random(2)
    # only the words themselves tell the kinds apart: lengths, from none on, are alike
    taught = [(i, " ".join(pick.choices("the river ran past an old mill you".split(), k=pick.randrange(12)) + ["idiot"] * (i % 4 == 0))) for i in range(1000, 1800)]
    docs, labels = spark.createDataFrame(ODD + taught, "doc_id long, text string"), spark.createDataFrame([(i, int("idiot" in t)) for i, t in taught], "doc_id long, toxic int")
    got = {}
    for r in score_toxicity(docs, labels, trees=3).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert got[1] == got[2] == got[3] and got[5][0] == got[5][1] > got[1][0] and got[5][0] > 0.9 and got[1][0] < 0.1
