"""op7_decontaminate against a brute-force search of all windows, on the smallest tables and on edited passages."""

import random
from collections import Counter

import pytest

from muster.llm import op7_decontaminate as op7

SF = "/root/testdata/sf0.001"


def best_windows(text, items) -> dict:
    """The most similar window of the item's length, the first among equals, of each item at SIMILARITY or more."""
    words, out = op7.words_of(text), {}
    own = set(op7.shingles_of(words))
    for i, item in items:
        bag = Counter(op7.shingles_of(op7.words_of(item)))
        n = len(op7.words_of(item))
        if not bag or (n >= 5 and not own & set(bag)):
            continue
        for s in range(max(0, len(words) - n) + 1):
            window = Counter(op7.shingles_of(words[s : s + n], min(5, n)))
            found = sum((window & bag).values()) / sum((window | bag).values()) if window else 0
            if found >= op7.SIMILARITY and found > out.get(i, (0,))[0]:
                out[i] = (found, s, n)
    return out


def test_rows_equal_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r["item_id"], r["text"]) for r in items.collect()]
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["start_word"], r["n_words"]) for r in op7.find_leaks(docs, items).collect()}
    want = {(r["doc_id"], i): (round(found, 9), s, n) for r in docs.collect() for i, (found, s, n) in best_windows(r["text"], listed).items()}
    assert want and got == want


def planted(spot):
    """(items, rows): passages in prose, every second one with words changed."""
    items, rows = [], []
    for k in range(60):
        words = [f"w{spot.randrange(400)}" for _ in range(spot.choice((6, 20, 40, 90)))]
        items.append((k, " ".join(words)))
        for edits in range(4):
            copy = list(words)
            for at in spot.sample(range(len(copy)), min(edits * len(copy) // 40, len(copy) // 3)):
                copy[at] = "changed"
            prose = [f"p{spot.randrange(300)}" for _ in range(80)]
            rows.append((4 * k + edits, " ".join(prose[:30] + copy + prose[30:])))
    return items, rows


@pytest.mark.parametrize("chars", [2_000_000, 4000])
def test_recall_on_edited_passages(spark, monkeypatch, chars):
    monkeypatch.setattr(op7, "BLOCK_CHARS", chars)
    items, rows = planted(random.Random(8))
    want = {(d, i) for d, t in rows for i in best_windows(t, items)}
    found = op7.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert len(want) > 100 and got <= want and len(got) >= 0.98 * len(want)


def test_items_without_id_and_empty_tables(spark):
    text = " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (None, text), (2, None), (3, "")], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (4, text), (5, None)], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in op7.find_leaks(docs, items).collect()} == {(1, None), (1, 4), (None, None), (None, 4)}
    assert sorted(r["doc_id"] for r in op7.without_leaks(docs, items).collect()) == [2, 3]
    assert op7.find_leaks(docs.limit(0), items).count() == 0 and op7.find_leaks(docs, items.limit(0)).count() == 0
