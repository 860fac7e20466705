"""The numbered operators against brute force, with null, empty, tied and repeated rows and extra columns."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

from muster.llm import op4_secrets, op6_quality, op9_url_filter
from muster.llm.op1_sharding import Sketch, op1_sharding, shard_documents
from muster.llm.op2_simhash import codewords, fingerprint, near_duplicates
from muster.llm.op3_bpe import encode_documents, vocabulary_path
from muster.llm.op5_language_model import score_documents
from muster.llm.op7_decontaminate import find_leaks
from muster.llm.op8_substrings import remove_repeats
from muster.llm.op10_lines import dedup_lines
from muster.llm.queries import ORACLE_SQL, QUERIES, shard_sql

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(3000))
ROWS = [(1, "alpha beta gamma delta epsilon zeta eta theta", "a"), (2, None, "b"), (3, "", "c"), (4, LONG, "d"), (4, LONG, "d"), (5, "one", "e"), (None, "lonely words here", "f"), (6, LONG[:-9] + "otherend", "g")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = c.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF).select(*names).collect()
    assert sorted(tuple(map(str, r)) for r in got) == sorted(tuple(map(str, r)) for r in want.fetchall())


def test_shards_equal_the_minimax_cut_in_sql(spark, texts):
    c = duckdb.connect()
    c.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = {r[0]: r[1:] for r in c.execute(f"select doc_id, size, shard, slot from ({shard_sql()})").fetchall()}
    got = op1_sharding(spark, SF).collect()
    assert {r["doc_id"]: (r["size"], r["shard"], r["slot"]) for r in got} == want
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in got)


def test_shards_of_odd_rows(odd):
    got = shard_documents(odd, 3).collect()
    assert len(got) == len(ROWS) and len({r["shard"] for r in got if r["size"] == len(LONG) + 1 and r["doc_id"] == 4}) == 1
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert shard_documents(odd.limit(0), 3).count() == 0


def test_sketch_decides_exactly():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 50, 500))
    cuts, split = Sketch(ends, ends).open_ranges(8)
    assert cuts[-1] == ends[-1] and not split.any()


def test_golay_words_one_bit_apart_share_a_codeword():
    words = np.random.default_rng(2).integers(0, 1 << 23, 300)
    for bit in range(23):
        near, (_, at, index) = words ^ (1 << bit), codewords(words)
        own = codewords(near)[0]
        for i in range(len(words)):
            assert own[i] in index[at == i]


def test_near_duplicates(docs, texts, odd):
    ids = list(texts)
    fps = np.array([fingerprint(texts[i]) & (2**64 - 1) for i in ids], np.uint64)
    near, label = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3, np.array(ids)
    while not (label == (new := np.where(near, label[None, :], 1 << 60).min(1))).all():
        label = new
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert got == dict(zip(ids, label.tolist(), strict=True))
    mixed = near_duplicates(odd).collect()
    assert len(mixed) == len(ROWS) and {r["component_id"] for r in mixed if r["doc_id"] in (2, 3)} == {2}


def test_bpe_equals_the_library(spark, docs, texts, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    strange = spark.createDataFrame([(900, "It's ΣΑΣ İx <|endoftext|>a b\x1cc é \U0001f600 9１2 don't'LL"), (901, None), (902, "")], "doc_id long, text string")
    for frame in (docs.select("doc_id", "text"), strange, odd):
        for r in encode_documents(frame).join(frame.select("doc_id", "text").distinct(), "doc_id").collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False) and r["n_tokens"] == len(ids)


def test_entropy_finds_what_patterns_miss_and_allows_known_forms(spark):
    rows = [(1, "see 9fK2mQ7xZp4LwT8rVb3N now"), (2, "id 123e4567-e89b-12d3-a456-426614174000 is fine"), (3, "zzzzzzzzzzzzzzzzzzzzzzzz1"), (4, None), (5, "token = 0123456789abcdef01234567")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in op4_secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("entropy", 4, 24)], 2: [], 3: [], 4: [], 5: [("assign", 0, 32), ("hex", 8, 32)]}


def tokens(text):
    """Words in lower case (A-Z) and the end."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words] + [""]


def test_language_model(docs, texts):
    rows = {r["doc_id"]: r for r in score_documents(docs).collect()}
    counts = Counter(t for i, x in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1 for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    for i, x in texts.items():
        want = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x))
        assert abs(rows[i]["base_score"] - want) < 1e-6 and rows[i]["n_known"] == sum(counts[t] > 0 for t in tokens(x)) and rows[i]["score"] < 0


def test_language_model_on_odd_and_empty_tables(odd):
    assert len(score_documents(odd).collect()) == len(ROWS)
    assert score_documents(odd.limit(0)).count() == 0


def test_quality_keeps_clean_and_drops_junk():
    clean = ("The river ran past the old mill where nobody had worked for years. " + " ".join(f"Sentence{i} goes{i} onward{i} nicely{i}." for i in range(20)))
    assert op6_quality.judge(clean)[6]
    assert not op6_quality.judge(" ".join(w + "&&&" for w in clean.split()))[6]
    assert not op6_quality.judge(None)[6] and op6_quality.repeated_words("a a a a".split()) == 4


def test_leaks(spark):
    item = " ".join(f"b{i}" for i in range(30))
    rows = [(1, "before " + item + " after"), (2, "before " + item.replace("b29", "x") + " after"), (3, "nothing of the kind"), (4, None), (5, ""), (1, "before " + item + " after")]
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    got = find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start_word"]) for r in got) == [(1, 7, 1), (2, 7, 0)]


@pytest.mark.parametrize("most_bytes", [4 << 20, 100])
def test_repeats_equal_brute_force(docs, texts, odd, most_bytes):
    for frame, rows in ((docs, list(texts.items())), (odd, [r[:2] for r in ROWS])):
        seen = Counter(xxhash.xxh3_128_digest(b[k : k + 400]) for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - 399))
        want = []
        for i, t in rows:
            b = (t or "").encode()
            keep = bytearray(b"\1" * len(b))
            for k in range(len(b) - 399):
                if seen[xxhash.xxh3_128_digest(b[k : k + 400])] > 1:
                    keep[k : k + 400] = bytes(400)
            want.append((str(i), hashlib.sha256(bytes(x for x, y in zip(b, keep, strict=True) if y)).hexdigest()))
        got = [(str(r["doc_id"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in remove_repeats(frame, most_bytes=most_bytes).collect()]
        assert sorted(got) == sorted(want)


def test_lists_as_of(spark):
    entries = spark.createDataFrame([("host", "a.x.org", "block", 10), ("host", "a.x.org", "none", 20), ("site", "x.org", "block", 15), ("path", "a.x.org/ok", "allow", 12), ("host", None, "block", 1)], "level string, key string, action string, since int")
    captures = spark.createDataFrame([(1, "http://A.x.org/p", 9), (2, "http://a.x.org/p", 10), (3, "http://a.x.org/p", 20), (4, "http://a.x.org/ok?q", 13), (5, None, 13), (6, "nonsense", 13), (7, "http://b.x.org", None)], "id int, url string, fetched_at int")
    want = {1: ("pass", None), 2: ("block", "host"), 3: ("block", "site"), 4: ("pass", "path"), 5: ("pass", None), 6: ("pass", None), 7: ("pass", None)}
    for most in (100, 0):
        got = op9_url_filter.apply_lists(captures, entries, most_broadcast=most).collect()
        assert {r["id"]: (r["verdict"], r["level"]) for r in got} == want


def test_lines(spark):
    base = "Quiet " + " ".join(f"lantern{i}" for i in range(60))
    near = base.replace("lantern30", "lantern3O")
    rows = [(2, f"{base}\nsecond  line\n\n---"), (1, f"SECOND line\n{near}"), (3, None), (4, ""), (None, "second line\nunique thing")]
    got = {r["doc_id"]: (r["text"], r["note"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as note")).collect()}
    assert got[1] == (f"SECOND line\n{near}", "x") and got[3] == (None, "x") and got[4] == ("", "x") and got[None] == ("unique thing", "x")
    assert got[2][0] in ("\n---", f"{base}\n\n---")


def test_pairs_of_tokens_are_judged_as_all_merges_judge_them():
    import random

    from muster.llm.op3_bpe import encoder

    bpe, pick = encoder(vocabulary_path("word_bpe_49k.json")), random.Random(1)
    tokens = [t for t in bpe.vocab if bpe.may_be(t)]
    inner, short = [t for t in tokens if not t.endswith(bpe.end)], [t for t in tokens if len(t) <= 3]
    for i in range(8000):
        left, right = pick.choice(inner if i % 2 else [t for t in short[:400] if not t.endswith(bpe.end)]), pick.choice(tokens if i % 3 else short)
        assert bpe.compatible(left, right) == (bpe.merged(bpe.symbols(left) + bpe.symbols(right)) == [left, right])


def test_bpe_caches_stay_small_within_a_batch(monkeypatch):
    """A batch with many more distinct pieces than are remembered: the caches keep their bounds, ids and texts are the library's."""
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from muster.llm import op3_bpe

    monkeypatch.setattr(op3_bpe, "LEARNT", 50, raising=False)
    bpe, pick = op3_bpe.TrieBpe(vocabulary_path("word_bpe_49k.json")), random.Random(4)
    bpe.known.most = bpe.words.most = 100
    texts = [" ".join("".join(pick.choices("abcdeéß,'", k=pick.randrange(1, 9))) for _ in range(300)) for _ in range(10)] + [None, "", " \t", "<|endoftext|> It's 12"]
    counts, ids, decoded = bpe.encode(pa.array(texts, pa.string()))
    assert all(len(half) <= 150 for cache in (bpe.known, bpe.words) for half in (cache, cache.old))
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.to_pylist() == want and counts.tolist() == [len(w) for w in want]
    assert decoded.to_pylist() == [library.decode(w, skip_special_tokens=False) for w in want]
