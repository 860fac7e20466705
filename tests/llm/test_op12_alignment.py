"""op12_alignment against the libraries and plain loops."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest

from muster.llm.op3_bpe import vocabulary_path
from muster.llm.op12_alignment import align_documents, byte_table, cut_words, op12_alignment, pair_counts

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"Wörter{i % 97}x{i % 31}" for i in range(200_000))
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b   c \n\n d\t e "), (5, " wide　space   x"), (6, "<|endoftext|> <s> </s> <unk>"), (7, "▁lower one eighth"), (8, "\U0001f600 ｆｕｌｌ\x00zero é É"), (9, "It's don't'LL we'd"),
    (9, "It's don't'LL we'd"), (None, "no id here"), (10, LONG), (11, "x" * 5000), (12, "a b   c\u0085 d"), (13, "a　 b　c d"),
]


@pytest.fixture(scope="module")
def expected():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")), SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    a.encode_special_tokens = True
    to_byte = byte_table()
    bytes_a = {i: bytes(to_byte[c] for c in t) for t, i in a.get_vocab(False).items()}
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in range(b.get_piece_size()))]

    def one(text):
        """(ids of A, ids of B, groups, links) by walking through the bytes; None for texts without tokens."""
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids if text else [], b.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(bytes_a[i] for i in ia) != whole or b"".join(bytes_b[i] for i in ib) != whole:
            return None
        groups, links, i, j, at_a, at_b = [([], [])], [], 0, 0, 0, 0
        while i < len(ia):
            end_a, end_b = at_a + len(bytes_a[ia[i]]), at_b + len(bytes_b[ib[j]])
            links.append((ia[i], ib[j]))
            if end_a <= end_b:
                groups[-1][0].append(ia[i])
                i, at_a = i + 1, end_a
            if end_b <= end_a:
                groups[-1][1].append(ib[j])
                j, at_b = j + 1, end_b
            if end_a == end_b:
                groups.append(([], []))
        return ia, ib, groups[:-1], links

    def rows(texts):
        each = [one(t) for _, t in texts]
        counts = Counter(p for e in each if e for p in set(e[3]))
        top = Counter()
        for (x, _), n in counts.items():
            top[x] = max(top[x], n)
        out = []
        for (i, _), e in zip(texts, each, strict=True):
            if e is None:
                out.append((str(i), 0, 0, 0, 0, 0, 0, ""))
                continue
            said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in e[2])
            out.append((str(i), len(e[0]), len(e[1]), len(e[2]), len(e[3]), sum(counts[p] == top[p[0]] for p in e[3]), sum(counts[p] for p in e[3]), said))
        return sorted(out), counts

    return rows


def test_odd_rows_equal_plain_loops(spark, expected):
    frame = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as n_a", "'x' as chunk", "2 as links")
    want, counts = expected(ODD)
    got = sorted((str(r["doc_id"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in align_documents(frame).collect())
    assert got == want
    assert {(r["a_id"], r["b_id"]): r["n"] for r in pair_counts(frame).collect()} == counts


def test_query_equals_plain_loops(spark, expected):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in expected(texts)[0]]
    got = sorted((str(r["doc_id"]), r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in op12_alignment(spark, SF).collect())
    assert got == want


def test_small_chunks_give_the_same(spark, expected):
    """Chunks of a few texts: counts come from all of them."""
    frame = spark.createDataFrame(ODD, "doc_id long, text string").repartition(4)
    got = sorted((str(r["doc_id"]), r["n_best"], r["count_sum"]) for r in align_documents(frame, chunk_chars=50).collect())
    assert got == [(r[0], r[5], r[6]) for r in expected(ODD)[0]]


def test_cut_and_empty(spark):
    words, counts = cut_words(pa.array(["ab cd  e", "", " x"]))
    assert words.to_pylist() == [" ab", " cd", "  e", " ", "  x"] and counts.tolist() == [3, 1, 1]
    assert align_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert align_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).filter("n_links = 0 and groups = ''").count() == 2
