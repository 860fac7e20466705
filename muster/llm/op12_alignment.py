"""Alignment of two tokenizers over the same bytes, and how often their tokens overlap in the whole corpus.

A chunk is a slice of an Arrow batch with ``chunk_chars`` of text (or one longer text). Its texts, a space before each, stand
one after another in one buffer with the documents' byte offsets. Both encoders give byte lengths, and so the ends of their
tokens in that buffer; the ends are counted once by position (bincount), and both streams are cut into groups where both have
an end. Between two neighbouring ends of any kind lies one pair of overlapping tokens, a *link*. Prefix sums over the ends,
read at the documents' offsets, give the figures of each document.

A pair of ids counts in a document once. Chunks are written with their distinct pairs (a dictionary) and their documents'
distinct links as places in it, so that only distinct pairs of chunks are shuffled: they are summed over the corpus, joined
back to the chunks' dictionaries, and gathered by chunk; a chunk is bounded, and so is what is gathered. Pairs that are in
every document are in a chunk once, so no key is hot.

Words (cut at a space after a character that isn't white space, where neither encoder can join bytes) are encoded once a chunk.

Nulls: null and empty texts, and texts that an encoder doesn't give back byte for byte, have no tokens and only zeros. A row
without id is a document like others; repeated rows are documents each (they count each). An empty table gives no rows;
other columns are ignored. Texts of any length are aligned whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.llm.common import stored, table
from muster.llm.op3_bpe import vocabulary_path

CHUNK_CHARS = 4_000_000
#: The splitter of byte-level vocabularies whose file says "ByteLevel" with "use_regex". (A fixed value.)
SPLITTER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space beyond ASCII; texts with it are only cut after ASCII characters. (Fixed values.)
WIDE_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
CHUNK = (
    "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, links binary, most_bytes long, "
    "pairs array<struct<pair:long,docs:long>>"
)


def byte_table() -> dict[str, int]:
    """The characters that byte-level vocabularies write for the 256 bytes: printable ones for themselves, then those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file: ids of words, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_table()
        as_bytes = {t: bytes(to_byte[c] for c in t) for t in vocab}
        self.bytes = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for t, i in vocab.items():
            self.bytes[i] = as_bytes[t]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        steps = spec.get("pre_tokenizer") or {}
        ranked = all(vocab["".join(m)] == 256 + i for i, m in enumerate(merges)) and steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space")
        if ranked and not spec.get("normalizer"):
            import tiktoken

            self.encode = tiktoken.Encoding("own", pat_str=SPLITTER, mergeable_ranks={as_bytes[t]: i for t, i in vocab.items()}, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self.encode = lambda word: library.encode(word, add_special_tokens=False).ids

    def words(self, words: list[str]) -> list[list[int]]:
        encode = self.encode
        return [encode(w) for w in words]


class Pieces:
    """A piece vocabulary with byte fallback, which adds the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a vocabulary whose pieces cross words can't be cut at spaces")

    def words(self, words: list[str]) -> list[list[int]]:
        found = self.model.encode([w[1:] for w in words], num_threads=1)
        lone = [self.model.piece_to_id("▁")]
        return [lone if w == " " else ids for w, ids in zip(words, found, strict=True)]  # nothing is put before an empty text


class Encoder:
    """Ids, byte lengths and decimal names of a vocabulary's tokens."""

    def __init__(self, path: str):
        self.source = Pieces(path) if path.endswith(".model") else ByteLevel(path)
        self.lengths = np.array([len(b) for b in self.source.bytes], np.int64)

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, how many each word has, whether its tokens' bytes are the word's)."""
        texts = words.to_pylist()
        found = self.source.words(texts)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        same = np.fromiter((b"".join([self.source.bytes[i] for i in ids]) == w.encode() for ids, w in zip(found, texts, strict=True)), bool, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts, same


@lru_cache(4)
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary))


@lru_cache(2)
def names(a: str, b: str) -> pa.Array:
    """Decimal ids with what follows them: of A 'id,' and 'id|', then of B 'id,' and 'id;'."""
    return pa.array([f"{i}{mark}" for vocabulary, marks in ((a, ",|"), (b, ",;")) for i in range(len(encoder(vocabulary).lengths)) for mark in marks])


def spans(counts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places starts[k], starts[k] + 1, ... (counts[k] of each), one after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts with a space before each text, how many words each text has)."""
    wide = pc.any(pc.match_substring_regex(texts, WIDE_SPACE)).as_py()
    joined = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar(" "), texts, pa.scalar(""))])
    offsets = np.frombuffer(joined.buffers()[1], np.int32)[: len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], np.uint8)[: offsets[-1]]
    ends_word = np.zeros(256, bool)
    ends_word[0x21:0x7F] = True
    ends_word[0x80:] = not wide
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = (data[1:] == 0x20) & ends_word[data[:-1]]
    begins[offsets] = True
    at = np.flatnonzero(begins).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), joined.buffers()[2])
    return words, np.diff(np.searchsorted(at, offsets))


def align(texts: pa.Array, a: str, b: str) -> dict:
    """Tokens, groups and links of the texts (without nulls) of a chunk.

    Of each text n_a, n_b, n_groups, n_links and groups (bytes of 'a1,a2|b1;...'); link_doc and link_pair of all links in order."""
    of_a, of_b, n = encoder(a), encoder(b), len(texts)
    words, per_text = cut_words(texts)
    coded = words.dictionary_encode()
    which = coded.indices.to_numpy().astype(np.int64)
    (flat_a, count_a, same_a), (flat_b, count_b, same_b) = of_a.words(coded.dictionary), of_b.words(coded.dictionary)
    doc = np.repeat(np.arange(n), per_text)
    bad = np.bincount(doc, weights=~(same_a & same_b)[which], minlength=n) > 0
    bad |= pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    which, doc = which[~bad[doc]], doc[~bad[doc]]
    ids_a = flat_a[spans(count_a[which], (np.cumsum(count_a) - count_a)[which])]
    ids_b = flat_b[spans(count_b[which], (np.cumsum(count_b) - count_b)[which])]
    ends_a, ends_b = np.cumsum(of_a.lengths[ids_a]), np.cumsum(of_b.lengths[ids_b])
    size = np.where(bad, 0, pc.binary_length(texts).to_numpy().astype(np.int64) + 1)
    borders = np.cumsum(size)
    width = int(borders[-1]) + 1 if n else 1
    mark_a, mark_b = np.bincount(ends_a, minlength=width).astype(np.int8), np.bincount(ends_b, minlength=width).astype(np.int8)
    both = mark_a & mark_b
    at = np.flatnonzero(mark_a | mark_b)
    link_a, link_b = ids_a[np.cumsum(mark_a[at]) - mark_a[at]], ids_b[np.cumsum(mark_b[at]) - mark_b[at]]
    out = {"n_a": per_document(ends_a, borders), "n_b": per_document(ends_b, borders), "n_groups": per_document(np.flatnonzero(both), borders), "n_links": per_document(at, borders)}
    before = np.cumsum(both) - both  # groups that end before a position
    group_a, group_b = before[ends_a], before[ends_b]
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a, "left")] = 2 * ids_a + both[ends_a]
    order[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")] = 2 * (len(of_a.lengths) + ids_b) + both[ends_b]
    written = names(a, b).take(pa.array(order))
    text, edges = written.buffers()[2], np.frombuffer(written.buffers()[1], np.int32)[: len(order) + 1]
    stops = edges[np.cumsum(out["n_a"] + out["n_b"])] if n else []
    view, out["groups"], start = memoryview(text) if text else memoryview(b""), [], 0
    for stop in stops:
        out["groups"].append(bytes(view[start : max(start, int(stop) - 1)]))
        start = int(stop)
    return out | {"link_doc": np.repeat(np.arange(n), out["n_links"]), "link_pair": (link_a << 32) | link_b}


def per_document(places: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """How many of the ascending places (each over 0) are up to each border and over the one before."""
    return np.diff(np.searchsorted(places, borders, "right"), prepend=0).astype(np.int64)


def packed(found: dict, digest: bool) -> dict:
    """A chunk's row: distinct links of documents as (document * pairs + place of the pair), their first differences compressed."""
    coded = pa.array(found["link_pair"]).dictionary_encode()
    pairs = coded.dictionary.to_numpy()
    key = np.sort(found["link_doc"] * len(pairs) + coded.indices.to_numpy())
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key, times = key[first], np.diff(np.append(first, len(key)))
    links = np.concatenate([np.diff(key, prepend=0), times]).astype(np.int64).tobytes()
    docs = np.bincount(key % max(1, len(pairs)), minlength=len(pairs)) if len(pairs) else np.zeros(0, np.int64)
    groups = [(sha256(g).hexdigest() if g else "") if digest else g.decode() for g in found["groups"]]
    return {
        **{k: found[k].tolist() for k in ("n_a", "n_b", "n_groups", "n_links")}, "groups": groups, "links": pa.compress(links, codec="zstd", asbytes=True), "most_bytes": len(links),
        "pairs": pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(docs, pa.int64())], ["pair", "docs"]),
    }


def chunks(batches: Iterator[pa.RecordBatch], a: str, b: str, digest: bool, chars: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    listed = pa.list_(pa.int64())
    kinds = {"doc_id": listed, "n_a": listed, "n_b": listed, "n_groups": listed, "n_links": listed, "groups": pa.list_(pa.string()), "links": pa.binary(), "most_bytes": pa.int64()}
    for batch in batches:
        ends, at = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy()), 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chars, side="right")))
            part = batch.slice(at, to - at)
            row = packed(align(pa.concat_arrays([part.column(1)]).fill_null(""), a, b), digest) | {"doc_id": part.column(0).to_pylist()}
            pairs = row.pop("pairs")
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *(pa.array([row[k]], kind) for k, kind in kinds.items()), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pairs)],
                names=["chunk", *kinds, "pairs"],
            )
            number, at = number + 1, to


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents' rows of chunks that have their pairs' counts: (doc_id, ..., links, most_bytes, known: place, n, best)."""
    for batch in batches:
        columns = {name: batch.column(name) for name in batch.schema.names}
        for i in range(batch.num_rows):
            known = columns["known"][i].values
            size = 0 if known is None else len(known)
            n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
            if size:
                place = known.field("place").to_numpy()
                n[place], best[place] = known.field("n").to_numpy(), known.field("best").to_numpy(zero_copy_only=False)
            numbers = np.frombuffer(pa.decompress(columns["links"][i].as_py(), columns["most_bytes"][i].as_py(), codec="zstd", asbytes=True), np.int64)
            key, times = np.cumsum(numbers[: len(numbers) // 2]), numbers[len(numbers) // 2 :]
            place, ids = key % max(1, size), columns["doc_id"][i].values
            edges = np.searchsorted(key, np.arange(len(ids) + 1) * size)
            sums = [np.concatenate([[0], np.cumsum(times * x[place])]) if size else np.zeros(1, np.int64) for x in (best, n)]
            kept = [columns[c][i].values for c in ("n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([ids, *kept, *(pa.array(np.diff(s[edges]), pa.int64()) for s in sums), columns["groups"][i].values], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def align_documents(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", digest: bool = False, chunk_chars: int = CHUNK_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups (decimal ids 'a1,a2|b1;a3|b2,b3', or its SHA-256) of every row.

    n_best: links whose pair counts as much as the best pair of its A id in the corpus; count_sum: the sum of the counts over links.
    ``a``, ``b``: paths or names of public vocabulary files, a .json of byte-level BPE or a .model of pieces for either."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    of_chunk = stored(rows.mapInArrow(lambda batches: chunks(batches, a, b, digest, chunk_chars), CHUNK), "alignment")
    pairs = of_chunk.select("chunk", F.posexplode("pairs").alias("place", "p")).select("chunk", "place", "p.pair", "p.docs")
    counts = stored(pairs.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))), "pair-counts")
    known = pairs.select("chunk", "place", "pair").join(counts, "pair").groupBy("chunk").agg(F.collect_list(F.struct("place", "n", "best")).alias("known"))
    whole = of_chunk.drop("pairs").join(known, "chunk", "left")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    return whole.mapInArrow(counted, out)


def pair_counts(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model", text_col: str = "text") -> DataFrame:
    """a_id, b_id and n (documents in which they are linked) of every pair in the corpus."""
    rows = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    pairs = rows.mapInArrow(lambda batches: chunks(batches, a, b, True), CHUNK).select(F.inline("pairs"))
    return pairs.groupBy("pair").agg(F.sum("docs").alias("n")).select(F.shiftright("pair", 32).alias("a_id"), (F.col("pair") % (1 << 32)).alias("b_id"), "n")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
