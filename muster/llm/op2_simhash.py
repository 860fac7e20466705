"""Near-duplicates by SimHash, found with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. Each segment is a word of the perfect binary Golay code
(23, 12, 7): it lies within distance 3 of exactly one codeword, and a word at distance 3 has exactly five more codewords
at distance 4. Two words that differ in one bit share a codeword among these. With at most three errors over three
segments, either one segment has none and another has one at most, or each has one. So a fingerprint is filed once
in seven tables (an exact segment and the codeword of another: six; the codewords of the first two: one), looked up
under all nearby codewords, and every hit is verified by its bits. No pair within three bits can be missed.

The work is done on distinct fingerprints; documents only meet their fingerprint again at the end.

Nulls: a null text has no words, as an empty one: fingerprint zero. Repeated rows share a component; a null doc_id
counts only where its component has no other id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.common import LOWER, UPPER, components, join_to_key, per_batch, stored, table

#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1. (A fixed value.)
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))
RADIUS = 3
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash over the word shingles of a text, as a signed 64-bit number."""
    words = WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(TO_LOWER))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = words[at : at + 8192 + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (signed 64 bits) of every document, in one pass without a shuffle."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    return per_batch(docs, [F.col(id_col).cast("long"), F.col(text_col).cast("string")], lambda ids, texts: {"doc_id": ids, "fp": [fingerprint(t) for t in texts]}, schema)


def remainder(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator: the syndrome."""
    words = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error pattern to the nearest codeword, its weight, and the five patterns of weight 4 (if the weight is 3)."""
    near, weight, far = np.zeros(2048, np.int64), np.zeros(2048, np.int64), np.zeros((2048, 5), np.int64)
    filled = np.zeros(2048, np.int64)
    for w in range(1, 5):
        patterns = np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(23), w)], np.int64)
        syndromes = remainder(patterns)
        if w < 4:
            near[syndromes], weight[syndromes] = patterns, w
        else:
            for p, s in zip(patterns, syndromes, strict=True):
                if weight[s] == 3:
                    far[s, filled[s]] = p
                    filled[s] += 1
    return near, weight, far


def codewords(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 23-bit words: the index of the nearest codeword; (position, index) of all codewords that it is looked up under."""
    near, weight, far = golay_tables()
    s = remainder(segment)
    index = (segment ^ near[s]) >> 11
    more = np.flatnonzero(weight[s] == 3)
    others = (segment[more, None] ^ far[s[more]]) >> 11
    return index, np.concatenate([np.arange(len(segment)), np.repeat(more, 5)]), np.concatenate([index, others.ravel()])


def golay_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys to file fingerprints under (7 for each), and (position, key) of all to look them up under."""
    u = fps.view(np.uint64)
    segments = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    coded = [codewords(s) for s in segments]
    filed, asked_at, asked = [], [], []
    for t, (i, j) in enumerate(itertools.permutations(range(3), 2)):
        top = (t << 35) | segments[i] << 12
        index, at, near = coded[j]
        filed.append(top | index)
        asked_at.append(at)
        asked.append(top[at] | near)
    (index0, at0, near0), (index1, at1, near1) = coded[0], coded[1]
    filed.append((6 << 35) | index0 << 12 | index1)
    order, counts = np.argsort(at1, kind="stable"), np.bincount(at1, minlength=len(fps))
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    reps = counts[at0]
    within = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    mine = order[np.repeat(starts[at0], reps) + within]
    asked_at.append(np.repeat(at0, reps))
    asked.append((6 << 35) | np.repeat(near0, reps) << 12 | near1[mine])
    return np.stack(filed, 1), np.concatenate(asked_at), np.concatenate(asked)


def _emit(ask: bool):
    names = ["key", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(all_fps), 4096):
                fps = all_fps[at : at + 4096]
                filed, pos, asked = golay_keys(fps)
                columns = (asked, fps[pos]) if ask else (filed.ravel(), np.repeat(fps, 7))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def linked_fingerprints(distinct: DataFrame, column: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints within ``radius`` (3 at most) bits. Each pair may come more than once."""
    if radius > RADIUS:
        raise ValueError("the three Golay segments guarantee three bits")
    fps = distinct.select(F.col(column).alias("fp"))
    filed = fps.mapInArrow(_emit(False), "key long, fp long").withColumnRenamed("fp", "a")
    asked = fps.mapInArrow(_emit(True), "key long, fp long").withColumnRenamed("fp", "b")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    return filed.hint("merge").join(asked, (filed["key"] == asked["key"]) & near).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id that links reach), n_links (of its fingerprint to others)."""
    fps = stored(fingerprints(docs, id_col, text_col), "fps")
    return group_fingerprints(fps).drop("copies")


def group_fingerprints(fps: DataFrame) -> DataFrame:
    """Components of stored rows (doc_id, fp)."""
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "distinct-fps")
    links = stored(linked_fingerprints(distinct).distinct(), "links")
    degree = links.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("n_links"))
    groups = components(links).withColumnRenamed("node", "fp").join(distinct, "fp")
    least = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = groups.join(least, "component").join(degree, "fp").select("fp", "component_id", "n_links")
    keys = stored(distinct.join(named, "fp", "left").select("fp", "copies", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "fp-groups")
    return join_to_key(fps, keys, "fp", "copies", fps.count())


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
