"""Benchmark decontamination with SimHash windows.

Words are runs of letters and digits in lower case; shingles are five words. For every length that a benchmark item has, a
document's windows of that length are fingerprinted (weighted SimHash, from running sums of the shingles' bits, so that each
window costs one subtraction) and looked up in a multi-index over the items of the length: the fingerprint is cut into 8
blocks of 8 bits, and of two fingerprints within RADIUS bits at least one block differs in RADIUS // 8 bits or fewer. The index
names the items; every hit is verified by the exact similarity of the shingles, weighted by how often they occur (sum of
minima over sum of maxima), at 0.8 or more.

Windows that can't reach 0.8 are passed over before that: at least 0.8 of an item's shingles must lie in a window, so windows
with fewer shingles that any item holds are left out. This loses nothing. RADIUS loses a window of similarity 0.8 if its
fingerprint is 23 bits off, where 10 are expected (a deviation of 4.6 standard deviations).

The benchmark is a stated query set: it is cut into blocks of BLOCK_CHARS on Spark (stored in the shared folder), and each
block, held by one task at a time, passes over all documents; documents are not shuffled.

Items and texts with fewer than five words have one shingle: all their words. Nulls: a null text or item has no words
and no leaks; an item without id is searched like any other. Repeated rows are searched each (equal rows of the result are
one); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.common import per_batch, running_totals, stored, table

WIDTH = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCKS = 8
#: Most characters of benchmark text that one pass holds in each task.
BLOCK_CHARS = 2_000_000
#: Words of a document whose windows are fingerprinted at once.
SPAN = 1 << 14
WORDS = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def shingles_of(words: list[str], width: int = WIDTH) -> list[str]:
    if len(words) < width:
        return [" ".join(words)] if words else []
    return [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]


def signs(shingles: list[str]) -> np.ndarray:
    """One row of 64 signs for each shingle."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s) for s in shingles), np.dtype("<u8"), len(shingles))
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel()


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


class Benchmark:
    """A block of items with their shingles and, for each length, the multi-index over the items' fingerprints."""

    def __init__(self, items: list[tuple[int, str]], width: int, radius: int, least: float):
        self.width, self.radius, self.least = width, radius, least
        split = [(i, words_of(t)) for i, t in items]
        self.items = [(i, len(w), Counter(shingles_of(w, width))) for i, w in split if w]
        self.vocabulary = {w for _, ws in split for w in ws}
        self.shingles = {s for _, _, bag in self.items for s in bag}
        self.lengths: dict[int, list[int]] = defaultdict(list)
        for k, (_, n, _) in enumerate(self.items):
            self.lengths[n].append(k)
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= radius // BLOCKS
        self.prints, self.index = {}, {}
        for n, mine in self.lengths.items():
            prints = np.array([packed(signs(list(self.items[k][2].elements())).sum(0, keepdims=True))[0] for k in mine], np.uint64)
            self.prints[n], self.index[n] = prints, [near[:, self.block(prints, b)] for b in range(BLOCKS)]

    @staticmethod
    def block(prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(8 * b)) & np.uint64(255)).astype(np.int64)

    def candidates(self, n: int, prints: np.ndarray) -> np.ndarray:
        """(window, item of the length n) for windows within the radius: a block that is near finds them, the whole decides."""
        found = np.zeros((len(prints), len(self.lengths[n])), bool)
        for b, table in enumerate(self.index[n]):
            found |= table[self.block(prints, b)]
        window, item = np.nonzero(found)
        close = np.bitwise_count(prints[window] ^ self.prints[n][item]) <= self.radius
        return np.stack([window[close], item[close]], 1)

    def held(self, words: list[str], width: int) -> np.ndarray:
        """Running count of the document's shingles of a width that some item holds."""
        count = max(0, len(words) - width + 1)
        out = np.zeros(count + 1, np.int64)
        if count:
            known = np.fromiter(map(self.vocabulary.__contains__, words), bool, len(words))
            run = np.cumsum(np.concatenate([[0], known]))
            for p in np.flatnonzero(run[width:] - run[:-width] == width).tolist():
                out[p + 1] = " ".join(words[p : p + width]) in self.shingles
        return np.cumsum(out)

    def leaks(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity) of the best window of each item that the text leaks."""
        words = words_of(text)
        out, held = [], {}
        for n, items in self.lengths.items():
            width = min(self.width, n)
            if width not in held:
                held[width] = self.held(words, width)
            run, m = held[width], n - width + 1  # m: shingles in a window
            if run[-1] < self.least * m - 1e-9:
                continue
            starts = np.arange(max(0, len(words) - n) + 1)
            starts = starts[run[np.minimum(starts + m, len(run) - 1)] - run[starts] >= self.least * m - 1e-9]
            if not len(starts):
                continue
            best: dict[int, tuple[float, int]] = {}
            for part in np.split(starts, np.flatnonzero(np.diff(starts // SPAN)) + 1):
                low = int(part[0])
                grams = shingles_of(words[low : int(part[-1]) + n], width)
                sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs(grams), axis=0, dtype=np.int32)])
                prints = packed(sums[np.minimum(part - low + m, len(grams))] - sums[part - low])
                for window, item in self.candidates(n, prints).tolist():
                    at = int(part[window])
                    found = similarity(Counter(grams[at - low : at - low + m]), self.items[items[item]][2])
                    best[item] = max(best.get(item, (0.0, 0)), (found, -at))
            out += [(self.items[items[item]][0], -at, n, found) for item, (found, at) in best.items() if found >= self.least]
        return sorted(out, key=lambda leak: (leak[0] is not None, leak))


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about BLOCK_CHARS, cut on Spark; the driver holds one at a time."""
    named = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.col("text").isNotNull())
    size = named.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if size <= BLOCK_CHARS:
        yield [tuple(r) for r in named.collect()]
        return
    ended = running_totals(named.withColumn("n", F.length("text").cast("long")).withColumn("h", F.xxhash64("text")), ["id", "h", "text"], "n", "end")
    cut = stored(ended.select("id", "text", F.floor((F.col("end") - F.col("n")) / BLOCK_CHARS).alias("block")), "benchmark")
    for block in range(size // BLOCK_CHARS + 1):
        yield [tuple(r) for r in cut.filter(F.col("block") == block).select("id", "text").collect()]


def find_leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: float = SIMILARITY, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, start_word, n_words, similarity: the best window of each document for each item that it leaks."""
    names = ["doc_id", "item_id", "start_word", "n_words"]
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in names), T.StructField("similarity", T.DoubleType())])
    parts: list[DataFrame] = []
    for block in _blocks(items, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        cache: list = []

        def work(ids: list, texts: list, shared=shared, cache=cache) -> dict:
            if not cache:
                cache.append(Benchmark(shared.value, width, radius, least))
            rows = [(i, *leak) for i, t in zip(ids, texts, strict=True) for leak in cache[0].leaks(t)]
            return dict(zip([*names, "similarity"], map(list, zip(*rows, strict=True)) if rows else [[]] * 5, strict=True))

        if parts:  # several blocks: their results are stored, so that the broadcast can go
            parts[-1] = stored(parts[-1], "leaks")
        parts.append(per_batch(docs, [F.col(id_col).cast("long"), F.col(text_col).cast("string")], work, schema))
    return reduce(DataFrame.unionByName, parts).distinct()


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", rows: int = 500) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they are. (By Arrow: pandas stays out of the workers' memory.)"""
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    at = docs.columns.index(text_col)
    for block in _blocks(items, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        cache: list = []

        def clean(batches: Iterator[pa.RecordBatch], shared=shared, cache=cache) -> Iterator[pa.RecordBatch]:
            if not cache:
                cache.append(Benchmark(shared.value, WIDTH, RADIUS, SIMILARITY))
            for batch in batches:
                for start in range(0, batch.num_rows, rows):
                    part = batch.slice(start, rows)
                    yield part.filter(pa.array([not cache[0].leaks(t) for t in part.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
