"""Removal of repeated byte strings with a run-length index.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else in the corpus. Matches are decided for
*windows*, one for each start. Of the GRAM-byte grams inside a window, the one with the least hash is its anchor, so that
equal windows have equal anchors at equal places. All consecutive windows with one anchor form a *context* (the bytes
that they cover). Each window lies in exactly one context, and only contexts whose anchors are equal can hold equal
windows:

1. One pass cuts every document into contexts and stores (anchor, hash of the context, place).
2. Contexts that occur twice as a whole are repeated; this is a count by two hashes of 64 bits (anchor and context).
3. What is left are single contexts whose anchor has other contexts. Their bytes, and those of one copy of each of the
   others, are gathered in blocks by anchor. Of each block the run-compressed Burrows-Wheeler transform is built, with
   suffix-array and match-length samples at the ends of its runs. Streaming over the text gives every position's match
   statistics: at a sampled position it is the sample, and one less than before elsewhere, for inside a run the
   neighbours of a suffix stay its neighbours when both lose their first byte. Windows that match LENGTH bytes of a
   neighbour are repeated; their runs are the removed spans.
4. An anchor whose contexts exceed MOST_BYTES is not put into one task: its windows are counted by hash (128 bits) in a
   shuffle.

Nulls: a null text has no bytes. Rows that share doc_id and text are occurrences of their own, which remove each other.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import join_to_key, stored, table

LENGTH = 400
GRAM = 128
#: Bytes that one step of the cutting works on, bytes of a block's index, and most bytes of one anchor's contexts.
CHUNK = 1 << 20
BLOCK = 1 << 20
MOST_BYTES = 4 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
SEPARATOR = 0xFF  # no byte of UTF-8


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def gram_hashes(data: np.ndarray, gram: int, powers: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes (mod 2**64) of all grams."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    out, step = values, 1
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


class Cutter:
    """Cuts concatenated documents into contexts."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK):
        self.length, self.gram, self.chunk = length, gram, chunk
        size = 2 * chunk + length + 1
        self.powers, self.inverse = _powers(size, MULTIPLIER), _powers(size, pow(MULTIPLIER, -1, 1 << 64))

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes, list[tuple[int, int, int]]]]:
        """Bytes of about a chunk with (document, offset in it, offset here) of each part; long documents overlap by a window."""
        held, parts, size = [], [], 0
        for k, text in enumerate(texts):
            for at in range(0, max(1, len(text) - self.length + 1), self.chunk):
                part = text[at : at + self.chunk + self.length - 1]
                if len(part) < self.length:
                    continue
                if size and size + len(part) > 2 * self.chunk:
                    yield b"".join(held), parts
                    held, parts, size = [], [], 0
                held.append(part)
                parts.append((k, at, size))
                size += len(part)
        if parts:
            yield b"".join(held), parts

    def contexts(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(document, first window, windows, anchor, bytes) of each context."""
        for data, parts in self.pieces(texts):
            raw = np.frombuffer(data, np.uint8)
            hashes = gram_hashes(raw, self.gram, self.powers, self.inverse)
            places = np.arange(len(hashes), dtype=np.uint64)
            least = sliding_least((hashes & np.uint64(0xFFFFFFFFFF000000)) | places, self.length - self.gram + 1)
            owner = (least & np.uint64(0xFFFFFF)).astype(np.int64)
            starts = np.array([p[2] for p in parts] + [len(data)], np.int64)
            for (k, at, start), stop in zip(parts, starts[1:].tolist(), strict=True):
                mine = owner[start : stop - self.length + 1]
                cuts = [0, *(np.flatnonzero(np.diff(mine)) + 1).tolist(), len(mine)]
                anchors = hashes[mine[cuts[:-1]]].view(np.int64).tolist()
                for a, b, anchor in zip(cuts, cuts[1:], anchors, strict=False):
                    yield k, at + a, b - a, anchor, data[start + a : start + b + self.length - 1]


class RunLengthIndex:
    """Run-compressed BWT of a text, with the suffix and the match lengths to both neighbours sampled at the ends of runs."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        n = len(raw)
        padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
        words = np.zeros(n, np.uint64)
        for i in range(8):
            words = (words << np.uint64(8)) | padded[i : i + n]
        suffixes = self._sorted(words, n)
        bwt = raw[suffixes - 1].astype(np.int16)
        bwt[suffixes == 0] = 256
        heads = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.n, self.runs = n, len(heads)
        tails = np.concatenate([heads[1:], [n]]) - 1
        self.head_at, self.head_match = suffixes[heads], self._common(words, suffixes, heads - 1, heads)
        self.tail_at, self.tail_match = suffixes[tails], self._common(words, suffixes, tails, tails + 1)

    @staticmethod
    def _sorted(words: np.ndarray, n: int) -> np.ndarray:
        """Suffix array by prefix doubling from 8 bytes on; only ties are sorted again."""
        order = np.argsort(words, kind="stable")
        fresh = np.concatenate([[True], words[order[1:]] != words[order[:-1]]])
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        h = 8  # the last suffixes are padded by zeros and may tie with bytes that are zero: the shorter comes first
        while True:
            single = fresh & np.concatenate([fresh[1:], [True]])
            tied = ~single
            if not tied.any() or h >= 2 * n:
                return order
            at = np.flatnonzero(tied)
            suffix = order[at]
            after = np.where(suffix + h < n, rank[np.minimum(suffix + h, n - 1)], suffix - 2 * n)
            again = np.lexsort((after, rank[suffix]))
            suffix, after, old = suffix[again], after[again], rank[suffix[again]]
            order[at] = suffix
            new = np.concatenate([[True], (old[1:] != old[:-1]) | (after[1:] != after[:-1])])
            fresh[at] = new
            rank[suffix] = at[new][np.cumsum(new) - 1]
            h *= 2

    def _common(self, words: np.ndarray, suffixes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Common bytes of the suffixes at two places of the suffix array (none beyond its ends)."""
        out = np.zeros(len(left), np.int64)
        live = np.flatnonzero((left >= 0) & (right < self.n))
        a, b = suffixes[left[live]], suffixes[right[live]]
        at = 0
        while len(live):
            inside = np.maximum(a, b) + at < self.n
            live, a, b = live[inside], a[inside], b[inside]
            x = words[a + at] ^ words[b + at]
            same = sum((x < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8)) + (x == 0)
            out[live] = np.minimum(at + same, self.n - np.maximum(a, b))
            go = x == 0
            live, a, b = live[go], a[go], b[go]
            at += 8
        return out

    def _stream(self, at: np.ndarray, match: np.ndarray) -> np.ndarray:
        sample = np.zeros(self.n, np.int64)
        here = np.zeros(self.n, np.int64)
        here[at] = at
        last = np.maximum.accumulate(here)
        sample[at] = match
        return sample[last] - (np.arange(self.n) - last)

    def matches(self) -> np.ndarray:
        """For each position, the longest string that starts there and also somewhere else."""
        return np.maximum(self._stream(self.head_at, self.head_match), self._stream(self.tail_at, self.tail_match))


def block_spans(rows: list[tuple[int, int, bytes]], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(row, start, stop) of repeated strings in the contexts of single occurrence; rows: (copies, windows, bytes), distinct."""
    index = RunLengthIndex(bytes([SEPARATOR]).join(r[2] for r in rows))
    long = index.matches() >= length
    out, at = [], 0
    for k, (copies, windows, data) in enumerate(rows):
        if copies == 1:
            edge = np.flatnonzero(np.diff(np.concatenate([[0], long[at : at + windows].astype(np.int8), [0]])))
            out += [(k, int(a), int(b) + length - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        at += len(data) + 1
    return out


def _cut(length: int, gram: int):
    names = ["anchor", "ctx", "doc_id", "th", "spot"]
    kinds = [pa.int64()] * 5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(length, gram)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                ids, ths, texts = (batch.column(i).slice(lo, 500).to_pylist() for i in range(3))
                rows = [(anchor, xxhash.xxh3_64_intdigest(data) - (1 << 63), ids[k], ths[k], first << 12 | windows) for k, first, windows, anchor, data in cutter.contexts([t or b"" for t in texts])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names=names)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, th, start, stop of strings to remove (they may overlap). ``docs``: doc_id, th (hash of the text), body (binary)."""
    spark = docs.sparkSession
    found = docs.mapInArrow(_cut(length, gram), "anchor long, ctx long, doc_id long, th long, spot long")
    found = stored(found, "contexts")
    first, windows = F.shiftright("spot", 12).alias("first"), F.col("spot").bitwiseAND(F.lit(4095)).alias("windows")
    by_ctx = stored(found.groupBy("anchor", "ctx").agg(F.count("*").alias("copies"), F.first("spot").alias("spot"), F.first("doc_id").alias("doc_id"), F.first("th").alias("th")), "by-context")
    place = ["doc_id", "th", first.alias("start"), (first + windows + (length - 1)).alias("stop")]
    whole = join_to_key(found, by_ctx.filter("copies > 1").select("anchor", "ctx", "copies"), ["anchor", "ctx"], "copies", found.count()).select(*place)
    by_ctx = by_ctx.select("anchor", "copies", "doc_id", "th", first, windows)

    anchors = by_ctx.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"), F.sum(F.col("windows") + (length - 1)).alias("bytes"))
    anchors = stored(anchors.filter("kinds > 1 and least = 1"), "anchors")
    total = anchors.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    if not total[0]:
        return whole
    open_ctx = join_to_key(by_ctx, anchors.select("anchor", "kinds", "bytes"), "anchor", "kinds", by_ctx.count())
    wanted = open_ctx.groupBy("doc_id", "th").agg(F.collect_list(F.struct("anchor", "copies", "first", "windows", "bytes")).alias("wanted"))
    bodies = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]) & docs["th"].eqNullSafe(wanted["th"])).select(docs["doc_id"], docs["th"], "body", "wanted")
    each = bodies.select("doc_id", "th", "body", F.explode("wanted").alias("w")).select(
        "doc_id", "th", "w.*", F.expr(f"substring(body, int(w.first) + 1, int(w.windows) + {length - 1})").alias("data")
    )

    blocks = max(1, -(-int(total[0]) // BLOCK))

    def index(batch: pa.Table) -> pa.Table:
        once: dict[bytes, tuple] = {}
        for r in zip(*(batch.column(c).to_pylist() for c in ("data", "copies", "windows", "doc_id", "th", "first")), strict=True):
            once[r[0]] = (r[1], r[2], r[0], r[3], r[4], r[5]) if r[0] not in once else (2, *once[r[0]][1:])
        rows = list(once.values())
        spans = [(rows[k][3], rows[k][4], rows[k][5] + a, rows[k][5] + b) for k, a, b in block_spans([r[:3] for r in rows], length)]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*spans, strict=True) if spans else [[]] * 4)], names=["doc_id", "th", "start", "stop"])

    small = each.filter(F.col("bytes") <= most_bytes).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)))
    parts = whole.unionByName(small.groupBy("block").applyInArrow(index, "doc_id long, th long, start long, stop long"))
    if total[1] > most_bytes:
        large = each.filter(F.col("bytes") > most_bytes)

        def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for doc_id, th, copies, first, windows, data in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "copies", "first", "windows", "data")), strict=True):
                    hashes = [xxhash.xxh3_128_digest(data[i : i + length]) for i in range(windows)]
                    columns = [hashes, [copies] * windows, [doc_id] * windows, [th] * windows, range(first, first + windows)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), *[pa.int64()] * 4], strict=True)], names=["w", "copies", "doc_id", "th", "start"])

        every = stored(large.mapInArrow(windows_of, "w binary, copies long, doc_id long, th long, start long"), "windows")
        twice = every.groupBy("w").agg(F.sum("copies").alias("all_copies"), F.count("*").alias("n")).filter("all_copies > 1").select("w", "n")
        hit = join_to_key(every.filter("copies = 1"), twice, "w", "n", every.count())
        parts = parts.unionByName(hit.select("doc_id", "th", "start", (F.col("start") + length).alias("stop")))
    return parts


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, n_bytes, spans (array of maximal removed (start, stop), bytes) and kept: the remaining bytes."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("body")).select("doc_id", F.xxhash64("body").alias("th"), "body")
    spans = repeated_spans(named, length, gram, most_bytes).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    joined = named.join(spans.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                ids, bodies, found = (b.column(i).slice(lo, 500).to_pylist() for i in range(3))
                merged, kept = [], []
                for data, spots in zip(bodies, found, strict=True):
                    runs: list[list[int]] = []
                    for s in spots or ():
                        if runs and s["start"] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], s["stop"])
                        else:
                            runs.append([s["start"], s["stop"]])
                    edges = [0, *(x for r in runs for x in r), len(data)]
                    kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)))
                    merged.append([{"start": a, "stop": z} for a, z in runs])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(d) for d in bodies], pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    return joined.select("doc_id", "body", "spans").mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
