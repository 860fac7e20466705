"""Language-model scoring with a gated recurrent network.

Training documents are those whose crc32(doc_id as text) mod 5 is not 1; every one of their tokens is counted, and every
one is trained on once. Tokens are lower-cased words and one end (the empty word).

* Counts: a shuffle by word, all words. The base score is exact: the HEAD most frequent words (a fixed bound) are known to
  every task, the other words of a document go through a join with the stored counts.
* Ids: a second pass over the texts stores every document as ids of the network's vocabulary, with the sums over its head
  words and its other words. Training and scoring read these; texts are cut twice in all, by Arrow's functions on columns.
* Model: a GRU in numpy whose output is factored into classes of words (class, then word in class). Its vocabulary is the
  VOCABULARY most frequent words and *rare*; a rare word's probability is that of *rare* times its smoothed share among
  rare training words, where one more share is that of all unseen words. So the score is a probability of the text.
* Training: truncated backpropagation through windows of STEPS tokens over parallel streams of documents; the state is
  carried across windows and cleared where a document starts. Each partition trains a copy; copies are averaged (weighted
  by tokens, in a shuffle by parameter) after each round. Round one covers one in ROUND_ONE documents, round two the rest.
  Which documents share a copy follows from how the stored ids are split, so ``score`` (not the other columns) differs in
  its last digits, by about a thousandth, between tables that are split otherwise.
* Scoring: one pass; the state is carried over the whole document.

Nulls: a null text is empty: its only token is the end. A null doc_id counts as the empty text for crc32. Repeated rows
are scored each. Without training tokens the base score of a token is log10(0.5 / 0.5) = 0 and the model is uniform.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import stored, table

HEAD = 250_000
VOCABULARY = 1024
HIDDEN = 8
CLASSES = 24
STREAMS = 256
STEPS = 12
ROUND_ONE = 8
RATE = 0.1
END = ""
FLUSH = 400_000
#: Characters of text that one step cuts.
SLICE_CHARS = 4_000_000


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words in lower case, place of each word of all texts among them, where each text begins and the last one ends)."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = parts.flatten().dictionary_encode()
    index, empty = words.indices.to_numpy(), pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
    real = ~empty[index] if len(index) else np.zeros(0, bool)
    return words.dictionary, index[real], np.concatenate([[0], np.cumsum(real)])[parts.offsets.to_numpy()]


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with SLICE_CHARS of text, or one longer text, each."""
    ends, at = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy()), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_CHARS, side="right")))
        part = batch.slice(at, to - at)
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], names=part.schema.names)
        at = to


class Gru:
    """GRU over word ids 0..v-1 in order of class; input id v starts a document."""

    NAMES = ("inputs", "recur", "class_w", "class_b", "word_w", "word_b")

    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 7):
        self.v, self.h, rng = len(counts), hidden, np.random.default_rng(seed)
        share = (counts + 0.5) / (counts + 0.5).sum()
        mass = np.cumsum(np.sqrt(share)) / np.sqrt(share).sum()
        label = np.minimum((mass * classes - 1e-9).astype(np.int64), classes - 1)
        self.of_class = np.unique(label, return_inverse=True)[1]
        self.starts = np.concatenate([[0], np.flatnonzero(np.diff(self.of_class)) + 1, [self.v]])
        by_class = np.bincount(self.of_class, weights=share)
        f = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.inputs, self.recur = f(self.v + 1, 3 * hidden), f(hidden, 3 * hidden)
        self.inputs[:, :hidden] += 1.0  # a state that lasts
        self.class_w, self.class_b = np.zeros((hidden, len(by_class)), np.float32), np.log(by_class).astype(np.float32)
        self.word_w, self.word_b = np.zeros((hidden, self.v), np.float32), np.log(share / by_class[self.of_class]).astype(np.float32)
        self.speed = {n: np.full_like(getattr(self, n), 1e-2) for n in self.NAMES}

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> Gru:
        at = 0
        for n in self.NAMES:
            a = getattr(self, n)
            setattr(self, n, flat[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return self

    def forward(self, ids: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, list]:
        """States after each step for input ids (steps, streams), and what the backward pass needs."""
        k, x, fresh = 2 * self.h, self.inputs[ids], ids == self.v
        out, kept = np.empty((*ids.shape, self.h), np.float32), []
        for t in range(len(ids)):
            if fresh[t].any():
                h = np.where(fresh[t][:, None], np.float32(0), h)
            a = h @ self.recur
            zr = 1 / (1 + np.exp(-x[t, :, :k] - a[:, :k]))
            r = zr[:, self.h :]
            c = np.tanh(x[t, :, k:] + r * a[:, k:])
            kept.append((h, a[:, k:], zr, c))
            h = c + zr[:, : self.h] * (h - c)
            out[t] = h
        return out, kept

    def output(self, states: np.ndarray, targets: np.ndarray, learn: bool) -> tuple[np.ndarray, dict]:
        """Natural log probabilities of targets given states (n, h); with learn, gradients of their negative sum."""
        logits = states @ self.class_w + self.class_b
        logits -= logits.max(1, keepdims=True)
        e = np.exp(logits)
        total = e.sum(1)
        label, rows = self.of_class[targets], np.arange(len(targets))
        logp = logits[rows, label] - np.log(total)
        g: dict = {}
        if learn:
            e /= total[:, None]
            e[rows, label] -= 1
            g = {"class_w": states.T @ e, "class_b": e.sum(0), "states": e @ self.class_w.T, "word_w": np.zeros_like(self.word_w), "word_b": np.zeros_like(self.word_b)}
        order = np.argsort(label, kind="stable")
        edges = np.searchsorted(label[order], np.arange(len(self.starts)))
        for c in range(len(self.starts) - 1):
            mine, lo, hi = order[edges[c] : edges[c + 1]], self.starts[c], self.starts[c + 1]
            if not len(mine) or hi - lo == 1:
                continue
            s = states[mine]
            word = s @ self.word_w[:, lo:hi] + self.word_b[lo:hi]
            word -= word.max(1, keepdims=True)
            e = np.exp(word)
            total, at, n = e.sum(1), targets[mine] - lo, np.arange(len(mine))
            logp[mine] += word[n, at] - np.log(total)
            if learn:
                e /= total[:, None]
                e[n, at] -= 1
                g["word_w"][:, lo:hi], g["word_b"][lo:hi] = s.T @ e, e.sum(0)
                g["states"][mine] += e @ self.word_w[:, lo:hi].T
        return logp, g

    def learn(self, ids: np.ndarray, targets: np.ndarray, real: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One step of truncated backpropagation over a window; the state at its end."""
        k, out_kept = 2 * self.h, self.forward(ids, h)
        out, kept = out_kept
        _, g = self.output(out[real], targets[real], True)
        d_out = np.zeros_like(out)
        d_out[real] = g.pop("states")
        dx, du, dh = np.empty((*ids.shape, 3 * self.h), np.float32), np.zeros_like(self.recur), np.zeros_like(h)
        for t in range(len(ids) - 1, -1, -1):
            before, a, zr, c = kept[t]
            z, r = zr[:, : self.h], zr[:, self.h :]
            dh = dh + d_out[t]
            dc = dh * (1 - z) * (1 - c * c)
            gates = np.concatenate([dh * (before - c), dc * a], 1) * zr * (1 - zr)
            da = np.concatenate([gates, dc * r], 1)
            dx[t, :, :k], dx[t, :, k:] = gates, dc
            du += before.T @ da
            dh = (dh * z + da @ self.recur.T) * (ids[t] != self.v)[:, None]
        flat, order = dx.reshape(-1, 3 * self.h), np.argsort(ids, axis=None, kind="stable")
        used, first = np.unique(ids.ravel()[order], return_index=True)
        n = max(1, int(real.sum()))
        for name, d in (*g.items(), ("recur", du)):
            self._step(name, slice(None), d / n)
        self._step("inputs", used, np.add.reduceat(flat[order], first, axis=0) / n)
        return out[-1]

    def _step(self, name: str, at, d: np.ndarray) -> None:
        """Adagrad."""
        p, s = getattr(self, name), self.speed[name]
        s[at] += (d * 100) ** 2
        p[at] -= RATE * d * 100 / np.sqrt(s[at])


class Streams:
    """Documents (arrays of ids) laid out in parallel streams of about equal length, the longest stream first."""

    def __init__(self, docs: list[np.ndarray], start: int, streams: int = STREAMS):
        lanes: list[list[int]] = [[] for _ in range(min(streams, len(docs)))]
        heap = [(0, i) for i in range(len(lanes))]
        for k in sorted(range(len(docs)), key=lambda k: -len(docs[k])):
            size, i = heapq.heappop(heap)
            lanes[i].append(k)
            heapq.heappush(heap, (size + len(docs[k]), i))
        sizes = {i: s for s, i in heap}
        order = sorted(sizes, key=lambda i: -sizes[i])
        self.docs = [k for i in order for k in lanes[i]]
        self.size = np.array([sizes[i] for i in order], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([docs[k] for k in self.docs])
        lengths = np.array([len(docs[k]) for k in self.docs], np.int64)
        self.first = np.cumsum(lengths) - lengths
        self.before = np.concatenate([[start], self.flat[:-1]])
        self.before[self.first] = start

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(places (steps, live streams), which are real, live streams)."""
        for t in range(0, int(self.size[0]), steps):
            live = int(np.searchsorted(-self.size, -t, side="left"))
            step = t + np.arange(steps)[:, None]
            real = step < self.size[:live]
            yield np.where(real, self.at[:live] + step, self.at[:live]), real, live


class Scorer:
    """What every task knows: the head words, the model, and the sizes of the training corpus."""

    def __init__(self, words: list[str], counts: np.ndarray, n: int, v: int, weights: np.ndarray | None = None):
        self.index = {w: i for i, w in enumerate(words)}
        self.logs = np.log10(np.append(counts, 0) + 0.5)
        m = min(VOCABULARY, len(words))
        self.ids = np.full(len(words) + 1, -1, np.int32)
        own = np.append(counts[:m], max(0, n - counts[:m].sum())).astype(np.float64)  # the last is rare
        order = np.argsort(-own, kind="stable")
        place = np.empty(m + 1, np.int32)
        place[order] = np.arange(m + 1, dtype=np.int32)
        self.ids[:m], self.ids[m:], self.rare = place[:m], place[m], place[m]
        self.model = Gru(own[order])
        if weights is not None:
            self.model.load(weights)

    def lookup(self, words: list[str]) -> np.ndarray:
        """Place among the head words; the last place for others."""
        return np.fromiter(map(self.index.get, words, repeat(len(self.index))), np.int32, len(words))

    def train(self, docs: list[np.ndarray]) -> int:
        streams, m = Streams(docs, self.model.v), self.model
        h = np.zeros((len(streams.size), m.h), np.float32)
        for at, real, live in streams.windows(STEPS):
            h = m.learn(streams.before[at], streams.flat[at], real, h[:live])
        return len(streams.flat)

    def log10(self, docs: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each document under the network."""
        streams, m = Streams(docs, self.model.v), self.model
        h, logp = np.zeros((len(streams.size), m.h), np.float32), np.zeros(len(streams.flat))
        for at, real, live in streams.windows(4 * STEPS):
            out, _ = m.forward(streams.before[at], h[:live])
            h = out[-1]
            logp[at[real]] = m.output(out[real], streams.flat[at][real], False)[0]
        result = np.empty(len(docs))
        result[streams.docs] = np.add.reduceat(logp, streams.first) / np.log(10)
        return result


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []

    def out() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("c", "sum")]).select(["word", "c_sum"]).rename_columns(["word", "c"])

    for batch in batches:
        for part in text_slices(batch, 0):
            words, index, _ = cut(part.column(0))
            counts = np.bincount(index, minlength=len(words))
            seen = pa.table({"word": words, "c": pa.array(counts, pa.int64())}).filter(pa.array(counts > 0))
            held += [seen, pa.table({"word": [END], "c": pa.array([part.num_rows], pa.int64())})]
            if sum(t.num_rows for t in held) > 2 * FLUSH:
                held[:] = [out()]
                if held[0].num_rows > FLUSH:
                    yield from held[0].combine_chunks().to_batches()
                    held.clear()
    if held:
        yield from out().combine_chunks().to_batches()


def _documents(batches: Iterator[pa.RecordBatch], column: int, rows: int = 6000) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of batches with the ids of each row."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            lists = part.column(column)
            edges = lists.offsets.to_numpy()
            yield part, np.split(lists.flatten().to_numpy().astype(np.int64), edges[1:-1] - edges[0])


def head_least(counts: DataFrame, most: int = HEAD) -> int:
    """The least count of a head word: as low as at most ``most`` words have it or more. Counts are told apart to 1/64 of a power of two."""
    level = F.floor(F.log2(F.col("c").cast("double")) * 64).cast("int")
    held, least = 0, 1 << 62
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), reverse=True):
        held += r["n"]
        if held > most:
            break
        least = r["c"]
    return least


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 5, held: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc % modulus == held).alias("held_out"), F.floor(crc / modulus).cast("long").alias("draw"), F.col(text_col).cast("string").alias("text"))
    counts = stored(named.filter(~F.col("held_out")).select("text").mapInArrow(_counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    least = head_least(counts)
    top = counts.filter(F.col("c") >= least).toPandas().sort_values(["c", "word"], ascending=[False, True])
    words, numbers = top["word"].tolist(), top["c"].to_numpy(np.int64)
    fixed = spark.sparkContext.broadcast((words, numbers, n, v))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, row = Scorer(*fixed.value), TaskContext.get().partitionId() << 40
        outside = len(scorer.index)
        (end,) = scorer.lookup([END])
        for batch in batches:
            for part in text_slices(batch, 3):
                distinct, index, edges = cut(part.column(3))
                at = scorer.lookup(distinct.to_pylist())[index] if len(index) else np.zeros(0, np.int32)
                beyond = np.flatnonzero(at == outside)
                tail = pa.ListArray.from_arrays(pa.array(np.searchsorted(beyond, edges).astype(np.int32)), distinct.take(pa.array(index[beyond])))
                at = np.insert(at, edges[1:], end)
                first = edges[:-1] + np.arange(part.num_rows)
                network, inside = scorer.ids[at], at < outside
                logs, rare = np.where(inside, scorer.logs[at], 0.0), network == scorer.rare
                sums = [np.add.reduceat(x, first) for x in (inside.astype(np.int64), logs, np.where(rare, logs, 0.0), rare.astype(np.int64))]
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int64())
                ids = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(network.astype(np.int16)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(part.num_rows)), *part.columns[:3], pa.array(np.diff(np.append(first, len(at)))), *(pa.array(x, t) for x, t in zip(sums, kinds, strict=True)), ids, tail],
                    names=["rid", "doc_id", "held_out", "draw", "n_tokens", "n_head", "head_logs", "rare_logs", "n_rare", "ids", "tail"],
                )
                row += part.num_rows

    kept = "rid long, doc_id long, held_out boolean, draw long, n_tokens long, n_head long, head_logs double, rare_logs double, n_rare long"
    coded = stored(named.select("doc_id", "held_out", "draw", "text").mapInArrow(encode, f"{kept}, ids array<short>, tail array<string>"), "ids")

    weights = None
    for chosen in (F.col("draw") % ROUND_ONE == 0, F.col("draw") % ROUND_ONE != 0):
        start = spark.sparkContext.broadcast(weights)

        def train(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            scorer, seen = Scorer(*fixed.value, start.value), 0
            for ids in _documents(batches, 0):
                seen += scorer.train(ids[1])
            if seen:
                flat = scorer.model.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([float(seen)]), pa.array([flat], pa.list_(pa.float64()))], names=["seen", "flat"])

        each = coded.filter(~F.col("held_out") & chosen).select("ids").mapInArrow(train, "seen double, flat array<double>").select("seen", F.posexplode("flat").alias("pos", "x"))
        mean = each.groupBy("pos").agg((F.sum(F.col("x") * F.col("seen")) / F.sum("seen")).alias("x")).toPandas()
        if len(mean):
            weights = mean.sort_values("pos")["x"].to_numpy(np.float64)
    final = spark.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*fixed.value, final.value)
        for part, ids in _documents(batches, 8):
            yield pa.RecordBatch.from_arrays([*part.columns[:8], pa.array(scorer.log10(ids))], names=[*part.schema.names[:8], "net"])

    names = ["rid", "doc_id", "held_out", "n_tokens", "n_head", "head_logs", "rare_logs", "n_rare"]
    rows = coded.select(*names, "ids").mapInArrow(score, kept.replace("draw long, ", "") + ", net double")
    beyond = counts.filter(F.col("c") < least)
    found = coded.select("rid", F.explode("tail").alias("word")).join(beyond, "word")
    tails = found.groupBy("rid").agg(F.sum(F.log10(F.col("c") + 0.5)).alias("tail_logs"), F.count("*").alias("n_tail"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = rows.join(tails, "rid", "left").withColumn("n_known", F.col("n_head") + zero("n_tail"))
    logs = zero("tail_logs") + (F.col("n_tokens") - F.col("n_known")) * F.log10(F.lit(0.5))
    log_all = float(np.log10(n + 0.5 * (v + 1)))
    m = min(VOCABULARY, len(words))
    log_rare = float(np.log10(max(0, n - int(numbers[:m].sum())) + 0.5 * (v - m + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_logs") + logs - F.col("n_tokens") * log_all).alias("base_score"),
        (F.col("net") + F.col("rare_logs") + logs - F.col("n_rare") * log_rare).alias("score"),
    )


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
