"""Toxicity by gradient-boosted trees over dense features of whole texts, with isotonic calibration.

1. Labelled rows (``most_labelled`` at most, those with the smallest hash of their id, none of the held-out part) give a lexicon:
   words and beginnings of words (BEGIN characters) that documents with label 1 have far more often, each with its log ratio.
   Labels are counted on Spark; the lexicon has ``most_terms`` entries at most.
2. One pass over all texts turns each into the FEATURES: densities of lexicon words and beginnings, lexicon words near a second
   person, disguised lexicon words (digits and signs for letters, letters apart), capitals, punctuation, signs, repetition.
   Distinct words of an Arrow slice are looked at once. The features are stored (a row of numbers for each document).
3. Trees are fitted to three parts of the labelled rows (crc32 of the id mod 5 is 2, 3 or 4), and an isotonic curve from the trees'
   margin to the label to the fourth (1). All documents are scored by both; a thousandth of the score is the margin's logistic
   value, so that documents on one step of the curve keep the trees' order.

A document without words has features of 0 and the score of such documents. Nulls: a null text is empty; a row without id is scored
and isn't held out; null labels and ids of ``labels`` are left out, and of repeated ones the highest label counts. Repeated rows
are scored each; an empty table gives no rows; other columns are ignored. Without labelled rows of both kinds in both fits, every
score is the share of label 1 (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.llm.common import stored, table
from muster.llm.op5_language_model import text_slices

#: Lengths of beginnings of words.
BEGIN = range(4, 9)
#: Words this far from a second person are near it.
NEAR = 5
#: A term is in at least so many toxic documents, so many times as often as in others, and its G^2 (1 degree of freedom) is over this.
LEAST_DOCS, LEAST_RATIO, LEAST_G2 = 3, 4.0, 15.0
#: Characters that stand for letters, and words for the person spoken to. (Fixed values.)
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
SECOND = (
    "you your yours yourself yourselves u ur ya du dich dir dein deine deinen deinem deiner ihr euch euer eure tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tuya usted ustedes vosotros vosotras os vuestro vuestra"
).split()
EDGE = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»“”„’‘…–—¿¡"
FEATURES = (
    "log_words hits log_hits hit_weight top_weight begins log_begins begin_weight disguised_hits disguised_words second near_hits near_share capitals capital_words exclamations questions "
    "signs digits word_length distinct apart"
).split()
COUNTED = "term string, toxic long, clean long"


def held_out(doc_id: str = "doc_id", modulus: int = 5):
    """crc32 of the id as text, by ``modulus``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, place of each word of all texts among them, the text of each word)."""
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten().dictionary_encode()
    index, empty = words.indices.to_numpy().astype(np.int64), pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    real = ~empty[index] if len(index) else np.zeros(0, bool)
    return words.dictionary, index[real], doc[real]


def core(words: pa.Array) -> pa.Array:
    """Small letters without signs at the ends."""
    return pc.utf8_trim(pc.utf8_lower(words), EDGE)


def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, toxic): in how many toxic and other documents of the slice each word ('w' before it) and beginning ('b') is."""
    for batch in batches:
        for part in text_slices(batch, 0):
            raw, index, doc = cut(part.column(0))
            words, toxic = core(raw), part.column(1).to_numpy().astype(bool)
            for mark, terms in (("w", words), *(("b", pc.utf8_slice_codeunits(words, 0, k)) for k in BEGIN)):
                coded = terms.dictionary_encode()
                if not len(coded.dictionary):
                    continue
                size = len(coded.dictionary)
                once = np.unique(doc * size + coded.indices.to_numpy().astype(np.int64)[index])
                of, which = once // size, once % size
                counts = [pa.array(np.bincount(which[toxic[of] == side], minlength=size).astype(np.int64)) for side in (True, False)]
                marked = pc.binary_join_element_wise(pa.scalar(mark), coded.dictionary, pa.scalar(""))
                yield pa.RecordBatch.from_arrays([marked, *counts], names=["term", "toxic", "clean"]).filter(pc.greater(pc.utf8_length(marked), 2 if mark == "w" else 4))


def lexicon(labelled: DataFrame, most_terms: int) -> list[tuple[str, float]]:
    """(term, log ratio) of what toxic documents (text, toxic) have far more often; ``most_terms`` at most, the surest first."""
    toxic, clean = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    if not toxic or not clean:
        return []
    counts = labelled.mapInArrow(term_counts, COUNTED).groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).filter(F.col("a") >= LEAST_DOCS)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b, n = F.col("a"), F.col("b"), float(toxic + clean)
    g2 = 2 * (part(a, (a + b) * toxic / n) + part(b, (a + b) * clean / n) + part(toxic - a, (n - a - b) * toxic / n) + part(clean - b, (n - a - b) * clean / n))
    ratio = ((a + 0.5) / (toxic + 1.0)) / ((b + 0.5) / (clean + 1.0))
    sure = counts.withColumn("ratio", ratio).withColumn("g2", g2).filter((F.col("ratio") >= LEAST_RATIO) & (F.col("g2") >= LEAST_G2))
    return [(r["term"], float(np.log(r["ratio"]))) for r in sure.orderBy(F.desc("g2"), "term").limit(most_terms).collect()]


class Reader:
    """Features of texts by a lexicon."""

    def __init__(self, terms: list[tuple[str, float]]):
        self.words = pa.array([t[1:] for t, _ in terms if t[0] == "w"], pa.string())
        self.word_weights = np.array([0.0, *(w for t, w in terms if t[0] == "w")])
        begins = {k: [(t[1:], w) for t, w in terms if t[0] == "b" and len(t) - 1 == k] for k in BEGIN}
        self.begins = {k: (pa.array([t for t, _ in v], pa.string()), np.array([0.0, *(w for _, w in v)])) for k, v in begins.items() if v}

    @staticmethod
    def found(words: pa.Array, among: pa.Array) -> np.ndarray:
        """1 + place of each word in a list, 0 where it isn't there."""
        return pc.fill_null(pc.add(pc.index_in(words, value_set=among), 1), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def disguised(self, raw: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether distinct words hold signs for letters, and whether they are lexicon words once these are read as letters."""
        like = pc.match_substring_regex(words, r"\p{L}[0-9@$!*._-]+\p{L}").to_numpy(zero_copy_only=False)
        hit, at = np.zeros(len(words), bool), np.flatnonzero(pc.match_substring_regex(raw, r"[0-9@$!*._-]").to_numpy(zero_copy_only=False))
        if len(at):
            read = pc.utf8_trim(pc.utf8_lower(raw.take(pa.array(at))), ".,;:?!\"'()")
            for sign, letter in DISGUISE.items():
                read = pc.replace_substring(read, sign, letter)
            hit[at] = self.found(pc.replace_substring_regex(read, r"[^\p{L}]+", ""), self.words) > 0
        return like, hit & (self.found(words, self.words) == 0)

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row of FEATURES for each text (texts without nulls)."""
        n = len(texts)
        raw, index, doc = cut(texts)
        words = core(raw)

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(doc, weights=values, minlength=n).astype(float)

        count = total(np.ones(len(doc)))
        per, least = 100.0 / np.maximum(count, 1), np.maximum(count, 1)
        place = self.found(words, self.words)
        hit, weight = (place > 0)[index], self.word_weights[place][index]
        begin = np.zeros(len(words))
        for k, (among, weights) in self.begins.items():
            begin = np.maximum(begin, weights[self.found(pc.utf8_slice_codeunits(words, 0, k), among)])
        like, hidden = self.disguised(raw, words)
        second = (self.found(words, pa.array(SECOND)) > 0)[index]
        bad = hit | hidden[index]
        near = self.near(np.flatnonzero(bad), np.flatnonzero(second), doc)
        lower, upper = pc.utf8_lower(raw), pc.utf8_upper(raw)
        shout = (pc.equal(raw, upper).to_numpy(zero_copy_only=False) & pc.not_equal(raw, lower).to_numpy(zero_copy_only=False) & (pc.utf8_length(raw).to_numpy() > 1))[index]
        length = pc.utf8_length(words).to_numpy().astype(float)[index]
        size = max(1, len(words))
        distinct = np.bincount(np.unique(doc * size + index) // size, minlength=n)
        top = np.zeros(n)
        np.maximum.at(top, doc[hit], weight[hit])
        hits, begins = total(hit), total((begin > 0)[index])
        letters, capitals, calls, asks, signs, digits = self.characters(texts)
        return np.column_stack([
            np.log1p(count), hits * per, np.log1p(hits), total(weight) * per, top, begins * per, np.log1p(begins), total(begin[index]) * per, total(hidden[index]) * per, total(like[index]) * per,
            total(second) * per, near_sum(near, doc, n) * per, near_sum(near, doc, n) / np.maximum(total(bad), 1), capitals / np.maximum(letters, 1), total(shout) / least, calls * per, asks * per,
            signs * per, digits / np.maximum(letters + digits, 1), total(length) / least, distinct / least, self.apart(length == 1, doc, n) * per,
        ])

    @staticmethod
    def near(bad: np.ndarray, second: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Of the places of lexicon words, those with a second person NEAR words away at most, in the same text."""
        close = np.zeros(len(bad), bool)
        if len(second):
            at = np.searchsorted(second, bad)
            for other in (second[np.minimum(at, len(second) - 1)], second[np.maximum(at - 1, 0)]):
                close |= (np.abs(other - bad) <= NEAR) & (doc[other] == doc[bad])
        return bad[close]

    @staticmethod
    def apart(single: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Words of one letter in runs of four or more, by text."""
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(single.astype(np.int8)) != 0) | (np.diff(doc) != 0)])) if len(doc) else np.zeros(0, np.int64)
        long = np.diff(np.append(edges, len(doc)))
        kept = single[edges] & (long >= 4)
        return np.bincount(doc[edges[kept]], weights=long[kept], minlength=n)

    @staticmethod
    def characters(texts: pa.Array) -> list[np.ndarray]:
        """Letters, capitals (A-Z), exclamation and question marks, signs and digits of each text, by bytes."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if texts.buffers()[2] is not None and len(offsets) else np.zeros(0, np.uint8)
        kinds = np.zeros(256, np.uint8)
        for bit, chars in enumerate((bytes([*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)]), bytes(range(65, 91)), b"!", b"?", b"#*$%&|<>@~^_", bytes(range(48, 58)))):
            kinds[np.frombuffer(chars, np.uint8)] |= 1 << bit
        kind = kinds[data]
        return [np.diff(np.concatenate([[0], np.cumsum((kind >> bit) & 1, dtype=np.int64)])[offsets - offsets[0]]).astype(float) for bit in range(6)]


def near_sum(places: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc[places], minlength=n).astype(float)


def with_features(docs: DataFrame, terms: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the FEATURES of every row."""
    names = ["doc_id", *FEATURES]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(terms)
        for batch in batches:
            for part in text_slices(batch, 1):
                found = reader.features(part.column(1)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(found[:, i]) for i in range(len(FEATURES)))], names=names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(read, "doc_id long, " + ", ".join(f"{f} float" for f in FEATURES))


def score_toxicity(docs: DataFrame, labels: DataFrame, most_labelled: int = 40_000, most_terms: int = 4_000, trees: int = 30, depth: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``; ``labels`` has doc_id and toxic (0 or 1)."""
    part = held_out()
    known = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = stored(known.filter(part != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled), "labelled")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    terms = lexicon(texts.join(F.broadcast(sample), "doc_id").filter(part != 1).select("text", "toxic"), most_terms)
    features = stored(with_features(docs, terms, id_col, text_col), "features")
    as_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    rows = stored(features.join(F.broadcast(sample), "doc_id").withColumn("_fit", part != 1), "labelled-features")
    kinds = {(r["_fit"], r["toxic"]): r["count"] for r in rows.groupBy("_fit", "toxic").count().collect()}
    names = features.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), *FEATURES)
    if len(kinds) < 4:
        toxic, every = sum(n for (_, t), n in kinds.items() if t), sum(kinds.values())
        scored = names.select("doc_id", "held_out", F.lit(toxic / every if every else 0.0).alias("score"))
    else:
        labelled = as_vector.transform(rows.withColumn("label", F.col("toxic").cast("double"))).select("label", "_features", "_fit").repartition(8)
        boosted = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=5, seed=11).fit(labelled.filter("_fit"))
        with_margin = lambda df: boosted.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
        curve = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_iso").fit(with_margin(labelled.filter("not _fit")).select("_margin", "label"))
        scored = curve.transform(with_margin(as_vector.transform(names)))
        steady = 1 / (1 + F.exp(-2 * F.col("_margin")))
        scored = scored.select("doc_id", "held_out", (0.999 * F.least(F.greatest("_iso", F.lit(0.0)), F.lit(1.0)) + 0.001 * steady).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
