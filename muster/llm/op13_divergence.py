"""How the sources of a language differ in the terms they use, by sorted runs.

Texts are cut into terms, and each Arrow slice of SLICE_CHARS of text (or one longer text) is summed before anything is shuffled:
one record (lang, term, source, slice, documents, occurrences) for all documents of a slice. Records are dealt by (lang, term),
sorted by (lang, term, source, slice), and read in one pass: a run of equal (lang, term) gives the document frequency and the
occurrences by source, and a term in too few documents is forgotten at the end of its run. A hot term has at most one record a
slice and source, and no run is held whole: what is carried from batch to batch is one sum for each source.

The kept terms (a row each, with its sources and counts) meet their language's groups, and a second pass over the rows emits
partial pairs (sums over blocks of terms) and a row for each term that a source has more often than its language. All shares are
integers: 1 + floor(scale * (count + smooth) / (total + smooth * terms)), by long division in 64 bits.

A document is a row; repeated rows count each. Nulls: a null text, lang or source is ''. Texts without terms still name their
(lang, source). Languages without kept terms have pairs of value 0. An empty table gives no rows; other columns are ignored.
Ties of value are ordered by item (UTF-8 bytes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from muster.llm.common import stored, table
from muster.llm.op5_language_model import text_slices

SCALE = 1_000_000_000
#: Cells (terms x sources) of a block whose pairs are summed at once.
BLOCK = 2_000_000
#: Groups (lang, source) up to which they are broadcast by language; beyond, the join is Spark's own, which can split a hot language.
MOST_BROADCAST = 200_000
#: Bytes that end a term, and capitals: 0x00-0x40, 0x5B-0x60 and 0x7B-0x7F become spaces, A-Z small letters. (The contract's terms.)
BYTES = bytes(32 if b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if b <= 0x5A else b for b in range(128)) + bytes(range(128, 256))
RECORD = "lang string, term string, source string, slice long, docs long, n long"
KEPT = "lang string, term string, docs long, sources array<string>, counts array<long>"


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms, place of each term of all texts among them, how many each text has); texts without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    spaced = bytes(memoryview(texts.buffers()[2])[offsets[0] : offsets[-1]]).translate(BYTES) if texts.buffers()[2] is not None else b""
    parts = pc.ascii_split_whitespace(pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(spaced)))
    words = parts.flatten().dictionary_encode()
    index, empty = words.indices.to_numpy().astype(np.int64), pc.equal(words.dictionary, "").to_numpy(zero_copy_only=False)
    real = ~empty[index] if len(index) else np.zeros(0, bool)
    return words.dictionary, index[real], np.diff(np.concatenate([[0], np.cumsum(real)])[parts.offsets.to_numpy()])


def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, lang, source) summed by slice: RECORD."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in text_slices(batch, 0):
            terms, index, each = terms_of(pa.concat_arrays([part.column(0)]))
            groups = pa.StructArray.from_arrays([part.column(1), part.column(2)], ["lang", "source"])
            pairs = pc.binary_join_element_wise(pc.cast(pc.binary_length(part.column(1)), pa.string()), part.column(1), part.column(2), " ").dictionary_encode()
            group, shown = pairs.indices.to_numpy().astype(np.int64), np.unique(pairs.indices.to_numpy(), return_index=True)[1]
            doc = np.repeat(np.arange(part.num_rows), each)
            if len(index):
                k = len(terms)
                of_doc = np.sort(doc * k + index)
                first = np.flatnonzero(np.diff(of_doc, prepend=-1))
                times, own = np.diff(np.append(first, len(of_doc))), of_doc[first]
                key = group[own // k] * k + own % k
                order = np.argsort(key, kind="stable")
                key, times = key[order], times[order]
                at = np.flatnonzero(np.diff(key, prepend=-1))
                docs, n = np.diff(np.append(at, len(key))), np.add.reduceat(times, at)
                named = groups.take(pa.array(shown[key[at] // k]))
                columns = [named.field("lang"), terms.take(pa.array(key[at] % k)), named.field("source"), pa.array(np.full(len(at), number)), pa.array(docs, pa.int64()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "source", "slice", "docs", "n"])
            number += 1


def borders(*columns: pa.Array) -> np.ndarray:
    """Whether each row but the first differs from the one before in any column."""
    out = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        out |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
    return out


def summed(rows: pa.Table) -> pa.Table:
    """Sorted records with one row for each (lang, term, source)."""
    at = np.flatnonzero(np.concatenate([[True], borders(*(rows[c].combine_chunks() for c in ("lang", "term", "source")))]))
    sums = [pa.array(np.add.reduceat(rows[c].to_numpy(), at), pa.int64()) for c in ("docs", "n")]
    return pa.table([*(rows[c].take(pa.array(at)) for c in ("lang", "term", "source")), *sums], names=["lang", "term", "source", "docs", "n"])


def runs(batches: Iterator[pa.RecordBatch], least_docs: int) -> Iterator[pa.RecordBatch]:
    """KEPT of records that are sorted by (lang, term, source)."""

    def ended(rows: pa.Table, at: np.ndarray) -> pa.RecordBatch:
        """The runs of ``rows`` that begin at ``at``."""
        docs, edges = np.add.reduceat(rows["docs"].to_numpy(), at), np.append(at, rows.num_rows).astype(np.int32)
        listed = [pa.ListArray.from_arrays(pa.array(edges), rows[c].combine_chunks()) for c in ("source", "n")]
        found = pa.RecordBatch.from_arrays([*(rows[c].combine_chunks().take(pa.array(at)) for c in ("lang", "term")), pa.array(docs, pa.int64()), *listed], names=["lang", "term", "docs", "sources", "counts"])
        return found.filter(pa.array(docs >= least_docs))

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]).drop_columns(["slice"])
        rows = summed(pa.concat_tables([held, rows]) if held is not None else rows)
        at = np.flatnonzero(np.concatenate([[True], borders(rows["lang"].combine_chunks(), rows["term"].combine_chunks())]))
        last = int(at[-1])
        held = rows.slice(last)
        if last:
            yield ended(rows.slice(0, last), at[:-1])
    if held is not None:
        yield ended(held, np.zeros(1, np.int64))


def share(count: np.ndarray, total: np.ndarray, terms: int, scale: int = SCALE, smooth: int = 5) -> np.ndarray:
    """1 + floor(scale * (count + smooth) / (total + smooth * terms)), exact while total is under 9e15; ``scale`` is a power of 1000."""
    rest, base = count.astype(np.int64) + smooth, total.astype(np.int64) + smooth * terms
    found = rest // base
    rest = rest - found * base
    while scale > 1:
        digit = rest * 1000 // base
        found, rest, scale = found * 1000 + digit, rest * 1000 - digit * base, scale // 1000
    return found + 1


def divergences(batches: Iterator[pa.RecordBatch], smooth: int) -> Iterator[pa.RecordBatch]:
    """Of kept terms with their language's groups: partial pairs (both named, term null) and terms over the language's share (other null).

    Rows come as (lang, term, sources, counts, groups: sorted names, totals, terms)."""
    names = ["lang", "source", "other", "term", "value"]

    def block(lang: str, sources: list[str], totals: np.ndarray, terms: int, words: list[str], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        p = share(counts, totals[None, :], terms, smooth=smooth)
        q = share(counts.sum(1), totals.sum(), terms, smooth=smooth)
        for i in range(len(sources) - 1):
            value = np.abs(p[:, i + 1 :] - p[:, i : i + 1]).sum(0)
            k = len(value)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * k), pa.array([sources[i]] * k), pa.array(sources[i + 1 :]), pa.nulls(k, pa.string()), pa.array(value, pa.int64())], names=names)
        at, of = np.nonzero((counts > 0) & (p > q[:, None]))
        columns = [pa.array([lang] * len(at), pa.string()), pa.array(sources, pa.string()).take(pa.array(of)), pa.nulls(len(at), pa.string()), pa.array(words, pa.string()).take(pa.array(at)), pa.array((p - q[:, None])[at, of], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        columns, start = {c: batch.column(c) for c in batch.schema.names}, 0
        langs = columns["lang"].to_pylist()
        while start < batch.num_rows:
            sources = columns["names"][start].as_py()
            totals, terms, place = np.array(columns["totals"][start].as_py(), np.int64), columns["terms"][start].as_py(), {s: i for i, s in enumerate(sources)}
            stop, most = start, max(1, BLOCK // max(1, len(sources)))
            while stop < batch.num_rows and langs[stop] == langs[start] and stop - start < most:
                stop += 1
            part = batch.slice(start, stop - start)
            lists = pa.concat_arrays([part.column("sources")])
            which = lists.flatten().dictionary_encode()
            at = np.array([place[s] for s in which.dictionary.to_pylist()], np.int64)[which.indices.to_numpy()]
            counts = np.zeros((stop - start, len(sources)), np.int64)
            counts[np.repeat(np.arange(stop - start), np.diff(lists.offsets.to_numpy())), at] = pa.concat_arrays([part.column("counts")]).flatten().to_numpy()
            yield from block(langs[start], sources, totals, terms, part.column("term").to_pylist(), counts)
            start = stop


def kept_terms(docs: DataFrame, least_docs: int = 30, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, term, docs, and the sources that have the term with their counts, of terms in ``least_docs`` documents of a language."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text_col, lang_col, source_col)]
    rows = docs.select(filled[0].alias("text"), filled[1].alias("lang"), filled[2].alias("source"))
    dealt = rows.mapInArrow(records, RECORD).repartition("lang", "term").sortWithinPartitions("lang", "term", "source", "slice")
    return dealt.mapInArrow(lambda batches: runs(batches, least_docs), KEPT)


def audit(docs: DataFrame, least_docs: int = 30, smooth: int = 5, most_terms: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank: how far each other source of the language is, and which
    terms a source has more often than its language (the first ``most_terms``)."""
    kept = stored(kept_terms(docs, least_docs, text_col, lang_col, source_col), "kept-terms")
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    totals = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    groups = stored(named.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).cast("long").alias("n")), "groups")
    terms = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    of_lang = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("g"))
    of_lang = of_lang.select("lang", F.col("g.source").alias("names"), F.col("g.n").alias("totals")).join(terms, "lang")
    found = kept.drop("docs").join(F.broadcast(of_lang) if groups.count() <= MOST_BROADCAST else of_lang, "lang").mapInArrow(lambda batches: divergences(batches, smooth), "lang string, source string, other string, term string, value long")
    found = stored(found, "divergences")
    sums = found.filter("other is not null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    a, b = groups.select("lang", "source"), groups.select("lang", F.col("source").alias("other"))
    every = a.join(b, "lang").filter("source < other").join(sums, ["lang", "source", "other"], "left").select("lang", "source", "other", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    both = every.select("lang", "source", F.col("other").alias("item"), "value").unionByName(every.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), "value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = both.withColumn("rank", F.row_number().over(best))
    over = found.filter("term is not null").select("lang", "source", F.col("term").alias("item"), "value")
    over = over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most_terms)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(over.withColumn("part", F.lit("term")).select(columns))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The contract in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    p = "1 + ((1000000000::hugeint * ({c} + 5)) // ({n} + 5 * v))"
    return f"""
    with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
            translate(coalesce(text, ''), '{upper}', '{lower}') as t from documents),
    w as (select r, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
    df as (select lang, term from w group by lang, term having count(distinct r) >= 30),
    c as (select lang, source, term, count(*) as c from w semi join df using (lang, term) group by lang, source, term),
    g as (select distinct lang, source from d),
    v as (select lang, count(*) as v from df group by lang),
    n as (select g.lang, g.source, coalesce(sum(c), 0) as n from g left join c using (lang, source) group by g.lang, g.source),
    p as (select n.lang, n.source, df.term, coalesce(c.c, 0) as c, {p.format(c="coalesce(c.c, 0)", n="n.n")} as p
        from n join v using (lang) join df using (lang) left join c on c.lang = n.lang and c.source = n.source and c.term = df.term),
    ln as (select lang, sum(n) as n from n group by lang),
    q as (select lang, term, {p.format(c="c", n="ln.n")} as q from (select lang, term, sum(c) as c from c group by lang, term) x join v using (lang) join ln using (lang)),
    pairs as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    every as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(x.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
        left join pairs x on x.lang = a.lang and x.source = a.source and x.item = b.source
        union all select lang, source, 'term', term, p - q from p join q using (lang, term) where c > 0 and p > q),
    ranked as (select lang, source, part, item, value::bigint as value, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from every)
    select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50"""
