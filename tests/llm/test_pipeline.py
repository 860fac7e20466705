"""The five stages against a brute-force version on the smallest tables."""

import itertools
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import regex
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from muster.llm import op7_decontaminate as op7
from muster.llm import op10_lines as op10
from muster.llm.near_documents import shingle_hashes
from muster.llm.op3_bpe import vocabulary_path
from muster.llm.op6_quality import judge

SF = "/root/testdata/sf0.001"


def smallest_reachable(nodes: list, edges: list) -> dict:
    label = {x: x for x in nodes}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similar(a: str, b: str) -> bool:
    allowed = int((1 - op10.SIMILARITY) * max(len(a), len(b)) + 1e-9)
    return abs(len(a) - len(b)) <= allowed and distance(a, b) <= allowed


def blocks(line: str, edits: int) -> set[tuple]:
    """Where a block of a line that is up to ``edits`` characters shorter can lie in this one."""
    out = set()
    for length in range(len(line) - edits, len(line) + 1):
        sizes = [length // (edits + 1) + (edits + 1 - i <= length % (edits + 1)) for i in range(edits + 1)]
        for i, size in enumerate(sizes):
            start, shorter = sum(sizes[:i]), len(line) - length
            for shift in range(-edits, edits + 1):
                if abs(shift) <= i and abs(shift - shorter) <= edits - i:
                    out.add((edits, i, length, line[start + shift : start + shift + size]))
    return out


def line_keys(line: str) -> set[tuple]:
    """What a line can be found by: blocks of its text, or SimHashes of its lanes."""
    out: set[tuple] = blocks(line, 1) if op10.SHORT <= len(line) <= op10.ONE_EDIT else set()
    out |= blocks(line, op10.EDITS) if op10.SOME_EDITS <= len(line) <= op10.TEXT else set()
    if len(line) >= op10.LANED:
        ranks = sorted({(127 - min(len(w), 127)) << 56 | xxhash.xxh64_intdigest(w, 42) & (1 << 56) - 1 for w in regex.findall(r"[\p{L}\p{N}]+", line)})[: op10.DEALT]
        for k in range(op10.LANES):
            lane = [r for r in ranks if r % op10.LANES == k][: op10.TOP]
            if sum(127 - (r >> 56) for r in lane) >= op10.LETTERS:
                out.add((k, sum(1 << i for i in range(64) if 2 * sum(r >> i & 1 for r in lane) > len(lane))))
    return out


def without_repeated_lines(texts: dict[int, str]) -> dict[int, str]:
    spots: dict[str, tuple[int, int]] = {}
    where = {}
    for d, t in sorted(texts.items()):
        for pos, line in enumerate(t.split("\n")):
            if regex.search(r"[\p{L}\p{N}]", line):
                where[d, pos] = norm = regex.sub(r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ", line.lower()).strip(" ")
                spots.setdefault(norm, (d, pos))
    holders = defaultdict(list)
    for s in spots:
        for k in line_keys(s):
            holders[k].append(s)
    pairs = {p for held in holders.values() for p in itertools.combinations(sorted(held), 2)}
    edges = [(spots[a], spots[b]) for a, b in pairs if similar(a, b)]
    assert edges
    first = smallest_reachable(list(spots.values()), edges)
    out = {}
    for d, t in texts.items():
        kept = [line for pos, line in enumerate(t.split("\n")) if (d, pos) not in where or (spots[where[d, pos]] == (d, pos) == first[d, pos])]
        if kept:
            out[d] = "\n".join(kept)
    return out


def one_of_each_group(texts: dict[int, str]) -> dict[int, str]:
    sets = {i: set(shingle_hashes(t).tolist()) for i, t in texts.items()}
    edges = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return {i: texts[i] for i, c in smallest_reachable(list(sets), edges).items() if i == c}


def leaks(text: str, items: list[Counter], lengths: list[int]) -> bool:
    words = op7.words_of(text)
    every = set(op7.shingles_of(words))
    for item, n in zip(items, lengths, strict=True):
        if every & item.keys():
            for at in range(max(1, len(words) - n + 1)):
                window = Counter(op7.shingles_of(words[at : at + n]))
                if (window & item).total() >= op7.SIMILARITY * (window | item).total():
                    return True
    return False


def test_pipeline_equals_brute_force(spark):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    texts = {r["doc_id"]: judge(r["text"])[7] for r in rows if judge(r["text"])[6]}
    texts = one_of_each_group(without_repeated_lines(texts))
    bench = [op7.words_of(r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    items, lengths = [Counter(op7.shingles_of(w)) for w in bench if w], [len(w) for w in bench if w]
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = {}
    for i, t in texts.items():
        if not leaks(t, items, lengths):
            ids = library.encode(t, add_special_tokens=False).ids
            want[i] = (ids, library.decode(ids, skip_special_tokens=False))
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == sorted(want)
    assert got == want
    assert len(want) < len(rows)


ODD = [(1, None, "a", 3), (2, "", "b", None), (3, "word " * 9, "c", 1), (None, "A line of its own with several words in it that nobody wrote before. " * 8, "d", 2), (None, "A line of its own with several words in it that nobody wrote before. " * 8, "d", 2)]


def test_stages_on_odd_rows(spark):
    """Null ids and texts, repeated rows and a column named like one of the stages' own."""
    prose = " ".join(f"Sentence{i} goes{i} onward{i} nicely{i}." for i in range(30))
    rows = [(i, t, s, n) for i, t, s, n in ODD] + [(7, prose + "\nclick here", "x", 9), (7, prose + "\nclick here", "x", 9), (8, prose.replace("Sentence3 ", "Sentence3x "), "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_chars long")
    good = corpus_pipeline.quality(spark, docs, SF)
    assert good.columns == docs.columns and {(r["doc_id"], r["text"], r["n_chars"]) for r in good.collect()} == {(7, prose, len(prose)), (8, rows[-1][1], len(rows[-1][1]))}
    near = corpus_pipeline.near_dedup(spark, good, SF)
    assert [r["doc_id"] for r in near.collect()] == [7]
    alone = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted(str(r["doc_id"]) for r in alone) == ["1", "3", "7", "None"] or sorted(str(r["doc_id"]) for r in alone) == ["1", "3", "7", "8", "None"]
    cut = corpus_pipeline.line_dedup(spark, docs, SF)
    assert cut.columns == docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
