"""BPE encoding and decoding by a trie that shares prefixes.

The distinct words of a batch go into a trie (walked as a sorted list with a stack of the current path). A BPE encoding
is the one sequence of tokens in which every two neighbours are *compatible*: encoding the two together gives these two
again. Hence each prefix has exactly one possible last token, and with it the encoding of the rest is already known from
the node where that token starts. The depth-first walk finds each node's last token once, for all words below it; a
word's last symbol carries the end-of-word mark and is resolved at its leaf. Encodings are read back from the leaf.

Texts are cut at ASCII white space first, at which no word of the tokenizer can cross; the tokenizer's own normaliser and
splitter turn a cut piece into words. Each task keeps caches of bounded size (twice REMEMBERED short pieces and words, as
tuples of ids, and twice as many verdicts on pairs of tokens) and works on BATCH_CHARS of text at a time, or on one text that is longer. There is no shuffle.

Nulls: a null text is empty and has no tokens. Texts of any length are encoded whole. Repeated rows are encoded each;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.llm.common import arrow_type, table

#: A vocabulary file's splitter, and what it comes to on a printable ASCII piece in lower case. (Fixed values.)
SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Most pieces, words and pair verdicts in the younger half of a worker's caches; beyond it, the older half is forgotten.
REMEMBERED = 110_000
#: Pieces that are learnt at a time.
LEARNT = 80_000
#: Longer pieces aren't remembered.
LONGEST = 48
BATCH_CHARS = 5_000_000


class Memory(dict):
    """A cache in two halves: entries of the older half that are asked for move to the younger one."""

    def __init__(self, most: int = REMEMBERED):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        self[key] = found = self.old[key]
        return found

    def knows(self, key) -> bool:
        return key in self or key in self.old

    def age(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class TrieBpe:
    """Encoder for a BPE vocabulary with an end-of-word suffix and no word-inner prefix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a BPE vocabulary without byte fallback is needed")
        # the library's normaliser and splitter alone: its model would be a second copy of the vocabulary in each worker
        library = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None, "decoder": None}))
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        inner = [t for t in self.vocab if not self.end or not t.endswith(self.end)]
        #: What inner tokens begin with, and whole words' and ends' tokens by what they spell.
        self.begins = {t[:k] for t in inner for k in range(1, len(t) + 1)}
        self.closing = {t.removesuffix(self.end): t for t in self.vocab if t.endswith(self.end)}
        self.longest_end = max((len(t) - len(self.end) for t in self.vocab if t.endswith(self.end)), default=1)
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        #: What each id spells, by id.
        self.spelt = pa.array([self.token.get(i) for i in range(max(self.token, default=-1) + 1)], pa.string())
        self.decimal = pa.array([str(i) for i in range(len(self.spelt))], pa.string())
        #: Verdicts on pairs of tokens, by both numbers in one (a pair of strings takes five times as much); a token's number is its id
        #: and one, 0 for what is none. Lengths and ids by number: caches share these ids instead of having objects of their own.
        self.pairs: dict[int, bool] = {}
        self.whole: dict[str, int] = {}
        self.ids = list(range(-1, len(self.spelt)))
        self.length = [0, *(len(self.token.get(i, "")) for i in range(len(self.spelt)))]
        self.made: dict[str, tuple[str, str, int]] = {}
        self.words, self.known = Memory(), Memory()
        self.plain = self._is_plain(spec)

    @staticmethod
    def _is_plain(spec: dict) -> bool:
        """Whether the file's normaliser and splitter are those that ASCII_WORD can stand in for."""
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return kinds == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": SPLITTER} and steps[0]["behavior"] == "Removed" and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]

    # -- what two tokens give together -------------------------------------------------------------------------

    def symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return [*token]

    def merged(self, symbols: list[str]) -> list[str]:
        """Apply merges, lowest rank first and leftmost among equals."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:], strict=False)]
            if (least := min(ranks)) == 1 << 60:
                break
            i = ranks.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def halves(self, token: str) -> tuple[str, str, int]:
        """The merge that ends a token's encoding: its two sides and its rank; a single symbol has itself and -1."""
        if (found := self.made.get(token)) is None:
            symbols, found = self.symbols(token), (token, token, -1)
            while len(symbols) > 1:
                ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:], strict=False)]
                i = ranks.index(min(ranks))
                found = (symbols[i], symbols[i + 1], ranks[i])
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            self.made[token] = found
        return found

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are side by side: no merge across the border comes before one that made either.

        Both are taken apart at the border, the later merge first; a merge across comes too early if its rank is lower (or, against
        the right token's merge, equal, for the leftmost of equals goes first)."""
        a, b, limit = left, right, 1 << 60
        while True:
            if self.rank.get((a, b), 1 << 60) < limit:
                return False
            of_a, of_b = self.halves(a), self.halves(b)
            if of_a[2] < 0 and of_b[2] < 0:
                return True
            if of_a[2] > of_b[2]:
                a, limit = of_a[1], of_a[2]
            else:
                b, limit = of_b[0], of_b[2] + 1

    # -- the walk ------------------------------------------------------------------------------------------------

    def may_be(self, token: str) -> bool:
        """Whether a piece of a word is a token that its own merges give."""
        return self.number(token) > 0

    def number(self, token: str) -> int:
        """The number of such a token, else 0."""
        if (found := self.whole.get(token)) is None:
            own = token in self.vocab and self.merged(self.symbols(token)) == [token]
            found = self.whole[token] = self.vocab[token] + 1 if own else 0
        return found

    def fitting(self, left: int, right: int) -> bool:
        """Whether a token can follow another, by their numbers."""
        if (found := self.pairs.get(left << 32 | right)) is None:
            found = self.pairs[left << 32 | right] = self.compatible(self.token[left - 1], self.token[right - 1])
        return found

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each distinct word. Sorting puts the words in the order of a depth-first walk of their trie; the path
        from the root to the current node is ``last``: last[i] is the number of the last token of word[:i]."""
        out: dict[str, tuple[int, ...]] = {}
        begins, whole, pairs, closing, ids, length = self.begins, self.whole, self.pairs, self.closing, self.ids, self.length
        last, open_, before = [0], [[]], ""  # open_[n]: starts from which word[start:n] begins some token
        for word in sorted(words):
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            keep = min(shared, len(word) - 1) + 1
            del last[keep:], open_[keep:]
            for n in range(len(last), len(word)):
                starts = [s for s in (*open_[-1], n - 1) if word[s:n] in begins]
                open_.append(starts)
                for s in starts:
                    token = word[s:n]
                    if (k := whole.get(token)) is None:
                        k = self.number(token)
                    if k and (not s or pairs.get(last[s] << 32 | k) or self.fitting(last[s], k)):
                        last.append(k)
                        break
                else:
                    raise ValueError(f"no token ends {word[:n]!r}")
            size = len(word)
            for s in range(max(0, size - self.longest_end), size):
                if (token := closing.get(word[s:])) and (k := self.number(token)) and (not s or pairs.get(last[s] << 32 | k) or self.fitting(last[s], k)):
                    break
            else:
                raise ValueError(f"no token ends {word!r}")
            tokens, at = [ids[k]], s
            while at:
                tokens.append(ids[last[at]])
                at -= length[last[at]]
            tokens.reverse()
            out[word] = tuple(tokens)
            before = word
        return out

    # -- texts ---------------------------------------------------------------------------------------------------

    def split(self, piece: str) -> list[tuple[str, bool]]:
        """Words of a piece without white space, and whether each is a special token."""
        parts = self.special_at.split(piece) if self.special_at and "<|" in piece else [piece]
        words: list[tuple[str, bool]] = []
        for part in parts:
            if part in self.special:
                words.append((part, True))
            elif part and self.plain and part.isascii() and part.isprintable():
                words += [(w, False) for w in ASCII_WORD.findall(part.lower())]
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                words += [(w, False) for w, _ in self.pre_tokenizer.pre_tokenize_str(normal)]
        return words

    def learn(self, pieces: set[str]) -> dict[str, tuple[int, ...]]:
        """What long pieces come to; the shorter ones are known afterwards. All new words go through one trie."""
        known, words = self.known, self.words
        known.age()
        words.age()
        if len(self.pairs) > 4 * REMEMBERED:
            self.pairs.clear()
        for p in pieces:
            if p not in known and p in known.old:
                known[p] = known.old[p]
        new = {p: self.split(p) for p in pieces if p not in known}
        fresh = {w for parts in new.values() for w, special in parts if not special and not words.knows(w)}
        long = {}
        for w, coded in self.encode_words(list(fresh)).items():
            (words if len(w) <= LONGEST else long)[w] = coded
        out = {}
        for piece, parts in new.items():
            coded = [(self.special[w],) if special else long[w] if w in long else words[w] for w, special in parts]
            (known if len(piece) <= LONGEST else out)[piece] = coded[0] if len(coded) == 1 else tuple(chain.from_iterable(coded))
        return out

    def looked_up(self, pieces: pa.Array) -> list[tuple[int, ...]]:
        """The ids of each of the pieces. They are learnt in sorted order, LEARNT at a time: words with a common prefix stay together,
        and the caches are never more than that over their bounds."""
        distinct, order = pieces.to_pylist(), pc.array_sort_indices(pieces).to_pylist()
        out: list = [()] * len(distinct)
        for lo in range(0, len(order), LEARNT):
            part = order[lo : lo + LEARNT]
            long, known = self.learn({distinct[i] for i in part} - {""}), self.known
            for i in part:
                if p := distinct[i]:
                    out[i] = long[p] if p in long else known[p]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, pa.ListArray, pa.Array]:
        """Of each text: the number of tokens, the ids, the decoded text.

        Texts are cut and their distinct pieces numbered by Arrow; a piece's ids are looked up once, and put in the places of all its
        occurrences at once."""
        parts = pc.ascii_split_whitespace(texts.fill_null(""))
        pieces = parts.flatten().dictionary_encode()
        coded = self.looked_up(pieces.dictionary)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        ids = pa.array(np.fromiter(chain.from_iterable(coded), np.int32, int(sizes.sum())))
        each = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), ids).take(pieces.indices)
        at = np.concatenate([[0], np.cumsum(sizes[pieces.indices.to_numpy()])])[parts.offsets.to_numpy()]
        coded_texts = pa.ListArray.from_arrays(at.astype(np.int32), each.flatten())
        return np.diff(at), coded_texts, joined(coded_texts, self.spelt.take(coded_texts.values))

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids if i in self.token)


def joined(lists: pa.ListArray, words: pa.Array) -> pa.Array:
    """The words of each list, joined by one space; ``words`` stand for the lists' values."""
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, words), " ")


@lru_cache(2)
def encoder(path: str) -> TrieBpe:
    found = TrieBpe(path)
    gc.freeze()  # the vocabulary stays as long as the worker
    return found


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine (asked on the executor that reads it)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", ids: str = "array", batch_chars: int = BATCH_CHARS, give_back: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (array of ints, or with ids="text" one string of decimals joined by a space) and decoded.

    ``vocabulary``: a path, or the name of a public vocabulary file. ``batch_chars``: text that is worked on at a time.
    ``give_back``: after each slice Arrow returns freed buffers, for less memory and more time."""
    kind = T.ArrayType(T.IntegerType()) if ids == "array" else T.StringType()
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", kind), T.StructField("decoded", T.StringType())])
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()
        release = pa.default_memory_pool().release_unused  # else Arrow keeps freed buffers: those of earlier stages, and of each slice
        release()
        bpe = encoder(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary))
        gc.disable()  # millions of small objects without cycles
        try:
            for batch in batches:
                ends, at = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy()), 0
                while at < batch.num_rows:
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + batch_chars, side="right")))
                    yield coded(bpe, batch.slice(at, to - at))
                    if give_back:
                        release()
                    at = to
        finally:
            gc.enable()

    def coded(bpe: TrieBpe, part: pa.RecordBatch) -> pa.RecordBatch:
        counts, coded_texts, decoded = bpe.encode(pa.concat_arrays([part.column(1)]))
        shown = coded_texts if ids == "array" else joined(coded_texts, bpe.decimal.take(coded_texts.values))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(counts), shown, decoded], schema=arrow)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents"), ids="text")
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
