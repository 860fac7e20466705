"""The recurrent model of op5_language_model against plain loops, and its probabilities against one."""

import math
import re

import numpy as np
import pytest

from muster.llm.op5_language_model import END, Gru, Scorer, cut, score_documents

WORDS = ["", "the", "of", "river", "stone", "bridge", "old", "new", "ran", "past"]


@pytest.fixture(scope="module")
def scorer():
    counts = np.array([50, 40, 30, 9, 8, 7, 6, 5, 4, 3])
    found = Scorer(WORDS, counts, int(counts.sum()), len(WORDS))
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, len(WORDS), k) for k in (5, 40, 17, 1, 60)]
    for _ in range(3):
        found.train(docs)
    return found


def plain_log10(m: Gru, ids) -> float:
    """The sum over a document's tokens of log10 P(class) P(word | class), one step at a time."""
    h, before, total = np.zeros(m.h), m.v, 0.0
    for i in ids:
        x, k = m.inputs[before], 2 * m.h
        a = h @ m.recur
        zr = 1 / (1 + np.exp(-x[:k] - a[:k]))
        c = np.tanh(x[k:] + zr[m.h :] * a[k:])
        h = zr[: m.h] * h + (1 - zr[: m.h]) * c
        classes = h @ m.class_w + m.class_b
        own = m.of_class[i]
        lo, hi = m.starts[own], m.starts[own + 1]
        words = h @ m.word_w[:, lo:hi] + m.word_b[lo:hi]
        total += classes[own] - np.log(np.exp(classes).sum()) + words[i - lo] - np.log(np.exp(words).sum())
        before = i
    return total / math.log(10)


def test_scores_equal_a_plain_loop_over_windows_and_streams(scorer):
    rng = np.random.default_rng(9)
    docs = [rng.integers(0, len(WORDS), k) for k in (1, 3, 200, 49, 48, 12)]
    assert np.allclose(scorer.log10(docs), [plain_log10(scorer.model, d) for d in docs], atol=1e-3)


def test_probabilities_of_the_next_word_sum_to_one(scorer):
    m = scorer.model
    state = np.random.default_rng(2).standard_normal((1, m.h)).astype(np.float32)
    logs = m.output(np.repeat(state, m.v, 0), np.arange(m.v), False)[0]
    assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_gradients_equal_differences(scorer):
    m = scorer.model
    rng = np.random.default_rng(3)
    states, targets = rng.standard_normal((4, m.h)).astype(np.float32), rng.integers(0, m.v, 4)
    g = m.output(states, targets, True)[1]["states"]
    for at in ((0, 0), (1, 2), (3, m.h - 1)):
        up, down = states.copy(), states.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        slope = -(m.output(up, targets, False)[0].sum() - m.output(down, targets, False)[0].sum()) / 2e-2
        assert abs(slope - g[at]) < 2e-2


def test_cut_equals_the_contract(spark):
    import pyarrow as pa

    texts = [None, "", "  A b\x0bÉc\x1cd\x85 \n", "x", "B B"]
    words, index, edges = cut(pa.array(texts, pa.string()))
    got = [[words[int(i)].as_py() for i in index[a:b]] for a, b in zip(edges, edges[1:], strict=False)]
    want = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    assert got == want and END == ""


def test_training_beats_word_counts_on_text_with_order(spark):
    rows = [(i, " ".join(["left right up down"] * 40)) for i in range(60)]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(1)).filter("held_out").collect()
    assert got and all(r["score"] > r["base_score"] for r in got)
