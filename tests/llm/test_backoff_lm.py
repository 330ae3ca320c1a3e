import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, empty, table

from corpusloom.llm import backoff_lm as L


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            if w] + ["</s>"]


def brute(rows, learned, order, prior):
    counts = Counter()
    for text, used in zip((t for _, t in rows), learned):
        if used:
            seq = ["<s>"] + tokens(text)
            for i in range(len(seq)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        counts[tuple(seq[i - k + 1:i + 1])] += 1
    single = {g: n for g, n in counts.items() if len(g) == 1 and g != ("<s>",)}
    total, distinct = sum(single.values()), len(single)

    def chance(context, word):
        if not context:
            return (counts[word,] + 0.5) / (total + 0.5 * (distinct + 1))
        return (counts[(*context, word)] + prior * chance(context[1:], word)) / (counts[context] + prior)

    out = []
    for _, text in rows:
        seq = ["<s>"] + tokens(text)
        full = sum(math.log10(chance(tuple(seq[max(0, i - order + 1):i]), seq[i])) for i in range(1, len(seq)))
        base = sum(math.log10(chance((), w)) for w in seq[1:])
        out.append((len(seq) - 1, sum(counts[w,] > 0 for w in seq[1:]), total, base, full))
    return out


@pytest.mark.parametrize("order, block_bytes", [(1, 1 << 20), (2, 3000), (3, 1 << 20)])
def test_scores(spark, order, block_bytes):
    rows = [(i, t) for i, (_, t) in enumerate(AWKWARD)] + [
        (100 + i, f"the cat {w} sat on the {w} mat") for i, w in enumerate("red blue red old".split())]
    learned = [k % 3 != 1 for k, _ in rows]
    got = {r.doc_id: r for r in L.score_texts(table(spark, rows), F.col("doc_id") % 3 != 1, order=order,
                                              prior=2.0, block_bytes=block_bytes).collect()}
    for (key, _), used, want in zip(rows, learned, brute(rows, learned, order, 2.0)):
        r = got[key]
        assert r.learned == used and (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3]) and r.score == pytest.approx(want[4])


def test_null_keys_empty_table_and_nothing_learned(spark):
    assert L.score_texts(table(spark), F.lit(None).cast("boolean")).filter("score = 0").count() == len(AWKWARD)
    assert L.score_texts(empty(spark), F.lit(True)).count() == 0


def test_chances_of_a_context_sum_to_one(spark):
    rows = [(0, "a b a c"), (1, "b a")] + [(2 + i, f"a {w}") for i, w in enumerate(["a", "b", "c", "new"])]
    got = L.score_texts(table(spark, rows + [(9, "a")]), F.col("doc_id") < 2, prior=1.0)
    score = {r.doc_id: r.score for r in got.collect()}
    # After "a": four words, one of them unseen, and the end.
    want = brute(rows + [(9, "a")], [True, True] + [False] * 5, L.ORDER, 1.0)
    assert score[9] == pytest.approx(want[-1][4])


@pytest.mark.parametrize("order, lane", [(1, 3), (2, 1), (3, 2), (3, 5), (4, 3), (4, 500)])
def test_walks_in_lanes_of_any_length(order, lane):
    rng = random.Random(order * 10 + lane)
    texts = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 30))) for _ in range(25)]
    learned = [rng.random() < 0.6 for _ in texts]
    grams = L.Grams.of(texts, order)
    counts = grams.counts(np.array(learned))
    total, distinct = int(counts[0].sum()), int((counts[0] > 0).sum())
    automaton = L.Automaton.of(grams, counts, total, distinct, 1.5)
    paid = np.add.reduceat(automaton.traverse(grams, order, lane), grams.starts)
    want = brute([(0, t) for t in texts], learned, order, 1.5)
    assert paid.tolist() == pytest.approx([w[4] for w in want])
