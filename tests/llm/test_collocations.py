import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import random
import re
from collections import Counter

import numpy as np
import pytest
from rows import AWKWARD, CLASHING

from corpusloom.llm import collocations as C


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def brute(rows, threshold=10, most=2000):
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for w in pieces(text):
            words[lang] += len(w)
            for n in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    found = []
    for lang, f in counts.items():
        best = []
        for phrase, a in f.items():
            if len(phrase) == 1 or a < threshold:
                continue
            longer = [t for t in f if len(t) > len(phrase) and phrase in (t[:2], t[1:]) and
                      f[t] >= threshold and 100 * f[t] >= 50 * a]
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            if not longer:
                best.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(found)


def found(spark, rows, **options):
    clashing = [n for n in (*CLASHING, "phrase", "words", "n", "range", "rank") if n != "lang"]
    df = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in rows],
                               "lang string, text string, " + ", ".join(f"{n} string" for n in clashing))
    return sorted(tuple(r) for r in C.collocations(df, **options).collect())


def texts(seed, n, vocabulary=7):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += [f"W{rng.randint(0, vocabulary)}"] if rng.random() < 0.7 else rng.choice(
                [["New", "York", "City"], ["of", "the"], ["a", "a", "a"], ["x y", "é"]])
            words[-1] += rng.choice(["", "", "", ".", ",", "\n", "\t", " ?! "])
        rows.append((rng.choice(["en", "de", None, "und"]), " ".join(words)))
    return rows


def test_against_counting_everything(spark):
    rows = texts(1, 150)
    want = brute(rows)
    assert len({r[0] for r in want}) == 3 and len(want) > 40
    assert found(spark, rows) == want
    assert found(spark, rows, block_bytes=500, range_bytes=900) == want
    assert found(spark, rows, most=5) == [r for r in want if r[1] <= 5]
    assert found(spark, rows, threshold=2, block_bytes=2000, range_bytes=300) == brute(rows, 2)


def test_awkward_rows(spark):
    rows = [(None if n % 2 else "de", t) for n, (_, t) in enumerate(AWKWARD)]
    assert found(spark, rows, threshold=2) == brute(rows, 2)
    assert found(spark, [], threshold=2) == []


def test_hot_language_of_copies(spark):
    rows = [("en", "One passage that all of them share. " * 3)] * 400 + texts(2, 40)
    assert found(spark, rows, block_bytes=3000, range_bytes=3000) == brute(rows)


def test_scores_beyond_64_bits(spark):
    row = spark.sql("SELECT 9000000000000 AS a, 9000000000001 AS l, 9000000000002 AS r")
    got = row.select(C.score(row.a, row.l, row.r)).first()[0]
    assert got == 1_000_000 * 9000000000000 ** 2 // (9000000000001 * 9000000000002)


@pytest.mark.parametrize("threshold", [2, 10])
def test_summaries_lose_nothing_frequent(threshold):
    rng = np.random.default_rng(5)
    for trial in range(20):
        rows, exact = [], Counter()
        for _ in range(rng.integers(1, 30)):
            keys, counts = np.unique(rng.zipf(1.3, 300).astype(np.uint64) * np.uint64(7919), return_counts=True)
            exact.update(dict(zip(keys.tolist(), counts.tolist())))
            rows.append((C.pack(keys), C.pack_numbers(counts)))
        mass = sum(exact.values())
        found = set(C.frequent_keys(rows, mass, threshold).tolist())
        assert {k for k, n in exact.items() if n >= threshold} <= found
        assert len(found) <= mass // threshold + 1


@pytest.mark.parametrize("limit", [C.WORD_LIMIT, 4])
def test_n_grams_of_a_block(monkeypatch, limit):
    monkeypatch.setattr(C, "WORD_LIMIT", limit)
    w = random.Random(3).choices("abcdefgh", k=500)
    grams = C.NGrams("en", [" ".join(w).encode(), b"a, b"])
    want = Counter(" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)) + Counter("ab")
    phrases, times = grams.phrases(np.ones(len(want), bool))
    assert dict(zip(phrases, times.tolist())) == want and grams.n_words == 502
    assert len(set(grams.keys().tolist())) == len(want)
    some = np.arange(len(want)) % 3 == 0
    assert grams.phrases(some)[0] == [p for p, s in zip(phrases, some) if s]
    assert len(C.NGrams("en", [b" ., "]).keys()) == 0


def test_long_texts_are_cut_between_pieces():
    text = b"one two. three four! five six" * 50 + b" no marks " * 100
    parts = list(C.cut(text, 40))
    assert b"".join(parts) == text and len(parts) > 20
    assert all(p[-1:] in b".!" for p in parts[:-1])
