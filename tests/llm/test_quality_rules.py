import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import random
import re
from collections import Counter

from rows import AWKWARD, CLASHING

from corpusloom.llm import quality_rules as Q


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def rounded(value):
    drop = max(0, value.bit_length() - 8)
    return value >> drop << drop


def brute(rows, least=100):
    """(doc_id, measures, base_failed, kept) with quartiles taken from sorted lists."""
    known = [(k, lang, source, measures(t)) for k, t, lang, source in rows]
    failed = [m[0] < 50 or 100 * m[5] > 50 * m[0] for *_, m in known]

    def ratios(m):
        return [1000 * a // b for a, b in ((m[1], m[0]), (m[2], m[0]), (m[4], m[3]), (m[5], m[0]))]

    groups = {}
    for (_, lang, source, m), bad in zip(known, failed):
        if not bad:
            for g in ((lang, source), (lang,), ()):
                groups.setdefault(g, []).append([rounded(v) for v in ratios(m)])
    found = []
    for (k, lang, source, m), bad in zip(known, failed):
        kept = not bad
        if kept:
            group = next(g for g in ((lang, source), (lang,), ()) if not g or len(groups[g]) >= least)
            for n, (value, spread) in enumerate(zip(ratios(m), (250, 15, 50, 30))):
                own = sorted(g[n] for g in groups[group])
                q1, q3 = (own[-(-len(own) * p // 100) - 1] for p in (25, 75))
                reach = 6 * max(q3 - q1, spread)
                kept &= value <= q3 + reach and (n > 0 or value >= q1 - reach)
        found.append((k, *m, bad, kept))
    return sorted(found, key=repr)


def found(spark, rows, **options):
    clashing = [*CLASHING, "n_words", "broken", "rule", "value", "texts", "base_failed"]
    df = spark.createDataFrame([(*r, *["x"] * len(clashing)) for r in rows],
                               "doc_id long, text string, lang string, source string, " +
                               ", ".join(f"{n} string" for n in clashing))
    got = Q.quality_rules(df, **options).select("doc_id", *Q.MEASURES, "base_failed", "kept")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def documents(seed, n):
    rng, rows = random.Random(seed), []
    for k in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["hot", "hot", "hot", "b", None])
        size = rng.choice([3, 60, 120, 200])
        longest = 9 if lang == "de" else 6
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, longest))) for _ in range(size)]
        kind = rng.randint(0, 12)
        if kind == 0:
            words = [w + "#$%"[:rng.randint(1, 3)] for w in words]
        elif kind == 1:
            words = ["".join(rng.choices("abc", k=40)) for _ in words]
        elif kind == 2:
            words = words[:9] * (size // 9 + 1)
        text = " ".join(w + rng.choice(["", "", ".\n"]) for w in words)
        rows.append((k, text + "\nsame line\nsame line" * (rng.randint(0, 60) if kind == 3 else 0), lang, source))
    return rows


def test_against_sorted_values(spark):
    rows = documents(1, 400)
    want = brute(rows, least=30)
    kept = [r[-1] for r in want]
    assert 0.3 * len(rows) < sum(kept) < 0.8 * len(rows)
    assert sum(not r[-2] and not r[-1] for r in want) > 40
    assert found(spark, rows, least_texts=30) == want
    assert found(spark, rows, least_texts=10 ** 6) == brute(rows, 10 ** 6)


def test_awkward_rows(spark):
    rows = [(k, t, None if n % 2 else "de", "s" if n % 3 else None) for n, (k, t) in enumerate(AWKWARD)]
    rows.append((20, "one two three " * 40_000, "de", "s"))
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_a_group_of_copies_does_not_reject_the_rest(spark):
    rows = documents(2, 150)
    sound = next(t for _, t, *_ in rows if not brute([(0, t, "en", "s")])[0][-2])
    rows += [(1000 + n, sound, "en", "hot") for n in range(400)]
    want = brute(rows)
    assert found(spark, rows) == want
    assert sum(r[-1] for r in want) > 450


def test_repeated_words_of_many_kinds(monkeypatch):
    rng = random.Random(4)
    for limit in (Q.WORD_LIMIT, 3):
        monkeypatch.setattr(Q, "WORD_LIMIT", limit)
        for _ in range(200):
            text = " ".join(rng.choices("abcdef", k=rng.randint(0, 30)))
            assert Q.measure(text) == measures(text)
