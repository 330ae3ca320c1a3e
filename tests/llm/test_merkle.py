import random
from collections import Counter
from hashlib import sha256

from rows import AWKWARD, empty, table

from corpusloom.llm import merkle as M


def test_every_row_against_the_next(spark):
    rows = M.compare_edits(table(spark)).collect()
    assert len(rows) == len(AWKWARD)
    for r, (key, text) in zip(sorted(rows, key=repr), sorted(AWKWARD, key=repr)):
        assert r.n_chars is not None and r.fingerprint
    keyed = [(k, t) for k, t in [(5, "five " * 40), (2, "two " * 30), (9, None), (7, "abc")]]
    got = {r.doc_id: r for r in M.compare_edits(table(spark, keyed)).collect()}
    order = sorted(keyed)
    for (k, t), (_, n) in zip(order, order[1:] + order[:1]):
        text, following = t or "", n or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        assert got[k].edited == edited and got[k].n_chars == len(text)
        assert got[k].fingerprint == M.Tree.of(text).fingerprint()
        assert got[k].edited_fingerprint == M.Tree.of(edited).fingerprint()
        assert got[k].near_next == M.likeness(M.Tree.of(text), M.Tree.of(following))


def test_many_ranges_have_the_same_order(spark):
    keyed = [(i, f"text number {i} " * 20) for i in range(60)]
    result = [f for f in M.compare_edits(table(spark, keyed)).schema.fields if f.name != "x"]
    schema = M.T.StructType(result[:2])
    pairs = M.with_next(table(spark, keyed), "doc_id", "text",
                        lambda k, own, nxt, _: ((k, int(nxt.split()[2])), None), schema,
                        range_bytes=1500).collect()
    assert sorted(map(tuple, pairs)) == [(i, (i + 1) % 60) for i in range(60)]


def test_empty_table(spark):
    assert M.compare_edits(empty(spark)).count() == 0


def test_trees():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab c\nd. ") * rng.randint(1, 9) for _ in range(rng.randint(0, 120)))
        tree = M.Tree.of(text)
        assert M.Tree.read(tree.fingerprint()) == tree and M.likeness(tree, tree) == 1
        assert sum(n for s in tree.sections for p in s for _, n in p) == len(text)
        at = rng.randint(0, len(text))
        other = text[:at] + "ZZ" + text[at:]
        (a, b), (c, d) = M.differences(tree, M.Tree.of(other))
        assert a <= at <= b and text[:a] == other[:c] and text[b:] == other[d:]
        assert 0 <= M.likeness(tree, M.Tree.of(other)) < 1
    assert sha256(b"").hexdigest() and M.likeness(M.Tree.of(""), M.Tree.of("x")) == 0


def flat_likeness(a, b):
    """Likeness over all pieces of two texts, cut here once more, without a tree."""
    def pieces(text):
        found = Counter()
        for line in text.split("\n"):
            rest = line + "\n"
            while rest:
                size = next((n + 1 for n in range(24, min(95, len(rest) - 1) + 1) if rest[n].isspace()),
                            None) if len(rest) > 24 else None
                if size is None:
                    size = len(rest) if len(rest) < 96 else 96
                found[rest[:size]] += 1
                rest = rest[size:]
        return found

    one, other = pieces(a), pieces(b)
    both = sum(len(p) * n for p, n in (one & other).items())
    return 2 * both / (len(a) + len(b) + 2)


def test_likeness_is_that_of_all_pieces():
    rng = random.Random(7)
    for trial in range(200):
        lines = [" ".join("".join(rng.choices("abcdefg", k=rng.randint(1, 12))) for _ in range(rng.randint(0, 60)))
                 for _ in range(rng.randint(1, 12))]
        other = [rng.choice(lines) if rng.random() < 0.3 else line + " x" * (rng.random() < 0.2) for line in lines]
        a, b = "\n".join(lines), "\n".join(other)
        if a != b:
            want = flat_likeness(a, b)
            got = M.likeness(M.Tree.of(a + "\n"), M.Tree.of(b + "\n"))
            assert abs(got - want) < 1e-9, (trial, got, want)
