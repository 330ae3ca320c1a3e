import random
from collections import defaultdict
from itertools import product

import pytest
from rows import AWKWARD, empty, table

from corpusloom.llm import packing as P


# A lambda travels to the workers by value.
ids_of = lambda text: b"".join(ord(c).to_bytes(4, "little") for c in text or "")


def test_subset_sums_against_all_choices():
    rng = random.Random(2)
    for _ in range(150):
        counts = {n: rng.randint(1, 3) for n in rng.sample(range(1, 20), rng.randint(0, 4))}
        capacity = rng.randint(0, 40)
        chosen = P.fill(counts, sorted(counts), capacity)
        assert all(1 <= n <= counts[size] for size, n in chosen.items())
        best = max((s for s in (sum(size * n for size, n in zip(counts, c)) for c in product(
            *(range(n + 1) for n in counts.values()))) if s <= capacity), default=0)
        assert sum(size * n for size, n in chosen.items()) == best


def check(pieces, documents, capacity):
    """documents: the ids of each; pieces (document, start, length, window, offset) cover them."""
    by_document, by_window = defaultdict(list), defaultdict(list)
    for document, start, length, window, offset in pieces:
        by_document[document].append((start, length))
        by_window[window].append((offset, length))
    for document, size in documents.items():
        at = 0
        for start, length in sorted(by_document[document]):
            assert start == at and length > 0
            at += length
        assert at == size
    short = []
    for placed in by_window.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
        short += [at] if at < capacity else []
    assert all(n & (n - 1) == 0 for n in short) and len(set(short)) == len(short)


@pytest.mark.parametrize("sizes", [[700] * 50, [1] * 3000, [1023, 1], [2500], [],
                                   random.Random(4).choices(range(1, 3000), k=400)])
def test_windows_are_full_and_cover_each_token_once(sizes):
    pieces = []
    windows = P.Windows(1024, lambda *piece: pieces.append(piece))
    for i, size in enumerate(sizes):
        windows.add(i, size)
    windows.finish()
    check(pieces, dict(enumerate(sizes)), 1024)


def test_rows(spark):
    rows = [(i, t) for i, (_, t) in enumerate(AWKWARD)]
    got = P.pack(table(spark, rows), ids_of, end_id=7, capacity=64, run_tokens=500).collect()
    sizes = {i: len(t or "") + 1 for i, t in rows}
    assert all(r.doc_tokens == sizes[r.doc_id] and len(r.ids) == 4 * r.length for r in got)
    pieces = defaultdict(bytes)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        pieces[r.doc_id] += r.ids
    assert pieces == {i: ids_of(t) + (7).to_bytes(4, "little") for i, t in rows}
    by_window = defaultdict(int)
    for r in got:
        by_window[r.sequence_id] += r.length
    assert all(n <= 64 and (n == 64 or n & (n - 1) == 0) for n in by_window.values())
    # Rows without a key of their own are packed as well.
    again = P.pack(table(spark), ids_of, capacity=64)
    assert again.groupBy().sum("length").first()[0] == sum(sizes.values())
    assert P.pack(empty(spark), ids_of).count() == 0
    with pytest.raises(ValueError):
        P.pack(table(spark), ids_of, capacity=0)
