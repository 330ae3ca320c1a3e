import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from rows import AWKWARD, empty, table

from corpusloom.llm import ngram_jaccard as N
from corpusloom.llm.components import connected
from corpusloom.llm.queries import QUERIES


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=80):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        keys = [k for k, _ in (rows[j] for j in range(len(rows)) if find(j) == find(i)) if k is not None]
        low[i] = min(keys, default=None)
    return sorted(((k, len(sets[i]), low[i]) for i, (k, _) in enumerate(rows)), key=repr)


def found(df, **options):
    return sorted(((r.doc_id, r.n_grams, r.component)
                   for r in N.jaccard_components(df, **options).collect()), key=repr)


def test_awkward_rows(spark):
    assert found(table(spark)) == brute(AWKWARD)
    assert N.jaccard_components(empty(spark)).count() == 0


def similar_rows(seed, families, copies):
    """Families of copies with a few edits, with a passage that all share."""
    rng, rows = random.Random(seed), []
    passage = [f"p{i}" for i in range(30)]
    for family in range(families):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(3, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10 ** 6)}"
            if rng.random() < 0.5:
                words += passage
            rows.append((rng.randint(0, 10 ** 6), " ".join(words)))
    return rows


def test_against_all_pairs_over_many_blocks(spark):
    rows = similar_rows(7, 25, 12)
    assert found(table(spark, rows), block_bytes=4000) == brute(rows)


def near_copies(seed, n, length=60, edits=9, passage=12):
    """Copies of one text with some words changed: most are near it, few are near each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 900)}" for _ in range(length)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits) // 2):
            words[rng.randrange(length)] = f"x{rng.randint(0, 400)}"
        rows.append((k, " ".join(words + [f"p{i}" for i in range(passage * rng.randint(0, 1))])))
    return rows


def all_overlaps(rows):
    """(sizes, overlaps of all pairs) by a dense product."""
    sets = [grams(t) for _, t in rows]
    columns = {g: i for i, g in enumerate({g for s in sets for g in s})}
    incidence = np.zeros((len(rows), len(columns)), np.float32)
    for row, s in zip(incidence, sets):
        row[[columns[g] for g in s]] = 1
    return incidence.sum(axis=1), incidence @ incidence.T


def test_a_large_group_of_near_copies_is_joined_without_its_pairs(spark, monkeypatch):
    rows = near_copies(5, 2000)
    sizes, overlaps = all_overlaps(rows)
    linked = 100 * overlaps >= 80 * (sizes[:, None] + sizes[None, :] - overlaps)
    assert 0.02 < linked.mean() < 0.9
    component = np.arange(len(rows))
    while True:
        least = np.where(linked, component[None, :], len(rows)).min(axis=1)
        if (least == component).all():
            break
        component = least
    passed = []

    def counted(df, purpose, write=N.written):
        out = write(df, purpose)
        passed.append((purpose, out.count()))
        return out

    monkeypatch.setattr(N, "written", counted)
    got = sorted((r.doc_id, r.n_grams, r.component) for r in N.jaccard_components(
        table(spark, rows, extra=False), block_bytes=200_000).collect())
    assert got == [(k, int(sizes[k]), int(component[k])) for k in range(len(rows))]
    assert len(set(component.tolist())) > 20
    # Columns in front are a fifth of a row; no table holds more than these.
    most = sum(int(s) // 5 + 1 for s in sizes)
    assert {p for p, _ in passed} >= {"front", "hub-links", "blocks"}
    assert all(n <= most for _, n in passed), passed


def test_products_of_blocks_join_what_links(monkeypatch):
    rng = np.random.default_rng(6)
    for trial in range(60):
        n, percent = int(rng.integers(2, 40)), int(rng.choice([30, 50, 80]))
        base = rng.choice(500, 30, replace=False)
        shared = []
        for _ in range(n):
            kept = base[rng.random(30) < rng.choice([0.4, 0.9])]
            shared.append(np.unique(np.concatenate([kept, rng.integers(500, 520, 4)])).astype(np.uint64))
        sizes = np.array([len(s) for s in shared])
        counts = np.bincount(np.concatenate(shared).astype(int), minlength=600)
        fronts = []
        for s in shared:
            order = np.lexsort((s, counts[s.astype(int)]))
            fronts.append(s[order[:len(s) - -(-percent * len(s) // 100) + 1]])
        side = rng.random(n) < 0.5 if trial % 2 else np.zeros(n, bool)
        component = rng.integers(0, n, n) if trial % 3 else np.arange(n)
        parent = {int(c): int(c) for c in component}

        def find(c):
            while parent[c] != c:
                c = parent[c]
            return c

        for a, b in N.product_links(sizes, fronts, shared, component, side, percent):
            both = len(np.intersect1d(shared[a], shared[b]))
            assert 100 * both >= percent * (sizes[a] + sizes[b] - both)
            assert find(int(component[a])) != find(int(component[b]))
            parent[find(int(component[a]))] = find(int(component[b]))
        for a in range(n):
            for b in range(a):
                both = len(np.intersect1d(shared[a], shared[b]))
                if 100 * both >= percent * (sizes[a] + sizes[b] - both) and (side[a] != side[b] or not side.any()):
                    assert find(int(component[a])) == find(int(component[b]))


def test_one_of_each_stays(spark):
    rows = similar_rows(8, 4, 6)
    stay = N.one_of_each(table(spark, rows))
    assert stay.columns == table(spark).columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted({c for *_, c in brute(rows)})


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)]
    links += [(i, i + 1) for i in range(100, 120)]
    near = {}
    for a, b in links:
        near.setdefault(a, {a}).add(b)
        near.setdefault(b, {b}).add(a)
    want = {}
    for node in near:
        seen, todo = set(), [node]
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += near[at]
        want[node] = min(seen)
    got = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == want


def test_columns_pass_as_arrays():
    rows = [np.array([3, 2 ** 63 + 5], np.uint64), np.empty(0, np.uint64), np.array([7], np.uint64)]
    lists = N._lists([r.view(np.int64) for r in rows])
    for part, want in ((lists, rows), (lists.slice(1), rows[1:]), (lists.slice(2), rows[2:])):
        got = N._arrays(pa.chunked_array([part.slice(0, 1), part.slice(1)]))
        assert [g.tolist() for g in got] == [w.tolist() for w in want]


def test_op4_takes_few_texts_at_a_time(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        QUERIES["op4_ngram_jaccard"](spark, "/root/testdata/sf0.001")
        assert int(spark.conf.get(name)) <= 1000
    finally:
        spark.conf.set(name, kept)


def test_blocks_are_multiplied_where_they_lie(spark, monkeypatch):
    """However many blocks a row meets, it is not sent to each of them."""
    rows, plans, product = near_copies(9, 400, edits=30), [], N._product

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    def watched(*args):
        out = product(*args)
        return planned(out) if isinstance(out, DataFrame) else map(planned, out)

    monkeypatch.setattr(N, "_product", watched)
    assert found(table(spark, rows, extra=False), block_bytes=20_000) == brute(rows)
    assert plans and not any("Exchange" in p for p in plans)
    assert len(plans) > 1


def test_blocks_pass_in_order_and_whole(spark):
    sized = [(p, b"x" * n) for p, n in enumerate([3, 3, 5, 9, 1, 1, 1])]
    blocks = spark.createDataFrame(sized, "part int, shared binary")
    assert N._passes(blocks, 8) == [(0, 1), (2, 2), (3, 3), (4, 6)]
    assert N._passes(blocks.limit(0), 8) == []


def test_keys_get_longer_with_the_texts():
    for n_bytes in (0, 10 ** 6, 10 ** 9, 6 * 10 ** 9, 10 ** 12):
        bits = N.key_bits(n_bytes)
        assert 32 <= bits <= 64
        # Columns of two bytes are as many as can be.
        assert n_bytes / 2 / 2 ** bits < 1 / 16
    columns = np.array([0, 1 << 20, 5 << 40, 2 ** 64 - 1], np.uint64)
    assert N._high(columns, 64).tolist() == columns.tolist()
    assert N._high(columns, 44).tolist() == [0, 1, 5 << 20, 2 ** 44 - 1]
    assert N._borders(4, 64).tolist() == [0, 1 << 62, 1 << 63, 3 << 62]
