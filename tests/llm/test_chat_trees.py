from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import chat_trees as C

SCHEMA = "tree long, node string, parent string, role string, text string, score double, extra int"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
# One tree with two branches at a and a chain of seven, a circle, an orphan, repeats, nulls.
MESSAGES = [
    (1, "r", None, "user", "root <turn x></turn>", 0.0, 1), (1, "a", "r", "assistant", "A\\", 1.0, 1),
    (1, "b", "r", "assistant", None, 2.0, 1), (1, "c", "a", "user", "C", 5.0, 1),
    (1, "d", "a", None, "", None, 1), (1, "r", None, "user", "root <turn x></turn>", 0.0, 1),
    (2, "x", "y", "user", "circle", 0.0, 1), (2, "y", "x", "user", "circle", 0.0, 1),
    (2, "o", "lost", "assistant", "orphan", 0.0, 1), (None, "n", None, "a>b\\g", "null tree", 0.0, 1),
    (3, None, "n", "user", "no node", 0.0, 1),
    *[(4, str(i), str(i - 1) if i else None, "assistant" if i % 2 else "user", f"t{i}", 1.0, 1)
      for i in range(11)],
]


def brute(messages):
    nodes = {(t, n): (p, r or "", x or "", s or 0.0) for t, n, p, r, x, s, _ in messages if n}
    replied = {(t, p) for (t, _), (p, *_) in nodes.items()}
    paths = {}
    for t, n in nodes:
        if (t, n) in replied:
            continue
        path, at = [], n
        while (t, at) in nodes:
            path.append(at)
            at = nodes[t, at][0]
        paths[t, n] = [nodes[t, m] for m in reversed(path)]
    return paths


def read(paths):
    return paths.withColumn("turns", C.read_turns(F.col("formatted"))).withColumn(
        "loss", C.read_loss(F.col("formatted"), F.col("loss_spans")))


def test_paths_ranks_and_reading_back(spark):
    got = {(r.tree, r.leaf): r for r in read(C.format_paths(
        spark.createDataFrame(MESSAGES, SCHEMA))).collect()}
    want = brute(MESSAGES)
    assert set(got) == set(want)
    for at, path in want.items():
        assert [tuple(t) for t in got[at].turns] == [(r, x) for _, r, x, _ in path]
        assert got[at].loss == [x for _, r, x, _ in path if r == "assistant"]
        assert got[at].score == sum(s for *_, s in path) and got[at].n_turns == len(path)
    assert [got[1, n].path_rank for n in "cbd"] == [1, 2, 3]


def test_only_the_best_branch(spark):
    best = C.format_paths(spark.createDataFrame(MESSAGES, SCHEMA), top=1).collect()
    assert {(r.tree, r.leaf) for r in best} == {(1, "c"), (2, "o"), (None, "n"), (4, "10")}


def test_threads_with_ties_repeats_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None), (1, 2, None, "b"),
            (None, 0, "user", "c"), (None, 0, "assistant", "d")]
    got = {r.tree: [tuple(t) for t in r.turns] for r in read(C.format_paths(C.thread_messages(
        spark.createDataFrame(rows, CONVERSATIONS)))).collect()}
    assert got == {1: [("system", ""), ("user", "a"), ("user", "a"), ("", "b")],
                   None: [("assistant", "d"), ("user", "c")]}
    assert C.format_paths(C.thread_messages(spark.createDataFrame([], CONVERSATIONS))).count() == 0


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="\\<>/turng\n aé", max_size=12), min_size=40, max_size=40))
def test_every_text_comes_back(spark, texts):
    rows = [(i // 4, i % 4, texts[-i - 1], t) for i, t in enumerate(texts)]
    want = defaultdict(list)
    for conv, _, role, text in rows:
        want[conv].append((role, text))
    got = read(C.format_paths(C.thread_messages(spark.createDataFrame(rows, CONVERSATIONS))))
    assert {r.tree: [tuple(t) for t in r.turns] for r in got.collect()} == want


