import random

from corpusloom.operators import known_ids as K


def test_no_known_id_is_missed_and_few_others_are_taken_for_known(spark):
    rng = random.Random(4)
    stored = [f"doc-{rng.randint(0, 10 ** 9)}" for _ in range(5000)]
    n_words = K.word_count(len(stored))
    first, second = (spark.createDataFrame([(i,) for i in part], "doc_id string")
                     for part in (stored[:2000], stored[1500:]))
    sketches = K.sketch(first, n_words).unionByName(K.sketch(second, n_words))
    other = [f"new-{n}" for n in range(5000)]
    asked = spark.createDataFrame([(i, 1) for i in [*dict.fromkeys(stored), *other, None]], "doc_id string, word int")
    rows = K.with_chance(asked, sketches, n_words).collect()
    assert len(rows) == len(set(stored)) + 5001 and set(rows[0].asDict()) == {"doc_id", "word", "may_be_known"}
    said = {r.doc_id: r.may_be_known for r in rows}
    assert all(said[i] for i in stored) and not said[None]
    assert 0 < sum(said[i] for i in other) < 0.05 * len(other)


def test_merging_is_that_of_all_ids(spark):
    ids = spark.createDataFrame([(f"d{n}",) for n in range(300)], "doc_id string")
    parts = [K.sketch(ids.filter(f"crc32(doc_id) % 3 = {n}"), 64) for n in range(3)]
    whole = {r.word: r.bits for r in K.sketch(ids, 64).collect()}
    joined = K.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert {r.word: r.bits for r in joined.collect()} == whole
    assert all(bin(b & (1 << 64) - 1).count("1") <= 4 * 300 for b in whole.values())
    assert K.sketch(ids.limit(0), 64).count() == 0


def test_words_are_a_power_of_two():
    assert K.word_count(0) == 1 << 10
    for n in (10 ** 4, 10 ** 6, 10 ** 9):
        words = K.word_count(n)
        assert words & (words - 1) == 0 and 8 <= words * 64 / n <= 64
