import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, CLASHING, empty, table

from corpusloom.llm import language_id as L

LESSONS = [("de", "Der schnelle braune Fuchs springt und die Straße ist nicht weit"),
           ("en", "The quick brown fox jumps over the lazy dog and then they went"),
           ("fr", "Le renard brun saute par dessus le chien et ils sont où nous")] * 5 + [
    (None, "nothing to learn"), ("en", None)]


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.createDataFrame(LESSONS, "lang string, text string"))


def test_languages(spark, model):
    assert model.languages == ["en", "de", "fr"] or set(model.languages) == {"de", "en", "fr"}
    df = spark.createDataFrame([("the dog and they",), ("die Straße und der",), ("nous sont le chien",)],
                               "text string")
    assert [r.lang_pred for r in L.identify(df, model, F.col("text")).collect()] == ["en", "de", "fr"]


def test_awkward_rows(spark, model):
    df = table(spark)
    rows = L.identify(df, model, F.col("text")).collect()
    assert len(rows) == len(AWKWARD) and set(CLASHING) <= set(rows[0].asDict())
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred != "und") == letters and 0 <= r.score <= 1
    assert L.identify(empty(spark), model, F.col("text")).count() == 0


def test_without_lessons(spark):
    nothing = L.fit(spark.createDataFrame([], "lang string, text string"))
    df = spark.createDataFrame([("words",)], "text string")
    assert L.identify(df, nothing, F.col("text")).first().lang_pred == "und"


def test_filter_answers_all_languages_and_little_else():
    rng = np.random.default_rng(1)
    grams = {f"l{i}": rng.integers(0, 1 << 60, 500).astype(np.uint64) for i in range(70)}
    model = L.Filter.of(grams, list(grams))
    for i, own in enumerate(grams.values()):
        found = model.masks(own)
        assert (found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()
    others = model.masks(rng.integers(0, 1 << 60, 20_000).astype(np.uint64))
    assert np.mean(others[:, 0] & np.uint64(1)) < 0.01


def test_long_texts_are_cut_between_trigrams(monkeypatch):
    letters, text = L.letter_table(), "Abc déf, ghi " * 40
    whole = [g for _, grams in L.trigrams([text, None, ""], letters) for g in grams]
    monkeypatch.setattr(L, "SEGMENT", 7)
    cut = [g for _, grams in L.trigrams([text, None, ""], letters) for g in grams]
    assert cut == whole and len(whole) == sum(c.isalpha() for c in text)


def _script(n, width=12):
    """Words of an alphabet of its own."""
    rng = np.random.default_rng(n)
    alphabet = [chr(0x4E00 + width * n + i) for i in range(width)]
    return " ".join("".join(rng.choice(alphabet, 5)) for _ in range(12))


def test_every_language_is_learned_and_found(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARES_HELD", 3000)
    lessons = [(f"l{n:03d}", _script(n)) for n in range(300) for _ in range(2)]
    model = L.fit(spark.createDataFrame(lessons, "lang string, text string"))
    assert model.languages == [f"l{n:03d}" for n in range(300)] and len(model.filters) == 5
    rows = L.identify(spark.createDataFrame(lessons, "lang string, text string"), model,
                      F.col("text")).collect()
    assert len(rows) == 600 and all(r.lang_pred == r.lang and r.score > 0.9 for r in rows)


def test_a_large_alphabet_keeps_its_share(spark):
    rng = np.random.default_rng(4)
    letters = [chr(0x4E00 + i) for i in range(2000)]
    large = [("zh", "".join(rng.choice(letters, 400))) for _ in range(60)]
    df = spark.createDataFrame(large + LESSONS, "lang string, text string")
    model = L.fit(df)
    assert len(model.filters[0].slots) > 1 << L.SLOT_BITS
    rows = L.identify(df.filter("lang = 'zh'"), model, F.col("text")).collect()
    assert all(r.lang_pred == "zh" and r.score >= L.SHARE_LEARNED - 0.05 for r in rows)
