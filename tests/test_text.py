import hashlib
import json

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.text import SPACE_POINTS
from corpusloom.operators import validate


def model(text):
    """What cleaning means, by Python's own notion of whitespace."""
    return " ".join(text.replace("\0", "").split())


def cleaned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    rows = df.select("n", X.clean_text("text").alias("c"), X.is_blank("text").alias("b")).collect()
    return [(r.c, r.b) for r in sorted(rows, key=lambda r: r.n)]


def test_every_code_point_up_to_the_last_space(spark):
    points = [p for p in range(0x3100) if not 0xD800 <= p < 0xE000]
    texts = [f"a{chr(p)}b{chr(p)}{chr(p)} c{chr(p)}" for p in points]
    for p, text, (c, _) in zip(points, texts, cleaned(spark, texts)):
        assert c == model(text), hex(p)
    blanks = cleaned(spark, [chr(p) * 2 for p in points])
    found = [p for p, (_, blank) in zip(points, blanks) if blank]
    assert found == SPACE_POINTS == [p for p in points if chr(p).isspace()]


def test_nulls_and_nul(spark):
    assert cleaned(spark, [None, "", "\0", " \0 ", "a\0b", "\0 a \0", "\x1c\x1fa"]) == [
        ("", True), ("", True), ("", False), ("", False), ("ab", False), ("a", False),
        ("a", False)]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t\n\0  　 abé𝄞", max_size=30),
                min_size=1, max_size=40))
def test_random_texts(spark, texts):
    assert [c for c, _ in cleaned(spark, texts)] == [model(t) for t in texts]


def test_hashes(spark):
    row = spark.range(1).select(
        X.sha256(F.lit("é")).alias("a"),
        X.key_hash(F.lit("d"), F.lit("h"), F.lit(0), F.lit(384)).alias("b"),
        X.key_hash(F.lit("d"), F.lit(None).cast("string"), F.lit(1)).alias("c")).first()
    assert row.a == hashlib.sha256("é".encode()).hexdigest()
    assert row.b == hashlib.sha256(b"d|h|0|384").hexdigest()
    assert row.c == hashlib.sha256(b"d||1").hexdigest()


RAW = "id string, url string, title string, text string, seq int"


def test_reject_reasons_and_their_order(spark):
    raw = spark.createDataFrame([
        ("", "u", "t", "", 1), (" ", "u", None, "fine", 2), (None, None, None, None, 3),
        ("a", "u", "t", None, 4), ("b", "u", "t", " \x1f", 5), ("c", "u", "t", "\0 \0", 6),
        (" d ", None, None, " x  y ", 7)], RAW)
    rejected = {r.raw_snapshot: r for r in validate.rejected_documents(raw, 3).collect()}
    reasons = [(json.loads(k)["id"], r.doc_id, r.reason_code, r.reason_detail, r.run_id)
               for k, r in rejected.items()]
    assert sorted(reasons, key=lambda r: (r[0] or "", r[3])) == sorted([
        ("", "", "MISSING_ID", "id is empty", 3),
        (" ", " ", "MISSING_ID", "id is empty", 3),
        (None, "", "MISSING_ID", "id is empty", 3),
        ("a", "a", "EMPTY_TEXT", "text is empty or None after strip", 3),
        ("b", "b", "EMPTY_TEXT", "text is empty or None after strip", 3),
        ("c", "c", "EMPTY_TEXT", "text is empty after cleaning", 3),
    ], key=lambda r: (r[0] or "", r[3]))
    valid = validate.valid_documents(raw).collect()
    assert [(v.doc_id, v.url, v.title, v.cleaned_text, v.text_len) for v in valid] == [
        (" d ", "", "", "x y", 3)]
    assert valid[0].content_hash == hashlib.sha256(b"x y").hexdigest()


def test_snapshot_keeps_nulls_and_the_first_characters(spark):
    raw = spark.createDataFrame([("", None, "t", "é" * 600, 1), ("", "u", "t", "", 2)], RAW)
    shots = [json.loads(r.raw_snapshot) for r in validate.rejected_documents(raw, 1).collect()]
    assert shots == [{"id": "", "url": None, "title": "t", "text": "é" * 500},
                     {"id": "", "url": "u", "title": "t", "text": None}]
