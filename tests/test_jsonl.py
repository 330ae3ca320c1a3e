import json

from corpusloom.sources import jsonl


def write(path, lines):
    path.write_bytes("\n".join(lines).encode("utf-8"))
    return str(path)


def test_faulty_lines(spark, tmp_path):
    lines = [
        '﻿{"id": "1", "url": "u", "title": "t", "text": "x"}',
        "", "   ", " \u001c",
        '{"id": "2", "text": "cut',
        '[{"id": "3", "text": "x"}]',
        '"text"', "17",
        "{'id': '4', 'text': 'x'}",
        '{"id": "40", "text": "x"} more', '{"id": "41"}{"id": "42"}', '{"id": "43"},{"id": "44"}',
        '{"id": "45", "text": "x"}}', '{"id": "46"}],[{"id": "47"}', "null", "[]",
        '{"id": "5", "id": "6", "text": "last key wins"}',
        '{"id": null, "text": "x"}',
        '{"text": "no id"}',
        '{"id": 7, "text": null}',
        '{"id": "8", "text": true}',
        '{"id": 9, "title": 1.0, "text": "nul \\u0000 inside", "more": [1]}',
    ]
    raw = jsonl.read_documents(spark, write(tmp_path / "in.jsonl", lines), 4)
    good = [(r.id, r.url, r.title, r.text) for r in
            jsonl.accepted(raw).orderBy("seq").collect()]
    assert good == [
        ("1", "u", "t", "x"), ("6", "", "", "last key wins"), ("", "", "", "x"),
        ("", "", "", "no id"), ("7", "", "", None), ("8", "", "", "true"),
        ("9", "", "1.0", "nul \0 inside")]
    bad = [r.malformed_line for r in jsonl.malformed(raw).orderBy("seq").collect()]
    assert bad == lines[4:16]
    assert {r.run_id for r in raw.select("run_id").collect()} == {4}


def test_order_and_batches(spark, tmp_path):
    lines = [json.dumps({"id": str(n), "text": "x" * 50}) for n in range(1203)]
    path = write(tmp_path / "in.jsonl", lines)
    raw = jsonl.read_documents(spark, path, 1)
    assert [r.id for r in raw.orderBy("seq").collect()] == [str(n) for n in range(1203)]
    sizes = sorted(r["count"] for r in raw.groupBy("ingest_batch_id").count().collect())
    assert sizes == [203, 500, 500]
    again = jsonl.read_documents(spark, path, 1)
    assert raw.select("ingest_batch_id").exceptAll(again.select("ingest_batch_id")).isEmpty()


def test_order_over_many_splits(spark, tmp_path):
    """Rows of one file keep their order when it is read in many pieces."""
    lines = [json.dumps({"id": str(n), "text": "x" * 200}) for n in range(2000)]
    path = write(tmp_path / "in.jsonl", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = jsonl.read_documents(spark, path, 1)
        assert raw.rdd.getNumPartitions() > 5
        assert [r.id for r in raw.orderBy("seq").collect()] == [str(n) for n in range(2000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_write_and_read_back(spark, tmp_path):
    rows = [("1", "u", "t", 'quotes " and \n lines'), ("2", "", "", None), ("3", "", "é", "\0")]
    df = spark.createDataFrame(rows, "id string, url string, title string, text string")
    jsonl.write_documents(df, str(tmp_path / "out"))
    raw = jsonl.accepted(jsonl.read_documents(spark, str(tmp_path / "out"), 1))
    assert sorted((r.id, r.url, r.title, r.text) for r in raw.collect()) == rows


def test_corpus_projection(spark):
    df = spark.createDataFrame([(1, "a", "b", "c", 0)], "k int, u string, n string, body string, z int")
    out = jsonl.normalise_corpus(df, "k", "u", "n", "body")
    assert [tuple(r) for r in out.collect()] == [("1", "a", "b", "c")]
    assert jsonl.normalise_corpus(spark.range(9).selectExpr("id k", "'' u", "'' n", "'' body"),
                                  "k", "u", "n", "body", limit=4).count() == 4
