"""The queries over the smallest tables, against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_backoff_lm import brute
from test_ngram_jaccard import brute as components
from tokenizers import Tokenizer

import corpus_pipeline
from corpusloom.llm import backoff_lm, language_id, merkle, prefix_bpe, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def documents():
    t = pq.read_table(f"{FOLDER}/documents.parquet").to_pydict()
    return sorted(zip(t["doc_id"], t["text"], t["lang"]))


def run(spark, name):
    return queries.QUERIES[name](spark, FOLDER)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, want = run(spark, name).toArrow(), duck.sql(queries.SQL[name]).to_arrow_table()
    names = sorted(got.column_names)
    assert names == sorted(want.column_names)
    rows = [sorted(zip(*(t.column(n).to_pylist() for n in names)), key=repr) for t in (got, want)]
    assert rows[0] == rows[1] and rows[0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def ids(documents):
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {k: found.encode(t or "", add_special_tokens=False).ids for k, t, _ in documents}


def test_op3(spark, documents):
    got = {r.doc_id: r for r in run(spark, "op3_merkle_fingerprints").collect()}
    near = 0
    for (k, text, _), (_, following, _) in zip(documents, documents[1:] + documents[:1]):
        edited = merkle.edited(text, following)
        r = got[k]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.Tree.of(text).fingerprint()
        near += r.near_edited > r.near_next
    assert len(got) == len(documents) and near > 0.95 * len(documents)


def test_op5(spark, ids):
    rows = run(spark, "op5_packing").orderBy("doc_id", "start").collect()
    at = {k: 0 for k in ids}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end == 1024 or end & (end - 1) == 0 and end < 1024
    assert sum(1024 for p in sequences) < 1.1 * sum(r.length for r in rows)
    for r in rows:
        own = ids[r.doc_id] + [0]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own)
        at[r.doc_id] += r.length
        assert r.ids_crc32 == crc(own[r.start:at[r.doc_id]])
    assert at == {k: len(v) + 1 for k, v in ids.items()}


def test_op7(spark, documents):
    rows = [(k, t) for k, t, _ in documents]
    learned = [zlib.crc32(str(k).encode()) % 5 != 1 for k, _ in rows]
    got = {r.doc_id: r for r in run(spark, "op7_backoff_lm").collect()}
    for (k, _), used, want in zip(rows, learned, brute(rows, learned, backoff_lm.ORDER, backoff_lm.PRIOR)):
        r = got[k]
        assert r.held_out != used and (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert (r.base_score, r.score) == pytest.approx(want[3:])


def test_op8(spark, ids):
    at = 0
    for r in run(spark, "op8_token_files").orderBy("doc_id").collect():
        own = ids[r.doc_id] + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(own), crc(own))
        at += len(own)
    assert at == sum(map(len, ids.values())) + len(ids)


def test_op9(spark, documents):
    lang = {k: name for k, _, name in documents}
    rows = run(spark, "op9_language_id").collect()
    assert len(rows) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def trigrams(text):
    shown = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
    return [shown[i - 1:i + 2] for i in range(1, len(shown) - 1) if shown[i] != " "]


def test_op9_against_plain_sets(spark, documents):
    """The same rules with a set for each language in place of filters."""
    lessons = [(t, name) for k, t, name in documents
               if zlib.crc32(str(k).encode()) % 4 != 2 and name is not None and t is not None]
    counts = {}
    for text, name in lessons:
        counts.setdefault(name, Counter()).update(trigrams(text))
    rate = {name: {g: n / own.total() for g, n in own.items()} for name, own in counts.items()}
    learned = {}
    for name, own in counts.items():
        typical = {g: n for g, n in own.items() if rate[name][g] >= language_id.TYPICAL * max(
            r.get(g, 0) for r in rate.values())}
        enough, held, least = language_id.SHARE_LEARNED * sum(typical.values()), 0, 1
        steps = Counter(typical.values())
        kinds = 0
        for n in sorted(steps, reverse=True):
            held, kinds, least = held + n * steps[n], kinds + steps[n], n
            if held >= enough and kinds >= language_id.TRIGRAMS_PER_LANGUAGE:
                break
        learned[name] = {g for g, n in typical.items() if n >= least}
    got = {r.doc_id: r for r in run(spark, "op9_language_id").collect()}
    for k, text, _ in documents:
        own = trigrams(text)
        if not own:
            assert (got[k].lang_pred, got[k].score) == ("und", 0)
            continue
        shares = {name: sum(g in known for g in own) / len(own) for name, known in learned.items()}
        best = max(shares.values())
        assert got[k].score == pytest.approx(best, abs=0.01)
        assert shares[got[k].lang_pred] >= best - 0.01


def test_op10(spark, documents):
    ranks = prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
    got = {r.doc_id: r for r in run(spark, "op10_prefix_bpe").collect()}
    for k, text, _ in documents:
        own = library.encode_ordinary(text)
        assert got[k].n_tokens == len(own)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(own, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_pipeline(spark, documents, ids):
    first = {}
    for k, text, _ in documents:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), k)
    texts = {k: t for k, t, _ in documents}
    near = components([(k, texts[k]) for k in sorted(first.values())])
    stay = {c for *_, c in near}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for (_, stage), kept in zip(corpus_pipeline.STAGES, (set(texts), set(first.values()), stay)):
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r.doc_id for r in docs.collect()} == kept
    rows = corpus_pipeline.STAGES[3][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in rows} == stay
    assert sum(r.length for r in rows) == sum(len(ids[k]) + 1 for k in stay)


def test_documents_without_a_language_go(spark):
    rows = [(1, "The words of the one", "en"), (2, "1234 !!", "en"), (3, None, None)] + [
        (i, "The words of all the others", "en") for i in range(4, 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.known_language(spark, docs, FOLDER)
    assert {r.doc_id for r in kept.collect()} == {1, *range(4, 20)}
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.known_language(spark, none, FOLDER).count() == 17
