import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from rows import AWKWARD, empty, table

from corpusloom.llm import prefix_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def random_bytes(rng, size):
    return bytes(rng.choice(b"thereisan ing.,aaa\xc3\xa9") for _ in range(size))


@pytest.mark.parametrize("kind", ["public", "own"])
def test_tables_give_what_merging_leaves(ranks, kind):
    rng = random.Random(5)
    if kind == "own":  # ranks that no training gave; some tokens are never made
        ranks = {bytes([b]): b for b in range(256)}
        for joined in (b"ab", b"bc", b"abc", b"cab", b"aa", b"aaa", b"bca", b"xyz", b"ca"):
            ranks[joined] = len(ranks)
    vocabulary = B.Vocabulary(ranks)
    for _ in range(150):
        data = random_bytes(rng, rng.randint(0, 40)) if kind == "public" else bytes(
            rng.choice(b"abcxyz") for _ in range(rng.randint(0, 14)))
        table = B.PrefixTable(vocabulary, data[:len(data) // 2])
        table.append(data[len(data) // 2:])
        for end in range(len(data) + 1):
            want = [vocabulary.ranks[p] for p in vocabulary.merged(data[:end])]
            assert table.tokens(end) == want


def test_edits_compute_only_what_they_change(ranks):
    vocabulary, rng = B.Vocabulary(ranks), random.Random(6)
    for _ in range(60):
        data = random_bytes(rng, 400)
        table = B.PrefixTable(vocabulary, data)
        start = rng.randint(0, 400)
        end = rng.randint(start, min(400, start + 20))
        new = random_bytes(rng, rng.randint(0, 20))
        computed = table.replace(start, end, new)
        fresh = B.PrefixTable(vocabulary, data[:start] + new + data[end:])
        assert table.data == fresh.data and table.last == fresh.last
        assert computed <= len(new) + 400 - end
    table = B.PrefixTable(vocabulary, b"the cat " * 1000)
    assert table.replace(4, 7, b"dog") < 200


def test_texts_like_the_library(spark, ranks, library):
    encoder = B.PrefixEncoder(ranks, public_tokenizers.PATTERN)
    rows = B.encode_and_decode(table(spark), encoder).collect()
    assert len(rows) == len(AWKWARD)
    want = sorted((repr(k), library.encode_ordinary(t or "")) for k, t in AWKWARD)
    assert sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in rows) == want
    assert sorted(bytes(r.decoded) for r in rows) == sorted((t or "").encode() for _, t in AWKWARD)
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows)
    assert B.encode_and_decode(empty(spark), encoder).count() == 0


def test_bytes_must_be_tokens():
    with pytest.raises(ValueError):
        B.Vocabulary({b"a": 0})
