from itertools import product

import numpy as np
import public_tokenizers
import pytest
from rows import AWKWARD, empty, table
from tokenizers import Tokenizer

from corpusloom.llm import token_files as F
from corpusloom.llm import tokens
from corpusloom.llm.queries import piece_encoder
from corpusloom.sources import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", " a", "a ", "a  b", "a\n b", "a \nb", "\x1c a \x1d b", "don't 's 1234 <|endoftext|> x",
       "\u3000 a \xa0b", "a" * 3000, " " * 300 + "b", "e\u0301 g\u0303 \u200b x", "\n\n a\n\n\n b \t c",
       "ab'll,'s (x) %% 'S", "x.\ny.\n\nz! 3rd ½ ² Ⅷ"]


def whole(**settings):
    found = Tokenizer.from_file(PATH)
    for name, value in settings.items():
        setattr(found, name, value)
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def library():
    return whole()


@pytest.mark.parametrize("plain", [False, True])
def test_pieces_are_encoded_like_whole_texts(plain):
    encoder = tokens.PieceEncoder(tokens.read_file(PATH), plain_specials=plain, held=6)
    wanted = whole(encode_special_tokens=plain)
    special = ["<|endoftext|>", "hello <|endoftext|> there", "<|endoftext|><|endoftext|>a \n<|endoftext|> ",
               "<|endoftext| <|endoftext|>.x"]
    for text in 2 * (ODD + special + [t for _, t in AWKWARD]):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == wanted(text)
    assert (50256 in wanted(special[0])) != plain


def test_white_space_between_words(library):
    encoder = tokens.PieceEncoder(tokens.read_file(PATH))
    for letters in ("a \n\t", "b. \n\xa0"):
        for text in map("".join, (c for n in range(7) for c in product(letters, repeat=n))):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text), repr(text)


def test_words_beside_line_breaks_and_marks_are_merged_once(library):
    words = ["Inwh", "thonea", "erlytion", "ándshti", "nted"]
    encoder = tokens.PieceEncoder(tokens.read_file(PATH))
    encoder.encode("")
    merged = []
    for table in (encoder.first, encoder.later):
        table.merges = lambda text, merges=table.merges: merged.append(text) or merges(text)
    for a, b in product(words, repeat=2):
        text = f"{a} {b}.\n{b} {a},\n\n{a} {b}.\n{a}"
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library(text)
    assert len(merged) == len(set(merged)) == 2 * len(words)
    assert not any("\n" in piece for piece in encoder.later)


@pytest.mark.parametrize("vocabulary", [50_257, 1 << 20])
def test_files(spark, library, vocabulary):
    out = scratch.new_folder(spark, "test-files")
    index = F.write_token_files(table(spark), out, piece_encoder(spark, PATH), end_id=2,
                                vocabulary=vocabulary)
    read = F.read_token_files(spark, out)
    rows = index.join(read, ["part", "row"]).orderBy("start").collect()
    assert len(rows) == len(AWKWARD)
    assert [r.doc_id for r in rows] == sorted((k for k, _ in AWKWARD), key=lambda k: (k is not None, k))
    assert [r.key for r in rows] == [r.doc_id for r in rows]
    assert [r.start for r in rows] == [sum(q.n_tokens for q in rows[:i]) for i in range(len(rows))]
    want = [(k, np.array(library(t) + [2], "<u4").tobytes()) for k, t in AWKWARD]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in rows), key=repr) == sorted(want, key=repr)


def test_many_parts_have_bases(spark, monkeypatch, library):
    monkeypatch.setattr(F, "RANGE_BYTES", 200)
    out = scratch.new_folder(spark, "test-files")
    texts = [(i, f"text {i} " * 5) for i in range(40)]
    index = F.write_token_files(table(spark, texts), out, piece_encoder(spark, PATH))
    assert index.select("part").distinct().count() > 4
    rows = index.join(F.read_token_files(spark, out), ["part", "row"]).orderBy("doc_id").collect()
    at = 0
    for r, (_, text) in zip(rows, texts):
        assert r.start == at and r.n_tokens == len(library(text)) + 1
        at += r.n_tokens


def test_empty_table(spark):
    out = scratch.new_folder(spark, "test-files")
    index = F.write_token_files(empty(spark), out, piece_encoder(spark, PATH))
    assert index.count() == 0 and F.read_token_files(spark, out).groupBy().sum("n_tokens").first()[0] is None
