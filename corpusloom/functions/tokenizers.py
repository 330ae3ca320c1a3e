"""Tokenizers: what a window is cut from, and how it becomes text again."""

from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions.text import let


WINDOW_TYPE = "array<struct<chunk_index:int,start_tok:int,end_tok:int,chunk_text:string>>"


def window_count(tokens: Column) -> Column:
    """How many windows a document of so many tokens has."""
    extra = F.ceil((tokens - S.CHUNK_TOKENS) / F.lit(S.STRIDE_TOKENS)).cast("int")
    return (
        F.when(tokens < S.MIN_CHUNK_TOKENS, 0)
        .when(tokens <= S.CHUNK_TOKENS, 1)
        .otherwise(1 + extra)
    )


class Tokenizer(Protocol):
    def windows(self, text: Column) -> Column:
        """An array of (chunk_index, start_tok, end_tok, chunk_text) for each text."""


class WordTokenizer:
    """Splits at single spaces; runs entirely in the JVM."""

    def windows(self, text: Column) -> Column:
        def cut(tokens: Column) -> Column:
            def window(i: Column) -> Column:
                start = i * S.STRIDE_TOKENS
                return F.struct(
                    i.alias("chunk_index"),
                    start.alias("start_tok"),
                    F.least(start + S.CHUNK_TOKENS, F.size(tokens)).alias("end_tok"),
                    F.array_join(F.slice(tokens, start + 1, S.CHUNK_TOKENS), " ").alias("chunk_text"),
                )
            n = window_count(F.size(tokens))
            numbers = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
            return F.transform(numbers, window).cast(WINDOW_TYPE)

        return let(F.split(text, " "), cut)
