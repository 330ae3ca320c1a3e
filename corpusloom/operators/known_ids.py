"""A sketch of all document ids that were ever stored.

It is a Bloom filter of 64-bit words kept as rows (word, bits): an id sets a few bits of one word.
Sketches of runs merge by OR. An id whose bits are not all set was never stored; of the others a few
were not either, so they are looked up in their key buckets.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import settings as S
from corpusloom.functions import text as X

WORD_BITS = 64
BITS_SET = 4


def word_count(n_ids: int) -> int:
    """Words for so many ids: a power of two."""
    wanted = max(S.MIN_SKETCH_WORDS, n_ids * S.SKETCH_BITS_PER_ID // WORD_BITS)
    return 1 << (wanted - 1).bit_length()


def place(doc_id: Column | str, n_words: int) -> tuple[Column, Column]:
    """(word, mask) of an id; the bits come from parts of a second hash."""
    first, second = F.xxhash64(X.col(doc_id)), F.xxhash64(X.col(doc_id), F.lit(1))
    mask = None
    for n in range(BITS_SET):
        at = F.pmod(F.shiftright(second, 6 * n), F.lit(WORD_BITS)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), at)
        mask = one if mask is None else mask.bitwiseOR(one)
    return F.pmod(first, F.lit(n_words)).alias("word"), mask.alias("bits")


def sketch(ids: DataFrame, n_words: int) -> DataFrame:
    """(word, bits) of the ids in ``doc_id``, combined before they are sent."""
    return merged(ids.select(*place("doc_id", n_words)))


def merged(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def with_chance(rows: DataFrame, sketches: DataFrame, n_words: int) -> DataFrame:
    """Rows with ``doc_id`` and, added, ``may_be_known``: false only for ids that were never stored.

    Null ids are not known. The rows move by word, which spreads a hot id no further than itself:
    give each id once.
    """
    word, mask = place("doc_id", n_words)
    probed = rows.withColumn("sketch_word", word).withColumn("sketch_mask", mask)
    held = merged(sketches).select(F.col("word").alias("sketch_word"), F.col("bits").alias("sketch_bits"))
    hit = F.coalesce(F.col("sketch_bits").bitwiseAND(F.col("sketch_mask")) == F.col("sketch_mask"), F.lit(False))
    return probed.join(held, "sketch_word", "left").select(
        *rows.columns, (hit & F.col("doc_id").isNotNull()).alias("may_be_known"))
