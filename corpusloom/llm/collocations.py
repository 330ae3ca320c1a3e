"""Phrases whose words keep company, counted in two passes.

A phrase that occurs often enough is found by Misra-Gries summaries: n-grams are dealt by hash over
ranges, and a range with more counters than its occurrences divided by the threshold cannot lose an
n-gram that reaches it. The summaries merge, so each block of texts sends its counts once, packed.
Every block is then told which of its n-grams may be frequent, and counts only those again, now
as phrases. Hashes only choose what is counted; counts and everything after are of the phrases.
"""

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import written
from corpusloom.llm.sorted_keys import pack, pack_numbers, unpack, unpack_numbers

UNDETERMINED = "und"
# What a phrase is, and when it is reported.
LEAST_COUNT = 10
SCALE = 1_000_000
COVERED_PERCENT = 50
MOST = 2000
# Bytes of text of a block, and of all texts for each range of hashes.
BLOCK_BYTES = 6 << 20
RANGE_BYTES = 8 << 20
WORD_LIMIT = 1 << 21
# Bits of a key beyond those that number the bytes of all texts: two n-grams in some thousand share
# a key, whatever the size, and keys stay short on the way.
SPARE_BITS = 10
_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(46 if b in _MARKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = re.compile(rb"[.,;:!?\x0a-\x0d]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_and_breaks(text: bytes) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with ``.`` wherever a piece ends."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


def cut(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about a size, between pieces; a longer piece stays whole."""
    at = 0
    while len(text) - at > size:
        end = _BREAK.search(text, at + size)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _mixed(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    state = (state + word) * _STEP
    return state ^ state >> np.uint64(32)


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    ordered = np.sort(values)
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])
    return ordered[first], np.diff(first, append=len(ordered)).astype(np.int32)


class NGrams:
    """The distinct n-grams of 1 to 3 words of a language's texts in a block, told apart exactly.

    Words are numbered within the block, and an n-gram is its numbers in one: ``codes`` by length,
    ``times`` how often each occurs.
    """

    def __init__(self, lang: str, texts: list[bytes]):
        words = words_and_breaks(b".".join(texts))
        known = defaultdict(count(1).__next__, {b".": 0})  # numbers a word when it first comes
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        del words
        self.lang, self.names, self.n_words = lang, list(known), int((ids > 0).sum())
        self.codes, self.times, self.pairs = [], [], None
        codes, at = ids, np.flatnonzero(ids)
        for n in (1, 2, 3):
            if n > 1:
                at = at[:np.searchsorted(at, len(ids) - n + 1)]
                at = at[ids[at + n - 1] > 0]
                if n == 3 and len(known) >= WORD_LIMIT:  # pairs are numbered anew, to fit 64 bits
                    self.pairs, codes = np.unique(codes, return_inverse=True)
                joined = np.zeros(len(ids), np.int64)
                joined[at] = codes[at] * len(known) + ids[at + n - 1]
                codes = joined
            found, times = _counted(codes[at])
            self.codes.append(found), self.times.append(times)

    def word_numbers(self, n: int, codes: np.ndarray) -> list[np.ndarray]:
        """The numbers of the first to the n-th word of n-grams."""
        found, size = [], len(self.names)
        for k in range(n - 1, 0, -1):
            found.append(codes % size)
            codes = codes // size
            if k == 2 and self.pairs is not None:
                codes = self.pairs[codes]
        return [codes, *found[::-1]]

    def keys(self) -> np.ndarray:
        """A hash of each n-gram and the language, shortest n-grams first."""
        import xxhash

        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names), np.uint64, len(self.names))
        seed, parts = xxhash.xxh3_64_intdigest(self.lang), []
        for n, codes in enumerate(self.codes, 1):
            state = np.full(len(codes), (seed + n) % (1 << 64), np.uint64)
            for numbers in self.word_numbers(n, codes):
                state = _mixed(state, hashes[numbers])
            parts.append(state)
        return np.concatenate(parts)

    def phrases(self, chosen: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The phrases and counts of the n-grams chosen, a flag for each in the order of keys."""
        texts, times, at = [], [], 0
        for n, (codes, counts) in enumerate(zip(self.codes, self.times), 1):
            own = np.flatnonzero(chosen[at:at + len(codes)])
            at += len(codes)
            words = [[self.names[i] for i in numbers.tolist()]
                     for numbers in self.word_numbers(n, codes[own])]
            texts += [b" ".join(parts).decode() for parts in zip(*words)]
            times.append(counts[own])
        return texts, np.concatenate(times).astype(np.int64)


def key_bits(total_bytes: int) -> int:
    return min(64, total_bytes.bit_length() + SPARE_BITS)


def block_grams(langs: list[str], texts: list[bytes]) -> dict[str, NGrams]:
    by_lang = {}
    for lang, text in zip(langs, texts):
        by_lang.setdefault(lang, []).append(text)
    return {lang: NGrams(lang, own) for lang, own in sorted(by_lang.items())}


def _borders(parts: int, bits: int) -> np.ndarray:
    """Where each of the equal ranges of keys begins, but the first."""
    return np.array([(i << bits) // parts for i in range(1, parts)], np.uint64)


def _sorted_keys(grams: dict[str, NGrams], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of all languages, ascending; the order that sorts the n-grams, and where in
    this order each key begins."""
    keys = np.concatenate([g.keys() for g in grams.values()]) >> np.uint64(64 - bits)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], order, first


class Summary:
    """A Misra-Gries summary: at most ``capacity`` counters, and how much each may be too low.

    What is taken off all counters together was taken off more than ``capacity`` of them, so
    ``low`` stays under mass / capacity.
    """

    def __init__(self, capacity: int):
        self.capacity, self.low = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        joined = np.concatenate([self.keys, *keys])
        order = np.argsort(joined, kind="stable")  # which merges ascending runs
        joined, totals = joined[order], np.concatenate([self.counts, *counts])[order]
        first = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]][:len(joined)])
        joined = joined[first]
        totals = np.add.reduceat(totals, first) if len(first) else totals
        if len(joined) > self.capacity:
            taken = np.partition(totals, len(totals) - self.capacity - 1)[len(totals) - self.capacity - 1]
            self.low += int(taken)
            totals -= taken
            joined, totals = joined[totals > 0], totals[totals > 0]
        self.keys, self.counts = joined, totals

    def at_least(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.low >= threshold]


def frequent_keys(rows: list[tuple[bytes, bytes]], mass: int, threshold: int) -> np.ndarray:
    """Ascending keys that may occur ``threshold`` times in rows of packed keys and counts; all
    that do are among them."""
    summary = Summary(mass // threshold + 1)
    keys, counts, held = [], [], 0
    for packed, numbers in rows:
        keys.append(unpack(packed, np.uint64)), counts.append(unpack_numbers(numbers).astype(np.int64))
        held += len(keys[-1])
        if held > summary.capacity:
            summary.add(keys, counts)
            keys, counts, held = [], [], 0
    summary.add(keys, counts)
    return summary.at_least(threshold)


def _first_pass(source: DataFrame, block_bytes: int, ranges: int, bits: int) -> DataFrame:
    """Two kinds of rows by block, written: the texts as they were cut, with their words counted,
    and the block's n-gram counts for each range."""
    borders = _borders(ranges, bits)

    def send(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("text", pa.binary()),
                            ("words", pa.int64()), ("range", pa.int32()), ("keys", pa.binary()),
                            ("counts", pa.binary()), ("mass", pa.int64())])
        block = TaskContext.get().partitionId() << 32

        def sent(langs, texts):
            grams = block_grams(langs, texts)
            keys, order, first = _sorted_keys(grams, bits)
            times = np.concatenate([t for g in grams.values() for t in g.times])[order]
            times = np.add.reduceat(times, first, dtype=np.int64) if len(first) else times
            cuts = np.searchsorted(keys, borders)
            parts = [(n, pack(k), pack_numbers(t), int(t.sum())) for n, (k, t) in enumerate(
                zip(np.split(keys, cuts), np.split(times, cuts))) if len(k)]
            for lang, own in grams.items():
                yield pa.RecordBatch.from_pylist(
                    [{"block": block, "lang": lang, "words": own.n_words}], schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(texts)), pa.array(langs), pa.array(texts, pa.binary()),
                 *(pa.nulls(len(texts), schema.field(n).type) for n in schema.names[3:])], schema=schema)
            for n, k, t, mass in parts:
                yield pa.RecordBatch.from_pylist(
                    [{"block": block, "range": n, "keys": k, "counts": t, "mass": mass}], schema)

        langs, texts, held = [], [], 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in cut(text, block_bytes):
                    langs.append(lang), texts.append(part)
                    held += len(part)
                    if held >= block_bytes:
                        yield from sent(langs, texts)
                        block += 1
                        langs, texts, held = [], [], 0
        if texts:
            yield from sent(langs, texts)

    return written(source.mapInArrow(
        send, "block long, lang string, text binary, words long, range int, keys binary, "
        "counts binary, mass long"), "n-grams")


def _answers(sent: DataFrame, threshold: int) -> DataFrame:
    """(block, range, bits): which of the keys that a block sent to a range may be frequent."""
    masses = sent.groupBy("range").agg(F.sum("mass").alias("all"))

    def answer(table):
        import pyarrow as pa

        packed, counts = table.column("keys").to_pylist(), table.column("counts").to_pylist()
        frequent = frequent_keys(list(zip(packed, counts)), table.column("all")[0].as_py(), threshold)
        bits = []
        for keys in packed:
            keys = unpack(keys, np.uint64)
            at = np.minimum(np.searchsorted(frequent, keys), max(0, len(frequent) - 1))
            is_in = frequent[at] == keys if len(frequent) else np.zeros(len(keys), bool)
            bits.append(np.packbits(is_in).tobytes() if is_in.any() else None)
        kept = [n for n, b in enumerate(bits) if b is not None]
        return pa.table({
            "block": table.column("block").take(pa.array(kept, pa.int64())),
            "range": table.column("range").take(pa.array(kept, pa.int64())),
            "bits": pa.array([zlib.compress(bits[n], 1) for n in kept], pa.binary())})

    return sent.join(masses, "range").select("block", "range", "keys", "counts", "all").groupBy(
        "range").applyInArrow(answer, "block long, range int, bits binary")


def frequent_phrases(df: DataFrame, text: str, lang: str, threshold: int, block_bytes: int,
                     range_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of 1 to 3 words that occur ``threshold`` times, and
    (lang, words)."""
    source = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNDETERMINED)).alias("lang"),
                       F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "utf-8").alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 + total // range_bytes
    bits = key_bits(total)
    borders = _borders(ranges, bits)
    rows = _first_pass(source, block_bytes, ranges, bits)
    answers = _answers(rows.filter("range IS NOT NULL").select(
        "block", "range", "keys", "counts", "mass"), threshold)
    texts = rows.filter("text IS NOT NULL").select("block", "lang", "text")

    def recount(table, answers):
        import pyarrow as pa

        order = np.argsort(table.column("lang").to_numpy(zero_copy_only=False), kind="stable")
        table = table.take(pa.array(order))
        grams = block_grams(table.column("lang").to_pylist(), table.column("text").to_pylist())
        langs, phrases, times = [], [], [np.empty(0, np.int64)]
        if grams:
            keys, order, first = _sorted_keys(grams, bits)
            cuts = [0, *np.searchsorted(keys, borders).tolist(), len(keys)]
            frequent = np.zeros(len(keys), bool)
            for n, data in zip(answers.column("range").to_pylist(), answers.column("bits").to_pylist()):
                own = np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8))
                frequent[cuts[n]:cuts[n + 1]] = own[:cuts[n + 1] - cuts[n]]
            chosen = np.zeros(len(order), bool)
            chosen[order] = np.repeat(frequent, np.diff(first, append=len(order)))
            at = 0
            for lang, own in grams.items():
                size = sum(map(len, own.codes))
                found, counts = own.phrases(chosen[at:at + size])
                at += size
                phrases += found
                times.append(counts)
                langs += [lang] * len(found)
        return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()),
                         "n": pa.array(np.concatenate(times))})

    counted = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        recount, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= threshold)
    words = rows.filter("words IS NOT NULL").groupBy("lang").agg(F.sum("words").alias("words"))
    return written(counted, "phrases"), words


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exact below 10^14 occurrences."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(14,0)")

    return F.call_function("div", wide(a) * wide(a) * F.lit(SCALE).cast("decimal(7,0)"),
                           wide(left) * wide(right))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", threshold: int = LEAST_COUNT,
                 most: int | None = MOST, block_bytes: int = BLOCK_BYTES,
                 range_bytes: int = RANGE_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language.

    Candidates have 2 or 3 words and occur ``threshold`` times or more; ``a`` counts all
    occurrences within pieces, overlapping ones too. Cut in two, ``l`` and ``r`` count the parts;
    the cut with the lowest score counts, of equal ones the first. A candidate inside a longer one
    that occurs at least half as often is dropped. ``n`` counts the words of the language. Order:
    score, a (both falling), phrase in byte order; ``most`` None reports all.

    A null language is ``und``, a null text empty. Texts are cut between pieces, so a long text is
    read in bounded parts; only a piece must fit a block. Repeated rows count each. An empty table
    gives no rows. Other columns are not looked at, whatever their names.
    """
    counted, totals = frequent_phrases(df, text, lang, threshold, block_bytes, range_bytes)
    words = F.split("phrase", " ")
    candidates = counted.withColumn("words", words).filter(F.size("words") > 1)
    cuts = candidates.select("lang", "phrase", F.col("n").alias("a"), F.size("words").alias("length"),
                             "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "a", "k", F.inline(F.array(
        F.struct(F.lit("l").alias("side"), F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("part")),
        F.struct(F.lit("r").alias("side"), F.array_join(F.slice(
            "words", F.col("k") + 1, F.col("length") - F.col("k")), " ").alias("part")))))
    parts = counted.select("lang", F.col("phrase").alias("part"), "n")
    met = sides.join(parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(*[
        F.max(F.when(F.col("side") == s, F.col("n"))).alias(s) for s in "lr"])
    best = met.withColumn("score", score(F.col("a"), F.col("l"), F.col("r"))).groupBy(
        "lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = cuts.filter("length = 3").select("lang", "a", F.array_join(F.slice(
        "words", F.col("k"), F.lit(2)), " ").alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("within"))
    kept = best.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("within") < COVERED_PERCENT * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "cut.*").withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    # As many rows as there are languages.
    return ranked.join(totals.withColumnRenamed("words", "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
        F.col("score").cast("long").alias("score"))
