"""Languages by bit-sliced Bloom filters of letter trigrams.

A filter slot holds one bit per language, so that one look-up of a trigram, an AND over a few
slots, gives all languages whose typical trigrams contain it. A text belongs to the language
with the largest share of its trigrams, after the share that a filter answers by chance is taken
off. Trigrams are counted over all training rows and every language is learned: there is one filter
for each block of languages, with slots for the typical trigrams that make up most of its texts.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import fresh, written

UNDETERMINED = "und"
# Slots of a filter: this many for each trigram of its largest language, 2^SLOT_BITS at least.
SLOTS_PER_TRIGRAM = 16
SLOT_BITS = 18
# The most frequent typical trigrams of a language are learned until they are this share of its
# typical occurrences, and so many of them at least; equally frequent ones stay together.
SHARE_LEARNED = 0.9
TRIGRAMS_PER_LANGUAGE = 3000
# A trigram is typical of a language where it is at least this part as frequent as in any other.
TYPICAL = 0.2
# Languages of a filter: one word of bits.
LANGUAGES_PER_FILTER = 64
# Shares (of texts, for languages) that are held at a time.
SHARES_HELD = 1 << 22
SEGMENT = 1 << 20
# Odd factors that spread a trigram over the slots.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def letter_table() -> np.ndarray:
    """Per code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str | None], letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(number of the text, trigram) arrays, in segments of bounded size.

    Texts are lower-cased and all but letters becomes a gap; each letter gives the trigram
    around it. Long texts are cut between trigrams, so that none is lost.
    """
    ids, held = [], []

    def flush():
        # The first and last of each segment are neighbours only.
        codes = np.concatenate(held).astype(np.uint64)
        own = np.concatenate([np.r_[False, np.ones(len(h) - 2, bool), False] for h in held])
        number = np.repeat(np.array(ids), [len(h) for h in held])
        at = np.flatnonzero(own & (codes > 0))
        ids.clear(), held.clear()
        return number[at], codes[at - 1] << np.uint64(42) | codes[at] << np.uint64(21) | codes[at + 1]

    size = 0
    for number, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        codes = np.pad(np.where(letters[codes], codes, 0), 1)
        for start in range(0, len(codes) - 2, SEGMENT):
            piece = codes[start:start + SEGMENT + 2]
            ids.append(number), held.append(piece)
            size += len(piece)
            if size >= SEGMENT:
                yield flush()
                size = 0
    if held:
        yield flush()


@dataclass
class Filter:
    """One bit per language in each slot; ``chance`` is the false-positive rate of each."""

    languages: list[str]
    slots: np.ndarray
    chance: np.ndarray

    @property
    def slot_bits(self) -> int:
        return len(self.slots).bit_length() - 1

    @classmethod
    def of(cls, grams: dict[str, np.ndarray], languages: list[str]) -> "Filter":
        kind = np.uint8 if len(languages) <= 8 else np.uint64
        width = 8 * np.dtype(kind).itemsize
        most = max((len(grams[n]) for n in languages), default=0)
        slot_bits = max(SLOT_BITS, (SLOTS_PER_TRIGRAM * most - 1).bit_length() if most else 0)
        slots = np.zeros((1 << slot_bits, -(-len(languages) // width) or 1), kind)
        for n, language in enumerate(languages):
            for at in cls.places(grams[language], slot_bits):
                slots[at, n // width] |= kind(1 << n % width)
        bits = [(slots[:, n // width] >> kind(n % width) & kind(1)).mean()
                for n in range(len(languages))]
        return cls(languages, slots, np.array(bits) ** len(FACTORS))

    @staticmethod
    def places(grams: np.ndarray, slot_bits: int) -> list[np.ndarray]:
        return [(grams * np.uint64(f) >> np.uint64(64 - slot_bits)).astype(np.int64) for f in FACTORS]

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """Per trigram the languages that contain it, as words of bits."""
        first, *others = self.places(grams, self.slot_bits)
        found = self.slots[first]
        for at in others:
            found &= self.slots[at]
        return found

    def add_hits(self, number: np.ndarray, grams: np.ndarray, hits: np.ndarray) -> None:
        """Count the trigrams of each text that each language contains."""
        width, kind = 8 * self.slots.itemsize, self.slots.dtype.type
        masks = self.masks(grams)
        present = np.bitwise_or.reduce(masks, axis=0)
        for n in range(len(self.languages)):
            if present[n // width] >> kind(n % width) & kind(1):
                bits = masks[:, n // width] >> kind(n % width) & kind(1)
                hits[:, n] += np.bincount(number, bits, len(hits))


@dataclass
class Model:
    """Filters of blocks of languages, those with most training rows first."""

    filters: list[Filter]

    @property
    def languages(self) -> list[str]:
        return [name for f in self.filters for name in f.languages]

    def best(self, texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(trigrams, number of the best language, its corrected share) of each text."""
        step = max(1, SHARES_HELD // max(1, len(self.languages)))
        parts = [self._best(texts[at:at + step], letters) for at in range(0, len(texts), step)]
        return tuple(map(np.concatenate, zip(*parts))) if parts else (np.zeros(0),) * 3

    def _best(self, texts, letters):
        total = np.zeros(len(texts))
        hits = [np.zeros((len(texts), len(f.languages))) for f in self.filters]
        for number, grams in trigrams(texts, letters):
            total += np.bincount(number, minlength=len(texts))
            for f, own in zip(self.filters, hits):
                f.add_hits(number, grams, own)
        chance = np.concatenate([f.chance for f in self.filters])
        share = np.hstack(hits) / np.maximum(total, 1)[:, None]
        share = np.clip((share - chance) / (1 - chance), 0, 1)
        best = share.argmax(axis=1)
        return total, best, share[np.arange(len(texts)), best]


def fit(rows: DataFrame, text: str = "text", lang: str = "lang",
        per_language: int = TRIGRAMS_PER_LANGUAGE, typical: float = TYPICAL,
        learned: float = SHARE_LEARNED) -> Model:
    """The filters of the most frequent typical trigrams of each language, over all rows.

    Rows with null text or language teach nothing; repeated rows teach each time, and a long text
    is read whole, in bounded segments. Without any row no language is known. Other columns are not
    looked at.
    """
    source = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(
        "lang IS NOT NULL AND text IS NOT NULL")

    def count(batches) -> Iterator:
        import pyarrow as pa

        letters = letter_table()
        for batch in batches:
            names = batch.column(0).to_pylist()
            known = sorted(set(names))
            number_of = np.array([known.index(n) for n in names])
            for number, grams in trigrams(batch.column(1).to_pylist(), letters):
                language = number_of[number]
                for n in np.unique(language):
                    found, times = np.unique(grams[language == n], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([known[n]] * len(found)), pa.array(found.astype(np.int64)),
                         pa.array(times)], ["lang", "gram", "n"])

    counts = source.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    counts = written(counts, "trigram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("all"))
    rate = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("all"))
    highest = rate.withColumn("highest", F.max("rate").over(Window.partitionBy("gram")))
    counts = highest.filter(F.col("rate") >= typical * F.col("highest")).select("lang", "gram", "n")
    counts = written(counts, "trigrams")
    # How often the last trigram occurs that is learned: a table of frequencies is short.
    steps = counts.groupBy("lang", "n").agg(F.count("*").alias("grams"))
    falling = Window.partitionBy("lang").orderBy(F.col("n").desc())
    whole = Window.partitionBy("lang")
    steps = steps.withColumn("all", F.sum(F.col("n") * F.col("grams")).over(whole))
    steps = steps.withColumn("held", F.sum(F.col("n") * F.col("grams")).over(falling)).withColumn(
        "kinds", F.sum("grams").over(falling))
    enough = (F.col("held") >= learned * F.col("all")) & (F.col("kinds") >= per_language)
    least = steps.groupBy("lang").agg(
        F.coalesce(F.max(F.when(enough, F.col("n"))), F.min("n")).alias("least"))
    best = counts.join(F.broadcast(least), "lang").filter("n >= least").select("lang", "gram")
    order = [r.lang for r in source.groupBy("lang").count().orderBy(F.col("count").desc(), "lang")
             .collect()]
    if not order:
        return Model([])
    best = written(best, "learned-trigrams")
    filters = []
    for start in range(0, len(order), LANGUAGES_PER_FILTER):
        names = order[start:start + LANGUAGES_PER_FILTER]
        # Of one block of languages at a time, two numbers a trigram.
        at = F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int")
        rows = best.filter(F.col("lang").isin(names)).select(at.alias("at"), "gram").toArrow()
        number, gram = rows.column("at").to_numpy(), rows.column("gram").to_numpy().view(np.uint64)
        filters.append(Filter.of({name: gram[number == n] for n, name in enumerate(names, 1)}, names))
    return Model(filters)


def prediction(rows: DataFrame, model: Model, text: Column) -> Column:
    """A struct of ``lang_pred`` and ``score`` for the rows of a table; see ``identify``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:

        letters, model = letter_table(), shared.value
        known = model.languages
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if known:
                total, best, share = model.best(texts, letters)
                for i in np.flatnonzero(total):
                    names[i], scores[i] = known[best[i]], float(share[i])
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return predict(text)


def identify(rows: DataFrame, model: Model, text: Column) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``, the share of trigrams in that language.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no
    language is known. Of languages with equal shares the one with more training rows is taken.
    Repeated rows are judged each; a long text is read whole, in bounded segments. Columns of these
    two names are replaced; all others stay, whatever their names.
    """
    found, = fresh(rows, "found")
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() not in ("lang_pred", "score")]
    return rows.select(*kept, prediction(rows, model, text).alias(found)).select(
        *kept, F.col(f"{found}.lang_pred"), F.col(f"{found}.score"))
