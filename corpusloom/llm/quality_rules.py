"""Quality rules whose thresholds follow each language and source.

Every text is measured once. The measures of a group (language and source) go into quantile
sketches: counts of values rounded to seven leading bits, which merge by adding and never depend on
the order of rows. A group's quartiles, read from its sketch, set its fences; small groups borrow
the merged sketch of their language, or of all. Texts are then joined with the fences.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import written

# The rules that hold for all texts, and the symbols counted.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW_WORDS = 3
SYMBOLS = "#*$%&|<>"
SPACES = "\x20\t\n\x0b\x0c\r"
# Fences lie so many interquartile ranges beyond the quartiles.
REACH = 6
# Groups with fewer sound texts borrow the fences of the next larger one.
LEAST_TEXTS = 100
SKETCH_BITS = 8
WORD_LIMIT = 1 << 21


@dataclass(frozen=True)
class Rule:
    """A measure in thousandths; a range between quartiles is taken as ``spread`` at least, so that
    a group whose texts hardly differ still allows for the variety of sound text."""

    name: str
    top: str
    bottom: str
    spread: int
    both_sides: bool = False


RULES = (
    Rule("word_length", "word_chars", "n_words", 250, both_sides=True),
    Rule("symbols", "n_symbols", "n_words", 15),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 50),
    Rule("repeated_words", "n_repeat_words", "n_words", 30),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words within windows of three that occur twice or more."""
    n = len(words)
    if n <= WINDOW_WORDS:
        return 0
    known = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    codes = ids[:-2] * len(known) + ids[1:-1]
    if len(known) >= WORD_LIMIT:  # pairs are numbered anew, to fit 64 bits
        codes = np.unique(codes, return_inverse=True)[1]
    _, place, counts = np.unique(codes * len(known) + ids[2:], return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(n, bool)
    for k in range(WINDOW_WORDS):
        covered[k:k + len(again)] |= again
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    """The measures of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


def measured(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """key, lang, source and the measures of each text, written."""
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").cast("string").alias("lang"),
                     F.col(f"`{source}`").cast("string").alias("source"), F.col(f"`{text}`").alias("text"))

    def read(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [measure(t.as_py() or "") for t in batch.column(3)]
            columns = zip(*found) if found else [[] for _ in MEASURES]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *(pa.array(c, pa.int64()) for c in columns)],
                ["key", "lang", "source", *MEASURES])

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, lang string, source string, " + ", ".join(f"{m} long" for m in MEASURES)
    return written(rows.mapInArrow(read, schema), "measures")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def thousandths(rule: Rule) -> Column:
    return F.call_function("div", 1000 * F.col(rule.top), F.col(rule.bottom))


def sketch_value(value: str) -> Column:
    """The value with its leading bits kept and the others zero: less by under one in 128."""
    return F.expr(f"shiftleft(shiftright({value}, greatest(0, length(bin({value})) - {SKETCH_BITS})), "
                  f"greatest(0, length(bin({value})) - {SKETCH_BITS}))")


def sketches(sound: DataFrame) -> DataFrame:
    """lang, source, rule, value, n: the sketch of each rule's measure in each group."""
    values = F.array(*[F.struct(F.lit(r.name).alias("rule"), thousandths(r).alias("exact"))
                       for r in RULES])
    rows = sound.select("lang", "source", F.inline(values))
    return rows.groupBy("lang", "source", "rule", sketch_value("exact").alias("value")).agg(
        F.count("*").alias("n"))


def fences(sketch: DataFrame, group: list[str]) -> DataFrame:
    """group, texts, and low and high of every rule, from the sketches merged over each group."""
    merged = sketch.groupBy(*group, "rule", "value").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*group, "rule")
    counted = merged.withColumn("below", F.sum("n").over(whole.orderBy("value"))).withColumn(
        "texts", F.sum("n").over(whole))

    def quantile(percent: int) -> Column:
        return F.min(F.when(100 * F.col("below") >= percent * F.col("texts"), F.col("value")))

    quartiles = counted.groupBy(*group, "rule").agg(
        F.max("texts").alias("texts"), quantile(25).alias("q1"), quantile(75).alias("q3"))
    columns = []
    for rule in RULES:
        reach = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(rule.spread))
        own = F.col("rule") == rule.name
        columns += [F.max(F.when(own, F.col("q1") - reach)).alias(f"{rule.name}_low"),
                    F.max(F.when(own, F.col("q3") + reach)).alias(f"{rule.name}_high")]
    return quartiles.groupBy(*group).agg(F.max("texts").alias("texts"), *columns)


def thresholds(sound: DataFrame, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """lang, source and the fences that hold there, written; a row per group of sound texts."""
    sketch = written(sketches(sound), "sketches")
    limits = [f"{r.name}_{side}" for r in RULES for side in ("low", "high")]
    own = fences(sketch, ["lang", "source"])
    wider = [fences(sketch, ["lang"]), fences(sketch.withColumn("every", F.lit(1)), ["every"])]
    by_lang, by_all = (w.toDF(*[f"{c}_{n}" for c in w.columns]) for n, w in enumerate(wider))
    met = own.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_0")), "left").join(
        by_all, F.col("texts") <= F.col("texts_1"))  # one row, that of all texts
    return written(met.select("lang", "source", *[
        F.when(F.col("texts") >= least_texts, F.col(c))
        .when(F.col("texts_0") >= least_texts, F.col(f"{c}_0"))
        .otherwise(F.col(f"{c}_1")).alias(c) for c in limits]), "fences")


def quality_rules(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                  source: str = "source", least_texts: int = LEAST_TEXTS) -> DataFrame:
    """One row per input row: key, lang, source, the measures, base_failed, broken, kept.

    ``broken`` lists the rules whose fences a text is beyond; kept texts broke none and did not fail
    the base rules. Only texts that pass the base rules set fences. Null texts are empty, and fail.
    Null languages and sources are groups of their own. Repeated rows count each, rows with equal
    or null keys too; ties cannot arise. A long text is measured whole, by one task. An empty table
    gives no rows. Other columns are not looked at, whatever their names.
    """
    rows = measured(df, key, text, lang, source).withColumn("base_failed", base_failed())
    limits = thresholds(rows.filter("NOT base_failed"), least_texts)
    limits = limits.withColumnsRenamed({"lang": "own_lang", "source": "own_source"})
    # One row for each group: sent to all tasks where Spark finds the table small, else sorted by
    # group, where adaptive execution splits a hot one.
    met = rows.join(limits, F.col("lang").eqNullSafe(F.col("own_lang"))
                    & F.col("source").eqNullSafe(F.col("own_source")), "left")
    broken = []
    for rule in RULES:
        value = thousandths(rule)
        beyond = value > F.col(f"{rule.name}_high")
        if rule.both_sides:
            beyond |= value < F.col(f"{rule.name}_low")
        broken.append(F.when(~F.col("base_failed") & beyond, F.lit(rule.name)))
    met = met.withColumn("broken", F.array_compact(F.array(*broken)))
    return met.select(F.col("key").alias(key), F.col("lang"), F.col("source"), *MEASURES, "base_failed",
                      "broken", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"))
