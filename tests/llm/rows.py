"""Small tables with the awkward cases that every operator must take."""

from pyspark.sql import types as T

LONG = "Ein sehr langer Text, " * 3000
# (doc_id, text): null key, null text, empty, blank, ties, repeated rows, one word, one long text.
AWKWARD = [
    (3, "Hello there, my old friend from far away."), (1, "Hello  there,\tmy old friend from far away."),
    (1, "Hello there, my old friend from far away."), (2, None), (4, ""), (5, " \n\t "), (6, "word"),
    (7, LONG), (7, LONG), (None, "Hello there, my old friend from far away."), (None, None),
    (8, "é 日本語 \u00a0\u2028 <|endoftext|> 'tis\r\n\r\nnaïve  \x1c end"), (8, "12 !! ?? 34"),
]
# Names that the operators use for their own columns.
CLASHING = ["key", "node", "score", "lang_pred", "ids", "block", "digest", "salt", "kept", "part", "size",
            "judged", "found", "own_node", "row", "root", "gram", "tie"]


def table(spark, rows=AWKWARD, extra=True):
    schema = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType())
    for name in CLASHING if extra else ():
        schema.add(name, T.StringType())
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHING) if extra else [])) for r in rows], schema)


def empty(spark):
    return table(spark, [])
