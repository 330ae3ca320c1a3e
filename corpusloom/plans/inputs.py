"""Builds over the plain Parquet tables: raw rows, an update batch and the versions they give."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.encoders import HashingEncoder, embed_chunks, encode_column
from corpusloom.operators import chunking, merge, validate
from corpusloom.sources.scratch import written

REVISED = " Revised in a later delivery."
CORRECTED = " Corrected once more."
DIM = 64


def seq(part: int, n: Column | str) -> Column:
    return F.struct(F.lit(part).alias("part"), X.col(n).cast("bigint").alias("n")).alias("seq")


@dataclass(frozen=True)
class Inputs:
    """Three runs over the tables of one folder: the documents, the same again, an update.

    The update delivers every labelled document again (as it was, revised, emptied or with
    a lone NUL, by its two labels; revised ones a second time with a correction), every page
    as a new document, and every conversation turn, which has no document id.
    """

    spark: SparkSession
    folder: str

    @cached_property
    def _open(self) -> dict[str, DataFrame]:
        return {}

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._open[name]

    @cached_property
    def base(self) -> DataFrame:
        return self.table("documents").select(
            F.col("doc_id").cast("string").alias("id"),
            F.concat(F.lit("doc://"), "source", F.lit("/"), "doc_id").alias("url"),
            F.concat_ws(" ", "source", "lang", "doc_id").alias("title"),
            "text", seq(0, "doc_id"))

    @cached_property
    def delta(self) -> DataFrame:
        labels = self.table("labels").select(
            F.col("doc_id").cast("string").alias("id"), "quality", "toxic")
        again = self.base.join(labels, "id")
        good, toxic = F.col("quality") == 1, F.col("toxic") == 1

        def delivery(part: int, text: Column) -> Column:
            return F.struct(text.alias("text"), seq(part, "seq.n"))

        revised = [delivery(0, F.concat("text", F.lit(REVISED))),
                   delivery(1, F.concat("text", F.lit(CORRECTED)))]
        other = F.when(~toxic, F.col("text")).when(good, F.lit(X.NUL)).otherwise("")
        deliveries = F.when(~toxic & ~good, F.array(*revised)).otherwise(
            F.array(delivery(0, other)))
        shape = ["id", "url", "title", "text", "seq"]
        redelivered = again.select("id", "url", "title", F.inline(deliveries))
        pages = self.table("pages").select(
            F.concat(F.lit("page-"), "page_id").alias("id"), "url", F.col("url").alias("title"),
            F.col("html").alias("text"), seq(2, "page_id"))
        turns = self.table("conversations").select(
            F.lit("").alias("id"), F.lit("").alias("url"), F.col("role").alias("title"), "text",
            seq(3, F.col("conv_id") * 1_000_000 + F.col("turn")))
        return redelivered.select(shape).unionByName(pages).unionByName(turns)

    @cached_property
    def noisy(self) -> DataFrame:
        """Every document wrapped in one of the whitespace code points, some of them emptied;
        every conversation turn under an id of whitespace."""
        spaces = F.array(*[F.lit(chr(p)) for p in X.SPACE_POINTS])

        def space(n: Column) -> Column:
            return F.element_at(spaces, (n % len(X.SPACE_POINTS)).cast("int") + 1)

        labels = self.table("labels").select(
            F.col("doc_id").cast("string").alias("id"), "quality", "toxic")
        ws = space(F.col("seq.n"))
        text = (
            F.when((F.col("toxic") == 1) & (F.col("quality") == 0), F.concat(ws, ws, F.lit(" ")))
            .when(F.col("toxic") == 1, F.concat(F.lit(X.NUL), ws, F.lit(X.NUL)))
            .otherwise(F.concat(ws, "text", ws, F.lit(" "), ws, F.lit("e" + X.NUL + "nd "), ws))
        )
        shape = ["id", "url", "title", "text", "seq"]
        documents = self.base.join(labels, "id", "left").withColumn("text", text).select(shape)
        turn = F.col("conv_id") * 1_000_000 + F.col("turn")
        turns = self.table("conversations").select(
            space(turn).alias("id"), F.lit(None).cast("string").alias("url"),
            F.col("role").alias("title"), "text", seq(3, turn))
        return documents.unionByName(turns)

    @cached_property
    def base_valid(self) -> DataFrame:
        return validate.valid_documents(self.base)

    @cached_property
    def delta_valid(self) -> DataFrame:
        return validate.valid_documents(self.delta)

    @cached_property
    def first_versions(self) -> DataFrame:
        """Versions of run 1: nothing was stored before, and document ids are unique."""
        return self.base_valid.drop("seq").withColumn("source_run_id", F.lit(1))

    @cached_property
    def statuses(self) -> DataFrame:
        """What run 3 decides about each document of the update."""
        current = self.first_versions.select("doc_id", "content_hash", "source_run_id")
        return merge.classify(merge.batch_keys(self.delta_valid), current)

    @cached_property
    def decided(self) -> DataFrame:
        """The statuses as a written table, as a build keeps them.

        They are narrow, and everything about versions refers to them several times.
        """
        return written(self.statuses, "statuses")

    @cached_property
    def closures(self) -> DataFrame:
        return merge.new_closures(self.decided, 3)

    @cached_property
    def last_versions(self) -> DataFrame:
        return merge.new_versions(self.delta_valid, self.decided, 3)

    @cached_property
    def versions(self) -> DataFrame:
        return self.first_versions.unionByName(self.last_versions)

    @cached_property
    def documents(self) -> DataFrame:
        return merge.with_validity(self.versions, self.closures)

    @cached_property
    def chunks(self) -> DataFrame:
        return chunking.chunk_documents(self.versions)

    @cached_property
    def corpus_chunks(self) -> DataFrame:
        """Chunks of the documents table alone."""
        return chunking.chunk_documents(self.first_versions)

    @cached_property
    def corpus_vectors(self) -> DataFrame:
        return embed_chunks(self.corpus_chunks, HashingEncoder(DIM))

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").cast("string").alias("id"), "embedding", "label")

    def questions(self, encoder: HashingEncoder, prefix: str) -> DataFrame:
        """Every benchmark text as a query."""
        texts = self.table("benchmark").select(F.col("item_id").alias("query_id"), "text")
        return encode_column(texts, "text", encoder, prefix).select("query_id", "embedding")
