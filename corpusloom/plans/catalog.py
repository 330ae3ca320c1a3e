"""Every operator as a query over the tables of a folder."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import schemas
from corpusloom import settings as S
from corpusloom.functions import text as X
from corpusloom.functions import vectors as V
from corpusloom.functions.encoders import HashingEncoder, embed_chunks, embedding_hash
from corpusloom.operators import (
    chunking, evaluation, index_store, ivf, merge, quality, sampling, search, two_level, validate)
from corpusloom.plans.build import Build, chunk_checksums, preview, states_and_recounts
from corpusloom.plans.build import audit_runs as stored_audit
from corpusloom.plans.inputs import DIM, REVISED, Inputs
from corpusloom.plans.retrieve import evaluate_retrieval, retrieve
from corpusloom.sources import jsonl, scratch
from corpusloom.sources.scratch import written
from corpusloom.sources.warehouse import Warehouse
from corpusloom.streaming.incremental import run_available

TOP_K = 5
# Cells by label mean are few, so fewer than the default are probed.
LABEL_NPROBE = 3
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(body: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    _QUERIES[body.__name__] = body
    return body


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(body):
        return lambda spark, folder: body(Inputs(spark, folder))
    return {name: bind(body) for name, body in _QUERIES.items()}


def rounded(c: Column | str) -> Column:
    return F.round(X.col(c), 6)


# --- sources and sinks

@query
def ingest_jsonl_roundtrip(i: Inputs) -> DataFrame:
    path = scratch.held_folder(i.spark, "jsonl") + "/rows"
    jsonl.write_documents(i.base, path)
    raw = jsonl.accepted(jsonl.read_documents(i.spark, path, 1))
    return raw.select("run_id", "id", "url", "title", "text")


@query
def malformed_lines(i: Inputs) -> DataFrame:
    """Whole lines, blank ones and every kind of fault side by side; only the faults come back."""
    whole = i.base.select(F.to_json(F.struct("id", "url", "title", "text")).alias("value"))
    faults = [('{"id": "', '", "text": "'), ('[{"id": "', '"}]'), ('"', '"'), ("{'id': '", "'}"),
              ('{"id": "', '"} {"id": "x"}'), ("", "")]
    faulty = i.table("labels").select(F.explode(F.array(*[
        F.concat(F.lit(before), "doc_id", F.lit(after)) for before, after in faults])).alias("value"))
    blank = i.table("pages").select(F.explode(F.array(F.lit("  \t"), F.lit("\xa0 "))).alias("value"))
    path = scratch.held_folder(i.spark, "lines") + "/rows"
    quality.union_all([whole, faulty, blank]).write.text(path)
    return jsonl.malformed(jsonl.read_documents(i.spark, path, 1)).select("malformed_line")


@query
def ingest_batches(i: Inputs) -> DataFrame:
    at = F.struct(F.lit("documents").alias("file"), F.lit(0).cast("bigint").alias("block"),
                  F.col("seq.n").alias("row"))
    raw = jsonl.raw_rows(i.base.withColumn("seq", at), 1)
    return raw.groupBy("run_id", "ingest_batch_id").agg(
        F.count("*").alias("n_rows"), F.min("seq.row").alias("first_row"),
        F.max("seq.row").alias("last_row"))


def _lines_with_faults(i: Inputs) -> DataFrame:
    """The documents as a stored raw table, read from JSON lines in several files, a malformed line
    before every third document."""
    whole = F.to_json(F.struct("id", "url", "title", "text"))
    lines = F.when(F.col("seq.n") % 3 == 0, F.array(F.lit("{"), whole)).otherwise(F.array(whole))
    path = scratch.held_folder(i.spark, "lines") + "/rows"
    ordered = i.base.repartitionByRange(7, "seq.n").sortWithinPartitions("seq.n")
    ordered.select(F.explode(lines).alias("value")).write.text(path)
    return written(jsonl.read_documents(i.spark, path, 1), "raw")


@query
def numbered_batches(i: Inputs) -> DataFrame:
    """Batches of accepted rows by their numbers over all files and splits."""
    rows = jsonl.numbered(_lines_with_faults(i))
    return rows.groupBy(jsonl.numbered_batch(1).alias("ingest_batch_id")).agg(
        F.count("*").alias("n_rows"), F.min("number").alias("first_number"),
        F.min(F.col("id").cast("long")).alias("first_id"), F.max(F.col("id").cast("long")).alias("last_id"))


@query
def first_documents(i: Inputs) -> DataFrame:
    """The first documents in input order, by number."""
    rows = jsonl.numbered(_lines_with_faults(i))
    return rows.filter(F.col("number") < 25).select("number", "id", "title")


@query
def corpus_normalise(i: Inputs) -> DataFrame:
    documents = jsonl.normalise_corpus(i.table("documents"), "doc_id", "source", "lang", "text")
    pages = jsonl.normalise_corpus(i.table("pages"), "page_id", "url", "url", "html")
    return documents.unionByName(pages)


@query
def run_scan(i: Inputs) -> DataFrame:
    """The raw rows of one run out of a table partitioned by run."""
    path = scratch.held_folder(i.spark, "raw") + "/rows"
    runs = quality.union_all([i.base.withColumn("run_id", F.lit(1)),
                              i.delta.withColumn("run_id", F.lit(3))])
    runs.drop("seq").write.partitionBy("run_id").parquet(path)
    stored = i.spark.read.schema("id string, url string, title string, text string, run_id int")
    return stored.parquet(path).filter(F.col("run_id") == 3)


@query
def table_overview(i: Inputs) -> DataFrame:
    return quality.table_overview({name: i.table(name) for name in TABLES})


# --- validation

@query
def clean_valid(i: Inputs) -> DataFrame:
    return validate.valid_documents(i.noisy).drop("seq")


@query
def clean_rejects(i: Inputs) -> DataFrame:
    return validate.rejected_documents(i.noisy, 1)


@query
def clean_reject_counts(i: Inputs) -> DataFrame:
    return validate.rejected_documents(i.noisy, 1).groupBy("reason_code", "reason_detail").agg(
        F.count("*").alias("n_rows"))


@query
def embedding_input_text(i: Inputs) -> DataFrame:
    return i.base_valid.select(
        "doc_id", F.concat(F.lit(S.PASSAGE_PREFIX),
                           X.embedding_text("title", "cleaned_text")).alias("passage"))


@query
def display_preview(i: Inputs) -> DataFrame:
    """The twenty longest documents, as a report shows them."""
    return i.base_valid.orderBy(F.desc("text_len"), "doc_id").limit(20).select(
        "doc_id", "title", "text_len", F.left("content_hash", F.lit(12)).alias("hash_head"),
        X.preview("cleaned_text", 60).alias("text_head"))


# --- samples and update batches

@query
def delta_batch(i: Inputs) -> DataFrame:
    return i.delta.select("id", "url", "title", "text", F.col("seq.part").alias("part"),
                          F.col("seq.n").alias("n"))


@query
def delta_preview(i: Inputs) -> DataFrame:
    return sampling.batch_preview(i.delta, i.base)


@query
def sample_documents(i: Inputs) -> DataFrame:
    rows = sampling.usable(i.base)
    n = sampling.sample_size(rows.count())
    return sampling.seeded_sample(rows, n).select("id", "url", "title", "text")


@query
def sample_split(i: Inputs) -> DataFrame:
    """Sizes of a sample and of what it leaves."""
    usable = sampling.usable(i.base)
    sample = sampling.seeded_sample(usable, sampling.SAMPLE_SIZE)
    return quality.count_row({"n_usable": usable, "n_sample": sample,
                              "n_rest": sampling.complement(usable, sample)})


@query
def update_batch(i: Inputs) -> DataFrame:
    usable = sampling.usable(i.base)
    return sampling.update_batch(usable, sampling.seeded_sample(usable, sampling.SAMPLE_SIZE))


# --- versioned merge

@query
def scd_dedup_batch(i: Inputs) -> DataFrame:
    return merge.batch_keys(i.delta_valid).select(
        "doc_id", F.col("seq.part").alias("part"), F.col("seq.n").alias("n"), "content_hash",
        "copies")


@query
def scd_classify(i: Inputs) -> DataFrame:
    return i.statuses.select("doc_id", "content_hash", "status", "closed_valid_from")


@query
def scd_status_counts(i: Inputs) -> DataFrame:
    return merge.status_counts(i.statuses)


@query
def changed_documents(i: Inputs) -> DataFrame:
    return i.last_versions.select("doc_id", "title", "content_hash", "text_len", "source_run_id")


@query
def scd_documents(i: Inputs) -> DataFrame:
    return i.documents.drop("cleaned_text")


@query
def active_documents(i: Inputs) -> DataFrame:
    return merge.active(i.versions, i.closures)


@query
def scd_chunks(i: Inputs) -> DataFrame:
    return merge.with_validity(i.chunks.drop("chunk_text", "content_hash"), i.closures)


@query
def scd_embeddings(i: Inputs) -> DataFrame:
    """Embeddings carry their document, so they expire through the same join."""
    vectors = embed_chunks(i.chunks, HashingEncoder(DIM)).select(
        "chunk_id", "doc_id", "embedding_dim", "source_run_id")
    return merge.with_validity(vectors, i.closures).drop("doc_id")


@query
def scd_history(i: Inputs) -> DataFrame:
    return merge.version_history(
        i.documents.select("doc_id", "content_hash", "source_run_id", "is_active",
                           "valid_to_run_id"), i.chunks)


@query
def idempotent_rerun(i: Inputs) -> DataFrame:
    """The documents once more: nothing is new or updated."""
    current = i.first_versions.select("doc_id", "content_hash", "source_run_id")
    return merge.status_counts(merge.classify(merge.batch_keys(i.base_valid), current))


# --- chunks

@query
def chunk_windows(i: Inputs) -> DataFrame:
    return i.corpus_chunks


@query
def chunk_stats(i: Inputs) -> DataFrame:
    return i.corpus_chunks.groupBy("chunk_index").agg(
        F.count("*").alias("n_chunks"), F.sum("chunk_token_len").alias("n_tokens"),
        F.min("chunk_token_len").alias("min_tokens"), F.max("chunk_token_len").alias("max_tokens"))


@query
def docs_without_chunks(i: Inputs) -> DataFrame:
    return chunking.documents_without_chunks(i.first_versions)


@query
def unembedded_chunks(i: Inputs) -> DataFrame:
    """Chunks left to encode when the first chunk of each document with a stored vector is done."""
    done = (
        i.corpus_chunks.filter("chunk_index = 0")
        .join(i.vectors.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"))
    return chunking.unembedded(i.corpus_chunks, done).select("chunk_id", "doc_id", "chunk_index")


# --- as-of views, checks and reports

@query
def asof_chunks(i: Inputs) -> DataFrame:
    rows = merge.with_validity(
        i.chunks.select("chunk_id", "doc_id", "chunk_hash", "source_run_id"), i.closures)
    return merge.as_of_runs(rows, [1, 2, 3]).select("run_id", "chunk_id", "chunk_hash")


@query
def asof_checksum(i: Inputs) -> DataFrame:
    return chunk_checksums(i.chunks, i.closures, [1, 2, 3])


@query
def ordered_checksum(i: Inputs) -> DataFrame:
    return quality.ordered_checksum(i.corpus_chunks, "chunk_hash")


# Warehouses of three runs by application, folder and state of the files read.
_SCENARIOS: dict[tuple, Warehouse] = {}
_READ_BY_SCENARIO = ("documents", "labels", "pages", "conversations")


def _file_state(df: DataFrame) -> tuple:
    """What changes when the files of a table do: their number, and sums over names, sizes, times."""
    files = df.select("_metadata.file_path", "_metadata.file_size",
                      F.unix_micros("_metadata.file_modification_time").alias("at")).distinct()
    return tuple(files.agg(F.count("*"), F.sum("file_size"), F.max("at"),
                           F.bit_xor(F.xxhash64("file_path", "file_size", "at"))).first())


def _scenario(i: Inputs) -> Warehouse:
    """The warehouse of the three runs; a session builds it once for each state of the tables."""
    key = (i.spark.sparkContext.applicationId, i.folder,
           *[_file_state(i.table(name)) for name in _READ_BY_SCENARIO])
    if key not in _SCENARIOS:
        _SCENARIOS[key] = _three_runs(i)
    return _SCENARIOS[key]


def build_shared(spark: SparkSession, folder: str) -> None:
    """Build the warehouse that queries over three runs share, if it is not there yet."""
    _scenario(Inputs(spark, folder))


@query
def run_summary(i: Inputs) -> DataFrame:
    return _scenario(i).run_history().select(
        "run_id", "mode", "dataset_name", "input_path", "status", *schemas.RUN_COUNTS)


@query
def previous_full_run(i: Inputs) -> DataFrame:
    here = {"dataset_name": "tables", "input_path": "documents", "run_id": 2}
    return quality.previous_full_run(_scenario(i).runs(), here).select("run_id", "active_doc_count")


def _audited(i: Inputs, pairs: list[tuple[int, int]]) -> DataFrame:
    w = _scenario(i)
    return quality.union_all([stored_audit(w, *pair) for pair in pairs]).select(
        "run_id_a", "run_id_b", "audit_type", "result", "details")


@query
def audit_runs(i: Inputs) -> DataFrame:
    """The same input twice, then before and after the update, then a run there is not."""
    return _audited(i, [(1, 2), (2, 3), (3, 9)])


@query
def audit_tally(i: Inputs) -> DataFrame:
    return quality.audit_tally(_audited(i, [(1, 2), (2, 3)]))


def _reconciled(i: Inputs, embeddings: DataFrame, registry: DataFrame) -> DataFrame:
    w = _scenario(i)
    closures = w.read("closures")
    return quality.reconcile(
        jsonl.accepted(w.read_run("raw_documents", 3)),
        merge.active(w.read("clean_documents"), closures), w.read_run("rejected_documents", 3),
        merge.active(w.read("chunks"), closures), merge.active(embeddings, closures), registry, 3)


@query
def reconciliation(i: Inputs) -> DataFrame:
    """Counted again from the tables that three runs left."""
    w = _scenario(i)
    return _reconciled(i, w.read("embeddings"), w.read("index_registry"))


@query
def reconciliation_stored(i: Inputs) -> DataFrame:
    """As the third run wrote it."""
    return _scenario(i).read("row_count_reconciliation").filter("run_id = 3")


@query
def reconciliation_faults(i: Inputs) -> DataFrame:
    """The vectors of the update are missing, and the newest index is that of the first run."""
    w = _scenario(i)
    return _reconciled(i, w.read("embeddings").filter("source_run_id = 1"),
                       w.read("index_registry").filter("run_id = 1"))


@query
def snapshot_classify(i: Inputs) -> DataFrame:
    """What the third run decided, against the buckets of current keys that its batch touched."""
    return _scenario(i).read_run("document_status", 3).select(
        "doc_id", "content_hash", "status", "closed_valid_from")


@query
def snapshot_keys(i: Inputs) -> DataFrame:
    """The current keys after three runs, from the newest generation of each bucket."""
    return _scenario(i).current_keys().select(
        "doc_id", "content_hash", "source_run_id", "n_chunks", "n_embeddings")


@query
def sketch_preview(i: Inputs) -> DataFrame:
    """The update once more, and pages under unseen ids, against the warehouse of three runs."""
    unseen = i.table("pages").select(
        F.concat(F.lit("unseen-"), "page_id").alias("id"), F.col("url").alias("title"),
        F.col("html").alias("text"))
    return preview(_scenario(i), i.delta.select("id", "title", "text").unionByName(unseen))


@query
def state_additive(i: Inputs) -> DataFrame:
    """The totals that each run kept by difference, and whether a full recount agrees."""
    return states_and_recounts(_scenario(i))


@query
def index_registry(i: Inputs) -> DataFrame:
    """One build per run; the newest is the active one."""
    return quality.newest_index(_scenario(i).read("index_registry")).select(
        "run_id", "dataset_name", "index_type", "metric", "nlist", "nprobe", "num_vectors",
        "build_mode", "is_active")


@query
def stage_log(i: Inputs) -> DataFrame:
    """What the stages of the three runs logged, but for their times."""
    return _scenario(i).read("latency_logs").select("run_id", "stage_name", "row_count", "details")


class _FailingBuild(Build):
    def _count_active(self) -> None:
        raise RuntimeError("stopped after the index stage")


@query
def failed_run_scenario(i: Inputs) -> DataFrame:
    """A run, an update that fails after its index is written, and the update again: the rows of
    each run that readers see."""
    w = Warehouse(i.spark, scratch.held_folder(i.spark, "failed"))
    encoder = HashingEncoder(DIM)
    _build(w, "full", "documents", i.base, encoder)
    try:
        _build(w, "augmented", "update", i.delta, encoder, _FailingBuild)
    except RuntimeError:
        pass
    _build(w, "augmented", "update", i.delta, encoder)
    tables = {"clean_documents": "source_run_id", "chunks": "source_run_id",
              "embeddings": "source_run_id", "index_registry": "run_id", "latency_logs": "run_id"}
    seen = quality.union_all([
        w.read(name).groupBy(F.col(column).alias("run_id")).agg(F.count("*").alias("n"))
        .withColumn("name", F.lit(name)) for name, column in tables.items()])
    counts = seen.groupBy("run_id").agg(*[
        F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables])
    return w.runs().select("run_id", "mode", "status").join(counts, "run_id", "left").select(
        "run_id", "mode", "status", *[F.coalesce(name, F.lit(0)).alias(name) for name in tables])


@query
def rows_per_run(i: Inputs) -> DataFrame:
    runs = [i.base.select(F.lit(1).alias("run_id")), i.base.select(F.lit(2).alias("run_id")),
            i.delta.select(F.lit(3).alias("run_id"))]
    return quality.union_all(runs).groupBy("run_id").agg(F.count("*").alias("n_rows"))


@query
def versions_by_activity(i: Inputs) -> DataFrame:
    return quality.activity(i.documents.select("doc_id", "is_active"), distinct=True)


@query
def chunks_by_activity(i: Inputs) -> DataFrame:
    keys = i.chunks.select("doc_id", "source_run_id")
    return quality.activity(merge.with_validity(keys, i.closures), distinct=False)


@query
def active_vs_total(i: Inputs) -> DataFrame:
    keys = i.chunks.select("doc_id", "source_run_id")
    return quality.active_and_total({
        "clean_documents": i.documents.select("is_active"),
        "chunks": merge.with_validity(keys, i.closures).select("is_active")})


@query
def input_counts(i: Inputs) -> DataFrame:
    def lines(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("n_lines"), F.countDistinct("id").alias("n_ids"))
    return quality.union_all([lines(i.base).withColumn("input", F.lit("base")),
                              lines(i.delta).withColumn("input", F.lit("delta"))])


def _latency(i: Inputs) -> DataFrame:
    """Events read as a stage log: a user is a run, an event one stage of it."""
    return i.table("events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("stage_name"),
        F.col("ts").alias("start_time"), F.col("value").alias("duration_seconds"))


@query
def latency_by_run(i: Inputs) -> DataFrame:
    runs = quality.seconds_per_run(_latency(i))
    return runs.select("run_id", "n_stages", F.round("total_seconds", 3).alias("total_seconds"))


@query
def latest_run_latency(i: Inputs) -> DataFrame:
    """Stages of the newest run that did not end in an error."""
    log = _latency(i)
    ended = log.groupBy("run_id").agg(F.max_by("stage_name", "start_time").alias("last"))
    runs = ended.select("run_id", F.when(F.col("last") == "error", "failed")
                        .otherwise("success").alias("status"))
    return quality.latest_run_latency(runs, log)


# --- vectors

def _cells(i: Inputs, df: DataFrame) -> DataFrame:
    """Vector elements as rows."""
    return df.select("id", F.posexplode("embedding").alias("pos", "x")).select(
        "id", "pos", rounded(F.col("x").cast("double")).alias("x"))


@query
def vector_normalise(i: Inputs) -> DataFrame:
    longer = i.vectors.select("id", F.transform(
        "embedding", lambda x: (x * (F.col("label") + 1)).cast("float")).alias("v"))
    return _cells(i, longer.select("id", V.l2_normalise("v").alias("embedding")))


@query
def feature_hash_embed(i: Inputs) -> DataFrame:
    vectors = i.corpus_vectors.select(F.col("chunk_id").alias("id"), "embedding")
    return _cells(i, vectors).filter("x <> 0")


@query
def vector_hashes(i: Inputs) -> DataFrame:
    return i.vectors.select("id", embedding_hash("embedding").alias("embedding_hash"))


@query
def embedding_gather(i: Inputs) -> DataFrame:
    """Active vectors out of two runs: a revised document's vector comes from the later one."""
    first = i.vectors.select(F.col("id").alias("doc_id"), "embedding",
                             F.lit(1).alias("source_run_id"))
    later = first.join(i.last_versions.select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.reverse("embedding").alias("embedding"), F.lit(3).alias("source_run_id"))
    stored = merge.active(first.unionByName(later), i.closures)
    return stored.select(
        "doc_id", "source_run_id", rounded(F.col("embedding")[0].cast("double")).alias("first_x"),
        rounded(V.dot("embedding", "embedding")).alias("norm"))


def _asked(i: Inputs) -> DataFrame:
    """Every fiftieth vector; it is searched among all."""
    return i.vectors.filter(F.col("id").cast("bigint") % 50 == 0).select(
        F.col("id").alias("query_id"), "embedding")


def _shown(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "id", "rank", "score")


def _exact_others(i: Inputs) -> DataFrame:
    return search.without_self(search.exact_topk(_asked(i), i.vectors, TOP_K + 1), TOP_K)


@query
def knn_exact(i: Inputs) -> DataFrame:
    """The nearest other vectors of each vector asked for."""
    return _shown(_exact_others(i))


def _label_index(i: Inputs) -> tuple[DataFrame, ivf.Centroids]:
    numbers = i.vectors.select("label").distinct().withColumn(
        "first", F.dense_rank().over(Window.orderBy("label")) - 1)
    centroids = ivf.Centroids.from_df(ivf.mean_centroids(i.vectors.join(numbers, "label"), "first"))
    return ivf.assign(i.vectors, centroids), centroids


@query
def ivf_assign(i: Inputs) -> DataFrame:
    return _label_index(i)[0].select("id", "cell")


@query
def ivf_cell_sizes(i: Inputs) -> DataFrame:
    return ivf.cell_sizes(_label_index(i)[0])


@query
def ivf_centroid_update(i: Inputs) -> DataFrame:
    """One k-means step: assign to the label means, then average each cell."""
    moved = ivf.mean_centroids(_label_index(i)[0], "cell")
    return moved.select("cell", F.posexplode("centroid").alias("pos", "x")).select(
        "cell", "pos", rounded("x").alias("x"))


def _ivf_others(i: Inputs) -> DataFrame:
    index, centroids = _label_index(i)
    found = search.ivf_topk(_asked(i), index, centroids, TOP_K + 1, LABEL_NPROBE)
    return search.without_self(found, TOP_K)


@query
def ivf_search(i: Inputs) -> DataFrame:
    return _shown(_ivf_others(i))


def _trained(i: Inputs) -> tuple[DataFrame, ivf.Centroids]:
    centroids = ivf.train(i.vectors, ivf.cell_count(i.vectors.count()))
    return ivf.assign(i.vectors, centroids), centroids


@query
def ivf_train_assign(i: Inputs) -> DataFrame:
    """Whether the cell of each vector is that of the nearest trained centroid, by distances to all."""
    index, centroids = _trained(i)
    return ivf.is_nearest(index, centroids).select("id", "is_nearest")


@query
def ivf_trained_cells(i: Inputs) -> DataFrame:
    """Whether each trained centroid has unit length."""
    cells = _trained(i)[1].to_df(i.spark)
    return cells.select("cell", (F.abs(V.l2_norm("centroid") - 1) < 1e-5).alias("is_unit"))


@query
def ivf_full_probe(i: Inputs) -> DataFrame:
    """A trained index with every cell probed answers like exact search."""
    index, centroids = _trained(i)
    found = search.ivf_topk(_asked(i), index, centroids, TOP_K + 1, centroids.nlist)
    return _shown(search.without_self(found, TOP_K))


def measured_recall(i: Inputs, nprobe: int | None = None) -> DataFrame:
    """(n_true, n_found, recall, nprobe) of the trained index against exact search.

    Without ``nprobe`` the number of probes is chosen on other vectors than those asked for.
    """
    index, centroids = _trained(i)
    index, truth = written(index, "index"), written(_exact_others(i), "truth")
    if nprobe is None:
        others = index.join(_asked(i).select(F.col("query_id").alias("id")), "id", "left_anti")
        nprobe = search.probes_for(
            search.measured_curve(index, centroids, others), S.AIMED_RECALL)
    found = search.without_self(
        search.ivf_topk(_asked(i), index, centroids, TOP_K + 1, nprobe), TOP_K)
    return evaluation.recall(found, truth).withColumn("nprobe", F.lit(nprobe))


@query
def ivf_recall(i: Inputs) -> DataFrame:
    """Neighbours to find, and whether the index finds enough of them with the probes chosen."""
    return measured_recall(i).select(
        "n_true", (F.col("recall") >= S.LEAST_RECALL).alias("is_enough"))


@query
def ivf_measured_recall(i: Inputs) -> DataFrame:
    """How many of them it finds, and with how many probes; SQL has no trained cells."""
    return measured_recall(i)


@query
def knn_certified(i: Inputs) -> DataFrame:
    """Exact neighbours from cells by label, those left out that cannot hold one."""
    index, centroids = _label_index(i)
    found = search.certified_topk(_asked(i), written(index, "index"), centroids, TOP_K + 1,
                                  LABEL_NPROBE)
    return _shown(search.without_self(found.hits, TOP_K))


@query
def certified_cells(i: Inputs) -> DataFrame:
    """How many cells exact search reads for each query over trained cells."""
    index, centroids = _trained(i)
    return search.certified_topk(_asked(i), written(index, "index"), centroids, TOP_K + 1).cells


# Groups and fine cells of each, in the queries over two levels.
COARSE, FINE = 10, 12


def _two_levels(i: Inputs) -> tuple[DataFrame, two_level.TwoLevel]:
    vectors = written(i.vectors.select("id", "embedding"), "vectors")
    cells = two_level.train(vectors, COARSE, FINE)
    return written(two_level.assign(vectors, cells), "index"), cells


@query
def two_level_assign(i: Inputs) -> DataFrame:
    """Whether the cell of each vector is the nearest of its group, by distances to all of them."""
    index, cells = _two_levels(i)
    group = F.floor(F.col("cell") / FINE).cast("int")
    away = V.dot(V.difference("embedding", "centroid"), V.difference("embedding", "centroid"))
    met = index.withColumn("coarse", group).join(cells.fine, "coarse").withColumn("away", away)
    own = F.min(F.when(F.col("fine") == F.col("cell") % FINE, F.col("away")))
    return met.groupBy("id").agg((own <= F.min("away") + 1e-6).alias("is_nearest"))


@query
def two_level_full_probe(i: Inputs) -> DataFrame:
    """Two levels with every cell probed answer like exact search."""
    index, cells = _two_levels(i)
    found = two_level.topk(_asked(i), index, cells, TOP_K + 1, COARSE, COARSE * FINE)
    return _shown(search.without_self(found, TOP_K))


@query
def two_level_recall(i: Inputs) -> DataFrame:
    """What a third of the groups and a third of the cells find; SQL has no trained cells."""
    index, cells = _two_levels(i)
    found = two_level.topk(_asked(i), index, cells, TOP_K + 1, COARSE // 3 + 1, COARSE * FINE // 3)
    truth = written(_exact_others(i), "truth")
    return evaluation.recall(search.without_self(found, TOP_K), truth).withColumn(
        "n_cells", F.lit(index.select("cell").distinct().count()))


@query
def index_roundtrip(i: Inputs) -> DataFrame:
    """An index written by cell and read back."""
    index, centroids = _label_index(i)
    root = scratch.held_folder(i.spark, "index")
    named = index.select(F.col("id").alias("chunk_id"), "embedding", "cell",
                         embedding_hash("embedding").alias("embedding_hash"))
    index_store.write_index(named, centroids, f"{root}/vectors", f"{root}/centroids")
    stored = index_store.read_index(i.spark, f"{root}/vectors")
    return stored.select("chunk_id", "cell", "embedding_hash",
                         rounded(V.dot("embedding", "embedding")).alias("norm"))


@query
def index_checksum(i: Inputs) -> DataFrame:
    index = _label_index(i)[0].select(
        F.col("id").alias("chunk_id"), "cell", embedding_hash("embedding").alias("embedding_hash"))
    return index_store.index_checksum(index)


# --- retrieval

@query
def retrieve_exact(i: Inputs) -> DataFrame:
    """Every benchmark text against all chunks of all documents, with the texts found.

    Documents are cut and encoded once, however many blocks of questions there are.
    """
    chunks = written(i.corpus_chunks, "chunks")
    corpus = written(embed_chunks(chunks, HashingEncoder(DIM)).select(
        F.col("chunk_id").alias("id"), "embedding"), "vectors")
    blocks = search.block_hits(i.questions(HashingEncoder(DIM), S.QUERY_PREFIX), corpus, TOP_K)
    return search.in_one((search.hydrate(hits, chunks, i.first_versions)
                          for hits in blocks), "retrieved")


@query
def retrieve_indexed(i: Inputs) -> DataFrame:
    """The same through a warehouse: built, indexed, published, all cells probed."""
    w = Warehouse(i.spark, scratch.held_folder(i.spark, "retrieve"))
    _build(w, "full", "documents", i.base, HashingEncoder(DIM))
    questions = i.table("benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    return retrieve(w, questions, TOP_K, nprobe=S.MAX_CELLS, encoder=HashingEncoder(DIM))


def _build(w: Warehouse, mode: str, input_path: str, rows: DataFrame, encoder, kind=Build) -> int:
    at = F.struct(F.col("seq.part").cast("string").alias("file"),
                  F.lit(0).cast("bigint").alias("block"), F.col("seq.n").alias("row"))
    source = rows.withColumn("seq", at)
    return kind(w, mode, "tables", input_path, encoder=encoder).run(
        lambda run_id: jsonl.raw_rows(source, run_id))


def _three_runs(i: Inputs) -> Warehouse:
    """The documents, the same again, then the update, through one warehouse."""
    w = Warehouse(i.spark, scratch.held_folder(i.spark, "scenario"))
    encoder = HashingEncoder(DIM)
    _build(w, "full", "documents", i.base, encoder)
    _build(w, "full", "documents", i.base, encoder)
    _build(w, "augmented", "update", i.delta, encoder)
    return w


@query
def three_run_scenario(i: Inputs) -> DataFrame:
    return _three_runs(i).runs().select("run_id", "mode", "dataset_name", "input_path", "status",
                                        *schemas.RUN_COUNTS)


@query
def streamed_updates(i: Inputs) -> DataFrame:
    """The documents, and the same with a sentence added to the labelled ones, merged as they
    arrive in as many files as Spark writes."""
    root = scratch.held_folder(i.spark, "stream")
    w = Warehouse(i.spark, f"{root}/warehouse")
    labelled = i.table("labels").select(F.col("doc_id").cast("string").alias("id")).distinct()
    again = i.base.join(labelled.withColumn("labelled", F.lit(True)), "id", "left").withColumn(
        "text", F.when(F.col("labelled"), F.concat("text", F.lit(REVISED))).otherwise(F.col("text")))
    for n, rows in enumerate((i.base, again)):
        jsonl.write_documents(rows, f"{root}/inbox/{n}", compressed=True)
        run_available(w, "tables", f"{root}/inbox/*", f"{root}/checkpoint", encoder=HashingEncoder(DIM))
    return w.run_history().select("run_id", "mode", "status", "raw_doc_count", "new_doc_count",
                                  "updated_doc_count", "unchanged_doc_count", "active_doc_count")


# --- evaluation

def _evaluated(i: Inputs) -> DataFrame:
    """Exact nearest neighbours as expectation, index hits as retrieval."""
    best = _exact_others(i).filter("rank = 1")
    expected = best.select("query_id", F.concat(F.lit("vector "), "query_id").alias("query_text"),
                           F.col("id").alias("expected_doc_id"))
    hits = _ivf_others(i).select("query_id", F.col("id").alias("retrieved_doc_id"), "rank")
    return evaluation.evaluate(hits, expected, TOP_K, 1)


@query
def retrieval_eval(i: Inputs) -> DataFrame:
    return _evaluated(i).withColumn("reciprocal_rank", rounded("reciprocal_rank"))


@query
def retrieval_metrics(i: Inputs) -> DataFrame:
    m = evaluation.metrics(_evaluated(i))
    return m.select("n_queries", rounded("hit_rate").alias("hit_rate"), rounded("mrr").alias("mrr"))


@query
def retrieval_eval_stored(i: Inputs) -> DataFrame:
    """Benchmark texts asked of a built warehouse, expected to find the document that holds their
    exact best hit; as the warehouse kept it."""
    w = Warehouse(i.spark, scratch.held_folder(i.spark, "evaluate"))
    encoder = HashingEncoder(DIM)
    _build(w, "full", "documents", i.base, encoder)
    corpus = w.read("embeddings").select(F.col("chunk_id").alias("id"), "embedding")
    best = search.exact_topk(i.questions(encoder, S.QUERY_PREFIX), corpus, 1)
    owners = w.read("chunks").select(F.col("chunk_id").alias("id"), F.col("doc_id").alias("expected_doc_id"))
    expected = best.join(owners, "id").join(i.table("benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")), "query_id")
    evaluate_retrieval(w, expected, TOP_K, nprobe=S.MAX_CELLS, encoder=encoder)
    return w.read("retrieval_eval").select(
        "query_id", "query_text", "expected_doc_id", "retrieved_doc_id", "rank", "hit_at_k",
        rounded("reciprocal_rank").alias("reciprocal_rank"))
