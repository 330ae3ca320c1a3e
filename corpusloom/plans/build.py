"""A build: from input rows to a published run."""

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import schemas
from corpusloom import settings as S
from corpusloom.functions import text as X
from corpusloom.functions.encoders import Encoder, HashingEncoder, embed_chunks
from corpusloom.functions.tokenizers import Tokenizer, WordTokenizer
from corpusloom.operators import (
    chunking, current, index_store, ivf, known_ids, merge, quality, sampling, validate)
from corpusloom.sources import jsonl, scratch
from corpusloom.sources.scratch import written
from corpusloom.sources.warehouse import Warehouse, small_frame

AUGMENTED_NOTE = "index rebuilt from all active vectors; only new and updated documents embedded"

Source = Callable[[int], DataFrame]


@dataclass
class Build:
    """One run over one warehouse; ``mode`` is metadata, except that only a full run audits."""

    warehouse: Warehouse
    mode: str
    dataset_name: str
    input_path: str
    tokenizer: Tokenizer = field(default_factory=WordTokenizer)
    encoder: Encoder = field(default_factory=HashingEncoder)
    note: str | None = None
    max_cells: int = S.MAX_CELLS
    # Hash buckets of the current keys of a new corpus; by its size where None.
    key_buckets: int | None = None

    def __post_init__(self):
        if self.mode not in ("full", "augmented"):
            raise ValueError("mode is 'full' or 'augmented'")
        self.counts: dict[str, int] = dict.fromkeys(schemas.RUN_COUNTS, 0)

    def run(self, source: Source | None = None) -> int:
        """Run all stages and return the run id. On an error the run is marked failed."""
        w = self.warehouse
        self.run_id, self.started = w.next_run_id(), _now()
        self.latency: list[tuple] = []
        self._record("running", None, None)
        try:
            with w.as_of_now():
                self._stages(source or self._read_input)
        except Exception as error:
            self._record("failed", _now(), str(error))
            raise
        note = self.note or (AUGMENTED_NOTE if self.mode == "augmented" else None)
        self._record("success", _now(), note)
        return self.run_id

    def _read_input(self, run_id: int) -> DataFrame:
        return jsonl.read_documents(self.warehouse.spark, self.input_path, run_id)

    def _stages(self, source: Source) -> None:
        self._stage("ingest", self._ingest, source)
        self._stage("clean", self._clean)
        self._stage("curate", self._curate)
        self._stage("chunk", self._chunk)
        self._stage("embed", self._embed)
        self._stage("index", self._index)
        self._count_active()
        self._reconcile()
        if self.mode == "full":
            self._audit()

    def _stage(self, name: str, body, *args) -> None:
        start = _now()
        rows, details = body(*args)
        end = _now()
        self.latency.append(
            (self.run_id, name, start, end, (end - start).total_seconds(), rows,
             json.dumps(details, separators=(",", ":"))))

    def _ingest(self, source: Source) -> tuple[int, dict]:
        seen = self.warehouse.write_run(
            "raw_documents", source(self.run_id), self.run_id,
            {"rows": F.count_if(F.col("malformed_line").isNull())})
        self.counts["raw_doc_count"] = seen["rows"]
        return seen["rows"], {"input": self.input_path}

    def _clean(self) -> tuple[int, dict]:
        # Every text is cleaned once, here; the next stage reads the cleaned rows and removes them.
        w, c = self.warehouse, self.counts
        raw = jsonl.accepted(w.read_run("raw_documents", self.run_id))
        if 2 * raw.rdd.getNumPartitions() < w.spark.sparkContext.defaultParallelism:
            # So small that few tasks read it: dealt anew, or those few would do all that follows.
            raw = raw.hint("rebalance")
        self.staged = written(validate.staged_documents(raw), "staged", scratch.TEXT_CODEC)
        seen = w.write_run("rejected_documents", validate.refused_of(self.staged, self.run_id),
                           self.run_id, {"rows": F.count("*")})
        c["rejected_doc_count"] = seen["rows"]
        c["stg_valid_count"] = c["raw_doc_count"] - c["rejected_doc_count"]
        return c["stg_valid_count"], {"rejected": c["rejected_doc_count"]}

    def _curate(self) -> tuple[int, dict]:
        # Keys and statuses are narrow tables of their own: later plans then know their
        # size when they choose a join, and nothing is recomputed after a lost executor.
        w, run_id = self.warehouse, self.run_id
        valid = validate.accepted_of(self.staged)
        n_keys = w.write_run("batch_keys", merge.batch_keys(valid), run_id,
                             {"rows": F.count("*")})["rows"]
        keys = w.read_run("batch_keys", run_id).drop("run_id")
        self._find_current(keys, n_keys)
        statuses = merge.classify(keys, self.current, current.HELD)
        decided = w.write_run("document_status", statuses, run_id,
                              merge.status_metrics() | current.closed_metrics())
        self.closed = {c: decided.pop(f"closed_{c}") for c in current.HELD}
        self.counts.update(decided)
        statuses = w.read_run("document_status", run_id)
        changes = decided["new_doc_count"] + decided["updated_doc_count"]
        if changes == self.counts["stg_valid_count"]:
            # Every row is the one occurrence of a document that changed: no text moves.
            versions = merge.version_rows(valid, run_id)
        else:
            versions = merge.new_versions(valid if changes else valid.filter("false"), statuses, run_id)
        w.write_run("clean_documents", versions, run_id)
        w.write_run("closures", merge.new_closures(statuses, run_id), run_id)
        scratch.remove(self.staged)
        return self.counts["stg_valid_count"], decided

    def _find_current(self, keys: DataFrame, n_keys: int) -> None:
        """The snapshot rows of the buckets that the batch touches, and how many buckets there are.

        A corpus that outgrew its buckets gets more of them with a batch that touches them all. One
        without a snapshot gets it from its history.
        """
        w = self.warehouse
        self.before = w.last_state()
        known = self.before["n_documents"] if self.before else 0
        self.n_buckets, at = w.key_layout()
        if self.n_buckets is None:
            self.n_buckets = self.key_buckets or current.bucket_count(max(n_keys, known))
            self.current = w.spark.createDataFrame([], schemas.TABLES["current_keys"])
            if "success" in w.statuses().values():
                self.current = written(current.from_history(
                    w.read("clean_documents"), w.read("closures"), w.read("chunks"),
                    w.read("embeddings")).withColumn("bucket", F.lit(0)), "history")
            return
        # As many numbers as there are buckets.
        touched = {r.bucket for r in keys.select(
            current.bucket_of(self.n_buckets)).distinct().collect()}
        self.current = w.read_keys({b: run for b, run in at.items() if b in touched})
        grown = current.bucket_count(known)
        if self.key_buckets is None and touched >= at.keys() and grown >= S.OUTGROWN * self.n_buckets:
            self.n_buckets = grown

    def _chunk(self) -> tuple[int, dict]:
        w = self.warehouse
        fresh = w.read_run("clean_documents", self.run_id)
        chunks = chunking.chunk_documents(fresh, self.tokenizer)
        self.added = w.write_run("chunks", chunks.withColumn("prefix", chunking.prefix("chunk_id")),
                                 self.run_id,
                                 {"n_chunks": F.count("*")} | current.hash_metrics("chunk_hash"))
        self.counts["new_chunk_count"] = self.added["n_chunks"]
        return self.added["n_chunks"], {"tokenizer": type(self.tokenizer).__name__}

    def _embed(self) -> tuple[int, dict]:
        w = self.warehouse
        fresh = w.read_run("chunks", self.run_id)
        seen = w.write_run("embeddings", embed_chunks(fresh, self.encoder), self.run_id,
                           {"n_embeddings": F.count("*")})
        self.added |= seen
        self.counts["new_embedding_count"] = seen["n_embeddings"]
        return seen["n_embeddings"], {"encoder": self.encoder.name}

    def _visible(self, table: str) -> DataFrame:
        return self.warehouse.read(table, also=self.run_id)

    def _active(self, table: str) -> DataFrame:
        return merge.active(self._visible(table), self._visible("closures"))

    def _index(self) -> tuple[int, dict]:
        """Keep the last index if nothing changed since, add a part to it if little did, else build
        one over all active vectors."""
        w, run_id = self.warehouse, self.run_id
        last, parts = self._last_index()
        paths = w.index_path(run_id), w.centroids_path(run_id)
        changed = [self.added["n_embeddings"], int(self.closed["n_embeddings"])]
        if last is None or not self._may_add(parts, sum(changed)):
            facts = index_store.build_index(self._active("embeddings"), *paths, self.max_cells)
            curve, parts = facts["curve"], [(run_id, facts["num_vectors"], 0)]
        elif not sum(changed):
            paths = last.index_path, last.centroids_path
            facts, curve = {"num_vectors": last.num_vectors, "nlist": last.nlist,
                            "checksum": last.index_checksum}, []
        else:
            paths = last.index_path, last.centroids_path
            parts = [*parts, (run_id, *changed)]
            facts = self._add_to_index(last, parts)
            curve = stored_curve(w, last.index_checksum)
        w.write_index_parts(parts, run_id)
        if curve:
            w.write_run("index_recall", small_frame(
                w.spark, [(facts["checksum"], n, *pair) for n, pair in enumerate(curve, 1)],
                T.StructType(schemas.TABLES["index_recall"].fields[:-1])), run_id)
        w.append("index_registry", registry_row(
            w.spark, run_id, self.dataset_name, self.encoder.name, facts, paths, self.mode))
        self.counts["index_vector_count"] = facts["num_vectors"]
        return facts["num_vectors"], {"nlist": facts["nlist"]}

    def _last_index(self):
        """The registry row and the parts of the last run's index, if it was built alike; else None."""
        w = self.warehouse
        nothing = None, []
        if self.before is None:
            return nothing
        last = w.read("index_registry").filter(F.col("run_id") == self.before["run_id"]).first()
        if last is None or last.embedding_model != self.encoder.name:
            return nothing
        parts = [(r.part_run_id, r.n_added, r.n_closed) for r in w.index_parts(last.run_id)]
        alike = parts and last.nlist == ivf.cell_count(parts[0][1], self.max_cells)
        return (last, parts) if alike else nothing

    @staticmethod
    def _may_add(parts: list[tuple[int, int, int]], changed: int) -> bool:
        since = sum(added + closed for _, added, closed in parts[1:]) + changed
        return not changed or len(parts) < S.MOST_PARTS and since <= S.ADDED_SHARE * parts[0][1]

    def _add_to_index(self, last, parts: list[tuple[int, int, int]]) -> dict:
        w, run_id = self.warehouse, self.run_id
        centroids = index_store.read_centroids(w.spark, last.centroids_path)
        index_store.add_part(w.read_run("embeddings", run_id), centroids, w.index_path(run_id))
        ended = w.read_run("closures", run_id).select(
            "doc_id", F.col("valid_from_run_id").alias("source_run_id"))
        w.write_run("index_closed", w.read("chunks").select("chunk_id", "doc_id", "source_run_id").join(
            ended, ["doc_id", "source_run_id"], "left_semi"), run_id)
        stored = index_store.index_checksum(whole_index(w, parts, also=run_id)).first()
        return {"num_vectors": stored.n_rows, "nlist": last.nlist, "checksum": stored.digest}

    def _count_active(self) -> None:
        """Write the touched key buckets and the state: that of the run before, plus, less."""
        w, c = self.warehouse, self.counts
        held = current.held_by_document(w.read_run("chunks", self.run_id),
                                        w.read_run("embeddings", self.run_id))
        statuses = w.read_run("document_status", self.run_id)
        w.write_keys(current.updated_snapshot(
            self.current, statuses, held, self.run_id, self.n_buckets), self.n_buckets, self.run_id)
        self._sketch(statuses)
        before = self.before or self._counted_before()
        changes = c["new_doc_count"] + c["updated_doc_count"]
        state = {"n_documents": before["n_documents"] + c["new_doc_count"],
                 "n_changes": before["n_changes"] + changes}
        state |= {n: before[n] + int(self.added[n]) - int(self.closed[n]) for n in current.HELD}
        w.write_state(state, self.run_id)
        c.update(active_doc_count=state["n_documents"], active_chunk_count=state["n_chunks"],
                 active_embedding_count=state["n_embeddings"])

    def _sketch(self, statuses: DataFrame) -> None:
        """Add the new ids to the sketch of known ones; at first, those of the history too."""
        w = self.warehouse
        n_words = w.sketch_words()
        ids = statuses.filter(F.col("status") == S.NEW).select("doc_id")
        if n_words is None:
            n_words = known_ids.word_count(S.SKETCH_ROOM * max(
                self.counts["new_doc_count"], self.before["n_documents"] if self.before else 0))
            ids = ids.unionByName(self.current.select("doc_id"))
        w.write_run("known_ids", known_ids.sketch(ids, n_words).withColumn(
            "n_words", F.lit(n_words).cast("long")), self.run_id)

    def _counted_before(self) -> dict[str, int]:
        """The state of a corpus that has none yet, summed over its snapshot."""
        row = self.current.agg(F.count("*").alias("n_documents"), *[
            F.coalesce(F.sum(F.col(n).cast("decimal(38,0)")), F.lit(0)).alias(n)
            for n in current.HELD]).first()
        return {n: int(v) for n, v in row.asDict().items()} | {"n_changes": 0}

    def _reconcile(self) -> None:
        c, w = self.counts, self.warehouse
        fields = schemas.TABLES["row_count_reconciliation"].fields[:6]
        row = small_frame(w.spark, [(
            c["raw_doc_count"], c["active_doc_count"], c["rejected_doc_count"],
            c["active_chunk_count"], c["active_embedding_count"], c["index_vector_count"])],
            T.StructType(fields))
        w.write_run("row_count_reconciliation",
                    quality.reconciliation_status(row, self.run_id), self.run_id)

    def _audit(self) -> None:
        w = self.warehouse
        here = {"dataset_name": self.dataset_name, "input_path": self.input_path,
                "run_id": self.run_id}
        before = quality.previous_full_run(w.runs(), here).first()
        if before is None:
            return
        names = ["run_id", *quality.AUDITED_COUNTS]
        fields = [schemas.TABLES["runs"][n] for n in names]
        own = small_frame(w.spark, [(self.run_id, *[self.counts[n] for n in names[1:]])],
                          T.StructType(fields))
        known = w.runs().filter(F.col("run_id") != self.run_id).select(*names)
        write_audit(w, known.unionByName(own), before.run_id, self.run_id, also=self.run_id)

    def _record(self, status: str, end, notes: str | None) -> None:
        w = self.warehouse
        if end is not None and self.latency:
            w.append_rows("latency_logs", self.latency)
        w.append_rows("runs", [(
            self.run_id, self.mode, self.dataset_name, self.input_path, w.root, self.started,
            end, status, *[self.counts[n] for n in schemas.RUN_COUNTS], notes)])


def whole_index(w: Warehouse, parts: list[tuple], also: int | None = None) -> DataFrame:
    """The vectors of an index by its parts, without those closed since."""
    places = [(run, w.index_path(run)) for run, *_ in parts]
    return index_store.read_parts(w.spark, places, w.read("index_closed", also=also))


def stored_curve(w: Warehouse, index_checksum: str) -> list[tuple[int, int]]:
    """(true, found) pairs by number of probes, as measured when the index was built; there are as
    many as cells. Empty for an index from before they were kept."""
    rows = w.read("index_recall").filter(F.col("index_checksum") == index_checksum).select(
        "nprobe", "n_true", "n_found").distinct().orderBy("nprobe").collect()
    return [(r.n_true, r.n_found) for r in rows]


def registry_row(spark: SparkSession, run_id: int, dataset_name: str, model: str, facts: dict,
                 paths: tuple[str, str], mode: str) -> DataFrame:
    row = (run_id, dataset_name, S.INDEX_TYPE, model, S.METRIC, facts["nlist"], S.NPROBE,
           facts["num_vectors"], *paths, facts["checksum"], mode, _now())
    fields = schemas.TABLES["index_registry"].fields[1:]
    return small_frame(spark, [row], T.StructType(fields)).withColumn(
        "index_id", X.key_hash("dataset_name", "run_id", "index_checksum"))


def checksums(w: Warehouse, run_ids: list[int], also: int | None = None) -> DataFrame:
    """(run_id, checksum) of the chunks active at the end of runs, as the runs kept it; a run from
    before states were kept is counted again."""
    stored = w.read("corpus_state", also=also).filter(F.col("run_id").isin(run_ids)).select(
        "run_id", current.checksum("n_chunks").alias("checksum"))
    known = {r.run_id for r in stored.select("run_id").collect()}
    missing = [r for r in run_ids if r in w.statuses().keys() - known]
    if not missing:
        return stored
    return stored.unionByName(chunk_checksums(
        w.read("chunks", also=also), w.read("closures", also=also), missing))


def chunk_checksums(chunks: DataFrame, closures: DataFrame, run_ids: list[int]) -> DataFrame:
    """The same in one pass over the chunks of all versions."""
    rows = merge.with_validity(chunks.select("doc_id", "chunk_hash", "source_run_id"), closures)
    active = merge.as_of_runs(rows, run_ids).select("run_id", "chunk_hash")
    # A run without chunks has the checksum of an empty set.
    every = chunks.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(r) for r in run_ids])).alias("run_id"),
        F.lit(None).cast("string").alias("chunk_hash"))
    return active.unionByName(every).groupBy("run_id").agg(
        F.count("chunk_hash").alias("n_rows"), *quality.digest_columns("chunk_hash"),
    ).select("run_id", current.checksum("n_rows").alias("checksum"))


def states_and_recounts(w: Warehouse) -> DataFrame:
    """The kept state of every run beside a full recount: run_id, n_documents, n_chunks,
    n_embeddings, checksum, agrees."""
    stored = w.read("corpus_state").select(
        "run_id", "n_documents", "n_chunks", "n_embeddings",
        current.checksum("n_chunks").alias("checksum"))
    # One number per run.
    run_ids = sorted(r.run_id for r in stored.select("run_id").collect())
    again = current.recounted(w.read("clean_documents"), w.read("closures"), w.read("chunks"),
                              w.read("embeddings"), run_ids)
    counted = F.struct(*[again[c] for c in stored.columns[1:]])
    return stored.join(again, "run_id").select(
        "run_id", *[stored[c] for c in stored.columns[1:]],
        (F.struct(*[stored[c] for c in stored.columns[1:]]) == counted).alias("agrees"))


def write_audit(w: Warehouse, runs: DataFrame, run_a: int, run_b: int,
                also: int | None = None) -> DataFrame:
    """Run the checks between two runs, store them and return the stored rows."""
    created = _now()
    sums = checksums(w, [run_a, run_b], also)
    w.append("audit_results", quality.audit(runs, sums, [(run_a, run_b)]).select(
        X.key_hash("run_id_a", "run_id_b", "audit_type").alias("audit_id"), "*",
        F.lit(created).alias("created_at")).coalesce(1))
    return w.everything("audit_results").filter(
        (F.col("run_id_a") == run_a) & (F.col("run_id_b") == run_b)
        & (F.col("created_at") == F.lit(created)))


def audit_runs(w: Warehouse, run_a: int, run_b: int) -> DataFrame:
    """Compare two finished runs of a warehouse."""
    return write_audit(w, w.runs(), run_a, run_b)


def preview(w: Warehouse, batch: DataFrame) -> DataFrame:
    """How a coming batch (id, title, text) looks against a warehouse: see ``batch_preview``.

    Ids that the sketch does not know are new without a look at any key; the others are looked up in
    the key buckets that they fall into.
    """
    n_buckets, at = w.key_layout()
    ids = batch.select(F.col("id").alias("doc_id")).filter(~X.is_blank("doc_id")).distinct()
    if n_buckets is None:
        return sampling.batch_preview(batch, ids.filter("false").withColumnRenamed("doc_id", "id"))
    n_words = w.sketch_words()
    chance = ids if n_words is None else known_ids.with_chance(
        ids, w.read("known_ids"), n_words).filter("may_be_known").select("doc_id")
    chance = written(chance.withColumn("bucket", current.bucket_of(n_buckets)), "maybe-known")
    touched = {r.bucket for r in chance.select("bucket").distinct().collect()}
    keys = w.read_keys({b: run for b, run in at.items() if b in touched})
    known = keys.join(chance.select("doc_id"), "doc_id", "left_semi")
    return sampling.batch_preview(batch, known.select(F.col("doc_id").alias("id")))


def build(spark: SparkSession, root: str, mode: str, dataset_name: str, input_path: str,
          **options) -> int:
    """Build or update the corpus at ``root`` from JSON lines; returns the run id."""
    return Build(Warehouse(spark, root), mode, dataset_name, input_path, **options).run()


def _now() -> datetime:
    return datetime.now(timezone.utc)
