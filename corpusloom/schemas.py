"""Declared schemas of every stored table."""

from pyspark.sql import types as T

STRING, INT, LONG, BOOLEAN = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
DOUBLE, TIMESTAMP, FLOATS = T.DoubleType(), T.TimestampType(), T.ArrayType(T.FloatType())
# A sum of any number of 32-bit words.
WIDE = T.DecimalType(38, 0)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SEQ = _table(file=STRING, block=LONG, row=LONG)
WORDS = tuple(f"w{i}" for i in range(8))

# Names and order of the counts of a run and of the columns of every table.
RUN_COUNTS = (
    "raw_doc_count", "stg_valid_count", "rejected_doc_count", "new_doc_count",
    "updated_doc_count", "duplicate_doc_count", "unchanged_doc_count", "active_doc_count",
    "new_chunk_count", "active_chunk_count", "new_embedding_count",
    "active_embedding_count", "index_vector_count",
)

TABLES: dict[str, T.StructType] = {
    "runs": _table(
        run_id=INT, mode=STRING, dataset_name=STRING, input_path=STRING, output_dir=STRING,
        start_time=TIMESTAMP, end_time=TIMESTAMP, status=STRING, **dict.fromkeys(RUN_COUNTS,
        LONG), notes=STRING),
    "raw_documents": _table(
        ingest_batch_id=STRING, id=STRING, url=STRING, title=STRING, text=STRING,
        malformed_line=STRING, seq=SEQ, ingested_at=TIMESTAMP, run_id=INT),
    "rejected_documents": _table(
        doc_id=STRING, title=STRING, reason_code=STRING, reason_detail=STRING,
        raw_snapshot=STRING, run_id=INT),
    "batch_keys": _table(doc_id=STRING, seq=SEQ, content_hash=STRING, copies=LONG, run_id=INT),
    "document_status": _table(
        doc_id=STRING, seq=SEQ, content_hash=STRING, copies=LONG, status=STRING,
        closed_valid_from=INT, run_id=INT),
    "clean_documents": _table(
        doc_id=STRING, url=STRING, title=STRING, cleaned_text=STRING, content_hash=STRING,
        text_len=INT, source_run_id=INT),
    "closures": _table(doc_id=STRING, valid_from_run_id=INT, valid_to_run_id=INT),
    # The documents that are current after a run, with what they hold; by hash bucket.
    "current_keys": _table(
        doc_id=STRING, content_hash=STRING, source_run_id=INT, n_chunks=LONG, n_embeddings=LONG,
        **dict.fromkeys(WORDS, LONG), bucket=INT),
    # The buckets that a run wrote, of how many.
    "key_buckets": _table(bucket=INT, n_buckets=INT, run_id=INT),
    # What a run added to the sketch of known ids, of so many words.
    "known_ids": _table(word=LONG, bits=LONG, n_words=LONG, run_id=INT),
    # What a run left: counts and the summed words of the hashes of its chunks. ``n_changes`` counts
    # new and updated documents of all runs, so equal numbers mean the same corpus.
    "corpus_state": _table(
        n_documents=LONG, n_chunks=LONG, n_embeddings=LONG, n_changes=LONG,
        **dict.fromkeys(WORDS, WIDE), run_id=INT),
    # ``prefix``, the first digits of chunk_id, is a folder, so that a look-up of few chunks lists and
    # reads few files.
    "chunks": _table(
        chunk_id=STRING, doc_id=STRING, content_hash=STRING, chunk_index=INT, start_tok=INT,
        end_tok=INT, chunk_text=STRING, chunk_token_len=INT, chunk_hash=STRING,
        source_run_id=INT, prefix=STRING),
    "embeddings": _table(
        chunk_id=STRING, doc_id=STRING, embedding_model=STRING, embedding_dim=INT,
        embedding_hash=STRING, embedding=FLOATS, source_run_id=INT),
    "index_vectors": _table(chunk_id=STRING, embedding_hash=STRING, embedding=FLOATS, cell=INT),
    "index_centroids": _table(cell=INT, centroid=FLOATS),
    "index_registry": _table(
        index_id=STRING, run_id=INT, dataset_name=STRING, index_type=STRING,
        embedding_model=STRING, metric=STRING, nlist=INT, nprobe=INT, num_vectors=LONG,
        index_path=STRING, centroids_path=STRING, index_checksum=STRING, build_mode=STRING,
        created_at=TIMESTAMP),
    # What an index consists of: the run that built it, then runs that added to it, and how many
    # vectors each added and closed.
    "index_parts": _table(part_run_id=INT, n_added=LONG, n_closed=LONG, run_id=INT),
    "index_closed": _table(chunk_id=STRING, run_id=INT),
    # How many true neighbours of stored vectors an index finds with so many probes.
    "index_recall": _table(
        index_checksum=STRING, nprobe=INT, n_true=LONG, n_found=LONG, run_id=INT),
    "row_count_reconciliation": _table(
        raw_documents=LONG, clean_documents_active=LONG, rejected_documents=LONG,
        active_chunks=LONG, active_embeddings=LONG, index_vectors=LONG,
        reconciliation_status=STRING, details=STRING, run_id=INT),
    "audit_results": _table(
        audit_id=STRING, run_id_a=INT, run_id_b=INT, audit_type=STRING, result=STRING,
        details=STRING, created_at=TIMESTAMP),
    "retrieval_eval": _table(
        eval_id=STRING, run_id=INT, query_id=STRING, query_text=STRING, expected_doc_id=STRING,
        retrieved_doc_id=STRING, rank=INT, hit_at_k=BOOLEAN, reciprocal_rank=DOUBLE,
        created_at=TIMESTAMP),
    "latency_logs": _table(
        run_id=INT, stage_name=STRING, start_time=TIMESTAMP, end_time=TIMESTAMP,
        duration_seconds=DOUBLE, row_count=LONG, details=STRING),
}
