"""The queries of the catalogue once more, in SQL that DuckDB runs on the same tables."""

from corpusloom import schemas
from corpusloom import settings as S
from corpusloom.functions.text import SPACE_POINTS
from corpusloom.operators.sampling import CORRUPTED_ID, CORRUPTED_TITLE, REVISION
from corpusloom.plans.inputs import CORRECTED, DIM, REVISED

# The whitespace class in RE2 notation.
WS = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
TOP_K = 5
LABEL_NPROBE = 3


def blank(c: str) -> str:
    return f"NOT regexp_matches({c}, '[^{WS}]')"


def clean(c: str) -> str:
    return f"trim(regexp_replace(replace({c}, chr(0), ''), '[{WS}]+', ' ', 'g'), ' ')"


_SPACES = "[" + ", ".join(f"chr({p})" for p in SPACE_POINTS) + "]"


def _space(n: str) -> str:
    return f"list_extract({_SPACES}, 1 + ({n} % {len(SPACE_POINTS)})::INT)"


_TURN = "(conv_id * 1000000 + turn)"

# Named steps; each may use the ones before it.
_STEPS = {
    "base": """
        SELECT doc_id::VARCHAR AS id, 'doc://' || source || '/' || doc_id AS url,
               source || ' ' || lang || ' ' || doc_id AS title, text, 0 AS part, doc_id AS n
        FROM documents""",
    "delta": f"""
        SELECT id, url, title,
               CASE WHEN toxic = 0 AND quality = 1 THEN text
                    WHEN toxic = 0 THEN text || '{REVISED}'
                    WHEN quality = 1 THEN chr(0) ELSE '' END AS text, 0 AS part, n
        FROM base JOIN labels ON n = doc_id
        UNION ALL
        SELECT id, url, title, text || '{CORRECTED}', 1, n
        FROM base JOIN labels ON n = doc_id WHERE toxic = 0 AND quality = 0
        UNION ALL
        SELECT 'page-' || page_id, url, url, html, 2, page_id FROM pages
        UNION ALL
        SELECT '', '', role, text, 3, {_TURN} FROM conversations""",
    "usable": f"""
        SELECT * FROM base WHERE NOT ({blank('id')}) AND NOT ({blank('text')})""",
    "drawn": f"""
        SELECT * FROM usable ORDER BY md5('{S.SEED}|' || id), id
        LIMIT (SELECT CASE WHEN count(*) >= 45 THEN 40 ELSE greatest(2, count(*) - 5) END
               FROM usable)""",
    "drawn_forty": f"SELECT * FROM usable ORDER BY md5('{S.SEED}|' || id), id LIMIT 40",
    "redelivered": f"""
        SELECT {clean('text')} <> '' AS ok, {clean('text')} AS whole,
               CASE WHEN n IN (SELECT doc_id FROM labels) THEN {clean(f"text || '{REVISED}'")}
                    ELSE {clean('text')} END AS later FROM base""",
    "noisy": f"""
        SELECT id, url, title,
               CASE WHEN toxic = 1 AND quality = 0 THEN {_space('n')} || {_space('n')} || ' '
                    WHEN toxic = 1 THEN chr(0) || {_space('n')} || chr(0)
                    ELSE {_space('n')} || text || {_space('n')} || ' ' || {_space('n')}
                         || 'e' || chr(0) || 'nd ' || {_space('n')} END AS text
        FROM base LEFT JOIN labels ON n = doc_id
        UNION ALL
        SELECT {_space(_TURN)}, NULL, role, text FROM conversations""",
    "noisy_why": f"""
        SELECT *, CASE WHEN {blank('id')} THEN '{S.DETAIL_MISSING_ID}'
                       WHEN {blank('text')} THEN '{S.DETAIL_EMPTY_TEXT}'
                       WHEN {clean('text')} = '' THEN '{S.DETAIL_EMPTY_CLEANED}' END AS why
        FROM noisy""",
    "rejects": f"""
        SELECT id AS doc_id, coalesce(title, '') AS title,
               CASE WHEN why = '{S.DETAIL_MISSING_ID}' THEN '{S.MISSING_ID}'
                    ELSE '{S.EMPTY_TEXT}' END AS reason_code,
               why AS reason_detail,
               json_object('id', id, 'url', url, 'title', title,
                           'text', nullif(substr(text, 1, {S.SNAPSHOT_CHARS}), ''))::VARCHAR
                   AS raw_snapshot,
               1 AS run_id
        FROM noisy_why WHERE why IS NOT NULL""",
    "base_valid": f"""
        SELECT id AS doc_id, url, title, part, n, {clean('text')} AS cleaned_text,
               sha256({clean('text')}) AS content_hash, length({clean('text')})::INT AS text_len
        FROM base WHERE NOT ({blank('id')}) AND {clean('text')} <> ''""",
    "delta_valid": f"""
        SELECT id AS doc_id, url, title, part, n, {clean('text')} AS cleaned_text,
               sha256({clean('text')}) AS content_hash, length({clean('text')})::INT AS text_len
        FROM delta WHERE NOT ({blank('id')}) AND {clean('text')} <> ''""",
    "delta_rejected": f"""
        SELECT * FROM delta WHERE {blank('id')} OR {clean('text')} = ''""",
    "winners": """
        SELECT * FROM (
            SELECT *, count(*) OVER (PARTITION BY doc_id) AS copies,
                   row_number() OVER (PARTITION BY doc_id ORDER BY part DESC, n DESC) AS nth
            FROM delta_valid) WHERE nth = 1""",
    "statuses": f"""
        SELECT w.*, CASE WHEN b.doc_id IS NULL THEN '{S.NEW}'
                         WHEN b.content_hash = w.content_hash THEN '{S.UNCHANGED}'
                         ELSE '{S.UPDATED}' END AS status
        FROM winners w LEFT JOIN base_valid b ON w.doc_id = b.doc_id""",
    "log": f"""
        SELECT doc_id, url, title, cleaned_text, content_hash, text_len, 1 AS source_run_id
        FROM base_valid
        UNION ALL
        SELECT doc_id, url, title, cleaned_text, content_hash, text_len, 3
        FROM statuses WHERE status <> '{S.UNCHANGED}'""",
    "versions": """
        SELECT *, valid_to_run_id IS NULL AS is_active, source_run_id AS valid_from_run_id
        FROM (SELECT *, lead(source_run_id) OVER (PARTITION BY doc_id ORDER BY source_run_id)
                        AS valid_to_run_id FROM log)""",
    "tokenised": """
        SELECT *, string_split(title || ': ' || cleaned_text, ' ') AS tokens FROM versions""",
    "windows": f"""
        SELECT *, unnest(range(CASE WHEN len(tokens) < {S.MIN_CHUNK_TOKENS} THEN 0
                                    WHEN len(tokens) <= {S.CHUNK_TOKENS} THEN 1
                                    ELSE 1 + ceil((len(tokens) - {S.CHUNK_TOKENS})
                                                  / {S.STRIDE_TOKENS}.0)::BIGINT END)) AS i
        FROM tokenised""",
    "cuts": f"""
        SELECT *, i * {S.STRIDE_TOKENS} AS start_tok,
               least(i * {S.STRIDE_TOKENS} + {S.CHUNK_TOKENS}, len(tokens)) AS end_tok
        FROM windows""",
    "chunks": """
        SELECT sha256(doc_id || '|' || content_hash || '|' || start_tok || '|' || end_tok)
                   AS chunk_id,
               doc_id, content_hash, i::INT AS chunk_index, start_tok::INT AS start_tok,
               end_tok::INT AS end_tok,
               array_to_string(tokens[start_tok + 1:end_tok], ' ') AS chunk_text,
               (end_tok - start_tok)::INT AS chunk_token_len,
               sha256(array_to_string(tokens[start_tok + 1:end_tok], ' ')) AS chunk_hash,
               source_run_id, is_active, valid_from_run_id, valid_to_run_id
        FROM cuts""",
    "corpus_chunks": "SELECT * FROM chunks WHERE source_run_id = 1",
    "run_ids": "SELECT unnest([1, 2, 3])::INT AS run_id",
    "live": """
        SELECT r.run_id, c.chunk_id, c.chunk_hash FROM run_ids r JOIN chunks c
          ON c.source_run_id <= r.run_id
         AND (c.valid_to_run_id IS NULL OR c.valid_to_run_id > r.run_id)""",
    "asof_sums": """
        SELECT run_id, {digest} || ':' || count(*) AS checksum FROM live GROUP BY run_id""",
    "decisions": f"""
        SELECT 1 AS run_id, '{S.NEW}' AS status, 1 AS copies FROM base_valid
        UNION ALL SELECT 2, '{S.UNCHANGED}', 1 FROM base_valid
        UNION ALL SELECT 3, status, copies FROM statuses""",
    "decided": f"""
        SELECT run_id, count_if(status = '{S.NEW}')::BIGINT AS new_doc_count,
               count_if(status = '{S.UPDATED}')::BIGINT AS updated_doc_count,
               count_if(status = '{S.UNCHANGED}')::BIGINT AS unchanged_doc_count,
               sum(copies - 1)::BIGINT AS duplicate_doc_count
        FROM decisions GROUP BY run_id""",
    "runs": """
        SELECT run_id, CASE WHEN run_id = 3 THEN 'augmented' ELSE 'full' END AS mode,
               'tables' AS dataset_name,
               CASE WHEN run_id = 3 THEN 'update' ELSE 'documents' END AS input_path,
               'success' AS status,
               (SELECT count(*) FROM base) * (run_id < 3)::INT
                   + (SELECT count(*) FROM delta) * (run_id = 3)::INT AS raw_doc_count,
               (SELECT count(*) FROM base_valid) * (run_id < 3)::INT
                   + (SELECT count(*) FROM delta_valid) * (run_id = 3)::INT AS stg_valid_count,
               ((SELECT count(*) FROM base) - (SELECT count(*) FROM base_valid))
                   * (run_id < 3)::INT
                   + (SELECT count(*) FROM delta_rejected) * (run_id = 3)::INT
                   AS rejected_doc_count,
               d.new_doc_count, d.updated_doc_count, d.duplicate_doc_count,
               d.unchanged_doc_count,
               (SELECT count(*) FROM versions v WHERE v.source_run_id <= r.run_id
                 AND (valid_to_run_id IS NULL OR valid_to_run_id > r.run_id)) AS active_doc_count,
               (SELECT count(*) FROM chunks c WHERE c.source_run_id = r.run_id) AS new_chunk_count,
               (SELECT count(*) FROM live a WHERE a.run_id = r.run_id) AS active_chunk_count,
               (SELECT count(*) FROM chunks c WHERE c.source_run_id = r.run_id)
                   AS new_embedding_count,
               (SELECT count(*) FROM live a WHERE a.run_id = r.run_id) AS active_embedding_count,
               (SELECT count(*) FROM live a WHERE a.run_id = r.run_id) AS index_vector_count
        FROM run_ids r JOIN decided d USING (run_id)""",
    "pairs": """
        SELECT a.run_id AS run_id_a, b.run_id AS run_id_b, a.*, b.*,
               a.active_doc_count AS ad, b.active_doc_count AS bd,
               a.active_chunk_count AS ac, b.active_chunk_count AS bc,
               a.active_embedding_count AS ae, b.active_embedding_count AS be,
               a.index_vector_count AS ai, b.index_vector_count AS bi,
               sa.checksum AS sa, sb.checksum AS sb
        FROM runs a JOIN runs b ON b.run_id = a.run_id + 1
        JOIN asof_sums sa ON sa.run_id = a.run_id JOIN asof_sums sb ON sb.run_id = b.run_id""",
    "audited": """
        SELECT run_id_a, run_id_b, 'active_doc_count' AS audit_type,
               CASE WHEN ad = bd THEN 'PASS' ELSE 'FAIL' END AS result,
               '{"run_a":' || ad || ',"run_b":' || bd || '}' AS details FROM pairs
        UNION ALL
        SELECT run_id_a, run_id_b, 'active_chunk_count',
               CASE WHEN ac = bc THEN 'PASS' ELSE 'FAIL' END,
               '{"run_a":' || ac || ',"run_b":' || bc || '}' FROM pairs
        UNION ALL
        SELECT run_id_a, run_id_b, 'active_embedding_count',
               CASE WHEN ae = be THEN 'PASS' ELSE 'FAIL' END,
               '{"run_a":' || ae || ',"run_b":' || be || '}' FROM pairs
        UNION ALL
        SELECT run_id_a, run_id_b, 'index_vector_count',
               CASE WHEN ai = bi THEN 'PASS' ELSE 'FAIL' END,
               '{"run_a":' || ai || ',"run_b":' || bi || '}' FROM pairs
        UNION ALL
        SELECT run_id_a, run_id_b, 'chunk_hash_checksum',
               CASE WHEN sa = sb THEN 'PASS' ELSE 'FAIL' END,
               '{"checksum_a":"' || left(sa, 16) || '...","checksum_b":"' || left(sb, 16)
               || '..."}' FROM pairs""",
    "stage_log": """
        SELECT user_id AS run_id, event_type AS stage_name, ts AS start_time,
               value AS duration_seconds FROM events""",
    "vectors": """
        SELECT vec_id::VARCHAR AS id, embedding::DOUBLE[] AS v, label FROM embeddings""",
    "label_elements": """
        SELECT cell, generate_subscripts(v, 1) AS pos, unnest(v) AS x
        FROM (SELECT *, (dense_rank() OVER (ORDER BY label) - 1)::INT AS cell FROM vectors)""",
    "centroids": """
        SELECT cell, list(x ORDER BY pos) AS c
        FROM (SELECT cell, pos, avg(x) AS x FROM label_elements GROUP BY cell, pos) GROUP BY cell""",
    "near": """
        SELECT id, v, cell, row_number() OVER (PARTITION BY id ORDER BY round(
                   list_dot_product(c, c) - 2 * list_dot_product(v, c), 9), cell) AS nth
        FROM vectors, centroids""",
    "assigned": "SELECT id, v, cell FROM near WHERE nth = 1",
    "exact_pairs": """
        SELECT q.id AS query_id, o.id AS id, round(list_dot_product(q.v, o.v), 9) AS score
        FROM vectors q JOIN vectors o ON q.id <> o.id WHERE q.id::BIGINT % 50 = 0""",
    "exact": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
                                                    ORDER BY score DESC, id)::INT AS rank
                       FROM exact_pairs) WHERE rank <= {TOP_K}""",
    "probed_pairs": f"""
        SELECT q.id AS query_id, o.id AS id, round(list_dot_product(q.v, o.v), 9) AS score
        FROM near q JOIN assigned o ON q.cell = o.cell
        WHERE q.nth <= {LABEL_NPROBE} AND q.id <> o.id AND q.id::BIGINT % 50 = 0""",
    "probed": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
                                                    ORDER BY score DESC, id)::INT AS rank
                       FROM probed_pairs) WHERE rank <= {TOP_K}""",
    "evaluated": f"""
        SELECT sha256('1|' || e.query_id || '|' || coalesce(h.rank::VARCHAR, '')) AS eval_id,
               1 AS run_id, e.query_id, 'vector ' || e.query_id AS query_text,
               e.id AS expected_doc_id, h.id AS retrieved_doc_id, h.rank,
               coalesce(h.id = e.id AND h.rank <= {TOP_K}, false) AS hit_at_k,
               CASE WHEN h.id = e.id THEN 1.0::DOUBLE / h.rank ELSE 0.0 END AS reciprocal_rank
        FROM exact e LEFT JOIN probed h USING (query_id) WHERE e.rank = 1""",
    # Raw bytes of a float: sign, exponent and fraction from arithmetic, lowest byte first.
    "float_parts": """
        SELECT id, pos, x, abs(x) AS a,
               CASE WHEN x = 0 THEN 0 ELSE floor(log2(abs(x)))::INT END AS e0
        FROM (SELECT id, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM vectors)""",
    "float_exponents": """
        SELECT *, CASE WHEN a = 0 THEN 0 WHEN a >= pow(2.0, e0 + 1) THEN e0 + 1
                       WHEN a < pow(2.0, e0) THEN e0 - 1 ELSE e0 END AS e FROM float_parts""",
    "float_bits": """
        SELECT id, pos, (CASE WHEN x < 0 THEN 2147483648 ELSE 0 END
               + CASE WHEN a = 0 THEN 0 ELSE (e + 127) * 8388608
                      + round((a / pow(2.0, e) - 1) * 8388608)::BIGINT END)::BIGINT AS bits
        FROM float_exponents""",
    "vector_hash": """
        SELECT id, sha256(unhex(string_agg(
                 printf('%02x%02x%02x%02x', bits & 255, (bits >> 8) & 255, (bits >> 16) & 255,
                        (bits >> 24) & 255), '' ORDER BY pos))) AS embedding_hash
        FROM float_bits GROUP BY id""",
    # Signed feature hashing of passages and questions.
    "texts": """
        SELECT 'p' AS kind, chunk_id AS key, string_split({passage} || chunk_text, ' ') AS words
        FROM corpus_chunks
        UNION ALL
        SELECT 'q', item_id::VARCHAR, string_split({question} || text, ' ') FROM benchmark""",
    "slots": f"""
        SELECT kind, key, ('0x' || substr(h, 1, 8))::BIGINT % {DIM} AS slot,
               1 - 2 * (('0x' || substr(h, 9, 1))::BIGINT % 2) AS sign
        FROM (SELECT kind, key, md5(w) AS h
              FROM (SELECT kind, key, unnest(words) AS w FROM texts))""",
    "slot_sums": "SELECT kind, key, slot, sum(sign)::DOUBLE AS s FROM slots GROUP BY ALL",
    "slot_norms": "SELECT kind, key, sqrt(sum(s * s)) AS norm FROM slot_sums GROUP BY ALL",
    "hashed": """
        SELECT kind, key, slot, (s / CASE WHEN norm = 0 THEN 1 ELSE norm END)::FLOAT::DOUBLE AS x
        FROM slot_sums JOIN slot_norms USING (kind, key)""",
    "text_scores": """
        SELECT q.key AS query_key, p.key AS chunk_id, round(sum(q.x * p.x), 9) AS score
        FROM hashed q JOIN hashed p ON q.slot = p.slot AND q.kind = 'q' AND p.kind = 'p'
        GROUP BY ALL""",
    "text_hits": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_key
                                                    ORDER BY score DESC, chunk_id)::INT AS rank
                       FROM text_scores) WHERE rank <= {TOP_K}""",
}
_WORDS = " || '|' || ".join(
    f"coalesce(sum(('0x' || substr({{h}}, {1 + 8 * i}, 8))::BIGINT), 0)::HUGEINT" for i in range(8))


def digest(h: str) -> str:
    return f"sha256({_WORDS.replace('{h}', h)})"


_STEPS["asof_sums"] = _STEPS["asof_sums"].replace("{digest}", digest("chunk_hash"))
_STEPS["texts"] = (_STEPS["texts"].replace("{passage}", f"'{S.PASSAGE_PREFIX}'")
                   .replace("{question}", f"'{S.QUERY_PREFIX}'"))


def sql(select: str) -> str:
    """A select over the named steps; steps nothing refers to are left out."""
    import re

    needed, text = [], select
    for name in reversed(_STEPS):
        if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
            needed.insert(0, name)
            text += _STEPS[name]
    steps = ",\n".join(f"{name} AS ({_STEPS[name].strip()})" for name in needed)
    return f"WITH {steps}\n{select}" if needed else select


_COUNTS = ", ".join(schemas.RUN_COUNTS)
_RETRIEVED = """
    SELECT h.query_key::BIGINT AS query_id, h.rank, h.score, h.chunk_id,
           c.doc_id, c.chunk_text, c.chunk_index, c.start_tok, c.end_tok, d.title, d.url
    FROM text_hits h JOIN corpus_chunks c ON h.chunk_id = c.chunk_id
    JOIN base_valid d ON c.doc_id = d.doc_id"""
_RECONCILED = """
            SELECT *, CASE WHEN active_chunks = active_embeddings
                            AND active_embeddings = index_vectors THEN 'PASS' ELSE 'FAIL' END
                          AS reconciliation_status,
                   json_object('raw', raw_documents, 'clean_active', clean_documents_active,
                       'rejected', rejected_documents, 'chunks', active_chunks,
                       'embeddings', active_embeddings, 'index_vectors', index_vectors)::VARCHAR
                       AS details, 3 AS run_id
            FROM (SELECT raw_doc_count AS raw_documents,
                         active_doc_count AS clean_documents_active,
                         rejected_doc_count AS rejected_documents,
                         active_chunk_count AS active_chunks,
                         active_embedding_count AS active_embeddings,
                         index_vector_count AS index_vectors FROM runs WHERE run_id = 3)"""
_NLIST = (f"least({S.MAX_CELLS}, greatest({S.MIN_CELLS}, index_vector_count // {S.VECTORS_PER_CELL}), "
          "index_vector_count)::INT")
_EXACT = "SELECT query_id, id, rank, score FROM exact"


def statements() -> dict[str, str]:
    tables = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()
    selects = {
        "ingest_jsonl_roundtrip": "SELECT 1 AS run_id, id, url, title, text FROM base",
        "malformed_lines":
            """SELECT unnest(['{"id": "' || doc_id || '", "text": "', '[{"id": "' || doc_id || '"}]',
                   '"' || doc_id || '"', '{' || chr(39) || 'id' || chr(39) || ': ' || chr(39) || doc_id || chr(39) || '}',
                   '{"id": "' || doc_id || '"} {"id": "x"}', doc_id::VARCHAR]) AS malformed_line
            FROM labels""",
        "ingest_batches": f"""
            SELECT 1 AS run_id, sha256('1|documents|0|' || batch) AS ingest_batch_id,
                   count(*) AS n_rows, min(n) AS first_row, max(n) AS last_row
            FROM (SELECT n, n // {S.INGEST_BATCH_ROWS} AS batch FROM base) GROUP BY batch""",
        "numbered_batches": f"""
            SELECT sha256('1|' || batch) AS ingest_batch_id, count(*) AS n_rows,
                   min(number) AS first_number, min(n) AS first_id, max(n) AS last_id
            FROM (SELECT *, number // {S.INGEST_BATCH_ROWS} AS batch
                  FROM (SELECT n, row_number() OVER (ORDER BY n) - 1 AS number FROM base))
            GROUP BY batch""",
        "first_documents": """
            SELECT row_number() OVER (ORDER BY n) - 1 AS number, id, title FROM base
            QUALIFY number < 25""",
        "snapshot_classify": f"""
            SELECT doc_id, content_hash, status,
                   CASE WHEN status = '{S.UPDATED}' THEN 1 END AS closed_valid_from
            FROM statuses""",
        "sketch_preview": f"""
            SELECT d.id, d.title, length(d.text)::INT AS text_len, NOT ({blank('d.text')}) AS has_text,
                   v.doc_id IS NULL AS is_new
            FROM (SELECT id, title, text FROM delta
                  UNION ALL SELECT 'unseen-' || page_id, url, html FROM pages) d
            LEFT JOIN (SELECT DISTINCT doc_id FROM versions) v ON v.doc_id = d.id""",
        "snapshot_keys": """
            SELECT v.doc_id, v.content_hash, v.source_run_id, count(c.chunk_id) AS n_chunks,
                   count(c.chunk_id) AS n_embeddings
            FROM versions v LEFT JOIN chunks c
              ON c.doc_id = v.doc_id AND c.source_run_id = v.source_run_id
            WHERE v.is_active GROUP BY ALL""",
        "state_additive": """
            SELECT run_id, active_doc_count AS n_documents, active_chunk_count AS n_chunks,
                   active_embedding_count AS n_embeddings, checksum, true AS agrees
            FROM runs JOIN asof_sums USING (run_id)""",
        "retrieval_eval_stored": f"""
            SELECT h.query_key AS query_id, b.text AS query_text, e.doc_id AS expected_doc_id,
                   c.doc_id AS retrieved_doc_id, h.rank, c.doc_id = e.doc_id AS hit_at_k,
                   round(CASE WHEN c.doc_id = e.doc_id THEN 1.0 / h.rank ELSE 0 END::DOUBLE, 6)
                       AS reciprocal_rank
            FROM text_hits h JOIN corpus_chunks c ON h.chunk_id = c.chunk_id
            JOIN text_hits f ON f.query_key = h.query_key AND f.rank = 1
            JOIN corpus_chunks e ON e.chunk_id = f.chunk_id
            JOIN benchmark b ON b.item_id::VARCHAR = h.query_key::VARCHAR""",
        "corpus_normalise": """
            SELECT doc_id::VARCHAR AS id, source AS url, lang AS title, text FROM documents
            UNION ALL SELECT page_id::VARCHAR, url, url, html FROM pages""",
        "run_scan": "SELECT id, url, title, text, 3 AS run_id FROM delta",
        "table_overview": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in tables),
        "clean_valid": f"""
            SELECT id AS doc_id, coalesce(url, '') AS url, coalesce(title, '') AS title,
                   {clean('text')} AS cleaned_text, sha256({clean('text')}) AS content_hash,
                   length({clean('text')})::INT AS text_len
            FROM noisy_why WHERE why IS NULL""",
        "clean_rejects": "SELECT * FROM rejects",
        "clean_reject_counts": """
            SELECT reason_code, reason_detail, count(*) AS n_rows FROM rejects GROUP BY ALL""",
        "embedding_input_text": f"""
            SELECT doc_id, '{S.PASSAGE_PREFIX}' || title || ': ' || cleaned_text AS passage
            FROM base_valid""",
        "display_preview": """
            SELECT doc_id, title, text_len, left(content_hash, 12) AS hash_head,
                   left(cleaned_text, 60) || '...' AS text_head
            FROM base_valid ORDER BY text_len DESC, doc_id LIMIT 20""",
        "delta_batch": "SELECT id, url, title, text, part, n FROM delta",
        "delta_preview": f"""
            SELECT d.id, d.title, length(d.text)::INT AS text_len,
                   NOT ({blank('d.text')}) AS has_text, b.id IS NULL AS is_new
            FROM delta d LEFT JOIN base b ON d.id = b.id""",
        "sample_split": f"""
            SELECT n AS n_usable, least(n, 40) AS n_sample, n - least(n, 40) AS n_rest
            FROM (SELECT count(*) AS n FROM base
                  WHERE NOT ({blank('id')}) AND NOT ({blank('text')}))""",
        "scd_dedup_batch": "SELECT doc_id, part, n, content_hash, copies FROM winners",
        "scd_classify": f"""
            SELECT doc_id, content_hash, status,
                   CASE WHEN status = '{S.UPDATED}' THEN 1 END AS closed_valid_from
            FROM statuses""",
        "scd_status_counts": f"""
            SELECT count_if(status = '{S.NEW}')::BIGINT AS new_doc_count,
                   count_if(status = '{S.UPDATED}')::BIGINT AS updated_doc_count,
                   count_if(status = '{S.UNCHANGED}')::BIGINT AS unchanged_doc_count,
                   sum(copies - 1)::BIGINT AS duplicate_doc_count FROM statuses""",
        "changed_documents": f"""
            SELECT doc_id, title, content_hash, text_len, 3 AS source_run_id FROM statuses
            WHERE status <> '{S.UNCHANGED}'""",
        "scd_documents": "SELECT * EXCLUDE (cleaned_text) FROM versions",
        "active_documents": """
            SELECT doc_id, url, title, cleaned_text, content_hash, text_len, source_run_id
            FROM versions WHERE is_active""",
        "scd_chunks": "SELECT * EXCLUDE (chunk_text, content_hash) FROM chunks",
        "scd_embeddings": f"""
            SELECT chunk_id, {DIM} AS embedding_dim, source_run_id, is_active, valid_from_run_id,
                   valid_to_run_id FROM chunks""",
        "scd_history": """
            SELECT v.doc_id, v.content_hash, v.source_run_id, v.is_active, v.valid_to_run_id,
                   c.chunk_id, c.chunk_index
            FROM versions v LEFT JOIN chunks c ON v.doc_id = c.doc_id
             AND v.content_hash = c.content_hash AND v.source_run_id = c.source_run_id""",
        "idempotent_rerun": """
            SELECT 0::BIGINT AS new_doc_count, 0::BIGINT AS updated_doc_count,
                   count(*) AS unchanged_doc_count, 0::BIGINT AS duplicate_doc_count FROM base_valid""",
        "chunk_windows": """
            SELECT chunk_id, doc_id, content_hash, chunk_index, start_tok, end_tok, chunk_text,
                   chunk_token_len, chunk_hash, source_run_id FROM corpus_chunks""",
        "chunk_stats": """
            SELECT chunk_index, count(*) AS n_chunks, sum(chunk_token_len)::BIGINT AS n_tokens,
                   min(chunk_token_len) AS min_tokens, max(chunk_token_len) AS max_tokens
            FROM corpus_chunks GROUP BY chunk_index""",
        "docs_without_chunks": f"""
            SELECT doc_id, source_run_id, len(tokens)::INT AS n_tokens FROM tokenised
            WHERE source_run_id = 1 AND len(tokens) < {S.MIN_CHUNK_TOKENS}""",
        "unembedded_chunks": """
            SELECT c.chunk_id, c.doc_id, c.chunk_index FROM corpus_chunks c
            LEFT JOIN vectors v ON c.doc_id = v.id
            WHERE v.id IS NULL OR c.chunk_index > 0""",
        "asof_chunks": "SELECT run_id, chunk_id, chunk_hash FROM live",
        "asof_checksum": "SELECT run_id, checksum FROM asof_sums",
        "ordered_checksum": """
            SELECT sum(n)::BIGINT AS n_rows, sha256(string_agg(value, '' ORDER BY p)) AS checksum
            FROM (SELECT left(p, 3) AS p, sha256(string_agg(value, '' ORDER BY p)) AS value,
                         sum(n) AS n
                  FROM (SELECT left(h, 6) AS p, sum(n) AS n,
                               sha256(string_agg(h || ':' || n, '' ORDER BY h)) AS value
                        FROM (SELECT chunk_hash AS h, count(*) AS n FROM corpus_chunks GROUP BY h)
                        GROUP BY left(h, 6))
                  GROUP BY left(p, 3))""",
        "run_summary": "SELECT * FROM runs",
        "previous_full_run": "SELECT run_id, active_doc_count FROM runs WHERE run_id = 1",
        "audit_runs": """
            SELECT run_id_a, run_id_b, audit_type, result, details FROM audited
            UNION ALL SELECT 3, 9, 'run_existence', 'FAIL', '{"error":"run_a=ok, run_b=missing"}'
            """,
        "audit_tally": """
            SELECT count_if(result = 'PASS')::BIGINT AS n_pass, count_if(result = 'FAIL')::BIGINT AS n_fail
            FROM audited""",
        "reconciliation": _RECONCILED,
        "reconciliation_stored": _RECONCILED,
        "reconciliation_faults": """
            SELECT raw_documents, clean_documents_active, rejected_documents, active_chunks,
                   active_embeddings, index_vectors, 'FAIL' AS reconciliation_status,
                   json_object('raw', raw_documents, 'clean_active', clean_documents_active,
                       'rejected', rejected_documents, 'chunks', active_chunks,
                       'embeddings', active_embeddings, 'index_vectors', index_vectors)::VARCHAR
                       AS details, 3 AS run_id
            FROM (SELECT raw_doc_count AS raw_documents, active_doc_count AS clean_documents_active,
                         rejected_doc_count AS rejected_documents,
                         active_chunk_count AS active_chunks,
                         (SELECT count(*) FROM chunks WHERE source_run_id = 1 AND is_active)
                             AS active_embeddings,
                         (SELECT count(*) FROM corpus_chunks) AS index_vectors
                  FROM runs WHERE run_id = 3)""",
        "index_registry": f"""
            SELECT run_id, dataset_name, '{S.INDEX_TYPE}' AS index_type, '{S.METRIC}' AS metric,
                   {_NLIST} AS nlist, {S.NPROBE} AS nprobe, index_vector_count AS num_vectors,
                   mode AS build_mode, run_id = 3 AS is_active
            FROM runs""",
        "stage_log": f"""
            SELECT run_id, unnest(['ingest', 'clean', 'curate', 'chunk', 'embed', 'index'])
                       AS stage_name,
                   unnest([raw_doc_count, stg_valid_count, stg_valid_count, new_chunk_count,
                           new_embedding_count, index_vector_count])::BIGINT AS row_count,
                   unnest([json_object('input', input_path)::VARCHAR,
                           json_object('rejected', rejected_doc_count)::VARCHAR,
                           json_object('new_doc_count', new_doc_count,
                               'updated_doc_count', updated_doc_count,
                               'unchanged_doc_count', unchanged_doc_count,
                               'duplicate_doc_count', duplicate_doc_count)::VARCHAR,
                           '{{"tokenizer":"WordTokenizer"}}',
                           '{{"encoder":"hashing-md5-{DIM}"}}',
                           json_object('nlist', {_NLIST})::VARCHAR]) AS details
            FROM runs""",
        "failed_run_scenario": """
            SELECT run_id, mode, status, d AS clean_documents, c AS chunks, c AS embeddings,
                   i AS index_registry, 6 * i AS latency_logs
            FROM (SELECT 1 AS run_id, 'full' AS mode, 'success' AS status, 1::BIGINT AS i,
                         (SELECT count(*) FROM versions WHERE source_run_id = 1) AS d,
                         (SELECT count(*) FROM chunks WHERE source_run_id = 1) AS c
                  UNION ALL SELECT 2, 'augmented', 'failed', 0, 0, 0
                  UNION ALL SELECT 3, 'augmented', 'success', 1,
                         (SELECT count(*) FROM versions WHERE source_run_id = 3),
                         (SELECT count(*) FROM chunks WHERE source_run_id = 3))""",
        "streamed_updates": f"""
            SELECT run_id, 'augmented' AS mode, 'success' AS status, raw_doc_count, new_doc_count,
                   updated_doc_count, unchanged_doc_count, active_doc_count
            FROM (SELECT 1 AS run_id, count(*) AS raw_doc_count, count_if(ok)::BIGINT AS new_doc_count,
                         0::BIGINT AS updated_doc_count, 0::BIGINT AS unchanged_doc_count,
                         count_if(ok)::BIGINT AS active_doc_count FROM redelivered
                  UNION ALL
                  SELECT 2, count(*), count_if(NOT ok AND later <> '')::BIGINT,
                         count_if(ok AND later <> '' AND later <> whole)::BIGINT,
                         count_if(ok AND later = whole)::BIGINT,
                         count_if(ok OR later <> '')::BIGINT FROM redelivered)""",
        "sample_documents": f"""
            SELECT id, url, title, text FROM drawn""",
        "update_batch": f"""
            SELECT id, url, title, text, 'new' AS "case" FROM (
                SELECT * FROM usable WHERE id NOT IN (SELECT id FROM drawn_forty)
                ORDER BY part, n LIMIT 1)
            UNION ALL
            SELECT id, url, title, text || '{REVISION}', 'revised' FROM (
                SELECT * FROM drawn_forty ORDER BY part, n LIMIT 1)
            UNION ALL
            SELECT id, url, title, text, 'duplicate' FROM (
                SELECT * FROM drawn_forty ORDER BY part, n LIMIT 1 OFFSET 1)
            UNION ALL
            SELECT '{CORRUPTED_ID}', '', '{CORRUPTED_TITLE}', '', 'corrupted'""",
        "ivf_train_assign": "SELECT id, true AS is_nearest FROM vectors",
        "ivf_trained_cells": f"""
            SELECT unnest(range(least({S.MAX_CELLS}, greatest({S.MIN_CELLS},
                       n // {S.VECTORS_PER_CELL}), n)))::INT AS cell, true AS is_unit
            FROM (SELECT count(*) AS n FROM vectors)""",
        "knn_certified": _EXACT,
        "two_level_full_probe": _EXACT,
        "two_level_assign": "SELECT id, true AS is_nearest FROM vectors",
        "ivf_recall": "SELECT count(*) AS n_true, true AS is_enough FROM exact",
        "rows_per_run": """
            SELECT 1 AS run_id, count(*) AS n_rows FROM base
            UNION ALL SELECT 2, count(*) FROM base UNION ALL SELECT 3, count(*) FROM delta""",
        "versions_by_activity": """
            SELECT is_active, count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids
            FROM versions GROUP BY is_active""",
        "chunks_by_activity":
            "SELECT is_active, count(*) AS n_rows FROM chunks GROUP BY is_active",
        "active_vs_total": """
            SELECT 'clean_documents' AS table_name, count_if(is_active)::BIGINT AS n_active,
                   count(*) AS n_total FROM versions
            UNION ALL SELECT 'chunks', count_if(is_active)::BIGINT, count(*) FROM chunks""",
        "input_counts": """
            SELECT 'base' AS input, count(*) AS n_lines, count(DISTINCT id) AS n_ids FROM base
            UNION ALL SELECT 'delta', count(*), count(DISTINCT id) FROM delta""",
        "latency_by_run": """
            SELECT run_id, count(*) AS n_stages, round(sum(duration_seconds), 3) AS total_seconds
            FROM stage_log GROUP BY run_id""",
        "latest_run_latency": """
            SELECT run_id, stage_name, start_time, duration_seconds FROM stage_log
            WHERE run_id = (SELECT max(run_id) FROM (
                SELECT run_id, arg_max(stage_name, start_time) AS last FROM stage_log
                GROUP BY run_id) WHERE last <> 'error')""",
        "vector_normalise": """
            SELECT id, pos::INT - 1 AS pos, round((x / norm)::FLOAT::DOUBLE, 6) AS x
            FROM (SELECT id, generate_subscripts(w, 1) AS pos, unnest(w) AS x,
                         sqrt(list_dot_product(w, w)) AS norm
                  FROM (SELECT id, list_transform(v, lambda x: (x * (label + 1))::FLOAT::DOUBLE)
                                   AS w FROM vectors))""",
        "feature_hash_embed": """
            SELECT key AS id, slot::INT AS pos, round(x, 6) AS x FROM hashed
            WHERE kind = 'p' AND round(x, 6) <> 0""",
        "vector_hashes": "SELECT id, embedding_hash FROM vector_hash",
        "embedding_gather": f"""
            SELECT v.id AS doc_id, 3 AS source_run_id, round(v.v[len(v.v)], 6) AS first_x,
                   round(list_dot_product(v.v, v.v), 6) AS norm
            FROM vectors v JOIN statuses s ON v.id = s.doc_id WHERE s.status = '{S.UPDATED}'
            UNION ALL
            SELECT v.id, 1, round(v.v[1], 6), round(list_dot_product(v.v, v.v), 6)
            FROM vectors v
            LEFT JOIN statuses s ON v.id = s.doc_id AND s.status = '{S.UPDATED}'
            WHERE s.doc_id IS NULL""",
        "knn_exact": _EXACT,
        "ivf_full_probe": _EXACT,
        "ivf_assign": "SELECT id, cell FROM assigned",
        "ivf_cell_sizes": "SELECT cell, count(*) AS n_vectors FROM assigned GROUP BY cell",
        "ivf_centroid_update": """
            SELECT cell, pos::INT - 1 AS pos, round(avg(x), 6) AS x
            FROM (SELECT cell, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM assigned)
            GROUP BY cell, pos""",
        "ivf_search": "SELECT query_id, id, rank, score FROM probed",
        "index_roundtrip": """
            SELECT a.id AS chunk_id, a.cell, h.embedding_hash,
                   round(list_dot_product(a.v, a.v), 6) AS norm
            FROM assigned a JOIN vector_hash h ON a.id = h.id""",
        "index_checksum": f"""
            SELECT count(*) AS n_rows, {digest('h')} AS digest
            FROM (SELECT sha256(a.id || '|' || a.cell || '|' || h.embedding_hash) AS h
                  FROM assigned a JOIN vector_hash h ON a.id = h.id)""",
        "retrieve_exact": _RETRIEVED,
        "retrieve_indexed": _RETRIEVED,
        "three_run_scenario": f"""
            SELECT run_id, mode, dataset_name, input_path, status, {_COUNTS} FROM runs""",
        "retrieval_eval": """
            SELECT * EXCLUDE (reciprocal_rank), round(reciprocal_rank, 6) AS reciprocal_rank
            FROM evaluated""",
        "retrieval_metrics": """
            SELECT count(*) AS n_queries, round(avg(hit), 6) AS hit_rate, round(avg(rr), 6) AS mrr
            FROM (SELECT query_id, max(hit_at_k::INT) AS hit, max(reciprocal_rank) AS rr
                  FROM evaluated GROUP BY query_id)""",
    }
    return {name: sql(select) for name, select in selects.items()}
