"""The queries of the training-data operators and their SQL, where SQL can express one."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    backoff_lm, chat_trees, collocations, conversation_repair, exact_dedup, language_id, merkle,
    ngram_jaccard, packing, prefix_bpe, quality_rules, token_files, tokens, url_filter)
from corpusloom.llm.shared import small_batches
from corpusloom.sources import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(body):
    QUERIES[body.__name__] = body
    return body


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents")).select(
        "doc_id", F.col("keep_key").alias("keep_id"), "group_size", "kept",
        F.col("normalised_sha256").alias("text_sha256"))


SQL["op1_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents),
groups AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM texts JOIN groups USING (norm)
"""

# A conversation whose texts hold control strings.
TRICKY_ID, TRICKY = -7, r"\### Assistant: </turn> ok"


@query
def op2_chat_trees(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(TRICKY_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"))
    paths = chat_trees.format_paths(chat_trees.thread_messages(rows.unionByName(tricky)))
    read = paths.select(
        F.col("tree").alias("conv_id"), "formatted",
        chat_trees.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat_trees.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    flat = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL["op2_chat_trees"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *,
    replace(replace(replace(replace(role, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn'),
            '>', '\g') AS marked_role,
    replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn') AS marked
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length(marked_role) + length(marked) + 16) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

# Host rules as (verdict, host, path).
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"),
         ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


@query
def op6_url_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge_url("url", RULES).alias("j")
    return table(spark, folder, "pages").select("page_id", judged).select(
        "page_id", "j.host", "j.path", "j.rule", "j.verdict")


def _url_sql() -> str:
    u = url_filter
    terms = ", ".join(f"('{t}', '{kind}', {weight})" for t, kind, weight in u.VOCABULARY)
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return rf"""
WITH split AS (
  SELECT page_id, url,
    translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      AS lowered,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES {rules}),
fits AS (
  SELECT page_id, max_by(struct_pack(rule := rule_host || rule_path, verdict := r.verdict),
                         length(rule_host || rule_path)) AS best
  FROM split JOIN rules r
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id),
vocabulary(term, kind, weight) AS (VALUES {terms}),
hits AS (
  SELECT page_id, count_if(kind = '{u.STRICT}') AS strict, count_if(kind = '{u.SOFT}') AS soft,
    coalesce(sum(weight) FILTER (kind = '{u.SOFT}'), 0) AS together
  FROM split JOIN vocabulary ON contains(lowered, term)
    AND regexp_matches(lowered, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)')
  GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.verdict, CASE WHEN strict > 0 OR soft >= {u.MIN_SOFT} AND together >= {u.SOFT_BOUND}
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM split LEFT JOIN fits USING (page_id) LEFT JOIN hits USING (page_id)
"""


SQL["op6_url_vocabulary"] = _url_sql()


def piece_encoder(spark: SparkSession, path: str, **options):
    """encode(text) for tasks; the tokenizer file travels from the driver in a broadcast."""
    shared = spark.sparkContext.broadcast(tokens.PieceEncoder(tokens.read_file(path), **options))
    return lambda text: shared.value.encode(text)


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    encode = piece_encoder(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(table(spark, folder, "documents"), encode, end_id=0).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@query
def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    encode = piece_encoder(spark, public_tokenizers.path("byte_bpe_50k.json"))
    out = scratch.held_folder(spark, "token-files")
    token_files.write_token_files(
        table(spark, folder, "documents"), out, encode, end_id=2, vocabulary=50_257)
    return token_files.read_token_files(spark, out).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op10_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    encoder = prefix_bpe.PrefixEncoder(
        prefix_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        public_tokenizers.PATTERN)
    return prefix_bpe.encode_and_decode(table(spark, folder, "documents"), encoder).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _kept_from_training() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", _kept_from_training())
    model = language_id.fit(docs.filter("NOT held_out"))
    return language_id.identify(docs, model, F.col("text")).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op3_merkle_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.compare_edits(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next")


@query
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    small_batches(spark)
    return ngram_jaccard.jaccard_components(table(spark, folder, "documents")).select(
        "doc_id", F.col("n_grams").alias("n_shingles"), F.col("component").alias("component_id"))


# Pairs are found by a common shingle and counted in full, which is affordable on small tables.
SQL["op4_ngram_jaccard"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS s
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT b, root FROM reached JOIN ends ON a = doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, min(root) AS component_id
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id, n
"""


@query
def op7_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    scored = backoff_lm.score_texts(table(spark, folder, "documents"), ~held_out)
    return scored.select(
        "doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with a fault set by a checksum of their place: lost, emptied, cut, repeated, mistaken."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), space))
    fault = F.col("fault")
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), (F.crc32(place) % 20).alias("fault"),
    ).filter(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(
            F.col("text")).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
    ).drop("col")


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(damaged(conversations))
    audits = conversation_repair.audits_and_digests(repaired.edits)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def shaped(df: DataFrame, key: str) -> DataFrame:
        return df.select(F.col(key).alias("conv_id"), *[
            F.col(c) if c in df.columns else F.lit(None).cast("string" if c not in counts else "long").alias(c)
            for c in [*counts, "audit", "repaired_sha256"]])

    parts = shaped(conversations, "conv_id").unionByName(
        shaped(repaired.summary, "conversation")).unionByName(shaped(audits, "conversation"))
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@query
def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


SQL["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
      lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM words, range(1, 4) AS sizes(size))
  GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT lang, phrase, size, f AS a, k, string_split(phrase, ' ') AS w
  FROM counts, range(1, 3) AS ks(k) WHERE size > k),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
best AS (
  SELECT lang, phrase, a, l, r, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, array_to_string(w[k:k + 1], ' ') AS phrase, max(a) AS within
  FROM cuts WHERE size = 3 GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang)
WHERE coalesce(100 * within < 50 * a, true)
QUALIFY rank <= 2000
"""


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def _quality_sql() -> str:
    q = quality_rules
    values = ", ".join(f"({n}, 1000 * {r.top} // {r.bottom})" for n, r in enumerate(q.RULES))
    spreads = " ".join(f"WHEN {n} THEN {r.spread}" for n, r in enumerate(q.RULES))
    both = ", ".join(str(n) for n, r in enumerate(q.RULES) if r.both_sides)
    return rf"""
WITH split AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE times > 1) GROUP BY doc_id),
measures AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (doc_id)),
judged AS (
  SELECT *, n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED_PERCENT} * n_words
    AS base_failed
  FROM measures),
ratios AS (
  SELECT doc_id, lang, source, u.rule, u.exact
  FROM judged, LATERAL (VALUES {values}) AS u(rule, exact) WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, rule, (exact >> s) << s AS value FROM (
    SELECT *, greatest(0, length(bin(exact)) - {q.SKETCH_BITS}) AS s FROM ratios)),
fences AS (
  SELECT level, lang, source, rule, count(*) AS texts,
    quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
  FROM (SELECT 0 AS level, lang, source, rule, value FROM sketch
        UNION ALL SELECT 1, lang, NULL, rule, value FROM sketch
        UNION ALL SELECT 2, NULL, NULL, rule, value FROM sketch)
  GROUP BY ALL),
chosen AS (
  SELECT r.doc_id, r.rule, r.exact, f.q1, f.q3,
    {q.REACH} * greatest(f.q3 - f.q1, CASE r.rule {spreads} END) AS reach
  FROM ratios r JOIN fences f ON f.rule = r.rule AND (
    (f.level = 0 AND f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source)
    OR (f.level = 1 AND f.lang IS NOT DISTINCT FROM r.lang) OR f.level = 2)
  WHERE f.texts >= {q.LEAST_TEXTS} OR f.level = 2
  QUALIFY row_number() OVER (PARTITION BY r.doc_id, r.rule ORDER BY f.level) = 1),
broken AS (
  SELECT DISTINCT doc_id FROM chosen
  WHERE exact > q3 + reach OR (rule IN ({both}) AND exact < q1 - reach))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM judged
"""


SQL["op13_quality_rules"] = _quality_sql()
