"""Parameters that are part of the results."""

# Window geometry in tokens.
CHUNK_TOKENS = 384
OVERLAP_TOKENS = 64
STRIDE_TOKENS = 320
MIN_CHUNK_TOKENS = 32

# Prefixes put before a text when it is encoded.
PASSAGE_PREFIX = "passage: "
QUERY_PREFIX = "query: "

# The default neural encoder.
EMBEDDING_MODEL = "intfloat/e5-base-v2"
EMBEDDING_DIM = 768

# Index geometry and labels.
MAX_CELLS = 100
MIN_CELLS = 4
VECTORS_PER_CELL = 10
NPROBE = 10
# An index takes further parts while all that they added and closed is at most this share of the
# vectors it was built over, and up to so many; then it is built anew.
ADDED_SHARE = 0.1
MOST_PARTS = 16
INDEX_TYPE = "IVFFlat"
METRIC = "INNER_PRODUCT"

# Batch sizes and seed.
INGEST_BATCH_ROWS = 500
ENCODE_BATCH_ROWS = 32
SEED = 42

# Digits of a chunk's id that name its folder.
PREFIX_DIGITS = 2

# Hash buckets of the current keys: about so many keys each, within these bounds.
KEYS_PER_BUCKET = 20_000
MIN_KEY_BUCKETS = 8
MAX_KEY_BUCKETS = 1 << 16
# A corpus gets more buckets when it is due this many times those it has.
OUTGROWN = 4

# The sketch of known ids: bits for each id there is room for, and that room at the first build.
SKETCH_BITS_PER_ID = 16
SKETCH_ROOM = 8
MIN_SKETCH_WORDS = 1 << 10

# Reject reasons and document statuses.
MISSING_ID = "MISSING_ID"
EMPTY_TEXT = "EMPTY_TEXT"
DETAIL_MISSING_ID = "id is empty"
DETAIL_EMPTY_TEXT = "text is empty or None after strip"
DETAIL_EMPTY_CLEANED = "text is empty after cleaning"
NEW = "NEW"
UPDATED = "UPDATED"
UNCHANGED = "UNCHANGED"
SNAPSHOT_CHARS = 500

# Share of the true neighbours that a search over the index has to find. The fixed number of
# probes does not reach it on vectors without clusters, so probes are chosen by measurement when an
# index is built: on the neighbours of so many stored vectors, with a share somewhat higher, as
# other vectors may fare worse.
LEAST_RECALL = 0.9
AIMED_RECALL = 0.95
RECALL_VECTORS = 256
RECALL_NEIGHBOURS = 10

# Scores are compared after rounding to this many decimals, so that equal vectors tie
# whatever the summation order of the machine that scored them.
SCORE_DECIMALS = 9

# Queries travel to the corpus in blocks of about this many bytes, their hits included.
QUERY_BLOCK_BYTES = 32 << 20
