"""Document fingerprints: a Merkle tree over sections, paragraphs and their pieces.

A paragraph is a line, cut into pieces of some words; a section is a run of paragraphs, closed by
an empty one or by what its last paragraph hashes to, so that an edit moves no section border
behind it. Each node hashes its children. Equal roots mean equal texts; below unequal roots only
unequal branches need a look.
"""

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import blocks_for

# Pieces have 24 to 96 characters and end at white space where there is some.
_PIECE = re.compile(r"(?s).{24,95}?(?:\s|\Z)|.{96}|.+")
_LINE = re.compile(r"[^\n]*\n|[^\n]+")
SECTION_EVERY = 4
RANGE_BYTES = 32 << 20
BATCH_CHARS = 4 << 20


def _hash(level: bytes, content: bytes, size: int = 16) -> bytes:
    return blake2b(content, digest_size=size, person=level).digest()


@dataclass(frozen=True)
class Tree:
    """root is the hex hash of all; sections hold paragraphs, those hold (hash, length) pieces."""

    root: str
    sections: tuple[tuple[tuple[tuple[str, int], ...], ...], ...]

    @classmethod
    def of(cls, text: str) -> "Tree":
        sections, hashes, paragraphs, below = [], [], [], []

        def close():
            sections.append(tuple(paragraphs))
            hashes.append(_hash(b"section", b"".join(below)))
            paragraphs.clear(), below.clear()

        for line in _LINE.findall(text):
            pieces = _PIECE.findall(line)
            leaves = [_hash(b"piece", p.encode("utf-8", "surrogatepass")) for p in pieces]
            paragraphs.append(tuple((h[:4].hex(), len(p)) for h, p in zip(leaves, pieces)))
            below.append(_hash(b"paragraph", b"".join(leaves)))
            if line == "\n" or below[-1][0] % SECTION_EVERY == 0:
                close()
        if paragraphs:
            close()
        return cls(_hash(b"root", b"".join(hashes), 32).hex(), tuple(sections))

    def fingerprint(self) -> str:
        """root:section/section, a section being paragraph.paragraph, that 8 digits of hash and
        2 of length per piece."""
        return f"{self.root}:" + "/".join(
            ".".join("".join(f"{h}{n:02x}" for h, n in pieces) for pieces in section)
            for section in self.sections)

    @classmethod
    def read(cls, fingerprint: str) -> "Tree":
        root, _, rest = fingerprint.partition(":")
        return cls(root, tuple(
            tuple(tuple((p[i:i + 8], int(p[i + 8:i + 10], 16)) for i in range(0, len(p), 10))
                  for p in section.split(".")) for section in rest.split("/")) if rest else ())


def likeness(a: Tree, b: Tree) -> float:
    """The characters in pieces that both have, of the characters of both: 1 for equal roots.

    Equal sections count as a whole and are left, then equal paragraphs of the others, then equal
    pieces of what remains, so only unequal branches are entered.
    """
    if a.root == b.root:
        return 1.0
    total = sum(_size(s, 2) for tree in (a, b) for s in tree.sections)
    left, right, both = Counter(a.sections), Counter(b.sections), 0
    for depth in (2, 1, 0):
        common = left & right
        both += sum(n * _size(node, depth) for node, n in common.items())
        left, right = left - common, right - common
        if depth:
            left, right = (Counter(c for node in nodes.elements() for c in node)
                           for nodes in (left, right))
    return 2 * both / total if total else 0.0


def differences(a: Tree, b: Tree) -> tuple[tuple[int, int], tuple[int, int]] | None:
    """The span of characters (from, to) of each text that holds all edits; None for equal texts.

    Equal branches are passed from both ends: sections, then paragraphs, then pieces.
    """
    if a.root == b.root:
        return None
    left, right = list(a.sections), list(b.sections)
    start = end = 0
    for level in range(3):
        depth = 2 - level
        while left and right and left[0] == right[0]:
            start += _size(left[0], depth)
            del left[0], right[0]
        while left and right and left[-1] == right[-1]:
            end += _size(left[-1], depth)
            del left[-1], right[-1]
        if level < 2:
            left, right = [x for n in left for x in n], [x for n in right for x in n]
    return ((start, start + sum(_size(n, 0) for n in left)),
            (start, start + sum(_size(n, 0) for n in right)))


def _size(node, depth: int) -> int:
    return node[1] if depth == 0 else sum(_size(child, depth - 1) for child in node)


def with_next(df: DataFrame, key: str, text: str, body: Callable, result: T.StructType,
              range_bytes: int = RANGE_BYTES) -> DataFrame:
    """body(key, text, next text, carried) for every row and the row after it by key.

    Order is by key, null first, then by a hash of the text and the text; the last row's next is
    the first. Rows are dealt into ranges of keys; the first row of a range is also sent, as a
    guest, to the range before it, so a range is read once in order and texts move once. The
    borders are one key per range. ``body`` returns (row of result, what to carry to the next).
    """
    rows = df.select(df[f"`{key}`"].alias("key"), df[f"`{text}`"].alias("text")).withColumn(
        "tie", F.xxhash64("text"))
    ranges = blocks_for(rows, "text", range_bytes)
    borders = sorted(_rank(r.low.key, r.low.tie) for r in (
        rows.select("key", "tie").repartitionByRange(ranges, "key", "tie")
        .groupBy(F.spark_partition_id()).agg(F.min(F.struct("key", "tie")).alias("low")).collect()))

    @F.udf("array<struct<part: int, guest: boolean>>", useArrow=True)
    def deal(key, tie):
        rank = _rank(key, tie)
        part = bisect_right(borders, rank) - 1
        places = [(part, False)]
        if borders[part] == rank:
            places.append(((part - 1) % len(borders), True))
        return places

    dealt = (
        rows.withColumn("place", F.explode(deal("key", "tie")))
        .select("place.part", "place.guest", "key", "tie", "text")
        .repartitionById(max(1, len(borders)), "part")
        .sortWithinPartitions("part", "guest", "key", "tie", "text"))
    names = result.names

    def walk(batches) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(result)
        held, before, carried, size, closed = [], None, None, 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                part, guest, own_key, _, own_text = row
                if guest and part == closed:
                    continue
                if before is not None and before[0] == part:
                    done, carried = body(before[1], before[2], own_text, carried)
                    held.append(dict(zip(names, done)))
                    size += len(before[2] or "")
                else:
                    carried = None
                before, closed = ((None, part) if guest else ((part, own_key, own_text), None))
                if size >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return dealt.mapInArrow(walk, result)


def _rank(key, tie: int) -> tuple:
    return (key is not None, key if key is not None else 0, tie)


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by the first as many code points of the other."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and likenesses.

    The columns are key, n_chars, edited (the text), fingerprint, edited_fingerprint, near_edited,
    near_next, and edit_start, edit_end: the span of the text outside which nothing changed (null
    if nothing did). A null text is empty; a long one is read by one task. Rows with equal or null
    keys are documents of their own, so are repeated rows. Other columns are not looked at. An empty table gives no rows.
    """
    result = (T.StructType().add("key", df.schema[key].dataType).add("n_chars", T.LongType())
              .add("edited", T.StringType()).add("fingerprint", T.StringType())
              .add("edited_fingerprint", T.StringType()).add("near_edited", T.DoubleType())
              .add("near_next", T.DoubleType()).add("edit_start", T.LongType())
              .add("edit_end", T.LongType()))

    def compare(own_key, own, following, carried):
        own, following = own or "", following or ""
        tree, next_tree = carried or Tree.of(own), Tree.of(following)
        changed = edited(own, following)
        changed_tree = Tree.of(changed)
        span = differences(tree, changed_tree)
        start, end = span[0] if span else (None, None)
        return (own_key, len(own), changed, tree.fingerprint(), changed_tree.fingerprint(),
                likeness(tree, changed_tree), likeness(tree, next_tree), start, end), next_tree

    return with_next(df, key, text, compare, result).withColumnRenamed("key", key)
