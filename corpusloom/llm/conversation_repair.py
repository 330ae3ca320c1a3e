"""Conversations repaired at least cost, with an audit of every edit.

Roles have to read: nothing, or an optional system turn and then user and assistant in turn. A
dynamic programme over this grammar takes the cheapest edits, and of equally cheap ones the
audit, the string of their initials, that is least in ASCII order.

* Audits are persistent: each is a linked node after the audit it extends, so all candidates share
  their common beginnings. A node has a rolling hash and its ancestors at powers of two. Ties are
  settled by a search for the longest common prefix; hashes that agree are verified on the letters.
* A conversation is cut into segments of bounded size. A segment gives its best audit for each
  state it may be entered and left in; all of its audits hold one edit a row and end in one, so
  none is the beginning of another and their ranks stand for them. A second programme of the same
  kind over the ranks of a conversation's segments picks one audit of each.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import blocks_for, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
# States of the grammar: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
# What a row needs: nothing, a cost if it stays, or to be deleted.
SOUND, TRUNCATED, UNFIT = range(3)
SPACES = "\x20\t\n\x0b\x0c\r"
SEGMENT_ROWS = 4096
PART_BYTES = 8 << 20
MODULUS, BASE = (1 << 61) - 1, 1_000_003


class Audit:
    """A letter after an audit; ``ups[k]`` is the audit 2^k letters before."""

    __slots__ = ("letter", "depth", "hash", "ups", "twin")

    def __init__(self, letter: int, depth: int, hashed: int, ups: list["Audit"]):
        self.letter, self.depth, self.hash, self.ups, self.twin = letter, depth, hashed, ups, None

    def before(self, depth: int) -> "Audit":
        """The first ``depth`` letters."""
        node = self
        while node.depth > depth:
            node = node.ups[(node.depth - depth).bit_length() - 1]
        return node

    def letters(self) -> list[int]:
        found, node = [], self
        while node.depth:
            found.append(node.letter)
            node = node.ups[0]
        return found[::-1]


EMPTY = Audit(0, 0, 0, [])


class Audits:
    """Extends and compares audits; a smaller modulus only makes more hashes collide."""

    def __init__(self, modulus: int = MODULUS):
        self.modulus = modulus

    def extend(self, node: Audit, letters: Iterable[int]) -> Audit:
        for letter in letters:
            ups = [node]
            while len(ups[-1].ups) >= len(ups):
                ups.append(ups[-1].ups[len(ups) - 1])
            node = Audit(letter, node.depth + 1, (node.hash * BASE + letter + 1) % self.modulus, ups)
        return node

    @staticmethod
    def _first_twin(node: Audit) -> Audit:
        while node.twin is not None:
            node = node.twin
        return node

    def same(self, a: Audit, b: Audit) -> bool:
        """Whether two audits of one length agree: by hash, then letter by letter back to where
        they are one node or were found equal before."""
        if a is b:
            return True
        if a.hash != b.hash:
            return False
        passed = []
        while (a := self._first_twin(a)) is not (b := self._first_twin(b)):
            if a.letter != b.letter:
                return False
            passed.append((a, b))
            a, b = a.ups[0], b.ups[0]
        for a, b in passed:
            a.twin = b
        return True

    def less(self, a: Audit, b: Audit) -> bool:
        depth = min(a.depth, b.depth)
        x, y = a.before(depth), b.before(depth)
        if self.same(x, y):
            return a.depth < b.depth
        for k in reversed(range(len(x.ups))):
            if k < len(x.ups) and not self.same(x.ups[k], y.ups[k]):
                x, y = x.ups[k], y.ups[k]
        return x.letter < y.letter

    def cheapest(self, candidates: list[tuple[int, Audit, list[int]]]) -> tuple[int, Audit]:
        """The least of (cost, audit, letters to add), as (cost, audit)."""
        least = min(cost for cost, *_ in candidates)
        best = None
        for cost, node, letters in candidates:
            if cost == least:
                node = self.extend(node, letters)
                if best is None or self.less(node, best):
                    best = node
        return least, best


def next_role(state: int) -> int:
    """The role that may follow besides system: user, or assistant after user."""
    return ASSISTANT if state == USER else USER


def _moves() -> dict[tuple[str, int], list[tuple[int, int, list[int], int]]]:
    """(entered, left, letters, cost) for each (initial, need) of a row: inserts, then its edit.

    Rows to delete take no insert before them: behind them it costs the same and comes later.
    """
    found = {}
    for initial in ("s", "u", "a", ""):
        for need in (SOUND, TRUNCATED, UNFIT):
            best = {}
            for entered in range(4):
                options = [(DELETE_COST, DELETE, entered)]
                state = entered
                for inserts in range(3 if need != UNFIT else 0):
                    before, cost = INSERT * inserts, INSERT_COST * inserts + need * TRUNCATED_COST
                    follows = next_role(state)
                    if initial == "s" and state == START:
                        options.append((cost, before + KEEP, SYSTEM))
                    if initial == (".", ".", "u", "a")[follows]:
                        options.append((cost, before + KEEP, follows))
                    options.append((cost + REROLE_COST, before + REROLE, follows))
                    state = follows
                for cost, letters, left in options:
                    if (entered, left) not in best or (cost, letters) < best[entered, left]:
                        best[entered, left] = cost, letters
            found[initial, need] = [
                (entered, left, [ord(x) for x in letters], cost)
                for (entered, left), (cost, letters) in best.items()]
    return found


MOVES = _moves()
# State left -> (cost, letters) of the inserts that end a conversation.
ENDINGS = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT_COST, INSERT),
           SYSTEM: (2 * INSERT_COST, 2 * INSERT)}


def segment_audits(rows: list[tuple[str, int]], entered: int, audits: Audits) -> dict[int, tuple[int, str]]:
    """State left -> (cost, audit) of the cheapest edits of rows (initial, need)."""
    best = {entered: (0, EMPTY)}
    for initial, need in rows:
        options = {}
        for state, left, letters, cost in MOVES[initial if initial in ("s", "u", "a") else "", need]:
            if state in best:
                before, node = best[state]
                options.setdefault(left, []).append((before + cost, node, letters))
        best = {left: audits.cheapest(found) for left, found in options.items()}
    return {left: (cost, "".join(map(chr, node.letters()))) for left, (cost, node) in best.items()}


def join_segments(segments: list[dict[tuple[int, int], tuple[int, int]]],
                  audits: Audits) -> tuple[int, list[tuple[int, int]], str]:
    """(cost, states entered and left of each segment, inserts at the end).

    A segment maps (entered, left) to (cost, rank of its audit).
    """
    best = {START: (0, EMPTY)}
    for segment in segments:
        options = {}
        for (entered, left), (cost, rank) in segment.items():
            if entered in best:
                before, node = best[entered]
                options.setdefault(left, []).append((before + cost, node, [rank]))
        best = {left: audits.cheapest(found) for left, found in options.items()}
    ended = {left: (cost + ENDINGS[left][0], node) for left, (cost, node) in best.items()}
    cost, node = audits.cheapest([(cost, node, []) for cost, node in ended.values()])
    last = next(left for left, end in ended.items() if end == (cost, node))
    state, path = START, []
    for segment, rank in zip(segments, node.letters()):
        left = next(b for (a, b), (_, r) in segment.items() if a == state and r == rank)
        path.append((state, left))
        state = left
    return cost, path, ENDINGS[last][1]


@dataclass
class Repaired:
    """``edits``: conversation, part, place (in order by these two), edit, role, text; a deleted row
    is there with edit D. ``summary``: a row per conversation that has rows."""

    edits: DataFrame
    summary: DataFrame


def _is_blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def _in_order(df: DataFrame, key: str, turn: str, role: str, text: str,
              part_bytes: int) -> DataFrame:
    """conversation, turn, role, text in (part, row) order, written.

    Long conversations span parts, and so do many copies of one row: the last range key tells
    copies apart.
    """
    def named(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    rows = df.select(F.col(f"`{key}`").alias("conversation"), F.col(f"`{turn}`").alias("turn"),
                     named(role).alias("role"), named(text).alias("text"))
    order = ["conversation", "turn", "role", "head", "digest", "tie"]
    dealt = rows.select(
        "*", F.left("text", F.lit(32)).alias("head"), F.xxhash64("text").alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
    ).repartitionByRange(blocks_for(rows, "text", part_bytes), *order).sortWithinPartitions(*order)
    return written(dealt.select(
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"),
        "conversation", "turn", "role", "text"), "turns")


def _needs(turns: DataFrame, parts: int) -> DataFrame:
    """part, row, conversation, turn, initial, need, fault; in order within their parts."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    told = turns.select(
        "part", "row", "conversation", "turn", "role", F.left("role", F.lit(1)).alias("initial"),
        F.when(_is_blank(F.col("text")), "blank").when(
            ~last.isin(".", "!", "?"), "truncated").alias("fault"),
        F.sha2("text", 256).alias("digest"))
    # Of equal role and text the first is no duplicate; positions are unique, so no key is hot.
    first = told.filter("fault IS NULL OR fault <> 'blank'").groupBy(
        "conversation", "role", "digest").agg(F.min(F.struct("part", "row")).alias("at")).select(
        "at.part", "at.row", F.lit(True).alias("first"))
    fault = F.when(F.col("fault") == "blank", "blank").when(
        F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))
    need = F.when(fault == "truncated", TRUNCATED).when(fault.isNotNull(), UNFIT).otherwise(SOUND)
    return written(told.join(first, ["part", "row"], "left").select(
        "part", "row", "conversation", "turn", "initial", need.alias("need"), fault.alias("fault"),
    ).repartitionById(parts, "part").sortWithinPartitions("part", "row"), "needs")


def _runs(rows: Iterable[tuple], of: int, most: int) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows that agree in their first columns, a bounded number of them."""
    for agree, run in groupby(rows, key=lambda r: r[:of]):
        held = []
        for row in run:
            held.append(row)
            if len(held) == most:
                yield agree, held
                held = []
        if held:
            yield agree, held


def _tuples(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batched(rows: Iterable[tuple], schema, size: int = 4096) -> Iterator:
    import pyarrow as pa

    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _mapped(df: DataFrame, body, schema: str) -> DataFrame:
    """Rows as tuples through ``body``, as a stream."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: _batched(body(_tuples(batches)), arrow), schema)


def _lawful(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _segments(needs: DataFrame, kind: str, most: int) -> DataFrame:
    """A row per segment and pair of states: cost, audit and its rank among those of the segment."""
    def search(rows):
        audits, known = Audits(), object()
        part, segment, begun = None, 0, 0
        for (at, conversation), run in _runs(rows, 2, most):
            if at != part:
                part, segment, begun, known = at, 0, 0, conversation
            # Only the first conversation of a part may have begun before, or one cut here.
            entries = range(4) if not begun or known == conversation else [START]
            begun, known = 1, conversation
            turns = [(r[3], r[4]) for r in run]
            found = {(a, b): best for a in entries
                     for b, best in segment_audits(turns, a, audits).items()}
            ranks = {x: n for n, x in enumerate(sorted({x for _, x in found.values()}))}
            illegal = sum(not _lawful(a[0], b[0]) for a, b in zip(turns, turns[1:]))
            for (a, b), (cost, audit) in found.items():
                yield (part, segment, run[0][2], conversation, a, b, cost, ranks[audit], audit,
                       illegal, turns[0][0], turns[-1][0])
            segment += 1

    return written(_mapped(
        needs.select("part", "conversation", "row", "initial", "need"), search,
        f"part int, segment int, row long, conversation {kind}, entered int, left int, cost long, "
        "rank int, audit string, illegal long, first string, last string"), "segments")


def _joined(segments: DataFrame, kind: str) -> DataFrame:
    """The states chosen for each segment, with the cost and illegal pairs of a conversation on
    the row of its last segment."""
    def join(rows):
        for conversation, run in groupby(rows, key=lambda r: r[0]):
            options, facts = [], []
            for at, entries in groupby(run, key=lambda r: r[1:3]):
                entries = list(entries)
                options.append({(r[3], r[4]): (r[5], r[6]) for r in entries})
                facts.append((*at, *entries[0][7:]))
            cost, path, tail = join_segments(options, Audits())
            illegal = sum(f[2] for f in facts) + sum(
                not _lawful(a[4], b[3]) for a, b in zip(facts, facts[1:]))
            for n, (fact, states) in enumerate(zip(facts, path), 1):
                end = n == len(facts)
                yield (conversation, *fact[:2], *states, tail if end else "",
                       cost if end else None, illegal if end else None)

    narrow = segments.select("conversation", "part", "segment", "entered", "left", "cost", "rank",
                             "illegal", "first", "last")
    return written(_mapped(
        narrow.repartition("conversation").sortWithinPartitions("conversation", "part", "segment"),
        join, f"conversation {kind}, part int, segment int, entered int, left int, tail string, "
        "cost long, illegal long"), "joined")


def _edits(turns: DataFrame, segments: DataFrame, joined: DataFrame, parts: int,
           kind: str) -> DataFrame:
    """Every edit of every row; a part's segments are met before their rows."""
    at = ["part", "segment", "entered", "left"]
    chosen = segments.select(*at, "row", "conversation", "audit").join(
        joined.select(*at, "tail"), at).select(
        "part", "row", "conversation", "entered", F.concat("audit", "tail").alias("audit"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = turns.select("part", "row", "conversation", F.lit(None).cast("int").alias("entered"),
                        F.lit(None).cast("string").alias("audit"), "role", "text")
    met = chosen.unionByName(rows).repartitionById(parts, "part").sortWithinPartitions(
        "part", "row", F.col("audit").isNull())

    def edit(rows):
        names = {USER: "user", ASSISTANT: "assistant"}
        audit, at, place, state, of = "", 0, 0, START, None
        for part, _, conversation, entered, own, role, text in rows:
            if own is not None:
                place = place if of == (part, conversation) else 0
                audit, at, state, of = own, 0, entered, (part, conversation)
                last = len(own.rstrip(INSERT))
                continue
            done = False
            while not done or last <= at < len(audit):
                letter = audit[at]
                at, place = at + 1, place + 1
                done = done or letter != INSERT
                if letter == DELETE:
                    shown = role, text
                elif letter == KEEP:
                    state = SYSTEM if role[:1] == "s" else next_role(state)
                    shown = role, text
                else:
                    state = next_role(state)
                    shown = names[state], "" if letter == INSERT else text
                yield (conversation, part, place, letter, *shown)

    return written(_mapped(met, edit, f"conversation {kind}, part int, place long, edit string, "
                           "role string, text string"), "edits")


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", part_bytes: int = PART_BYTES,
           segment_rows: int = SEGMENT_ROWS) -> Repaired:
    """Cheapest edits of each conversation (rows with equal key), taken by turn, nulls first.

    Rows of equal turn are ordered by role, the head of their text and a hash of it; copies are
    adjacent. Faults: blank (no character but white space), duplicate (role and text seen before),
    truncated (last character but white space is none of ``.!?``); a row has its first one. Blank
    rows and duplicates are deleted. Null roles and texts are empty ones; rows with a null key are
    one conversation. An empty table gives no rows. Texts may be long: they only move, a row at a
    time. Other columns are not looked at, whatever their names.

    ``summary``: conversation, gaps (whole turn numbers missing between the least and the greatest),
    blank, duplicate, truncated, illegal (neighbours that are not system-user, user-assistant or
    assistant-user by initials), cost.
    """
    turns = _in_order(df, key, turn, role, text, part_bytes)
    kind = turns.schema["conversation"].dataType.simpleString()
    parts = (turns.agg(F.max("part")).first()[0] or 0) + 1
    needs = _needs(turns, parts)
    segments = _segments(needs, kind, segment_rows)
    joined = _joined(segments, kind)
    counted = needs.groupBy("conversation").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
        .cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name)
          for name in ("blank", "duplicate", "truncated")])
    ended = joined.filter("cost IS NOT NULL").select("conversation", "illegal", "cost")
    summary = counted.join(
        ended.withColumnRenamed("conversation", "own"), F.col("conversation").eqNullSafe(F.col("own"))
    ).drop("own")
    return Repaired(_edits(turns, segments, joined, parts, kind), summary)


def audits_and_digests(edits: DataFrame) -> DataFrame:
    """conversation, audit, repaired_sha256 (of ``role:text`` lines of what is left, in order).

    The digest of a conversation is taken as its rows stream by; only its audit is held.
    """
    import hashlib

    kind = edits.schema["conversation"].dataType.simpleString()

    def digest(rows):
        for conversation, run in groupby(rows, key=lambda r: r[0]):
            audit, hashed, between = [], hashlib.sha256(), ""
            for _, _, _, edit, role, text in run:
                audit.append(edit)
                if edit != DELETE:
                    hashed.update(f"{between}{role}:{text}".encode())
                    between = "\n"
            yield conversation, "".join(audit), hashed.hexdigest()

    in_order = edits.select("conversation", "part", "place", "edit", "role", "text").repartition(
        "conversation").sortWithinPartitions("conversation", "part", "place")
    return _mapped(in_order, digest, f"conversation {kind}, audit string, repaired_sha256 string")
