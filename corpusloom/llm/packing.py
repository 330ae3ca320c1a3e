"""Documents into fixed windows by minimum bin slack.

A task cuts its documents into full windows and packs what remains of them: for each window a
subset-sum over bitsets picks the remaining lengths that come closest to its capacity. Packing is
local to a task's run of documents, so nothing is shuffled, and a run is bounded in tokens.
"""

from bisect import insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CAPACITY = 1024
RUN_TOKENS = 2 << 20
# Local window numbers of a task; the task's number stands above them.
TASK_SHIFT = 40


def fill(counts: dict[int, int], lengths: list[int], capacity: int) -> dict[int, int]:
    """How many of each length make the largest sum up to capacity.

    ``lengths`` are ascending, with their counts. Bit s of ``reach`` says that s can be made;
    long lengths come first, and copies of one length join in groups of 1, 2, 4 and so on. The
    search ends as soon as the capacity itself is reached.
    """
    mask, goal = (1 << capacity + 1) - 1, 1 << capacity
    reach, steps = 1, []
    for length in reversed(lengths):
        left, group = min(counts[length], capacity // length), 1
        while left and not reach & goal:
            n = min(group, left)
            steps.append((length, n, reach))
            reach |= reach << length * n & mask
            left, group = left - n, group * 2
    made, chosen = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> made & 1:
            chosen[length] = chosen.get(length, 0) + n
            made -= length * n
    return chosen


@dataclass
class Windows:
    """Pieces placed so far and the rests still to place, by length.

    A rest is (document, start). ``place`` receives (document, start, length, window, offset).
    """

    capacity: int
    place: Callable[[int, int, int, int, int], None]
    next_window: int = 0
    rests: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    lengths: list[int] = field(default_factory=list)
    total: int = 0

    def add(self, document: int, n_tokens: int) -> None:
        """Full windows of a document are placed at once, its rest is kept."""
        full = n_tokens - n_tokens % self.capacity
        for start in range(0, full, self.capacity):
            self.place(document, start, self.capacity, self.next_window, 0)
            self.next_window += 1
        if n_tokens > full:
            self._keep(n_tokens - full, document, full)

    def _keep(self, length: int, document: int, start: int) -> None:
        if length not in self.rests:
            self.rests[length] = []
            insort(self.lengths, length)
        self.rests[length].append((document, start))
        self.total += length

    def _take(self, length: int) -> tuple[int, int]:
        rest = self.rests[length].pop()
        if not self.rests[length]:
            del self.rests[length]
            self.lengths.remove(length)
        self.total -= length
        return rest

    def finish(self) -> None:
        """Place every rest. Where no subset fills a window, a further rest is cut to do so; the
        last tokens fill windows of a power of two, so that nothing is padded."""
        while self.total:
            size = self.capacity if self.total >= self.capacity else 1 << self.total.bit_length() - 1
            self._fill_window(size)
            self.next_window += 1

    def _fill_window(self, size: int) -> None:
        fitting = [n for n in self.lengths if n <= size]
        counts = {n: len(self.rests[n]) for n in fitting}
        if fitting:  # the longest rest that fits is in the window, the others close its slack
            longest = fitting[-1]
            counts[longest] -= 1
            chosen = fill(counts, [n for n in fitting if n <= size - longest], size - longest)
            chosen[longest] = chosen.get(longest, 0) + 1
        else:
            chosen = {}
        offset = 0
        for length, n in chosen.items():
            for _ in range(n):
                document, start = self._take(length)
                self.place(document, start, length, self.next_window, offset)
                offset += length
        while offset < size:  # every rest left is longer than the slack
            length, slack = self.lengths[0], size - offset
            document, start = self._take(length)
            used = min(length, slack)
            self.place(document, start, used, self.next_window, offset)
            offset += used
            if length > used:
                self._keep(length - used, document, start + used)


def pack(df: DataFrame, encode: Callable[[str | None], bytes], key: str = "doc_id",
         text: str = "text", end_id: int = 0, capacity: int = CAPACITY,
         run_tokens: int = RUN_TOKENS) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, ids.

    ``encode`` gives a text's ids as little-endian unsigned 32-bit integers; ``end_id`` closes
    each document, so an empty or null text is one token. Each token is in one piece, the pieces
    of a sequence lie gapless from offset 0, and a sequence is ``capacity`` long or a power of
    two at the end of a run. Rows with equal or null keys are documents of their own. Other
    columns are not looked at. An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("a window holds at least one token")

    def packed(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("key", key_type), ("start", pa.int64()), ("length", pa.int64()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                            ("offset", pa.int64()), ("ids", pa.binary())])
        base = TaskContext.get().partitionId() << TASK_SHIFT
        end = end_id.to_bytes(4, "little")
        keys, ids, rows, held = [], [], [], 0

        def place(document, start, length, window, offset):
            tokens = ids[document]
            rows.append((keys[document], start, length, len(tokens) // 4, base + window, offset,
                         tokens[4 * start:4 * (start + length)]))

        windows = Windows(capacity, place)

        def flush():
            windows.finish()
            for at in range(0, len(rows), 4096):
                columns = zip(schema.types, zip(*rows[at:at + 4096]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in columns], schema=schema)
            keys.clear(), ids.clear(), rows.clear()

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                tokens = encode(t.as_py()) + end
                keys.append(k.as_py()), ids.append(tokens)
                windows.add(len(ids) - 1, len(tokens) // 4)
                held += len(tokens) // 4
                if held >= run_tokens:
                    yield from flush()
                    held = 0
        yield from flush()

    from pyspark.sql.pandas.types import to_arrow_type

    source = df.select(df[f"`{key}`"].alias("key"), df[f"`{text}`"].alias("text"))
    key_type = to_arrow_type(source.schema["key"].dataType)
    result = T.StructType([T.StructField("key", source.schema["key"].dataType)])
    for name in ("start", "length", "doc_tokens", "sequence_id", "offset"):
        result.add(name, T.LongType())
    return (source.mapInArrow(packed, result.add("ids", T.BinaryType()))
            .withColumnRenamed("key", key))
