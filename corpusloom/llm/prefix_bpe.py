"""Byte-level BPE by prefixes.

For every prefix of a byte string exactly one token can end its encoding: the token that is a
suffix of the prefix and whose pair with the last token before it is what merging would leave.
The table of these last tokens holds the encoding of every prefix. Bytes can therefore be
appended exactly, and after an edit only what lies behind it is computed, until the table agrees
with the old one again.
"""

import base64
import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHED_PIECES = 800_000
CACHED_CHARS = 64
CACHED_PAIRS = 800_000

_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNCLEAR = re.compile(r" \s|\s ")
# ASCII punctuation but the apostrophe, which can begin a match of letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a line 'base64 rank' for each token."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Tokens and their ranks; every single byte must be one."""

    def __init__(self, ranks: dict[bytes, int]):
        if not all(bytes([b]) in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        # When a token is made: single bytes are there from the start.
        self.time = {rank: rank if len(t) > 1 else -1 for t, rank in ranks.items()}
        # By their last three bytes, the lengths of tokens that can end there, the longest first.
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            lengths.setdefault(token[-3:], {1, 2}).add(len(token))
        self.sizes = {end: sorted(found, reverse=True) for end, found in lengths.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        # Merging makes every token, so that each has one past that can be undone.
        self.whole = all(map(self.is_made, self.tokens))

    def merged(self, data: bytes, below: float = float("inf")) -> list[bytes]:
        """The definition: join the adjacent pair of lowest rank, the leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, below), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens that are joined into this one; None if merging never makes it."""
        if rank not in self._halves:
            parts = self.merged(self.tokens[rank], rank)
            self._halves[rank] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self._halves[rank]

    def is_made(self, rank: int) -> bool:
        """Whether merging the bytes of a token leaves this token."""
        return self.time[rank] < 0 or self.halves(rank) is not None

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens leaves these two."""
        answer = self.pairs.get((left, right))
        if answer is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            if not (self.is_made(left) and self.is_made(right)):
                answer = False
            elif self.whole:
                answer = self._stay_apart(left, right)
            else:
                parts = [self.tokens[left], self.tokens[right]]
                answer = self.merged(b"".join(parts)) == parts
            self.pairs[left, right] = answer
        return answer

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undoes the past of the border step by step.

        Of the two tokens at the border the one made later is taken apart. Before it was made,
        its half met the other token; had their union an earlier turn, it would have been made
        instead. In the same turn the merge further left comes first.
        """
        turn = float("inf")
        while True:
            if self.ranks.get(self.tokens[left] + self.tokens[right], turn) < turn:
                return False
            if self.time[left] > self.time[right]:
                turn = left
                left = self.halves(left)[1]
            elif self.time[right] >= 0:
                turn = right + 1
                right = self.halves(right)[0]
            else:
                return True


class PrefixTable:
    """The last token of the encoding of every prefix of ``data``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self._extend(start, len(self.data))

    def _extend(self, start: int, end: int) -> None:
        """Entries for the prefixes longer than start, up to end. The loop is the whole cost of
        encoding, so look-ups that mostly succeed are made here rather than in a call."""
        vocabulary, data, last = self.vocabulary, self.data, self.last
        ranks, pairs, sizes = vocabulary.ranks, vocabulary.pairs, vocabulary.sizes
        for stop in range(start + 1, end + 1):
            for size in sizes.get(data[max(0, stop - 3):stop], (2, 1)):
                begin = stop - size
                if begin < 0 or (rank := ranks.get(data[begin:stop])) is None:
                    continue
                if begin:
                    pair = last[begin - 1], rank
                    fits = pairs[pair] if pair in pairs else vocabulary.may_follow(*pair)
                else:
                    fits = vocabulary.is_made(rank)
                if fits:
                    last.append(rank)
                    break

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in the place of data[start:end]; how many prefixes were computed.

        An entry depends on the bytes and entries of the ``longest`` positions before it. Behind
        the edit, as many equal entries in a row as that make the rest equal too.
        """
        old, kept = self.last, self.data[end:]
        self.data, self.last = self.data[:start] + new + kept, self.last[:start]
        self._extend(start, start + len(new))
        equal, computed = 0, len(new)
        for at in range(end, len(old)):
            if equal == self.vocabulary.longest:
                self.last += old[at:]
                break
            self._extend(len(self.last), len(self.last) + 1)
            equal = equal + 1 if self.last[-1] == old[at] else 0
            computed += 1
        return computed

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all by default."""
        end, found = len(self.data) if end is None else end, []
        while end:
            found.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[found[-1]])
        return found[::-1]


class _Pieces(dict):
    """Ids of the pieces of texts after a common lead, computed when first asked for.

    Letters before a run of marks or a line break are matches of their own, so they are looked up
    on their own; other pieces are matched by the pattern.
    """

    def __init__(self, vocabulary: Vocabulary, matches, lead: str, first: "_Pieces | None" = None):
        super().__init__()
        self.vocabulary, self.matches, self.lead = vocabulary, matches, lead
        self.first = self if first is None else first

    def __missing__(self, piece: str) -> bytes:
        letters = piece.rstrip(_MARKS)
        if letters.isalpha():
            ids = self._match(self.lead + piece) if letters == piece else (
                self[letters] + self._match(piece[len(letters):]))
        else:
            ids = self._lines(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def _lines(self, piece: str) -> bytes:
        before, cut, after = piece.partition("\n")
        if cut and before and after and not before[-1].isspace() and not after[0].isspace():
            return self[before] + self._match(cut) + self.first[after]
        return b"".join(map(self._match, self.matches(self.lead + piece)))

    def _match(self, match: str) -> bytes:
        data = match.encode("utf-8", "replace")
        rank = self.vocabulary.ranks.get(data)
        return array("I", PrefixTable(self.vocabulary, data).tokens() if rank is None
                     else (rank,)).tobytes()


class PrefixEncoder:
    """Whole texts: each match of the pattern is encoded on its own.

    A match that is itself a token is that token. The pattern must be one that takes runs of
    letters, digits and other signs, each with a space before it, so that no match spans a space
    between other characters. Short pieces between such spaces are remembered up to a bound. The
    encoder is a broadcast value, so all tasks of a worker share what it remembers.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern, self.later = ranks, pattern, None

    def __getstate__(self):
        return self.ranks, self.pattern

    def __setstate__(self, state):
        self.__init__(*state)

    def _load(self) -> None:
        import regex

        self.vocabulary = Vocabulary(self.ranks)
        matches = regex.compile(self.pattern).findall
        self.first = _Pieces(self.vocabulary, matches, "")
        self.later = _Pieces(self.vocabulary, matches, " ", self.first)

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; null is empty."""
        if self.later is None:
            self._load()
        text = text or ""
        pieces = _CUT.split(text) if _UNCLEAR.search(text) else text.split(" ")
        return self.first[pieces[0]] + b"".join(map(self.later.__getitem__, pieces[1:]))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens; the inverse of encode."""
        if self.later is None:
            self._load()
        return b"".join(map(self.vocabulary.tokens.__getitem__, memoryview(ids).cast("I")))


RESULT_FIELDS = (T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                 T.StructField("decoded", T.BinaryType()))


def encode_and_decode(df: DataFrame, encoder: PrefixEncoder, key: str = "doc_id",
                      text: str = "text") -> DataFrame:
    """One row per input row: key, n_tokens, ids, decoded (the bytes read back from the ids).

    A null or empty text has no token. Rows with equal or null keys are kept apart. Other columns
    are not looked at. An empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(encoder)
    source = df.select(df[f"`{key}`"].alias("key"), df[f"`{text}`"].alias("text"))
    result = T.StructType([T.StructField("key", source.schema["key"].dataType),
                           *RESULT_FIELDS])

    def coded(batches) -> Iterator:
        import pyarrow as pa

        bpe = shared.value
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()),
                 pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.binary())],
                ["key", "n_tokens", "ids", "decoded"])

    return source.mapInArrow(coded, result).withColumnRenamed("key", key)
