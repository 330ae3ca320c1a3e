"""Token ids of whole texts through a byte-level tokenizer file."""

import os
import re
from array import array
from operator import attrgetter

# A space between two characters that are no white space starts a new piece: no token of a
# byte-level vocabulary spans it, as the split before the merges cuts there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# In any other run of white space, each space and each line break is a token or starts one.
_UNCLEAR = re.compile(r"\s\s(?:\s|\Z)")
# ASCII punctuation but the apostrophe, which can begin a token of letters.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Pieces remembered: so many are new, as many again may be older ones.
CACHED_PIECES = 400_000
CACHED_CHARS = 64
_ID = attrgetter("id")


def _clear(text: str) -> bool:
    """Whether the text may be cut before every space and around every line break."""
    spaced = text.replace("\n", " ")
    if "   " in spaced or spaced.endswith("  "):
        return False
    # Spaces are the only white space that is printable.
    return spaced.isprintable() or not _UNCLEAR.search(text)


def _byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Pieces(dict):
    """Ids of pieces after a common lead, computed when first asked for.

    When so many are held, they become the old ones, and those old before are forgotten; a piece
    that is asked for again is new again, so frequent ones stay. Letters go straight to the
    tokenizer's merges, also before a run of marks or a line break, since the split before the
    merges cuts there; marks and line breaks are pieces of their own without a lead. Any other
    piece goes through all of the tokenizer.
    """

    def __init__(self, tokenizer, lead: str, first: "_Pieces | None" = None,
                 held: int = CACHED_PIECES):
        super().__init__()
        self.tokenizer, self.lead, self.held, self.old = tokenizer, lead, held, {}
        self.first = self if first is None else first
        self.merges, self.letters = tokenizer.model.tokenize, _byte_letters()

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self._encoded(piece)
        if len(piece) <= CACHED_CHARS:
            if len(self) >= self.held:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _encoded(self, piece: str) -> bytes:
        letters = piece.rstrip(_MARKS)
        if not letters.isalpha():
            return self._lines(piece)
        if letters == piece:
            return self._merged(self.lead + piece)
        return self[letters] + self.first[piece[len(letters):]]

    def _lines(self, piece: str) -> bytes:
        before, cut, after = piece.partition("\n")
        if cut and before and after and not before[-1].isspace() and not after[0].isspace():
            return self[before] + self.first[cut] + self.first[after]
        encoded = self.tokenizer.encode(self.lead + piece, add_special_tokens=False)
        return array("I", encoded.ids).tobytes()

    def _merged(self, text: str) -> bytes:
        if text.isascii():  # a lead and letters, which write themselves
            mapped = text.replace(" ", self.letters[32])
        else:
            mapped = text.encode().decode("latin-1").translate(self.letters)
        return array("I", map(_ID, self.merges(mapped))).tobytes()


class PieceEncoder:
    """Encodes texts with the tokenizers library, each distinct piece of a text once.

    Texts of a corpus repeat their words, and the library spends most of its time on words it
    has seen. Pieces are remembered up to a bound, ``held`` new and as many old ones in each of two
    tables; the bound costs time only. The names of special tokens in a text become those tokens,
    as the library has it, or with ``plain_specials`` are text like any other. The file must be
    byte-level without a normalizer or added leading space, and its special tokens must not take
    white space around them. Broadcast, an encoder serves all tasks of a worker.
    """

    def __init__(self, tokenizer_json: str, plain_specials: bool = False, held: int = CACHED_PIECES):
        self.options = tokenizer_json, plain_specials, held
        self.first = self.later = self.specials = None
        self.special_ids = {}

    def __getstate__(self):
        return self.options

    def __setstate__(self, state):
        self.__init__(*state)

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer_json, plain_specials, held = self.options
        tokenizer = Tokenizer.from_str(tokenizer_json)
        added = {} if plain_specials else {
            t.content: n for n, t in tokenizer.get_added_tokens_decoder().items()}
        self.special_ids = {name: array("I", [n]).tobytes() for name, n in added.items()}
        if added:
            longest_first = sorted(added, key=len, reverse=True)
            self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        tokenizer.encode_special_tokens = True
        self.first = _Pieces(tokenizer, "", held=held)
        self.later = _Pieces(tokenizer, " ", self.first, held=held)

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers; null is empty."""
        if self.later is None:
            self._load()
        if not text or self.specials is None or not self.specials.search(text):
            return self._plain(text or "")
        between = self.specials.split(text)
        return b"".join(self.special_ids[part] if n % 2 else self._plain(part)
                        for n, part in enumerate(between))

    def _plain(self, text: str) -> bytes:
        first, later = self.first, self.later.__getitem__
        if _clear(text):
            found = []
            for line in text.split("\n"):
                pieces = line.split(" ")
                found.append(first[pieces[0]] + b"".join(map(later, pieces[1:])))
            return first["\n"].join(found)
        pieces = _CUT.split(text)
        return first[pieces[0]] + b"".join(map(later, pieces[1:]))


def read_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()
