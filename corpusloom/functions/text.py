"""Text, hash and JSON column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import settings as S

# The 29 whitespace code points, as the inside of a Java character class.
# Single Latin-1 characters are looked up in a bit set; the nested class is reached only by
# characters from U+1680 on, which keeps scanning ordinary text cheap.
_LATIN_SPACE = r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_OTHER_SPACE = _LATIN_SPACE + (
    r"[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]")
WHITESPACE = " " + _OTHER_SPACE
# Runs that change when collapsed: any run that starts with something else than U+0020, or
# goes on after it. A lone U+0020 is left alone, which spares rewriting most texts.
_UNEVEN_RUN = f"[{_OTHER_SPACE}][{WHITESPACE}]*+| [{WHITESPACE}]++"
NUL = "\0"
# The same 29 code points one by one.
SPACE_POINTS = [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACES = "".join(map(chr, SPACE_POINTS))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_blank(c: Column | str) -> Column:
    """True for null, '' and texts made of whitespace only.

    Trimming from the left stops at the first other character, whatever the length.
    """
    return F.coalesce(F.ltrim(col(c), F.lit(_SPACES)) == "", F.lit(True))


def without_nul(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(NUL), F.lit(""))


def clean_text(c: Column | str) -> Column:
    """Drop NUL, collapse whitespace runs to one space, strip; null becomes ''."""
    text = F.coalesce(without_nul(c), F.lit(""))
    return F.trim(F.regexp_replace(text, _UNEVEN_RUN, " "))


def sha256(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def key_hash(*parts: Column | str) -> Column:
    """SHA-256 of the parts joined by '|'; a null part counts as ''."""
    texts = [F.coalesce(col(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def raw_snapshot() -> Column:
    """JSON of a raw row with the first characters of its text (null when empty)."""
    head = F.when(F.col("text") != "", F.substring("text", 1, S.SNAPSHOT_CHARS))
    return F.to_json(
        F.struct("id", "url", "title", head.alias("text")), {"ignoreNullFields": "false"})


def embedding_text(title: Column | str, text: Column | str) -> Column:
    """The text that is cut into windows."""
    return F.concat(col(title), F.lit(": "), col(text))


def preview(c: Column | str, chars: int) -> Column:
    return F.concat(F.left(col(c), F.lit(chars)), F.lit("..."))
