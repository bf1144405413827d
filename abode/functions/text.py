"""Text expressions (Column -> Column). All JVM-side, no UDFs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space, written out so the same class means the same thing in
# Java regex and RE2 (the SQL oracle), whose bare \s is ASCII only. Spark
# uses Java's own (?U)\s, which is the same set and measured ~25% faster.
WHITESPACE_CLASS = (
    r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# Word pattern for title casing: letters/digits, keeping an apostrophe or a
# full stop between two word characters inside the word; everything else is
# a separator run (hyphen, slash, ampersand, space, comma ...).
TITLE_WORD_PATTERN = r"([\p{L}\p{N}]+(?:['’.][\p{L}\p{N}]+)*|[^\p{L}\p{N}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


UNICODE_SPACE_RUN = r"(?U)\s+"


def squish(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim both ends."""
    return F.trim(F.regexp_replace(_col(c), UNICODE_SPACE_RUN, " "))


def lower_squish(c: Column | str) -> Column:
    return squish(F.lower(_col(c)))


# The Unicode White_Space code points of WHITESPACE_CLASS.
_WS_CODEPOINTS = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                  0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WS_CHARACTERS = "".join(map(chr, _WS_CODEPOINTS))


def lower_trim_unicode(c: Column | str) -> Column:
    """lower + trim Unicode whitespace at both ends, without a regex.

    For a value only ever compared with a single word (a yes/no cell),
    ``lower_trim_unicode(c) == "yes"`` exactly when ``lower_squish(c) == "yes"``.
    """
    return F.btrim(F.lower(_col(c)), F.lit(_WS_CHARACTERS))


def is_word(c: Column | str, word: str) -> Column:
    """``lower_trim_unicode(c) == word`` for an ASCII word; a missing cell is not it.

    A cell as long as the word can't have white space around it, and a shorter one can't
    hold it, so only longer cells are trimmed, and of all white space only if plain spaces aren't it.
    """
    c = _col(c)
    length, plain = F.length(c), F.lower(F.trim(c)) == word
    return (F.when(length == len(word), F.lower(c) == word)
            .when(length > len(word), plain | (F.lower(c).contains(word) & (lower_trim_unicode(c) == word))).otherwise(F.lit(False)))


def is_blank(c: Column | str) -> Column:
    """NULL, "" or a single space. Never NULL itself."""
    c = _col(c)
    return c.isNull() | F.coalesce(c.isin("", " "), F.lit(False))


def null_safe_isin(c: Column | str, values: Iterable) -> Column:
    """Membership that is FALSE (not NULL) for a NULL input."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def strip_postcode_noise(c: Column | str) -> Column:
    """Remove spaces, question marks and double quotes."""
    return F.translate(_col(c), ' ?"', "")


def postcode_key(c: Column | str) -> Column:
    """Join key for postcodes: lower case, no spaces."""
    return F.lower(F.replace(_col(c), F.lit(" "), F.lit("")))


def paste_na(*cols: Column | str) -> Column:
    """Concatenate, writing a missing value as the text NA (never NULL)."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])


def title_words(c: Column | str) -> Column:
    """Capitalise the first letter of every word, lower-case the rest."""
    words = F.regexp_extract_all(F.lower(_col(c)), F.lit(TITLE_WORD_PATTERN), 1)
    capped = F.transform(
        words, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))
    )
    return F.when(_col(c).isNull(), F.lit(None)).otherwise(F.array_join(capped, ""))


def tidy_address(c: Column | str) -> Column:
    """Address tidy: drop trailing commas/whitespace, title case, squish."""
    stripped = F.regexp_replace(_col(c), r"[,\s]*$", "")
    return squish(title_words(stripped))


def blank_if_contains(c: Column | str, needle: str) -> Column:
    """Replace a value containing ``needle`` by the empty string."""
    c = _col(c)
    return F.when(F.coalesce(c.contains(needle), F.lit(False)), F.lit("")).otherwise(c)
