"""Text cleaning as column expressions; the character table works in an Arrow UDF.

F1 transliterate, F2 strip newline/tab, F3 strip whitespace, F4 strip
backslash, F5 clean text (two modes), F6 word split, F7 spaced characters.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill.functions.scripts import romanise
from tokenmill.operators.arrow_ids import text_slices

# Fixed value: every character Python's str.isspace() accepts (== Python
# ``\s``), written so that Java regex and RE2 read it the same way.
WS_CLASS = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_CLASS}]"
WS_RUN = f"{WS}+"

#: ASCII characters that reference mode deletes: white space and the backslash.
DELETED = bytes(c for c in range(128) if re.match(r"[\s\\]", chr(c)))

# Transliterations that Unicode decomposition does not give
# (letters without a base letter, and common typographic punctuation).
EXTRA_TRANSLITERATIONS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "ł": "l", "Ł": "L", "þ": "th", "Þ": "Th", "ħ": "h", "Ħ": "H",
    "ı": "i", "ŧ": "t", "Ŧ": "T", "ŋ": "ng", "Ŋ": "NG", "ſ": "s",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,",
    "–": "-", "—": "--", "‐": "-", "‑": "-", "−": "-",
    "«": "<<", "»": ">>", "‹": "<", "›": ">", "•": "*", "·": ".",
    "¡": "!", "¿": "?", "©": "(c)", "®": "(r)", "°": "deg", "€": "EUR",
    "£": "PS", "¥": "Y=", "§": "SS", "¶": "P", "×": "x", "÷": "/",
    "±": "+-", "µ": "u", "¢": "C/", "¤": "$?", "¦": "|", "¬": "!",
    "´": "'", "¨": '"', "¯": "-", "¸": ",", "′": "'", "″": '"', "‴": "'''",
    "…": "...", "⁄": "/", "†": "+", "‡": "++", "‰": "%0", "™": "tm", "№": "No",
}

# Code point blocks scanned for decompositions (Latin-1 supplement, Latin
# extended A/B, Latin extended additional, general punctuation, letterlike).
_SCAN_RANGES = ((0x00A0, 0x0250), (0x1E00, 0x1F00), (0x2000, 0x2070),
                (0x2100, 0x2150), (0xFB00, 0xFB07))


@functools.lru_cache(maxsize=1)
def transliteration_table() -> tuple[dict[str, str], dict[str, str]]:
    """(one-to-one, one-to-many) maps built by rule from NFKD + fixed values."""
    one: dict[str, str] = {}
    many: dict[str, str] = {}
    for lo, hi in _SCAN_RANGES:
        for cp in range(lo, hi):
            ch = chr(cp)
            if ch in EXTRA_TRANSLITERATIONS:
                continue
            # the fraction slash is no ASCII character: without it 1/2 would read 12
            plain = unicodedata.normalize("NFKD", ch).replace("\u2044", "/")
            base = "".join(c for c in plain if ord(c) < 128)
            if not base:
                continue
            (one if len(base) == 1 else many)[ch] = base
    for ch, rep in EXTRA_TRANSLITERATIONS.items():
        (one if len(rep) == 1 else many)[ch] = rep
    return one, many


def _by_table(texts: Column, unknown: str, delete: bytes = b"") -> Column:
    """Every non-ASCII character by the table, the rest dropped or kept; then
    the ASCII characters ``delete`` go."""
    one, many = transliteration_table()
    table = one | many
    other = re.compile("[^\x00-\x7f]")

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        read = (lambda m: table.get(m[0], "")) if unknown == "drop" else (lambda m: table.get(m[0], m[0]))
        for batch in batches:
            for part in text_slices(batch):
                texts = [t if t is None or t.isascii() else other.sub(read, t) for t in part.to_pylist()]
                if delete:
                    texts = [t if t is None else t.encode().translate(None, delete).decode() for t in texts]
                yield pa.array(texts, pa.string())
    return F.arrow_udf(run, "string")(texts)


def transliterate(col: Column, unknown: str = "drop") -> Column:
    """map Unicode letters to ASCII; ``unknown='drop'|'keep'`` for the rest.

    Texts without another script skip the reading of scripts, and ASCII texts
    the table: only a text's non-ASCII characters cost a look-up.
    """
    if unknown not in ("drop", "keep"):
        raise ValueError("unknown must be 'drop' or 'keep'")
    return _by_table(romanise(col), unknown)  # a character read so is none of the table's


def strip_newlines(col: Column) -> Column:
    """delete newline and tab."""
    return F.replace(F.replace(col, F.lit("\n"), F.lit("")), F.lit("\t"), F.lit(""))


def strip_whitespace(col: Column, replacement: str = "") -> Column:
    """replace every whitespace run (Python semantics) by ``replacement``."""
    if replacement == " ":  # single spaces, most runs, stay without a match
        return F.regexp_replace(col, f" {WS_RUN}|[{WS_CLASS.replace('x20', 'x1f')}]{WS}*", replacement)
    return F.regexp_replace(col, WS_RUN, replacement)


def strip_backslash(col: Column) -> Column:
    """delete backslash runs."""
    return F.replace(col, F.lit("\\"), F.lit(""))


def clean_text(col: Column, mode: str = "reference") -> Column:
    """transliterate, then drop newline/tab, whitespace and backslashes.

    ``reference`` deletes every whitespace character (as coded upstream);
    ``collapse`` turns each run into one space (as documented upstream).
    In reference mode all three deletions are fused into the transliteration,
    which leaves ASCII alone: deleting set A then set B equals deleting A and
    B together.
    """
    if mode == "reference":
        return _by_table(romanise(col), "drop", DELETED)
    if mode == "collapse":
        return strip_backslash(strip_whitespace(strip_newlines(transliterate(col)), " "))
    raise ValueError("mode must be 'reference' or 'collapse'")


def words(col: Column) -> Column:
    """whitespace-delimited words, empties removed (Python ``str.split()``)."""
    return F.filter(F.split(col, WS_RUN), lambda w: w != "")


def chars(col: Column) -> Column:
    """G1: one element per code point; the empty string gives an empty array."""
    return F.when(col == "", F.array().cast("array<string>")).otherwise(F.split(col, ""))
