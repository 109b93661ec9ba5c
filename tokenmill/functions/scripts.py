"""F1 for other scripts: Greek, Cyrillic, kana and Hangul to ASCII by rule.

Letters follow the published ALA-LC romanisations without their diacritics
(Greek, Cyrillic), Hepburn (kana; a long mark repeats the vowel) and the
letter-by-letter form of the Revised Romanisation (Hangul).  Only the letters
and syllable rows below are fixed; accented letters, capitals, voiced kana and
the 11,172 Hangul syllables come from rules.  A text is read once, each
character by its place in its block; what depends on a neighbour (Greek
diphthongs, Japanese small kana, doubled consonants, long vowels) is a
replacement on texts of that script.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Romanised letters, small form.
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
         "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s", "σ": "s", "τ": "t", "υ": "y", "φ": "ph",
         "χ": "ch", "ψ": "ps", "ω": "o"}
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
            "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
            "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": '"', "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia",
            "ђ": "d", "є": "ie", "ѕ": "dz", "і": "i", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "ў": "u", "џ": "dz",
            "ґ": "g", "ѣ": "ie", "ѳ": "f", "ѵ": "y"}
# Kana rows in the order a i u e o, then the readings that leave their row.
KANA_ROWS = {"": "あいうえお", "k": "かきくけこ", "s": "さしすせそ", "t": "たちつてと", "n": "なにぬねの", "h": "はひふへほ",
             "m": "まみむめも", "r": "らりるれろ", "g": "がぎぐげご", "z": "ざじずぜぞ", "d": "だぢづでど", "b": "ばびぶべぼ",
             "p": "ぱぴぷぺぽ"}
KANA_OTHERS = {"し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "や": "ya", "ゆ": "yu",
               "よ": "yo", "わ": "wa", "ゐ": "i", "ゑ": "e", "を": "o", "ゔ": "vu", "ゎ": "wa", "ゕ": "ka", "ゖ": "ke"}
# Hangul letters in code order.
HANGUL_LEAD = "g kk n d tt r m b pp s ss - j jj ch k t p h".replace("-", "").split(" ")
HANGUL_VOWEL = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" ")
HANGUL_TAIL = "- g kk gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j ch k t p h".replace("-", "").split(" ")

VOWELS = "aiueo"
#: Kept by the single pass for the replacements that need their neighbour.
SMALL_VOWELS, SMALL_Y, SMALL_TSU, SYLLABIC_N, LONG = "ぁぃぅぇぉ", "ゃゅょ", "っ", "ん", "ー"
KATAKANA_SHIFT = 0x60

GREEK_CLASS = "[\\x{0370}-\\x{03ff}\\x{1f00}-\\x{1fff}]"
KANA_CLASS = "[\\x{3041}-\\x{30ff}]"
ANY_CLASS = "[\\x{0370}-\\x{052f}\\x{1f00}-\\x{1fff}\\x{3001}-\\x{30ff}\\x{ac00}-\\x{d7a3}\\x{ff01}-\\x{ff5e}]"


def _alphabet(ch: str) -> str | None:
    """Reading of a Greek or Cyrillic letter: its small base letter's, in its own case."""
    whole = unicodedata.normalize("NFKC", ch)
    base, *marks = unicodedata.normalize("NFD", whole)
    read = {**GREEK, **CYRILLIC}
    small = whole.lower() if whole.lower() in read else base.lower()
    if small not in read:
        return None
    out = read[small]
    if "̔" in marks:  # rough breathing
        out = out + "h" if small == "ρ" else "h" + out
    return out[0].upper() + out[1:] if whole[0] != whole[0].lower() else out


def _kana(ch: str) -> str | None:
    cp = ord(ch)
    if 0x30A1 <= cp <= 0x30F6:
        ch = chr(cp - KATAKANA_SHIFT)
    if ch in SMALL_VOWELS + SMALL_Y + SMALL_TSU + SYLLABIC_N:
        return ch
    if ch in KANA_OTHERS:
        return KANA_OTHERS[ch]
    for consonant, row in KANA_ROWS.items():
        if ch in row:
            return consonant + VOWELS[row.index(ch)]
    return {"、": ",", "。": ".", "・": " ", "「": '"', "」": '"'}.get(ch)


#: (first, last, rule) of each block; the rest of a block stays as it is.
BLOCKS = ((0x0370, 0x03FF, _alphabet), (0x0400, 0x052F, _alphabet), (0x1F00, 0x1FFF, _alphabet), (0x3001, 0x30FF, _kana),
          (0xFF01, 0xFF5E, lambda ch: chr(ord(ch) - 0xFEE0)))


@functools.lru_cache(maxsize=None)
def readings(first: int, last: int, rule) -> tuple[str, ...]:
    return tuple(rule(chr(cp)) or chr(cp) for cp in range(first, last + 1))


def _array(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _one(c: Column) -> Column:
    code = F.ascii(c)
    s = code - 0xAC00
    out = F.when(c < chr(BLOCKS[0][0]), c)
    for first, last, rule in BLOCKS:
        out = out.when(code.between(first, last), F.element_at(_array(readings(first, last, rule)), code - (first - 1)))
    hangul = F.concat(F.element_at(_array(HANGUL_LEAD), F.expr("int(1)") + F.floor(s / 588).cast("int")),
                      F.element_at(_array(HANGUL_VOWEL), 1 + F.floor(s % 588 / 28).cast("int")),
                      F.element_at(_array(HANGUL_TAIL), 1 + s % 28))
    return out.when(code.between(0xAC00, 0xD7A3), hangul).otherwise(c)


def _greek_context(col: Column) -> Column:
    """γ before a guttural reads n; υ after a vowel or before ι reads u (not with
    a diaeresis); the rough breathing of a diphthong stands before it."""
    col = F.regexp_replace(col, "γ(?=[γκξχ])", "n")
    col = F.regexp_replace(col, "([αεηο][ὑὓὕὗ]|[αεου][ἱἳἵἷ])", "h$1")
    col = F.regexp_replace(F.regexp_replace(col, "(?<=h[αεηο])[ὑὓὕὗ]", "υ"), "(?<=h)([αεου])[ἱἳἵἷ]", "$1ι")
    return F.regexp_replace(col, "(?<=[αεοηΑΕΟΗ])[υύὐὔὖῦὺ]|[υύὐ](?=[ιίὶῖ])", "u")


def _kana_context(col: Column) -> Column:
    """Small kana, doubled consonants, the syllabic n and long vowels, on text read by character."""
    for small, vowel in zip(SMALL_Y, "auo"):
        col = F.regexp_replace(col, f"(sh|ch|j)i{small}", f"$1{vowel}")
        col = F.regexp_replace(col, f"([kgnhbpmr])i{small}", f"$1y{vowel}")
        col = F.replace(col, F.lit(small), F.lit("y" + vowel))
    col = F.regexp_replace(col, "(?<![a-z])u([ぃぇぉ])", "w$1")
    col = F.regexp_replace(col, "(ts|sh|ch|[fvtdj])[uoei](?=[ぁぃぅぇぉ])", "$1")
    col = F.translate(col, SMALL_VOWELS, VOWELS)
    col = F.regexp_replace(col, "っ(?=ch)", "t")
    col = F.regexp_replace(col, "っ([bdfghjkmprstvwyz])", "$1$1")
    col = F.replace(col, F.lit(SMALL_TSU), F.lit(""))
    col = F.regexp_replace(col, "ん(?=[aiueoy])", "n'")
    col = F.replace(col, F.lit(SYLLABIC_N), F.lit("n"))
    col = F.regexp_replace(col, "([aiueo])ー", "$1$1")
    return F.replace(col, F.lit(LONG), F.lit("-"))


def romanise(col: Column) -> Column:
    """Greek, Cyrillic, kana, Hangul and full-width ASCII read as ASCII; all
    else, texts without such a character included, unchanged (null: null)."""
    text = F.when(col.rlike(GREEK_CLASS), _greek_context(col)).otherwise(col)
    read = F.array_join(F.transform(F.split(text, ""), _one), "")
    return F.when(~col.rlike(ANY_CLASS), col).when(col.rlike(KANA_CLASS), _kana_context(read)).otherwise(read)
