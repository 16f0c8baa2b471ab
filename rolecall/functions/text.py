"""Text folding and cleaning as Column expressions."""

import sys
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Fixed value: every character that Python's str.strip and its \s treat as blank,
# as a regex class and as plain text. Java's \s alone knows only the ASCII ones.
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
BLANK_CHARACTERS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Letters the compatibility decomposition leaves whole but folding must map.
_FIXED_FOLDS = {"Đ": "D", "đ": "d"}

# Hangul syllables become two or three letters by arithmetic (Unicode, chapter 3.12).
_HANGUL, _VOWELS, _FINALS = 0xAC00, 21, 28
_LEADING = [chr(0x1100 + i) for i in range(19)]
_VOWEL = [chr(0x1161 + i) for i in range(_VOWELS)]
_FINAL = [""] + [chr(0x11A8 + i) for i in range(_FINALS - 1)]


@lru_cache(1)
def _fold_tables() -> tuple[str, str, dict[str, str], str]:
    """Derived from the Unicode tables: arguments of ``translate``, the characters that
    become several with what they become, and a regex class of these and of Hangul.

    Mapped: every character whose decomposition minus its combining marks is exactly one
    other character. Dropped, having no counterpart in the second text: characters of
    which nothing remains.
    """
    src, dst, gone, several = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) in ("Cs", "Cn", "Co") or _HANGUL <= code <= 0xD7A3:
            continue
        plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        plain = _FIXED_FOLDS.get(char, plain)
        if not plain:
            gone.append(char)
        elif len(plain) > 1:
            several[char] = plain
        elif plain != char:
            src.append(char)
            dst.append(plain)
    return "".join(src + gone), "".join(dst), several, _class_of([*map(ord, several), *range(_HANGUL, 0xD7A4)])


def _class_of(codes: list[int], width: int = 10) -> str:
    """A regex class of these characters. Ranges stand in groups behind the span of each
    group: the engine tries all members of a union in turn, and few spans hold a character."""
    ranges: list[list[int]] = []
    for code in sorted(codes):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    span = lambda a, b: f"\\x{{{a:X}}}-\\x{{{b:X}}}"
    groups = [ranges[i : i + width] for i in range(0, len(ranges), width)]
    guarded = [f"[{span(g[0][0], g[-1][1])}&&[{''.join(span(a, b) for a, b in g)}]]" for g in groups]
    return f"[{''.join(guarded)}]"


def strip_blank(text: Column) -> Column:
    """Cut blanks of any kind from both ends (``trim`` cuts only U+0020)."""
    return F.btrim(text, F.lit(BLANK_CHARACTERS))


def fold_blanks(text: Column) -> Column:
    """Runs of blanks to one space, ends cut; then only spaces are left to cut."""
    return F.trim(F.regexp_replace(text, f"{BLANK}+", " "))


def contains_any(text: Column, phrases) -> Column:
    """Any of the phrases occurs (plain searches beat one alternation pattern)."""
    return reduce(lambda a, b: a | b, [text.contains(p) for p in phrases])


def ascii_fold(text: Column, compat: bool = False, expand: bool = True) -> Column:
    """Accent-free lower-case text; NULL becomes ''.

    Every script's accents go and compatibility forms are resolved. Characters that become
    one other are translated; texts that hold one which becomes several (ligatures,
    fractions, Hangul syllables) have it replaced character by character, in the JVM like
    the rest. ``expand=False`` leaves such characters as they are; ``compat=True`` asks
    for them whatever ``expand`` says.
    """
    from_, to, several, expands = _fold_tables()
    text = F.coalesce(text.cast(StringType()), F.lit(""))
    whole = text
    if expand or compat:
        whole = F.when(text.rlike(expands), _expanded(text, several, expands)).otherwise(text)
    # as many bytes as characters: ASCII, which folding leaves as it is
    plain = F.octet_length(text) == F.length(text)
    return strip_blank(F.lower(F.when(plain, text).otherwise(F.translate(whole, from_, to))))


def _expanded(text: Column, several: dict[str, str], expands: str) -> Column:
    """The text with each character of the class written out. What a character becomes
    stands in an array by its number: of Hangul letters, or among the class's others."""
    strings = lambda values: F.split(F.lit("\n".join(values)), "\n")
    ordered = sorted(several)
    known, meaning = F.lit("".join(ordered)), strings([several[c] for c in ordered])

    def written(char: Column) -> Column:
        place = F.ascii(char) - _HANGUL
        syllable = F.concat(
            F.get(strings(_LEADING), F.floor(place / (_VOWELS * _FINALS)).cast("int")),
            F.get(strings(_VOWEL), F.floor(place / _FINALS).cast("int") % _VOWELS),
            F.get(strings(_FINAL), place % _FINALS),
        )
        hangul = (place >= 0) & (place < 19 * _VOWELS * _FINALS)
        other = F.get(meaning, F.instr(known, char) - 1)
        return F.when(~char.rlike(expands), char).when(hangul, syllable).otherwise(other)

    return F.array_join(F.transform(F.split(text, ""), written), "")


def clean_title(text: Column) -> Column:
    """Runs of blanks (line breaks and tabs included) to one space, ends cut,
    capitals kept; NULL becomes ''."""
    spaced = F.regexp_replace(F.coalesce(text.cast(StringType()), F.lit("")), f"{BLANK}+", " ")
    return F.trim(spaced)


def search_text(title: Column, tags: Column) -> Column:
    """Lower-case title plus tags with all but ``[a-zA-Z0-9+#. ]`` blanked."""
    joined = F.concat_ws(
        " ",
        F.coalesce(title.cast(StringType()), F.lit("")),
        F.coalesce(tags.cast(StringType()), F.lit("")),
    )
    return F.lower(F.regexp_replace(joined, r"[^a-zA-Z0-9+#. ]", " "))


def decode_tags(tags: Column, limit: int = 6) -> Column:
    """Tags from JSON array text, else from comma-separated text; first ``limit``."""
    split = F.filter(F.transform(F.split(tags, ","), strip_blank), lambda t: t != "")
    return F.slice(F.coalesce(F.from_json(tags, "array<string>"), split), 1, limit)


def ordered_unique_tags(tags: Column) -> Column:
    """Non-blank trimmed tags, the first occurrence of each kept in place."""
    return F.array_distinct(F.filter(F.transform(tags, strip_blank), lambda t: t != ""))
