"""Salary text to ``min_salary``, ``max_salary``, ``currency``.

Two dialects, never mixed:

* ``posted``: the batch jobs' rules. Every separator is dropped, numbers pass
  through 32-bit floats, a missing salary is VND.
* ``folded``: accent-insensitive rules with bounds, sorted ranges and decimal
  separators; a missing salary is UNKNOWN. The better default for new tables.
"""

import sys
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from .compute import add_once
from .text import ascii_fold, contains_any, strip_blank

# Number shapes of the posted dialect.
POSTED_NUMBER = r"(\d{1,3}(?:[.,]\d{3})*+(?:\.\d+)?|\d+(?:\.\d+)?)"
POSTED_NUMBER_AFTER_DASH = r"-\s*" + POSTED_NUMBER

# A word boundary written out: \b differs between Java releases beside accents.
_END = r"($|[^\p{L}\p{Mn}\p{Nd}_])"
_WORD_START, _WORD_END = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"

# Phrases of the folded dialect, in folded spelling.
NEGOTIABLE = (
    "thoa thuan", "negotiable", "hidden", "login to view", "khong hien thi",
    "salary not shown", "competitive", "you'll love it",
)
VND_MARKS = ("vnd", "₫", "trieu", "tr ", " tr", "million")
UPPER_BOUND = ("up to", "upto", "len den", "toi da")
LOWER_BOUND = ("from", "starting from", "tu ")

_DIGITS = [chr(c) for c in range(sys.maxunicode + 1) if c > 0x7F and unicodedata.category(chr(c)) == "Nd"]
_DIGIT_FROM = "".join(_DIGITS)
_DIGIT_TO = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


# ---- posted dialect -------------------------------------------------------

def posted_text(salary: Column) -> Column:
    return F.lower(F.trim(F.coalesce(salary, F.lit(""))))


def posted_currency(text: Column) -> Column:
    """USD when the text shows ``usd`` or ``$``, else VND. Takes posted_text."""
    return F.when(contains_any(text, ("usd", "$")), "USD").otherwise("VND")


# The words of a million and a thousand, here and in ``folded_multiplier``.
def posted_multiplier(text: Column, currency: Column) -> Column:
    return (
        F.when(currency == "USD", 1.0)
        .when(contains_any(text, ("triệu", "million")) | text.rlike(f"tr{_END}"), 1_000_000.0)
        .when(contains_any(text, ("nghìn", "thousand")) | text.rlike(f"k{_END}"), 1_000.0)
        .otherwise(1.0)
    )


def posted_number(text: Column, pattern: str = POSTED_NUMBER) -> Column:
    """First number of that shape, separators dropped, as a 32-bit float."""
    digits = F.regexp_replace(F.regexp_extract(text, pattern, 1), "[,.]", "")
    return digits.try_cast("float")


def _posted_salary(df: DataFrame, salary: str) -> DataFrame:
    # Each step is its own projection, so a regex result that later steps read
    # several times is evaluated once per row.
    is_upper = F.col("_s").contains("up to")
    first = F.col("_v1") * F.col("_m")
    steps = (
        df.withColumn("_s", posted_text(F.col(salary)))
        .withColumn("_c", posted_currency(F.col("_s")))
        .withColumns({
            "_m": posted_multiplier(F.col("_s"), F.col("_c")),
            "_v1": posted_number(F.col("_s")),
            "_v2": posted_number(F.col("_s"), POSTED_NUMBER_AFTER_DASH),
        })
    )
    return add_once(steps, {
        "currency": F.col("_c"),
        "min_salary": F.when(~is_upper, first),
        "max_salary": F.when(is_upper, first)
        .when(F.col("_v2") > 0, F.col("_v2") * F.col("_m"))
        .when(F.col("_v2").isNull(), first),
    }).drop("_s", "_c", "_m", "_v1", "_v2")


# ---- folded dialect -------------------------------------------------------

def number_token(token: Column) -> Column:
    """One number token to a double, judging its separators.

    Both kinds: commas are thousands. One kind repeated: thousands. One single
    separator: thousands when it splits <=3 digits from exactly 3, else decimal.
    """
    plain = _plain_number(_plain_digits(token))
    return F.when(plain.rlike(_PLAIN_NUMBER), plain.try_cast("double"))


# Fixed value: what counts as a number once the separators are judged.
_PLAIN_NUMBER = r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"


def _plain_digits(token: Column) -> Column:
    return F.translate(strip_blank(token), _DIGIT_FROM, _DIGIT_TO)


def _plain_number(token: Column) -> Column:
    """The token with a point as its only separator, if it is a number."""
    return (
        F.when(token.contains(",") & token.contains("."), F.replace(token, F.lit(","), F.lit("")))
        .when(token.rlike(r"[,].*[,]"), F.replace(token, F.lit(","), F.lit("")))
        .when(token.rlike(r"[.].*[.]"), F.replace(token, F.lit("."), F.lit("")))
        .when(token.rlike(r"^[^,.]{0,3}[,.][^,.]{3}$"), F.regexp_replace(token, "[,.]", ""))
        .otherwise(F.replace(token, F.lit(","), F.lit(".")))
    )


def folded_currency(raw: Column, folded: Column) -> Column:
    return (
        F.when(raw.contains("$") | folded.contains("usd"), "USD")
        .when(contains_any(folded, VND_MARKS), "VND")
        .otherwise("UNKNOWN")
    )


def folded_multiplier(folded: Column, currency: Column) -> Column:
    return (
        F.when(currency != "VND", 1.0)
        .when(folded.rlike(f"{_WORD_START}(trieu|tr|million){_WORD_END}"), 1_000_000.0)
        .when(folded.rlike(f"{_WORD_START}(nghin|k|thousand){_WORD_END}"), 1_000.0)
        .otherwise(1.0)
    )


def _folded_salary(df: DataFrame, salary: str) -> DataFrame:
    s, first, second = F.col("_s"), F.get("_n", F.lit(0)), F.get("_n", F.lit(1))
    tokens = F.regexp_extract_all(s, F.lit(r"\p{Nd}++(?:[,.]\p{Nd}++)*+"), F.lit(0))
    # each step's text is built once; only the two numbers that are read are cast
    plain = F.transform(F.transform(tokens, _plain_digits), _plain_number)
    first_two = F.slice(F.filter(plain, lambda p: p.rlike(_PLAIN_NUMBER)), 1, 2)
    numbers = F.transform(first_two, lambda p: p.try_cast("double"))
    steps = (
        df.withColumn("_s", ascii_fold(F.col(salary)))
        .withColumn("_shown", (s != "") & ~contains_any(s, NEGOTIABLE))
        .withColumn(
            "_c",
            F.when(F.col("_shown"), folded_currency(F.coalesce(F.col(salary), F.lit("")), s))
            .otherwise("UNKNOWN"),
        )
        .withColumns({
            "_m": folded_multiplier(s, F.col("_c")),
            "_n": F.when(F.col("_shown"), numbers),
            "_upper": contains_any(s, UPPER_BOUND),
            "_lower": contains_any(s, LOWER_BOUND),
        })
        .withColumns({"_first": first * F.col("_m"), "_second": second * F.col("_m")})
    )
    return add_once(steps, {
        "currency": F.col("_c"),
        "min_salary": F.when(F.col("_upper"), F.lit(None))
        .when(F.col("_lower"), F.col("_first"))
        .otherwise(F.least("_first", F.coalesce("_second", "_first"))),
        "max_salary": F.when(F.col("_upper"), F.col("_first"))
        .when(F.col("_lower"), F.lit(None))
        .otherwise(F.greatest("_first", F.coalesce("_second", "_first"))),
    }).drop("_s", "_shown", "_c", "_m", "_n", "_upper", "_lower", "_first", "_second")


# ---- entry points ---------------------------------------------------------

def with_salary(df: DataFrame, salary: str = "salary", dialect: str = "folded") -> DataFrame:
    """Add ``currency``, ``min_salary``, ``max_salary`` parsed from a text column."""
    if dialect == "posted":
        return _posted_salary(df, salary)
    if dialect == "folded":
        return _folded_salary(df, salary)
    raise ValueError(f"unknown salary dialect {dialect!r}")


def salary_range_valid(low: Column, high: Column) -> Column:
    """Both ends non-negative when present, and low <= high when both are."""
    return (
        F.coalesce(low >= 0, F.lit(True))
        & F.coalesce(high >= 0, F.lit(True))
        & F.coalesce(low <= high, F.lit(True))
    )


def has_salary(low: Column, high: Column) -> Column:
    return low.isNotNull() | high.isNotNull()


# Alert thresholds per currency.
ALERT_THRESHOLDS = {"USD": 1000, "VND": 20_000_000}


def is_high_salary(low: Column, currency: Column, thresholds: dict = ALERT_THRESHOLDS) -> Column:
    """The lower end reaches its currency's threshold; a NULL end never does."""
    hit = F.lit(False)
    for code, least in thresholds.items():
        hit = hit | ((currency == code) & (low >= least))
    return hit
