"""Free-text location to one of five city labels, in three dialects."""

from pyspark.sql import Column, DataFrame, functions as F

from .compute import add_once
from .text import ascii_fold, contains_any

# "hn" as a word of its own. A boundary written out: \b differs between Java
# releases beside accents.
_HN_END = r"hn($|[^\p{L}\p{Mn}\p{Nd}_])"
_HN_WORD = r"(^|[^\p{L}\p{N}_])hn($|[^\p{L}\p{N}_])"

# Spellings and pattern of each city per dialect; first match wins.
CITIES = {
    # unaccented spellings only; accented names fall to Other
    "ascii": (
        ("Ho Chi Minh", ("ho chi minh", "hcm", "saigon"), None),
        ("Ha Noi", ("ha noi", "hanoi"), _HN_END),
        ("Da Nang", ("da nang", "danang"), None),
        ("Remote", ("remote",), None),
    ),
    # unaccented and accented spellings
    "accented": (
        ("Ho Chi Minh", ("hồ chí minh", "ho chi minh", "hcm", "sài gòn", "saigon"), None),
        ("Ha Noi", ("hà nội", "ha noi", "hanoi"), _HN_END),
        ("Da Nang", ("đà nẵng", "da nang", "danang"), None),
        ("Remote", ("remote",), None),
    ),
    # any accents, folded first
    "folded": (
        ("Ho Chi Minh", ("ho chi minh", "hcm", "saigon", "sai gon"), None),
        ("Ha Noi", ("ha noi", "hanoi"), _HN_WORD),
        ("Da Nang", ("da nang", "danang"), None),
        ("Remote", ("remote", "work from home"), None),
    ),
}


def _comparable(text: Column, dialect: str) -> Column:
    return ascii_fold(text) if dialect == "folded" else F.lower(F.trim(text))


def _label(text: Column, dialect: str) -> Column:
    label = None
    for city, spellings, pattern in CITIES[dialect]:
        found = contains_any(text, spellings)
        if pattern is not None:
            # the plain search spares most texts the pattern
            found = found | (text.contains("hn") & text.rlike(pattern))
        label = F.when(found, city) if label is None else label.when(found, city)
    return label.otherwise("Other")


def location_std(text: Column, dialect: str = "folded") -> Column:
    """City label of a location text; NULL and unknown places give 'Other'."""
    return _label(_comparable(text, dialect), dialect)


def with_location(df: DataFrame, location: str = "location", dialect: str = "folded", out: str = "location_std") -> DataFrame:
    """As ``location_std``, with the comparable text computed once per row."""
    texts = df.withColumn("_l", _comparable(F.col(location), dialect))
    return add_once(texts, {out: _label(F.col("_l"), dialect)}).drop("_l")
