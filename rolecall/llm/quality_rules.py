"""Line-first cleaning and document rules, DataFrame functions only."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rolecall.functions.compute import add_once

# Character classes and phrases of the rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
SEPARATORS = r"[|•·»›]+"
BLANKS = " \t\n\x0b\x0c\r"
CLOSERS = "\"'”’»)]"
SIGNS = tuple(".!?…:;。！？।")
BOILERPLATE = (
    r"(?i)lorem ipsum|enable javascript|cookie policy|privacy policy|terms of use|terms of service|"
    r"all rights reserved|click here|read more|sign up|log in|subscribe"
)


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _chars(text: Column, pattern: str) -> Column:
    """Characters of the text that the pattern covers."""
    return F.length(text) - F.length(_without(text, pattern))


def ends_in_sign(line: Column) -> Column:
    """A sentence sign is the last character but for closing quotes, brackets and blanks.
    Read from the end, so a line of any length is looked at once; most lines show it by
    their last character."""
    last = lambda signs: reduce(lambda a, b: a | b, [line.endswith(c) for c in signs])
    bare = F.rtrim(F.rtrim(line, F.lit(BLANKS)), F.lit(CLOSERS))
    return F.when(last(SIGNS), True).when(~last(BLANKS + CLOSERS), False).otherwise(F.right(bare, F.lit(1)).isin(*SIGNS))


def line_passes(line: Column) -> Column:
    """The rules of one line; a line without a word passes.

    punctuation: a line of fewer than 20 words ends in a sentence sign;
    navigation: not 3 or more separators that are a quarter of the words or more;
    symbols: at most 1 symbol in 4 words, unless there are fewer than 3;
    shouting: not 5 or more words all in capitals;
    boilerplate: none of the phrases in a line of fewer than 20 words.
    """
    words = F.size(F.array_remove(F.split(line, SPACE), ""))
    separators, symbols = _chars(line, SEPARATORS), _chars(line, SYMBOLS)
    short = words < 20
    fails = (
        (short & ~ends_in_sign(line))
        | ((separators >= 3) & (separators * 4 >= words))
        | ((symbols >= 3) & (symbols * 4 > words))
        | ((words >= 5) & (F.upper(line) == line) & (F.lower(line) != line))
        | (short & line.rlike(BOILERPLATE))
    )
    return (words == 0) | ~fails


def repeated_window_words(df: DataFrame, words: str, out: str, width: int = 3) -> DataFrame:
    """Adds the number of words in windows of ``width`` words that a text holds twice or
    more, the first included; null or fewer words: 0. Windows are compared as 64-bit
    hashes; (hash, place) pairs are sorted within the row, n log n in its words."""
    n = F.size(words)
    hashes = F.when(
        n >= width,
        F.transform(
            F.sequence(F.lit(0), n - width),
            lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = add_once(df, {"_hashes": hashes})
    pairs = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = add_once(df, {
        "_pairs": F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), pairs)
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    }).drop("_hashes")
    same = F.filter(
        "_pairs",
        lambda x, i: (F.get(F.col("_pairs"), i - 1)["h"] == x["h"]) | (F.get(F.col("_pairs"), i + 1)["h"] == x["h"]),
    )
    df = add_once(df, {"_places": F.sort_array(F.transform(same, lambda x: x["i"]))}).drop("_pairs")
    # each window adds the words that the one before does not reach
    covered = F.aggregate(
        "_places", F.struct(F.lit(-width).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(width), x - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return df.withColumn(out, covered).drop("_places")


def quality_rules(
    df: DataFrame, text: str = "text", clean: str = "clean_text", most_lost: float = 0.5,
    least_words: int = 50, most_repeated: float = 0.5,
) -> DataFrame:
    """Adds the cleaned text, the counts and the verdict of each document.

    Lines (split at \\n) that fail ``line_passes`` are removed. A document is kept when
    it has ``least_words`` words, at most the share ``most_repeated`` of them in
    repeated 3-word windows, and cleaning takes at most the share ``most_lost`` of its
    word characters. Null and empty texts have no words and are rejected. One
    projection over the scan: no shuffle. Result columns: ``clean``, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, kept_chars, base_failed, kept;
    a column of ``df`` with one of these names is replaced.
    """
    added = (clean, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "base_failed", "kept")
    df = df.drop(*added).withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = add_once(df, {
        "_words": F.array_remove(F.split("_text", SPACE), ""),
        "_lines": F.split("_text", "\n"),
        "n_symbols": _chars(F.col("_text"), SYMBOLS).cast("bigint"),
    }).drop("_text")
    df = add_once(df, {
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "_worded": F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        clean: F.array_join(F.filter("_lines", line_passes), "\n"),
    }).drop("_lines")
    df = repeated_window_words(df, "_words", "n_repeat_words").drop("_words")
    df = add_once(df, {
        "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("bigint"),
        "kept_chars": F.length(_without(F.col(clean), SPACE)).cast("bigint"),
    }).drop("_worded")
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    fair = F.col("kept_chars") >= (1 - most_lost) * F.col("word_chars")
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & fair)
