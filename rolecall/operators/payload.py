"""Contracts, key scans and checksums of raw JSON payloads."""

from pyspark.sql import Column, DataFrame, functions as F

from rolecall.functions.compute import add_once
from rolecall.functions.text import contains_any

# Fragments that a payload's object keys must not contain.
SENSITIVE_KEY_FRAGMENTS = ("authorization", "cookie", "password", "secret_access_key", "session_token")

# Every string token of a JSON text, with the colon that marks it as a key.
# Consuming all strings keeps the scan from starting inside a value.
# Possessive: a repeated group that may give characters back recurses once for each.
_STRING_TOKEN = r'"(?:[^"\\]++|\\.)*+"(?:\s*+:)?'


def _followed(json: Column) -> tuple[Column, Column]:
    """The text as the first element of an array, followed by a mark, and the mark. The
    parser alone stops after the first value and ignores what follows; here the mark is
    the second element only if the text is one value, as no text holds its own digest."""
    mark = F.md5(json)
    return F.concat(F.lit("["), json, F.lit(',"'), mark, F.lit('"]')), mark


def _parsed(json: Column, read) -> Column:
    """``read(record, whole)`` of a text parsed once: ``record(type)`` is the value as that
    type, NULL where it is none; ``whole`` is whether the text is one JSON value."""
    followed, mark = _followed(json)
    once = F.array(F.struct(F.try_parse_json(followed).alias("both"), mark.alias("mark")))

    def judged(x):
        whole = F.coalesce(F.try_variant_get(x["both"], "$[1]", "string") == x["mark"], F.lit(False))
        return read(lambda kind: F.try_variant_get(x["both"], "$[0]", kind), whole)

    return F.get(F.transform(once, judged), F.lit(0))


def strict_variant(json: Column) -> Column:
    """The JSON text as a variant, NULL unless the whole text is one JSON value."""
    return _parsed(json, lambda record, whole: F.when(whole, record("variant")))


def record_verdict(json: Column) -> Column:
    """'ok', 'not_json', 'not_object' or 'empty_object' for one JSON record, from one
    parse. An object that names a key twice is not accepted as JSON."""
    return _parsed(json, lambda record, whole: (
        F.when(~whole, "not_json")
        .when(record("map<string,variant>").isNull(), "not_object")
        .when(F.size(record("map<string,variant>")) == 0, "empty_object")
        .otherwise("ok")
    ))


def payload_contract(df: DataFrame, json: str, batch: list[str]) -> DataFrame:
    """Per batch of JSON records: record and byte counts, bad records, verdict.
    Sizes and counts are summed before the shuffle, so a hot batch is cheap."""
    return (
        df.select(*batch, F.octet_length(json).alias("_bytes"), record_verdict(F.col(json)).alias("_verdict"))
        .groupBy(*batch)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.sum("_bytes").alias("payload_bytes"),
            F.count_if(F.col("_verdict") != "ok").alias("bad_records"),
        )
        .withColumn(
            "verdict",
            F.when(F.col("bad_records") > 0, "bad_record").otherwise("ok"),
        )
    )


def payload_file_verdict(files: DataFrame, max_bytes: int = 100 * 1024 * 1024) -> DataFrame:
    """Verdict per whole payload file (``path``, ``length``, ``content``): a UTF-8
    JSON array, not empty, of non-empty objects, of at most ``max_bytes``, without
    sensitive keys. Larger files are judged by length alone, never parsed: the limit
    of one file bounds what one row may hold. With the SHA-256 of every file."""
    within = F.col("length") <= max_bytes
    raw = F.col("content").cast("string")
    text = F.when(within & F.is_valid_utf8(raw), F.regexp_replace(raw, r"^\ufeff", ""))
    parsed = files.withColumn("_text", text).withColumns({
        "_length": F.json_array_length("_text"),
        "_records": F.from_json("_text", "array<string>"),
    })
    is_json = strict_variant(F.col("_text")).isNotNull() | F.json_object_keys("_text").isNotNull()
    bad = F.exists("_records", lambda r: F.coalesce(record_verdict(r), F.lit("not_json")) != "ok")
    leaky = F.exists("_records", lambda r: F.size(sensitive_keys(r)) > 0)
    return parsed.select(
        "path", "length",
        F.col("_length").alias("record_count"),
        F.sha2("content", 256).alias("content_hash"),
        F.when(F.col("length") <= 0, "empty_file")
        .when(~within, "too_large")
        .when(F.col("_text").isNull(), "not_utf8")
        .when(F.col("_length").isNull() & is_json, "not_array")
        .when(F.col("_length").isNull(), "invalid_json")
        .when(F.col("_length") == 0, "empty_array")
        .when(bad, "bad_record")
        .when(leaky, "sensitive_key")
        .otherwise("ok")
        .alias("verdict"),
    )


def canonical_json(json: Column) -> Column:
    """Same JSON value, same text: keys sorted, blanks and escapes normalised.
    NULL for text that is not JSON."""
    return F.to_json(strict_variant(json))


def _string(token: Column) -> Column:
    """What a string token of a JSON text says, escapes read."""
    plain = F.get(F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>"), F.lit(0))
    return F.coalesce(F.when(token.contains("\\"), plain), F.regexp_replace(token, '^"|"$', ""))


def object_keys(json: Column) -> Column:
    """All object keys of a JSON text, at any depth and however often named, in the
    text's order, with escapes read. The text is scanned, not parsed, so text that is
    only nearly JSON is searched as well; NULL text is not judged."""
    tokens = F.regexp_extract_all(json, F.lit(_STRING_TOKEN), F.lit(0))
    raw = F.transform(F.filter(tokens, lambda t: t.endswith(":")), lambda t: F.regexp_replace(t, r"\s*+:$", ""))
    return F.transform(raw, _string)


def is_sensitive(key: Column, fragments=SENSITIVE_KEY_FRAGMENTS) -> Column:
    """The key contains a sensitive fragment (case and ``-``/``_`` ignored)."""
    return contains_any(F.replace(F.lower(key), F.lit("-"), F.lit("_")), fragments)


def sensitive_keys(json: Column, fragments=SENSITIVE_KEY_FRAGMENTS) -> Column:
    """The sensitive ones of all object keys. Text values are never judged."""
    return F.filter(object_keys(json), lambda k: is_sensitive(k, fragments))


def sensitive_key_scan(df: DataFrame, json: str, fragments=SENSITIVE_KEY_FRAGMENTS, with_path: bool = False) -> DataFrame:
    """Rows with a sensitive key, with those keys in ``sensitive_keys``.
    ``with_path`` adds where the first one sits, NULL in text that is not JSON; only
    the hits pay for that."""
    scanned = add_once(df, {"sensitive_keys": sensitive_keys(F.col(json), fragments)})
    hits = scanned.filter(F.size("sensitive_keys") > 0)
    return add_once(hits, {"key_path": first_sensitive_path(F.col(json), fragments)}) if with_path else hits


# Strings and the signs that nest them; numbers and words say nothing about places.
_STEP = r'"(?:[^"\\]++|\\.)*+"|[{}\[\],:]'


def first_sensitive_path(json: Column, fragments=SENSITIVE_KEY_FRAGMENTS) -> Column:
    """Where the first sensitive key of a JSON text stands, as in ``$.a[1].key``; NULL
    without one and in text that is not one JSON value. Repeated keys count.

    The text's strings and signs are folded in order: ``open`` holds the path of every
    open object or array and the place within an array (-1: an object), ``at`` the path
    of the value that comes next.
    """
    nothing = F.array().cast("array<struct<path:string,n:int>>")
    start = F.struct(nothing.alias("open"), F.lit("$").alias("at"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("found"))

    def step(state, token):
        open_, at, key = state["open"], state["at"], state["key"]
        top = F.element_at(open_, -1)
        rest = F.slice(open_, 1, F.greatest(F.size(open_) - 1, F.lit(0)))
        inside = lambda n: F.array(F.struct(at.alias("path"), F.lit(n).alias("n")))
        then = lambda o=open_, a=at, k=key, f=state["found"]: F.struct(o.alias("open"), a.alias("at"), k.alias("key"), f.alias("found"))
        place = lambda path, n: F.concat(path, F.lit("["), n.cast("string"), F.lit("]"))
        next_ = F.struct(top["path"].alias("path"), (top["n"] + 1).alias("n"))
        named = F.concat(top["path"], F.lit("."), key)
        return (
            F.when(state["found"].isNotNull(), state)
            .when(token == "{", then(o=F.concat(open_, inside(-1))))
            .when(token == "[", then(o=F.concat(open_, inside(0)), a=place(at, F.lit(0))))
            .when(token.isin("}", "]"), then(o=rest))
            .when((token == ",") & (top["n"] >= 0), then(o=F.concat(rest, F.array(next_)), a=place(top["path"], top["n"] + 1)))
            .when(token == ":", then(a=named, f=F.when(is_sensitive(key, fragments), named)))
            .when(token.startswith('"'), then(k=_string(token)))
            .otherwise(state)
        )

    followed, mark = _followed(json)
    is_json = F.get(F.from_json(followed, "array<string>"), F.lit(1)) == mark
    tokens = F.regexp_extract_all(json, F.lit(_STEP), F.lit(0))
    return F.when(is_json, F.aggregate(tokens, start, step, lambda state: state["found"]))


def key_inventory(df: DataFrame, json: str, fragments=SENSITIVE_KEY_FRAGMENTS) -> DataFrame:
    """Every key of a data set: how many records hold it and whether it is
    sensitive. Counted before the shuffle, which carries distinct keys only."""
    keys = df.select(F.explode(F.array_distinct(object_keys(F.col(json)))).alias("key"))
    counted = keys.groupBy("key").agg(F.count(F.lit(1)).alias("records"))
    return counted.withColumn("sensitive", is_sensitive(F.col("key"), fragments))


def batch_checksum(df: DataFrame, json: str, batch: list[str]) -> DataFrame:
    """Record count and an order-free digest per batch.

    Each record's canonical text is hashed; four 60-bit lanes of the hash are
    summed, which combines map-side, so no task ever holds a batch. Copies count.
    Records that are not JSON are hashed as they stand, and records with numbers that
    parsing may round also as they stand.
    """
    raw, same = F.col(json), canonical_json(F.col(json))
    # numbers beyond a double's range or precision are not told apart by the canonical text
    lossy = raw.rlike(r"[0-9]{16}|[eE][+-]?[0-9]{3}")
    text = F.coalesce(F.when(lossy, F.concat(same, F.lit("\n"), raw)).otherwise(same), raw, F.lit("null"))
    hashed = df.select(*batch, F.sha2(text, 256).alias("_h"))
    lanes = [
        F.sum(F.conv(F.substring("_h", 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)")).cast("string").alias(f"_l{i}")
        for i in range(4)
    ]
    summed = hashed.groupBy(*batch).agg(F.count(F.lit(1)).alias("record_count"), *lanes)
    digest = F.sha2(F.concat_ws(":", F.col("record_count").cast("string"), *[f"_l{i}" for i in range(4)]), 256)
    return summed.select(*batch, "record_count", digest.alias("checksum"))


def payload_decision(incoming: DataFrame, manifest: DataFrame, batch: list[str], allow_new_version: bool = False) -> DataFrame:
    """What to do with each incoming batch checksum: ``UPLOADED`` when new,
    ``SKIPPED_IDENTICAL`` when the stored one is equal, else ``CONFLICT`` unless
    new versions are allowed. Both sides hold one row per batch."""
    stored = manifest.select(*batch, F.col("checksum").alias("_stored"))
    differs = "UPLOADED" if allow_new_version else "CONFLICT"
    return incoming.join(stored, batch, "left_outer").withColumn(
        "status",
        F.when(F.col("_stored").isNull(), "UPLOADED")
        .when(F.col("_stored") == F.col("checksum"), "SKIPPED_IDENTICAL")
        .otherwise(differs),
    ).drop("_stored")
