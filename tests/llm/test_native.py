"""Sharding, quality rules and the license scan: SQL, brute force, edge rows, native plans."""

import math
import re
import textwrap
import time
import zlib

import duckdb
import pytest
import xxhash

from rolecall.llm import license_scan, oracle, quality_rules, queries, sharding

MIT = dict(x for x in license_scan.TEMPLATES if "NONINFRINGEMENT" in x[1])["mit"]
WRAPPED = textwrap.fill(" ".join(MIT.split()), 70)

TEXTS = [
    None, "", " \n\t ", "one two", "a b c " * 40, "The cat sat on the mat and it was there. " * 3, "x | y | z | w\n" * 20,
    "Home | About | Contact | Help\n" + "Plain words that tell a story which nobody has told before in this town. " * 9 + "\nClick here",
    "WORDS IN CAPITALS ARE SHOUTED AT EVERYONE!\n" * 3 + " ".join(f"Word{i} of prose goes on and on." for i in range(30)),
    "Same line of words.\nSame line of words.\n\nother\n", "é ñ ß. " * 60, "w1 w2 w3 " + " ".join(f"u{i}" for i in range(60)) + " w1 w2 w3.",
    "#a *b $c %d &e |f <g >h " * 9, "Licensed under the Apache License, Version 2.0.\nthis is gnu general public license gnu general public license",
    "CC-BY cc by, MIT License!\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that",
    "mit\nlicense apache  license", "All rights reserved.", "apache licence; released under mit License", "long " * 30000 + "cc by",
    f"Copyright (c) Nobody\n\n{WRAPPED}\n", "/*\n" + "\n".join(f" * {x}" for x in WRAPPED.split("\n")) + "\n */ code", WRAPPED[: len(WRAPPED) // 3],
    "This program is free\nsoftware: you can redistribute it and/or\nmodify it under the terms of the GNU General\nPublic License as you like.",
    "all words\nof rights\nthat are\nreserved", "all " + "of these words are many " * 9 + "rights reserved", "." * 3000 + "x", " \t" * 3000 + "x.\n" + "word " * 60 + '."  \t\n',
]


@pytest.fixture(scope="module")
def tables(spark, docs_of, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("native"))
    docs_of(list(enumerate(TEXTS))).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.mark.parametrize("name", ["op7_quality_rules", "op10_license_scan"])
@pytest.mark.parametrize("where", ["small", "/root/testdata/sf0.001"])
def test_as_sql(spark, tables, name, where):
    path = tables if where == "small" else where
    df = queries.QUERIES[name](spark, path)
    columns = sorted(df.columns)
    connection = duckdb.connect()
    files = f"{path}/documents.parquet" + ("/*.parquet" if where == "small" else "")
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{files}')")
    answer = connection.execute(oracle.ORACLE[name])
    order = [[d[0] for d in answer.description].index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in answer.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want


def test_no_python_in_the_plans(spark, tables):
    for name in ("op6_rendezvous_shards", "op7_quality_rules", "op10_license_scan"):
        plan = queries.QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "InPandas"))


def rendezvous(key, weights):
    def cost(shard):
        h = 42
        if key is not None:
            h = xxhash.xxh64_intdigest(str(key).encode(), 42)
        h = xxhash.xxh64_intdigest(f"shard-{shard}".encode(), h)
        return -math.log(((h & ((1 << 53) - 1)) + 0.5) / (1 << 53)) / weights[shard]

    return min(sorted(weights), key=cost)


def test_shards_as_plain_hashes(spark):
    keys = [None, *range(-50, 1500)]
    df = spark.createDataFrame([(k, "x") for k in keys], "k bigint, shard string")
    weights = {0: 1.0, 1: 2.0, 5: 0.5}
    rows = sharding.with_shards(df, "k", weights, grown_weight=1.5).collect()
    for r in rows:
        assert r["shard"] == rendezvous(r["k"], weights)
        assert r["grown_shard"] in (r["shard"], 6) and r["grown_shard"] == rendezvous(r["k"], weights | {6: 1.5})
    share = sum(r["shard"] == 1 for r in rows) / len(rows)
    assert abs(share - 2 / 3.5) < 0.06
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(df["k"], {0: 0.0})


def test_slots_have_no_gap(spark):
    rows = [(i % 7, i % 3) for i in range(400)] + [(1, 1)] * 300 + [(None, 1), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "k int, shard int")
    placed = sharding.with_slots(df, rows_per_group=10).collect()
    assert sorted(((r["k"], r["shard"]) for r in placed), key=repr) == sorted(rows, key=repr)
    for shard in (0, 1, 2, None):
        slots = sorted(r["slot"] for r in placed if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.with_slots(df.limit(0)).collect() == []


def test_shard_query(spark, tables):
    rows = queries.QUERIES["op6_rendezvous_shards"](spark, tables).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        raw = (TEXTS[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 8)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_quality_cleans_lines(docs_of):
    prose = " ".join(f"A{i} b{i} c{i} d{i} e{i} f{i}." for i in range(20))
    docs = docs_of([(1, f"Home | News | Shop | Help\n{prose}\nAll rights reserved.\n"), (1, None), (None, "x")])
    rows = sorted(quality_rules.quality_rules(docs.withColumnRenamed("source", "kept")).collect(), key=lambda r: -r["n_words"])
    assert rows[0]["clean_text"] == f"{prose}\n" and rows[0]["kept"] and rows[0]["doc_id"] == 1
    assert [r["base_failed"] for r in rows] == [False, True, True]
    assert quality_rules.quality_rules(docs_of([])).collect() == []


def test_license_rows(docs_of):
    docs = docs_of([(1, "mit license"), (1, "mit license"), (None, "cc by"), (None, None), (2, "All rights RESERVED")])
    out = sorted(((r["doc_id"], r["n_base"], r["labels"], r["score"]) for r in license_scan.license_scan(docs).collect()), key=repr)
    assert out == sorted([(1, 1, ["mit"], 0.0)] * 2 + [(None, 1, ["cc-by"], 0.0), (None, 0, [], 0.0), (2, 0, ["all-rights-reserved"], 1.0)], key=repr)
    assert license_scan.license_scan(docs_of([])).collect() == []
    assert license_scan.license_scan(docs, templates=()).where("score > 0").collect() == []


def blocks_by_hand(text, share=0.8):
    """(size, block, label) of every window that holds the share of a template."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = set()
    for label, body in license_scan.TEMPLATES:
        of = re.findall("[a-z0-9]+", body.lower())
        size = next(n for n in (8, 32, 128, 512) if n >= len(of))
        for block in range(-(-len(words) // size)):
            held = set(words[block * size : block * size + 2 * size]) & set(of)
            if len(held) >= share * len(set(of)):
                out.add((size, block, label, round(len(held) / len(set(of)), 9)))
    return out


def test_blocks_as_by_hand(docs_of):
    found = license_scan.template_matches(docs_of(list(enumerate(TEXTS))), ["doc_id"], "text").collect()
    want = {(i, *x) for i, text in enumerate(TEXTS) for x in blocks_by_hand(text)}
    assert {(r["doc_id"], r["size"], r["block"], r["label"], round(r["containment"], 9)) for r in found} == want
    labels = {i: {x[3] for x in want if x[0] == i} for i in range(len(TEXTS))}
    assert "mit" in labels[TEXTS.index(f"Copyright (c) Nobody\n\n{WRAPPED}\n")] and any("gpl-3.0" in x for x in labels.values())


def test_endless_lines_take_seconds(docs_of):
    begin = time.perf_counter()
    lines = ["." * 200_000 + "x", " " * 200_000 + "x", "\"" * 200_000, "a " * 100_000 + " " * 100_000, "|" * 200_000]
    rows = quality_rules.quality_rules(docs_of([(i, f"{line}\nA line that ends well.") for i, line in enumerate(lines)])).collect()
    assert time.perf_counter() - begin < 60
    assert all(r["clean_text"].endswith("A line that ends well.") for r in rows)


@pytest.mark.parametrize("line", ["a.", "a", "a.\"' \t", "a.x\"", "\"", "", ".", "a… »)", "a 。\x0b", "a.\u00a0", "a\n", "a.’”", "!" * 50 + "]", "a.\"b"])
def test_endings(spark, line):
    want = bool(re.search(r"[.!?…:;。！？।]+[\"'”’»)\]]*[\x20\x09-\x0D]*\Z", line))
    df = spark.createDataFrame([(line,)], "x string")
    assert df.select(quality_rules.ends_in_sign(df["x"])).first()[0] == want


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "shard int, slot int, n int, first int, `c0` int")
    placed = sharding.with_slots(df)
    assert placed.columns == ["shard", "n", "first", "c0", "slot"] and tuple(placed.first()) == (1, 3, 4, 5, 0)
