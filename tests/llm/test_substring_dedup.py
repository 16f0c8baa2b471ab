"""Repeated units against a plain version of the method."""

import random
import re

import pytest

from rolecall.llm import queries, substring_dedup


def units_of(text):
    """(start, end, words) of the units of a text that have a word."""
    at, out = 0, []
    for piece in re.split(r"(?<=\n)|(?<=[.!?][\x20\x09-\x0D])|(?<=[。！？｡．؟۔।॥።။។])", text or ""):
        words = tuple(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), piece)))
        if words:
            out.append((at, at + len(piece), words))
        at += len(piece)
    return out


def plain(rows, least=0):
    """Later occurrences by (id, row, start), as (id, start, end, kept id, kept start)."""
    first, spare = {}, []
    for row, (doc, text) in sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0])):
        found = units_of(text)
        later = []
        for n, (a, z, words) in enumerate(found):
            if words in first:
                later.append((n, a, z, *first[words]))
            else:
                first[words] = (doc, a)
        runs = []
        for unit in later:
            if not runs or runs[-1][-1][0] + 1 != unit[0]:
                runs.append([])
            runs[-1].append(unit)
        for run in runs:
            if sum(z - a for _, a, z, *_ in run) >= least:
                spare += [(doc, a, z, *kept) for _, a, z, *kept in run]
    return sorted(spare, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{i}" for a in ("al", "Été", "ñ") for i in range(300)]
    sentence = lambda: " ".join(rng.choices(vocabulary, k=rng.randrange(1, 14))) + rng.choice([".", "!", "?", "。"])
    passages = [rng.choice([" ", "\n"]).join(sentence() for _ in range(6)) for _ in range(5)]
    chinese = ["今天天气很好。我们去公园散步！", "他说:你好吗？我很好。", "कल मिलेंगे। अच्छा॥"]
    rows = []
    for i in range(60):
        parts = [sentence() for _ in range(rng.randrange(1, 20))] + ["Licensed under the Apache License, Version 2.0."]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts)), f"some words before {rng.choice(passages)} and behind")
        if rng.random() < 0.3:
            parts.insert(rng.randrange(len(parts)), rng.choice(chinese))
        rows.append((i * 3 % 61, rng.choice([" ", "\n", "  \n"]).join(parts)))
    rows.append((200, rows[0][1].upper().replace("É", "É").replace("Ñ", "ñ")))
    rows += [(201, rows[1][1]), (202, rows[1][1] + " " + rows[1][1]), (203, None), (204, ""), (205, " \n ")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [0, 60])
def test_as_plain(docs_of, seed, least):
    rows = corpus(seed)
    found = substring_dedup.repeated_units(docs_of(rows).coalesce(1), least_chars=least).collect()
    want = plain(rows, least)
    assert sorted((tuple(r) for r in found), key=repr) == want
    assert want and (least == 0) == any(z - a < 10 for _, a, z, *_ in want if least == 0)


def test_every_later_occurrence_goes(docs_of):
    rows = [(1, "Short line.\nshort  LINE.\nOther."), (2, "Other. More.\nShort line."), (3, "天。地。天。")]
    found = sorted(map(tuple, substring_dedup.repeated_units(docs_of(rows)).collect()))
    assert found == [(1, 12, 25, 1, 0), (2, 0, 7, 1, 25), (2, 13, 24, 1, 0), (3, 4, 6, 3, 0)]


def test_rows_of_one_id_are_rows(docs_of):
    text = " ".join(f"w{i}" for i in range(30)) + "."
    rows = [(1, text), (1, text), (None, text), (None, "x. " + text), (2, "y."), (2, "y.")]
    found = sorted(((r["doc_id"], r["start"], r["kept_id"]) for r in substring_dedup.repeated_units(docs_of(rows).coalesce(1)).collect()), key=repr)
    assert found == sorted([(1, 0, 1), (None, 0, 1), (None, 3, 1), (2, 0, 2)], key=repr)


def test_runs_do_not_cross_rows(docs_of):
    rows = [(i, f"Phrase number {i}.") for i in range(20)] + [(None, f"Phrase number {i}.") for i in range(20)]
    assert substring_dedup.repeated_units(docs_of(rows), least_chars=40).collect() == []
    assert len(substring_dedup.repeated_units(docs_of(rows)).collect()) == 20


def test_texts_without_the_units(docs_of):
    rows = [(1, "éa b c d e f. x"), (2, "start. éa b c d e f. éa b c d e f. end"), (3, None), (None, "éa b c d e f. q")]
    docs = docs_of(rows).withColumnRenamed("source", "id_of_removed").withColumnRenamed("lang", "removed")
    removed = substring_dedup.repeated_units(docs)
    out = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in substring_dedup.remove_units(docs, removed).collect()}
    assert out == {1: ("éa b c d e f. x", []), 2: ("start. end", [(7, 21), (21, 35)]), 3: (None, []), None: ("q", [(0, 14)])}


def test_hot_digests_are_split(spark, docs_of, tmp_path):
    """The groups are stored, so the join that brings them back can split one digest."""
    docs_of([(i, "The same line of all.\n" + ("" if i % 3 else f"Line {i}.")) for i in range(6000)]).write.parquet(f"{tmp_path}/d")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = substring_dedup.repeated_units(spark.read.parquet(f"{tmp_path}/d").repartition(24))
        assert len(found.collect()) == 5999
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_one_long_line(docs_of):
    line = "one line without an end " * 20_000
    rows = [(1, line), (2, line + "!"), (3, "x\n" + line), (4, "." * 200_000), (5, "。" * 50_000)]
    found = substring_dedup.repeated_units(docs_of(rows), least_chars=80).collect()
    assert [r["doc_id"] for r in found if r["doc_id"] < 5] == [3] and sum(r["doc_id"] == 5 for r in found) == 49_999


def test_empty_tables(spark, docs_of, tmp_path):
    assert substring_dedup.repeated_units(docs_of([])).collect() == []
    text = " ".join(f"w{i}" for i in range(30)) + "."
    docs_of([(1, text), (2, text), (3, "Short.\nShort.")]).write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["doc_id"] for r in queries.QUERIES["op1_substring_dedup"](spark, str(tmp_path)).collect()] == [2]
