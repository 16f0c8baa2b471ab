"""Near-duplicate documents: a T-occurrence search (DivideSkip) over word n-grams.

How the search is spread. A set's rarest shingles (fewer than it may miss in a partner)
are its short lists: two sets that link share one of them. The sets of each such list
that are of like size meet in a block with the least of them; lists with the same least
set share a block. A linked pair is thus found in some block, and inside a block
DivideSkip finds every link that joins two groups not yet joined. Nothing lists pairs.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from rolecall.llm import batches, sketches, wordbytes
from rolecall.llm.components import components
from rolecall.sources.sinks import stage

#: Counters that shingles share to be ordered by frequency. More of them tell rare shingles
#: apart better; the result is the same with any number.
SKETCH = 1 << 22
#: Lists that may be longer than this are met by a join that can split them.
LONG_LIST = 50_000
#: Least and most bits of a set's parities; the result is the same with any powers of two from 64 on.
PARITIES = 1 << 6, 1 << 20
#: A block is screened, each set against each, if its sets times its shingles (400 more for
#: each set) are not more; a larger one is searched as it is.
SCREENED = 2e10
#: Bytes of parities that are compared at once.
COMPARED = 1 << 22
#: Binary searches that are done at once inside a block, about.
PROBES = 1 << 14


def document_sets(column, width: int, lower: bool) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = wordbytes.utf8(column)
    for first, last in wordbytes.steps(offsets):
        part = data[offsets[first] : offsets[last]]
        part = wordbytes.LOWER[part] if lower else part
        words = wordbytes.find_words(part, offsets[first : last + 1] - offsets[first])
        hashes, of = wordbytes.shingles(wordbytes.hash_words(part, words), words, width)
        for a, b in zip(of[:-1], of[1:], strict=True):
            yield np.unique(hashes[a:b])


def set_id(tokens: np.ndarray) -> int:
    """64-bit hash of a set."""
    total = np.add.reduce(wordbytes.mix(tokens ^ np.uint64(0xD1B54A32D192ED03)), dtype=np.uint64)
    return int(wordbytes.mix(np.array([total ^ np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _level(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(4 * np.log2(counts.astype(float) + 1))).astype(np.uint8)


def parities(tokens: np.ndarray) -> bytes:
    """Whether an odd number of a set's tokens has each of the low values modulo a power of two
    at or above their number."""
    bits = min(PARITIES[1], max(PARITIES[0], 1 << (len(tokens) - 1).bit_length()))
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def may_link(begins: np.ndarray, n: np.ndarray, parity: pa.BinaryArray, far: np.ndarray, percent: int) -> np.ndarray:
    """Whether each set may be linked with another one of its block, one of both being
    ``far``, by the sizes and the parities; no set that is linked so gets lost. Blocks
    lie one after another and begin at ``begins``, each with its far sets first."""
    width = np.asarray(pc.binary_length(parity)).astype(np.int64)
    classes, of = np.unique(width, return_inverse=True)
    at, matrices = np.empty(len(n), np.int64), {}
    for k, w in enumerate(classes):
        mine = np.flatnonzero(of == k)
        at[mine] = np.arange(len(mine))
        matrices[k, k] = np.frombuffer(b"".join(parity.take(pa.array(mine)).to_pylist()), np.uint64).reshape(-1, w // 8)

    def folded(k: int, to: int) -> np.ndarray:
        # parities modulo half as much are those of the two halves, added up
        if (k, to) not in matrices:
            wide = matrices[k, k]
            matrices[k, to] = np.bitwise_xor.reduce(wide.reshape(len(wide), -1, classes[to] // 8), axis=1)
        return matrices[k, to]

    length = np.diff(np.append(begins, len(n)))
    begin = np.repeat(begins, length)
    # sets of the block before each that it is compared with
    before = np.where(far, np.arange(len(n)) - begin, np.repeat(np.add.reduceat(far, begins, dtype=np.int64), length) if len(n) else begin)
    ends = np.cumsum(before)
    linked = np.zeros(len(n), bool)
    first = 0
    while first < len(n):
        done = ends[first] - before[first]
        last = max(first + 1, int(np.searchsorted(ends, done + COMPARED // 16, "right")))
        b = np.repeat(np.arange(first, last), before[first:last])
        a = begin[b] + np.arange(len(b)) - np.repeat(ends[first:last] - before[first:last] - done, before[first:last])
        close = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        a, b = a[close], b[close]
        a, b = np.where(of[a] <= of[b], a, b), np.where(of[a] <= of[b], b, a)
        kinds, kind = np.unique(of[a] * len(classes) + of[b], return_inverse=True)
        for i, both in enumerate(kinds):
            small, large = divmod(int(both), len(classes))
            x, y = a[kind == i], b[kind == i]
            step = max(1, COMPARED // int(classes[small]))
            for k in range(0, len(x), step):
                u, v = x[k : k + step], y[k : k + step]
                differ = np.bitwise_count(matrices[small, small][at[u]] ^ folded(large, small)[at[v]]).sum(axis=1, dtype=np.int64)
                may = (100 + percent) * differ <= (100 - percent) * (n[u] + n[v])
                linked[u[may]] = linked[v[may]] = True
        first = last
    return linked


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


@dataclass
class Lists:
    """For each token of a block the sets that hold it, in ascending order, one list after another."""

    owners: np.ndarray  # the lists
    begin: np.ndarray  # of each token
    length: np.ndarray
    keys: np.ndarray  # token * sets + set, ascending, of each entry
    sets: int

    def entries(self, tokens: np.ndarray) -> np.ndarray:
        length = self.length[tokens]
        return self.owners[np.repeat(self.begin[tokens] - np.cumsum(length) + length, length) + np.arange(length.sum())]


def divide_skip(query: int, tokens: np.ndarray, lists: Lists, least: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sets, shared tokens) of every set but ``query`` in ``least`` or more of the lists
    of ``tokens``; sets that are ``known`` are not looked up.

    The longest lists are set aside; the short ones are merged and counted, and what they
    hold often enough is looked up in the long ones, as long as it can be in enough of
    them: by binary search, or where that would be more work by counting these as well.
    """
    tokens = tokens[np.argsort(lists.length[tokens], kind="stable")]
    longest = lists.length[tokens[-1]]
    aside = min(least - 1, int(least / (0.0085 * np.log2(longest + 1) + 1)))
    short, long = tokens[: len(tokens) - aside], tokens[len(tokens) - aside :]
    entries = lists.entries(short)
    if len(entries) * 8 < lists.sets:
        found, count = np.unique(entries, return_counts=True)
    else:
        count = np.bincount(entries, minlength=lists.sets)
        found = np.flatnonzero(count)
        count = count[found]
    kept = (count >= least - aside) & (found != query) & ~known[found]
    found, count = found[kept], count[kept]
    first = 0
    while first < aside and len(found):
        # some lists for all sets, so that the probes stay few
        last = min(aside, first + max(16, PROBES // len(found)))
        some = np.sort(long[first:last])
        if lists.length[some].sum() + lists.sets < 8 * len(some) * len(found):
            count = count + np.bincount(lists.entries(some), minlength=lists.sets)[found]
        else:
            probes = some[:, None] * lists.sets + found
            at = np.searchsorted(lists.keys, probes)
            count = count + (lists.keys[np.minimum(at, len(lists.keys) - 1)] == probes).sum(axis=0)
        kept = count + (aside - last) >= least
        found, count, first = found[kept], count[kept], last
    return found, count


def links_of_block(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links between the sets (by index) that connect them as all links together would.

    A set is a query as long as it is not in the largest connected group; links inside
    a group change nothing, and a link between two groups has an end outside the largest.
    """
    m = len(sets)
    group, held = np.arange(m), [[k] for k in range(m)]
    n = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")  # owners of a token ascend
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[order[1:]] != tokens[order[:-1]]
    begin, token = np.flatnonzero(new), np.cumsum(new) - 1
    owners = np.repeat(np.arange(m), n)[order]
    lists = Lists(owners, begin, np.diff(np.append(begin, len(tokens))), token * m + owners, m)
    place = np.empty(len(tokens), np.int64)
    place[order] = token
    shared = lists.length[place] > 1
    first = np.concatenate([[0], np.cumsum(n)])

    largest = 0  # a group's number
    waiting = list(range(m))
    while waiting:
        outside = []
        for q in waiting:
            if len(held[largest]) > 1 and group[q] == largest:
                outside.append(q)
                continue
            a, b = first[q], first[q + 1]
            mine = place[a:b][shared[a:b]]
            least = _least_overlap(len(sets[q]), percent)
            if len(mine) < least:
                continue
            found, same = divide_skip(q, mine, lists, least, group == group[q])
            for other in found[100 * same >= percent * (n[q] + n[found] - same)].tolist():
                if group[q] != group[other]:
                    yield q, other
                    x, y = sorted((int(group[q]), int(group[other])), key=lambda g: len(held[g]))
                    group[held[x]] = y
                    held[y] += held[x]
                    held[x] = []
                    if len(held[y]) > len(held[largest]):
                        largest = y
        # those that were in a group which is no longer the largest
        waiting = [q for q in outside if group[q] != largest]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64))


def _band(percent: int) -> float:
    """Linked sets are of one size band or of two neighbours, floor(ln(size) / this)."""
    return -1.000001 * math.log(percent / 100)


def _meet(named: DataFrame, percent: int) -> DataFrame:
    """(lead, node, n) of every set in a short list with another set of like size. A list is
    split into pairs of neighbouring bands; the least set of each leads it. The sketch
    counts no shingle too low, so no list here is longer than LONG_LIST."""

    def meet(arrow):
        held = [np.zeros(0, np.int64)] * 3
        for batch in _and_none(arrow):
            if batch is not None:
                held = [np.concatenate([h, np.asarray(batch[c])]) for h, c in zip(held, ("token", "node", "n"), strict=True)]
            token, node, n = held
            # the last list may go on in the next batch
            whole = len(token) if batch is None else int(np.searchsorted(token, token[-1])) if len(token) else 0
            held = [x[whole:] for x in held]
            token, node, n = token[:whole], node[:whole], n[:whole]
            same = token[1:] == token[:-1]
            shared = np.zeros(len(token), bool)
            shared[1:] |= same
            shared[:-1] |= same
            token, node, n = token[shared], node[shared], n[shared]
            band = np.floor(np.log(n) / _band(percent)).astype(np.int64)
            token, node, n, band = np.tile(token, 2), np.tile(node, 2), np.tile(n, 2), np.concatenate([band, band + 1])
            order = np.lexsort([node, band, token])
            token, node, n, band = token[order], node[order], n[order], band[order]
            first = np.ones(len(token), bool)
            first[1:] = (token[1:] != token[:-1]) | (band[1:] != band[:-1])
            group = np.cumsum(first) - 1
            begins = np.flatnonzero(first)
            ends = np.append(begins[1:], len(token)) - 1
            several = (node[begins] != node[ends])[group] if len(begins) else first
            lead, node, n = node[begins][group][several] if len(begins) else node, node[several], n[several]
            order = np.lexsort([node, lead])
            lead, node, n = lead[order], node[order], n[order]
            first = np.ones(len(lead), bool)
            first[1:] = (lead[1:] != lead[:-1]) | (node[1:] != node[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[first]) for x in (lead, node, n)], ["lead", "node", "n"])

    entries = named.select("node", "n", F.explode("rare").alias("token"))
    return entries.repartition("token").sortWithinPartitions("token").mapInArrow(meet, "lead bigint, node bigint, n bigint")


def _and_none(items):
    yield from items
    yield None


def _meet_long(named: DataFrame, percent: int) -> DataFrame:
    """The same for shingles that may be in very many sets: minima are taken map-side and
    stored, so that the join which takes them back to the sets can be split within one
    shingle (an aggregate on the join's own keys would leave nothing to split)."""
    lists = lambda rows, *key: rows.groupBy(*key).agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last")
    band = F.floor(F.log("n") / _band(percent))
    entries = named.select("node", "n", F.explode("long").alias("token"))
    banded = entries.select("token", "node", "n", F.explode(F.array(band, band + 1)).alias("band"))
    return banded.join(stage(lists(banded, "token", "band"), "lists"), ["token", "band"]).select("lead", "node", "n")


def _screen(blocks: DataFrame, parities_of: DataFrame, percent: int) -> DataFrame:
    """``blocks`` (lead, part, node, far) without the sets that can be linked with no other of
    their block, one of both being far. A lead stays as long as another set does."""

    def screen(arrow):
        held: list[pa.RecordBatch] = []
        for batch in _and_none(arrow):
            held += [] if batch is None or not batch.num_rows else [batch]
            if not held:
                continue
            lead, part = (np.concatenate([np.asarray(x[key]) for x in held]) for key in ("lead", "part"))
            begins = np.concatenate([[0], np.flatnonzero((lead[1:] != lead[:-1]) | (part[1:] != part[:-1])) + 1])
            # the last block may go on in the next batch
            whole = len(lead) if batch is None else int(begins[-1])
            if not whole:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            held = table.slice(whole).to_batches()
            begins, table = begins[begins < whole], table.slice(0, whole)
            node, n, far = (np.asarray(table[key]) for key in ("node", "n", "far"))
            linked = may_link(begins, n, table["parity"].combine_chunks(), far, percent)
            any_linked = np.repeat(np.logical_or.reduceat(linked, begins), np.diff(np.append(begins, whole)))
            linked |= (node == lead[:whole]) & any_linked
            yield pa.RecordBatch.from_arrays([pa.array(x[linked]) for x in (lead[:whole], part[:whole], node, n)], ["lead", "part", "node", "n"])
            batches.give_back()

    dealt = blocks.join(parities_of, "node").select("lead", "part", "node", "far", "n", "parity").repartition("lead", "part")
    return dealt.sortWithinPartitions("lead", "part", F.desc("far")).mapInArrow(screen, "lead bigint, part bigint, node bigint, n bigint")


def _search(blocks: DataFrame, width: int, percent: int, lower: bool) -> DataFrame:
    """Links within each block (lead, part), and for a lead with several parts the sets
    that are not connected with it there (b is null)."""

    def search(arrow):
        loosen = zstandard.ZstdDecompressor()
        for table in batches.runs(arrow, ["lead", "part"]):
            ids, at = np.unique(np.asarray(table["node"]), return_index=True)
            texts = table["packed"].take(pa.array(at)).to_pylist()
            sets = list(document_sets(pa.array([loosen.decompress(t).decode() for t in texts], pa.large_string()), width, lower))
            lead, several = table["lead"][0].as_py(), table["parts"][0].as_py() > 1
            links = list(links_of_block(sets, percent))
            a, b = [int(ids[x]) for x, _ in links], [int(ids[y]) for _, y in links]
            if several:
                near, added = {lead}, True
                while added:
                    more = {y for x, y in zip(a + b, b + a, strict=True) if x in near} - near
                    added = bool(more)
                    near |= more
                far = [int(x) for x in ids if int(x) not in near]
                a, b = a + far, b + [None] * len(far)
            n, part = len(a), table["part"][0].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([lead] * n, pa.int64()), pa.array([part] * n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                ["lead", "part", "a", "b"],
            )

    dealt = blocks.repartition("lead", "part").sortWithinPartitions("lead", "part")
    return dealt.mapInArrow(search, "lead bigint, part bigint, a bigint, b bigint")


def ngram_components(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85,
    lower: bool = True, block_tokens: int = 500_000,
) -> DataFrame:
    """(id, n_shingles, component_id, text_hash, group_id) for every row of ``df``.

    Rows link when their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more; ``component_id`` is the smallest id reachable by links.
    Exact up to 64-bit hashes of words, shingles and sets; equal sets are one set from
    the start, so copies meet nobody twice. ``group_id`` tells groups of linked rows apart
    even where ids repeat, and is null where nothing can link. Null, empty and blank texts have no shingles
    and are linked with nothing; a row with a null id is linked with nothing and gets a
    null component. Rows that repeat an id each get a row.

    Blocks above ``block_tokens`` shingles are searched in parts, each with the lead;
    what is not connected with the lead in its part is then searched against all parts.
    """
    spark = df.sparkSession
    docs = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))

    def count(batch, array):
        data, offsets = wordbytes.utf8(batch["text"])
        for first, last in wordbytes.steps(offsets):
            part = data[offsets[first] : offsets[last]]
            part = wordbytes.LOWER[part] if lower else part
            words = wordbytes.find_words(part, offsets[first : last + 1] - offsets[first])
            hashes, _ = wordbytes.shingles(wordbytes.hash_words(part, words), words, width)
            np.add.at(array, (hashes & np.uint64(SKETCH - 1)).astype(np.int64), 1)

    # how common a shingle is, by a counter that it shares with others: any order serves, rare first is fast
    counts = sketches.add_up(docs.select("text"), count, SKETCH, np.int64)
    level = spark.sparkContext.broadcast(_level(counts))
    hot = int(_level(np.array([LONG_LIST]))[0])

    def describe(arrow):
        seen: set[int] = set()
        for batch in arrow:
            sizes, names, rare, long, parity = [], [], [], [], []
            for there, tokens in zip(batch["id"].is_valid().to_pylist(), document_sets(batch["text"], width, lower), strict=True):
                sizes.append(len(tokens))
                names.append(set_id(tokens))
                if not len(tokens) or not there or names[-1] in seen:  # for a copy in this task, they are there already
                    rare.append(tokens[:0])
                    long.append(tokens[:0])
                    parity.append(None)
                    continue
                of = level.value[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]
                order = np.argsort((of.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8)), kind="stable")
                order = order[: len(tokens) - _least_overlap(len(tokens), percent) + 1]
                rare.append(tokens[order[of[order] < hot]])
                long.append(tokens[order[of[order] >= hot]])
                parity.append(parities(tokens))
                seen.add(names[-1])
                if len(seen) > 1_000_000:
                    seen.clear()
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["text_hash"], pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), _lists(rare), _lists(long), pa.array(parity, pa.binary())],
                ["id", "text_hash", "n", "node", "rare", "long", "parity"],
            )
            batches.give_back()

    described = "id bigint, text_hash bigint, n bigint, node bigint, rare array<bigint>, long array<bigint>, parity binary"
    sets = stage(docs.mapInArrow(describe, described), "sets")
    named = sets.where("id is not null and n > 0")
    pairs = _meet(named, percent)
    if not named.where("size(long) > 0").isEmpty():
        pairs = pairs.unionByName(_meet_long(named, percent))
    # leads differ from token to token but are few in a group of near copies
    members = stage(pairs.distinct(), "members")
    parities_of = named.where("parity is not null").select("node", "n", "parity").dropDuplicates(["node"])
    work = members.groupBy("lead").agg((F.count(F.lit(1)) * F.sum(F.col("n") + 400).cast("double")).alias("work"))
    placed, zero = members.join(work, "lead"), F.lit(0).cast("bigint")
    little = placed.where(F.col("work") <= SCREENED).select("lead", zero.alias("part"), "node", F.lit(True).alias("far"))
    much = placed.where(F.col("work") > SCREENED)
    members = _screen(little, parities_of, percent).select("lead", "node", "n").unionByName(much.select("lead", "node", "n"))
    members = stage(members, "screened")

    nodes = members.select("node").distinct()
    chosen = stage(named.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id")), "chosen")
    wanted = spark.sparkContext.broadcast(sketches.id_filter(chosen, "id"))

    def packed(arrow):
        squeeze, seen = zstandard.ZstdCompressor(), set()
        for batch in arrow:
            batch = batch.filter(pa.array(sketches.holds(wanted.value, batch["id"])))
            names, texts = [], []
            for name, row in zip(map(set_id, document_sets(batch["text"], width, lower)), batch["text"], strict=True):
                if name in seen:  # a copy of a set: many rows may repeat an id or pass by chance
                    continue
                seen.add(name)
                names.append(name)
                texts.append(squeeze.compress((row.as_py() or "").encode()))
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.binary())], ["node", "packed"])
            batches.give_back()

    # the filter lets other rows pass: other sets join nothing, and of equal sets one text meets the blocks
    texts = docs.select("id", "text").mapInArrow(packed, "node bigint, packed binary").dropDuplicates(["node"])

    sizes = members.groupBy("lead").agg((F.lit(1) + F.floor(F.sum("n") / block_tokens)).alias("parts"))
    placed = members.join(sizes, "lead")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    own = placed.where("node <> lead").select("lead", part.alias("part"), "parts", "node")
    leads = sizes.select("lead", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), "parts", F.col("lead").alias("node"))
    search = lambda blocks: _search(blocks.join(texts, "node"), width, percent, lower)
    found = stage(search(own.unionByName(leads)), "found")
    links = found.where("b is not null").select("a", "b")

    far = found.where("b is null").select("lead", "part", F.col("a").alias("node"))
    if not far.isEmpty():
        groups = far.groupBy("lead").agg((F.lit(1) + F.floor(F.count(F.lit(1)) / 1000)).alias("groups"))
        far = far.join(groups, "lead").join(sizes, "lead").withColumn("group", F.pmod(F.xxhash64("node", F.lit(7)), F.col("groups")))
        number = lambda of: F.sequence(F.lit(0).cast("bigint"), F.col(of) - 1)
        across = far.select("lead", F.explode(number("parts")).alias("part"), "group", "groups", "node", F.lit(True).alias("far"))
        standing = own.join(groups, "lead").select("lead", "part", F.explode(number("groups")).alias("group"), "groups", "node", F.lit(False).alias("far"))
        tile = (F.col("part") * F.col("groups") + F.col("group")).alias("part")
        # a set may be in a tile both as a far and as a standing one
        tiles = across.unionByName(standing).groupBy("lead", tile, "node").agg(F.max("far").alias("far"))
        tiles = stage(_screen(tiles, parities_of, percent), "tiles").select("lead", "part", F.lit(1).cast("bigint").alias("parts"), "node")
        links = links.unionByName(search(tiles).select("a", "b"))
    roots = components(links).withColumnsRenamed({"node": "_node", "root": "_root"})
    smallest = named.groupBy("node").agg(F.min("id").alias("least"))
    classes = smallest.join(roots, F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("_root", "node"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = classes.select("node", "root").join(least, "root").select(F.col("node").alias("_node"), "root", "component_id")
    alone = F.when(F.col("n") == 0, F.col("id"))
    return sets.join(labels, (sets["node"] == labels["_node"]) & (sets["n"] > 0) & sets["id"].isNotNull(), "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component_id", alone).alias("component_id"), "text_hash",
        F.col("root").alias("group_id"),
    )


def one_of_each(df: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each group of linked rows: the one with the smallest id (of
    rows that repeat it, one). Rows without shingles or with a null id stay, but of equal
    rows with one id one stays. Only rows whose id is among those to drop are shuffled."""
    groups = stage(ngram_components(df, id_column, text, **options), "groups").where(f"{id_column} is not null")
    linked = groups.where("n_shingles > 0")
    first = linked.where(F.col(id_column) == F.col("component_id")).groupBy("group_id").agg(F.min("text_hash").alias("text_hash"))
    keys = ["group_id", "text_hash"]
    apart = linked.select(id_column, *keys, (F.col(id_column) != F.col("component_id")).alias("_later"))
    later = apart.where("_later").select(id_column, "text_hash")
    other = apart.where("not _later").join(first.select(*keys), keys, "left_anti").select(id_column, "text_hash")
    dropped = stage(later.unionByName(other).distinct(), "dropped")
    again = groups.groupBy(id_column, "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bitmap = sketches.id_filter(dropped.select(id_column).unionByName(again.select(id_column)), id_column)
    suspect = F.coalesce(sketches.may_be_in(df.sparkSession, bitmap, id_column), F.lit(False))
    marked = df.withColumn("_text_hash", F.xxhash64(text))
    gone = dropped.withColumnsRenamed({id_column: "_id", "text_hash": "_hash"})
    checked = marked.where(suspect).join(gone, (F.col(id_column) == F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left_anti")
    return marked.where(~suspect).unionByName(checked.dropDuplicates([id_column, "_text_hash"])).drop("_text_hash")
