"""License notices: exact phrases, and an exact set-similarity join of text blocks with templates.

DataFrame functions only. A text block is a window of words, wherever lines end: for
templates of up to n words (n is 8, 32, 128, ...) the windows of 2 n words that begin at
every n-th word, so any n words in a row stand in one of them. The join keeps every
block that holds ``share`` of a template's distinct words. Words are ordered by how many
documents of the corpus hold them, rarest first; a block that holds enough of a template
holds one of its first words (prefix filter), has enough words (length filter), and from
the first word that it holds on enough words are left in the template (positional
filter). What passes is counted.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from rolecall.functions.compute import add_once

# Phrases with their labels, and templates of notices with theirs.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("all-rights-reserved", "All rights reserved"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "You may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    # whole notices
    ("apache-2.0", """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License."""),
    ("mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE."""),
    ("isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
        OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("gpl-3.0", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
        even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
        License for more details. You should have received a copy of the GNU General Public License along with this
        program. If not, see https://www.gnu.org/licenses/."""),
    ("mpl-2.0", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
)
#: Words of the shortest class of templates; each next class has four times as many.
SHORTEST = 8
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in lower case: runs of digits, letters and everything beyond ASCII."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAK), "")


def _plain_words(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def phrase_places(words: str, phrases=PHRASES) -> Column:
    """array<struct<at, label>> of every place where a phrase's words stand one after another."""
    split = [(_plain_words(phrase), label) for phrase, label in phrases]
    here = lambda i: F.coalesce(*[
        F.when(
            F.array(*[F.get(F.col(words), i + k) for k in range(len(p))]) == F.array(*[F.lit(w) for w in p]),
            F.struct(i.alias("at"), F.lit(label).alias("label")),
        )
        for p, label in split
    ])
    # only texts with the second word of some phrase are looked through
    second = F.arrays_overlap(F.col(words), F.array(*[F.lit(w) for w in sorted({p[min(1, len(p) - 1)] for p, _ in split})]))
    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), here), lambda x: x.isNotNull())
    return F.when(second, found).otherwise(F.array().cast("array<struct<at:int,label:string>>"))


def _class_of(words: int) -> int:
    size = SHORTEST
    while size < words:
        size *= 4
    return size


def template_matches(df: DataFrame, keys: list[str], text: str, templates=TEMPLATES, share: float = 0.8) -> DataFrame:
    """(keys, size, block, label, containment) of every text block with ``share`` of a
    template's distinct words or more: the window of 2 ``size`` words from word
    ``block * size`` on, where ``size`` is the least of 8, 32, 128, ... that is no less than
    the template's words.

    The texts are read twice: to count the documents of each template word (one number
    per word comes to the driver), and to join; texts without one of the first words
    are not cut into blocks. Templates are a bounded parameter.
    """
    sets = [(label, _plain_words(body)) for label, body in templates]
    sets = [(label, _class_of(len(words)), list(dict.fromkeys(words))) for label, words in sets if words]
    if not sets:
        return df.select(*keys, F.lit(0).alias("size"), F.lit(0).alias("block"), F.lit("").alias("label"), F.lit(0.0).alias("containment")).limit(0)
    literal = lambda words: F.array(*[F.lit(w) for w in sorted(words)])
    need = [max(1, math.ceil(share * len(words) - 1e-9)) for *_, words in sets]

    every = literal({w for *_, words in sets for w in words})
    counts = df.select(F.explode(F.array_intersect(words_of(F.col(text)), every)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()
    number = {r["word"]: r["n"] for r in counts}
    ordered = [sorted(words, key=lambda w: (number.get(w, 0), w)) for *_, words in sets]
    index = [
        (word, size, label, place, least, words)
        for (label, size, _), words, least in zip(sets, ordered, need, strict=True)
        for place, word in enumerate(words[: len(words) - least + 1])
    ]
    sizes = sorted({size for _, size, _ in sets})
    first = {size: {word for word, of, *_ in index if of == size} for size in sizes}
    held = {size: {w for _, of, words in sets if of == size for w in words} for size in sizes}

    worded = add_once(df.select(*keys, F.col(text).alias("_text")), {"_w": words_of(F.col("_text"))}).drop("_text")
    worded = worded.where(F.arrays_overlap("_w", literal(set().union(*first.values()))))

    def blocks(size: int):
        places = F.filter(F.transform("_w", lambda w, i: F.when(w.isin(*sorted(first[size])), i)), lambda i: i.isNotNull())
        numbers = F.transform(places, lambda i: F.floor(i / size).cast("int"))
        numbers = F.array_distinct(F.concat(numbers, F.filter(F.transform(numbers, lambda k: k - 1), lambda k: k >= 0)))
        return F.transform(numbers, lambda k: F.struct(
            F.lit(size).alias("size"), k.alias("block"), F.array_intersect(F.slice("_w", k * size + 1, F.lit(2 * size)), literal(held[size])).alias("known")
        ))

    cut = worded.select(*keys, F.explode(F.concat(*[blocks(size) for size in sizes])).alias("_b"))
    known = add_once(cut, {"size": F.col("_b.size"), "block": F.col("_b.block"), "_known": F.col("_b.known")}).drop("_b")
    prefixes = df.sparkSession.createDataFrame(index, "_word string, size int, label string, _place int, _need int, _words array<string>")
    every_first = literal(set().union(*first.values()))
    entries = known.select(*keys, "size", "block", "_known", F.explode(F.array_intersect("_known", every_first)).alias("_word"))
    pairs = entries.join(prefixes, ["_word", "size"]).where(
        (F.size("_known") >= F.col("_need"))
        & (F.size("_words") - F.col("_place") >= F.col("_need"))
        # a pair is counted at the template's first word that the block holds
        & (F.size(F.array_intersect("_known", F.slice("_words", F.lit(1), F.col("_place")))) == 0)
    )
    same = F.size(F.array_intersect("_known", "_words"))
    return pairs.where(same >= F.col("_need")).select(*keys, "size", "block", "label", (same / F.size("_words")).alias("containment"))


def license_scan(
    df: DataFrame, id_column: str = "doc_id", text: str = "text", phrases=PHRASES, templates=TEMPLATES, share: float = 0.8
) -> DataFrame:
    """One row per row of ``df``: id, n_words, n_base, first_word, last_word, base_labels,
    labels (arrays, distinct and sorted) and score.

    ``n_base`` counts the places of all phrases; first and last word are null without
    one. ``labels`` are those of the phrases and of the template matches; ``score`` is
    the greatest containment of a match, 0 without one. Null and empty texts have no
    words; rows of one id and text get the same result each, a null id is an id like any
    other. Shuffles hold counts and labels, never texts.
    """
    keyed = df.select(F.col(id_column).alias("_id"), F.xxhash64(F.col(text)).alias("_hash"), F.col(text).alias("_text"))
    base = add_once(keyed, {"_w": words_of(F.col("_text"))}).drop("_text")
    base = add_once(base, {"n_words": F.size("_w").cast("bigint"), "_found": phrase_places("_w", phrases)}).drop("_w")
    base = base.select(
        "_id", "_hash", "n_words", F.size("_found").cast("bigint").alias("n_base"),
        F.array_min("_found.at").cast("bigint").alias("first_word"), F.array_max("_found.at").cast("bigint").alias("last_word"),
        F.array_sort(F.array_distinct("_found.label")).alias("base_labels"),
    )
    matches = template_matches(keyed, ["_id", "_hash"], "_text", templates, share).groupBy("_id", "_hash").agg(
        F.collect_set("label").alias("_labels"), F.max("containment").alias("_score")
    ).withColumnsRenamed({"_id": "_id2", "_hash": "_hash2"})
    joined = base.join(matches, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_hash") == F.col("_hash2")), "left")
    more = F.coalesce("_labels", F.array().cast("array<string>"))
    return joined.select(
        F.col("_id").alias(id_column), "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", more)).alias("labels"), F.coalesce("_score", F.lit(0.0)).alias("score"),
    )
