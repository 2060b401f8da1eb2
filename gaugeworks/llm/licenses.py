"""License scans by diagonal voting.

All runs of ``k`` words of the documents meet those of the templates in a join
on their hash.  A match at word ``d`` of a document and word ``t`` of a template
votes for the diagonal ``d - t``; a notice quoted whole gathers all its votes on
one diagonal, one with words put in or left out on a few neighbouring ones.
Votes of neighbouring diagonals are merged and the span they cover is verified.
Only Spark's own functions take part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import whole_text

#: Words of a run, and how many words may be put in or left out before a diagonal is no neighbour.
RUN_WORDS = 3
SHIFT = 4
#: The part of a notice that must be found, and the least likeness of its span.
LIKENESS = 0.85
#: The runs of all templates are broadcast up to so many: some 100 bytes each.
BROADCAST_RUNS = 100_000

# What is between words; upper case letters are words before they are lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose every place counts.
PHRASES = {
    "mit": ("under the mit license",),
    "apache-2": ("apache license version 2",),
    "cc-by-nc": ("cc by nc",),
}

# The words that licenses ask to be repeated, and usual short notices.
NOTICES = {
    "agpl-3": ("gnu affero general public license version 3",),
    "apache-2": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license",
        "licensed under the apache license version 2 0",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "cc-by": ("licensed under a creative commons attribution 4 0 international license",),
    "cc-by-nc": (
        "licensed under cc by nc 4 0",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
    ),
    "cc-by-sa": (
        "licensed under cc by sa 4 0",
        "licensed under a creative commons attribution sharealike 4 0 international license",
    ),
    "cc0": ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",),
    "epl-2": ("made available under the terms of the eclipse public license 2 0",),
    "gpl-2": ("gnu general public license version 2", "gnu general public license as published by the free software foundation version 2"),
    "gpl-3": (
        "gnu general public license version 3",
        "gnu general public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "lgpl-3": ("gnu lesser general public license version 3",),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
        "released under the mit license",
    ),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
}


def words_of(text: Column) -> Column:
    """The words of a text as they are written."""
    return F.array_remove(F.split(text, _BETWEEN, -1), "")


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.translate(word, _UPPER, _LOWER)


def _runs(words: Column, k: int) -> Column:
    """An array of all runs of ``k`` words; before them an empty one, which stands for the text itself."""
    number = F.greatest(F.size(words) - (k - 1), F.lit(0))
    kind = ",".join(f"w{i}:string" for i in range(k))
    zipped = F.arrays_zip(*[F.slice(words, i + 1, number).alias(f"w{i}") for i in range(k)])
    return F.concat(F.array(F.lit(None).cast(f"struct<{kind}>")), zipped.cast(f"array<struct<{kind}>>"))


def _run_rows(rows: DataFrame, keep: Sequence[str], k: int) -> DataFrame:
    """One row per run with its place and hash; place -1 is the text itself.

    ``lower`` is faster than what defines equal words and never tells apart
    words that are equal, so it may go into the hash.
    """
    exploded = rows.select(*keep, F.posexplode(_runs(F.col("words"), k)).alias("at", "run"))
    parts = [F.lower(F.col("run")[f"w{i}"]) for i in range(k)]
    return exploded.select(
        *keep, (F.col("at") - 1).alias("at"), F.when(F.col("at") > 0, F.xxhash64(*parts)).otherwise(F.lit(0)).alias("hash"), "run"
    )


def _templates(spark: SparkSession, phrases: Mapping[str, Sequence[str]], notices: Mapping[str, Sequence[str]]) -> list[tuple]:
    kinds = [(label, True, text) for label in sorted(phrases) for text in phrases[label]]
    kinds += [(label, False, text) for label in sorted(notices) for text in notices[label]]
    return [(number, *kind) for number, kind in enumerate(kinds)]


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, Sequence[str]] = PHRASES,
    notices: Mapping[str, Sequence[str]] = NOTICES,
    k: int = RUN_WORDS,
    shift: int = SHIFT,
    likeness: float = LIKENESS,
) -> DataFrame:
    """Per row ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base`` counts the places where all words of a phrase stand one after the
    other, ``first_word`` and ``last_word`` are the least and largest of them
    (words from 0, null without any), ``base_labels`` names the phrases found.
    ``labels`` adds the notices of which at least ``likeness`` of the words are
    found on neighbouring diagonals, in a span that is as much like the notice:
    twice the common words over the words of both.  ``score`` is the best
    likeness of what was found, 1 for a phrase and 0 for nothing; ``spans``
    lists label, first word, word after the last and likeness.  Labels are
    sorted and joined by commas; none is an empty text.

    A null text has no words.  Rows that repeat id and text give the same row
    each; a null id stays null; other columns are not looked at; an empty table
    gives an empty result.  Phrases and notices have ``k`` words at least.

    The hits of a document lie within it: neither a word of many documents nor
    a license that all of them carry gathers rows anywhere.
    """
    spark = docs.sparkSession
    templates = _templates(spark, phrases, notices)
    listed = spark.createDataFrame(templates, "template int, label string, exact boolean, text string")
    sizes = [len(text.split()) for *_, text in templates]
    if min(sizes, default=k) < k:
        raise ValueError(f"phrases and notices need {k} words")
    listed = listed.select("template", "label", "exact", F.transform(words_of(F.col("text")), lowered).alias("words"))
    known = _run_rows(listed, ["template"], k).filter("at >= 0")
    # What stands for a text meets what stands for no template.
    itself = spark.range(1).select(F.lit(-1).alias("template"), F.lit(-1).alias("at"), F.lit(0).cast("long").alias("hash"), F.lit(None).cast(known.schema["run"].dataType).alias("run"))
    known = known.unionByName(itself).select("template", F.col("at").alias("t"), "hash", F.col("run").alias("known"))
    if sum(sizes) <= BROADCAST_RUNS:
        known = F.broadcast(known)

    text = whole_text(text_col)
    rows = docs.select(ref(id_col).alias("id"), F.md5(text).alias("digest"), words_of(text).alias("words"))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    runs = _run_rows(rows, ["id", "digest", "n_words"], k)
    # Equal words, written so that the join stays one on the hash alone.
    alike = F.col("at") == F.col("t")
    for i in range(k):
        found, wanted = lowered(F.col("run")[f"w{i}"]), F.col("known")[f"w{i}"]
        same = found.between(wanted, wanted)
        alike = same if i == 0 else alike & same
    hits = runs.join(known, "hash").filter(((F.col("template") < 0) & (F.col("at") < 0)) | ((F.col("at") >= 0) & alike))
    key = ["id", "digest", "n_words"]
    diagonals = hits.groupBy(*key, "template", (F.col("at") - F.col("t")).cast("long").alias("diagonal")).agg(
        F.count("*").alias("n"), F.collect_set("t").alias("places")
    )
    facts = F.broadcast(listed.select("template", "label", "exact", F.size("words").alias("size")))
    judged = _judged(diagonals.join(facts, "template", "left"), key, k, shift, likeness)
    base = F.col("accepted") & F.col("exact")
    result = judged.groupBy(*key).agg(
        F.sum(F.when(F.col("template") < 0, F.col("n"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("begin"))).alias("first_word"),
        F.max(F.when(base, F.col("begin"))).alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("accepted"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("accepted"), F.col("likeness"))), F.lit(0.0)).alias("score"),
        F.collect_set(F.when(F.col("accepted"), F.struct("label", "begin", "end", "likeness"))).alias("spans"),
    )
    joined = [F.array_join(F.array_sort(name), ",").alias(name) for name in ("base_labels", "labels")]
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return result.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", *joined, "score", F.array_sort("spans").alias("spans"),
        copies.alias("_copy"),
    ).drop("_copy")


def _judged(diagonals: DataFrame, key: list[str], k: int, shift: int, likeness: float) -> DataFrame:
    """Votes of neighbouring diagonals merged, and whether their span is the phrase or notice."""
    near = Window.partitionBy(*key, "template").orderBy("diagonal").rangeBetween(-shift, shift)
    exact, size = F.col("exact"), F.col("size")
    placed = diagonals.withColumns(
        {
            "first": F.col("diagonal") + F.array_min("places"),
            "last": F.col("diagonal") + F.array_max("places") + k,
        }
    )
    merged = placed.withColumns(
        {
            "votes": F.array_distinct(F.flatten(F.collect_list("places").over(near))),
            "begin": F.when(exact, F.col("first")).otherwise(F.min("first").over(near)),
            "end": F.when(exact, F.col("last")).otherwise(F.max("last").over(near)),
        }
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("votes", lambda t: F.sequence(t, t + (k - 1))))))
    alike = F.when(exact, F.lit(1.0)).otherwise(2.0 * F.col("covered") / (size + F.col("end") - F.col("begin")))
    whole = F.size("places") == size - (k - 1)
    found = merged.withColumn("covered", covered).withColumn("likeness", alike)
    accepted = F.when(exact, whole).otherwise((F.col("covered") >= likeness * size) & (F.col("likeness") >= likeness))
    return found.withColumn("accepted", F.coalesce(accepted, F.lit(False)))
