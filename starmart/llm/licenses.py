"""License scans by diagonal voting.

Every word pair of a text is joined to the word pairs of the templates. A hit at text position p and template
position q votes for the diagonal p - q: a whole template leaves all its votes on one diagonal, an edited one on a
few neighbouring diagonals, chance hits are scattered. Votes are gathered by diagonal and stretch of text, neighbouring
diagonals are merged into runs, and runs too short to be more than chance go.

The runs that are left in a window of bounded length are verified together: the longest chain of hits that goes on in the
text and in the template tells how many of the template's pairs stand there in order. A pair hit again and again counts
once, and two parts of a notice with words put in between add up.

Only DataFrame functions are used. The words of a text are exploded once, beside the word that follows; one
aggregate gathers the votes inside each task before any row is shuffled, and carries the document's own row along,
so that texts are never joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import LOWER, UPPER
from starmart.session import stage

#: Everything that is not part of a word, once A-Z are lower case.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A window of text is so many times as long as the template; windows begin at each multiple of its length.
WINDOW = 3
#: Template pairs that a run of neighbouring diagonals must hold to be more than chance.
LEAST_RUN = 3

# The phrases that count as they stand, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening sentences of the license notices, which texts quote with edits and line breaks.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided "
    "that the following conditions are met",
    "apache": "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    "gpl": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation",
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
    "hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by": "this work is licensed under a creative commons attribution",
    "all-rights-reserved": "all rights reserved no part of this publication may be reproduced",
}


def template_pairs(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per word pair of a template: ``(template, is_base, label, n_pairs, q, w0, w1)``; a fixed, small table."""
    kinds = [(t, True, label) for t, label in base.items()] + [(t, False, label) for label, t in notices.items()]
    if any(len(t.split()) < 2 for t, _, _ in kinds):
        raise ValueError("a template needs two words at least")
    parts = []
    for i, (text, is_base, label) in enumerate(kinds):
        words = F.split(F.lit(text), " ")
        parts.append(
            spark.range(1).select(
                F.lit(i).alias("template"), F.lit(is_base).alias("is_base"), F.lit(label).alias("label"),
                F.lit(len(text.split()) - 1).alias("n_pairs"),
                F.posexplode(F.arrays_zip(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1)))
                .alias("q", "pair"),
            )
        )
    pairs = reduce(DataFrame.unionAll, parts)
    return pairs.select("template", "is_base", "label", "n_pairs", "q", F.col("pair.0").alias("t0"), F.col("pair.1").alias("t1"))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for an empty or null one."""
    split = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN_WORDS)
    return F.filter(split, lambda w: w != "")


def chain_length(hits: Column, n_pairs: Column) -> Column:
    """The most hits ``(p, q)`` of an array that can follow each other with rising p and rising q."""
    in_order = F.array_sort(hits, lambda x, y: F.when(x["p"] != y["p"], F.signum(x["p"] - y["p"])).otherwise(F.signum(y["q"] - x["q"])).cast("int"))
    # ends[j]: the longest chain so far whose last hit has q = j
    longest = lambda ends, h: F.coalesce(F.array_max(F.slice(ends, F.lit(1), h["q"])), F.lit(0)) + 1
    put = lambda ends, h: F.transform(ends, lambda v, j: F.when(j == h["q"], F.greatest(v, longest(ends, h))).otherwise(v))
    return F.array_max(F.aggregate(in_order, F.array_repeat(F.lit(0), n_pairs), put))


def _verified(votes: DataFrame, min_share: float, max_shift: int) -> DataFrame:
    """The notices that stand in each text: ``doc_id, _text, label, first, last, share``."""
    doc = ["doc_id", "_text", "template", "label", "n_pairs"]
    inside = votes.filter("NOT is_base").withColumn(
        "w", F.explode(F.filter(F.sequence(F.col("stretch") - (WINDOW - 1), F.col("stretch")), lambda w: w >= 0))
    )
    inside = inside.groupBy(*doc, "w", "diagonal").agg(F.flatten(F.collect_list("qs")).alias("qs"))
    along = Window.partitionBy(*doc, "w").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along)
    inside = inside.withColumn("run", F.sum(F.when(apart <= max_shift, 0).otherwise(1)).over(along))
    hits = F.transform("qs", lambda q: F.struct((F.col("diagonal") + q).alias("p"), q.alias("q")))
    runs = inside.groupBy(*doc, "w", "run").agg(F.flatten(F.collect_list(hits)).alias("hits"))  # as many as a window has places
    positions = lambda: F.size(F.array_distinct(F.transform("hits", lambda h: h["q"])))
    windows = runs.filter(positions() >= LEAST_RUN).groupBy(*doc, "w").agg(F.flatten(F.collect_list("hits")).alias("hits"))
    windows = windows.filter(positions() >= min_share * F.col("n_pairs"))
    windows = windows.withColumn("chain", chain_length(F.col("hits"), F.col("n_pairs")))
    windows = windows.withColumn("share", F.col("chain") / F.col("n_pairs")).filter(F.col("share") >= min_share)
    # one place is seen by several windows: the best of those that overlap stays, the first among equals
    rank = F.col("chain").cast("long") * (1 << 40) - F.col("w")
    near = Window.partitionBy(*doc).orderBy("w").rangeBetween(1 - WINDOW, WINDOW - 1)
    windows = windows.withColumn("rank", rank).withColumn("best", F.max("rank").over(near)).filter("rank = best")
    places = F.transform("hits", lambda h: h["p"])
    return windows.select("doc_id", "_text", "label", F.array_min(places).alias("first"), (F.array_max(places) + 2).alias("last"), "share")


def scan(
    docs: DataFrame,
    base: dict[str, str] | None = None,
    notices: dict[str, str] | None = None,
    min_share: float = 0.6,
    max_shift: int = 3,
) -> DataFrame:
    """Licenses of every text: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    n_spans, spans``.

    A base phrase counts wherever its words stand consecutively: all its pairs vote for one diagonal (a pair holds
    both words, so full votes are the phrase itself). A notice counts if in a window of ``WINDOW`` times its length
    ``min_share`` of its pairs stand in order, each once, in runs of diagonals up to ``max_shift`` apart that hold
    ``LEAST_RUN`` pairs or more. ``score`` is 1 with a base phrase, else the largest share of a notice that counts, else 0.
    Spans are structs ``(label, first, last, share)``, words from 0, ``last`` excluded; a notice's span runs over all
    hits of its window.

    One row per input row: rows equal in ``doc_id`` and text are scanned together and given back as often as they
    came. Null or empty texts have no words and no labels; a null ``doc_id`` stays null. Only ``doc_id`` and
    ``text`` are used, other columns may have any name. An empty input gives an empty result.
    """
    spark = docs.sparkSession
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices
    pairs = template_pairs(spark, base, notices)
    pairs = pairs.withColumn("gram", F.xxhash64("t0", "t1"))
    text = docs.select("doc_id", F.xxhash64("text").alias("_text"), words_of(F.col("text")).alias("_w"))
    # the last element has no following word: it stands for the document itself, also for one without words
    words = text.select(
        "doc_id", "_text",
        F.posexplode(F.arrays_zip(
            F.concat("_w", F.array(F.lit(None).cast("string"))).alias("w0"), F.slice("_w", 2, F.greatest(F.size("_w"), F.lit(1))).alias("w1")
        )).alias("p", "w"),
    ).select("doc_id", "_text", "p", F.col("w.w0").alias("w0"), F.col("w.w1").alias("w1"))
    words = words.withColumn("gram", F.xxhash64("w0", "w1"))
    hits = words.join(
        F.broadcast(pairs), (words.gram == pairs.gram) & (words.w0 == pairs.t0) & (words.w1 == pairs.t1), "left"
    ).drop(pairs.gram)
    stretch = F.when(F.col("is_base"), 0).otherwise(F.expr("p div n_pairs")).cast("int")
    votes = hits.groupBy(
        "doc_id", "_text", "template", "is_base", "label", "n_pairs", (F.col("p") - F.col("q")).alias("diagonal"), stretch.alias("stretch")
    ).agg(
        F.collect_set("q").alias("qs"),
        F.sum(F.when(F.col("w0").isNull(), 1).otherwise(0)).alias("copies"),
        F.max(F.when(F.col("w0").isNull(), F.col("p"))).alias("n_words"),
    )
    votes = stage(votes, "votes")  # the texts are read once
    # hits of equal rows are one; the document's row (no template) says how many rows there are
    own = votes.filter("template IS NULL").select(
        "doc_id", "_text", "copies", "n_words", *[F.lit(None).cast(t).alias(c) for c, t in _FOUND.items()]
    )
    nothing = [F.lit(None).cast("long").alias("copies"), F.lit(None).cast("int").alias("n_words")]
    exact = votes.filter(F.col("is_base") & (F.size("qs") == F.col("n_pairs"))).select(
        "doc_id", "_text", *nothing, F.lit(True).alias("exact"), "label", F.col("diagonal").alias("first"),
        (F.col("diagonal") + F.col("n_pairs") + 1).alias("last"), F.lit(1.0).alias("share"),
    )
    loose = _verified(votes, min_share, max_shift).select("doc_id", "_text", *nothing, F.lit(False).alias("exact"), "label", "first", "last", "share")
    spans = own.unionByName(exact).unionByName(loose)
    labels = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    found, is_exact = F.col("label").isNotNull(), F.coalesce(F.col("exact"), F.lit(False))
    out = spans.groupBy("doc_id", "_text").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.sum(F.when(is_exact, 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(is_exact, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(is_exact, F.col("first"))).cast("long").alias("last_word"),
        labels(is_exact).alias("base_labels"), labels(found).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        F.sum(F.when(found, 1).otherwise(0)).cast("long").alias("n_spans"),
        F.array_sort(F.collect_list(F.when(found, F.struct("label", "first", "last", "share")))).alias("spans"),
        F.max("copies").alias("copies"),
    )
    return out.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("_again", "_text", "copies")


_FOUND = {"exact": "boolean", "label": "string", "first": "int", "last": "int", "share": "double"}
