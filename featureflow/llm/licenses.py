"""License phrases in texts by diagonal voting.

Every three consecutive words of a text are hashed and joined to the places of the same three words in
license templates. A match votes for the diagonal text place minus template place; votes are counted per
text, template and diagonal, neighbouring diagonals (a few words inserted or left out) are merged, and a
span counts if its words cover enough of the template. The join compares the words themselves as well as
their hashes, so the votes of one diagonal are a verified run of equal words.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

GRAM = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Exact phrases and the labels they give.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
# Longer notices that may be worded a little differently.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved"),
)
LEAST_SHARE = 0.7
# Diagonals at most this far apart belong to one span.
DRIFT = 2


def folded_words(text: str) -> Column:
    """Lower-case words of letters, digits and everything beyond ASCII; none for null.

    Letters beyond ASCII are lower-cased as well, which changes no count and, but for the Kelvin sign,
    makes no ASCII word; no base phrase has a k.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS), "")


def _grams(words: Column) -> Column:
    """Three consecutive words from every place that has them, as structs."""
    size = F.greatest(F.size(words) - (GRAM - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, j + 1, size).alias(f"w{j}") for j in range(GRAM)])


def template_places(spark: SparkSession, base: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...]) -> DataFrame:
    """(template, label, base, grams, at, w0, w1, w2): one row per place of the given templates."""
    rows = []
    for k, (label, phrase) in enumerate([*base, *notices]):
        words = [w for w in re.split(SEPARATORS, phrase.lower()) if w]
        if len(words) < GRAM:
            raise ValueError(f"{phrase!r} has fewer than {GRAM} words")
        grams = len(words) - GRAM + 1
        rows += [(k, label, k < len(base), grams, at, *words[at : at + GRAM]) for at in range(grams)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, grams int, at int, w0 string, w1 string, w2 string")


def scan(
    docs: DataFrame,
    base: tuple[tuple[str, str], ...] = BASE,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    least_share: float = LEAST_SHARE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, h, n_words, spans, score) per row: the license spans of each text.

    ``spans``: (label, base, first_word, end_word, share), by place. ``base`` spans are exact occurrences of a
    base phrase; the others cover ``least_share`` of a notice or more. ``score`` is the largest share of a
    template found on merged diagonals, below ``least_share`` too, and 0 where there is none.

    Defined results: null and empty texts have no words and no spans; rows with the same ``doc_id`` and text
    have the same result; an empty table gives an empty one. Only the templates are broadcast, whose number
    the caller sets.
    """
    places = template_places(docs.sparkSession, base, notices)
    places = F.broadcast(places.withColumn("gram", F.xxhash64("w0", "w1", "w2")))
    hashed = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("h"), folded_words(text).alias("words"))
    rolled = hashed.select("doc_id", "h", F.posexplode(_grams(F.col("words"))).alias("place", "g"))
    rolled = rolled.select("doc_id", "h", "place", "g.w0", "g.w1", "g.w2")
    same = [rolled[f"w{j}"] == places[f"w{j}"] for j in range(GRAM)]
    votes = rolled.join(places, [F.xxhash64(rolled["w0"], rolled["w1"], rolled["w2"]) == places["gram"], *same])
    votes = votes.select("doc_id", "h", "template", "label", "base", "grams", "at", "place")

    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    lines = votes.groupBy("doc_id", "h", "template", "label", "base", "grams", diagonal).agg(F.collect_set("at").alias("ats"))
    exact = lines.where(F.col("base") & (F.size("ats") == F.col("grams")))
    exact = exact.select("doc_id", "h", "label", "base", F.col("diagonal").alias("first_word"), (F.col("diagonal") + F.col("grams") + GRAM - 1).alias("end_word"), F.lit(1.0).alias("share"))

    in_text = W.partitionBy("doc_id", "h", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(in_text)
    band = F.sum(F.when(gap <= DRIFT, 0).otherwise(1)).over(in_text.rowsBetween(W.unboundedPreceding, 0))
    bands = lines.withColumn("band", band).groupBy("doc_id", "h", "template", "label", "band").agg(
        F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("ats") + GRAM).alias("end_word"),
        F.first("grams").alias("grams"),
    )
    merged = bands.select("doc_id", "h", "label", F.lit(False).alias("base"), "first_word", "end_word", (F.size("ats") / F.col("grams")).alias("share"))
    found = exact.unionByName(merged)
    kept = F.col("base") | (F.col("share") >= least_share)
    span = F.struct(F.col("first_word").cast("bigint").alias("first_word"), F.col("end_word").cast("bigint").alias("end_word"), "label", "base", "share")
    per_text = found.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.when(kept, span))).alias("spans"), F.max("share").alias("score"))
    per_text = per_text.withColumnsRenamed({"doc_id": "__id", "h": "__h"})

    counted = hashed.select("doc_id", "h", F.size("words").cast("bigint").alias("n_words"))
    joined = counted.join(per_text, counted["doc_id"].eqNullSafe(per_text["__id"]) & (counted["h"] == per_text["__h"]), "left")
    none = F.array().cast("array<struct<first_word:bigint,end_word:bigint,label:string,base:boolean,share:double>>")
    return joined.select("doc_id", "h", "n_words", F.coalesce("spans", none).alias("spans"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _labels(spans: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def summary(scanned: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of ``scan``'s rows."""
    exact = F.filter("spans", lambda s: s["base"])
    starts = F.transform(exact, lambda s: s["first_word"])
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(exact).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(exact).alias("base_labels"),
        _labels(F.col("spans")).alias("labels"),
        "score",
    )
