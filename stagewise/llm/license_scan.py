"""License scans by diagonal voting: which license phrases and notices stand in a text, and where.

Every pair of consecutive words of a document is joined with the places of that pair in a fixed set of templates. A match
at word p of the document and word o of the template votes for the diagonal ``p - o``, where the template would start.
Votes are counted by document, template and diagonal; neighbouring diagonals, which inserted or missing words leave, are
merged; and the spans are verified:

* a phrase (the base) must stand word for word: all its pairs on one diagonal;
* a notice needs at least ``MIN_SHARE`` of its pairs within merged diagonals, in a span hardly longer than itself; one of
  ``LONG_PAIRS`` pairs or more needs ``LONG_SHARE`` of them, in a span of at most ``LONG_LENGTH`` times its own length.

Words are digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII. The join compares words, not only hashes.
Only DataFrame functions are used, on whole texts. The templates are a fixed table of a few hundred rows, so broadcasting
them does not depend on the data. Documents are exploded, joined and counted within one task, so a word pair that is
common everywhere is not gathered anywhere.

Defined cases: null and empty texts have no words, no labels (empty strings) and score 0. Every row is scanned by itself,
so repeated rows and null or repeated ids each give a row. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The phrases of the base, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Words of well-known license notices, and the labels they add.
NOTICES = {
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl-notice",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": (
        "apache-2.0"
    ),
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-notice",
    "released under the mit license": "mit-release",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4.0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2.0",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    # Whole texts, from the permission or the conditions to the disclaimer.
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the software the software is "
    "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
    "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
    "arising from out of or in connection with the software or the use or other dealings in the software": "mit-text",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
    "provided as is and the author disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect "
    "or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action "
    "of contract negligence or other tortious action arising out of or in connection with the use or performance of "
    "this software": "isc-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
    "distribution this software is provided by the copyright holders and contributors as is and any express or implied "
    "warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect "
    "incidental special exemplary or consequential damages including but not limited to procurement of substitute goods "
    "or services loss of use data or profits or business interruption however caused and on any theory of liability "
    "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use "
    "of this software even if advised of the possibility of such damage": "bsd-text",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
    "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
    "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
    "without warranties or conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license": "apache-2.0-header",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
    "distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-2.0-header",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation either version 3 of the license or at your option any later "
    "version this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for "
    "more details": "gpl-3.0-header",
}

MIN_SHARE = 0.9
# A notice of so many pairs is known even if one word in ten differs, which breaks two pairs each.
LONG_PAIRS, LONG_SHARE, LONG_LENGTH = 60, 0.75, 1.15
# Diagonals so near to each other belong together, and a span may be so much longer than its notice.
SLACK = 2

_BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


# Pairs of a template that one column of bits tells apart.
MASK_BITS = 62


def template_pairs(spark: SparkSession, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES) -> DataFrame:
    """The pairs of consecutive words of all templates. Templates are words with single spaces, two at least."""
    rows = []
    for exact, texts in ((True, phrases), (False, notices)):
        for text, label in texts.items():
            words = text.split(" ")
            if len(words) < 2 or not all(words):
                raise ValueError(f"a template needs two words with a single space between them: {text!r}")
            rows += [
                (len(phrases) * (not exact) + list(texts).index(text), label, exact, len(words) - 1, at, *pair)
                for at, pair in enumerate(zip(words, words[1:], strict=False))
            ]
    columns = "template int, label string, exact boolean, pairs int, offset int, t_word string, t_next string"
    return spark.createDataFrame(rows, columns).withColumn("t_gram", F.xxhash64("t_word", "t_next"))


def scan_licenses(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, str] = NOTICES,
) -> DataFrame:
    """A row for each document: id, words, base phrases with their places and labels, all labels, and a score.

    ``phrases`` and ``notices`` map templates of any length to their labels. The score is the largest share of a
    template's pairs that an accepted span has.
    """
    pairs = F.broadcast(template_pairs(documents.sparkSession, phrases, notices))
    longest = max((t.count(" ") for t in (*phrases, *notices)), default=1)
    # The pairs of a template that a span has: a bit for each, in as many columns as the longest template needs.
    masks = [f"mask_{w}" for w in range(-(-longest // MASK_BITS))]
    bit = F.expr(f"shiftleft(1L, CAST(offset % {MASK_BITS} AS INT))")

    def found_pairs() -> Column:
        return reduce(Column.__add__, [F.bit_count(m) for m in masks])

    # Two characters beyond ASCII would become ASCII letters; their stand-ins stay beyond it.
    kept = F.replace(F.replace(F.col(text), F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    words = F.array_remove(F.split(F.lower(F.coalesce(kept, F.lit(""))), _BREAKS, -1), "")
    rows = documents.select(F.col(doc_id).alias("doc_id"), words.alias("words"))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), "words"
    )
    following = F.get("words", F.col("at") + 1)
    each = rows.select("row", "doc_id", "n_words", "words", F.posexplode_outer("words").alias("at", "word")).select(
        "row", "doc_id", "n_words", "at", "word", following.alias("next"), F.xxhash64("word", following).alias("gram")
    )
    same = (F.col("gram") == F.col("t_gram")) & (F.col("word") == F.col("t_word")) & (F.col("next") == F.col("t_next"))
    document = ["row", "doc_id", "n_words"]
    # Words without a match fall into one group of their document, so that every document is counted.
    votes = (
        each.join(pairs, same, "left")
        .groupBy(*document, "template", "label", "exact", "pairs", (F.col("at") - F.col("offset")).alias("diagonal"))
        .agg(
            *[
                F.bit_or(F.when(F.floor(F.col("offset") / MASK_BITS) == w, bit).otherwise(F.lit(0).cast("long"))).alias(m)
                for w, m in enumerate(masks)
            ],
            F.min("offset").alias("low"),
            F.max("offset").alias("high"),
        )
    )
    by_diagonal = Window.partitionBy(*document, "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") > F.lag("diagonal").over(by_diagonal) + SLACK).cast("int"), F.lit(1))
    whole = F.col("exact") & (found_pairs() == F.col("pairs"))
    spans = (
        votes.withColumn("apart", apart)
        .withColumn("span", F.sum("apart").over(by_diagonal))
        .groupBy(*document, "template", "label", "exact", "pairs", "span")
        .agg(
            *[F.bit_or(m).alias(m) for m in masks],
            (F.max(F.col("diagonal") + F.col("high")) - F.min(F.col("diagonal") + F.col("low")) + 1).alias("length"),
            F.sum(whole.cast("long")).alias("places"),
            F.min(F.when(whole, F.col("diagonal"))).alias("first"),
            F.max(F.when(whole, F.col("diagonal"))).alias("last"),
        )
    )
    share = found_pairs() / F.col("pairs")
    long = F.col("pairs") >= LONG_PAIRS
    least = F.when(long, LONG_SHARE).otherwise(MIN_SHARE)
    room = F.when(long, F.floor(F.col("pairs") * LONG_LENGTH)).otherwise(F.col("pairs")) + 2 * SLACK
    accepted = F.when(F.col("exact"), F.col("places") > 0).otherwise((share >= least) & (F.col("length") <= room))
    accepted = F.coalesce(accepted, F.lit(False))

    def labels(where):
        return F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")

    return (
        spans.groupBy(*document)
        .agg(
            F.coalesce(F.sum("places"), F.lit(0)).alias("n_base"),
            F.min("first").cast("long").alias("first_word"),
            F.max("last").cast("long").alias("last_word"),
            labels(accepted & F.col("exact")).alias("base_labels"),
            labels(accepted).alias("labels"),
            F.coalesce(F.max(F.when(accepted, share)), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
