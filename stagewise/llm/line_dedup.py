"""Line dedup: windows of three consecutive lines that occur again are removed, all over the corpus.

Lines are what newlines separate, compared as they are. Of equal windows the first stays: that in the document with the
smallest id, at the smallest place in it. Each later occurrence covers its three lines; covered places are merged into
runs, and the lines of the runs go. Windows overlap, so a passage of n >= 3 repeated lines goes as a whole. Where a
window repeats within a run of its own lines (``a a a a``), the later places go though they overlap the first.

Only DataFrame functions are used. Windows are compared by two 64-bit hashes of their lines. The first place of each
window is a grouped minimum, combined before the shuffle, so a window that a third of all documents have is one row per
task there; the join back is an inner join of shuffled sides, which adaptive execution splits where a window is hot.

Defined cases: a null text has no lines and stays null. Texts with fewer than three lines are left alone, and so are
windows of three blank lines (white space only). Rows equal in id and text are one document: each gets the same result
and none counts as later than another. Null ids come first in the order. With equal ids and different texts, a hash of
the text decides the order. Columns of the input named like an output are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagewise.llm.names import free_names
from stagewise.session import settle

WIDTH = 3


def _key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text), F.lit("row"))


def line_windows(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each window that has a line that is not blank: its two hashes, its document and its first line."""
    lines = F.split(F.col("text"), "\n", -1)
    whole = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole = whole.select("doc_id", _key("doc_id", "text").alias("key"), lines.alias("lines"))
    whole = whole.where(F.size("lines") >= WIDTH)
    each = whole.select("doc_id", "key", "lines", F.posexplode("lines").alias("at", "line"))
    two, three = F.get("lines", F.col("at") + 1), F.get("lines", F.col("at") + 2)
    blank = F.trim(F.regexp_replace(F.concat("line", two, three), r"\s", "")) == ""
    return each.where((F.col("at") <= F.size("lines") - WIDTH) & ~blank).select(
        F.xxhash64("line", two, three).alias("h1"),
        F.xxhash64(three, F.lit("|"), two, F.lit("|"), F.col("line")).alias("h2"),
        "doc_id",
        "key",
        "at",
    )


def repeated_runs(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """By document key, the merged [first, end) runs of lines that later occurrences cover."""
    windows = line_windows(documents, doc_id, text)
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("doc_id", "key", "at")).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("h1", "h2", "first")
    )
    first = F.col("first")
    later = (
        windows.join(settle(firsts, "repeated-windows"), ["h1", "h2"])
        .where(~(first["key"].eqNullSafe(F.col("key")) & (first["at"] == F.col("at"))))
        .select("key", "at")
        .distinct()
    )
    by_place = Window.partitionBy("key").orderBy("at")
    opens = F.coalesce((F.col("at") > F.lag("at").over(by_place) + WIDTH).cast("int"), F.lit(1))
    return (
        later.withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(by_place))
        .groupBy("key", "run")
        .agg(F.min("at").alias("first"), (F.max("at") + WIDTH).alias("end"))
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("runs"))
    )


def dedup_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents`` with their text cut, and ``n_lines`` and ``n_removed`` (lines before, lines gone)."""
    rest = [c for c in documents.columns if c not in (text, "n_lines", "n_removed")]
    key, held, whole_text, cut_lines = free_names(documents.columns, "key", "runs", "whole_text", "cut_lines")
    runs = repeated_runs(documents, doc_id, text).select(F.col("key").alias(key), F.col("runs").alias(held))
    whole = documents.select(
        *[F.col(f"`{c}`") for c in rest],
        F.col(text).alias(whole_text),
        _key(doc_id, text).alias(key),
    )
    lines, found = F.split(whole_text, "\n", -1), F.col(held)
    count = F.coalesce(F.size(lines), F.lit(0))
    # The pieces between the runs: from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), found["end"])
    pieces = F.transform(
        F.arrays_zip(starts.alias("from"), F.concat(found["first"], F.array(count)).alias("to")),
        lambda piece: F.slice(F.col(cut_lines), piece["from"] + 1, piece["to"] - piece["from"]),
    )
    removed = F.aggregate(found, F.lit(0), lambda total, run: total + run["end"] - run["first"])
    cut = F.when(found.isNull(), F.col(whole_text)).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return (
        whole.join(runs, key, "left")
        .withColumn(cut_lines, F.when(found.isNotNull(), lines))
        .select(
            *[F.col(f"`{c}`") for c in rest],
            cut.alias(text),
            F.when(F.col(whole_text).isNull(), 0).otherwise(count).cast("long").alias("n_lines"),
            F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        )
        .select(*documents.columns, *[c for c in ("n_lines", "n_removed") if c not in documents.columns])
    )
