"""Raw documents to training tokens: stages that each apply one operator to what the stage before has kept.

Every stage but the last returns the columns of ``documents``. Rows go only where a stage's operator says so: documents
taken for toxic, near-duplicates of a document that stays, and documents that hold a window of a benchmark item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.llm.bpe import encode_and_decode, joined_digest, public_file
from stagewise.llm.decontamination import find_windows
from stagewise.llm.jaccard_join import Rule, link_documents
from stagewise.llm.line_dedup import dedup_lines
from stagewise.llm.names import free_names
from stagewise.llm.toxicity import fit_toxicity, score_toxicity
from stagewise.session import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# What the near-duplicate stage links. Op7 has its own rule.
NEAR = Rule(words=5, least=80)


def apart(docs: DataFrame) -> DataFrame:
    """Id and text beside all other columns in one, so that none is taken for an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *([F.struct(*rest).alias("rest")] if rest else []))


def together(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[c if c in ("doc_id", "text") else F.col("rest").getField(c).alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model takes for toxic go."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return together(score_toxicity(apart(docs), model).where(F.col("predicted") == 0), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of repeated three-line windows go from all documents but the first; ``n_chars`` follows the text."""
    cut = together(dedup_lines(apart(docs)), docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows one stays: the one with the smallest id, without an id only if none has one.

    Near-duplicates share 0.8 of their five-word shingles, other than in op7. Rows are compared by names of their own, so
    repeated ids and rows without an id are rows like all others. Of rows with equal ids that of the smallest text hash
    stays. Rows without words are like no other and all stay.
    """
    # Written before it is used twice: the names stay the same.
    (row,) = free_names(docs.columns, "row")
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "named-rows")
    found = link_documents(rows.select(F.col(row).alias("doc_id"), "text"), rule=NEAR)
    rank = F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("hash"), F.col(row).alias("row")
    )
    placed = found.select(F.col("doc_id").alias(row), "component_id")
    ranked = settle(rows.select(row, rank.alias("rank")).join(placed, row), "ranked-rows")
    first = (
        ranked.groupBy("component_id")
        .agg(F.min_by(row, "rank").alias("first"), F.count("*").alias("members"))
        .where(F.col("members") > 1)
    )
    # Fewer rows go than stay, as a rule. Where they are few enough to be broadcast, no text is shuffled.
    gone = settle(ranked.join(first, "component_id").where(F.col(row) != F.col("first")).select(row), "copies")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = find_windows(apart(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return together(found.where(F.size("spans") == 0), docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with digests of the ids and of what they decode to.

    Columns of the input that are named like one of these are replaced.
    """
    path = public_file("word_bpe_49k.json")
    made = ("text", "ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256")
    rest = [c for c in docs.columns if c not in made]
    decoded = encode_and_decode(docs.select(*rest, "text"), path)
    return decoded.select(
        *rest,
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        joined_digest("ids").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# A trained model and merged tokens are beyond SQL; tests hold every stage against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents, each reading what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
