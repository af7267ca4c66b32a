"""Primary keys that an earlier landing partition has already, without reading what cannot have them.

A Bloom filter is kept beside each landing partition. It is made of blocks of 32,768 bits, as many as the partition's keys
need; a key belongs to one block and sets ``PROBES`` bits of it. Filters are tables, one row for each block, built with
Spark's own bitmap aggregate, so neither a filter nor a partition's keys pass through one task.

New keys are joined with the blocks they belong to, for each number of blocks that any filter has, and tested inside the
join. Only hits come out: pairs of a key and a partition. The partitions among them are the only ones that are read, by
their folders, and the exact comparison follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import Contract, ContractError
from stagewise.operators.partitions import stage_partitions
from stagewise.session import settle
from stagewise.sources.files import path_exists
from stagewise.sources.scans import scan_partitions

# Bits and bytes of one of Spark's bitmaps.
BLOCK_BITS, BLOCK_BYTES = 32_768, 4_096
# Bits of a filter for each key, and bits that a key sets: about one key in 200 is taken for another.
BITS_PER_KEY, PROBES = 12, 5
FILTER_FOLDER = "_key_filters"
FILTER_SCHEMA = "blocks long, block long, bits binary"


def key_hash(key: Sequence[str], seed: int = 0) -> Column:
    """A hash of a key, whatever the types of its columns; equal values of other integer types have equal hashes."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("\0null")) for k in key]
    return F.xxhash64(F.lit(seed), *parts)


def _probes(key: Sequence[str]) -> Column:
    """The bits that a key sets within its block."""
    step, start = (F.pmod(key_hash(key, seed), F.lit(BLOCK_BITS)) for seed in (1, 2))
    odd = step.bitwiseOR(F.lit(1))
    return F.array(*[F.pmod(start + odd * n, F.lit(BLOCK_BITS)) for n in range(PROBES)])


def write_key_filters(rows: DataFrame, path: str, key: Sequence[str], partition: str) -> None:
    """Build the filters of all landing partitions in ``rows`` and keep them beside the partitions below ``path``.

    A partition that has a filter gets a new one, so the rows must be all it has. Filters are small against the keys.
    """
    keyed = rows.where(F.col(partition).isNotNull()).select(
        F.col(partition).cast("long").alias(partition), key_hash(key).alias("hash"), _probes(key).alias("probes")
    )
    keyed = settle(keyed.distinct(), "keys")
    need = F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BLOCK_BITS)
    # A power of two, so that only a few numbers of blocks occur.
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(need, F.lit(1))))).cast("long")
    sized = settle(keyed.groupBy(partition).agg(blocks.alias("blocks")), "filter-sizes")
    bits = (
        keyed.join(sized, partition)
        .select(partition, "blocks", F.pmod("hash", "blocks").alias("block"), F.explode("probes").alias("bit"))
        .groupBy(partition, "blocks", "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    writer = bits.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(f"{path.rstrip('/')}/{FILTER_FOLDER}")


def read_key_filters(spark: SparkSession, path: str, partition: str) -> DataFrame:
    folder = f"{path.rstrip('/')}/{FILTER_FOLDER}"
    schema = f"{FILTER_SCHEMA}, {partition} long"
    return spark.read.schema(schema).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], schema)


def _has(bits: Column, probe: Column) -> Column:
    """Is a bit of a block set?"""
    byte = F.conv(F.hex(F.substring(bits, F.floor(probe / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(probe, F.lit(8)).cast("int")) == 1


def possible_hits(new: DataFrame, filters: DataFrame, key: Sequence[str], partition: str) -> DataFrame:
    """Pairs of a distinct new key and an earlier partition that may have it: the key's columns, ``hash`` and the partition.

    ``filters`` are those of the partitions to look into.
    """
    levels = [r["blocks"] for r in filters.select("blocks").distinct().orderBy("blocks").collect()]
    keys = new.select(*[F.col(f"`{k}`") for k in key], key_hash(key).alias("hash"), _probes(key).alias("probes")).distinct()
    level = F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<bigint>")).alias("blocks")
    asked = keys.select("*", level).withColumn("block", F.pmod("hash", "blocks"))
    known = filters.select(F.col("blocks").alias("b_blocks"), F.col("block").alias("b_block"), "bits", partition)
    tests = [_has(F.col("bits"), F.get("probes", F.lit(n))) for n in range(PROBES)]
    same = (F.col("blocks") == F.col("b_blocks")) & (F.col("block") == F.col("b_block"))
    for test in tests:
        same = same & test
    return asked.join(known, same).select(*[f"`{k}`" for k in key], "hash", partition)


def check_key_history(
    new: DataFrame,
    path: str,
    contract: Contract,
    key: Sequence[str],
    partition: str,
    fmt: str = "parquet",
    before: int | None = None,
) -> DataFrame:
    """New keys that earlier partitions below a path have: the key's columns, the partition and its rows with that key.

    ``before`` looks into partitions below a value only. Partitions without a filter are an error, as their keys are
    unknown. Null parts of a key are equal to null.
    """
    spark = new.sparkSession
    unknown = [k for k in key if k not in contract.lookup]
    if unknown:
        raise ContractError(f"key columns {unknown} are not in the contract of '{contract.name}'")
    filters, present = read_key_filters(spark, path, partition), stage_partitions(spark, path, partition)
    if before is not None:
        filters, present = (x.where(F.col(partition) < before) for x in (filters, present))
    lacking = missing_filters(filters, present, partition).take(5)
    if lacking:
        raise ContractError(f"no key filters for {partition} {[r[partition] for r in lacking]} and perhaps more")
    hits = settle(possible_hits(new, filters, key, partition), "possible-hits")
    values = [r[partition] for r in hits.select(partition).distinct().collect()]
    columns = [*[F.col(f"`{k}`") for k in key], F.col(partition)]
    if not values:
        return hits.select(*columns, F.lit(0).cast("long").alias("occurrences"))
    stored = scan_partitions(spark, path, fmt, contract, partition, values)
    old = stored.select(*columns[:-1], F.col(partition).cast("long").alias(partition), key_hash(key).alias("hash"))
    counted = old.groupBy(*[f"`{k}`" for k in key], partition, "hash").agg(F.count(F.lit(1)).alias("occurrences"))
    asked = hits.select(*[F.col(f"`{k}`").alias(f"new_{n}") for n, k in enumerate(key)], "hash", partition)
    same = [F.col(f"new_{n}").eqNullSafe(F.col(f"`{k}`")) for n, k in enumerate(key)]
    joined = counted.join(asked, ["hash", partition])
    for condition in same:
        joined = joined.where(condition)
    return joined.select(*columns, "occurrences")


def missing_filters(filters: DataFrame, present: DataFrame, partition: str) -> DataFrame:
    """Landing partitions among ``present`` that have no filter."""
    return present.select(partition).distinct().join(filters.select(partition).distinct(), partition, "left_anti")
