"""Contract documents as tables: one document per part, with columns named after the part's properties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.operators import contracts as op
from stagewise.session import scratch_path
from workload.registry import query, table

COLOR, ITEM = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
KIND = "CASE WHEN p_size <= 20 THEN 'string' WHEN p_size <= 40 THEN 'int64' ELSE 'float16' END"
FORMAT = "CASE WHEN p_retailprice < 950 THEN 'parquet' ELSE 'avro' END"

DOCUMENT = f"""
    concat('part_', p_partkey) AS name,
    p_type AS description,
    array(named_struct('name', 'raw_hist', 'format', 'csv'), named_struct('name', 'curated', 'format', {FORMAT}))
        AS file_formats,
    false AS sensitive,
    array(lower(p_type)) AS primary_key,
    array({COLOR}) AS partitions,
    array(
        named_struct('name', lower(p_type), 'nullable', p_size > 25, 'enum', array(p_brand),
            'stages', array(
                named_struct('name', 'raw_hist', 'type', 'string', 'pattern', '[A-Z]+', 'format', ''),
                named_struct('name', 'curated', 'type', {KIND}, 'pattern', '', 'format', ''))),
        named_struct('name', {ITEM}, 'nullable', false, 'enum', cast(array() AS array<string>),
            'stages', array(named_struct('name', 'curated', 'type', 'date32', 'pattern', '', 'format', '%Y-%m-%d'))),
        named_struct('name', if(p_size <= 30, {COLOR}, {ITEM}), 'nullable', true, 'enum', array('a', 'b'),
            'stages', array(named_struct('name', if(p_size = 50, 'shelf', 'raw_hist'), 'type', 'int32',
                'pattern', '', 'format', '')))
    ) AS columns
"""

# The same columns as rows: (position, name, nullable, stage, type).
ROWS_SQL = f"""
    WITH c AS (
        SELECT 'part_' || p_partkey AS t, 0 AS position, lower(p_type) AS n, p_size > 25 AS nullable,
               'raw_hist' AS stage, 'string' AS kind, '[A-Z]+' AS pattern, NULL AS fmt, p_brand AS enum, part.*
        FROM part
        UNION ALL
        SELECT 'part_' || p_partkey, 0, lower(p_type), p_size > 25, 'curated', {KIND}, NULL, NULL, p_brand, part.*
        FROM part
        UNION ALL
        SELECT 'part_' || p_partkey, 1, {ITEM}, false, 'curated', 'date32', NULL, '%Y-%m-%d', NULL, part.* FROM part
        UNION ALL
        SELECT 'part_' || p_partkey, 2, CASE WHEN p_size <= 30 THEN {COLOR} ELSE {ITEM} END, true,
               CASE WHEN p_size = 50 THEN 'shelf' ELSE 'raw_hist' END, 'int32', NULL, NULL, 'a,b', part.* FROM part
    )
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "contracts")
    table(spark, sf_dir, "part").selectExpr(*_split(DOCUMENT)).write.json(path)
    return op.load_contracts(spark, path, "parts", multi_line=False)


def _split(text: str) -> list[str]:
    """The select list as separate expressions, for ``selectExpr``."""
    out, depth, current = [], 0, ""
    for char in text:
        depth += (char in "([") - (char in ")]")
        if char == "," and depth == 0:
            out.append(current)
            current = ""
        else:
            current += char
    return [*out, current]


@query(
    "contracts_rows",
    f"""
    SELECT 'part_' || p_partkey AS table_name, 'parts' AS "database", p_type AS description,
           {COLOR} AS partitions, lower(p_type) AS primary_key, CAST(3 AS BIGINT) AS n_columns,
           {FORMAT} AS curated_format
    FROM part
    """,
)
def q_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "table_name",
        "database",
        "description",
        F.array_join("partitions", ",").alias("partitions"),
        F.array_join("primary_key", ",").alias("primary_key"),
        F.size("columns").cast("long").alias("n_columns"),
        F.filter("file_formats", lambda f: f["name"] == "curated")[0]["format"].alias("curated_format"),
    )


@query(
    "stage_contract",
    f"""{ROWS_SQL}
    SELECT 'parts' AS "database", t AS table_name, position, n AS column_name, kind AS column_type, nullable,
           enum, pattern, fmt AS format, n = {COLOR} AS is_partition, {FORMAT} AS file_format
    FROM c WHERE stage = 'curated'
    """,
)
def q_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = op.stage_contract(documents(spark, sf_dir), "curated")
    return columns.withColumn("enum", F.array_join("enum", ","))


@query(
    "data_dictionary",
    f"""{ROWS_SQL}
    SELECT 'parts' AS "System", 'parts' AS "Dataset", t AS "Data Table", n AS "Data Field", '' AS "Description",
           kind AS "Data Type", nullable AS "Nullable"
    FROM c WHERE stage = 'curated'
    """,
)
def q_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.data_dictionary(documents(spark, sf_dir))


@query(
    "contract_violations",
    f"""{ROWS_SQL},
    names AS (SELECT DISTINCT t, position, n, {COLOR} AS part_name FROM c)
    SELECT 'parts' AS "database", t AS table_name, 'duplicate column' AS rule_name, n AS item
    FROM names GROUP BY t, n HAVING count(*) > 1
    UNION ALL
    SELECT 'parts', t, 'undeclared partition', min(part_name) FROM names
    GROUP BY t HAVING count(*) FILTER (WHERE n = part_name) = 0
    UNION ALL SELECT DISTINCT 'parts', t, 'unknown type', kind FROM c WHERE kind = 'float16'
    UNION ALL SELECT DISTINCT 'parts', t, 'unknown stage', stage FROM c WHERE stage = 'shelf'
    UNION ALL SELECT 'parts', 'part_' || p_partkey, 'unknown format', 'avro' FROM part WHERE {FORMAT} = 'avro'
    """,
)
def q_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.contract_violations(documents(spark, sf_dir))
