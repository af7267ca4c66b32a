"""Row, file and table checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagewise.contract import ColumnSpec, Contract
from stagewise.functions.checks import check_enum, check_nullable, check_pattern, check_range, check_type
from stagewise.operators import quality as op
from stagewise.session import scratch_path
from stagewise.sources.inventory import headers, schema_inventory
from stagewise.spec import LintOptions
from workload.registry import ORDER_MONTH, PART, SHIP_MONTH, events, land, lineitem, orders, query, table


@query(
    "lint_type",
    """
    SELECT event_id, event_type FROM events
    WHERE TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) IS NULL
    """,
)
def q_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ColumnSpec("value", "float64")
    # The text of an error event's value is unusable: it holds the word "error".
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    rows = events(spark, sf_dir).withColumn("text_value", text)
    return rows.where(check_type(F.col("text_value"), spec)).select("event_id", "event_type")


@query(
    "lint_nullable",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE l_quantity END AS q
          FROM lineitem)
    WHERE q IS NULL GROUP BY 1, 2
    """,
)
def q_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_return = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    rows = lineitem(spark, sf_dir).withColumn("q", F.when(~open_return, F.col("l_quantity")))
    failing = rows.where(check_nullable(F.col("q"), ColumnSpec("q", "float64", nullable=False)))
    return failing.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


@query("lint_enum", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def q_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ColumnSpec("o_orderstatus", "string", enum=("F", "O"))
    return orders(spark, sf_dir).where(check_enum(F.col(spec.name), spec)).select("o_orderkey", "o_orderstatus")


@query(
    "lint_range",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, count(*) AS n FROM lineitem
    WHERE l_quantity < 10 OR l_quantity > 20 GROUP BY 1, 2, 3
    """,
)
def q_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ColumnSpec("l_quantity", "float64", minimum=10, maximum=20)
    failing = lineitem(spark, sf_dir).where(check_range(F.col(spec.name), spec))
    return failing.groupBy("l_orderkey", "l_linenumber", "l_quantity").agg(F.count("*").alias("n"))


@query(
    "lint_pattern",
    "SELECT page_id, url FROM pages WHERE NOT regexp_full_match(url, 'https?://[a-z.]+/(en|fr)/[0-9]+')",
)
def q_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ColumnSpec("url", "string", pattern="https?://[a-z.]+/(en|fr)/[0-9]+")
    return table(spark, sf_dir, "pages").where(check_pattern(F.col("url"), spec)).select("page_id", "url")


ORDER_FEED = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "lint_columns",
    f"""
    SELECT feed, rule_name, column_name, count(DISTINCT {ORDER_MONTH}) AS partitions
    FROM orders JOIN (VALUES
        ('F', 'O_ORDERPRIORITY', 'extra'), ('F', 'o_orderpriority', 'missing'),
        ('P', 'o_totalprice', 'missing'), ('P', 'o_comment', 'extra')
    ) v(feed, column_name, rule_name) ON o_orderstatus = feed
    GROUP BY 1, 2, 3
    """,
)
def q_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds of one table whose files have different headers."""
    rows = orders(spark, sf_dir)
    shapes = {
        "O": list(ORDER_FEED),
        "F": ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority AS O_ORDERPRIORITY"],
        "P": ["o_orderkey", "o_orderstatus", "o_orderpriority", "'none' AS o_comment"],
    }
    root = scratch_path(spark, "headers")
    for status, columns in shapes.items():
        feed = rows.where(F.col("o_orderstatus") == status).selectExpr(*columns, PART)
        land(feed, f"{root}/feed={status}", "csv")
    wanted = Contract("orders", tuple(ColumnSpec(c, "string") for c in ORDER_FEED))
    problems = op.check_columns(headers(schema_inventory(spark, root, "csv")), wanted, LintOptions())
    feed = F.regexp_extract("file", "feed=(.)", 1).alias("feed")
    part = F.regexp_extract("file", f"{PART}=([0-9]+)", 1).alias(PART)
    return (
        problems.select("rule_name", "column_name", feed, part)
        .groupBy("feed", "rule_name", "column_name")
        .agg(F.countDistinct(PART).alias("partitions"))
    )


LINES = Contract(
    "lineitem",
    (
        ColumnSpec("l_orderkey", "int64", nullable=False),
        ColumnSpec("l_linenumber", "int32", nullable=False, minimum=1, maximum=6),
        ColumnSpec("l_quantity", "float64", minimum=2, maximum=49),
        ColumnSpec("l_discount", "float64", maximum=0.09),
        ColumnSpec("l_returnflag", "string", enum=("A", "N", "R")),
        ColumnSpec("l_linestatus", "string", nullable=False, pattern="[OF]"),
        ColumnSpec("l_shipmode", "string"),
        ColumnSpec(PART, "int64", nullable=False),
    ),
    (PART,),
)
# (column, rule, SQL that fails) of the contract above.
LINE_RULES = (
    ("l_orderkey", "nullable", "l_orderkey IS NULL"),
    ("l_linenumber", "nullable", "l_linenumber IS NULL"),
    ("l_linenumber", "range", "l_linenumber < 1 OR l_linenumber > 6"),
    ("l_quantity", "range", "l_quantity < 2 OR l_quantity > 49"),
    ("l_discount", "range", "l_discount > 0.09::DOUBLE"),
    ("l_returnflag", "enum", "l_returnflag NOT IN ('A', 'N', 'R')"),
    ("l_linestatus", "nullable", "l_linestatus IS NULL"),
    ("l_linestatus", "pattern", "NOT regexp_full_match(l_linestatus, '[OF]')"),
)


@query(
    "lint_report",
    " UNION ALL ".join(
        f"""SELECT {SHIP_MONTH} AS land_ts, '{column}' AS column_name, '{rule}' AS rule_name,
        count(*) AS "rows", count(*) FILTER (WHERE {test}) AS failures FROM lineitem GROUP BY 1"""
        for column, rule, test in LINE_RULES
    ),
)
def q_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.lint_report(lineitem(spark, sf_dir), LINES, [PART], typed=True)


@query(
    "lint_quarantine",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, failed_rules FROM (
        SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {t} THEN '{c}:{r}' END" for c, r, t in LINE_RULES)})
               AS failed_rules
        FROM lineitem)
    WHERE failed_rules <> ''
    """,
)
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = op.split_valid(lineitem(spark, sf_dir), LINES, typed=True)
    return bad.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.array_join(op.FAILED, ",").alias(op.FAILED)
    )


ORDERS = Contract(
    "orders",
    (
        ColumnSpec("o_orderkey", "int64", nullable=False),
        ColumnSpec("o_totalprice", "float64", maximum=499_000),
        ColumnSpec("o_orderstatus", "string", enum=("F", "O", "P")),
        ColumnSpec(PART, "int64"),
    ),
    (PART,),
)


@query(
    "lint_file_verdict",
    f"""
    SELECT o_orderkey, o_totalprice, land_ts, max(CASE WHEN o_totalprice > 499000 THEN 1 ELSE 0 END)
           OVER (PARTITION BY land_ts) = 0 AS passed
    FROM (SELECT *, {ORDER_MONTH} AS land_ts FROM orders)
    """,
)
def q_file_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderstatus", PART)
    good, bad = op.split_by_verdict(rows, op.verdicts(rows, ORDERS, [PART], typed=True), [PART])
    columns = ["o_orderkey", "o_totalprice", PART]
    return good.select(*columns, F.lit(True).alias("passed")).union(
        bad.select(*columns, F.lit(False).alias("passed"))
    )


@query(
    "lint_all_must_pass",
    f"""
    SELECT count(*) AS files, count(*) FILTER (WHERE bad > 0) AS failed_files, bool_and(bad = 0) AS publish FROM (
        SELECT {ORDER_MONTH} AS p, count(*) FILTER (WHERE o_totalprice > 499000) AS bad FROM orders GROUP BY 1
        UNION ALL
        SELECT {SHIP_MONTH}, count(*) FILTER (WHERE {' OR '.join(f'({t})' for _, _, t in LINE_RULES)})
        FROM lineitem GROUP BY 1)
    """,
)
def q_all_must_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_table = [
        op.verdicts(orders(spark, sf_dir), ORDERS, [PART], typed=True),
        op.verdicts(lineitem(spark, sf_dir), LINES, [PART], typed=True),
    ]
    return op.all_must_pass(per_table[0].union(per_table[1]))


@query("assert_not_empty", "SELECT doc_id, lang, length(text) AS chars FROM documents")
def q_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.length("text").cast("long").alias("chars"))
    return op.assert_not_empty(rows, "documents")


@query(
    "lint_primary_key",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def q_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.check_primary_key(lineitem(spark, sf_dir), ["l_orderkey", "l_linenumber"])


@query(
    "schema_conformance",
    """
    SELECT feed, path, problem, n FROM (VALUES
        ('F', 'lines[].price', 'type differs'), ('P', 'lines[].qty', 'missing'), ('P', 'o_custkey', 'missing')
    ) v(feed, path, problem)
    JOIN (SELECT o_orderstatus, count(DISTINCT o_orderkey) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey
          GROUP BY 1) ON feed = o_orderstatus
    """,
)
def q_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nested lines, where two of three feeds have drifted away from the contract."""
    parts = {"l_linenumber": "line", "l_quantity": "qty", "l_extendedprice": "price"}
    line = F.struct(*[F.col(c).alias(name) for c, name in parts.items()])
    joined = orders(spark, sf_dir).join(lineitem(spark, sf_dir).drop(PART), F.col("o_orderkey") == F.col("l_orderkey"))
    nested = joined.select("o_orderkey", "o_custkey", "o_orderstatus", F.array(line).alias("lines"))
    drifted = {
        "O": nested.withColumn("extra", F.lit(1)),
        "F": nested.withColumn(
            "lines", F.expr("transform(lines, l -> struct(l.line, l.qty, cast(l.price AS string) AS price))")
        ),
        "P": nested.withColumn("lines", F.expr("transform(lines, l -> struct(l.line, l.price))")).drop("o_custkey"),
    }
    root = scratch_path(spark, "drift")
    for feed, rows in drifted.items():
        rows.where(F.col("o_orderstatus") == feed).write.parquet(f"{root}/feed={feed}")
    wanted = Contract(
        "orders",
        (
            ColumnSpec("o_orderkey", "int64"),
            ColumnSpec("o_custkey", "int64"),
            ColumnSpec("lines", "list<struct<line:int32, qty:float64, price:float64>>"),
        ),
    )
    found = op.conforms(schema_inventory(spark, root, "parquet"), wanted)
    kinds = found.select(F.regexp_extract("file", "feed=(.)", 1).alias("feed"), "path", "problem").distinct()
    keys = spark.read.option("basePath", root).schema("o_orderkey long, feed string").parquet(root)
    sizes = keys.groupBy("feed").agg(F.countDistinct("o_orderkey").alias("n"))
    return kinds.join(sizes, "feed")
