"""Joins by time: the latest earlier row (as of), and points in intervals, without a nested loop and without hot tasks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagewise.contract import ContractError
from stagewise.session import settle

# Rows of both sides that one time bucket is to have, and how many buckets there are at most.
BUCKET_ROWS, MAX_BUCKETS = 2_000_000, 4_000
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
LAST_TICK = 2**63 - 1


def ticks(df: DataFrame, name: str) -> Column:
    """A column of whole numbers, dates or times as a long: the number, the day, or microseconds."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, INTEGRAL):
        return col.cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("long")
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), col)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    raise ContractError(f"'{name}' is {kind.simpleString()}, not a whole number, date or time")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    at: str,
    right_at: str,
    by: Sequence[str] = (),
    how: str = "left",
    within: int | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Every left row with the latest right row of its key that is not later; right columns are null where there is none.

    Both sides have the key columns ``by``; other right columns must have names of their own. ``within`` bounds how much
    earlier the right row may be, in ticks. Of right rows of one key and time the one with the largest other columns
    counts. Rows with a null time or key have no partner. ``how`` is ``left`` or ``inner``.

    Both sides are one tagged union, cut into buckets of time that hold about as many rows each, so a key with very many
    rows is many groups. In a bucket the last right row before each left row is a running window. What a bucket ends with
    is carried to the later ones of its key in a second window, over one row for each bucket.
    """
    if how not in ("left", "inner"):
        raise ContractError(f"cannot join as of '{how}'")
    others = [c for c in right.columns if c not in by]
    clashes = sorted(set(others) & set(left.columns))
    if clashes:
        raise ContractError(f"both sides have the columns {clashes}")
    keys = [F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(by)]
    names = [f"_k{n}" for n in range(len(by))]
    filled = F.lit(True)
    for k in by:
        filled = filled & F.col(f"`{k}`").isNotNull()
    payload = F.struct(*[F.col(f"`{c}`") for c in others])
    known = (
        right.where(filled & F.col(f"`{right_at}`").isNotNull())
        .groupBy(*keys, ticks(right, right_at).alias("_t"))
        .agg(F.max(payload).alias("_right"))
        .select(*names, "_t", F.lit(0).alias("_side"), F.struct("_t", "_right").alias("_found"), _null_of(left).alias("_left"))
    )
    kind = known.schema["_found"].dataType
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    placed = F.when(filled, ticks(left, at))
    asked = left.select(*keys, placed.alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_found"), whole.alias("_left"))
    both = known.unionByName(asked.where(F.col("_t").isNotNull()))
    bucket = _time_bucket(both, bucket_rows)
    groups = [*names, "_bucket"]
    inside = Window.partitionBy(*groups).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = both.withColumn("_bucket", bucket)
    running = tagged.withColumn("_own", F.last("_found", ignorenulls=True).over(inside)).where("_side = 1")
    # One row for each bucket of a key: the bucket's last right row, then the last of all buckets before it.
    ends = tagged.groupBy(*groups).agg(F.max_by("_found", F.when(F.col("_side") == 0, F.col("_t"))).alias("_last"))
    earlier = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*groups, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    found = running.join(carried, groups, "left").withColumn("_found", F.coalesce("_own", "_carried"))
    if within is not None:
        near = F.col("_t") - F.col("_found._t") <= int(within)
        found = found.withColumn("_found", F.when(near, F.col("_found")))
    found = found.select("_left", F.col("_found._right").alias("_right"))
    if how == "inner":
        found = found.where(F.col("_right").isNotNull())
    else:
        alone = asked.where(F.col("_t").isNull()).select("_left", F.lit(None).cast(kind["_right"].dataType).alias("_right"))
        found = found.unionByName(alone)
    right_columns = [F.col("_right").getField(c).alias(c) for c in others]
    return found.select(*[F.col("_left").getField(c).alias(c) for c in left.columns], *right_columns)


def _null_of(df: DataFrame) -> Column:
    return F.lit(None).cast(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]))


def _time_bucket(both: DataFrame, bucket_rows: int) -> Column:
    """The number of a row's time bucket; the bounds are quantiles of the times, a few numbers on the driver."""
    count = both.count()
    buckets = min(MAX_BUCKETS, -(-count // bucket_rows))
    if buckets <= 1:
        return F.lit(0)
    shares = [n / buckets for n in range(1, buckets)]
    bounds = both.agg(F.percentile_approx("_t", shares, max(10_000, 10 * buckets)).alias("b")).first()["b"]
    return F.size(F.filter(F.lit(sorted(set(bounds))), lambda b: b < F.col("_t")))


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    closed: str = "left",
    sums: Mapping[str, Column] | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Every point with every interval that it lies in: all columns of both sides, those of ``by`` once.

    ``closed`` says which ends belong to an interval: ``left``, ``right``, ``both`` or ``neither``. Null points, ends and
    keys, and intervals that end before they start, match nothing.

    With ``sums``, whole numbers of an interval by their new names, the result is this join grouped by its point rows: every
    point that lies in any interval, with all its columns and the sums of these numbers over its intervals. Sums are those
    of SQL: nulls are left out, and a sum beyond a long is an error. ``F.lit(1)`` counts. Pairs grow with the product of
    both sides, so here none is made (``_interval_sums``).

    An interval is filed under bins of the power of two that is not less than its length, which are one or two. A point
    has one bin for each power that occurs, at most 64. So both sides meet in an equi-join, which adaptive execution splits
    where a bin is hot, and the ends are compared in it. A long interval costs two rows, like a short one.
    """
    if closed not in ("left", "right", "both", "neither"):
        raise ContractError(f"'{closed}' says not which ends are closed")
    clashes = sorted(set(points.columns) & (set(intervals.columns) - set(by) if sums is None else set(sums)))
    if clashes:
        raise ContractError(f"both sides have the columns {clashes}")
    if sums is not None:
        return _interval_sums(points, intervals, point, start, end, by, closed, sums, bucket_rows)
    low, high = ticks(intervals, start), ticks(intervals, end)
    # Spans of more than 2**62 have its class, and up to five bins.
    span = F.least(F.greatest(high.cast("decimal(20,0)") - low, F.lit(1)), F.lit(2**62)).cast("long")
    order = F.length(F.bin(span - 1)).cast("int") * F.when(span > 1, 1).otherwise(0)
    filed = intervals.where(low <= high).select(
        *[F.col(f"`{c}`") for c in intervals.columns if c not in by],
        *[F.col(f"`{k}`").alias(f"_i{n}") for n, k in enumerate(by)],
        low.alias("_low"),
        high.alias("_high"),
        order.alias("_order"),
    )
    first, last = (F.expr(f"shiftright({c}, _order)") for c in ("_low", "_high"))
    filed = filed.select("*", F.explode(F.sequence(first, last)).alias("_bin"))
    orders = [r["_order"] for r in filed.select("_order").distinct().collect()]
    at = points.select("*", ticks(points, point).alias("_at"))
    at = at.select("*", F.explode(F.array(*[F.lit(o) for o in sorted(orders)]).cast("array<int>")).alias("_class"))
    at = at.withColumn("_cell", F.expr("shiftright(_at, _class)"))
    after = F.col("_at") >= F.col("_low") if closed in ("left", "both") else F.col("_at") > F.col("_low")
    before = F.col("_at") <= F.col("_high") if closed in ("right", "both") else F.col("_at") < F.col("_high")
    same = (F.col("_class") == F.col("_order")) & (F.col("_cell") == F.col("_bin")) & after & before
    for n, k in enumerate(by):
        same = same & (F.col(f"`{k}`") == F.col(f"_i{n}"))
    kept = [F.col(f"`{c}`") for c in [*points.columns, *[c for c in intervals.columns if c not in by]]]
    return at.join(filed, same).select(*kept)


def _interval_sums(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    by: Sequence[str],
    closed: str,
    sums: Mapping[str, Column],
    bucket_rows: int,
) -> DataFrame:
    """The points with sums over their intervals, in time that grows with the rows of both sides and not with the pairs.

    An interval adds its numbers at the first tick that it has and takes them off at the first one after it, so the sums at
    a tick are the running sums up to there. Ticks of both sides are grouped by key before anything is sorted. Running sums
    are cut into buckets of time, with a carry between buckets, as in ``asof_join``. Points then look up their tick.
    """
    kinds = intervals.select(*[c.alias(n) for n, c in sums.items()]).schema.fields
    for field in kinds:
        if not isinstance(field.dataType, INTEGRAL):
            raise ContractError(f"'{field.name}' is {field.dataType.simpleString()}, not a whole number")
    names = [f"_k{n}" for n in range(len(by))]
    keys = [F.col(f"`{k}`").alias(n) for k, n in zip(by, names, strict=True)]
    filled = F.lit(True)
    for k in by:
        filled = filled & F.col(f"`{k}`").isNotNull()
    low, high = ticks(intervals, start), ticks(intervals, end)
    # After the last tick there is none: nothing begins there, and what would end there never does.
    begins = low if closed in ("left", "both") else F.when(low < LAST_TICK, low + 1)
    ends = F.when(high < LAST_TICK, high + 1) if closed in ("right", "both") else high
    # Longs are summed in halves, so that running sums of up to 2**31 rows fit where the sum that is asked for does.
    parts = {"_n": F.lit(1).cast("long")}
    for n, (field, col) in enumerate(zip(kinds, sums.values(), strict=True)):
        value = F.coalesce(col.cast("long"), F.lit(0).cast("long"))
        wide = isinstance(field.dataType, T.LongType)
        parts |= {f"_low{n}": value.bitwiseAND(F.lit(2**32 - 1)), f"_high{n}": F.shiftright(value, 32)} if wide else {f"_low{n}": value}
        parts |= {f"_has{n}": col.isNotNull().cast("long")} if field.nullable else {}
    held = intervals.where(filled & (low <= high)).select(
        *keys, begins.alias("_begins"), ends.alias("_ends"), *[c.alias(p) for p, c in parts.items()]
    )
    held = held.where("_begins IS NOT NULL AND (_ends IS NULL OR _begins < _ends)")
    both = F.array(
        F.struct(F.col("_begins").alias("_t"), F.lit(1).cast("long").alias("_sign")),
        F.struct(F.col("_ends").alias("_t"), F.lit(-1).cast("long").alias("_sign")),
    )
    changes = held.select(*names, *parts, F.inline(both)).where("_t IS NOT NULL")
    changes = changes.select(*names, "_t", F.lit(False).alias("_asked"), *[(F.col(p) * F.col("_sign")).alias(p) for p in parts])
    asked = points.where(filled).select(
        *keys, ticks(points, point).alias("_t"), F.lit(True).alias("_asked"), *[F.lit(0).cast("long").alias(p) for p in parts]
    )
    steps = changes.unionByName(asked.where("_t IS NOT NULL")).groupBy(*names, "_t")
    steps = settle(steps.agg(F.max("_asked").alias("_asked"), *[F.sum(p).alias(p) for p in parts]), "interval-steps")
    tagged = steps.withColumn("_bucket", _time_bucket(steps, bucket_rows))
    groups = [*names, "_bucket"]
    inside = Window.partitionBy(*groups).orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = tagged.select(*groups, "_t", "_asked", *[F.sum(p).over(inside).alias(p) for p in parts]).where("_asked")
    # One row for each bucket of a key: the sums of all buckets before it.
    earlier = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = tagged.groupBy(*groups).agg(*[F.sum(p).alias(p) for p in parts])
    carried = carried.select(*groups, *[F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"{p}_before") for p in parts])
    found = running.join(carried, groups).select(*names, "_t", *[(F.col(p) + F.col(f"{p}_before")).alias(p) for p in parts])
    totals = []
    for n, field in enumerate(kinds):
        total = F.col(f"_low{n}")
        if f"_high{n}" in parts:
            total = (F.col(f"_high{n}").cast("decimal(20,0)") * F.lit(Decimal(2**32)) + total).cast("long")
        totals.append((F.when(F.col(f"_has{n}") > 0, total) if field.nullable else total).alias(field.name))
    found = settle(found.where("_n > 0").select(*names, "_t", *totals), "interval-sums")
    same = F.col("_at") == F.col("_t")
    for k, n in zip(by, names, strict=True):
        same = same & (F.col(f"`{k}`") == F.col(n))
    at = points.select("*", ticks(points, point).alias("_at"))
    return at.join(found, same).select(*[F.col(f"`{c}`") for c in [*points.columns, *sums]])


def overlap_join(
    left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Every pair of half-open intervals that overlap: of two such, one starts within the other.

    Intervals without length, or with a null end, overlap nothing.
    """
    sides = [
        side.where(F.col(f"`{a}`") < F.col(f"`{b}`")) for side, (a, b) in ((left, left_ends), (right, right_ends))
    ]
    here = interval_join(sides[1], sides[0], right_ends[0], *left_ends, by=by, closed="left")
    there = interval_join(sides[0], sides[1], left_ends[0], *right_ends, by=by, closed="neither")
    names = [*left.columns, *[c for c in right.columns if c not in by]]
    quoted = [F.col(f"`{c}`") for c in names]
    return here.select(*quoted).unionByName(there.select(*quoted))
