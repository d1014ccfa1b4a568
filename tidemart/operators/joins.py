"""Join helpers.

Dimension sides are never force-broadcast here: Spark's AQE broadcasts a
side only after measuring it under spark.sql.autoBroadcastJoinThreshold,
and plans a sort-merge or shuffled-hash join otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _type_default(dt: T.DataType):
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.lit("1970-01-01").cast("date")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(None).cast(dt)


def left_join_defaults(left: DataFrame, right: DataFrame, on: Sequence[str],
                       null_mode: str = "ansi") -> DataFrame:
    """LEFT JOIN ``right`` on equal ``on`` columns.

    null_mode="ansi": unmatched right columns are NULL (standard SQL).
    null_mode="defaults": unmatched right columns get their type's default
    (0, '', epoch) the way a warehouse with join_use_nulls=0 fills them."""
    on = list(on)
    if null_mode not in ("ansi", "defaults"):
        raise ValueError(f"null_mode must be 'ansi' or 'defaults', not {null_mode!r}")
    marker = "__matched"
    r = right.withColumn(marker, F.lit(True))
    j = left.join(r, on, "left")
    if null_mode == "ansi":
        return j.drop(marker)
    fields = {f.name: f.dataType for f in right.schema.fields}
    out = []
    for c in j.columns:
        if c == marker:
            continue
        if c in fields and c not in on:
            out.append(F.when(F.col(marker).isNull(), _type_default(fields[c]))
                       .otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def or_match_keys(dim: DataFrame, key_cols: Sequence[str], id_col: str,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Explode a small dimension into (match_key, id, keep...) rows, one per
    distinct lower-cased value of any of ``key_cols``. Joining on match_key
    reproduces ``lower(x) = lower(k1) OR lower(x) = lower(k2) ...`` as an
    equi-join (one output row per matching dimension row), instead of a
    nested-loop join."""
    parts = [dim.select(F.lower(F.col(k)).alias("match_key"), id_col, *keep)
             for k in key_cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.where(F.col("match_key").isNotNull()).dropDuplicates(["match_key", id_col])


def or_join(left: DataFrame, left_col: str, dim: DataFrame, key_cols: Sequence[str],
            id_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """LEFT JOIN dim ON lower(left_col) = lower(k1) OR lower(left_col) = lower(k2) ...
    Rows matching several dimension rows fan out, as the OR join does."""
    keys = or_match_keys(dim, key_cols, id_col, keep)
    return (left.withColumn("__mk", F.lower(F.col(left_col)))
                .join(keys.withColumnRenamed("match_key", "__mk"), "__mk", "left")
                .drop("__mk"))
