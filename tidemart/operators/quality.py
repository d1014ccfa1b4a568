"""Data-quality assertions.

``run_checks(df, checks)`` returns one row per check:
(pos, check_name, column_name, violations, total). The checks of one table share
its passes (see ``run_checks``). Counting follows the usual model-test
conventions:
  not_null         rows where the column is NULL
  unique           distinct non-NULL key values that occur more than once
  accepted_values  distinct non-NULL values outside the list
  expect           rows where the predicate is FALSE (NULL passes, as in CHECK)
  orphans          non-NULL keys with no match in the referenced table
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    kind: str                      # not_null | unique | accepted_values | expect | orphans
    columns: tuple
    values: tuple = ()
    predicate: str | None = None   # SQL boolean expression for "expect"
    ref: DataFrame | None = field(default=None, compare=False)
    ref_columns: tuple = ()
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def not_null(col: str) -> Check:
    return Check("not_null", (col,))


def unique(*cols: str) -> Check:
    return Check("unique", tuple(cols))


def accepted_values(col: str, values) -> Check:
    return Check("accepted_values", (col,), tuple(values))


def expect(name: str, predicate: str, columns=()) -> Check:
    return Check("expect", tuple(columns), predicate=predicate, name=name)


def orphans(cols, ref: DataFrame, ref_cols=None) -> Check:
    cols = (cols,) if isinstance(cols, str) else tuple(cols)
    ref_cols = cols if ref_cols is None else ((ref_cols,) if isinstance(ref_cols, str) else tuple(ref_cols))
    return Check("orphans", cols, ref=ref, ref_columns=ref_cols)


RESULT_SCHEMA = "pos int, check_name string, column_name string, violations bigint, total bigint"


def _row_level_expr(ch: Check) -> Column:
    if ch.kind == "not_null":
        return F.count_if(F.col(ch.columns[0]).isNull())
    if ch.kind == "accepted_values":
        c = F.col(ch.columns[0])
        return F.count_distinct(F.when(~c.isin(*ch.values), c))
    if ch.kind == "expect":
        return F.count_if(~F.expr(ch.predicate))
    raise ValueError(ch.kind)


def _nonnull(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in columns])


def _rows(one: DataFrame, found: list[tuple]) -> DataFrame:
    """Result rows of the checks in ``found``: (pos, check, violations, total) of columns of ``one``."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(ch.label).alias("check_name"), F.lit(ch.column).alias("column_name"),
                 F.col(v).cast("long").alias("violations"), F.coalesce(F.col(t), F.lit(0)).cast("long").alias("total"))
        for i, ch, v, t in found]))
    return one.select(stacked.alias("r")).select("r.pos", "r.check_name", "r.column_name", "r.violations", "r.total")


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Evaluate ``checks`` on ``df``; one result row per check, in order.

    The first uniqueness check and all not_null and expect checks share one
    pass: rows are reduced to their key with a counter for each check (map-side
    first), and the keys to one row. Accepted values are distinct counts of a
    few columns, a pass of their own. Orphan checks reduce the child rows to
    one per foreign key before they meet the parent's keys."""
    parts: list[DataFrame] = []
    numbered = list(enumerate(checks))
    counted = [(i, ch) for i, ch in numbered if ch.kind in ("not_null", "expect")]
    accepted = [(i, ch) for i, ch in numbered if ch.kind == "accepted_values"]
    uniques = [(i, ch) for i, ch in numbered if ch.kind == "unique"]
    if counted and not uniques or accepted:
        mine = accepted if uniques else counted + accepted
        one = df.agg(F.count(F.lit(1)).alias("total"), *[_row_level_expr(ch).alias(f"v{i}") for i, ch in mine])
        parts.append(_rows(one, [(i, ch, f"v{i}", "total") for i, ch in mine]))
    for k, (u, check) in enumerate(uniques):
        mine = counted if k == 0 else []
        keyed = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("__n"),
                                               *[_row_level_expr(ch).alias(f"v{i}") for i, ch in mine])
        has_key = _nonnull(check.columns)
        one = keyed.agg(F.sum("__n").alias("total"), F.count_if(has_key & (F.col("__n") > 1)).alias(f"v{u}"),
                        F.sum(F.when(has_key, F.col("__n"))).alias("keyed"),
                        *[F.coalesce(F.sum(f"v{i}"), F.lit(0)).alias(f"v{i}") for i, _ in mine])
        parts.append(_rows(one, [(u, check, f"v{u}", "keyed"), *((i, ch, f"v{i}", "total") for i, ch in mine)]))
    for i, ch in numbered:
        if ch.kind == "orphans":
            ref = ch.ref.select(*[F.col(r).alias(f"__ref{j}") for j, r in enumerate(ch.ref_columns)]) \
                .distinct().withColumn("__hit", F.lit(True))
            cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__ref{j}")
                                               for j, c in enumerate(ch.columns)])
            child = df.groupBy(*ch.columns).agg(F.count(F.lit(1)).alias("__n"))
            lost = _nonnull(ch.columns) & F.col("__hit").isNull()
            one = child.join(ref, cond, "left").agg(
                F.coalesce(F.sum(F.when(lost, F.col("__n"))), F.lit(0)).alias("lost"), F.sum("__n").alias("total"))
            parts.append(_rows(one, [(i, ch, "lost", "total")]))
    # every part selects (pos, check_name, column_name, violations, total)
    # with the same types, so a positional UNION ALL is exact
    return reduce(DataFrame.union, parts)


class CheckFailed(AssertionError):
    pass


def enforce(df: DataFrame, checks: list[Check]) -> DataFrame:
    """DML2 (SET NOT NULL / ADD CONSTRAINT CHECK): evaluate ``checks`` in one
    pass and raise if any is violated; returns ``df`` unchanged otherwise."""
    bad = [r for r in run_checks(df, checks).collect() if r["violations"]]
    if bad:
        raise CheckFailed("; ".join(f"{r['check_name']}({r['column_name']}): {r['violations']}"
                                    for r in bad))
    return df


def schema_contract(df: DataFrame, expected: T.StructType, table: str) -> list[tuple]:
    """DQ10: compare ``df``'s columns and types with a contract (driver-side
    metadata only). Returns (table, column, expected, actual, status) rows."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for f in expected.fields:
        a = actual.get(f.name)
        exp = f.dataType.simpleString()
        status = "missing" if a is None else ("ok" if a == exp else "type_mismatch")
        rows.append((table, f.name, exp, a, status))
    for name in actual:
        if name not in {f.name for f in expected.fields}:
            rows.append((table, name, None, actual[name], "unexpected"))
    return rows


def band(metric: str, value: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """DQ9 helper: struct(metric, value, lo, hi, passed) for one aggregate."""
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (value >= F.lit(lo))
    if hi is not None:
        ok = ok & (value <= F.lit(hi))
    return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"),
                    F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi"),
                    ok.alias("passed"))
