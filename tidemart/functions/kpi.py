"""KPI arithmetic shared by facts and marts.

Money is summed as DECIMAL(18,2) so totals do not depend on the order in
which partitions are combined; it is turned into DOUBLE at the mart
boundary. Averages are exact sums divided by exact counts. Ratios are
guarded because Spark runs with ANSI mode on (x/0 raises)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, digits: int = 2) -> Column:
    """round(x, digits) half away from zero on the value's decimal form.

    The double is first fixed to 8 decimals, so the last-bit noise of a double
    sum or quotient (which differs with summation order) never decides a tie;
    the result is a DOUBLE."""
    return F.round(_c(x).cast("decimal(38,8)"), digits).cast("double")


def money(x) -> Column:
    """A 2-decimal amount held as DECIMAL(18,2)."""
    return _c(x).cast(MONEY)


def dbl(x) -> Column:
    return _c(x).cast("double")


def sum_money(x) -> Column:
    """Order-independent sum of an amount, returned as DOUBLE."""
    return F.sum(money(x)).cast("double")


def mean(x) -> Column:
    """avg() as exact sum / count (integer or decimal input)."""
    return (F.sum(_c(x)).cast("double") / F.count(_c(x)).cast("double"))


def safe_div(num, den, default=0.0) -> Column:
    """if(den > 0, num / den, default) in DOUBLE."""
    return F.when(_c(den) > 0, dbl(num) / dbl(den)).otherwise(F.lit(default).cast("double"))


def ratio_pct(num, den, digits: int = 2) -> Column:
    """if(den > 0, round(num / den * 100, digits), 0)."""
    return F.when(_c(den) > 0, rnd(dbl(num) / dbl(den) * 100, digits)) \
        .otherwise(F.lit(0.0))


def ratio(num, den, digits: int = 2, default: float = 0.0) -> Column:
    """if(den > 0, round(num / den, digits), default)."""
    return F.when(_c(den) > 0, rnd(dbl(num) / dbl(den), digits)) \
        .otherwise(F.lit(float(default)))


def flag(cond: Column) -> Column:
    """Boolean predicate as a 0/1 INT flag (the models average these)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def sku(category, index, width: int = 4):
    """'SKU-' + first three letters of the category, upper-cased + '-' +
    zero-padded index, e.g. SKU-ELE-0001."""
    cat = F.col(category) if isinstance(category, str) else category
    idx = F.col(index) if isinstance(index, str) else index
    return F.concat(F.lit("SKU-"), F.upper(F.substring(cat, 1, 3)), F.lit("-"),
                    F.format_string(f"%0{width}d", idx))
