"""Latest-version reads of append-only raw tables.

The warehouse keeps every loaded copy of a row and resolves "latest
version wins" at read time. We express that as one grouped aggregate,
``max_by(struct(row), struct(version, tie-breaks))``: the partial aggregate
runs map-side, so a key with millions of copies is reduced inside each
input task before the shuffle and never lands whole in one task.

The load numbers the rows of a batch (``load_seq``), so (loaded_at, load_seq) is
unique and nothing else is needed to order versions: with ``columns`` only
the keys, the version and those columns are scanned and shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SEQUENCE = "load_seq"


def latest(df: DataFrame, keys: Sequence[str], version: str = "loaded_at",
           tiebreak: Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``version``.

    Equal versions are ordered by ``load_seq`` where the table has it, otherwise
    by ``tiebreak`` (default: every other wanted column in schema order,
    descending, NULL lowest), so the result is deterministic whatever the input
    order. ``columns`` (default: all but ``load_seq``) are those of the result,
    beside the keys; none at all is a plain distinct on the keys."""
    keys = list(keys)
    sequence = [SEQUENCE] if SEQUENCE in df.columns and tiebreak is None else []
    cols = [c for c in df.columns if c != SEQUENCE and (columns is None or c in keys or c in columns)]
    others = [c for c in cols if c not in keys]
    if not others:
        return df.select(*cols).distinct()
    if tiebreak is None:
        # Ordering over (version, sequence, wanted columns) is the row itself:
        # max(struct) carries one struct through the shuffle instead of a
        # payload plus an ordering key.
        first = [version, *sequence]
        row = F.struct(*[F.col(c) for c in [*first, *(c for c in others if c not in first)]])
        agg = df.groupBy(*keys).agg(F.max(row).alias("__row"))
    else:
        order = F.struct(*[F.col(c) for c in [version, *tiebreak]])
        agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("__row"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols])
