"""Load-time type repair.

The load repairs by contract (``coerce_to_contract``): the columns the catalogue
types as timestamp or date get that type, whatever the batch holds, so every
batch of a raw table has one schema.

``coerce_datetime_strings`` is the form without a contract. A string column becomes a timestamp when every non-blank value parses as
one; blanks ('', 'nan', 'none', '<na>', 'nat' after trim + lower-case) become
NULL. Otherwise the column is left unchanged. The decision for all string
columns is made in one aggregate pass; the conversion is one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings treated as missing when repairing datetime columns.
BLANKS = ["", "nan", "none", "<na>", "nat"]


def _is_blank(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*BLANKS)


def _parsed(c: Column) -> Column:
    return F.trim(c).try_cast("timestamp_ntz")


def coerce_datetime_strings(df: DataFrame) -> DataFrame:
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not strings:
        return df
    aggs = []
    for name in strings:
        c = F.col(name)
        must = c.isNotNull() & ~_is_blank(c)
        aggs += [F.count_if(must).alias(f"{name}__n"),
                 F.count_if(must & _parsed(c).isNotNull()).alias(f"{name}__ok"),
                 F.count_if(_parsed(c).isNotNull()).alias(f"{name}__any")]
    stats = df.agg(*aggs).first()  # one row of counts per string column
    convert = set()
    for name in strings:
        n, ok, any_ = stats[f"{name}__n"], stats[f"{name}__ok"], stats[f"{name}__any"]
        if (n > 0 and ok == n) or (n == 0 and any_ > 0):
            convert.add(name)
    return df.select(*[
        F.when(_is_blank(F.col(f.name)), F.lit(None).cast("timestamp_ntz"))
         .otherwise(_parsed(F.col(f.name))).alias(f.name) if f.name in convert else F.col(f.name)
        for f in df.schema.fields])


def coerce_to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """``df`` with every timestamp or date column of ``contract`` in its type: text is
    trimmed, blanks become NULL, and text that is no date fails the load (ANSI
    cast). Other columns are left as they are."""
    want = {f.name: f.dataType for f in contract.fields
            if isinstance(f.dataType, T.TimestampNTZType | T.TimestampType | T.DateType)}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = want.get(f.name)
        if kind is None or f.dataType == kind:
            cols.append(c)
        elif isinstance(f.dataType, T.StringType):
            cols.append(F.when(~_is_blank(c), F.trim(c)).cast(kind).alias(f.name))
        else:
            cols.append(c.cast(kind).alias(f.name))
    return df.select(*cols)


def strip_timezone(c) -> Column:
    """tz-aware -> UTC -> naive: with the session time zone at UTC a TIMESTAMP
    cast to TIMESTAMP_NTZ keeps the UTC wall clock."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")
