"""Filter interaction audit by relations of failing ids.

Method: the filters are evaluated once, and every filter gets a table of its own
with the ids of the rows that fail it, bucketed by id like the table of all
ids. The state of a prefix (a set of filters already applied) is a relation of
ids, each alive or gone. One step from a prefix is a left-semi join of its
state with the next filter's table (rows alive there are removed by it, rows
gone are redundant failures) and a left-anti join (what survives). A prefix's
state depends on the set of its filters alone, so the 120 orders of five
filters need 32 states; those of one size are stacked in one table and joined
together, level by level, without a shuffle. Only counts per (part, prefix,
filter) leave the joins, and the orders are put together from them.

The levels are written to the shared folder: a lost executor costs one level.
A group of equal texts may hold a third of all rows; its smallest doc_id is
found per (digest, salt) first and travels back the same way.

Defined cases: null text counts as empty, null lang as the empty part; a null
doc_id is neither smaller nor larger than any other, so it never fails E and
makes no other row fail it, and it has no labels; repeated rows are rows of
their own (a copy under the same doc_id does not fail E); several labels of a
document count as set if any is; very long texts are evaluated whole, one at a
time; ties do not arise, as E compares ids strictly; an empty table gives no
rows; extra columns are not looked at."""

from __future__ import annotations

import json
import math
import uuid
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import scratch, stored, table, text_or_empty

SALTS = 64                  # parts of one group of equal texts
BUCKET_ROWS = 1 << 20       # ids in a bucket, about
LEAST_BUCKETS = 4
WORD = r"[^\x20\x09-\x0D]+"


def conditions(text: Column) -> dict[str, Column]:
    """Failure conditions A to D of a text; E needs the whole table."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return {"A": n < 100,
            "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def evaluate(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(row, part, good, toxic) of every row of ``docs``, and for each of the filters A
    to E the (row) that fail it. The texts are read once."""
    text = text_or_empty()
    checked = stored(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        *(c.alias(f) for f, c in conditions(text).items())), "audit-checked")
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    ids = (checked.join(marks, "doc_id", "left")
           .select("row", "part", F.coalesce("good", F.lit(False)).alias("good"),
                   F.coalesce("toxic", F.lit(False)).alias("toxic")))
    fails = {f: checked.where(f).select("row") for f in "ABCD"}
    return ids, fails | {"E": _later_copies(checked)}


def _later_copies(checked: DataFrame) -> DataFrame:
    """(row) of the rows whose text a smaller doc_id has."""
    rows = checked.select("row", "doc_id", "digest",
                          F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = rows.groupBy("digest", "salt").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    groups = (parts.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                          F.collect_list("salt").alias("salts"))    # at most SALTS entries
              .where("low < high").select("digest", "low", F.explode("salts").alias("salt")))
    return rows.join(groups, ["digest", "salt"]).where("doc_id > low").select("row")


class _Buckets:
    """Tables bucketed and sorted by row, so that joins between them need no shuffle."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets, self.names = spark, buckets, []

    def write(self, df: DataFrame, dealt: bool = True) -> DataFrame:
        """``dealt``: the rows come in any order; otherwise each task already has rows of one bucket."""
        name = f"audit_{uuid.uuid4().hex}"
        self.names.append(name)
        if dealt:
            df = df.repartition(self.buckets, "row")
        df.write.bucketBy(self.buckets, "row").sortBy("row").option("path", scratch(self.spark, name)).saveAsTable(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Takes the names out of the session's catalogue; the files stay."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE {name}")


def count_steps(ids: DataFrame, fails: dict[str, DataFrame], buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """For every set of filters applied (``prefix``, a bit for each filter in the
    order of ``fails``) and every further filter: (part, prefix, filter, removed,
    redundant, good_lost, toxic_lost); and the survivors (part, prefix, kept).
    ``ids``: row (unique), part, good, toxic; ``fails``: filter -> (row)."""
    spark = ids.sparkSession
    ids = stored(ids, "audit-ids")
    b = _Buckets(spark, buckets or max(LEAST_BUCKETS, math.ceil(ids.count() / BUCKET_ROWS)))
    bit = {f: 1 << k for k, f in enumerate(fails)}
    failing = {f: b.write(rows.select("row")).hint("merge") for f, rows in fails.items()}
    state = b.write(ids.select("row", "part", "good", "toxic", F.lit(0).alias("prefix"), F.lit(True).alias("alive")))
    taken, left = [], []
    for level in range(len(bit) + 1):
        left.append(stored(state.where("alive").groupBy("part", "prefix").agg(F.count(F.lit(1)).alias("kept")), "audit-kept"))
        if level == len(bit):
            break
        steps, following = [], []
        for f, k in bit.items():
            hit = state.where(F.col("prefix").bitwiseAND(k) == 0).join(failing[f], "row", "left_semi")
            steps.append(hit.groupBy("part", "prefix").agg(
                F.count_if("alive").alias("removed"), F.count_if(~F.col("alive")).alias("redundant"),
                F.count_if(F.col("alive") & F.col("good")).alias("good_lost"),
                F.count_if(F.col("alive") & F.col("toxic")).alias("toxic_lost")).withColumn("filter", F.lit(f)))
            here = state.where(F.col("prefix") < k)         # each larger set comes from one smaller set only
            alive, then = here.where("alive"), (F.col("prefix") + k).alias("prefix")
            keep = ["row", "part", "good", "toxic", then]
            following += [
                alive.join(failing[f], "row", "left_anti").select(*keep, F.lit(True).alias("alive")),
                alive.join(failing[f], "row", "left_semi").select(*keep, F.lit(False).alias("alive")),
                here.where("not alive").select(*keep, F.lit(False).alias("alive"))]
        taken.append(stored(reduce(DataFrame.unionByName, steps), "audit-steps"))
        state = b.write(reduce(DataFrame.unionByName, following), dealt=False)
    b.forget()
    return reduce(DataFrame.unionByName, taken), reduce(DataFrame.unionByName, left)


def audit(ids: DataFrame, fails: dict[str, DataFrame], buckets: int | None = None) -> DataFrame:
    """One row per part, order of the filters and step (see the module's text).
    Filters have names of one letter; ``ids`` and ``fails`` as for ``count_steps``."""
    names = list(fails)
    bit = {f: 1 << k for k, f in enumerate(names)}
    steps, left = count_steps(ids, fails, buckets)
    steps, left = stored(steps, "audit-steps"), stored(left, "audit-kept")
    # an order's steps before and after f may come in any order: so many orders share a prefix
    size = F.bit_count("prefix").cast("int")
    orders = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(len(names) - 1 - k))
                                    for k in range(len(names)))), size + 1)
    alone = size == len(names) - 1
    whole = steps.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * orders).alias("shapley"),
        F.sum(F.when(alone, F.col("removed")).otherwise(0)).alias("unique_fails"))
    grid = [{"filter_order": "".join(p), "step": k + 1, "filter": f, "before": sum(bit[g] for g in p[:k]),
             "after": sum(bit[g] for g in p[:k + 1])} for p in permutations(names) for k, f in enumerate(p)]
    shape = "array<struct<filter_order:string,step:int,filter:string,before:int,after:int>>"
    rows = (left.where("prefix = 0").select("part", F.explode(F.from_json(F.lit(json.dumps(grid)), shape)).alias("g"))
            .select("part", "g.*"))
    out = (rows.join(steps.withColumnRenamed("prefix", "before"), ["part", "before", "filter"], "left")
           .join(left.withColumnRenamed("prefix", "after"), ["part", "after"], "left")
           .join(whole, ["part", "filter"], "left"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)      # noqa: E731
    return out.select("part", "filter_order", "step", *map(zero, (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(*evaluate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
masks AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END)
       + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
       + (CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 4 ELSE 0 END)
       + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
       + (CASE WHEN words.doc_id > min(words.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS mask
  FROM words LEFT JOIN marks USING (doc_id)),
patterns AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
letters(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.b | q.b | r.b | s.b | t.b = 31),
steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS b, list_sum(bits[1:step]) - bits[step] AS before
  FROM orders, range(1, 6) x(step)),
counted AS (
  SELECT part, filter_order, step, b,
         sum(CASE WHEN mask & (before::INT | b) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & b > 0 AND mask & before::INT = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & b > 0 AND mask & before::INT > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & b > 0 AND mask & before::INT = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & b > 0 AND mask & before::INT = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM patterns, steps GROUP BY part, filter_order, step, b)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley
FROM counted
"""
