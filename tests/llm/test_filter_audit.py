import itertools
import re

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"
LONG = "word " * 150_000
ROWS = [(1, "Short $ text", "en"), (2, "Short $ text", "de"), (2, "Short $ text", "de"), (3, None, "en"), (4, "", None),
        (5, LONG, "en"), (6, " ".join(f"w{i}" for i in range(120)), "en"), (7, " ".join(f"W{i}" for i in range(120)), ""),
        (8, " ".join(f"w{i}" for i in range(120)), "en"), (None, "Short $ text", "en"), (None, None, None),
        (9, "a b\x0bc d\x1fe", "fr"), (10, "ABC déf", "fr"), (11, "x|y " * 100, "fr"), (12, "\U0001f600" * 9 + "A", "fr")]
MARKS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, 1, 1), (6, 1, None), (8, 1, 0), (None, 1, 1), (99, 1, 1)]


def failing(rows):
    """The letters each row fails, by plain loops."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), i is not None and i > first[t]), strict=True) if bad))
    return out


def brute(rows, marks):
    fails = failing(rows)
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    out = []
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails, strict=True) if (p or "") == part]
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            alive = mine
            for k, f in enumerate(order):
                out_now = [(i, x) for i, x in alive if f in x]
                alive = [(i, x) for i, x in alive if f not in x]
                shapley[f] += len(out_now)
                steps.append((f, [part, "".join(order), k + 1, len(alive), len(out_now),
                                  sum(f in x for _, x in mine) - len(out_now), sum(x == f for _, x in mine),
                                  sum(i in good for i, _ in out_now), sum(i in toxic for i, _ in out_now)]))
        out += [(*row, shapley[f]) for f, row in steps]
    return sorted(out)


def frame(spark, rows):
    from pyspark.sql import functions as F
    d = docs(spark, []).drop("lang").withColumn("lang", F.lit("x"))
    made = spark.createDataFrame([(i, t, p, "s", 1) for i, t, p in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return made if rows else d.limit(0)


def test_matches_brute_force_with_odd_rows(spark):
    d = odd_columns(frame(spark, ROWS).repartition(3))
    for c in ("row", "part", "good", "prefix", "alive", "A", "low", "kept"):
        d = d.withColumn(c, d.text)
    got = A.audit(*A.evaluate(d, spark.createDataFrame(MARKS, LABELS)))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                           "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == brute(ROWS, MARKS)


def test_empty_tables(spark):
    assert A.audit(*A.evaluate(frame(spark, []), spark.createDataFrame([], LABELS))).count() == 0
    got = A.audit(*A.evaluate(frame(spark, ROWS), spark.createDataFrame([], LABELS)))
    assert sorted(map(tuple, got.collect())) == brute(ROWS, [])


def test_hot_group_of_copies(spark):
    rows = [(i, "same old text" if i % 3 else f"text {i}", "en" if i % 5 else "de") for i in range(3000)]
    marks = [(i, i % 2, i % 7 == 0) for i in range(0, 3000, 2)]
    got = A.audit(*A.evaluate(frame(spark, rows), spark.createDataFrame([(i, q, int(x)) for i, q, x in marks], LABELS)))
    assert sorted(map(tuple, got.collect())) == brute(rows, marks)


def test_any_filters_can_be_audited(spark):
    ids = spark.createDataFrame([(i, "p", i < 5, False) for i in range(10)], "row long, part string, good boolean, toxic boolean")
    fails = {"x": spark.range(0, 6).toDF("row"), "y": spark.range(4, 8).toDF("row")}
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley)
           for r in A.audit(ids, fails).collect()}
    assert got == {("xy", 1): (4, 6, 0, 4, 5, 10), ("xy", 2): (2, 2, 2, 2, 0, 6),
                   ("yx", 1): (6, 4, 0, 2, 1, 6), ("yx", 2): (2, 4, 2, 4, 4, 10)}


def test_joins_are_sort_merge_without_shuffle(spark):
    b = A._Buckets(spark, 4)
    ids = b.write(spark.range(1000).withColumnRenamed("id", "row"))
    bad = b.write(spark.range(0, 1000, 3).withColumnRenamed("id", "row")).hint("merge")
    for how in ("left_semi", "left_anti"):
        plan = ids.join(bad, "row", how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    b.forget()
    assert ids.join(bad, "row", "left_anti").count() == 666
