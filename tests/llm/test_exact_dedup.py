import hashlib

from tests.llm.helpers import docs, odd_columns
from tidemart.llm.common import scratch
from tidemart.llm.exact_dedup import DigestIndex, drop_copies, exact_dedup

ROWS = [(1, "A b"), (2, "a B"), (3, "é"), (4, "É"), (5, None), (6, ""), (7, "x" * 300_000), (8, "X" * 300_000),
        (9, "one"), (9, "one"), (None, "a b"), (None, "lonely")]


def brute(rows):
    groups = {}
    for i, t in rows:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups.setdefault(key, []).append(i)
    out = []
    for key, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        sha, first = hashlib.sha256(key.encode()).hexdigest(), True
        for i in ids:
            out.append((i, best, len(ids), i == best and first, sha))
            first = first and i != best
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in df.collect()), key=repr)


def test_matches_brute_force_with_odd_rows(spark):
    assert answer(exact_dedup(odd_columns(docs(spark, ROWS)))) == brute(ROWS)


def test_hot_group(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") for i in range(3000)]
    assert answer(exact_dedup(docs(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(docs(spark, [])).count() == 0
    assert drop_copies(docs(spark, [])).count() == 0


def test_index_persists_between_batches(spark):
    path = scratch(spark, "t-index")
    first = DigestIndex(spark, path)
    assert first.admit(docs(spark, [(1, "a"), (2, "A"), (3, "b")])).where("kept").count() == 2
    again = DigestIndex(spark, path)        # another handle on the same files
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in
           again.admit(docs(spark, [(10, "a"), (11, "c"), (12, "C")])).collect()}
    assert got == {10: (2, 3, False), 11: (12, 2, False), 12: (12, 2, True)}
    assert again.read().count() == 3


def test_anti_join_is_a_sort_merge_without_shuffling_the_index(spark):
    index = DigestIndex(spark, scratch(spark, "t-index"), buckets=8)
    index.admit(docs(spark, [(1, "a")]))
    new = spark.range(100).selectExpr("unhex(sha2(string(id), 256)) digest")
    plan = new.hint("merge").join(index.read().select("digest").hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().sparkPlan().toString() + plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") <= 1


def test_drop_copies_keeps_whole_rows(spark):
    got = drop_copies(odd_columns(docs(spark, ROWS)))
    assert got.columns == odd_columns(docs(spark, [])).columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1) for r in got.collect())
    assert ids == [-1, 2, 3, 4, 6, 8, 9]
