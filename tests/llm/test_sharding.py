import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs
from tidemart.llm import sharding as S
from tidemart.llm.common import scratch


def brute_table(names, m):
    perms = []
    for n in names:
        h = hashlib.sha256(n.encode()).digest()
        start, step = int.from_bytes(h[:8], "big") % m, int.from_bytes(h[8:16], "big") % (m - 1) + 1
        perms.append([(start + j * step) % m for j in range(m)])
    owner = {}
    while len(owner) < m:
        for k, p in enumerate(perms):
            free = [s for s in p if s not in owner]
            if free:
                owner[free[0]] = k
    return [owner[s] for s in range(m)]


def test_table_matches_brute_force():
    for names in (["a"], ["a", "b", "c"], [f"s{i}" for i in range(13)]):
        assert S.lookup_table(names, 211) == brute_table(names, 211)


def test_every_row_is_placed(spark):
    rows = [(i, "t") for i in range(500)] + [(None, "t"), (7, "t"), (7, "again")]
    table = brute_table(S.SHARDS[:5], 211)
    got = S.place(docs(spark, rows), F.col("doc_id"), S.SHARDS[:5], 211).collect()
    want = Counter()
    for i, _ in rows:
        slot = int(hashlib.md5(str(i if i is not None else "").encode()).hexdigest()[:15], 16) % 211
        want[(i, slot, table[slot])] += 1
    assert Counter((r.doc_id, r.slot, r.shard) for r in got) == want
    assert S.place(docs(spark, []), F.col("doc_id")).count() == 0


def test_shares_are_even_and_losing_a_shard_moves_little():
    whole = S.lookup_table(S.SHARDS)
    share = Counter(whole)
    assert max(share.values()) - min(share.values()) <= 1
    fewer = S.lookup_table(S.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(whole, fewer, strict=True) if a != len(S.SHARDS) - 1)
    assert moved < 0.1 * S.SLOTS


def test_bad_tables():
    for names, m in (([], 7), (["a", "a"], 7), (["a"], 8), ([str(i) for i in range(8)], 7)):
        with pytest.raises(ValueError):
            S.lookup_table(names, m)


def test_plan_is_native_with_one_broadcast(spark):
    plan = S.place(docs(spark, [(1, "a")]), F.col("doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan


def test_written_shards_read_back(spark):
    path = scratch(spark, "t-shards")
    rows = [(i, f"t{i}") for i in range(200)]
    S.write_shards(docs(spark, rows), F.col("doc_id"), path, S.SHARDS[:4], 211)
    back = S.read_shards(spark, path, docs(spark, []).schema)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == rows
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_registered_query_writes_whole_documents(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i} é") for i in range(300)] + [(None, None), (7, "again"), (7, "again")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    paths = []
    monkeypatch.setattr(S, "scratch", lambda *a: paths.append(scratch(*a)) or paths[-1])
    got = S.op5_sharding(spark, str(tmp_path)).collect()
    placed = S.place(docs(spark, rows), F.col("doc_id")).select("doc_id", "slot", "shard").collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, placed))
    back = S.read_shards(spark, paths[0], docs(spark, []).schema).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(rows)


def test_registered_query_on_an_empty_table(spark, tmp_path):
    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert S.op5_sharding(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_come_back(spark, tmp_path):
    d = docs(spark, [(i, f"text {i}") for i in range(50)])
    for k, n in enumerate(("slot", "shard", "row", "_0", "_1", "owner", "Shard", "key")):
        if n != "Shard":
            d = d.withColumn(n, F.concat(F.lit(f"{n}{k}:"), F.col("doc_id").cast("string")))
    path = scratch(spark, "t-shards")
    S.write_shards(d, F.col("doc_id"), path, S.SHARDS[:4], 211)
    back = S.read_shards(spark, path, d.schema, "at")
    assert back.columns == [*d.columns, "at"]
    assert sorted(map(tuple, back.drop("at").collect())) == sorted(map(tuple, d.collect()))
    placed = S.place(d, F.col("doc_id"), S.SHARDS[:4], 211, slot="s", shard="at")
    assert sorted(map(tuple, placed.drop("s").collect())) == sorted(map(tuple, back.collect()))
    with pytest.raises(ValueError):
        S.place(d, F.col("doc_id"))
    d.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.slot, r.shard) for r in S.op5_sharding(spark, str(tmp_path)).collect()}
    want = {tuple(r) for r in S.place(docs(spark, [(i, "") for i in range(50)]), F.col("doc_id")).select("doc_id", "slot", "shard").collect()}
    assert got == want
