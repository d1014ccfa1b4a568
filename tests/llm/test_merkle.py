import hashlib
import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, odd_columns
from tidemart.llm import merkle as M


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def climb(nodes, fanout=8):
    """Root and, for each leaf, its [(left, right)] up to it."""
    where, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for k, at in enumerate(where):
            run = at // fanout * fanout
            paths[k].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + fanout])))
            where[k] = at // fanout
        nodes = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout=8):
    """rows: (doc_id, text, lang, source, n_chars)."""
    leaf = lambda i, t, g, s, n: H(*map(field, (i, s, g, n, t)))        # noqa: E731
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((mine, *climb([leaf(*r) for r in mine], fanout)))
    root, above = climb([t[1] for t in trees], fanout) if trees else (None, [])
    out = []
    for (mine, sub, paths), top in zip(trees, above, strict=True):
        for r, path in zip(mine, paths, strict=True):
            i, t, *rest = r
            bad = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
            acc = leaf(i, lower(t) if bad else t, *rest)
            for left, right in path + top:
                acc = H(left, acc, right)
            out.append((i, leaf(*r), sub, root, H(*(a + b for a, b in path + top)), acc, acc == root))
    return sorted(out, key=repr)


def make_rows(n):
    langs = ["en", "de", None, "", "é", "z" * 3, *(f"l{k}" for k in range(20))]
    rows = [(i, f"Text {i}" if i % 2 else f"text {i}", langs[(i * i) % 11 % len(langs)], f"s{i % 3}", i) for i in range(n)]
    rows += [(1000 + k, "Lone", g, None, 4) for k, g in enumerate(langs[11:])]
    return rows + [(7, "Again", "en", "s", 1), (7, "Again", "en", "s", 1), (7, None, "en", None, None), (None, "No Id", "en", "s", 5),
                   (None, None, None, None, None), (8, "", "en", "s", 0), (9, "Äb" * 200_000, "en", "s", 9)]


def answer(spark, tmp_path, rows, odd=False, name="d"):
    d = spark.createDataFrame(rows, DOCS).repartition(5)
    if odd:
        d = odd_columns(d)
        for c in ("leaf", "grp", "pos", "n", "c0", "path", "root", "key", "range", "at", "id", "other", "up", "tie"):
            d = d.withColumn(c, F.lit("x"))
    d.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return sorted(map(tuple, M.op11_merkle(spark, f"{tmp_path}/{name}").collect()), key=repr)


def test_matches_brute_force_with_odd_rows(spark, tmp_path):
    rows = make_rows(700)
    got = answer(spark, tmp_path, rows, odd=True)
    assert got == brute(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_one_row_one_group_and_no_rows(spark, tmp_path):
    for k, rows in enumerate(([(3, "a", "en", "s", 1)], [(i, "A", "en", "s", 1) for i in range(9)], [])):
        assert answer(spark, tmp_path, rows, name=f"d{k}") == brute(rows)


def test_other_fanouts(spark):
    rows = make_rows(100)
    leaves = spark.createDataFrame(rows, DOCS).select(
        F.col("doc_id").alias("id"), F.col("lang").alias("group"), M.leaf([F.col(c) for c in M.FIELDS]).alias("leaf"))
    for fanout in (2, 3):
        got = M.prove(M.build(leaves, fanout)).select("id", "leaf", "subroot", "root", M.proof_digest()).collect()
        assert sorted(map(tuple, got), key=repr) == sorted((r[:5] for r in brute(rows, fanout)), key=repr)


def test_a_path_holds_and_a_changed_row_does_not(spark):
    leaves = spark.range(500).select(F.col("id"), F.lit("g").alias("group"), M.leaf([F.col("id")]).alias("leaf"))
    rows = M.prove(M.build(leaves)).withColumns({
        "same": M.fold(F.col("leaf")) == F.col("root"),
        "other": M.fold(M.leaf([F.col("id") + 1])) == F.col("root")})
    assert rows.where("same").count() == 500 and rows.where("other").count() == 0
