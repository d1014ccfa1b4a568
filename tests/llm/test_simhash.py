import random

import xxhash

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import simhash as S


def brute_fp(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ")
             .split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    """fps: {fp}: union-find over all pairs."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    fs = sorted(fps)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    return {f: find(f) for f in fs}


def brute(rows):
    fp = [(i, brute_fp(t)) for i, t in rows]
    comp = brute_components({f for _, f in fp})
    best = {}
    for i, f in fp:
        if i is not None:
            best[comp[f]] = min(best.get(comp[f], i), i)
    return sorted(((i, f, best.get(comp[f])) for i, f in fp), key=repr)


def answer(df):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect()), key=repr)


def texts(seed, n):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice("alpha beta gamma delta eps zeta eta theta Iota kappa é ü".split())
                     for _ in range(rnd.randint(1, 120))) for _ in range(n // 4)]
    out = []
    for i in range(n):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = rnd.choice(["omega", "psi", "chi"])
        out.append((i, " ".join(words)))
    return out


def test_fingerprint_equals_native_hash(spark):
    rows = [(1, "One two THREE four"), (2, "a"), (3, None), (4, " \t\n "), (5, "x\x0by\x1cz É é")]
    got = {r.doc_id: r.fp % 2**64 for r in S.fingerprints(docs(spark, rows)).collect()}
    assert got == {i: brute_fp(t) for i, t in rows}
    assert got[2] == spark.sql("select xxhash64('a') h").first().h % 2**64


def test_matches_brute_force(spark):
    rows = texts(1, 300) + [(1000, None), (1001, ""), (7, "repeat me now please"), (7, "repeat me now please"),
                            (None, "repeat me now please"), (None, "only null id here"), (1002, "w " * 200_000)]
    assert answer(S.near_dedup(odd_columns(docs(spark, rows)))) == brute(rows)


def test_empty_table(spark):
    assert S.near_dedup(docs(spark, [])).count() == 0
    assert S.drop_near(docs(spark, [])).count() == 0


def test_links_of_random_fingerprints_are_complete(spark):
    rnd = random.Random(5)
    fps = set()
    for _ in range(150):
        f = rnd.getrandbits(64)
        fps.add(f)
        for _ in range(3):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                g ^= 1 << b
            fps.add(g)
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp bigint")
    want = {frozenset((a, b)) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    got = [frozenset((r.a % 2**64, r.b % 2**64)) for r in S.links(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    # with every anchor crowded: links may be fewer, components are the same
    few = S.links(frame, crowd=0).collect()
    assert {frozenset((r.a % 2**64, r.b % 2**64)) for r in few} <= want
    nodes = frame.selectExpr("fp", "struct(false as none, fp as id, fp as fp) as mark")
    root = brute_components(fps)
    groups = {}
    for r in S.component_labels(nodes, S.links(frame, crowd=0)).collect():
        groups.setdefault(r.label.fp, set()).add(r.node % 2**64)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(x for x in fps if root[x] == r) for r in set(root.values()) if sum(root[x] == r for x in fps) > 1)


def test_drop_near_keeps_one_of_each_component(spark):
    rows = texts(2, 120) + [(7, "repeat me now please"), (7, "repeat me now please")]
    want = sorted({(c, ) for _, _, c in brute(rows)})
    got = S.drop_near(odd_columns(docs(spark, rows)))
    assert got.columns == odd_columns(docs(spark, [])).columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted((i,) for i in ids if i != 7) == [w for w in want if w != (7,)] and 7 in ids
