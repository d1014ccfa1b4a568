import random
import re

import numpy as np

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import decontam as D

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi é ü 12 x".split()


def words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall("[0-9a-z\x80-\U0010ffff]+", low)


def brute(rows, items):
    out = []
    for i, t in rows:
        w = words(t)
        for j, x in set(items):
            v = words(x)
            n = min(5, len(v))
            if not n:
                continue
            have = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
            want = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)}
            if len(want & have) >= 0.8 * len(want):
                out.append((i, j, len(want), len(want & have)))
    return sorted(out, key=repr)


def cases(seed=4):
    rnd = random.Random(seed)
    text = lambda n: " ".join(f"{rnd.choice(WORDS)}{rnd.randrange(40)}" for _ in range(n))
    items = [(k, text(rnd.choice([1, 2, 3, 4, 5, 6, 8, 9, 12, 13, 20, 30, 37, 60, 150]))) for k in range(60)]
    rows = []
    for i in range(150):
        t = text(rnd.choice([0, 1, 3, 40, 400, 3000]))
        for _, x in rnd.sample(items, rnd.randint(0, 2)):
            v = x.split()
            kind = rnd.randrange(4)
            if kind == 1:       # broken off
                v = v[:max(1, len(v) * rnd.randint(5, 10) // 10)]
            elif kind == 2:     # in two places
                half = len(v) // 2
                t, v = " ".join(v[half:]) + " " + t, v[:half + 4]
            elif kind == 3:     # other case and punctuation
                v = [w.upper() + rnd.choice(["!!", "", "***"]) for w in v]
            w = t.split()
            at = rnd.randint(0, len(w))
            t = " ".join(w[:at] + v + w[at:])
        rows.append((i, t))
    return rows, items


def answer(df):
    return sorted(((r.doc_id, r.item_id, r.item_shingles, r.shared_shingles) for r in df.collect()), key=repr)


def frame(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string").repartition(2)


def test_matches_brute_force(spark):
    rows, items = cases()
    rows += [(900, None), (901, ""), (902, items[3][1]), (902, items[3][1]), (None, items[9][1]),
             (903, "la " * 150_000 + items[-1][1])]
    items += [(70, None), (71, ""), (72, "!!"), (3, items[3][1]), (73, items[5][1])]
    got = answer(D.find_items(odd_columns(docs(spark, rows)), frame(spark, items).selectExpr("*", "1 as doc_id", "2 as digest")))
    assert got == brute(rows, items) and len(got) > 50
    bad = {(i, t) for i, t in rows if brute([(i, t)], items)}
    left = D.drop_contaminated(odd_columns(docs(spark, rows)), frame(spark, items))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        (r for r in rows if r not in bad), key=repr)


def test_blocks_of_items(spark, monkeypatch):
    rows, items = cases(8)
    monkeypatch.setattr(D, "BLOCK_ITEMS", 13)
    assert answer(D.find_items(docs(spark, rows), frame(spark, items))) == brute(rows, items)


def test_empty_tables(spark):
    assert D.find_items(docs(spark, []), frame(spark, [(1, "a b c d e f")])).count() == 0
    assert D.find_items(docs(spark, [(1, "a")]), frame(spark, [])).count() == 0
    assert D.drop_contaminated(docs(spark, [(1, "a")]), frame(spark, [])).count() == 1


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(D, "GROUP", 50)
    text = b" ".join(f"w{k % 17}".encode() for k in range(300))
    h, start = D.word_hashes(text)
    assert len(h) == 300 and start[1] == 3
    assert all(h[k] == h[k % 17] for k in range(300)) and len(np.unique(h)) == 17
