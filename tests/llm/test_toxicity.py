import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def made(seed, n):
    rnd = random.Random(seed)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(n):
        words = [rnd.choice(base) for _ in range(rnd.randint(5, 80))]
        toxic, good = rnd.random() < 0.2, rnd.random() < 0.8
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(["nastyone", "nastytwo", "Vile!"])
        if not good:
            words += ["zzz%%%"] * 3
        rows.append((i, " ".join(words), int(good), int(toxic)))
    return rows


def chain_of(rows):
    return T.Chain.fit([r[1] for r in rows], [T.targets(*r[2:]) for r in rows], [zlib.crc32(r[1].encode()) for r in rows])


def test_earlier_probabilities_reach_later_models():
    rows = made(1, 400)
    chain = chain_of(rows)
    n = len(chain.features)
    assert [len(w) for w in chain.models] == [n + 1, n + 2, n + 3]
    p = chain.probabilities([r[1] for r in rows])
    x = chain.matrix([r[1] for r in rows])
    for c, w in enumerate(chain.models):        # by hand, in order
        z = x @ w[:n] + sum(T.log_odds(p[:, k]) * w[n + k] for k in range(c)) + w[-1]
        assert np.allclose(p[:, c], T.sigmoid(z))


def test_out_of_fold_predictions_do_not_see_their_own_labels():
    rnd = np.random.default_rng(0)
    texts = [" ".join(f"w{k}" for k in rnd.integers(0, 60, 20)) for _ in range(300)]
    y = rnd.integers(0, 2, 300)                 # labels without meaning
    chain = T.Chain.fit(texts, np.stack([y, y], axis=1), [zlib.crc32(t.encode()) for t in texts])
    # the first category's in-sample fit is good, out-of-fold it is worthless, so the second leans on it little
    assert chain.models[1][-2] < 0.5


def test_held_out_accuracy():
    chain = chain_of(made(1, 600))
    held = made(2, 600)
    p = chain.probabilities([r[1] for r in held])[:, -1] >= T.THRESHOLD
    y = np.array([r[3] for r in held]) == 1
    assert (p & y).sum() / y.sum() > 0.9 and (p & ~y).sum() / (~y).sum() < 0.05


def test_odd_rows(spark):
    rows = made(1, 300)
    chain = chain_of(rows)
    odd = [(1, None), (2, ""), (3, "nastyone " * 100_000), (3, "nastyone nastytwo"), (3, "nastyone nastytwo"), (None, "vile")]
    got = T.score(odd_columns(docs(spark, odd)), chain).collect()
    assert len(got) == 6
    empty = chain.probabilities([""])[0]
    assert all(np.allclose([r.p_spam, r.p_abuse, r.p_toxic], empty) for r in got if r.doc_id in (1, 2))
    left = T.drop_toxic(odd_columns(docs(spark, odd)), chain)
    assert left.columns == odd_columns(docs(spark, [])).columns
    want = [i for (i, t), p in zip(odd, chain.probabilities([t or "" for _, t in odd])[:, -1], strict=True) if p < T.THRESHOLD]
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)
    assert T.score(docs(spark, []), chain).count() == 0 and T.drop_toxic(docs(spark, []), chain).count() == 0


def test_without_labels(spark):
    labels = spark.createDataFrame([(1, None, 1)], "doc_id bigint, quality int, toxic int")
    chain = T.fit(docs(spark, [(1, "a")]), labels)
    assert T.score(docs(spark, [(1, "a")]), chain).first().p_toxic == 0


def test_registered_tables_held_out(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4))
    chain = T.fit(d, labels.where(fold != 0))
    seen = {r.text for r in d.join(labels.where(fold != 0), "doc_id").select("text").collect()}
    held = [r for r in d.join(labels.where(fold == 0), "doc_id").collect() if r.text not in seen]
    p = chain.probabilities([r.text for r in held])[:, -1] >= T.THRESHOLD
    y = np.array([r.toxic for r in held]) == 1
    assert (p & y).sum() / y.sum() > 0.9 and (p & ~y).sum() / (~y).sum() < 0.02
