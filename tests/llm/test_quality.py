import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import quality as Q


def slow_score(net, text):
    """One document by plain loops."""
    data = text or b""
    n = max(1, -(-len(data) // Q.HALF))
    data = data + b"\0" * (n * Q.HALF + Q.WIDTH - 1 - len(data))
    e, f, b = net.parts["embedding"], net.parts["filters"], net.parts["bias"]
    response = np.array([sum(e[data[p + j]] @ f[j] for j in range(Q.WIDTH)) + b for p in range(n * Q.HALF)])
    starts = range(0, max(1, n - 1) * Q.HALF, Q.HALF)
    chunks = np.array([np.maximum(response[s:s + 2 * Q.HALF].max(axis=0), 0) for s in starts])
    z = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ net.parts["weights"] + net.parts["constant"][0]
    return 1 / (1 + np.exp(-z))


def test_scores_match_plain_loops():
    net = Q.Network.new(0.7)
    texts = [b"", b"x", b"a" * 256, b"ab " * 90, "é!! $$$ ".encode() * 200, b"The end.\n" * 400]
    assert np.allclose(net.scores(texts), [slow_score(net, t) for t in texts], atol=1e-4)


def test_gradients_match_differences():
    net = Q.Network.new(0.8)
    rows, counts = Q.halves([b"abc def GHI!! " * 60, b"x", b"THE !!" * 300])
    y = np.array([1.0, 0, 0])
    found = net.gradients(rows, counts, y)

    def loss():
        net.tables = np.einsum("ce,jef->jcf", net.parts["embedding"], net.parts["filters"])
        half = net.pooled(rows)[0]
        *_, mean, most = net._combine(half, counts)
        p = 1 / (1 + np.exp(-(np.hstack([mean, most]) @ net.parts["weights"] + net.parts["constant"][0])))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    for name, at in (("filters", (2, 1, 3)), ("embedding", (84, 1)), ("bias", (5,)), ("weights", (20,)), ("constant", (0,))):
        kept = net.parts[name][at]
        ends = []
        for e in (1e-3, -1e-3):
            net.parts[name][at] = kept + e
            ends.append(loss())
        net.parts[name][at] = kept
        assert abs((ends[0] - ends[1]) / 2e-3 - found[name][at]) < 1e-3


def test_only_rows_that_are_not_held_out_are_fitted(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "train", lambda texts, y: seen.extend(texts))
    rows = [(i, f"text {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id bigint, quality int, toxic int")
    Q.fit(docs(spark, rows), labels)
    assert {t.decode() for t in seen} == {f"text {i}" for i in range(60) if zlib.crc32(str(i).encode()) % 5}
    got = spark.range(60).select("id", Q.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_odd_rows(spark):
    net = Q.Network.new(0.7)
    rows = [(1, None), (2, ""), (3, "word " * 100_000), (3, "word"), (3, "word"), (None, "é")]
    got = sorted(((r.doc_id, round(r.score, 5)) for r in Q.score(odd_columns(docs(spark, rows)), net).collect()), key=repr)
    assert got == sorted(((i, round(float(net.scores([(t or "").encode()])[0]), 5)) for i, t in rows), key=repr)
    assert Q.score(docs(spark, []), net).count() == 0
    assert Q.score(docs(spark, rows), None).where("score = 0.5").count() == 6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = d.join(labels, "doc_id").where(Q.held_out(F.col("doc_id"))).collect()
    net = Q.fit(d, labels)
    s = np.concatenate([net.scores(g) for g in Q._groups([r.text.encode() for r in held])])
    y = np.array([r.quality for r in held])
    assert (s[y == 1] >= Q.THRESHOLD).mean() > 0.98 and (s[y == 0] < Q.THRESHOLD).mean() > 0.9
