"""Quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in halves of HALF bytes (the last one padded with
zero bytes); two neighbouring halves are a chunk, so chunks overlap by half and
cover the whole document. Every filter looks at WIDTH neighbouring bytes by
way of a learned embedding; its responses are max-pooled over the chunk and
rectified. The mean and the maximum over all chunks are combined into one
probability (of label 1) by a logistic unit. All parts are trained together by
Adam; the gradient of a pooled response goes to the place that gave the
maximum. Embedding and filters fold into a table of 256 rows for each place of
the filter, so scoring is WIDTH table look-ups for a byte.

The network is fitted on at most SAMPLE labelled documents, none of them with
crc32(doc_id) mod 5 = 0; texts of up to 64 KiB are fitted on whole. Its only
input is the text. Every document is scored whole; scoring needs no shuffle.

Defined cases: null text counts as empty; an empty text is one padded half and
has a score like any other; labels with a null are not used; without labelled
documents every score is 0.5; a null doc_id is not held out; repeated rows
give repeated results; an empty table gives an empty result; extra columns
are not looked at."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import labelled_sample, rows_of, table, utf8_rows

HALF = 256
WIDTH = 7
FILTERS = 16
EMBEDDING = 10
SAMPLE = 3000
STEPS = 500
BATCH = 32
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.3
HELD_OUT = 5
GROUP = 1 << 17         # bytes convolved together


def halves(texts: list[bytes]):
    """(rows of HALF + WIDTH - 1 bytes, number of rows of each text)."""
    import numpy as np
    counts = [max(1, -(-len(t) // HALF)) for t in texts]
    rows = np.zeros((sum(counts), HALF + WIDTH - 1), np.uint8)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        flat = np.zeros(n * HALF + WIDTH - 1, np.uint8)
        flat[:len(t)] = np.frombuffer(t, np.uint8)
        rows[at:at + n] = np.lib.stride_tricks.sliding_window_view(flat, HALF + WIDTH - 1)[::HALF]
        at += n
    return rows, np.array(counts)


def _classes():
    """The embedding before training: kinds of bytes."""
    import numpy as np
    kind = np.zeros((256, EMBEDDING))
    for c in range(256):
        if 97 <= c <= 122:
            k = 0
        elif 65 <= c <= 90:
            k = 1
        elif 48 <= c <= 57:
            k = 2
        elif c == 32:
            k = 3
        elif c in (9, 10, 13):
            k = 4
        elif c in b".,;:'\"()-":
            k = 5
        elif c >= 128:
            k = 6
        elif c:
            k = 7
        else:
            k = 8
        kind[c, k] = 1
    return kind


class Network:
    def __init__(self, parts: dict):
        self.parts = parts
        self.fold()

    @classmethod
    def new(cls, share: float):
        import numpy as np
        rnd = np.random.default_rng(7)
        return cls({"embedding": _classes() + rnd.normal(0, 0.1, (256, EMBEDDING)),
                    "filters": rnd.normal(0, 0.4, (WIDTH, EMBEDDING, FILTERS)),
                    "bias": np.zeros(FILTERS), "weights": rnd.normal(0, 0.1, 2 * FILTERS),
                    "constant": np.array([np.log(share / (1 - share))])})

    def fold(self) -> None:
        import numpy as np
        self.tables = np.einsum("ce,jef->jcf", self.parts["embedding"], self.parts["filters"]).astype(np.float32)

    def pooled(self, rows, places: bool = False):
        """Largest response of every filter in every row, and where it is."""
        import numpy as np
        out = np.empty((len(rows), FILTERS), np.float32)
        at = np.empty((len(rows), FILTERS), np.int64) if places else None
        step = max(1, GROUP // HALF)
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            response = self.tables[0][part[:, :HALF]]
            for j in range(1, WIDTH):
                response += self.tables[j][part[:, j:j + HALF]]
            if places:
                at[k:k + step] = response.argmax(axis=1)
            out[k:k + step] = response.max(axis=1)
        return out + self.parts["bias"].astype(np.float32), at

    def _combine(self, half, counts):
        """Chunks and what documents make of them."""
        import numpy as np
        text = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(counts)
        other = np.minimum(np.arange(len(half)) + 1, ends[text] - 1)   # a lone last half is a chunk of itself
        second = half[other] > half
        chunk = np.maximum(np.where(second, half[other], half), 0)
        used = counts - (counts > 1)
        weight = np.ones(len(half))
        weight[ends[counts > 1] - 1] = 0        # the last half is in the chunk before it
        starts = ends - counts
        mean = np.add.reduceat(chunk * weight[:, None], starts, axis=0) / used[:, None]
        most = np.maximum.reduceat(chunk, starts, axis=0)
        return text, other, second, chunk, weight, used, starts, mean, most

    def scores(self, texts: list[bytes]):
        import numpy as np
        rows, counts = halves(texts)
        half, _ = self.pooled(rows)
        *_, mean, most = self._combine(half, counts)
        z = np.hstack([mean, most]) @ self.parts["weights"] + self.parts["constant"][0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, rows, counts, y) -> dict:
        import numpy as np
        half, at = self.pooled(rows, places=True)
        text, other, second, chunk, weight, used, starts, mean, most = self._combine(half, counts)
        seen = np.hstack([mean, most])
        z = seen @ self.parts["weights"] + self.parts["constant"][0]
        dz = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        back = dz[:, None] * self.parts["weights"]
        d_chunk = (back[:, :FILTERS] / used[:, None])[text] * weight[:, None]
        # the maximum over chunks: the first chunk that reaches it
        reach = chunk == most[text]
        first = np.cumsum(reach, axis=0, dtype=np.int64)
        first = reach & (first - (first[starts] - reach[starts])[text] == 1)
        d_chunk = (d_chunk + back[:, FILTERS:][text] * first) * (chunk > 0)
        row, filt = np.nonzero(d_chunk)
        g = d_chunk[row, filt]
        row = np.where(second[row, filt], other[row], row)
        place = at[row, filt]
        d_table = np.stack([np.bincount(rows[row, place + j].astype(np.int64) * FILTERS + filt, g, 256 * FILTERS)
                            .reshape(256, FILTERS) for j in range(WIDTH)])
        return {"embedding": np.einsum("jcf,jef->ce", d_table, self.parts["filters"]),
                "filters": np.einsum("ce,jcf->jef", self.parts["embedding"], d_table),
                "bias": np.bincount(filt, g, FILTERS), "weights": seen.T @ dz, "constant": np.array([dz.sum()])}


def train(texts: list[bytes], y, steps: int = STEPS) -> Network | None:
    """Adam over batches of BATCH texts in a fixed random order."""
    import numpy as np
    if not texts:
        return None
    y = np.asarray(y, float)
    net = Network.new(float(np.clip(y.mean(), 0.02, 0.98)))
    cut = [halves([t])[0] for t in texts]
    rnd = np.random.default_rng(11)
    first = {k: np.zeros_like(v) for k, v in net.parts.items()}
    second = {k: np.zeros_like(v) for k, v in net.parts.items()}
    order: list[int] = []
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order += rnd.permutation(len(texts)).tolist()
        batch, order = order[:BATCH], order[BATCH:]
        found = net.gradients(np.concatenate([cut[k] for k in batch]), np.array([len(cut[k]) for k in batch]), y[batch])
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in found.items():
            g = g + DECAY * net.parts[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            net.parts[k] = net.parts[k] - rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        net.fold()
    return net


def held_out(doc_id):
    """crc32 of the doc_id as text leaves no remainder by HELD_OUT; false for a null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    """On labelled rows that are not held out."""
    rows = labelled_sample(docs, labels, sample, ~held_out(F.col("doc_id")))
    return train([r.text.encode() for r in rows], [r.quality for r in rows])


def _groups(texts, size: int = GROUP):
    group, held = [], 0
    for t in texts:
        group.append(t)
        held += len(t) + HALF
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    parts = docs.sparkSession.sparkContext.broadcast(net.parts if net else None)   # of fixed size

    def batches(it):
        import numpy as np
        import pyarrow as pa
        net = Network(parts.value) if parts.value else None
        for b in it:
            texts = list(utf8_rows(b.column(1)))
            found = [net.scores(g) for g in _groups(texts)] if net else [np.full(len(texts), 0.5)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.concatenate(found) if found else [], pa.float64())], names=["doc_id", "score"])
    return rows_of(docs).mapInArrow(batches, "doc_id bigint, score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
