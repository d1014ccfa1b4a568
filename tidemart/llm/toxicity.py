"""Toxicity by a classifier chain.

The categories are predicted one after another: ``spam`` (labelled as of low
quality), ``abuse`` (toxic, though of good quality otherwise) and ``toxic``. Each is
a linear (logistic) model over the text's features and the log-odds of the
categories before it. While fitting, those earlier probabilities are
out-of-fold: a document's are predicted by models that have not seen it or any
copy of it, so a later model learns how far to trust them. Scoring runs the
chain in the same order; a document is rejected when the last category's
probability reaches THRESHOLD.

Features: the different lower-cased words of the text and their beginnings of 4, 5
and 7 letters, as log(1 + number of different words with the beginning). For
every category the FEATURES with the largest log-odds ratio in standard errors
are used. The chain is fitted on at most SAMPLE labelled documents; every
document is scored over its whole text. Scoring needs no shuffle.

Defined cases: null text counts as empty; an empty text has the models'
constant probabilities; labels with a null are not used; without labelled
documents every probability is 0; repeated rows give repeated results; an
empty table gives an empty result; ``drop_toxic`` keeps extra columns."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm.common import labelled_sample, rows_of, table, utf8_rows

CATEGORIES = ("spam", "abuse", "toxic")
SAMPLE = 4000
FEATURES = 300          # of each category
FOLDS = 5
THRESHOLD = 0.25
LEAST = 3               # documents a feature must occur in
STARTS = (4, 5, 7)
PENALTY = 1.0
STEPS = 200
MEMO = 1 << 18

_WORD = re.compile(r"\w+")


def targets(quality: int, toxic: int) -> tuple[int, ...]:
    return int(quality == 0), int(toxic == 1 and quality == 1), int(toxic == 1)


def word_features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in STARTS if len(word) > k)]


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def choose_features(found: list[list[str]], y) -> list[str]:
    """The features that tell the classes apart best; ``found`` has those of each document."""
    n1 = int(sum(y))
    n0 = len(y) - n1
    ones, zeros = Counter(), Counter()
    for features, label in zip(found, y, strict=True):
        (ones if label else zeros).update(features)
    scored = []
    for f in ones.keys() | zeros.keys():
        a, b = ones[f], zeros[f]
        if a + b < LEAST:
            continue
        cells = (a + 0.5, n1 - a + 0.5, b + 0.5, n0 - b + 0.5)
        ratio = math.log(cells[0] * cells[3] / (cells[1] * cells[2]))
        scored.append((-abs(ratio) / math.sqrt(sum(1 / c for c in cells)), f))
    return [f for _, f in sorted(scored)[:FEATURES]]


def sigmoid(z):
    import numpy as np
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def log_odds(p):
    import numpy as np
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_logistic(x, y, used):
    """Weights, the constant last, of one model for every column of ``used`` (the rows
    that it sees, 0 or 1): accelerated gradient descent with a ridge penalty, all
    models in the same matrix products."""
    import numpy as np
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    used, y = used.astype(np.float32), y.astype(np.float32)[:, None]
    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):                     # largest eigenvalue: the step size
        v = x.T @ (x @ v)
        size = np.linalg.norm(v)
        v = v / size
    step = np.float32(1 / (0.25 * size * 1.05 + PENALTY))
    ridge = np.full((x.shape[1], 1), PENALTY, np.float32)
    ridge[-1] = 0
    w = ahead = np.zeros((x.shape[1], used.shape[1]), np.float32)
    for k in range(STEPS):
        gradient = x.T @ ((sigmoid(x @ ahead) - y) * used) + ridge * ahead
        new = ahead - step * gradient
        ahead = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w.astype(np.float64)


class Chain:
    """A fitted chain: features (name -> column) and the models in order."""

    def __init__(self, features: list[str], models: list):
        self.features = {f: k for k, f in enumerate(features)}
        self.models = models
        self.memo: dict[str, tuple[int, ...]] = {}

    @classmethod
    def fit(cls, texts: list[str], y, groups: list[int]) -> Chain:
        """``y``: one row of targets for each text; texts of one group stay in one fold."""
        import numpy as np
        if not len(texts):
            return cls([], [])
        y = np.asarray(y, float)
        of_word: dict[str, list[str]] = {}
        found = []
        for t in texts:
            own: set[str] = set()
            for w in words_of(t):
                if w not in of_word:
                    of_word[w] = word_features(w)
                own.update(of_word[w])
            found.append(list(own))
        features: dict[str, None] = {}
        for c in range(y.shape[1]):
            features |= dict.fromkeys(choose_features(found, y[:, c]))
        del found, of_word
        chain = cls(list(features), [])
        x = chain.matrix(texts)
        fold = np.array([g % FOLDS for g in groups])
        # a model for each fold, without its rows, and the last one with all rows
        used = np.stack([*(fold != k for k in range(FOLDS)), np.ones(len(x), bool)], axis=1)
        for c in range(y.shape[1]):
            w = fit_logistic(x, y[:, c], used)
            unseen = sigmoid((x * w[:-1, fold].T).sum(axis=1) + w[-1, fold])
            chain.models.append(w[:, -1])
            x = np.hstack([x, log_odds(unseen)[:, None]])
        return chain

    def matrix(self, texts: list[str]):
        import numpy as np
        rows, columns = [], []
        for k, t in enumerate(texts):
            if len(self.memo) > MEMO:
                self.memo.clear()
            memo = self.memo
            for w in words_of(t):
                at = memo.get(w)
                if at is None:
                    at = memo[w] = tuple(self.features[f] for f in word_features(w) if f in self.features)
                if at:
                    columns += at
                    rows += [k] * len(at)
        size = len(self.features)
        counts = np.bincount(np.array(rows, np.int64) * size + np.array(columns, np.int64),
                             minlength=len(texts) * size) if size else np.zeros(0)
        return np.log1p(counts.reshape(len(texts), size))

    def probabilities(self, texts: list[str]):
        """One row for each text, one column for each category."""
        import numpy as np
        if not self.models:
            return np.zeros((len(texts), len(CATEGORIES)))
        x = self.matrix(texts)
        out = []
        for w in self.models:
            p = sigmoid(x @ w[:-1] + w[-1])
            out.append(p)
            x = np.hstack([x, log_odds(p)[:, None]])
        return np.stack(out, axis=1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    rows = labelled_sample(docs, labels, sample)
    return Chain.fit([r.text for r in rows], [targets(r.quality, r.toxic) for r in rows],
                     [zlib.crc32(r.text.encode()) for r in rows])


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_spam, p_abuse, p_toxic) for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast((list(chain.features), chain.models))  # FEATURES bounds it
    names = [f"p_{c}" for c in CATEGORIES]

    def batches(it):
        import pyarrow as pa
        chain = Chain(*shared.value)
        for b in it:
            p = chain.probabilities([t.decode() for t in utf8_rows(b.column(1))])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, k].copy()) for k in range(len(names)))],
                                             names=["doc_id", *names])
    return rows_of(docs).mapInArrow(batches, "doc_id bigint, " + ", ".join(f"{n} double" for n in names))


def drop_toxic(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents the chain rejects; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((list(chain.features), chain.models))
    at = docs.columns.index("text")

    def batches(it):
        import pyarrow as pa
        chain = Chain(*shared.value)
        for b in it:
            p = chain.probabilities([t.decode() for t in utf8_rows(b.column(at))])
            yield b.filter(pa.array(p[:, -1] < threshold))
    return docs.mapInArrow(batches, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.selectExpr("doc_id", "p_spam", "p_abuse", "p_toxic as score",
                             f"cast(p_toxic >= {THRESHOLD} as int) as predicted")
