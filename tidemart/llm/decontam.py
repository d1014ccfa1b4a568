"""Benchmark decontamination: short test items inside long documents.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z lower-cased; a shingle is five words (an item of fewer words is one
shingle, its whole sequence). An item is found in a document when at least 0.8
of its different shingles occur in the document.

Method: the items are partitioned by size, class u holding those of more than
u/2 and up to u different shingles. Within a class a document is read in
windows of 2u shingles, one every u, so an item is compared with sets of about
its own size and not with the whole document, of which it may be a thousandth
part. Every window and every item of the class have a MinHash signature; one
equal place makes the pair a candidate. Wherever the shared shingles stand,
the windows' similarities to an item that is found sum to 0.19 or more, so
96 places miss it with probability 1e-8. Items of up to 8 shingles are looked
up by each shingle instead (windows of one shingle). A candidate is verified
by exact containment, on the shingles' bytes, against the whole document.

Documents are not shuffled: the items' index goes to the tasks, in blocks of
bounded size (a pass over the documents for each block), and a task has the
whole text at hand for the check.

Defined cases: null text counts as empty; an item without words is never
found; items that repeat as a whole count once; repeated documents are found
each; an empty table on either side gives no pairs and removes nothing; extra
columns are not looked at, and ``drop_contaminated`` keeps them."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import rows_of, table, text_or_empty, utf8_rows

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 96             # length of a MinHash signature
SMALL = 8               # items of so few shingles are looked up shingle by shingle
BLOCK_ITEMS = 4096      # items searched for in one pass over the documents
BLOCK_BYTES = 8 << 20   # and their text
GROUP = 1 << 20         # bytes of text hashed together

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c in _WORD else 32 for c in range(256))
_BASE = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def shingle_set(words: list[bytes], n: int) -> set[bytes]:
    join = b" ".join
    return {join(t) for t in zip(*(words[k:] for k in range(n)), strict=False)}


def _mix(x):
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base of word hashes and of its inverse, modulo 2^64."""
    up = down = None

    @classmethod
    def to(cls, n: int):
        import numpy as np
        if cls.up is None or len(cls.up) < n:
            n = 1 << n.bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def word_hashes(data: bytes):
    """(hash, start) of every word of folded ``data``; equal words have equal hashes."""
    import numpy as np
    hashes, starts, begin = [], [], 0
    while begin < len(data):
        end = data.find(b" ", min(begin + GROUP, len(data)))        # pieces end between words
        end = len(data) if end < 0 else end
        code = np.frombuffer(data, np.uint8, end - begin, begin)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], code != 32, [False]]).astype(np.int8)))
        first, stop = edge[::2], edge[1::2]
        up, down = _Powers.to(len(code) + 1)
        total = np.concatenate([np.zeros(1, np.uint64),
                                np.cumsum(code.astype(np.uint64) * up[:len(code)], dtype=np.uint64)])
        hashes.append(_mix((total[stop] - total[first]) * down[first] ^ (stop - first).astype(np.uint64)))
        starts.append(first + begin)
        begin = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_hashes(word, counts, n: int):
    """Hashes of the n-word shingles of consecutive texts of ``counts`` words, and
    how many each text has."""
    import numpy as np
    have = np.maximum(counts - (n - 1), 0)
    if not have.sum():
        return np.zeros(0, np.uint64), have
    h = word[:len(word) - n + 1].copy()
    for k in range(1, n):
        h = h * np.uint64(_BASE) + word[k:len(word) - n + 1 + k]
    # a text's last n - 1 words start no shingle of it
    text = np.repeat(np.arange(len(counts)), counts)[:len(h)]
    left = np.cumsum(counts)[text] - np.arange(len(h))
    return _mix(h[left >= n]), have


def _signature_keys():
    import numpy as np
    flip = _mix(np.arange(1, PLACES + 1, dtype=np.uint64) * np.uint64(_BASE))
    return flip, _mix(flip + np.uint64(1)) | np.uint64(1)


class _Lookup:
    """Values that lead to items; a bit table sieves most other values first."""

    def __init__(self, values, items):
        import numpy as np
        order = np.argsort(values, kind="stable")
        self.values, self.items = values[order], items[order]
        bits = min(26, max(16, (64 * len(values)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.sieve = np.zeros(1 << bits, bool)
        self.sieve[(values >> self.shift).astype(np.int64)] = True

    def find(self, values):
        """(index into ``values``, item) for every equal value."""
        import numpy as np
        at = np.flatnonzero(self.sieve[(values >> self.shift).astype(np.int64)])
        low = np.searchsorted(self.values, values[at], "left")
        n = np.searchsorted(self.values, values[at], "right") - low
        take = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(at, n), self.items[take]


class ItemIndex:
    """The items of one block: exact shingles, and lookups by size class."""

    def __init__(self, texts: list[bytes], threshold: float = THRESHOLD):
        import numpy as np
        self.threshold = threshold
        words = [words_of(t) for t in texts]
        self.length = [min(SHINGLE, len(w)) for w in words]
        self.shingles = [shingle_set(w, n) if n else set() for w, n in zip(words, self.length, strict=True)]
        direct: dict[int, list] = {}        # words in a shingle -> (hash, item)
        classes: dict[int, list] = {}       # u -> (signature, item)
        flip, odd = _signature_keys()
        for k, (w, n, s) in enumerate(zip(words, self.length, self.shingles, strict=True)):
            if not n:
                continue
            word, _ = word_hashes(b" ".join(w))
            h = np.unique(shingle_hashes(word, np.array([len(word)]), n)[0])
            if len(s) <= SMALL:
                direct.setdefault(n, []).append((h, np.full(len(h), k)))
            else:
                sig = ((h[:, None] ^ flip) * odd).min(axis=0)
                classes.setdefault(1 << (len(s) - 1).bit_length(), []).append((sig, np.full(PLACES, k)))
        self.direct = {n: _Lookup(*map(np.concatenate, zip(*x, strict=True))) for n, x in direct.items()}
        self.classes = {u: _Lookup(*map(np.concatenate, zip(*x, strict=True))) for u, x in sorted(classes.items())}

    def _candidates(self, texts: list[bytes]):
        """(text, item) pairs that share a signature place or, for small items, a shingle."""
        import numpy as np
        folded = b" ".join(t.translate(_FOLD) for t in texts)
        word, start = word_hashes(folded)
        ends = np.cumsum([len(t) + 1 for t in texts])
        counts = np.diff(np.searchsorted(start, ends), prepend=0)
        pairs = []
        for n, lookup in self.direct.items():
            h, have = shingle_hashes(word, counts, n)
            at, item = lookup.find(h)
            pairs.append((np.repeat(np.arange(len(texts)), have)[at], item))
        if self.classes:
            h, have = shingle_hashes(word, counts, SHINGLE)
            if len(h):
                pairs += self._by_windows(h, have)
        if not pairs:
            return []
        text, item = (np.concatenate(x) for x in zip(*pairs, strict=True))
        both = np.unique(text.astype(np.int64) * len(self.shingles) + item)
        return [divmod(int(x), len(self.shingles)) for x in both]

    def _by_windows(self, h, have):
        import numpy as np
        levels = []         # of each class: block starts in the level below, text of each block, same text follows
        below = have
        sizes = list(self.classes)
        for step in (sizes[0], *(b // a for a, b in pairwise(sizes))):
            blocks = -(-below // step)
            text = np.repeat(np.arange(len(have)), blocks)
            within = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            starts = np.repeat(np.cumsum(below) - below, blocks) + within * step
            levels.append((starts, text, text[1:] == text[:-1]))
            below = blocks
        out = []
        for flip, odd in zip(*_signature_keys(), strict=True):
            least = (h ^ flip) * odd
            for (starts, text, follows), lookup in zip(levels, self.classes.values(), strict=True):
                least = np.minimum.reduceat(least, starts)
                window = least.copy()
                np.minimum(window[:-1], least[1:], out=window[:-1], where=follows)
                at, item = lookup.find(window)
                if len(at):
                    out.append((text[at], item))
        return out

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of every pair that reaches the threshold."""
        found, last, cache = [], -1, {}
        for text, item in self._candidates(texts):
            if text != last:
                words, last, cache = words_of(texts[text]), text, {}
            n = self.length[item]
            if n not in cache:
                cache[n] = shingle_set(words, n)
            shared = len(self.shingles[item] & cache[n])
            if shared >= self.threshold * len(self.shingles[item]):
                found.append((text, item, shared))
        return found


def _groups(texts: list[bytes], size: int = GROUP):
    """(first, texts): runs of texts of about ``size`` bytes together."""
    first, group, held = 0, [], 0
    for k, t in enumerate(texts):
        group.append(t)
        held += len(t)
        if held >= size:
            yield first, group
            first, group, held = k + 1, [], 0
    if group:
        yield first, group


def item_blocks(items: DataFrame):
    """Blocks of different (item_id, text) rows of bounded size, collected one at a time."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_or_empty().alias("text")).distinct()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    n = max(-(-size.n // BLOCK_ITEMS), -(-size.b // BLOCK_BYTES), 1)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for k in range(n if size.n else 0):
        block = dealt.where(F.col("block") == k).select("item_id", "text").collect()
        if block:
            yield [r.item_id for r in block], [r.text.encode() for r in block]


def find_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared_shingles, containment), one row for
    each document and item found in it."""
    spark = docs.sparkSession
    shape = "doc_id bigint, item_id bigint, item_shingles int, shared_shingles int, containment double"

    def searched(block):
        ids, texts = block
        shared_texts = spark.sparkContext.broadcast((ids, texts))   # at most one block

        def batches(it):
            import pyarrow as pa
            ids, texts = shared_texts.value
            index = ItemIndex(texts, threshold)
            schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_shingles", pa.int32()),
                                ("shared_shingles", pa.int32()), ("containment", pa.float64())])
            for b in it:
                keys, out = b.column(0).to_pylist(), []
                for first, group in _groups(list(utf8_rows(b.column(1)))):
                    for text, item, shared in index.search(group):
                        size = len(index.shingles[item])
                        out.append((keys[first + text], ids[item], size, shared, shared / size))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in
                                                  zip(zip(*out, strict=True) if out else [[]] * 5, schema, strict=True)],
                                                 schema=schema)
        return rows_of(docs).mapInArrow(batches, shape)
    found = None
    for block in item_blocks(items):
        more = searched(block)
        found = more if found is None else found.unionByName(more)
    return found if found is not None else spark.createDataFrame([], shape)


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents in which an item is found; nothing is shuffled."""
    spark, at = docs.sparkSession, docs.columns.index("text")

    def cleaned(docs, block):
        shared_texts = spark.sparkContext.broadcast(block[1])

        def batches(it):
            import numpy as np
            import pyarrow as pa
            index = ItemIndex(shared_texts.value, threshold)
            for b in it:
                clean = np.ones(b.num_rows, bool)
                for first, group in _groups(list(utf8_rows(b.column(at)))):
                    for text, _, _ in index.search(group):
                        clean[first + text] = False
                yield b.filter(pa.array(clean))
        return docs.mapInArrow(batches, docs.schema)
    for block in item_blocks(items):
        docs = cleaned(docs, block)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
  FROM documents),
i AS (
  SELECT item_id, w, least(5, len(w)) AS n, row_number() OVER () AS k FROM (
    SELECT item_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
    FROM (SELECT DISTINCT item_id, coalesce(text, '') AS t FROM benchmark)) WHERE len(w) > 0),
si AS (
  SELECT DISTINCT k, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
size AS (SELECT k, count(*) AS item_shingles FROM si GROUP BY k),
sd AS (
  SELECT DISTINCT r, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n))
SELECT doc_id, item_id, CAST(item_shingles AS INTEGER) AS item_shingles,
       CAST(shared AS INTEGER) AS shared_shingles, CAST(shared AS DOUBLE) / item_shingles AS containment
FROM (SELECT r, k, count(*) AS shared FROM sd JOIN si USING (n, s) GROUP BY r, k)
JOIN size USING (k) JOIN d USING (r) JOIN i USING (k)
WHERE shared >= 0.8 * item_shingles"""
