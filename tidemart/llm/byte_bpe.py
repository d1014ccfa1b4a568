"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut by the tokenizer's pattern into pre-tokens; each is encoded by
itself. Tier one: a minimal perfect hash over the vocabulary (levels of bit
arrays, the place of a key being the rank of its bit) resolves the pre-tokens
that are whole vocabulary entries; the entry found is compared with the
pre-token, since the hash maps strangers somewhere too. Tier two: the rest is
merged from single bytes over a linked list, the lowest rank first, leftmost
first: short pre-tokens many at a time by numpy, one merge of each in a round,
and long ones with a heap that yields that rank. Results are kept in a store of fixed size (emptied
when full), so memory does not grow with the corpus; a pre-token is a number
that leads into the store, and texts are put together by numpy.

Defined cases: null text counts as empty; an empty text has no ids, and
decodes to no bytes; special tokens are ordinary text; repeated rows give
repeated results; an empty table gives an empty result; extra columns are not
looked at."""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import rows_of, table, utf8_rows

STORE = 1 << 18      # pre-tokens an encoder holds
PIECE = 1 << 18     # characters whose pre-tokens are looked up together


class PerfectHash:
    """Minimal perfect hash over ``keys`` (different byte strings): ``places``
    gives each key its own number below ``len(keys)``, and some number or -1 to
    any other string."""

    GAMMA = 2

    def __init__(self, keys: list[bytes]):
        import numpy as np
        self.levels = []        # (bits as booleans, rank before each bit)
        left, placed, salt = self._hashes(keys), 0, 0
        while len(left):
            size = max(64, self.GAMMA * len(left))
            at = self._at(left, salt, size)
            bits = np.bincount(at, minlength=size) == 1
            self.levels.append((salt, bits, placed + np.cumsum(bits, dtype=np.int64) - bits))
            alone = bits[at]
            placed += int(alone.sum())
            left = left[~alone]
            salt += 1
            if salt > 200:
                raise ValueError("the keys are not all different")

    @staticmethod
    def _hashes(keys: Iterable[bytes]):
        import numpy as np
        from xxhash import xxh3_64_intdigest
        return np.fromiter(map(xxh3_64_intdigest, keys), np.uint64)

    @staticmethod
    def _at(h, salt: int, size: int):
        import numpy as np
        x = h ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    def places(self, keys: list[bytes]):
        import numpy as np
        h = self._hashes(keys)
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for salt, bits, rank in self.levels:
            at = self._at(h[left], salt, len(bits))
            hit = bits[at]
            out[left[hit]] = rank[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out


_NONE = 1 << 62         # no such pair; above every rank
_PLACE = (1 << 32) - 1
_NO_RANK = 1 << 30      # the same for ranks alone
WIDTHS = (8, 16, 32, 64)    # bytes of pre-tokens that are merged together; longer ones are merged with a heap
ROWS = 1 << 13          # pre-tokens merged together


class Merger:
    """Merges of single bytes: of all neighbours the pair of lowest rank, leftmost
    first, until no pair is in the vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np
        self.byte = [ranks[bytes((a,))] for a in range(256)]
        self.rank = {t: r << 32 for t, r in ranks.items()}
        self.of_two = [self.rank.get(bytes((a, b)), _NONE) for a in range(256) for b in range(256)]
        # every way to make a token of two, as left * size + right
        self.size = max(ranks.values()) + 1
        ways = {-1: _NO_RANK}
        for t, r in ranks.items():
            for k in range(1, len(t)):
                a, b = ranks.get(t[:k]), ranks.get(t[k:])
                if a is not None and b is not None:
                    ways[a * self.size + b] = r
        self.pair = np.array(sorted(ways), np.int64)
        self.pair_rank = np.array([ways[x] for x in self.pair.tolist()], np.int32)
        self.byte_ids = np.array(self.byte, np.int32)

    def _ranks(self, left, right):
        """Rank of each ``left`` token with the ``right`` one (_NO_RANK: not in the vocabulary)."""
        import numpy as np
        sought = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair, sought), len(self.pair) - 1)
        return np.where(self.pair[at] == sought, self.pair_rank[at], np.int32(_NO_RANK))

    def all_of(self, pieces: list[bytes]):
        """(ids of all ``pieces`` in turn, number of ids of each)."""
        import numpy as np
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        done = []       # (places of pieces, their ids, numbers of ids)
        for low, high in zip((0, *WIDTHS), WIDTHS, strict=False):
            of = np.flatnonzero((size > low) & (size <= high))
            done += [(part, *self._rounds([pieces[i] for i in part], size[part], high))
                     for part in (of[k:k + ROWS] for k in range(0, len(of), ROWS))]
        for i in np.flatnonzero(size > WIDTHS[-1]).tolist():
            ids = np.array(self(pieces[i]), np.int32)
            done.append((np.array([i]), ids, np.array([len(ids)])))
        counts = np.zeros(len(pieces), np.int64)
        for at, _, n in done:
            counts[at] = n
        begin = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for at, ids, n in done:
            out[np.arange(len(ids)) + np.repeat(begin[at] - (np.cumsum(n) - n), n)] = ids
        return out, counts

    def _rounds(self, pieces: list[bytes], size, width: int):
        """``all_of`` for pieces of at most ``width`` bytes: a row for each piece, a column for
        the place of a part's first byte. A round makes the best merge of every row."""
        import numpy as np
        rows = np.arange(len(pieces))
        places = np.arange(width + 1, dtype=np.int16)
        alive = places[:-1] < size[:, None]
        token = np.zeros((len(pieces), width), np.int32)
        token[alive] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        want = np.full((len(pieces), width), _NO_RANK, np.int32)
        paired = alive[:, 1:]
        want[:, :-1][paired] = self._ranks(token[:, :-1][paired], token[:, 1:][paired])
        after, before = np.tile(places + 1, (len(pieces), 1)), np.tile(places - 1, (len(pieces), 1))
        while True:
            i = want[rows].argmin(1)            # the first of equal ones: leftmost
            rank = want[rows, i]
            go = rank < _NO_RANK
            rows, i, rank = rows[go], i[go], rank[go]
            if not len(rows):
                break
            j = after[rows, i]
            stop = after[rows, j]
            token[rows, i] = rank
            alive[rows, j] = False
            want[rows, i] = want[rows, j] = _NO_RANK
            after[rows, i] = stop
            before[rows, stop] = i
            has = stop < size[rows]
            r, k = rows[has], i[has]
            want[r, k] = self._ranks(rank[has], token[r, stop[has]])
            k = before[rows, i]
            has = k >= 0
            r, k = rows[has], k[has]
            want[r, k] = self._ranks(token[r, k], rank[has])
        return token[alive], alive.sum(1)

    def __call__(self, piece: bytes) -> list[int]:
        """The ids of ``piece``. A part is known by the place of its first byte; the
        heap holds rank (upper bits) and place as one number, and an entry counts
        while it is what ``want`` has for its place."""
        n = len(piece)
        of_two = self.of_two
        want = [of_two[a << 8 | b] | i for i, (a, b) in enumerate(zip(piece, piece[1:], strict=False))]
        heap = [x for x in want if x < _NONE]
        if not heap:
            return [self.byte[a] for a in piece]
        heapq.heapify(heap)
        want.append(_NONE)
        token = [self.byte[a] for a in piece]
        after = list(range(1, n + 1))
        before = list(range(-1, n))
        rank, pop, push = self.rank.get, heapq.heappop, heapq.heappush
        while heap:
            x = pop(heap)
            i = x & _PLACE
            if want[i] != x:
                continue
            j = after[i]
            stop = after[i] = after[j]
            token[i] = x >> 32
            want[j] = want[i] = _NONE
            before[stop] = i
            if stop < n:
                r = rank(piece[i:after[stop]])
                if r is not None:
                    want[i] = r = r | i
                    push(heap, r)
            k = before[i]
            if k >= 0:
                r = rank(piece[k:stop])
                if r is None:
                    want[k] = _NONE
                else:
                    want[k] = r = r | k
                    push(heap, r)
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out


class ByteBPE:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, path: str, pattern: str):
        import numpy as np
        import pyarrow as pa
        import regex
        with open(path, "rb") as f:
            lines = [x.split() for x in f if x.strip()]
        self.ranks = {base64.b64decode(t): int(r) for t, r in lines}
        tokens = list(self.ranks)
        self.hash = PerfectHash(tokens)
        self.slots: list[bytes] = [b""] * len(tokens)
        for t, p in zip(tokens, self.hash.places(tokens).tolist(), strict=True):
            self.slots[p] = t
        self.slot_ids = np.array([self.ranks[t] for t in self.slots], np.int64)
        by_id = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            by_id[r] = t
        self.tokens = pa.array(by_id, pa.large_binary())
        self.merge = Merger(self.ranks)
        self.split = regex.compile(pattern).findall
        self._empty()

    def _empty(self) -> None:
        self.number: dict[str, int] = {}                # pre-token -> its number
        self.flat, self.start = array("i"), array("q", [0])

    def _learn(self, pieces: set[str]) -> None:
        if len(self.number) > STORE:
            self._empty()
        import numpy as np
        new = list(pieces.difference(self.number))
        raw = [p.encode() for p in new]
        place = self.hash.places(raw)
        slots = self.slots
        whole = np.fromiter((at >= 0 and slots[at] == b for b, at in zip(raw, place.tolist(), strict=True)), bool, len(raw))
        counts = np.ones(len(raw), np.int64)
        ids, counts[~whole] = self.merge.all_of([b for b, w in zip(raw, whole.tolist(), strict=True) if not w])
        stop = np.cumsum(counts)
        flat = np.empty(int(counts.sum()), np.int32)
        single = np.repeat(whole, counts)
        flat[single] = self.slot_ids[place[whole]]
        flat[~single] = ids
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.start.frombytes((stop + len(self.flat)).tobytes())
        self.flat.frombytes(flat.tobytes())

    def encode_many(self, texts: list[str]):
        """(ids of all texts in turn, number of ids of each text)."""
        import numpy as np
        cut = [self.split(t) for t in texts]
        self._learn(set(chain.from_iterable(cut)))
        counts = np.array([len(c) for c in cut], np.int64)
        number = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, int(counts.sum()))
        start = np.array(self.start, np.int64)
        n = (start[1:] - start[:-1])[number]
        stop = np.cumsum(n)
        ids = np.array(self.flat, np.int32)[np.arange(int(n.sum())) + np.repeat(start[number] - (stop - n), n)]
        ends = np.concatenate([np.zeros(1, np.int64), stop])[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0)

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode_many(self, lists):
        """The bytes of every list of ids (Arrow lists of int32): tokens are taken from
        the vocabulary in turn, so a document's bytes stand next to each other."""
        import numpy as np
        import pyarrow as pa
        offsets = lists.offsets.to_numpy().astype(np.int64)
        taken = self.tokens.take(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 0) if len(taken) else np.zeros(1, np.int64)
        at = ends[offsets - offsets[0]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists),
                                                [None, pa.py_buffer(at.tobytes()), taken.buffers()[2]])

    def decode(self, ids: Iterable[int]) -> bytes:
        import pyarrow as pa
        return self.decode_many(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()


@lru_cache(2)
def tokenizer(path: str, pattern: str) -> ByteBPE:
    """One for each Python worker."""
    return ByteBPE(path, pattern)


def _pieces(texts: Iterable[bytes], size: int = PIECE) -> Iterable[list[str]]:
    """Texts in groups of about ``size`` characters (at least one whole text)."""
    group, held = [], 0
    for t in texts:
        group.append(t.decode())
        held += len(t)
        if held >= size:
            yield group
            group, held = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs``."""
    def batches(it):
        import numpy as np
        import pyarrow as pa
        bpe = tokenizer(path, pattern)
        for b in it:
            at = 0
            for group in _pieces(utf8_rows(b.column(1))):
                flat, n = bpe.encode_many(group)
                offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(group)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "ids"])
                at += len(group)
    return rows_of(docs).mapInArrow(batches, "doc_id bigint, ids array<int>")


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded binary) for every row of ``coded`` (doc_id, ids)."""
    def batches(it):
        import pyarrow as pa
        bpe = tokenizer(path, pattern)
        for b in it:
            lists = b.column(1).fill_null([]) if b.column(1).null_count else b.column(1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), bpe.decode_many(lists).cast(pa.binary())],
                                             names=["doc_id", "ids", "decoded"])
    return coded.select("doc_id", "ids").mapInArrow(batches, "doc_id bigint, ids array<int>, decoded binary")


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the vocabulary the registered query uses."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, ids, n_tokens, ids_sha256, decoded_sha256): encoded, then decoded from the ids."""
    path, pattern = vocabulary()
    both = decode(encode(docs, path, pattern), path, pattern)
    return both.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents")).drop("ids")
