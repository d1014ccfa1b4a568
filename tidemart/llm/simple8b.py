"""Token ids in files of Simple-8b words.

A word of 64 bits holds a selector (4 bits) and as many equal-width values as
fit 60 bits: 240 or 120 zeros, 60 of 1 bit, ... one of 60 bits. Values are
small because a file first lists its most frequent ids: a listed id is coded
by its place in the list, any other is an escape, coded as the length of the
list plus the id. Words are filled greedily within blocks of 1,024 ids, and
the file has the first word of every block, so a reader can start at any block
and decodes all blocks at once, selector by selector, with numpy.

File, little-endian: magic ``TS8B0001``; u64 counts of documents, ids, blocks,
words and listed ids; u8 per document: has an id; i64 per document: doc_id; u64
per document: ids; u64 per block: its first word; u32 listed ids; u64 words;
u32 CRC-32 of all before. A file holds whole documents in ascending order.

Documents are dealt to tasks by ranges of doc_id (of doc_id and a hash of the
text, so a repeated doc_id can be split) and sorted; each task encodes its own
and writes files of about FILE_IDS ids under names that a repeated attempt
reproduces, each moved into place whole. The first id of each file follows
from the files' own counts (a window over one row per file).

Defined cases: null text counts as empty; an empty text has the end id only; a
null doc_id comes first; rows with one doc_id are ordered by text; an empty
table gives no files and no rows; extra columns are not looked at. In the
registered query an added token's string in a text is that token's id, as the
library's plain call has it."""

from __future__ import annotations

import math
import re
import struct
import zlib
from array import array
from functools import lru_cache

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import open_file, put_file, rows_of, scratch, stored, table

COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)     # fixed values of the coding
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
MAGIC = b"TS8B0001"
BLOCK = 1024
BLOCKS = 128            # coded together
LISTED = 4096           # most ids that a file lists
FILE_IDS = 1 << 21
END_ID = 1
READ_BYTES = 1 << 24    # of files read by a task, about
STORE = 1 << 19         # pre-tokens held by an encoder
LEARNT = 1 << 13        # pre-tokens that the library gets at once; it needs over a kilobyte for each
GROUP = 1 << 22         # bytes of texts that are encoded together, about
# texts with other characters are the library's; U+0130 becomes two when lower-cased
_ODD = "[^\t\n\r -~\u00a1-\u012f\u0131-\u02ff\u0388-\u0482\u048a-\u052f]"
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"     # the tokenizer's own pattern
# the character that stands for a byte in the vocabulary: itself if it is visible, or one of those from U+0100
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + k for k, b in enumerate(sorted({*range(256)}.difference(_SEEN))) if b != 32}
_ROW = BLOCK + COUNTS[0]


def pack(values):
    """uint64 values below 2^60 as Simple-8b words: (words, first word of each block)."""
    import numpy as np
    if len(values) and values.max() >= 1 << 60:
        raise ValueError("a value does not fit 60 bits")
    words, first, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    for k in range(0, len(values), BLOCKS * BLOCK):
        w, f = _pack(values[k:k + BLOCKS * BLOCK])
        words.append(w)
        first.append(f + np.uint64(held))
        held += len(w)
    return np.concatenate(words), np.concatenate(first)


def _pack(values):
    """``pack`` of some blocks: what it needs besides is many times their size."""
    import numpy as np
    n = len(values)
    blocks = -(-n // BLOCK)
    rows = np.zeros((blocks, _ROW), np.uint64)
    whole = np.zeros(blocks * BLOCK, np.uint64)
    whole[:n] = values
    rows[:, :BLOCK] = whole.reshape(blocks, BLOCK)
    low, high = rows & np.uint64((1 << 30) - 1), rows >> np.uint64(30)
    bits = np.frexp(high.astype(np.float64))[1]         # exact below 2^53
    width = np.where(bits > 0, bits + 30, np.frexp(low.astype(np.float64))[1]).astype(np.uint8)
    # the selector at each place: the most values of which the widest fits
    most = {1: width}                                   # widest of the next 1, 2, 4, ... values
    while 2 * max(most) <= COUNTS[0]:
        p = max(most)
        wide = most[p].copy()
        np.maximum(wide[:, :-p], most[p][:, p:], out=wide[:, :-p])
        most[2 * p] = wide
    best = np.full((blocks, BLOCK), len(COUNTS) - 1, np.uint8)
    for sel in range(len(COUNTS) - 2, -1, -1):
        c = COUNTS[sel]
        p = 1 << (c.bit_length() - 1)
        widest = np.maximum(most[p][:, :BLOCK], most[p][:, c - p:c - p + BLOCK])
        best[widest <= WIDTHS[sel]] = sel
    # greedy, one word of every block at a time
    count = np.array(COUNTS, np.int64)
    length = np.minimum(BLOCK, n - BLOCK * np.arange(blocks, dtype=np.int64))
    at, open_ = np.zeros(blocks, np.int64), np.arange(blocks)
    taken = []
    while len(open_):
        sel = best[open_, at[open_]]
        taken.append((open_, at[open_], sel))
        at[open_] += count[sel]
        open_ = open_[at[open_] < length[open_]]
    row, place, sel = (np.concatenate(x) for x in zip(*taken, strict=True))
    order = np.argsort(row, kind="stable")
    row, place, sel = row[order], place[order], sel[order]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        if w and (k := np.flatnonzero(sel == s)).size:
            part = rows[row[k][:, None], place[k][:, None] + np.arange(c)]
            words[k] |= np.bitwise_or.reduce(part << (np.uint64(w) * np.arange(c, dtype=np.uint64)), axis=1)
    return words, np.searchsorted(row, np.arange(blocks)).astype(np.uint64)


def unpack(words, first, n: int):
    """The values of whole blocks; ``first`` is the first word of each, ``n`` the number of values."""
    import numpy as np
    if not n:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = np.array(COUNTS, np.int64)[sel]
    start = np.cumsum(count) - count
    first = first.astype(np.int64)
    row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    place = row * _ROW + start - start[first][row]
    out = np.zeros(len(first) * _ROW, np.uint64)        # a block's last word may reach past its end
    for s, (c, w) in enumerate(zip(COUNTS, WIDTHS, strict=True)):
        if w and (k := np.flatnonzero(sel == s)).size:
            shift = np.uint64(w) * np.arange(c, dtype=np.uint64)
            out[place[k][:, None] + np.arange(c)] = (words[k][:, None] >> shift) & np.uint64((1 << w) - 1)
    return out.reshape(-1, _ROW)[:, :BLOCK].reshape(-1)[:n]


def to_file(doc_ids: list[int | None], lengths: list[int], ids) -> bytes:
    """The bytes of one file; ``ids`` (uint32) are those of all documents in turn."""
    import numpy as np
    if len(ids) and ids.max() < 1 << 22:                # a count for every id that may occur
        at, times = ids, np.bincount(ids)
        known = np.arange(len(times))
    else:
        known, at, times = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((known, -times))[:LISTED]        # most frequent first
    order = order[times[order] > 0]
    code = known.astype(np.uint64) + np.uint64(len(order))
    code[order] = np.arange(len(order), dtype=np.uint64)
    words, first = pack(code[at] if len(ids) else np.zeros(0, np.uint64))
    body = b"".join([
        MAGIC, struct.pack("<5Q", len(doc_ids), len(ids), len(first), len(words), len(order)),
        np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(), np.array(lengths, "<u8").tobytes(),
        first.astype("<u8").tobytes(), known[order].astype("<u4").tobytes(), words.astype("<u8").tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


class TokenFile:
    """A file's documents and ids; ``ids(a, b)`` decodes only the blocks it needs."""

    def __init__(self, data: bytes):
        import numpy as np
        if data[:8] != MAGIC or zlib.crc32(memoryview(data)[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("not a whole token file")
        n, self.n_ids, blocks, words, listed = struct.unpack("<5Q", data[8:48])
        at = 48

        def take(kind, k):
            nonlocal at
            out = np.frombuffer(data, kind, k, at)
            at += out.nbytes
            return out
        has = take(np.uint8, n)
        ids = take("<i8", n)
        self.doc_ids = [int(i) if h else None for h, i in zip(has, ids, strict=True)]
        self.lengths = take("<u8", n).astype(np.int64)
        self.first, self.listed, self.words = take("<u8", blocks), take("<u4", listed), take("<u8", words)

    def ids(self, start: int = 0, stop: int | None = None):
        import numpy as np
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        low = int(self.first[a])
        high = int(self.first[b]) if b < len(self.first) else len(self.words)
        code = unpack(self.words[low:high], self.first[a:b] - np.uint64(low), min(b * BLOCK, self.n_ids) - a * BLOCK)
        listed = code < np.uint64(len(self.listed))
        out = np.empty(len(code), np.uint32)
        out[listed] = self.listed[code[listed].astype(np.int64)]
        out[~listed] = (code[~listed] - np.uint64(len(self.listed))).astype(np.uint32)
        return out[start - a * BLOCK:stop - a * BLOCK]


def _in_turn(flat, start, number):
    """The runs of ``flat`` with these numbers one after another, and where each ends;
    run k is flat[start[k]:start[k + 1]]."""
    import numpy as np
    n = (start[1:] - start[:-1])[number]
    stop = np.cumsum(n)
    at = np.arange(int(stop[-1]) if len(stop) else 0)
    at += np.repeat(start[number] - (stop - n), n)
    return flat[at], stop


class TextEncoder:
    """The ids of texts by the tokenizers library, its model applied once to each
    pre-token that recurs.

    No pre-token reaches over white space, so the ids of a text are those of its
    words in turn. Texts of printable ASCII, line ends and the composed letters of
    Latin, Greek and Cyrillic are split here (their normal form is what they are);
    the different words of a group of texts are lower-cased and cut into
    pre-tokens by Arrow's kernels, and the different pre-tokens are looked up. New
    ones go to the library together, by its model alone: every pre-token ends with
    the one id that closes a word. Any other text goes through the library whole.
    Ids are kept in one flat array, a pre-token being a number that leads into it.
    The store is emptied when full.

    ``added_tokens``: the string of an added token in a text becomes its one id,
    as the library does by default (such a text goes through it whole);
    otherwise it is ordinary text."""

    def __init__(self, path: str, end_id: int = END_ID, added_tokens: bool = False):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        import numpy as np
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith(self.tokenizer.model.end_of_word_suffix)]] = True
        self.tokenizer.encode_special_tokens = not added_tokens
        added = self.tokenizer.get_added_tokens_decoder().values()
        # normalized ones are sought in the lower-cased text
        self.added = "|".join(re.escape(t.content) for t in added if added_tokens or not t.special)
        if self.added and any(t.normalized for t in added):
            self.added = f"(?i:{self.added})"
        self.end_id = end_id
        self._empty()

    def _empty(self) -> None:
        self.number = {"": 0}                           # pre-token -> its number
        self.flat, self.start = array("I"), array("q", [0, 0])

    def _learn(self, pieces: list[str]) -> None:
        """Puts the ids of pre-tokens in the store."""
        import numpy as np
        for k in range(LEARNT, len(pieces), LEARNT):
            self._learn(pieces[k:k + LEARNT])
        pieces = pieces[:LEARNT]
        seen = " ".join(pieces).encode().decode("latin-1").translate(_BYTES)
        ids = np.array(self.model.encode_batch_fast([seen], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("a pre-token is not closed by one id")
        self.number.update(zip(pieces, range(len(self.number), len(self.number) + len(pieces)), strict=True))
        self.start.frombytes((ends + len(self.flat)).astype(np.int64).tobytes())
        self.flat.frombytes(ids.tobytes())

    def _words(self, words):
        """The ids of different words in one array, and where each word begins."""
        import numpy as np
        import pyarrow.compute as pc
        words = pc.utf8_lower(words)
        mixed = pc.invert(pc.utf8_is_alpha(words))      # words of letters are one pre-token
        words = pc.replace_with_mask(words, mixed, pc.replace_substring_regex(words.filter(mixed), _CUT, r" \0"))
        cut = pc.utf8_split_whitespace(words)
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if new := [p for p in pieces if p not in self.number]:
            self._learn(new)
        known = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        ids, stop = _in_turn(np.array(self.flat, np.uint32), np.array(self.start, np.int64), known[coded.indices.to_numpy()])
        offsets = cut.offsets.to_numpy()
        return ids, np.append(0, stop)[offsets - offsets[0]]

    def encode(self, texts) -> list:
        """An array of ids for each text (a list, or a string array of Arrow), the end id
        after its own."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(self.number) > STORE:
            self._empty()
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _ODD)
        if self.added:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.added))
        words = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        coded = words.flatten().dictionary_encode()
        flat, start = self._words(coded.dictionary)
        ends = words.offsets.to_numpy()[1:] - words.offsets[0].as_py()
        # one more word, after those of each text: the end id
        number = np.insert(coded.indices.to_numpy(), ends, len(coded.dictionary))
        ids, stop = _in_turn(np.append(flat, np.uint32(self.end_id)), np.append(start, len(flat) + 1), number)
        out = np.split(ids, stop[ends + np.arange(len(texts))][:-1])
        for k in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            whole = self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
            out[k] = np.array([*whole, self.end_id], np.uint32)
        return out


@lru_cache(2)
def encoder_of(path: str, end_id: int, added_tokens: bool) -> TextEncoder:
    """One for each Python worker."""
    return TextEncoder(path, end_id, added_tokens)


def write_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID,
                file_ids: int = FILE_IDS, added_tokens: bool = False) -> DataFrame:
    """Writes ``docs`` as token files in ``folder``; one row per file: part, file
    (their order is that of doc_id), name, n_docs, n_ids, n_bytes, start (ids in
    all files before). ``added_tokens`` as for TextEncoder."""
    def batches(it):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        encoder = encoder_of(tokenizer_path, end_id, added_tokens)
        part, made = TaskContext.get().partitionId(), 0
        doc_ids, ids, held = [], [], 0

        def flush():
            nonlocal doc_ids, ids, held, made
            name = f"part-{part:06d}-{made:05d}.s8b"
            data = to_file(doc_ids, [len(x) for x in ids], np.concatenate(ids))
            put_file(folder, name, data)
            row = pa.RecordBatch.from_pylist([{"part": part, "file": made, "name": name, "n_docs": len(doc_ids),
                                               "n_ids": held, "n_bytes": len(data)}], schema=shape)
            doc_ids, ids, held, made = [], [], 0, made + 1
            pa.default_memory_pool().release_unused()
            return row
        shape = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("name", pa.string()),
                           ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
        for b in it:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // GROUP)) + 1), len(b)]
            for low, high in zip(cuts, cuts[1:], strict=False):
                keys = b.column(0).slice(low, high - low).to_pylist()
                for i, x in zip(keys, encoder.encode(b.column(1).slice(low, high - low)), strict=True):
                    doc_ids.append(i)
                    ids.append(x)
                    held += len(x)
                    if held >= file_ids:
                        yield flush()
        if doc_ids:
            yield flush()
    rows = rows_of(docs).withColumn("h", F.xxhash64("text"))
    dealt = (rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
             .select("doc_id", "text"))
    files = stored(dealt.mapInArrow(batches, "part int, file int, name string, n_docs bigint, n_ids bigint, "
                                             "n_bytes bigint"), "token-files")
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary) from token files: ``ids`` are unsigned
    32-bit little-endian."""
    def batches(it):
        import numpy as np
        import pyarrow as pa
        for b in it:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with open_file(folder, name) as data:
                    f = TokenFile(data.read())
                ids = f.ids().astype("<u4", copy=False)
                ends = np.cumsum(f.lengths)
                for k in range(0, len(ends), 512):
                    stop = ends[k:k + 512]
                    begin = stop - f.lengths[k:k + 512]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f.doc_ids[k:k + 512], pa.int64()), pa.array(begin + start),
                         pa.array(stop - begin),
                         pa.array([ids[a:z].tobytes() for a, z in zip(begin, stop, strict=True)], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
    sums = files.agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("bytes")).first()
    tasks = max(1, min(sums["n"], 3 * files.sparkSession.sparkContext.defaultParallelism),
                math.ceil((sums["bytes"] or 0) / READ_BYTES))
    spread = files.select("name", "start").repartition(tasks)
    return spread.mapInArrow(batches, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op2_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = scratch(spark, "tokens")
    files = write_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder,
                        added_tokens=True)
    return read_files(files, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
