import os
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import simple8b as S
from tidemart.llm.common import scratch

PATH = P.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60).flatmap(lambda b: st.integers(0, (1 << b) - 1 if b else 0)), max_size=700),
       st.integers(0, 5))
def test_words_round_trip(values, repeat):
    v = np.array(values * (1 + repeat), np.uint64)
    words, first = S.pack(v)
    assert (S.unpack(words, first, len(v)) == v).all()


def test_words_are_dense():
    words, _ = S.pack(np.zeros(1024, np.uint64))
    assert len(words) == 5      # 4 words of 240 zeros and one more
    words, _ = S.pack(np.ones(1024, np.uint64))
    assert len(words) == 18     # 60 to a word
    with pytest.raises(ValueError):
        S.pack(np.array([1 << 60], np.uint64))


def test_file_round_trip_and_random_access():
    rnd = np.random.default_rng(0)
    lengths = [0, 5, 3000, 1, 10_000]
    ids = np.concatenate([rnd.zipf(1.3, 13_000) % 60_000, [2**32 - 1, 0, 2**31, 5, 5, 5]]).astype(np.uint32)
    data = S.to_file([None, -5, 7, 7, 2**62], lengths, ids)
    f = S.TokenFile(data)
    assert f.doc_ids == [None, -5, 7, 7, 2**62] and f.lengths.tolist() == lengths
    assert (f.ids() == ids).all()
    for a, b in ((0, 1), (1023, 1025), (5000, 5000), (12_000, 99_999), (2048, 3072)):
        assert (f.ids(a, b) == ids[a:b]).all()
    with pytest.raises(ValueError):
        S.TokenFile(data[:100] + b"?" + data[101:])
    assert S.TokenFile(S.to_file([], [], np.zeros(0, np.uint32))).ids().size == 0


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=50) | st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=0x530), max_size=30) | st.text(alphabet="Ab 's\n\r\t\x1c\x85\xa0́　éİK1２!", max_size=50))
def test_encodes_like_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert _enc.encode([text, "a " + text])[0].tolist() == [*_whole.encode(text, add_special_tokens=False).ids, 1]


_enc = S.TextEncoder(PATH)
_whole = Tokenizer.from_file(PATH)
_whole.encode_special_tokens = True


def brute(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*_whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_give_the_documents_back(spark):
    rows = [(i * 7 % 101, f"Document number {i}, some words, <|endoftext|> é {'la ' * (i % 50)}") for i in range(101)]
    rows += [(200, None), (201, ""), (None, "no id"), (300, "very long " * 60_000)]
    folder = scratch(spark, "t-tokens")
    files = S.write_files(odd_columns(docs(spark, rows)), PATH, folder, file_ids=500)
    assert files.count() > 5 and {r.name for r in files.collect()} == set(os.listdir(folder.removeprefix("file://")))
    got = S.read_files(files, folder).collect()
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got), key=lambda r: r[1]) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "same"), (5, "same"), (5, "other words"), (1, "a")]
    folder = scratch(spark, "t-tokens")
    got = sorted(tuple(r) for r in S.read_files(S.write_files(docs(spark, rows), PATH, folder), folder)
                 .select("start", "doc_id", "n_tokens").collect())
    assert [g[1] for g in got] == [1, 5, 5, 5]
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1]]
    folder = scratch(spark, "t-tokens")
    assert S.read_files(S.write_files(docs(spark, []), PATH, folder), folder).count() == 0


_plain = Tokenizer.from_file(PATH)      # the library's own settings


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", " ", "\n", "see",
                                 "Here", "é", "\u0301", "１", "'s"]), max_size=8))
def test_added_tokens_like_the_plain_library(parts):
    text = "".join(parts)
    assert _added.encode([text, "a"])[0].tolist() == [*_plain.encode(text, add_special_tokens=False).ids, 1]


_added = S.TextEncoder(PATH, added_tokens=True)


def test_registered_query_has_ids_of_added_tokens(spark, tmp_path):
    rows = [(1, "see <|endoftext|> here"), (2, "<|startoftext|>a"), (3, "plain words"), (4, "<|ENDOFTEXT|>")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want, start = [], 0
    for i, t in rows:
        ids = np.array([*_plain.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in S.op2_simple8b(spark, str(tmp_path)).collect()) == want
