import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import docs, odd_columns
from tidemart.llm import byte_bpe as B

PATH, PATTERN = B.vocabulary()


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    return B.ByteBPE(PATH, PATTERN)


def test_perfect_hash_is_minimal():
    keys = [f"k{i}".encode() for i in range(5000)] + [b""]
    h = B.PerfectHash(keys)
    assert sorted(h.places(keys).tolist()) == list(range(len(keys)))
    assert all(-1 <= p < len(keys) for p in h.places([b"x", b"stranger"]).tolist())
    with pytest.raises(ValueError):
        B.PerfectHash([b"a", b"a"])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab 'srevtl\n\t\x1c\xa0é1２!?", max_size=60))
def test_encodes_like_the_library(reference, bpe, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = bpe.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_long_and_odd_texts(reference, bpe):
    rnd = random.Random(3)
    for t in ["", " " * 5000, "a" * 20_000, "\n" * 100, "<|endoftext|>", "".join(chr(rnd.randrange(32, 0x3000)) for _ in range(20_000)),
              "".join(rnd.choice("abcdefghij") for _ in range(20_000)), "日本語のテキスト" * 200, "🙂" * 300]:
        assert bpe.encode(t) == reference.encode_ordinary(t)
        assert bpe.decode(bpe.encode(t)) == t.encode()


def test_store_is_emptied(reference, bpe, monkeypatch):
    monkeypatch.setattr(B, "STORE", 5)
    for k in range(40):
        t = f"word{k % 7} and number {k} again word{k % 3}"
        assert bpe.encode(t) == reference.encode_ordinary(t)


def test_decodes_sliced_lists(bpe):
    import pyarrow as pa
    texts = ["one two", "", "é!", "three"]
    lists = pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))
    assert [x.as_py() for x in bpe.decode_many(lists.slice(1, 3))] == [t.encode() for t in texts[1:]]
    assert len(bpe.decode_many(lists.slice(0, 0))) == 0
    assert bpe.decode_many(lists.slice(1, 1))[0].as_py() == b""


def test_query_columns(spark, reference):
    rows = [(1, "Hello world, hello"), (2, None), (3, ""), (4, "x" * 400_000), (1, "Hello world, hello"), (None, "é è")]
    got = sorted((tuple(r) for r in B.round_trip(odd_columns(docs(spark, rows))).drop("ids").collect()), key=repr)
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert B.round_trip(docs(spark, [])).count() == 0


def test_merges_of_many_pieces_are_those_of_each(reference, bpe, monkeypatch):
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"abcdeinorst \n\xc3\xa9\xff") for _ in range(n)) for n in [*range(1, 80), 500] for _ in range(6)]
    rnd.shuffle(pieces)
    monkeypatch.setattr(B, "ROWS", 7)
    ids, n = bpe.merge.all_of(pieces)
    want = [bpe.merge(p) for p in pieces]       # one by one, with the heap
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert [bpe.decode(w) for w in want] == pieces
    assert [len(x) for x in bpe.merge.all_of([])] == [0, 0]


def test_vocabulary_of_bytes_alone_merges_nothing():
    ids, n = B.Merger({bytes((a,)): a for a in range(256)}).all_of([b"abc", b"", b"z" * 100])
    assert (ids.tolist(), n.tolist()) == ([97, 98, 99] + [122] * 100, [3, 0, 100])
