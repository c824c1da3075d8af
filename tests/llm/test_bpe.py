"""BPE: exact agreement with the tokenizers library, chunk repair, round trip."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stardw.llm import bpe

PATH = bpe.default_vocabulary()


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def chunked(text: str, cuts: list[int] | None = None) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    offs = np.array([0, len(raw)])
    store = bpe.ChunkStore(bpe.codec(PATH))
    cuts = bpe.chunk_cuts(raw, offs)[0] if cuts is None else cuts
    return bpe.encode_chunks(raw.tobytes(), cuts, bpe._joints(raw), store)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'slé\n\t  　#1ß<|endoftext|>½语")), max_size=120), st.data())
def test_any_cuts_agree(text, data):
    raw = text.encode()
    inside = [k for k in range(1, len(raw)) if raw[k] & 0xC0 != 0x80]
    cuts = sorted(data.draw(st.sets(st.sampled_from(inside), max_size=8))) if inside else []
    want = Tokenizer.from_file(PATH) if not hasattr(test_any_cuts_agree, "t") else test_any_cuts_agree.t
    test_any_cuts_agree.t = want
    assert chunked(text, [0, *cuts]).tolist() == want.encode(text, add_special_tokens=False).ids


def test_long_and_odd_texts(reference):
    rnd = random.Random(5)
    words = ["don't", "we'll", "<|endoftext|>", "  ", "\n\n", "naïve", "x" * 50, "12345", "..."] + ["w%d" % k for k in range(200)]
    texts = [" ".join(rnd.choices(words, k=3000)), "a" * 40000, " " * 30000, "é" * 20000, "", "'", "\n" * 9000,
             "".join(rnd.choices(words, k=4000)), " a" * 20000]
    for t in texts:
        assert chunked(t).tolist() == reference.encode(t, add_special_tokens=False).ids
        assert bpe.codec(PATH).decode(chunked(t)).decode() == t == reference.decode(chunked(t).tolist(), skip_special_tokens=False)


def test_query_shape(spark, reference):
    rows = [(1, "Hello world"), (2, None), (3, ""), (None, "Hello world"), (1, "Hello world"), (4, "<|endoftext|> x " * 900)]
    docs = spark.createDataFrame([(i, t, "z", 0) for i, t in rows], "doc_id long, text string, route string, ids int")
    got = bpe.bpe_decode(bpe.bpe_encode(docs)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.decoded) for r in got), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    for r in got:
        ids = reference.encode(r.decoded, add_special_tokens=False).ids
        assert (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (len(ids), ids)
    assert bpe.bpe_encode(docs.limit(0)).count() == 0


def test_chunks_are_reused():
    passage = " ".join(f"word{k * 7919 % 1000}" for k in range(3000))
    raw = np.frombuffer((passage + " tail one").encode() + ("Another start " + passage).encode(), np.uint8)
    n = len((passage + " tail one").encode())
    offs, store = np.array([0, n, len(raw)]), bpe.ChunkStore(bpe.codec(PATH))
    for r, cuts in enumerate(bpe.chunk_cuts(raw, offs)):
        a, b = offs[r], offs[r + 1]
        bpe.encode_chunks(raw[a:b].tobytes(), [c - a for c in cuts], bpe._joints(raw[a:b]), store)
    assert store.reused > 0.4 * (store.encoded + store.reused)
