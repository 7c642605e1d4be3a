import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from camstat.llm import queries, tokenfiles
from tests.llm.helpers import BYTE_BPE, SF, docs


@pytest.mark.parametrize("bits, block", [(1, 8), (13, 5), (16, 4096), (17, 4096), (20, 64), (32, 3)])
def test_file_round_trip(bits, block):
    rng = np.random.default_rng(bits)
    own = [rng.integers(0, 1 << bits, n, dtype=np.uint64).astype("<u4") for n in (0, 1, 7, 0, 5000, 300_000, 3)]
    f = io.BytesIO()
    w = tokenfiles.Writer(f, bits, block)
    for k, ids in enumerate(own):
        w.add(k - 3, ids)
    w.close()
    r = tokenfiles.Reader(f)
    assert r.keys.tolist() == [k - 3 for k in range(7)]
    for k, ids in enumerate(own):
        assert (r.document(k) == ids).all()
    whole = np.concatenate(own)
    for a, b in ((0, 0), (0, len(whole)), (17, 18), (4090, 9000), (len(whole) - 1, len(whole))):
        assert (r.ids(a, b) == whole[a:b]).all()
    assert f.getbuffer().nbytes < len(whole) * bits / 8 + len(whole) / block * 9 + 400


def test_width():
    assert [tokenfiles.width(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def test_broken_file():
    with pytest.raises(ValueError):
        tokenfiles.Reader(io.BytesIO(b"x" * 100))


@pytest.fixture(scope="module")
def own():
    with open(BYTE_BPE, encoding="utf-8") as f:
        return tokenfiles.ByteLevel(f.read())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ae  \n\t'1é　\xa0\x0b")), max_size=50))
def test_any_text(own, text):
    assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids


class Counting:
    def __init__(self, model):
        self.model, self.words = model, []

    def tokenize(self, word):
        self.words.append(word)
        return self.model.tokenize(word)


def test_library_sees_a_new_word_once():
    """Whatever stands around it: marks, line ends, a start of another text."""
    with open(BYTE_BPE, encoding="utf-8") as f:
        own = tokenfiles.ByteLevel(f.read())
    own.model = counting = Counting(own.model)
    for text in ("a bordeonly, a bordeonly. a bordeonly\nthe end", "a bordeonly a bordeonly! the end\nthe end 12 bordeonly\n\na bordeonly"):
        assert np.frombuffer(own.encode(text.encode()), "<u4").tolist() == own.library.encode(text, add_special_tokens=False).ids
    assert sorted(counting.words) == sorted(set(counting.words))


TEXTS = st.text(alphabet=st.one_of(
    st.sampled_from("aestlvrmdAZ09  \n\n\t\r''.,!#_-éßÀÿžĀſ×÷«»²ªµ“”—中é\u0301😀\x0b\x85\xa0\x00\x7f"), st.characters(codec="utf-8")), max_size=40)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS, st.just("x<|endoftext|> y")), max_size=8), st.integers(1, 60))
def test_texts_cut_together(own, texts, chunk):
    """Several texts in chunks of any size, longer texts cut on the way."""
    was, tokenfiles.CHUNK = tokenfiles.CHUNK, chunk
    try:
        got = [ids.tolist() for ids in own.encode_all([None if t is None else t.encode() for t in texts])]
    finally:
        tokenfiles.CHUNK = was
    assert got == [own.library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_word_starts():
    texts = ["I'm «là», don't 3×4 a ".encode(), b" b\n\nc12."]
    data = b"".join(texts)
    pieces = np.split(np.frombuffer(data, np.uint8), tokenfiles.word_starts(data, np.array([len(texts[0])]))[1:])
    assert [p.tobytes().decode() for p in pieces] == ["I'm", " «là»,", " don't", " 3×4", " a", " ", " b", "\n", "\n", "c", "12", "."]


def check(spark, df, **kw):
    encode, size = tokenfiles.library_ids(spark, BYTE_BPE)
    got = tokenfiles.read_files(tokenfiles.write_files(df, encode, size, end_id=0, **kw)).orderBy("start").collect()
    library = Tokenizer.from_file(BYTE_BPE)
    rows = sorted(((-(2**63) if r["doc_id"] is None else r["doc_id"]), r["text"] or "") for r in df.collect())
    assert [r["key"] for r in got] == [k for k, _ in rows]
    start = 0
    for r, (_, text) in zip(got, rows):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (r["start"], r["n_tokens"]) == (start, len(ids))
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_edge_cases(spark):
    check(spark, docs(spark))
    check(spark, docs(spark, []))
    check(spark, docs(spark), file_docs=1)


def test_query(spark):
    got = queries.op7_token_files(spark, SF).orderBy("doc_id").collect()
    library = Tokenizer.from_file(BYTE_BPE)
    start = 0
    for r, d in zip(got, spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect(), strict=True):
        ids = np.array([*library.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_manifest_names_all_files(spark, tmp_path):
    """Files of lost attempts lie in the folder without being read."""
    (tmp_path / "lost.bits").write_bytes(b"half a file")
    encode, size = tokenfiles.library_ids(spark, BYTE_BPE)
    manifest = tokenfiles.write_files(docs(spark), encode, size, end_id=None, folder=str(tmp_path))
    assert tokenfiles.read_files(manifest).count() == 11
    assert manifest.agg(F.sum("n_docs")).first()[0] == 11
