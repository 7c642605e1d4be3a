import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from camstat.llm import bpe
from tests.llm.helpers import SF, WORD_BPE, docs


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def encoder():
    with open(WORD_BPE, encoding="utf-8") as f:
        return bpe.Encoder(f.read())


def check(df, spark, library):
    encode, decode = bpe.encode(spark, WORD_BPE), bpe.decode(spark, WORD_BPE)
    got = df.withColumn("ids", encode(F.col("text").cast("binary"))).withColumn("back", decode(F.col("ids"))).collect()
    for r in got:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["back"] == library.decode(ids, skip_special_tokens=False)
    return len(got)


def test_edge_cases(spark, library):
    assert check(docs(spark), spark, library) == 11
    assert check(docs(spark, []), spark, library) == 0


def test_given_documents(spark, library):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert check(df, spark, library) == df.count()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aeinrst '<|>1éİ́ \n")), max_size=60))
def test_any_text(encoder, library, text):
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_certain(encoder):
    """No token of the vocabulary holds a pair that is cut."""
    for token in encoder.library.get_vocab(with_added_tokens=False):
        body = [encoder.alphabet[c] for c in token.removesuffix("</w>")]
        assert not any(encoder.cut[a, b] for a, b in zip(body, body[1:]))
    assert encoder.cut.any() and not encoder.cut.all()


def test_memo_is_bounded():
    memo = bpe.Memo(str, 10)
    assert [memo[i] for i in range(35)] == [str(i) for i in range(35)]
    assert len(memo) <= 10
