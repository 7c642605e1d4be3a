import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from camstat.llm import align, queries
from tests.llm.helpers import BYTE_BPE, SF, docs

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def own():
    with open(BYTE_BPE, encoding="utf-8") as f, open(PIECES, "rb") as g:
        return align.spelling(f.read(), g.read())


def expected(rows):
    """The contract, by plain loops over both libraries' tokens."""
    a_lib = Tokenizer.from_file(BYTE_BPE)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    of_char = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    out, links, counts = [], [], Counter()
    for key, text in rows:
        text = text or ""
        a = a_lib.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        a_bytes = [bytes(of_char[c] for c in a_lib.id_to_token(i)) for i in a]
        b_names = [b_lib.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in b_names]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a, b = [], []
        groups, mine, x, y, end_a, end_b, from_a, from_b = [], [], 0, 0, 0, 0, 0, 0
        while x < len(a):
            end_a += len(a_bytes[x])
            x += 1
            while end_b < end_a:
                end_b += len(b_bytes[y])
                y += 1
            if end_a == end_b:
                groups.append(",".join(map(str, a[from_a:x])) + "|" + ",".join(map(str, b[from_b:y])))
                mine.append((a[x - 1], b[y - 1]))
                from_a, from_b = x, y
        counts.update(mine)
        links.append(mine)
        out.append([key, len(a), len(b), len(groups), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(*row, sum(counts[p] == best[p[1]] for p in mine), sum(counts[p] for p in mine)) for row, mine in zip(out, links)]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_against_plain_loops(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(queries.op11_align(spark, SF)) == sorted(expected(table), key=repr)


def test_edge_cases(spark):
    extra = [(20, "a▁b", "s"), (21, "<s> </s> <unk> <|endoftext|> <0x41>", "s"), (22, " ", "s"), (23, "\0\t\r\n  x", "s"), (24, "é́ ﬁ ½ 𝔸   ​ \x85x", "s")]
    df = docs(spark).unionByName(docs(spark, extra)).withColumnRenamed("fp", "links").withColumnRenamed("key", "groups")
    got = rows_of(align.alignment(spark, df, BYTE_BPE, PIECES, ["doc_id"], digest_only=True))
    assert got == sorted(expected([(r["doc_id"], r["text"]) for r in df.collect()]), key=repr)
    assert sum(r[1] == 0 and r[5] == "" for r in got) == 3  # null, empty, and a text that holds the blank's own sign


def test_empty_table(spark):
    assert align.alignment(spark, docs(spark, []), BYTE_BPE, PIECES, ["doc_id"]).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ae  \n\t'1é　\xa0\x0b▁<s>")), max_size=40))
def test_any_text(own, text):
    a, b = own.spell(text)
    if len(a):
        assert a.tolist() == own.library.encode(" " + text, add_special_tokens=False).ids
        groups, links = own.align(a, b)
        assert b"".join(own.b[j] for j in b) == (" " + text).encode()
        assert len(groups.split(";")) == len(links) >= 1
        assert set(links.tolist()) <= set(own.codes.tolist())


def test_pairs_are_bounded_by_the_vocabularies(own):
    assert len(own.codes) < 8 * (len(own.a) + len(own.b))
    assert own.fast is not None


def test_counts_table(spark):
    aligner = align.Aligner(spark, BYTE_BPE, PIECES)
    df = spark.createDataFrame([(1, "the cat the cat"), (2, "the dog")], "doc_id long, text string")
    got = aligner.link_counts(aligner.aligned(df, ["doc_id"])).collect()
    assert sum(r["links"] for r in got) == 6 and max(r["links"] for r in got) == 3
    assert all(r["best"] for r in got)
