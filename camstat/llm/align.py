"""Cross-tokenizer alignment by intersecting cumulative token ends.

A text is spelt twice, by a byte-level BPE file (A, a space put before the text) and by a
sentencepiece file (B, which puts that space itself).  Both spell the same bytes, so the running
byte ends of either side go into an end-to-index dictionary, the ends that both dictionaries hold
are taken in order, and consecutive common ends slice the two id lists into groups.  Ends are byte offsets of
the text, so the dictionaries are tables addressed by the offset itself: a hash without collisions,
whose keys come out sorted.  No token is empty, so
each slice links exactly its two last tokens: the ones that end together.

Linked tokens end at the same byte, so one of them is a suffix of the other.  All pairs that can ever be
linked are therefore known from the two vocabularies: a link travels as the index of its pair, and
the corpus-wide counts are one number per possible pair, whatever the size of the corpus.  That
table is counted per task first, and is what the driver collects and broadcasts (about 0.3 million
pairs for vocabularies of 50,000 and 32,000).
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from camstat.llm.bpe import byte_alphabet
from camstat.llm.common import written

#: Fixed value: the word pattern of byte-level BPE files with ``use_regex``.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def _changing() -> re.Pattern:
    """Characters that regular expression engines may class differently: beyond the basic plane,
    younger than Unicode 3.2 or classed anew since, and white space other than the common kinds."""
    def kind(c: str, of) -> str:
        return of.category(c)[0]

    odd = [i for i in range(0x10000) if not 0xD800 <= i < 0xE000 and (
        kind(chr(i), unicodedata) != kind(chr(i), unicodedata.ucd_3_2_0) or (chr(i).isspace() and i not in (9, 10, 11, 12, 13, 32, 0xA0)))]
    cuts = [k for k in range(1, len(odd)) if odd[k] != odd[k - 1] + 1]
    runs = [odd[a:b] for a, b in zip([0, *cuts], [*cuts, len(odd)])]
    return re.compile("[" + "".join(rf"\u{r[0]:04x}-\u{r[-1]:04x}" for r in runs) + "\U00010000-\U0010ffff]")


class Spelling:
    """Both tokenizers, the bytes of their entries, and all pairs that a link can hold."""

    def __init__(self, bpe: str, piece: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        spec = json.loads(bpe)
        added = {t["content"] for t in spec["added_tokens"]}
        self.library = Tokenizer.from_str(bpe)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        alphabet = byte_alphabet()
        self.a = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a[i] = bytes(map(alphabet.__getitem__, t))
        self.fast = self._ranks(spec, vocab)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece)
        size = self.pieces.get_piece_size()
        self.b = [self._piece_bytes(i) for i in range(size)]
        self.bytes_a, self.bytes_b = np.array(self.a, object), np.array(self.b, object)
        self.length_a, self.length_b = np.array([len(t) for t in self.a]), np.array([len(t) for t in self.b])
        #: Ids in decimal, followed by a comma, a bar, or a semicolon.
        self.names = max(len(self.a), size)
        self.named = np.array([f"{i}{end}" for end in ",|;" for i in range(self.names)], object)

    def _ranks(self, spec: dict, vocab: dict[str, int]):
        """The same merges as ranks for tiktoken, if ids follow the order of the merges; else none."""
        import tiktoken

        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["normalizer"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        single = sum(len(t) == 1 for t in vocab)
        if not plain or any(vocab["".join(m)] != single + k for k, m in enumerate(merges)):
            return None
        return tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks={t: i for i, t in enumerate(self.a) if t}, special_tokens={})

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    @functools.cached_property
    def codes(self) -> np.ndarray:
        """All possible pairs in ascending order, each as id_a * len(b) + id_b: one side's bytes are a
        suffix of the other's."""
        by_bytes: tuple[dict, dict] = {}, {}
        for side, tokens in zip(by_bytes, (self.a, self.b)):
            for i, t in enumerate(tokens):
                if t:
                    side.setdefault(t, []).append(i)
        found = set()
        for t, ids in by_bytes[0].items():
            for k in range(len(t)):
                found.update(i * len(self.b) + j for j in by_bytes[1].get(t[k:], ()) for i in ids)
        for t, ids in by_bytes[1].items():
            for k in range(1, len(t)):
                found.update(i * len(self.b) + j for i in by_bytes[0].get(t[k:], ()) for j in ids)
        return np.array(sorted(found), np.int64)

    def spell(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none where either does not spell the bytes of space and text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not text:
            return none
        spaced = " " + text
        if self.fast is not None and not _changing().search(spaced):
            a = self.fast.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        else:
            a = np.array(self.library.encode(spaced, add_special_tokens=False).ids, np.int64)
        b = np.array(self.pieces.encode(text), np.int64)
        want = spaced.encode()
        if b"".join(self.bytes_a[a].tolist()) != want or b"".join(self.bytes_b[b].tolist()) != want:
            return none
        return a, b

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[str, np.ndarray]:
        """(groups as ``a1,a2|b1;...``, links as id_a * len(b) + id_b)."""
        if not len(a) or not len(b):
            return "", np.zeros(0, np.int64)
        ends_a, ends_b = self.length_a[a].cumsum(), self.length_b[b].cumsum()
        at_a, at_b = (np.zeros(max(ends_a[-1], ends_b[-1]) + 1, np.int64) for _ in "ab")
        at_a[ends_a], at_b[ends_b] = np.arange(1, len(a) + 1), np.arange(1, len(b) + 1)
        common = np.flatnonzero(at_a * at_b)
        to_a, to_b = at_a[common], at_b[common]
        # Each slice is written as its A ids, then its B ids; every id has its separator behind it.
        before_a, before_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        spelt = np.empty(len(a) + len(b), np.int64)
        place_a = np.arange(len(a)) + np.repeat(to_b - before_b, before_a)
        place_b = np.arange(len(b)) + np.repeat(to_a, before_b)
        spelt[place_a], spelt[place_b] = a, b
        spelt[place_a[to_a - 1]] += self.names
        spelt[place_b[to_b - 1]] += 2 * self.names
        return "".join(self.named[spelt].tolist())[:-1], a[to_a - 1] * len(self.b) + b[to_b - 1]


@functools.lru_cache(maxsize=2)
def spelling(bpe: str, piece: bytes) -> Spelling:
    """One per worker process and pair of files."""
    return Spelling(bpe, piece)


class Aligner:
    """Alignment of texts under two tokenizer files, which are read on the driver and broadcast."""

    def __init__(self, spark: SparkSession, bpe_path: str, piece_path: str):
        with open(bpe_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
            self._files = spark.sparkContext.broadcast((f.read(), g.read()))

    def aligned(self, df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """One row per row of ``df``: ``keep``, n_a, n_b, groups (string), links (binary: 32-bit indexes of
        possible pairs, in text order).  Null and empty texts, and texts that either tokenizer spells
        otherwise, have no tokens; a name in ``keep`` must not be one of the new columns."""
        files = self._files

        @pandas_udf("n_a long, n_b long, groups string, links binary")
        def both(texts):
            import pandas as pd

            own = spelling(*files.value)

            def one(t):
                a, b = own.spell(t)
                groups, links = own.align(a, b)
                return len(a), len(b), groups, np.searchsorted(own.codes, links).astype("<u4").tobytes()

            return pd.DataFrame([one(t or "") for t in texts], columns=["n_a", "n_b", "groups", "links"])

        return df.select(*keep, both(F.col(text)).alias("__both")).select(*keep, "__both.*")

    def link_counts(self, links: DataFrame) -> DataFrame:
        """(pair, id_a, id_b, links, best): how many links of a table with ``links`` hold each pair, and
        whether no other pair of its id_b has more (ties included).  At most one row per possible pair."""
        files = self._files

        def tally(batches: Iterator) -> Iterator:
            import pandas as pd

            codes = spelling(*files.value).codes
            total = np.zeros(len(codes), np.int64)
            for batch in batches:
                total += np.bincount(np.frombuffer(b"".join(batch["links"]), "<u4"), minlength=len(codes))
            pair = np.flatnonzero(total)
            size = len(spelling(*files.value).b)
            yield pd.DataFrame({"pair": pair, "id_a": codes[pair] // size, "id_b": codes[pair] % size, "n": total[pair]})

        counts = (
            links.select("links").mapInPandas(tally, "pair long, id_a long, id_b long, n long")
            .groupBy("pair", "id_a", "id_b").agg(F.sum("n").alias("links")))
        top = counts.groupBy(F.col("id_b").alias("__b")).agg(F.max("links").alias("__top"))
        return counts.join(top, F.col("id_b") == F.col("__b")).select("pair", "id_a", "id_b", "links", (F.col("links") == F.col("__top")).alias("best"))

    def scored(self, rows: DataFrame, counts: DataFrame) -> DataFrame:
        """``rows`` (with ``links``) and n_best, count_sum under ``counts``, which the driver holds whole:
        one row per possible pair at most."""
        got = counts.select("pair", "links", "best").toPandas()
        size = len(spelling(*self._files.value).codes)
        of, best = np.zeros(size, np.int64), np.zeros(size, bool)
        of[got["pair"].to_numpy(np.int64)] = got["links"].to_numpy(np.int64)
        best[got["pair"].to_numpy(np.int64)] = got["best"].to_numpy(bool)
        sent = rows.sparkSession.sparkContext.broadcast((of, best))

        @pandas_udf("n_best long, count_sum long")
        def score(links):
            import pandas as pd

            of, best = sent.value
            own = [np.frombuffer(b, "<u4") for b in links]
            return pd.DataFrame({"n_best": [int(best[x].sum()) for x in own], "count_sum": [int(of[x].sum()) for x in own]})

        return rows.select("*", score(F.col("links")).alias("__score")).select(*rows.columns, "__score.*")


def alignment(spark: SparkSession, df: DataFrame, bpe_path: str, piece_path: str, keep: list[str], digest_only: bool = False) -> DataFrame:
    """``keep``, n_a, n_b, groups, n_groups, n_links, n_best, count_sum for every row of ``df``.

    The alignment is written once, counted, and read again.  ``digest_only`` keeps the SHA-256 of
    ``groups`` (groups_sha256, empty without tokens) in its place, which spares writing them.
    An empty table gives no rows; repeated rows count each."""
    aligner = Aligner(spark, bpe_path, piece_path)
    rows = aligner.aligned(df, keep)
    groups = F.col("groups")
    if digest_only:
        groups = F.when(F.col("n_a") > 0, F.sha2(groups.cast("binary"), 256)).otherwise(F.lit("")).alias("groups_sha256")
    n = (F.octet_length("links") / 4).cast("long")
    rows = written(rows.select(*keep, "n_a", "n_b", groups, n.alias("n_groups"), n.alias("n_links"), "links"), "aligned")
    return aligner.scored(rows, aligner.link_counts(rows)).drop("links")
