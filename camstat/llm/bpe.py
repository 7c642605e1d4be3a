"""BPE encoding by forced-boundary splitting, and decoding.

The vocabulary fixes which byte pairs can ever stand next to each other inside a token.  A pair
that occurs inside no token is a certain cut: no merge crosses it, whatever stands around it.
A text is cut at all such pairs, every fragment is encoded on its own by the merge list, and the
ids are concatenated.  The result is the same as merging the whole text.  Fragments go through the
library's own merge loop, one model for fragments that end a word and one for those that do not.

White space is the most frequent certain cut (checked against the vocabulary when the encoder is
built), so a text is first cut there; the pieces are normalised and split into words by the
tokenizer file's own rules, and words are cut at the other certain pairs.  Pieces and
words repeat a lot, so each is encoded once and kept in a bounded memo of the worker.

The tokenizer file is read on the driver and broadcast (a vocabulary file of a few MB, of fixed
size), so executors need no local copy.
"""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import pandas_udf

#: Entries in each half of a worker's memo of pieces, and of words.
MEMO, WORD_MEMO = 250_000, 150_000
WHITE = b" \t\n\r\x0b\x0c"
#: Beyond Latin, or white space on which Python and the library may differ.
_NOT_LATIN = re.compile("[^\x00-\u017f]|[\x1c-\x1f\x85\xa0]")


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, reversed."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


_PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else struct.pack(f"<{len(ids)}I", *ids)


class Memo(dict):
    """``memo[key]`` computes a missing value once.  When it holds ``most`` entries they become the
    older half, from which keys still in use are taken over; the rest is forgotten at the next turn."""

    def __init__(self, make: Callable, most: int = MEMO):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes with a byte-level BPE tokenizer file whose words end in a suffix or in nothing."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        self.library = Tokenizer.from_str(source)
        vocab = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens are expected to match as written")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.alphabet = byte_alphabet()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # The library's merge loop, for fragments that end a word and for those that do not.
        self.ending = BPE(vocab, merges, end_of_word_suffix=self.suffix) if self.suffix else BPE(vocab, merges)
        self.inner = BPE(vocab, merges)
        self.chars = {b: c for c, b in self.alphabet.items()}
        self.cut = self._certain_cuts(vocab)
        self.cut_rows = [row.tolist() for row in self.cut]
        # White space splits the raw text only if no token holds it beside another byte.
        white = np.frombuffer(WHITE, np.uint8)
        if not (self.cut[white].all() and self.cut[:, white].all()):
            raise ValueError("this vocabulary has tokens across white space")
        self._specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._latin = self._latin_rules(spec)
        self.pieces, self.words = Memo(self._piece), Memo(self._word, WORD_MEMO)

    def _latin_rules(self, spec: dict):
        """The word pattern, if the file's rules are: NFC, white space to one blank, lower case, words
        by a pattern, byte alphabet.  For texts of code points below U+0180 Python then gives the same
        words as the library (they are stable under NFC), faster; other texts go to the library."""
        normal, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        kinds = [n.get("type") for n in normal.get("normalizers", [])], [q.get("type") for q in pre.get("pretokenizers", [])]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            return None
        split, level = pre["pretokenizers"]
        if split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or level["add_prefix_space"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _certain_cuts(self, vocab: dict[str, int]) -> np.ndarray:
        """cut[a, b]: byte b follows byte a inside no token."""
        cut = np.ones((256, 256), bool)
        for token in vocab:
            body = token[: -len(self.suffix)] if self.suffix and token.endswith(self.suffix) else token
            b = np.fromiter((self.alphabet[c] for c in body), np.uint8, len(body))
            cut[b[:-1], b[1:]] = False
        return cut

    def _spelt(self, data: bytes) -> str:
        """Bytes in the byte alphabet, which leaves visible ASCII as it is."""
        return data.decode() if data.isascii() and data.isalnum() else "".join([self.chars[b] for b in data])

    def _word(self, data: bytes) -> bytes:
        """One word (UTF-8): cut at the certain pairs, fragments encoded apart, ids concatenated."""
        cut, at = self.cut_rows, 0
        out = []
        for i, (a, b) in enumerate(zip(data, data[1:]), 1):
            if cut[a][b]:
                out += [t.id for t in self.inner.tokenize(self._spelt(data[at:i]))]
                at = i
        out += [t.id for t in self.ending.tokenize(self._spelt(data[at:]))]
        return packed(out)

    def _split_words(self, text: str) -> list[bytes]:
        if self._latin and not _NOT_LATIN.search(text):
            return [w.encode() for w in self._latin.findall(text.lower())]
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.alphabet.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _piece(self, piece: bytes) -> bytes:
        """A piece of the text without ASCII white space."""
        text = piece.decode()
        parts = self._specials.split(text) if self._specials and "<" in text else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            else:
                out += [self.words[w] for w in self._split_words(part)]
        return b"".join(out)

    def encode(self, text: bytes | None) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers; null: none."""
        return b"".join(map(self.pieces.__getitem__, text.split())) if text else b""


@functools.lru_cache(maxsize=4)
def encoder(source: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    return Encoder(source)


def _broadcast(spark: SparkSession, path: str):
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from a text column, cast to binary, to its ids: binary, little-endian unsigned
    32-bit integers, as the tokenizers library gives them without added special tokens.  Null and
    empty texts give no ids.  ``path``: tokenizer file, read on the driver."""
    source = _broadcast(spark, path)

    @pandas_udf("binary")
    def ids(texts):
        own = encoder(source.value)
        return texts.map(own.encode)

    return ids


def decode(spark: SparkSession, path: str) -> Callable[[Column], Column]:
    """A function from ids (as ``encode`` gives them) to their text: tokens joined as the library's
    decode() does for a file without a decoder, by single spaces; special tokens included, ids
    outside the vocabulary skipped.  Null gives the empty text."""
    source = _broadcast(spark, path)

    @pandas_udf("string")
    def text(ids):
        own = encoder(source.value)
        if own.library.decoder is not None:
            return ids.map(lambda b: own.library.decode(np.frombuffer(b or b"", "<u4").tolist(), skip_special_tokens=False))
        known = own.tokens
        return ids.map(lambda b: " ".join([known[i] for i in np.frombuffer(b or b"", "<u4").tolist() if i in known]))

    return text
