"""Token ids in fixed-width bit-packed files.

Each id takes the minimum number of bits for the vocabulary.  File layout (little-endian numbers):

    header   magic "TOKBITS1", bits u32, ids per block u32
    blocks   ids packed most significant bit first, each block padded to whole bytes
    index    block offsets u64[n_blocks + 1], document starts u64[n_docs + 1], keys i64[n_docs]
    trailer  index position u64, n_blocks u64, n_docs u64, magic

Every block but the last holds the same number of ids, so id i lies in block i div size and any
range of ids is read by two seeks and unpacked with numpy.

Documents are range-partitioned by key and sorted; each task encodes its documents and writes one
file under a name of its own, and returns one manifest row.  Only files that the manifest names
count, so an executor lost half-way or a task run twice leaves the result right.  The start of each
file among all ids is a running sum over the manifest, one row a file.
"""

from __future__ import annotations

import functools
import io
import os
import re
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from camstat.llm.bpe import Memo, byte_alphabet, packed
from camstat.llm.common import shared_path, written

MAGIC = b"TOKBITS1"
#: Ids in a block, and documents aimed at in one file.
BLOCK_IDS, FILE_DOCS = 4096, 16_384


# ---------------------------------------------------------------- bits

def width(vocabulary: int) -> int:
    """Bits for ids 0 .. vocabulary-1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8)).tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype("<u4")
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return (each @ (np.uint32(1) << np.arange(bits - 1, -1, -1, dtype=np.uint32))).astype("<u4")


class Writer:
    """Streams documents into one file; holds one block and the index."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.rest: list[np.ndarray] = []
        self.held = self.at = self.n_ids = 0
        self.offsets, self.starts, self.keys = [], [0], []
        self._put(MAGIC + struct.pack("<II", bits, block_ids))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.empty(0, "<u4")
        full = len(ids) if last else len(ids) // self.block_ids * self.block_ids
        for i in range(0, full, self.block_ids):
            self.offsets.append(self.at)
            self._put(pack(ids[i:min(i + self.block_ids, full)], self.bits))
        self.rest, self.held = [ids[full:]], len(ids) - full

    def add(self, key: int, ids: np.ndarray) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        self.starts.append(self.n_ids)
        self.keys.append(key)
        if self.held >= 64 * self.block_ids:
            self._flush()

    def close(self) -> None:
        self._flush(last=True)
        self.offsets.append(self.at)
        index = self.at
        self._put(np.array(self.offsets, "<u8").tobytes())
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(np.array(self.keys, "<i8").tobytes())
        self._put(struct.pack("<QQQ", index, len(self.offsets) - 1, len(self.keys)) + MAGIC)


class Reader:
    """Random access to one file (a seekable binary file object)."""

    def __init__(self, src):
        self.src = src
        src.seek(0)
        head = src.read(16)
        src.seek(-32, io.SEEK_END)
        tail = src.read(32)
        if head[:8] != MAGIC or tail[24:] != MAGIC:
            raise ValueError("not a token file, or a broken one")
        self.bits, self.block_ids = struct.unpack("<II", head[8:])
        index, n_blocks, n_docs = struct.unpack("<QQQ", tail[:24])
        src.seek(index)
        self.offsets = np.frombuffer(src.read(8 * (n_blocks + 1)), "<u8").astype(np.int64)
        self.starts = np.frombuffer(src.read(8 * (n_docs + 1)), "<u8").astype(np.int64)
        self.keys = np.frombuffer(src.read(8 * n_docs), "<i8")

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop-1 of the file: only their blocks are read."""
        if stop <= start:
            return np.empty(0, "<u4")
        a, b = start // self.block_ids, (stop - 1) // self.block_ids + 1
        self.src.seek(int(self.offsets[a]))
        data = self.src.read(int(self.offsets[b] - self.offsets[a]))
        full = self.block_ids * self.bits  # bits of a full block; padded to bytes between blocks
        if full % 8 == 0:
            n = min(b * self.block_ids, int(self.starts[-1])) - a * self.block_ids
            got = unpack(data, n, self.bits)
        else:
            edges = (self.offsets[a:b + 1] - self.offsets[a]).tolist()
            sizes = [min((k + 1) * self.block_ids, int(self.starts[-1])) - k * self.block_ids for k in range(a, b)]
            got = np.concatenate([unpack(data[i:j], n, self.bits) for i, j, n in zip(edges, edges[1:], sizes)])
        return got[start - a * self.block_ids: stop - a * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


# ---------------------------------------------------------------- ids

#: White space beyond blank, tab and line ends, and the bytes that UTF-8 texts with such characters
#: hold (a quick first test).
_ODD_WHITE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_BYTES = b"\x0b\x0c\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"
_NOT_LATIN = re.compile("[^\x00-\u017f]")
#: Fixed value: the word pattern of byte-level BPE files with ``use_regex``.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Kinds of bytes.  UNSURE: of characters whose kind takes more than a look at the byte.
BLANK, WHITE, LETTER, DIGIT, MARK, QUOTE, UNSURE, FOLLOWS = range(8)


def _kind(b: int) -> int:
    if b == 32:
        return BLANK
    if b in b"\t\n\r":
        return WHITE
    if b < 128:
        return LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else QUOTE if b == 39 else MARK
    return FOLLOWS if b < 192 else LETTER if 0xC3 <= b <= 0xC5 else UNSURE


def _cut(before: int, now: int) -> int:
    """1: the word pattern always ends a word between two such bytes, 2: if no white space follows."""
    white = (BLANK, WHITE)
    if now in white:
        return 2 if before in white else 1
    if before in white:
        return int(before == WHITE)
    if UNSURE in (before, now) or now == QUOTE or (before, now) == (QUOTE, LETTER):  # 's and the like
        return 0
    return int(before != now and (before, now) != (QUOTE, MARK))


_KINDS = bytes(map(_kind, range(256)))
_CUTS = bytes([_cut(x >> 3, x & 7) if x < 64 else 0 for x in range(256)])
#: Bytes of text cut into words at a time, and a place where any longer text can be cut.
CHUNK, _WORD_START = 1 << 21, re.compile(rb" (?=[A-Za-z])")


def word_starts(data: bytes, texts: np.ndarray) -> np.ndarray:
    """Ascending positions in UTF-8 ``data`` at which words certainly start, among them all of
    ``texts``, where texts start.  Between two of them stands one word, or a few around quotes
    and characters beyond Latin letters."""
    kinds = np.frombuffer(bytearray(data.translate(_KINDS)), np.uint8)
    if not data.isascii():
        raw = np.frombuffer(data, np.uint8)
        follows = kinds == FOLLOWS
        kinds[follows] = UNSURE
        kinds[1:][follows[1:] & (kinds[:-1] == LETTER) & (raw[:-1] >= 0xC3)] = LETTER  # U+00C0 to U+017F
        if b"\xc3\x97" in data or b"\xc3\xb7" in data:  # the two that are no letters
            signs = np.flatnonzero((raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7)))
            kinds[signs] = kinds[signs + 1] = UNSURE
    cuts = np.frombuffer(bytearray(b"\1" + (kinds[:-1] << 3 | kinds[1:]).tobytes().translate(_CUTS)), np.uint8)
    cuts[texts] = 1
    later = np.flatnonzero(cuts == 2)
    if len(later):
        ended = np.append(np.isin(later[:-1] + 1, texts), True) if later[-1] + 1 == len(data) else np.isin(later + 1, texts)
        cuts[later] = ~ended & (kinds[np.minimum(later + 1, len(data) - 1)] > WHITE)
    return np.flatnonzero(cuts)


class ByteLevel:
    """Byte-level BPE by the tokenizers library, each word encoded once per worker.

    Texts are cut where a word starts for certain, a few MB at a time; of equal pieces one is looked
    up in a bounded memo, and the ids of all are gathered by position.  Texts with special tokens or
    unusual white space go to the library whole."""

    def __init__(self, source: str):
        import json

        from tokenizers import Tokenizer

        spec = json.loads(source)
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.by_piece = bool(plain and not spec["normalizer"] and spec["model"]["type"] == "BPE")
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        chars = {b: c for c, b in byte_alphabet().items()}
        self.spelt, self.blank = "".join([chars[b] for b in range(256)]), chars[32]
        self.pieces = Memo(self._piece)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # the byte alphabet leaves these as they are, but for blanks
            own = word.replace(" ", self.blank)
        else:
            own = word.encode().decode("latin-1").translate(self.spelt)
        return packed([t.id for t in self.model.tokenize(own)])

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, "<u4")

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        if not text.isascii() and _NOT_LATIN.search(text):
            return self._whole(piece).tobytes()
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):  # one word by the pattern
            return self._word(text)
        words = _WORDS.findall(text)
        return self._word(text) if len(words) == 1 else b"".join([self.pieces[w.encode()] for w in words])

    def _plain(self, text: bytes) -> bool:
        if not self.by_piece or any(s in text for s in self.special):
            return False
        return len(text.translate(None, _ODD_BYTES)) == len(text) or not _ODD_WHITE.search(text.decode())

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts."""
        import pyarrow as pa

        data = b"".join(texts)
        if not data:
            return [np.empty(0, "<u4")] * len(texts)
        ends = np.cumsum([len(t) for t in texts])
        starts = word_starts(data, ends[ends < len(data)])
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        known = [*map(self.pieces.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False))]
        flat, length = np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = pieces.indices.to_numpy()
        n = length[which]
        to = np.cumsum(n)
        ids = flat[np.repeat((np.cumsum(length) - length)[which] - (to - n), n) + np.arange(to[-1])]
        return np.split(ids, np.append(0, to)[np.searchsorted(starts, ends[:-1])])

    def _long(self, text: bytes) -> np.ndarray:
        """Ids of a plain text of any length."""
        at, own = 0, []
        while at < len(text):
            next_word = _WORD_START.search(text, at + CHUNK)
            end = next_word.start() if next_word else len(text)
            own += self._chunk([text[at:end]])
            at = end
        return np.concatenate(own)

    def encode_all(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn."""
        held, size = [], 0
        for text in texts:
            text = text or b""
            plain = self._plain(text)
            apart = not plain or len(text) > CHUNK
            if apart or size + len(text) > CHUNK:
                yield from self._chunk(held)
                held, size = [], 0
            if apart:
                yield self._long(text) if plain else self._whole(text)
            else:
                held.append(text)
                size += len(text)
        yield from self._chunk(held)

    def encode(self, text: bytes | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return next(self.encode_all([text])).tobytes()


@functools.lru_cache(maxsize=4)
def byte_level(source: str) -> ByteLevel:
    return ByteLevel(source)


#: From UTF-8 texts (null: empty) to the ids of each in turn.
Encode = Callable[[Iterable[bytes | None]], Iterable[np.ndarray]]


def library_ids(spark: SparkSession, path: str) -> tuple[Encode, int]:
    """(function from UTF-8 texts to their ids, vocabulary size) for a tokenizer file, which is
    read on the driver and broadcast."""
    with open(path, encoding="utf-8") as f:
        source = f.read()
    size = byte_level(source).vocabulary
    sent = spark.sparkContext.broadcast(source)
    return (lambda texts: byte_level(sent.value).encode_all(texts)), size


# ---------------------------------------------------------------- Spark

def _open(path: str, mode: str):
    """A binary file of any store that pyarrow knows; parents are made for writing."""
    from pyarrow import fs

    local = path[5:] if path.startswith("file:") else path
    if "://" not in local:
        local = "/" + local.lstrip("/")
        if mode == "w":
            os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, f"{mode}b")
    store, inner = fs.FileSystem.from_uri(path)
    if mode == "w":
        store.create_dir(inner.rpartition("/")[0], recursive=True)
        return store.open_output_stream(inner)
    return store.open_input_file(inner)


def write_files(df: DataFrame, encode: Encode, vocabulary: int, end_id: int | None,
                folder: str | None = None, key: str = "doc_id", text: str = "text",
                file_docs: int = FILE_DOCS) -> DataFrame:
    """Write the ids of all documents in ascending key order; returns the manifest: part, path,
    n_docs, n_ids, start (ids in earlier files), in a table of its own.

    ``folder``: a path that all executors share; by default a new one under spark.checkpoint.dir.
    ``end_id`` is appended to every document.  Null and empty texts have no other ids.  Rows that
    repeat a key stay, ordered by a hash of their texts; null keys come first and are written as
    the smallest long.  An empty table gives an empty manifest."""
    spark = df.sparkSession
    folder = folder or shared_path(spark, "token-files")
    bits, tail = width(vocabulary), np.array([] if end_id is None else [end_id], "<u4")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text")).withColumn("tie", F.xxhash64("text"))
    n = max(rows.count() // file_docs + 1, spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie")

    def save(batches: Iterator):
        import pandas as pd
        from pyspark import TaskContext

        path, out, w = f"{folder}/{uuid.uuid4().hex}.bits", None, None
        for batch in batches:
            if w is None:
                out = _open(path, "w")
                w = Writer(out, bits)
            for k, ids in zip(batch["key"], encode(batch["text"])):
                w.add(-(2**63) if pd.isna(k) else int(k), np.concatenate([ids, tail]))
        if w is not None:
            w.close()
            out.close()
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "path": [path],
                                "n_docs": [len(w.keys)], "n_ids": [w.n_ids]})

    manifest = written(ordered.mapInPandas(save, "part int, path string, n_docs long, n_ids long"), "token-manifest")
    before = F.sum("n_ids").over(Window.orderBy("part")) - F.col("n_ids")
    return manifest.withColumn("start", before)


def read_files(manifest: DataFrame) -> DataFrame:
    """(key, start, n_tokens, ids) of every document, from the files: ids as little-endian unsigned
    32-bit integers, start counted over all files."""

    def load(batches: Iterator):
        import pandas as pd

        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                with _open(path, "r") as src:
                    r = Reader(src)
                    for i in range(0, len(r.keys), 512):
                        some = range(i, min(i + 512, len(r.keys)))
                        lo, hi = int(r.starts[some[0]]), int(r.starts[some[-1] + 1])
                        if hi - lo <= 1 << 24:
                            ids = r.ids(lo, hi)
                            parts = [ids[int(r.starts[k]) - lo: int(r.starts[k + 1]) - lo].tobytes() for k in some]
                        else:
                            parts = [r.document(k).tobytes() for k in some]
                        yield pd.DataFrame({
                            "key": r.keys[i:i + len(some)], "start": start + r.starts[i:i + len(some)],
                            "n_tokens": np.diff(r.starts[i:i + len(some) + 1]), "ids": parts})

    n = max(1, manifest.count())
    return manifest.repartition(n, "part").mapInPandas(load, "key long, start long, n_tokens long, ids binary")
