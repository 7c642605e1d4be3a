"""Secret scans: fixed patterns, plus dictionary-primed zstandard novelty.

Base kinds are found by pattern (leftmost, non-overlapping, each kind on its own).  Beyond them,
a candidate is any run of secret-like characters shortly after a sensitive word, or alone on a line
that follows a reported run (the lines of a PEM block).  Its novelty is the
number of bytes that zstandard needs for it once primed with (a) the identifiers of the corpus and
(b) the code around it, per byte of the candidate.  Names, paths and repeated boilerplate compress
against those; a random key does not, and is reported as kind ``novel``.  From about 64 bytes on
zstandard also codes literals by frequency, so a long candidate is held against a shuffled copy of
itself as well, if its characters are spread like those of a random string.

The identifier dictionary is counted over all documents in one aggregation that combines before
the shuffle; only its first ``IDENTIFIERS`` names are kept, a bounded list that is broadcast.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a run shorter than 32 fails whole, so this finds the same spans
#: Words that make what follows sensitive; a text without any of them has no candidates.
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "key", "credential", "auth", "bearer", "private")
_SENSITIVE = re.compile("(?i:" + "|".join(SENSITIVE) + ")", re.A)
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{16,}={0,2}")
#: A line of its own after a run, quoted or indented at will; and the short last line of a PEM block.
_NEXT = re.compile(r"""["'`\\,;+\x20\tn]{0,16}\r?\n[>#*+"'`\x20\t]{0,64}([A-Za-z0-9+/_.-]{16,}={0,2})(?=["'`\\,;+)\x20\tn]{0,16}(?:\r?\n|$))""")
_TAIL = re.compile(r"""["'`\\,;+\x20\tn]{0,16}\r?\n[>#*+"'`\x20\t]{0,64}([A-Za-z0-9+/]{1,15}={0,2})(?=["'`\\,;+)\x20\tn]{0,16}\r?\n[^A-Za-z0-9\r\n]*-----END)""")
#: A candidate starts at most so many characters after a sensitive word.
REACH = 48
#: Characters of surrounding code on either side.
AROUND = 512
#: Names in the identifier dictionary, and marginal bytes per byte from which a candidate is novel.
IDENTIFIERS, NOVEL = 2048, 0.8
#: Length from which zstandard codes literals, and the share of a shuffled copy's bytes and of a random
#: string's entropy from which a longer candidate is novel as well.
CODED, RANDOM = 48, 0.9
_ALNUM = set(string.ascii_letters + string.digits)

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def identifiers(docs: DataFrame, text: str = "text", most: int = IDENTIFIERS) -> list[str]:
    """The corpus's most frequent identifiers (names followed by ``=``, ``:`` or ``(``; ties by name)."""
    names = docs.select(F.explode(F.regexp_extract_all(
        F.col(text), F.lit(r"(?<![A-Za-z0-9_])([A-Za-z_][A-Za-z0-9_]{2,40})\s?[=:(]"), F.lit(1))).alias("name"))
    top = names.groupBy("name").count().orderBy(F.desc("count"), "name").limit(most)
    return [r["name"] for r in top.collect()]


def base_spans(text: str) -> list[Span]:
    low = text.lower()
    out: list[Span] = []
    if any(w in low for w in ("password", "passwd", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return out


def marginal(candidate: str, around: str, names: bytes) -> int:
    """Bytes that the candidate adds after a dictionary of names and surrounding code."""
    import zstandard

    # The same key standing nearby again must not make itself look familiar; a longer name that
    # holds the candidate may.
    own = rf"(?<![A-Za-z0-9+/_.-]){re.escape(candidate)}(?![A-Za-z0-9+/_.=-])"
    primed = names + re.sub(own, " ", around).encode("utf-8", "replace")
    given = zstandard.ZstdCompressionDict(primed, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(primed) >= 8 else None
    packer = zstandard.ZstdCompressor(level=9, dict_data=given, write_content_size=False, write_dict_id=False)
    return len(packer.compress(candidate.encode())) - len(packer.compress(b""))


def randomness(value: str) -> float:
    """Entropy of the value's characters as a share of what a random string of its length and alphabet
    has (less than the alphabet's by the characters that a short one misses): digits, letters of
    either case (six where all are hexadecimal) and the signs that it holds."""
    held = Counter(value)
    alphabet = 10 * any(c in string.digits for c in held) + len(held.keys() - _ALNUM)
    for letters, few in ((string.ascii_lowercase, "abcdef"), (string.ascii_uppercase, "ABCDEF")):
        used = held.keys() & set(letters)
        alphabet += (6 if used <= set(few) else 26) if used else 0
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in held.values())
    return entropy / (math.log2(alphabet) - (alphabet - 1) / (2 * math.log(2) * len(value)))


def novel(value: str, around: str, names: bytes) -> bool:
    cost = marginal(value, around, names)
    if cost >= NOVEL * len(value):
        return True
    if len(value) < CODED or randomness(value) < RANDOM:
        return False
    shuffled = list(value)
    random.Random(len(value)).shuffle(shuffled)
    return cost >= RANDOM * marginal("".join(shuffled), around, names)


def _mixed(value: str) -> bool:
    return bool(re.search("[0-9]", value) and re.search("[A-Za-z]", value))


def novel_spans(text: str, names: bytes, base: list[Span]) -> list[Span]:
    """Incompressible runs in sensitive context that no base span overlaps."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    taken = sorted((a, b) for a, _, b in base)
    found: dict[int, int] = {}
    for word in _SENSITIVE.finditer(text):
        for run in _RUN.finditer(text, word.end(), min(len(text), word.end() + REACH + 16)):
            if run.start() in found or run.start() - word.end() > REACH:
                continue
            whole = _RUN.match(text, run.start())
            if _mixed(whole[0]):
                found[run.start()] = whole.end()
    out: list[Span] = []
    held = 0

    def measure(a: int, b: int) -> bool:
        """Reports the run if it is novel and no base span overlaps it."""
        nonlocal held
        while held < len(taken) and taken[held][1] <= a:
            held += 1
        if held < len(taken) and taken[held][0] < b:
            return False
        if not novel(text[a:b], text[max(0, a - AROUND):a] + " " + text[b:b + AROUND], names):
            return False
        out.append((a, 3, b))
        return True

    followed = 0  # up to here the lines after a reported run have been measured
    for a, b in sorted(found.items()):
        if a < followed or not measure(a, b):
            continue
        # Lines that follow the run and hold nothing but a run are in its context.
        while line := _NEXT.match(text, b):
            a, b = line.span(1)
            if _mixed(line[1]):
                measure(a, b)
        if out[-1][2] == b and (tail := _TAIL.match(text, b)):
            out.append((tail.start(1), 3, tail.end(1)))
        followed = b
    return out


def spans(text: str | None, names: bytes) -> list[Span]:
    """All spans by start, then kind as listed, in code points, end exclusive."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, names, base))


def _names(spark: SparkSession, known: list[str]):
    return spark.sparkContext.broadcast(" ".join(reversed(known)).encode())  # the most frequent nearest to the text


def scan(spark: SparkSession, known: list[str]) -> Callable[[Column], Column]:
    """A function from a text column to its spans: array<struct<kind, start, end>>.  Null and empty
    texts have none.  ``known``: the identifier dictionary."""
    names = _names(spark, known)

    @pandas_udf("array<struct<kind: string, start: bigint, end: bigint>>")
    def found(texts):
        return texts.map(lambda t: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t, names.value)])

    return found


def redact(spark: SparkSession, known: list[str], mark: str = "[SECRET]") -> Callable[[Column], Column]:
    """A function from a text column to the text with every span (overlapping ones merged)
    replaced by ``mark``.  Texts without spans, null and empty ones stay as they are."""
    names = _names(spark, known)

    def clean(text: str | None) -> str | None:
        out, at = [], 0
        for a, _, b in spans(text, names.value):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]]) if out else text

    @pandas_udf("string")
    def cleaned(texts):
        return texts.map(clean, na_action="ignore")

    return cleaned
