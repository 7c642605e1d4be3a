"""Toxicity by weak supervision.

1. Voters.  A bounded sample of labelled training rows gives units, words or beginnings of words, that
   lean to toxic texts by more than chance allows among all units.  Each unit is a lexicon voter: it votes
   where its density in a text passes a bound chosen on the labels, as single hits occur in clean texts
   too.  Fixed patterns (shouting, symbol runs and the like) are voters as well, and so are the labels
   themselves.  Near copies in the sample share one weight, so that a large group of copies cannot
   become a lexicon.
2. Label model.  A generative model of the votes: texts are clean or toxic in one of several ways (families of
   voters that fire together, such as those of one language).  Expectation maximisation estimates each voter's
   firing rate in each, the accuracy of the labels, and residual correlations between voters, by which the
   evidence of voters that move together is discounted.  The posterior of the toxic ways replaces the
   noisy label.
3. Classifier.  A logistic regression on unit densities and patterns is trained on the posteriors and scores
   every document.

Scores depend on the text alone.  What is collected is the bounded sample's votes (``SAMPLE`` rows)
and the lexicon (``LEXICON`` units); scoring is one pass over all documents without a shuffle.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from camstat.llm.common import digest, written

#: Most labelled rows that voters, label model and classifier are fitted on.
SAMPLE = 20_000
#: Clean documents without any vote that are added to the sample: few labels alone condemn nothing.
CLEAN = 10.0
#: Most units in the lexicon, least log odds of a unit, and the chance that any unit passes without a reason.
LEXICON, ODDS, CHANCE = 256, 1.5, 0.05
#: Lengths of word beginnings that are units beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Bounds from which a unit's bound is chosen: hits over the root of hundreds of words.
BOUNDS = (1e-9, 0.5, 1.0, 1.5, 2.0, 3.0)
#: Correlation in toxic rows from which voters are one family.
FAMILY = 0.1
#: Units that a task counts before it hands them on.
TALLY = 50_000
_WORD = re.compile(r"[^\W\d_]+")
#: Pattern voters: name, pattern, least matches per 100 words.
PATTERNS = (
    ("shouting", re.compile(r"\b[A-Z]{3,}\b"), 10.0),
    ("exclamations", re.compile(r"[!?]{2,}"), 2.0),
    ("symbol runs", re.compile(r"[#$%&*@]{2,}"), 5.0),
    ("masked words", re.compile(r"\b\w+[*@$]+\w+\b"), 1.0),
    ("repeated words", re.compile(r"\b(\w{3,})\W+\1\b", re.I), 5.0),
)


def words(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def units(word: str) -> list[str]:
    """A word and its beginnings (written with ``~``)."""
    return [word, *[word[:k] + "~" for k in BEGINNINGS if len(word) > k]]


def density(hits, n_words):
    """Hits over the root of hundreds of words: one hit tells more in a short text, many tell in any."""
    return hits / np.sqrt(n_words / 100 + 0.5)


def fired(text: str | None) -> list[bool]:
    """Which pattern voters vote toxic."""
    if not text:
        return [False] * len(PATTERNS)
    hundreds = max(1, text.count(" ") + 1) / 100
    return [sum(1 for _ in p.finditer(text)) >= least * max(hundreds, 0.2) for _, p, least in PATTERNS]


def shingle_minima(text: str | None, salts=(0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)) -> list[int]:
    """Four min-hashes over word triples: near copies share at least one almost surely."""
    from xxhash import xxh64_intdigest

    tokens = (text or "").split()
    grams = [" ".join(tokens[i:i + 3]) for i in range(max(1, len(tokens) - 2))]
    h = np.array([xxh64_intdigest(g) for g in grams], np.uint64)
    return [int(((h ^ (h >> np.uint64(29))) * np.uint64(s)).min() >> np.uint64(1)) for s in salts]


@dataclass
class Model:
    """A fitted scorer: pattern voters first, then the units of the lexicon, of which none begins another."""

    lexicon: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = -20.0
    def unit(self, word: str) -> int | None:
        return next((self.lexicon[u] for u in units(word) if u in self.lexicon), None)

    @functools.cached_property
    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for u, i in self.lexicon.items():
            found.add_word(u.rstrip("~"), (len(u.rstrip("~")), u.endswith("~"), i))
        found.make_automaton()
        return found

    def hits(self, low: str) -> list[int]:
        """The units of the words of a lower-cased text, one entry per hit, without looking at words that hold none."""
        out = []
        for end, (size, begins, i) in self.automaton.iter(low):
            before, after = low[end - size:end - size + 1] if end >= size else "", low[end + 1:end + 2]
            if not _WORD.match(before) and bool(_WORD.match(after)) == begins:
                out.append(i)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w for w, on in zip(self.weights, fired(text)) if on)
        if self.lexicon and text:
            low = text.lower()
            found = self.hits(low)
            if found:
                root = density(1.0, len(_WORD.findall(low)))
                z += root * sum(self.weights[len(PATTERNS) + u] for u in found)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def families(votes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Voters that fire together in the rows labelled toxic, as lists of columns; voters that do not lean to those rows
    belong to none."""
    a, b = weight * label, weight * (1 - label)
    leaning = np.flatnonzero((a @ votes + 0.5) / (a.sum() + 1) > 1.5 * (b @ votes + 0.5) / (b.sum() + 1))
    on, w = votes[label == 1][:, leaning], weight[label == 1]
    shifted = (on - np.average(on, axis=0, weights=w) if len(on) else on) * np.sqrt(w)[:, None]
    scale = np.sqrt(np.maximum((shifted**2).sum(axis=0), 1e-9))
    together = shifted.T @ shifted / np.outer(scale, scale) > FAMILY
    of = np.arange(len(leaning))
    for i, j in zip(*np.nonzero(np.tril(together, -1))):
        of[of == of[i]] = of[j]
    return [leaning[of == f] for f in np.unique(of)]


def label_model(votes: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 100):
    """(posterior that a row is toxic, rates (way, voter), (rate of label 1 in clean, in toxic rows)) from 0/1
    votes; way 0 is clean, every other is toxic in the manner of one family of voters."""
    groups = families(votes, label, weight)
    ways = max(len(groups), 1)
    support = np.stack([votes[:, g].sum(axis=1) for g in groups], 1) if groups else np.zeros((len(label), 1))
    share = (support + 0.02) / (support + 0.02).sum(axis=1, keepdims=True)
    toxic = share * np.where(label == 1, 0.9, 0.05)[:, None]
    post = np.hstack([1 - toxic.sum(axis=1, keepdims=True), toxic])
    for _ in range(rounds):
        w = weight[:, None] * post
        mix = w.sum(axis=0) + np.array([CLEAN] + [0.5 / ways] * ways)
        rates = (w.T @ votes + 0.05) / (w.sum(axis=0)[:, None] + 1)
        right = ((w[:, 0] @ label + 0.05) / (w[:, 0].sum() + 1), max((w[:, 1:].sum(axis=1) @ label + 0.5) / (w[:, 1:].sum() + 1), 0.5))
        # Correlation that the ways do not explain: such voters share their evidence.
        residual = (votes - post @ rates) * np.sqrt(weight)[:, None]
        cov = residual.T @ residual
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        shared = np.maximum(np.abs(cov / np.outer(scale, scale)) - 0.1, 0)
        np.fill_diagonal(shared, 0)
        trust = 1 / (1 + shared.sum(axis=1))
        q = np.array([right[0]] + [right[1]] * ways)
        z = np.log(mix / mix.sum()) + (votes * trust) @ np.log(rates).T + ((1 - votes) * trust) @ np.log(1 - rates).T
        z += label[:, None] * np.log(q) + (1 - label[:, None]) * np.log(1 - q)
        new = np.exp(z - z.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - post).max() < 1e-6
        post = new
        if done:
            break
    return 1 - post[:, 0], rates, right


def voters(density_: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Votes of every unit under the bound of its density that tells the labels apart best."""
    a, b = weight * label, weight * (1 - label)
    best, out = np.full(density_.shape[1], -np.inf), np.zeros_like(density_)
    for bound in BOUNDS:
        on = (density_ >= bound).astype(float)
        p1, p0 = (a @ on + 0.5) / (a.sum() + 1), (b @ on + 0.5) / (b.sum() + 1)
        told = p1 * np.log(p1 / p0) + (1 - p1) * np.log((1 - p1) / (1 - p0))
        better = told > best
        best[better], out[:, better] = told[better], on[:, better]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Newton steps of a ridge logistic regression on soft labels; the last column is the bias."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, grad)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _near_copies(seen: DataFrame) -> DataFrame:
    """(copy_key, alike): the most rows that share a min-hash with the row."""
    of = seen.select("key", F.posexplode("minima").alias("salt", "minimum"))
    sizes = of.groupBy(F.col("salt").alias("__salt"), F.col("minimum").alias("__minimum")).agg(F.count("*").alias("alike"))
    met = of.join(sizes, (F.col("salt") == F.col("__salt")) & (F.col("minimum") == F.col("__minimum")))
    return met.groupBy(F.col("key").alias("copy_key")).agg(F.max("alike").alias("alike"))


def _tally(batches: Iterator) -> Iterator:
    """Per task: unit, weighted hits and rows in toxic (a, rows_a) and clean rows (b, rows_b)."""
    import pandas as pd

    def handed(sums: dict):
        return pd.DataFrame([(u, *v) for u, v in sums.items()], columns=["unit", "a", "b", "rows_a", "rows_b"])

    sums: dict[str, list[float]] = {}
    for batch in batches:
        for y, weight, own, counts in zip(batch["y"], batch["weight"], batch["words"], batch["counts"]):
            of_row: dict[str, int] = {}
            for word, n in zip(own, counts):
                for u in units(word):
                    of_row[u] = of_row.get(u, 0) + int(n)
            for u, n in of_row.items():
                v = sums.setdefault(u, [0.0, 0.0, 0.0, 0.0])
                v[1 - int(y)] += weight * n
                v[3 - int(y)] += weight
            if len(sums) > TALLY:
                yield handed(sums)
                sums = {}
    yield handed(sums)


def _lexicon(train: DataFrame, rows0: float, rows1: float, words0: float, words1: float) -> dict[str, int]:
    """Units whose rows lean to toxic beyond chance (log-likelihood ratio, corrected for the number of units tried),
    best first; of units that begin one another the best counts, of equal ones the longest."""
    stats = written(
        train.select("y", "weight", "words", "counts").mapInPandas(_tally, "unit string, a double, b double, rows_a double, rows_b double")
        .groupBy("unit").agg(*[F.sum(c).alias(c) for c in ("a", "b", "rows_a", "rows_b")]), "toxicity-units")
    tried = stats.count()
    odds = F.log((F.col("a") + 0.5) / (words1 + 1)) - F.log((F.col("b") + 0.5) / (words0 + 1))
    share = (F.col("rows_a") + F.col("rows_b")) / (rows0 + rows1)

    def part(seen: Column, of: Column) -> Column:
        return F.when(seen > 1e-9, seen * F.log(seen / of)).otherwise(0.0)

    ratio = 2 * (part(F.col("rows_a"), rows1 * share) + part(F.col("rows_b"), rows0 * share)
                 + part(rows1 - F.col("rows_a"), rows1 * (1 - share)) + part(rows0 - F.col("rows_b"), rows0 * (1 - share)))
    leaning = (
        stats.withColumn("odds", odds).where(F.col("odds") > ODDS).where(F.col("rows_a") / rows1 > F.col("rows_b") / rows0)
        .where(ratio > 2 * np.log(max(tried, 1) / CHANCE)).withColumn("rank", F.round(F.col("odds") * F.sqrt("rows_a"), 6))
        .orderBy(F.desc("rank"), F.desc(F.length(F.rtrim(F.col("unit"), F.lit("~")))), "unit").limit(16 * LEXICON).collect())
    out: dict[str, int] = {}
    bare: list[str] = []
    for r in leaning:
        own = r["unit"].rstrip("~")
        if len(out) < LEXICON and not any(own.startswith(b) or b.startswith(own) for b in bare):
            out[r["unit"]] = len(out)
            bare.append(own)
    return out


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows (smallest hashes of their keys; of rows that repeat a key the one
    with the smallest digest of its text).

    Rows with a null key or label are no training rows; repeated labels of a key count as their
    maximum.  If one class is missing, every score is the smoothed share of toxic labels."""
    from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

    chosen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("k")).agg(F.max(F.col(label)).cast("int").alias("y"))
        .orderBy(F.xxhash64("k"), "k").limit(sample))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("key") == F.col("k")).groupBy("key", "y").agg(F.min_by("text", digest(F.col("text"))).alias("text"))
    kind = StructType([
        StructField("key", rows.schema["key"].dataType), StructField("y", LongType()), StructField("n", LongType()),
        StructField("words", ArrayType(StringType())), StructField("counts", ArrayType(LongType())),
        StructField("fired", ArrayType(BooleanType())), StructField("minima", ArrayType(LongType()))])

    def features(batches):
        import pandas as pd

        for batch in batches:
            for i in range(0, len(batch), 256):  # word lists are much larger than their texts
                b = batch.iloc[i:i + 256]
                texts = [t if isinstance(t, str) else "" for t in b["text"]]
                found = [words(t) for t in texts]
                yield pd.DataFrame({
                    "key": b["key"].to_numpy(), "y": b["y"].to_numpy(), "n": [sum(c.values()) for c in found],
                    "words": [list(c) for c in found], "counts": [list(c.values()) for c in found],
                    "fired": [fired(t) for t in texts], "minima": [shingle_minima(t) for t in texts]})

    seen = written(rows.mapInPandas(features, kind), "toxicity-sample")
    copies = _near_copies(seen)
    train = written(seen.join(copies, F.col("key") == F.col("copy_key")).select(
        "key", "y", "n", "words", "counts", "fired", (1 / F.col("alike")).alias("weight")), "toxicity-weighted")
    one, none = F.col("weight") * F.col("y"), F.col("weight") * (1 - F.col("y"))
    n0, n1, w0, w1 = train.agg(F.sum(none), F.sum(one), F.sum(none * F.col("n")), F.sum(one * F.col("n"))).first()
    if not n0 or not n1:
        share = ((n1 or 0) + 0.5) / ((n0 or 0) + (n1 or 0) + CLEAN) if n0 or n1 else 1e-9
        return Model(bias=float(np.log(share / (1 - share))))
    lexicon = _lexicon(train, n0, n1, w0, w1)
    own = Model(lexicon)

    def found_units(batches):
        import pandas as pd

        for batch in batches:
            hits = [[(u, int(n)) for u, n in zip(map(own.unit, w), c) if u is not None] for w, c in zip(batch["words"], batch["counts"])]
            yield pd.DataFrame({"key": batch["key"].astype(str), "y": batch["y"], "n": batch["n"], "weight": batch["weight"], "fired": batch["fired"],
                                "unit": [[u for u, _ in h] for h in hits], "hits": [[n for _, n in h] for h in hits]})

    got = train.mapInPandas(found_units, "key string, y long, n long, weight double, fired array<boolean>, unit array<long>, hits array<long>").toPandas()
    got = got.sort_values("key", ignore_index=True)  # one order on every run
    hits = np.zeros((len(got), len(lexicon)))
    for i, (u, h) in enumerate(zip(got["unit"], got["hits"])):
        np.add.at(hits[i], np.asarray(u, int), np.asarray(h, float))
    dense = density(hits, got["n"].to_numpy(float)[:, None])
    patterns = np.array(got["fired"].tolist(), float).reshape(len(got), len(PATTERNS))
    weight, y = got["weight"].to_numpy(float), got["y"].to_numpy(float)
    post, _, _ = label_model(np.hstack([patterns, voters(dense, y, weight)]), y, weight)
    x = np.hstack([patterns, dense, np.ones((len(got), 1))])
    silent = np.append(np.zeros(x.shape[1] - 1), 1.0)
    w = _logistic(np.vstack([x, silent]), np.append(post, 0.0), np.append(weight, CLEAN))
    return Model(lexicon, w[:-1], float(w[-1]))


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to its toxicity, 0 to 1.  Null texts score like empty ones."""
    sent = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts):
        own = sent.value
        return texts.map(lambda t: own.score(t if isinstance(t, str) else None)).astype("float64")

    return score


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the key as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
