import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.llm import queries, toxicity
from tests.llm.helpers import docs

SF01 = "/root/testdata/sf0.1"


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(7)
    y = rng.random(5000) < 0.2
    rates = np.array([[0.8, 0.02], [0.6, 0.05], [0.7, 0.01], [0.3, 0.3]])
    votes = (rng.random((5000, 4)) < np.where(y[:, None], rates[:, 0], rates[:, 1])).astype(float)
    votes = np.hstack([votes, votes[:, 3:], votes[:, 3:]])  # a useless voter, three times
    noisy = np.where(rng.random(5000) < 0.15, ~y, y).astype(float)
    post, _, (clean, toxic) = toxicity.label_model(votes, noisy, np.ones(5000))
    assert ((post > 0.5) == y).mean() > 0.95 > (noisy == y).mean()
    assert abs(clean - 0.15) < 0.05 and abs(toxic - 0.85) < 0.1


def test_label_model_keeps_small_families():
    """A family of voters that fires in few rows is not taken for clean because the large one is silent there."""
    rng = np.random.default_rng(8)
    kind = rng.choice(3, 4000, p=[0.88, 0.1, 0.02])
    p = np.array([[0.002] * 6, [0.5] * 4 + [0.002] * 2, [0.002] * 4 + [0.8] * 2])
    votes = (rng.random((4000, 6)) < p[kind]).astype(float)
    label = np.where(rng.random(4000) < 0.05, kind == 0, kind > 0).astype(float)
    assert len(toxicity.families(votes, label, np.ones(4000))) == 2
    post, _, _ = toxicity.label_model(votes, label, np.ones(4000))
    for k in (1, 2):
        assert (post[kind == k] > 0.5).mean() > 0.9
    assert (post[kind == 0] > 0.5).mean() < 0.02


@pytest.fixture(scope="module")
def scored(spark):
    got = queries.op8_toxicity(spark, SF01).join(
        spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert ((got.score >= 0.3) == got.predicted.astype(bool)).all()
    return got[got.held_out & got.toxic.notna()]


@pytest.mark.parametrize("lang", ["en", "de", "es", "fr"])
def test_held_out_recall_of_each_language(scored, lang):
    own = scored[scored.lang == lang]
    assert (own[own.toxic == 1].predicted == 1).mean() >= 0.9
    assert (own[own.toxic == 0].predicted == 1).mean() <= 0.02


def test_held_out_precision(scored):
    assert (scored[scored.predicted == 1].toxic == 1).mean() > 0.95


def test_score_against_plain_sums():
    """The score is the stated sum over patterns and unit densities."""
    model = toxicity.Model({"scum": 0, "achli~": 1}, np.array([1.0, 0, 0, 0, 0, 2.0, 3.0]), -4.0)
    n = 8  # words
    root = 1 / np.sqrt(n / 100 + 0.5)
    z = -4 + 2 * 2 * root + 3 * 3 * root + 1.0
    text = "SCUM scum achlich achliches! ACHLICHE scums ABC ok"
    assert abs(model.score(text) - 1 / (1 + np.exp(-z))) < 1e-12
    assert model.score(text) == model.score(text)


def test_rows_are_bounded_by_keys(spark):
    """A repeated id brings one row, whatever the number of its rows."""
    df = spark.range(3000).selectExpr("7 AS doc_id", "concat('row ', id) AS text").union(train(spark).select("doc_id", "text"))
    labels = train(spark).selectExpr("doc_id", "toxic")
    assert toxicity.fit(df, labels).score("some moron and trash") > 0.5


def test_scores_see_text_only(spark):
    df = spark.createDataFrame([(i, "you idiot" if i % 4 == 0 else "a kind word", "s") for i in range(400)], "doc_id long, text string, source string")
    labels = df.selectExpr("doc_id", "cast(doc_id % 4 = 0 as int) AS toxic")
    score = toxicity.scorer(spark, queries.toxicity_model(df, labels))
    got = df.select("text", score("text").alias("s")).groupBy("text").agg(F.min("s"), F.max("s")).collect()
    assert all(r[1] == r[2] for r in got)


def train(spark, n=400):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        words = [f"w{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in rng.integers(0, 400, 40)]
        bad = i % 5 == 0
        if bad:
            words[3:3] = [str(w) for w in rng.choice(["scum", "moron", "trash"], 2, replace=False)]
        rows.append((i, " ".join(words), "s", int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, toxic int")


def test_copies_do_not_become_a_lexicon(spark):
    df = train(spark)
    same = " ".join(f"copy{chr(97 + i)}" for i in range(20))
    copies = spark.range(10_000, 10_300).selectExpr("id AS doc_id", f"concat('{same} ', id) AS text", "'s' AS source", "1 AS toxic")
    both = df.unionByName(copies)
    model = toxicity.fit(both, both.select("doc_id", "toxic"))
    assert model.score("some moron and trash") > 0.5
    assert model.score(same) < 0.3


def test_edge_cases(spark):
    own = docs(spark)
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (3, None), (99, 1)], "doc_id long, toxic int")
    for lab in (labels, labels.limit(0), spark.createDataFrame([(1, 1), (6, 0)], "doc_id long, toxic int")):
        score = toxicity.scorer(spark, toxicity.fit(own, lab))
        got = [r["s"] for r in own.select(score("text").alias("s")).collect()]
        assert len(got) == 11 and all(0 <= s <= 1 for s in got)
    assert docs(spark, []).select(toxicity.scorer(spark, toxicity.Model())("text")).count() == 0
    assert toxicity.Model().score("anything") < 1e-6
    df = spark.createDataFrame([(None,), (0,), (5,)], "doc_id long").select(toxicity.held_out(F.col("doc_id")).alias("h"))
    import zlib
    assert [r["h"] for r in df.collect()] == [False, zlib.crc32(b"0") % 4 == 2, zlib.crc32(b"5") % 4 == 2]
