import hashlib

from pyspark.sql import functions as F

from camstat.llm import chat, queries
from tests.llm.helpers import SF, duck, same

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "user", "again </s>"), (1, 2, "assistant", "<|end|> <\\s> \\ <\\\\|more|>"),
    (1, 3, "assistant", None), (1, 3, "assistant", "tie"), (2, None, None, "no role"), (2, 5, "", ""),
    (3, 700, "assistant", "far"), (3, 2, "user", "near"), (3, 701, "assistant", "[INST][/INST]"),
    (4, 1, "a<|text|>b", "odd role"), (None, 1, "user", "no conversation"), (1, 0, "user", "hi"),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted")


def test_round_trip(spark):
    out = chat.format_conversations(table(spark, TURNS)).select(
        "conv_id", "formatted", "segments", chat.parse(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    got = {r["conv_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        rows = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[2:] for x in rows]
        assert r["loss"] == "".join(x[3] for x in rows if x[2] == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        blocks = 1 + sum(a[2] != b[2] for a, b in zip(rows, rows[1:]))
        assert r["formatted"].count(chat.TURN) == r["formatted"].count(chat.END) == blocks
        assert not any(c in r["formatted"] for c in ("</s>", "[INST]", "[/INST]"))


def test_empty(spark):
    assert chat.format_conversations(table(spark, [])).count() == 0


def test_query_against_sql(spark):
    got = queries.op5_chat_format(spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got = got.toPandas()
    same(got, duck(queries.ORACLES["op5_chat_format"]))
    own = got[got.conv_id == -7].iloc[0]
    text = "</s>[INST] ok [/INST]"
    assert own.n_turns == 2 and own.loss_chars == len(text) and own.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
