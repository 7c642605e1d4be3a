"""Reconciliation decisions against a plain per-file reference of the rule
table (D1-D6 / E), on random exports."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from camstat.operators.reconcile import decide

IDS = ["P1_C_x_1", "P1_C_x_2", "Q7_C_y_1", "10", "9", "77"]
SPECIES = [None, "Moose", "Caribou"]


def numeric(i):
    return i.lstrip("+-").isdigit()


def reference_rule(rows):
    r1 = [(i, s or "None") for o, i, s in rows if o == 1]
    r2 = [(i, s or "None") for o, i, s in rows if o == 2]
    n1, n2 = len(r1), len(r2)
    all_none = all(s == "None" for _, s in r1 + r2)
    n_num = sum(numeric(i) for i, _ in r1 + r2)
    if n1 == n2 and Counter(r1) == Counter(r2):
        return "D1"
    if n1 == n2 == 1 and all_none and n_num == 2:
        return "D2"
    if n1 == n2 == 1 and all_none and n_num == 1:
        return "D3"
    if n2 == 0:
        return "D4"
    if n1 == 0:
        return "D5"
    if n1 != n2 and all_none and n_num == 1:
        return "D6"
    return "E"


row = st.tuples(st.sampled_from([1, 2]), st.sampled_from(IDS), st.sampled_from(SPECIES))
files = st.dictionaries(st.sampled_from([f"f{i}" for i in range(8)]), st.lists(row, min_size=1, max_size=4),
                        min_size=1, max_size=8)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files)
def test_decide_matches_reference(spark, data):
    rows = [(f, o, i, s) for f, rs in data.items() for o, i, s in rs]
    df = spark.createDataFrame(rows, "source_file string, orig int, id string, species string")
    got = {r.source_file: r.rule for r in decide(df, ["source_file"]).collect()}
    assert got == {f: reference_rule(rs) for f, rs in data.items()}


times = st.lists(st.tuples(st.sampled_from([0, 1, 2]), st.integers(0, 20_000)), min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times, st.sampled_from([60, 600, 3600]), st.sampled_from([30, 900, 1800]))
def test_sessionize_matches_sequential_scan(spark, pts, bucket, gap):
    from pyspark.sql import functions as F

    from camstat.operators.windows import sessionize
    rows = [(k, n, t) for n, (k, t) in enumerate(pts)]
    df = spark.createDataFrame(rows, "key int, id int, sec long").withColumn("ts", F.timestamp_seconds("sec"))
    got = {r.id: r.session for r in sessionize(df, ["key"], "ts", gap, ["id"], bucket_seconds=bucket).collect()}
    ref = {}
    for k in {k for k, _, _ in rows}:
        seq = sorted((t, n) for kk, n, t in rows if kk == k)
        s, prev = 0, None
        for t, n in seq:
            if prev is None or t - prev >= gap:
                s += 1
            ref[n] = s
            prev = t
    assert got == ref
