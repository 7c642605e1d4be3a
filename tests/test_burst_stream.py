import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from camstat.operators import windows as W
from camstat.plans import windows_q as Q
from camstat.sources import adapters as S
from camstat.streaming import bursts as B

T0 = dt.datetime(2024, 6, 1, 12, 0, 0)


def table(spark, rows):
    return spark.createDataFrame([(k, None if s is None else T0 + dt.timedelta(seconds=s), c, i) for i, (k, s, c) in enumerate(rows)],
                                 "camera_id long, date_time timestamp_ntz, confidence double, obs_id long")


def ids(df):
    return sorted(r["obs_id"] for r in df.select("obs_id").collect())


def test_replay_equals_the_batch_rule(spark, sf, tmp_path):
    o = S.observations(spark, sf).select("obs_id", "camera_id", "date_time", "confidence")
    got = B.replay_bursts(o, str(tmp_path), ["camera_id"], "date_time", Q.BURST_THR, gap_seconds=Q.GAP_S)
    want = W.expand_bursts(o, ["camera_id"], "date_time", Q.BURST_THR, burst_gap_seconds=Q.GAP_S, tiebreak=["obs_id"])
    assert 0 < got.count() == want.count() < o.count()
    assert got.exceptAll(want.select(*o.columns)).count() == 0


def feed(spark, folder, rows, **kw):
    df = table(spark, rows)
    df.write.mode("append").parquet(f"{folder}/in")
    B.run_bursts(spark, f"{folder}/in", df.schema, f"{folder}/out", f"{folder}/state", ["camera_id"], "date_time", 0.5, **kw)
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def test_a_burst_is_emitted_once_an_image_passes(spark, tmp_path):
    """Across restarts: waiting images come out when the burst passes, later ones at once, others never."""
    base = str(tmp_path)
    assert ids(feed(spark, base, [(1, 0, 0.1), (1, 1, 0.2), (2, 0, 0.1), (2, 100, 0.9)], gap_seconds=2)) == [3]
    df = table(spark, [(1, 2.5, 0.9), (1, 3, 0.1), (2, 1, 0.3), (1, 50, 0.2)]).withColumn("obs_id", F.col("obs_id") + 10)
    df.write.mode("append").parquet(f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        B.run_bursts(spark, f"{base}/in", df.schema, f"{base}/out", f"{base}/state", ["camera_id"], "date_time", 0.5, gap_seconds=2)
    assert ids(spark.read.schema(df.schema).parquet(f"{base}/out")) == [0, 1, 3, 10, 11]


def test_late_images_and_odd_rows(spark, tmp_path):
    """The watermark is an hour behind; what comes later than that is dropped, also without key or instant."""
    base = str(tmp_path)
    feed(spark, base, [(1, 0, 0.1), (1, 20_000, 0.1), (None, 20_000, 0.9), (1, None, 0.9), (3, 20_000, None)], gap_seconds=2)
    df = table(spark, [(1, 1, 0.9), (1, 19_000, 0.9), (3, 20_001, 0.8)]).withColumn("obs_id", F.col("obs_id") + 10)
    df.write.mode("append").parquet(f"{base}/in")
    B.run_bursts(spark, f"{base}/in", df.schema, f"{base}/out", f"{base}/state", ["camera_id"], "date_time", 0.5, gap_seconds=2)
    assert ids(spark.read.schema(df.schema).parquet(f"{base}/out")) == [4, 11, 12]


def test_empty_table(spark, tmp_path):
    assert B.replay_bursts(table(spark, []), str(tmp_path), ["camera_id"], "date_time").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.floats(0, 1)), max_size=25), st.integers(1, 5), st.randoms(use_true_random=False))
def test_any_order_of_arrival(rows, gap, rnd):
    """Within the lateness the order of arrival and the cuts between batches change nothing."""
    own, out, at = B.Bursts(gap, 0.7), [], 0
    arrival = list(enumerate(rows))
    rnd.shuffle(arrival)
    while at < len(arrival):
        step = rnd.randint(1, 6)
        for i, (t, c) in arrival[at:at + step]:
            own.add(t, c, str(i))
        out += own.take()
        kept = own.state()
        own = B.Bursts(gap, 0.7)
        own.load(kept)
        at += step
    want, run, last = [], [], None
    for i, (t, c) in sorted(enumerate(rows), key=lambda r: r[1][0]):
        if last is not None and t - last >= gap:
            want += [i for i, _ in run] if any(c > 0.7 for _, c in run) else []
            run = []
        run.append((i, c))
        last = t
    want += [i for i, _ in run] if any(c > 0.7 for _, c in run) else []
    assert sorted(map(int, out)) == sorted(want)


@pytest.mark.parametrize("mark, left", [(0, 2), (4_999_999, 2), (5_000_000, 1), (12_000_000, 0)])
def test_bursts_close_a_gap_behind_the_watermark(mark, left):
    own = B.Bursts(2_000_000, 0.5)
    own.add(3_000_000, 0.1, "a")
    own.add(9_000_000, 0.1, "b")
    own.close(mark)
    assert len(own.open) == left
