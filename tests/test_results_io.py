"""Result analytics, run logs, run history, delimited text and streaming refresh."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from shelfline.plans import results as R
from shelfline.sources import io
from shelfline.plans.star import load_star
from shelfline.streaming.refresh import purchase_feed, stream_refresh
from tests.conftest import SF_SMALL

RUNS_SCHEMA = "run_ts timestamp, query_id int, status string, duration_ms double, rows_returned long"


def _runs(spark):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    rows = [(t1, 1, "OK", 100.0, 10), (t1, 2, "OK", 300.0, 5), (t1, 3, "ERROR: boom", 0.0, 0),
            (t2, 1, "OK", 50.0, 10), (t2, 2, "OK", 600.0, 5), (t2, 3, "TIMEOUT (5s)", 0.0, 0), (t2, 4, "OK", 70.0, 1)]
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def test_latest_status_slowest_failed_stats(spark):
    h = _runs(spark)
    latest = R.res_latest(h)
    assert sorted(r.query_id for r in latest.collect()) == [1, 2, 3, 4]
    assert latest.filter("query_id = 1").first().duration_ms == 50.0
    st = R.res_status(latest).first()
    assert (st.ok, st.errors, st.timeouts, st.total) == (3, 0, 1, 4)
    assert [r.query_id for r in R.res_slowest(latest, 2).collect()] == [2, 4]
    assert [r.query_id for r in R.res_failed(latest).collect()] == [3]
    s = R.res_stats(latest).first()
    assert (s.min_ms, s.max_ms, s.median_ms, s.fastest, s.slowest) == (50.0, 600.0, 70.0, 1, 2)


def test_compare_and_validate(spark):
    h = _runs(spark)
    a, b = h.filter("run_ts = '2026-01-01'"), h.filter("run_ts = '2026-01-02'")
    c = {r.query_id: r for r in R.res_compare(a, b).collect()}
    assert c[1].verdict == "faster" and c[1].improved == 1
    assert c[2].verdict == "slower" and c[2].regressed == 1
    assert c[3].verdict == "n/a" and c[4].verdict == "n/a"
    x = spark.createDataFrame([(1, 1.001), (2, 2.0)], "k int, v double")
    y = spark.createDataFrame([(2, 2.0), (1, 1.0)], "k int, v double")
    assert R.res_validate(x, y).count() == 0
    assert R.res_validate(x, spark.createDataFrame([(1, 1.5), (2, 2.0)], "k int, v double")).count() == 2


def test_log_timings(spark):
    d = tempfile.mkdtemp(prefix="logs-")
    with open(os.path.join(d, "q7.log"), "w") as f:
        f.write("plan...\nExecution Time: 12.5 ms\nmore\nExecution Time: 20.25 ms\n")
    with open(os.path.join(d, "q8.log"), "w") as f:
        f.write("ERROR: relation missing\n")
    got = {r.query_id: (r.duration_ms, r.status) for r in io.log_timings(spark, d + "/*.log").collect()}
    assert got == {7: (20.25, "OK"), 8: (None, "ERROR")}


def test_history_append_and_summary(spark):
    d = tempfile.mkdtemp(prefix="hist-")
    h = _runs(spark)
    io.append_history(h.filter("run_ts = '2026-01-01'"), d + "/history", d + "/summary")
    io.append_history(h.filter("run_ts = '2026-01-02'"), d + "/history", d + "/summary")
    assert spark.read.parquet(d + "/history").count() == 7
    assert spark.read.parquet(d + "/summary").count() == 4


def test_delimited_roundtrip_keeps_nulls(spark):
    d = tempfile.mkdtemp(prefix="delim-")
    df = spark.createDataFrame([(1, "a  ", None), (2, None, 3.5)], "k int, s string, x double")
    io.write_delimited(df, d + "/t")
    line = sorted(spark.read.text(d + "/t").collect())[0].value
    assert line.endswith("|")
    back = io.read_delimited(spark, d + "/t", df.schema).orderBy("k").collect()
    assert back[0].s == "a" and back[0].x is None and back[1].s is None and back[1].x == 3.5


def test_streaming_refresh_applies_feed(spark):
    st = load_star(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="stream-")
    feed = purchase_feed(st, 120)
    n = feed.count()
    feed.write.parquet(d + "/feed")
    q = stream_refresh(spark, st, d + "/feed", feed.schema, d + "/out", d + "/ck")
    q.awaitTermination(120)
    out = spark.read.parquet(d + "/out")
    assert out.count() == n and out.filter(F.col("ss_item_sk").isNull()).count() == 0


def test_streaming_refresh_replays_a_batch_without_doubling(spark):
    """A batch that was written but not committed runs again and replaces its rows."""
    import glob
    import os
    st = load_star(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="replay-")
    feed = purchase_feed(st, 120)
    n = feed.count()
    feed.write.parquet(d + "/feed")
    stream_refresh(spark, st, d + "/feed", feed.schema, d + "/out", d + "/ck").awaitTermination(120)
    for f in glob.glob(d + "/ck/commits/*") + glob.glob(d + "/ck/commits/.*"):
        os.unlink(f)
    stream_refresh(spark, st, d + "/feed", feed.schema, d + "/out", d + "/ck").awaitTermination(120)
    assert spark.read.parquet(d + "/out").count() == n
