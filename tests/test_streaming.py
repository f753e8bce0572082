"""The streaming monitor emits exactly the closed windows of its batch twin."""

from pyspark.sql import functions as F

from tessera.sources.tables import table
from tessera.streaming import monitor as O
from conftest import SMOKE


def test_stream_equals_batch(spark):
    ev = table(spark, SMOKE, "events")
    base = O.fit_baseline(ev)
    stream = O.run_stream(spark, SMOKE, base, file_glob="events.parquet")
    batch = O.closed_windows(O.window_metrics(ev, base, watermark=None), ev)
    cols = sorted(batch.columns)
    a = sorted(tuple(r) for r in stream.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b and len(a) > 0


def test_restart_goes_on_where_the_stream_stopped(spark, tmp_path):
    """Half the events, stop, the rest into the same folders: the windows of one run, each once."""
    ev = table(spark, SMOKE, "events")
    base = O.fit_baseline(ev)
    src, out = str(tmp_path / "in"), str(tmp_path / "state")
    middle = ev.agg(F.expr("percentile_approx(unix_micros(ts::timestamp), 0.5)")).first()[0]
    early = F.expr(f"unix_micros(ts::timestamp) < {middle}")
    ev.where(early).coalesce(1).write.mode("append").parquet(src)
    first = O.run_stream(spark, src, base, out_dir=out).count()
    ev.where(~early).coalesce(1).write.mode("append").parquet(src)
    both = O.run_stream(spark, src, base, out_dir=out)
    want = O.closed_windows(O.window_metrics(ev, base, watermark=None), ev)
    cols = sorted(want.columns)
    assert sorted(map(tuple, both.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert 0 < first < both.count()


def test_unknown_classes_count_as_other(spark):
    ev = table(spark, SMOKE, "events")
    base = O.fit_baseline(ev)
    odd = ev.withColumn("event_type", F.when(F.col("event_type") == "view", "scroll").otherwise(F.col("event_type")))
    got = O.window_metrics(odd, base, watermark=None).orderBy("window_start").select("share_other", "mix_drift").collect()
    plain = O.window_metrics(ev, base, watermark=None).orderBy("window_start").select("share_view").collect()
    assert [round(r[0], 9) for r in got] == [round(r[0], 9) for r in plain]
    assert all(r["mix_drift"] > 0 for r in got)
