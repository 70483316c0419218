"""Windows that late rows repair."""
import datetime as dt
import os
import random

from pyspark.sql import functions as F

from keelson.session import scratch_dir
from keelson.streaming import repair, run

T0 = dt.datetime(2024, 1, 1)
KIND = "id long, user long, ts timestamp_ntz, level string"


def _run(spark, parts, tmp, **options):
    stage, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    for rows in parts:
        spark.createDataFrame(rows, KIND).write.mode("append").parquet(stage)
        run.finish(repair.keep_windows(spark.readStream.schema(KIND).parquet(stage), "ts", out, ck, "10 seconds", ["user"],
                                       F.col("level") == "High", "30 seconds", 1, "n", **options))
        yield out


def _want(rows, closed):
    counts = {}
    for _, user, ts, level in rows:
        if level == "High" and ts is not None:
            w = ts.replace(second=ts.second // 10 * 10)
            counts[w, user] = counts.get((w, user), 0) + 1
    return sorted(((w, w + dt.timedelta(seconds=10), u, n) for (w, u), n in counts.items()
                   if n > 1 and w + dt.timedelta(seconds=10) <= closed), key=str)


def _got(spark, out):
    return sorted((tuple(r) for r in repair.read_windows(spark, out).collect()), key=str)


def test_late_rows_repair_their_windows_and_no_others(spark, tmp):
    rnd = random.Random(1)
    def rows(lo, hi, n):
        return [(rnd.randrange(10**6), rnd.choice([1, 2, None]), T0 + dt.timedelta(seconds=rnd.randrange(lo, hi)),
                 rnd.choice(["High", "High", "Low"])) for _ in range(n)]
    parts = [rows(0, 7200, 600) + [(1, 1, None, "High")], rows(7200, 14400, 600),
             [(7, 9, T0 + dt.timedelta(seconds=s), "High") for s in (100, 101, 5000)] + [(8, 1, T0 + dt.timedelta(seconds=103), "High")],
             [(9, 1, T0 + dt.timedelta(hours=6), "High")], [(10, 1, T0 + dt.timedelta(hours=1), "Low")]]
    seen = []
    for k, out in enumerate(_run(spark, parts, tmp)):
        seen += parts[k]
        newest = max(r[2] for r in seen if r[2] is not None and r[3] == "High")
        assert _got(spark, out) == _want(seen, newest - dt.timedelta(seconds=30))
    wrote = {r["batch_id"]: set() for r in spark.read.parquet(f"{out}/windows").select("batch_id").collect()}
    for r in spark.read.parquet(f"{out}/windows").collect():
        wrote[r["batch_id"]].add(r["window_start"])
    touched = T0 + dt.timedelta(seconds=100)
    assert touched in wrote[2] and wrote[2] <= {touched, T0 + dt.timedelta(seconds=5000)}
    late = repair.read_late(spark, out)
    assert late.count() == 4 and set(late.columns) == {"id", "user", "ts", "level"}


def test_a_replayed_batch_changes_nothing(spark, tmp):
    parts = [[(i, i % 2, T0 + dt.timedelta(seconds=i), "High") for i in range(200)],
             [(i, 0, T0 + dt.timedelta(seconds=i % 50), "High") for i in range(5)]]
    for out in _run(spark, parts, tmp):
        pass
    before = _got(spark, out)
    # the last batch's commit is lost: the query runs it again
    commits = f"{tmp}/ck/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    os.rename(f"{commits}/{last}", f"{tmp}/lost")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.rename(f"{commits}/.{last}.crc", f"{tmp}/lost.crc")
    q = repair.keep_windows(spark.readStream.schema(KIND).parquet(f"{tmp}/in"), "ts", out, f"{tmp}/ck", "10 seconds", ["user"],
                            F.col("level") == "High", "30 seconds", 1, "n")
    run.finish(q)
    assert _got(spark, out) == before


def test_an_empty_stream_has_no_windows(spark):
    root = scratch_dir(spark, "repair-empty")
    for out in _run(spark, [[]], root):
        assert _got(spark, out) == []
