import datetime as dt
import random

from strata.operators.health import volume_backfill
from strata.streaming.volume_checks import RUN_SCHEMA, read_checks, run_volume_checks

T0 = dt.datetime(2026, 1, 1, 12, 0, 0, 5)


def _run(name, k, count):
    return (name, f"{name}-{k:04d}", T0 + dt.timedelta(hours=7 * k), count)


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(sorted(df.columns)).collect())


def test_equals_the_backfill_across_batches_restarts_and_repetitions(spark, tmp_path):
    rng = random.Random(3)
    runs = [_run("hot", k, rng.randint(90, 110) * (20 if k % 17 == 0 else 1)) for k in range(100)]
    runs += [_run("rare", 40 * k, 7) for k in range(3)] + [_run("flat", 3 * k, 10**12) for k in range(34)]
    runs.sort(key=lambda r: r[2])
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    parts = [runs[:1], runs[1:50], runs[50:90] + runs[85:90], runs[88:]]
    for i, part in enumerate(parts):
        rng.shuffle(part)
        spark.createDataFrame(part, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        if i != 1:  # the second and third file arrive between two calls
            run_volume_checks(spark, src, out, ck, max_files_per_trigger=1)
    got, want = read_checks(spark, out), volume_backfill(spark.createDataFrame(runs, RUN_SCHEMA))
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want) and len(runs) == got.count() == 137
    found = {r.run_id: r for r in got.collect()}
    assert not found["hot-0017"].volume_ok and found["flat-0099"].volume_ok and found["flat-0099"].baseline_n == 30
    assert found["rare-0080"].volume_reason == "insufficient_history"


def test_late_runs_unfinished_rows_and_no_rows(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    first = [_run("a", k, 100) for k in (0, 1, 2, 4, 5)] + [("a", None, T0, 5), (None, "x", T0, 5), ("a", "y", None, 5), ("a", "z", T0, None)]
    for part in (first, [_run("a", 3, 500)], []):
        spark.createDataFrame(part, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        run_volume_checks(spark, src, out, ck)
    found = {r.run_id: r for r in read_checks(spark, out).collect()}
    assert sorted(found) == [f"a-{k:04d}" for k in range(6)]
    late = found["a-0003"]
    assert (late.baseline_n, late.volume_ok) == (3, False) and found["a-0005"].baseline_n == 4
