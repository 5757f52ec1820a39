from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandkit.operators.groups import daily_series
from demandkit.operators.series import Series, add_series_features
from demandkit.session import checkpointed, new_folder
from demandkit.sources import sinks, tables
from demandkit.streaming import daily


def test_csv_round_trip_and_sentinels(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("datetime,y,rain\n2014-10-1,3,--\n2014-10-2,,1.5\n2014-10-3,5,na\n")
    schema = StructType.fromDDL("datetime string, y int, rain double")
    got = tables.read_table(spark, str(path), schema, ["--", "na"]).collect()
    assert [tuple(r) for r in got] == [("2014-10-1", 3, None), ("2014-10-2", None, 1.5), ("2014-10-3", 5, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_table(spark, str(path), schema, ["--"]).collect()
    inferred = tables.read_table(spark, str(path), null_values=["--"])
    assert dict(inferred.dtypes)["rain"] == "string" and dict(inferred.dtypes)["y"] == "int"
    with pytest.raises(ValueError):
        tables.read_table(spark, str(path), null_values=["--", "na"])


def test_submission_file_format(spark, tmp_path):
    rows = [(dt.date(2014, 10, 2), 2.5), (dt.date(2014, 10, 1), 1.5), (dt.date(2014, 11, 28), -0.4)]
    df = spark.createDataFrame(rows, "ds date, p double")
    sinks.write_submission(df, str(tmp_path / "one"), "ds", "p", single_file=True)
    parts = list((tmp_path / "one").glob("part-*.csv"))
    assert len(parts) == 1 and parts[0].read_text() == "2014-10-1,2\n2014-10-2,2\n2014-11-28,0\n"
    sinks.write_submission(df, str(tmp_path / "many"), "ds", "p", integer=False)
    back = spark.read.csv(str(tmp_path / "many"))
    assert sorted(r[1] for r in back.collect()) == ["-0.4", "1.5", "2.5"]


def test_features_and_reports(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.write_features(df, str(tmp_path / "f"), partition_by=["k"])
    assert spark.read.parquet(str(tmp_path / "f")).filter("k = 'b'").first()["v"] == 2
    assert tables.shape(df).first().asDict() == {"n_rows": 2, "n_columns": 2}
    assert [r["type"] for r in tables.schema_table(df).orderBy("position").collect()] == ["string", "int"]
    assert [r["v"] for r in tables.head(df, 1, ["k"]).collect()] == [1]


def test_checkpoint_uses_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert new_folder(spark, "x").startswith(folder.rstrip("/"))
    assert checkpointed(spark.range(3)).count() == 3


def test_streams_equal_batch_over_many_files(spark, tmp_path):
    """Days arrive over several files and batches, with some rows late by hours."""
    rng = random.Random(1)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for d in range(14):
        for _ in range(rng.randrange(3, 9)):
            rows.append((rng.choice(["a", "b"]), start + dt.timedelta(days=d, seconds=rng.randrange(86400))))
    rows.sort(key=lambda r: r[1])
    for i in range(0, len(rows), 15):
        part = rows[i:i + 15]
        rng.shuffle(part)
        spark.createDataFrame(part, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    events = daily.read_stream(spark, str(tmp_path / "in"), max_files=2)
    days = daily.run_available(daily.daily_demand_stream(events, "ts", ["k"], "1 day"), "daily")
    closed = spark.read.parquet(days)
    batch = daily_series(spark.read.parquet(str(tmp_path / "in")), "ts", ["k"])
    newest = max(r[1] for r in rows)
    expected = batch.filter(F.col("ds") <= F.lit((newest - dt.timedelta(days=2)).date()))
    assert closed.exceptAll(expected).count() == 0 and expected.exceptAll(closed).count() == 0

    names = ["lag_1", "lag_5", "rolling_mean_5", "rolling_std_5", "lag_diff"]
    stream = daily.feature_stream(daily.read_closed_days(spark, days), "k", names)
    got = spark.read.parquet(daily.run_available(stream, "features"))
    wanted = add_series_features(expected, Series(("k",)), "y", names)
    shown = lambda df: sorted(
        str((r["k"], r["ds"], r["y"], *[None if r[n] is None else round(float(r[n]), 9) for n in names]))
        for r in df.collect()
    )
    assert shown(got) == shown(wanted)


def _scattered_events(spark, path, files):
    """Events of 20 days, dealt to files by hash: every file has rows of every day."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "ab"[i % 2], start + dt.timedelta(hours=i * 7919 % 480)) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp")
    df.repartition(files, "id").write.parquet(path)
    newest = max(r[2] for r in rows)
    whole = daily_series(df, "ts", ["k"])
    return whole.filter(F.col("ds") <= F.lit((newest - dt.timedelta(days=2)).date()))


def test_stream_over_a_folder_loses_nothing(spark, tmp_path):
    expected = _scattered_events(spark, str(tmp_path / "table"), 8)
    events = daily.read_stream(spark, str(tmp_path / "table"))
    out = daily.run_available(daily.daily_demand_stream(events, "ts", ["k"], "1 day"), "daily")
    closed = spark.read.parquet(out)
    assert closed.exceptAll(expected).count() == 0 and expected.exceptAll(closed).count() == 0


@pytest.mark.parametrize("cap", [1, 2])
def test_capped_stream_raises_instead_of_losing_rows(spark, tmp_path, cap):
    _scattered_events(spark, str(tmp_path / "table"), 8)
    events = daily.read_stream(spark, str(tmp_path / "table"), max_files=cap)
    stream = daily.daily_demand_stream(events, "ts", ["k"], "1 day")
    with pytest.raises(daily.LateRows):
        daily.run_available(stream, "daily")
    events = daily.read_stream(spark, str(tmp_path / "table"), max_files=cap)
    stream = daily.daily_demand_stream(events, "ts", ["k"], "1 day")
    assert spark.read.parquet(daily.run_available(stream, "daily", allow_late=True)).count() > 0


def test_late_rows_amend_their_day_and_replays_count_once(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "ab"[i % 2], start + dt.timedelta(hours=i * 7919 % 480)) for i in range(600)]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp")
    for n in range(3):  # every delivery has rows of every day
        df.where(F.col("id") % 3 == n).write.mode("append").parquet(source)
        daily.amend_days(spark.readStream.schema(df.schema).parquet(source), "ts", ["k"], out)
        so_far = daily_series(df.where(F.col("id") % 3 <= n), "ts", ["k"])
        got = daily.amended_days(spark, out, ["k"])
        assert got.exceptAll(so_far).count() == 0 and so_far.exceptAll(got).count() == 0
    # the last batch runs again, as after a failure between its write and its commit
    for name in ("2", ".2.crc"):
        (tmp_path / "out" / "state" / "commits" / name).unlink()
    daily.amend_days(spark.readStream.schema(df.schema).parquet(source), "ts", ["k"], out)
    got = daily.amended_days(spark, out, ["k"])
    assert got.exceptAll(so_far).count() == 0 and so_far.exceptAll(got).count() == 0


def test_days_in_any_order_within_the_delay(spark, tmp_path):
    rng = random.Random(3)
    days = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=d), rng.randrange(50)) for k in "abc" for d in range(24)]
    schema = "k string, ds date, y long"
    names = ["lag_1", "lag_5", "rolling_mean_5", "rolling_std_5", "lag_diff"]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    dealt = {}
    for row in days:
        dealt.setdefault(((row[1] - dt.date(2024, 1, 1)).days + rng.randrange(3)) // 6, []).append(row)
    for n in sorted(dealt):  # each delivery is a run of its own, from the checkpoint of the one before
        rng.shuffle(dealt[n])
        spark.createDataFrame(dealt[n], schema).repartition(3).write.mode("append").parquet(source)
        stream = daily.ordered_feature_stream(spark.readStream.schema(schema).parquet(source), "k", names, "4 days")
        with daily.rocksdb_state(spark):
            daily.run_available(stream, "ordered", out=out)
    got = spark.read.parquet(f"{out}/data")
    whole = add_series_features(spark.createDataFrame(days, schema), Series(("k",)), "y", names)
    wanted = whole.where(F.col("ds") <= F.lit(dt.date(2024, 1, 24) - dt.timedelta(days=4)))
    shown = lambda df: sorted(
        str((r["k"], r["ds"], float(r["y"]), *[None if r[n] is None else round(float(r[n]), 9) for n in names])) for r in df.collect()
    )
    assert shown(got) == shown(wanted)
    spark.createDataFrame([("a", dt.date(2024, 1, 2), 1)], schema).write.mode("append").parquet(source)
    stream = daily.ordered_feature_stream(spark.readStream.schema(schema).parquet(source), "k", names, "4 days")
    with daily.rocksdb_state(spark), pytest.raises(daily.LateRows):
        daily.run_available(stream, "ordered", out=out)
