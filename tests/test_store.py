"""Sources and sinks: ingest of landed replies, files, the stored table, incremental ingest."""

from __future__ import annotations

import csv
import glob
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hazeworks.jobs import run
from hazeworks.operators.clean import clean
from hazeworks.operators.quality import EmptyBatchError
from hazeworks.plans.load import load_raw
from hazeworks.plans.session import configure, shuffle_partitions
from hazeworks.schemas import CLEAN, RAW, READING_COLUMNS
from hazeworks.sinks.fact import FactStore, batch_dates
from hazeworks.sinks.files import export_csv, stringify, write_clean_text, write_raw
from hazeworks.sources import landed
from hazeworks.sources.files import read_clean_text, read_raw
from hazeworks.sources.jdbc import connection_options
from hazeworks.sources.scratch import scratch_dir
from hazeworks.streaming.ingest import start_ingest, stream_raw, stream_responses


def reply(feed, name="S", aqi=50, iaqi=None, time="2026-05-14T21:00:00+07:00", **extra):
    data = {"aqi": aqi, "city": {"name": name}, "iaqi": iaqi or {}, "dominentpol": "pm25", "time": {"iso": time}}
    return {"feed": feed, "status": "ok", "data": {**data, **extra}}


REPLIES = [
    reply("@1", "Full", 57, {"pm25": {"v": 57}, "pm10": {"v": 18}, "o3": {"v": 36.8}, "no2": {"v": 9.3}, "co": {"v": 3.4},
                             "t": {"v": 20}}),
    reply("@2", "Part", "-", {"pm25": {"v": 5.5}}),
    {"feed": "@3", "status": "ok", "data": {"aqi": 7, "iaqi": {}, "time": {}}},
    {"feed": "@4", "status": "error", "data": "Unknown station"},
    {"feed": "@5"},
]


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    return str(folder)


def test_ingest_of_landed_replies(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", REPLIES)
    responses = landed.read_responses(spark, str(tmp_path / "in"))
    assert sorted(r["feed"] for r in landed.rejected(responses).collect()) == ["@4", "@5"]
    rows = {r["city"]: r.asDict() for r in landed.ingest(responses).collect()}
    assert set(rows) == {"Full", "Part", "@3"}
    assert rows["Full"] == {
        "city": "Full", "station": "Full", "aqi": "57", "pm25": 57.0, "pm10": 18.0, "o3": 36.8, "no2": 9.3,
        "co": 3.4, "dominant_pollutant": "pm25", "recorded_at": "2026-05-14T21:00:00+07:00"}
    assert rows["Part"]["aqi"] == "-" and rows["Part"]["pm10"] is None
    assert rows["@3"]["station"] == "@3" and rows["@3"]["recorded_at"] is None
    assert landed.ingest(responses).schema.names == RAW.names


def test_replies_as_text_equal_replies_as_files(spark, tmp_path):
    write_lines(tmp_path / "in", "a.json", REPLIES)
    from_files = landed.read_responses(spark, str(tmp_path / "in"))
    text = spark.createDataFrame([(json.dumps(r),) for r in REPLIES], "document string")
    assert sorted(map(str, landed.parse_responses(text).collect())) == sorted(map(str, from_files.collect()))


def test_unreadable_replies_are_rejected_not_lost(spark):
    text = spark.createDataFrame(
        [(None,), ("not json",), ('{"feed": "@1", "status": "ok", "data": [1]}',), ('{"status": "OK"}',)],
        "document string")
    responses = landed.parse_responses(text)
    assert responses.count() == 4
    assert landed.rejected(responses).count() == 3
    assert landed.ingest(responses).first()["city"] == "@1"


def test_feed_settings(spark):
    settings = spark.createDataFrame(
        [(1, " @1, ,seoul ,,@2 "), (2, None), (3, ""), (4, " , ")], "id int, feeds string")
    rows = [tuple(r) for r in landed.feed_list(settings, "feeds").orderBy("id", "position").collect()]
    assert rows == [(1, 0, "@1"), (1, 1, "seoul"), (1, 2, "@2"), (2, 0, "@1451")]


def raw_rows(spark, rows):
    return spark.createDataFrame(
        [(c, c, a, None, None, None, None, 0.5, "o3", t) for c, a, t in rows], RAW)


def test_raw_files_round_trip(spark, tmp_path):
    frame = raw_rows(spark, [("Meguro (目黒)", "57", "2026-05-14T22:00:00+09:00"), (None, None, None)])
    for _ in range(2):
        write_raw(frame, str(tmp_path / "raw"))
    assert sorted(map(str, read_raw(spark, str(tmp_path / "raw")).collect())) == sorted(map(str, frame.collect()))
    (tmp_path / "array.json").write_text(json.dumps([r.asDict() for r in frame.collect()]), encoding="utf-8")
    array = read_raw(spark, str(tmp_path / "array.json"), array_files=True)
    assert sorted(map(str, array.collect())) == sorted(map(str, frame.collect()))


def test_clean_text_round_trip(spark, tmp_path):
    frame = clean(raw_rows(spark, [("a", "57", "2026-05-14T22:00:00+09:00"), (None, "3", None)]))
    write_clean_text(frame, str(tmp_path / "clean"))
    lines = [json.loads(line) for f in glob.glob(f"{tmp_path}/clean/*.json") for line in open(f, encoding="utf-8")]
    assert all(v is None or isinstance(v, str) for line in lines for v in line.values())
    assert all(set(line) == set(CLEAN.names) for line in lines)
    assert {line["recorded_at"] for line in lines} == {"2026-05-14 13:00:00", None}
    back = read_clean_text(spark, str(tmp_path / "clean"))
    assert [f.dataType for f in back.schema] == [f.dataType for f in CLEAN]
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    assert [f.dataType.simpleString() for f in stringify(frame).schema] == ["string"] * 11


def test_csv_export(spark, tmp_path):
    frame = spark.createDataFrame(
        [(datetime(2026, 5, 14, 12), 'say "hi", you', None, 1.5), (None, " x ", 7, None)],
        "`Ingestion Timestamp` timestamp, Location string, AQI int, `PM2.5 (µg/m³)` double").coalesce(1)
    path = export_csv(frame, str(tmp_path), datetime(2026, 5, 14, 9, 8, 7))
    assert path.endswith("/export_20260514_090807")
    with open(glob.glob(f"{path}/*.csv")[0], encoding="utf-8", newline="") as handle:
        rows = list(csv.reader(handle))
    assert rows == [
        ["Ingestion Timestamp", "Location", "AQI", "PM2.5 (µg/m³)"],
        ["2026-05-14 12:00:00", 'say "hi", you', "", "1.5"], ["", " x ", "7", ""]]


BATCH = [("a", "10", "2026-05-14T10:00:00Z"), ("a", "11", "2026-05-14T11:00:00Z"), ("b", "12", "2025-03-04T11:30:00Z"),
         ("b", "13", None), (None, "14", "2026-05-14T10:00:00Z"), ("c", "-", "2026-05-14T10:00:00Z"),
         ("A ", "15", "2026-05-14T10:00:00Z")]


@pytest.mark.parametrize("catalog", [False, True])
def test_append_new_is_idempotent(spark, tmp_path, catalog):
    table = "readings_store_test" if catalog else None
    store = FactStore(spark, str(tmp_path / "fact"), table)
    try:
        store.create()
        store.create()
        assert store.read().count() == 0
        first = load_raw(raw_rows(spark, BATCH), store, fetched_at=datetime(2026, 5, 14, 12))
        assert (first.batch_rows, first.inserted_rows, first.skipped_rows) == (5, 5, 0)
        again = load_raw(raw_rows(spark, BATCH), store)
        assert (again.batch_rows, again.inserted_rows, again.skipped_rows) == (5, 0, 5)
        more = load_raw(raw_rows(spark, BATCH + [("z", "1", "2026-05-15T00:00:00Z")]), store)
        assert (more.inserted_rows, more.skipped_rows) == (1, 5)
        rows = store.read()
        assert rows.columns == list(READING_COLUMNS) and rows.count() == 6
        stamped = rows.where(F.col("fetched_at") == F.lit("2026-05-14 12:00:00").cast("timestamp"))
        assert stamped.count() == 5 and rows.where("fetched_at IS NULL").count() == 0
        folders = {f.rsplit("/", 1)[1] for f in glob.glob(f"{tmp_path}/fact/recorded_date=*")}
        assert folders == {"recorded_date=2026-05-14", "recorded_date=2025-03-04", "recorded_date=2026-05-15",
                           "recorded_date=__HIVE_DEFAULT_PARTITION__"}
    finally:
        if catalog:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_dates_of_a_batch_prune_the_table(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    load_raw(raw_rows(spark, BATCH), store)
    assert load_raw(raw_rows(spark, BATCH), store).inserted_rows == 0
    dates = batch_dates(clean(raw_rows(spark, BATCH)))
    assert dates.rows == 5 and dates.undated and date(2025, 3, 4) in dates.dates and date(2026, 5, 14) in dates.dates
    only_undated = batch_dates(clean(raw_rows(spark, [("q", "1", None)])))
    assert store.read_dates(only_undated).count() == 1


def test_a_batch_with_repeats_keeps_the_key_unique(spark, tmp_path):
    for name in ("one", "two"):
        run(spark, ["transform", write_lines(tmp_path / f"raw-{name}", "1.json", [
            {"city": "a", "aqi": "1", "recorded_at": "2026-05-14T00:00:00+00:00"},
            {"city": name, "aqi": "2", "recorded_at": None}]), str(tmp_path / "clean" / name)])
    done = run(spark, ["load", str(tmp_path / "clean" / "*"), str(tmp_path / "fact")])
    assert done == "inserted 3 rows, skipped 1 known ones"
    assert run(spark, ["load", str(tmp_path / "clean" / "*"), str(tmp_path / "fact")]) == (
        "inserted 0 rows, skipped 4 known ones")
    assert FactStore(spark, str(tmp_path / "fact")).read().count() == 3


def test_quoted_numbers_are_numbers(spark, tmp_path):
    path = write_lines(tmp_path / "raw", "1.json", [
        {"city": "a", "aqi": 7, "pm25": "12.5", "pm10": "-", "o3": 3, "no2": None, "co": 1e-3},
        {"city": "b", "aqi": "9", "pm25": 1.25}])
    rows = {r["city"]: r for r in read_raw(spark, path).collect()}
    assert (rows["a"]["aqi"], rows["a"]["pm25"], rows["a"]["pm10"], rows["a"]["o3"], rows["a"]["co"]) == (
        "7", 12.5, None, 3.0, 0.001)
    assert (rows["b"]["pm25"], rows["b"]["no2"]) == (1.25, None)
    reply = {"feed": "f", "status": "ok", "data": {"aqi": "5", "iaqi": {"pm25": {"v": "12.5"}, "o3": {"v": 2}, "co": {"v": "-"}}}}
    row = landed.ingest(landed.read_responses(spark, write_lines(tmp_path / "replies", "1.json", [reply]))).first()
    assert (row["pm25"], row["o3"], row["co"]) == (12.5, 2.0, None)


def test_exported_numbers_are_those_of_the_source(spark, tmp_path):
    rows = [(f"c{i}", str(i), None, v) for i, v in enumerate([71.7, 12345678.0, 0.1, 3.0])]
    raw = spark.createDataFrame(rows, "city string, aqi string, recorded_at string, pm25 double")
    for p in ("pm10", "o3", "no2", "co"):
        raw = raw.withColumn(p, F.lit(None).cast("double"))
    raw = raw.withColumns({"station": F.col("city"), "dominant_pollutant": F.lit(None).cast("string")})
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    load_raw(raw, store)
    for more, count in (["--rows", "0"], 4), (["--rows", "700"], 4), (["--city", "C0", "--city", "C3"], 2):
        path = run(spark, ["export", str(tmp_path / "fact"), str(tmp_path / f"out{count}{more[-1]}"), *more]).removeprefix("wrote ")
        values = [line[6] for f in glob.glob(f"{path}/*.csv")
                  for line in list(csv.reader(open(f, encoding="utf-8", newline="")))[1:]]
        assert len(values) == count and set(values) <= {"71.7", "12345678.0", "0.1", "3.0"}


def test_empty_batches_are_refused(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    nothing_valid = raw_rows(spark, [("c", "-", "2026-05-14T10:00:00Z")])
    with pytest.raises(EmptyBatchError):
        load_raw(nothing_valid, store)
    assert load_raw(nothing_valid, store, allow_empty=True).batch_rows == 0


def test_partition_dates_need_utc(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            store.append_new(clean(raw_rows(spark, BATCH)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def keys(frame):
    return sorted(str((r["city"], r["recorded_at"])) for r in frame.select("city", "recorded_at").collect())


@pytest.mark.parametrize("max_files", [None, 1])
def test_stream_gives_the_keys_of_the_batch(spark, tmp_path, max_files):
    landing, store = tmp_path / "landing", FactStore(spark, str(tmp_path / "fact"))

    def drain(checkpoint):
        start_ingest(stream_raw(spark, str(landing), max_files), store, str(tmp_path / checkpoint)).awaitTermination()

    to_rows = [dict(zip(("city", "aqi", "recorded_at"), r)) for r in BATCH]
    write_lines(landing, "1.json", to_rows[:2])
    write_lines(landing, "2.json", to_rows[1:4])
    drain("c1")
    assert store.read().count() == 4
    # A later file repeats known readings and brings one that is 14 months old.
    write_lines(landing, "3.json", to_rows + [{"city": "old", "aqi": "5", "recorded_at": "2025-03-04T18:00:00+06:30"}])
    drain("c1")
    expected = clean(raw_rows(spark, BATCH + [("old", "5", "2025-03-04T18:00:00+06:30")]))
    assert keys(store.read()) == keys(expected)
    drain("c2")
    assert keys(store.read()) == keys(expected)


def test_stream_of_replies_archives_what_it_read(spark, tmp_path):
    landing, store = tmp_path / "landing", FactStore(spark, str(tmp_path / "fact"))
    for i in range(3):
        write_lines(landing, f"{i}.json", REPLIES[:1] if i else REPLIES)
        stream = stream_responses(spark, str(landing), archive=str(tmp_path / "archive"))
        start_ingest(stream, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted(r["city"] for r in store.read().collect()) == ["@3", "full"]
    assert glob.glob(f"{tmp_path}/archive/**/*.json", recursive=True)


def test_jobs_run_the_chain(spark, tmp_path):
    raw, text, fact = (str(tmp_path / name) for name in ("raw.json", "clean", "fact"))
    rows = [dict(zip(("city", "aqi", "recorded_at"), r)) for r in BATCH]
    (tmp_path / "raw.json").write_text(json.dumps(rows), encoding="utf-8")
    assert run(spark, ["transform", raw, text, "--array-files"]) == "read 7 rows, 6 valid, wrote 5"
    assert run(spark, ["load", text, fact]) == "inserted 5 rows, skipped 0 known ones"
    assert run(spark, ["ingest", raw, fact, "--array-files"]) == "inserted 0 rows, skipped 5 known ones"
    write_lines(tmp_path / "replies", "1.json", REPLIES)
    assert run(spark, ["ingest", str(tmp_path / "replies"), fact, "--replies"]) == "inserted 2 rows, skipped 0 known ones"
    write_lines(tmp_path / "landing", "1.json", [*rows, {"city": "new", "aqi": "1", "recorded_at": None}])
    run(spark, ["stream", str(tmp_path / "landing"), fact, str(tmp_path / "checkpoint")])
    assert FactStore(spark, fact).read().count() == 8
    path = run(spark, ["export", fact, str(tmp_path), "--pollutant", "co", "--rows", "25"]).removeprefix("wrote ")
    with open(glob.glob(f"{path}/*.csv")[0], encoding="utf-8", newline="") as handle:
        lines = list(csv.reader(handle))
    assert len(lines) == 9 and "CO (ppm)" in lines[0]
    with pytest.raises(EmptyBatchError):
        write_lines(tmp_path / "none", "1.json", [])
        run(spark, ["transform", str(tmp_path / "none"), text])


def test_stored_table_answers_plain_sql(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"), "readings_sql_test")
    store.create()
    try:
        load_raw(raw_rows(spark, BATCH), store)
        rows = spark.sql("SELECT city, aqi, aqi_category, recorded_at FROM readings_sql_test LIMIT 10").collect()
        assert len(rows) == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS readings_sql_test")


def test_connection_settings():
    options = connection_options("db.internal", 3306, "d", "u", "p", fetchsize="7")
    assert options == {"url": "jdbc:mysql://db.internal:3306/d", "user": "u", "password": "p", "fetchsize": "7"}


def test_scratch_folder_is_below_the_shared_one(spark):
    one, two = scratch_dir(spark), scratch_dir(spark)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert one != two and one.startswith(shared) and two.startswith(shared)


def test_shuffle_partitions_follow_the_data():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(1024 ** 4, 800) == 4096
    assert shuffle_partitions(100 * 1024 ** 4, 8000) == 409_600


def test_settings_of_the_user_stay(monkeypatch):
    class Builder:
        def __init__(self, **options):
            self._options = options

        def config(self, key, value):
            return Builder(**self._options, **{key: value})

    key = "spark.sql.shuffle.partitions"
    assert key not in configure(Builder())._options
    assert configure(Builder(), shuffled_bytes=1 << 40)._options[key] == 4096
    assert configure(Builder(**{key: 4000}), shuffled_bytes=1 << 40)._options[key] == 4000
    monkeypatch.delenv("PYSPARK_GATEWAY_PORT", raising=False)
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", f"--conf {key}=4000 --conf spark.sql.adaptive.enabled=false pyspark-shell")
    options = configure(Builder(), shuffled_bytes=1 << 40)._options
    assert key not in options and "spark.sql.adaptive.enabled" not in options
