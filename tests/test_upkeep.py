"""Averages over time, tables that a stream keeps up to date, replies set aside, sketches, long selections."""

from __future__ import annotations

import json
import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from hazeworks.operators import rollup as rl
from hazeworks.operators.hourly import alert_flags, hourly_avg, rolling_avg
from hazeworks.operators.selection import LONG_LIST, filter_selection, filter_stored
from hazeworks.plans import load as load_module
from hazeworks.plans.partials import Partials, spellings
from hazeworks.sinks.fact import FactStore
from hazeworks.sources import landed
from hazeworks.streaming.hourly import HourlyStream
from hazeworks.streaming.ingest import read_quarantine, start_ingest, start_reply_ingest, stream_raw, stream_replies

START = datetime(2026, 3, 1)
TABLES = ("rollup", "newest", "hours", "measured", "spellings")


def write_lines(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows), encoding="utf-8")


def plain_rows(df: DataFrame) -> list[str]:
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


# ------------------------------------------------------------------------------------------------ averages over time

def readings(spark, count=400):
    rng = random.Random(5)
    rows = [("seoul", START + timedelta(minutes=rng.randrange(0, 6000)), rng.randrange(1, 200)) for _ in range(count)]
    rows += [("seoul", START + timedelta(days=1, hours=h), 10) for h in range(-3, 4)]  # around the border of a piece
    rows += [("SEOUL", START + timedelta(days=1), 30), (None, START, 7), ("busan", None, 9), ("busan", START, None)]
    rows += [("hot", START, i % 50) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "city string, recorded_at timestamp, aqi int")


def shown(city):
    return "Unknown" if city is None else city.title()


def test_rolling_average_equals_brute_force(spark):
    rows, df = readings(spark)
    timed = [(shown(c), t, a) for c, t, a in rows if t is not None]
    expected = {}
    for city, at in {(c, t) for c, t, _ in timed}:
        window = [a for c, t, a in timed if c == city and at - timedelta(hours=2) <= t <= at and a is not None]
        count = sum(1 for c, t, _ in timed if (c, t) == (city, at))
        expected[city, at] = (count, sum(window) / len(window) if window else None)
    got = {(r["city"], r["recorded_at"]): (r["readings"], r["rolling_avg"]) for r in rolling_avg(df).collect()}
    assert got == expected
    small = {(r["city"], r["recorded_at"]): (r["readings"], r["rolling_avg"]) for r in rolling_avg(df, piece_hours=2).collect()}
    assert small == expected


def test_rolling_average_cuts_a_city_into_pieces(spark):
    _, df = readings(spark)
    plan = rolling_avg(df)._jdf.queryExecution().executedPlan().toString()
    window = next(line for line in plan.splitlines() if " Window " in line or "Window [" in line)
    assert "_piece" in window and "_piece" in plan.split("Window", 1)[1]
    with pytest.raises(ValueError):
        rolling_avg(df, hours=3, piece_hours=2)
    assert rolling_avg(df.limit(0)).collect() == []


def test_hourly_average_equals_brute_force(spark):
    rows, df = readings(spark)
    groups = {}
    for city, at, aqi in rows:
        hour = at and at.replace(minute=0)
        groups.setdefault((shown(city), hour), []).append(aqi)
    expected = {k: (len(v), sum(a for a in v if a is not None) / n if (n := sum(a is not None for a in v)) else None)
                for k, v in groups.items()}
    assert {(r["city"], r["hour"]): (r["readings"], r["avg_aqi"]) for r in hourly_avg(df).collect()} == expected


def test_alert_flags(spark):
    rows = [("a", 100, 35.0), ("b", 101, 35.5), ("c", 151, None), ("d", None, None)]
    flags = alert_flags(spark.createDataFrame(rows, "city string, aqi int, pm25 double")).orderBy("city").collect()
    assert [tuple(r)[3:] for r in flags] == [
        (False, False, False), (True, False, True), (True, True, False), (False, False, False)]


# ------------------------------------------------------------------------------------------------ hours of a stream

def at(hour, minute=0):
    return (START + timedelta(hours=hour, minutes=minute)).isoformat()


def test_stream_closes_the_hours_of_the_batch_and_notes_late_readings(spark, tmp_path):
    landing = tmp_path / "landing"
    stream = HourlyStream(spark, str(tmp_path / "hourly"), delay="2 hours")

    def run():
        for query in stream.start(stream_raw(spark, str(landing), max_files=1)):
            query.awaitTermination()

    write_lines(landing, "1.json", [{"city": "a", "aqi": str(10 + h), "recorded_at": at(h)} for h in range(6)])
    run()
    assert {r["hour"].hour for r in stream.hours().collect()} == {0, 1, 2}
    # A restart: one reading is behind but its hour is open; two come after their hour was closed.
    write_lines(landing, "2.json", [
        {"city": "a", "aqi": "50", "recorded_at": at(4, 30)}, {"city": "a", "aqi": "60", "recorded_at": at(0, 10)},
        {"city": "b", "aqi": "70", "recorded_at": at(1, 10)}, {"city": "a", "aqi": "-", "recorded_at": at(1)},
        {"city": "a", "aqi": "20", "recorded_at": at(12)}])
    run()
    got = {(r["city"], r["hour"].hour): (r["readings"], r["avg_aqi"]) for r in stream.hours().collect()}
    assert got == {("A", h): (1, 10.0 + h) for h in (0, 1, 2, 3, 5)} | {("A", 4): (2, 32.0)}
    late = {(r["city"], r["hour"].hour): (r["readings"], r["aqi_sum"]) for r in stream.late().collect()}
    assert late == {("A", 0): (1, 60), ("B", 1): (1, 70)}
    run()  # nothing new
    assert stream.late().count() == 2 and stream.hours().count() == 6


@pytest.mark.parametrize("hours", [list(range(60)), [0] * 50 + [9] * 10])  # with the latter, parts are empty
def test_hours_of_a_stream_are_landed_by_every_task(spark, tmp_path, monkeypatch, hours):
    rng, counts = random.Random(7), {}
    for file in range(4):
        rows = [(file * 1000 + i, rng.choice([START + timedelta(hours=h, minutes=i % 60), None] if i % 9 == 0 else
                                             [START + timedelta(hours=h, minutes=i % 60)]),
                 rng.choice([1, 2, 39, None]), "view", float(rng.randrange(1, 200))) for i, h in enumerate(hours * 3)]
        for number, time, user, _, value in rows:
            if time is not None and number % 17:
                city = "Unknown" if user in (39, None) else f"View (Zone {user})"
                counts.setdefault((city, time.replace(minute=0)), []).append(int(value))
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(
            1).write.mode("append").parquet(str(tmp_path / "tables" / "events.parquet"))
    monkeypatch.setattr(entry_module, "scratch_dir", lambda _: str(tmp_path / "scratch"))
    got = {(r["city"], r["hour"]): (r["readings"], r["avg_aqi"])
           for r in entry_module.stream_hourly(spark, str(tmp_path / "tables")).collect()}
    newest = max(hour for _, hour in counts)
    assert got == {(city, hour): (len(v), sum(v) / len(v)) for (city, hour), v in counts.items()
                   if hour + timedelta(hours=3) <= newest}
    landed = [f for f in (tmp_path / "scratch" / "landing").glob("*.json") if f.stat().st_size]
    parts = 3 if len(set(hours)) > 2 else 1
    assert len(landed) >= 4 * parts  # one of each file of the table, not one a part


# ------------------------------------------------------------------------------------------------ upkeep by a stream

def landed_rows(seed, count=60):
    rng = random.Random(seed)
    return [{"city": rng.choice(["Seoul", " busan ", "Jeju??", None]), "station": rng.choice(["s1", None]),
             "aqi": rng.choice(["12", "99.9", "151", "-"]), "pm25": rng.choice([1.5, "40", None]),
             "recorded_at": rng.choice([None, at(rng.randrange(100))])} for _ in range(count)]


def assert_as_rebuilt(partials: Partials, folder: str):
    fresh = Partials(partials.store, folder)
    fresh.rebuild()
    for name in TABLES:
        assert plain_rows(partials.read(name)) == plain_rows(fresh.read(name)), name
    assert plain_rows(partials.coverage()) == plain_rows(fresh.coverage())


def test_stream_keeps_the_small_tables(spark, tmp_path, monkeypatch):
    landing, store = tmp_path / "landing", FactStore(spark, str(tmp_path / "fact"))
    partials = Partials(store, str(tmp_path / "partials"))

    def run():
        start_ingest(stream_raw(spark, str(landing), max_files=1), store, str(tmp_path / "checkpoint"),
                     partials=partials).awaitTermination()

    for i in range(3):
        write_lines(landing, f"{i}.json", landed_rows(i))
    run()
    assert_as_rebuilt(partials, str(tmp_path / "one"))
    # A batch that is cut off between its two steps, and run again.
    write_lines(landing, "3.json", [*landed_rows(3), {"city": "new", "aqi": "5", "recorded_at": at(500)}])
    with monkeypatch.context() as patch:
        def lost(self, dates):
            raise RuntimeError("lost the driver")
        patch.setattr(Partials, "update", lost)
        with pytest.raises(Exception, match="lost the driver"):
            run()
    assert store.read().where("city = 'new'").count() == 1
    assert partials.read("spellings").where("stored = 'new'").count() == 0
    run()
    assert partials.read("spellings").where("stored = 'new'").count() == 1
    assert_as_rebuilt(partials, str(tmp_path / "two"))
    assert rl.overview(partials.read("rollup")).first()["records"] == store.read().count()


def test_load_without_readings_leaves_the_small_tables(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    empty = spark.createDataFrame([], landed.ingest(spark.createDataFrame([], landed.RESPONSE)).schema)
    result = load_module.load_raw(empty, store, allow_empty=True, partials=Partials(store, str(tmp_path / "partials")))
    assert result.batch_rows == 0 and not (tmp_path / "partials").exists()


# ------------------------------------------------------------------------------------------------ quarantine

def reply(feed, status="ok"):
    data = {"aqi": 50, "city": {"name": f"City {feed}"}, "iaqi": {}, "time": {"iso": at(1)}}
    return {"feed": feed, "status": status, "data": data if status == "ok" else "Unknown station"}


def test_rejected_replies_are_set_aside_once(spark, tmp_path, monkeypatch):
    landing, store = tmp_path / "landing", FactStore(spark, str(tmp_path / "fact"))
    quarantine, checkpoint = str(tmp_path / "quarantine"), str(tmp_path / "checkpoint")

    def run():
        start_reply_ingest(stream_replies(spark, str(landing), max_files=1), store, quarantine, checkpoint).awaitTermination()

    def counts():
        return store.read().count(), read_quarantine(spark, quarantine).count()

    write_lines(landing, "1.json", [reply("@1"), reply("@2", "error"), {"feed": "@3"}])
    run()
    assert counts() == (1, 2)
    # Cut off after the rejected replies were written, then run again.
    write_lines(landing, "2.json", [reply("@4"), reply("@5", "error"), reply("@6")])
    with monkeypatch.context() as patch:
        def lost(*_, **__):
            raise RuntimeError("lost the driver")
        patch.setattr("hazeworks.streaming.ingest.load_raw", lost)
        with pytest.raises(Exception, match="lost the driver"):
            run()
    assert counts() == (1, 3)
    run()
    assert counts() == (3, 3)
    rows = read_quarantine(spark, quarantine).orderBy("feed").collect()
    assert [(r["feed"], r["status"], r["batch"]) for r in rows] == [("@2", "error", 0), ("@3", None, 0), ("@5", "error", 1)]
    # A replay of everything: what landed is accepted or set aside, nothing twice.
    shutil.copytree(tmp_path / "fact", tmp_path / "kept")
    again = FactStore(spark, str(tmp_path / "kept"))
    start_reply_ingest(stream_replies(spark, str(landing), max_files=1), again, quarantine,
                       str(tmp_path / "second")).awaitTermination()
    assert (again.read().count(), read_quarantine(spark, quarantine).count()) == (3, 3)


# ------------------------------------------------------------------------------------------------ sketches

def test_sketched_coverage_of_date_ranges(spark, tmp_path):
    store = FactStore(spark, str(tmp_path / "fact"))
    store.create()
    days = [START + timedelta(days=d) for d in range(4)]
    rows = [(f"city {i % 900}", f"station {i}", "10", days[i % 4].isoformat()) for i in range(12_000)]
    raw = spark.createDataFrame(rows, "city string, station string, aqi string, recorded_at string").withColumns(
        {c: F.lit(None).cast("double") for c in ("pm25", "pm10", "o3", "no2", "co")}).withColumn(
        "dominant_pollutant", F.lit(None).cast("string"))
    partials = Partials(store, str(tmp_path / "partials"))
    load_module.load_raw(raw, store, partials=partials)
    fact = store.read()
    for first, last in ((None, None), (days[1].date(), days[2].date()), (days[3].date(), None)):
        chosen = fact if first is None else fact.where(F.to_date("recorded_at") >= F.lit(first))
        chosen = chosen if last is None else chosen.where(F.to_date("recorded_at") <= F.lit(last))
        exact = chosen.agg(F.count_distinct("city"), F.count_distinct("station")).first()
        estimate = partials.coverage(first, last).first()
        for measured, true in zip((estimate["cities"], estimate["stations"]), exact, strict=True):
            assert abs(measured - true) <= 0.03 * true
    plan = partials.coverage(days[1].date())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recorded_date" in plan and f"{tmp_path}/fact" not in plan
    assert partials.coverage(datetime(2030, 1, 1).date()).first()["cities"] == 0


# ------------------------------------------------------------------------------------------------ long selections

def test_long_selections_are_joined_and_not_collected(spark, monkeypatch):
    rows = [(f" city {i % 3000}", "Good", i) for i in range(6000)] + [(None, "Good", -1), ("", "Good", -2)]
    fact = spark.createDataFrame(rows, "city string, aqi_category string, aqi int")
    names = [f"City {i}" for i in range(0, 200_000, 2)] + ["Unknown"]
    assert len(names) > 100_000 > LONG_LIST
    kept = spellings(fact)
    with monkeypatch.context() as patch:
        def collected(self):
            raise AssertionError("collected")
        patch.setattr(DataFrame, "collect", collected)
        plans = [filter_stored(fact, names), filter_stored(fact, spark.createDataFrame([(n,) for n in names], "city string")),
                 filter_stored(fact, names, names_from=kept)]
    expected = sorted(a for c, _, a in rows if c in (None, "") or int(c.split()[1]) % 2 == 0)
    for plan in plans:
        assert "LeftSemi" in plan._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["aqi"] for r in plan.collect()) == expected
    short = filter_stored(fact, ["City 4", "Unknown"], names_from=kept)
    assert sorted(r["aqi"] for r in short.collect()) == sorted(filter_stored(fact, ["City 4", "Unknown"]).toPandas()["aqi"])
    shown_rows = spark.createDataFrame([("City 4", "Good"), ("City 5", "Good")], "city string, aqi_category string")
    assert [r["city"] for r in filter_selection(shown_rows, names).collect()] == ["City 4"]
