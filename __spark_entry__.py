"""

Every query runs over the whole `events` table, read as raw station readings.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hazeworks.functions import (  # noqa: E402
    category_of, category_of_range, to_float, to_instant, to_int, to_number,
)
from hazeworks.operators import clean as cl  # noqa: E402
from hazeworks.operators import hourly as hr  # noqa: E402
from hazeworks.operators import latest as lt  # noqa: E402
from hazeworks.operators import profile as pf  # noqa: E402
from hazeworks.operators import rollup as rl  # noqa: E402
from hazeworks.operators import series as sr  # noqa: E402
from hazeworks.operators import summary as sm  # noqa: E402
from hazeworks.operators import upsert as up  # noqa: E402
from hazeworks.operators.dedup import dedup_readings  # noqa: E402
from hazeworks.operators.lookup import with_category_color, with_pollutant_name  # noqa: E402
from hazeworks.operators.prepare import city_name, prepare, station_name, stored_names  # noqa: E402
from hazeworks.operators.quality import quality_counts  # noqa: E402
from hazeworks.operators.selection import filter_stored  # noqa: E402
from hazeworks.plans import dashboard as db  # noqa: E402
from hazeworks.plans.partials import Partials  # noqa: E402
from hazeworks.schemas import POLLUTANTS, RAW  # noqa: E402
from hazeworks.sinks.fact import FactStore, batch_dates  # noqa: E402
from hazeworks.sinks.files import export_rows, stringify, write_clean_text, write_raw  # noqa: E402
from hazeworks.sources import landed  # noqa: E402
from hazeworks.sources.events import readings_from_events, responses_from_readings  # noqa: E402
from hazeworks.sources.files import read_clean_text, read_raw  # noqa: E402
from hazeworks.sources.scratch import scratch_dir  # noqa: E402
from hazeworks.streaming.hourly import HourlyStream  # noqa: E402
from hazeworks.streaming.ingest import (  # noqa: E402
    read_quarantine, start_ingest, start_reply_ingest, stream_raw, stream_replies,
)
try:  # a separate part, which may be absent
    import corpus_pipeline
    from hazeworks.llm import queries as corpus
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "hazeworks.llm"):
        raise
    corpus = corpus_pipeline = None
from oracle_queries import CHOSEN_CATEGORIES, CHOSEN_CITY, CHOSEN_POLLUTANT, oracle_queries  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

raw = readings_from_events


def clean_batch(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    return cl.clean(
        raw(spark, sf_dir), carry=["fetched_at"], tie_breaker=["reading_id"], keep_key=keep_key)


# What the stored table holds once all readings are loaded.
fact = clean_batch


def stored_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the table held ten days before the newest reading: the history of the upsert queries."""
    readings = raw(spark, sf_dir)
    before = readings.agg(F.max("fetched_at") - F.expr("INTERVAL 10 DAYS")).scalar()
    earlier = readings.where(F.col("fetched_at") < before)
    return cl.clean(earlier, carry=["fetched_at"], tie_breaker=["reading_id"])


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(fact(spark, sf_dir))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed.parse_responses(responses_from_readings(raw(spark, sf_dir)))


def response_columns(replies: DataFrame) -> DataFrame:
    return replies.select(
        "feed", "status", F.col("data.aqi").alias("aqi"), F.col("data.city.name").alias("city_name"),
        *[F.col("data.iaqi")[p]["v"].try_cast("double").alias(p) for p in POLLUTANTS],
        F.col("data.dominentpol").alias("dominentpol"), F.col("data.time.iso").alias("iso"),
    )


def feed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    setting = F.when(F.col("reading_id") % 9 != 0, F.concat(
        F.lit(" @"), F.col("reading_id"), F.lit(" ,, "), F.coalesce("station", F.lit("")), F.lit(" ,")))
    return landed.feed_list(raw(spark, sf_dir).select("reading_id", setting.alias("feeds")), "feeds")


def file_rows(readings: DataFrame) -> DataFrame:
    iso = F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return readings.withColumn("recorded_at", iso).select(*RAW.names)


def raw_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_rows(raw(spark, sf_dir))


def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files: one with numbers, one with quoted ones."""
    path = scratch_dir(spark) + "/raw"
    rows = raw_file_rows(spark, sf_dir)
    quoted = F.col("pm10") > 50
    write_raw(rows.where(~F.coalesce(quoted, F.lit(False))), f"{path}/plain")
    write_raw(rows.where(quoted).withColumns({p: F.col(p).cast("string") for p in POLLUTANTS}), f"{path}/quoted")
    return read_raw(spark, f"{path}/*")


def plain_time(readings: DataFrame, *names: str) -> DataFrame:
    """UTC wall-clock columns, as the SQL twin has them."""
    return readings.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def scan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, path = cl.clean(raw(spark, sf_dir), tie_breaker=["reading_id"]), scratch_dir(spark) + "/clean"
    write_clean_text(rows, path)
    return plain_time(read_clean_text(spark, path), "recorded_at")


def scan_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, store = clean_batch(spark, sf_dir), FactStore(spark, scratch_dir(spark) + "/fact")
    store.create()
    store.append_new(batch)
    return plain_time(store.read(), "recorded_at", "fetched_at")


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after two loads, the second of which brings the first one's keys again."""
    store = FactStore(spark, scratch_dir(spark) + "/fact")
    store.create()
    store.append_new(stored_part(spark, sf_dir))
    store.append_new(clean_batch(spark, sf_dir, keep_key=True))
    return plain_time(store.read(), "recorded_at", "fetched_at")


def kept_partials(spark: SparkSession, sf_dir: str) -> Partials:
    """Stored readings and the small tables beside them, after two loads."""
    folder = scratch_dir(spark)
    store = FactStore(spark, f"{folder}/fact")
    store.create()
    partials = Partials(store, f"{folder}/partials")
    for batch in (stored_part(spark, sf_dir), clean_batch(spark, sf_dir)):
        dates = batch_dates(batch)
        store.append_new(batch, dates=dates)
        partials.update(dates)
    return partials


def on_partials(plan: Callable[[Partials], DataFrame], *times: str) -> Query:
    return lambda spark, sf_dir: plain_time(plan(kept_partials(spark, sf_dir)), *times)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys stored by a stream over several landed files, one file a batch."""
    folder = scratch_dir(spark)
    raw_file_rows(spark, sf_dir).repartition(3, "city").write.json(f"{folder}/landing")
    store = FactStore(spark, f"{folder}/fact")
    start_ingest(stream_raw(spark, f"{folder}/landing", max_files=1), store, f"{folder}/checkpoint").awaitTermination()
    return plain_time(store.read().select("city", "recorded_at"), "recorded_at")


def stream_with_partials(spark: SparkSession, sf_dir: str) -> Partials:
    """The small tables beside the store, kept up to date by a stream of several batches."""
    folder = scratch_dir(spark)
    raw_file_rows(spark, sf_dir).repartition(3, "city").write.json(f"{folder}/landing")
    store = FactStore(spark, f"{folder}/fact")
    partials = Partials(store, f"{folder}/partials")
    start_ingest(stream_raw(spark, f"{folder}/landing", max_files=1), store, f"{folder}/checkpoint",
                 partials=partials).awaitTermination()
    return partials


def overview_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What does not depend on which reading of a key came first."""
    measured = rl.overview(stream_with_partials(spark, sf_dir).read("rollup"))
    return measured.select("records", "cities")


def landed_replies(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    responses_from_readings(raw(spark, sf_dir)).repartition(3).select(F.col("document").alias("value")).write.text(
        f"{folder}/landing")
    return stream_replies(spark, f"{folder}/landing", max_files=1)


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies that a stream set aside, while it stored the others."""
    folder = scratch_dir(spark)
    store = FactStore(spark, f"{folder}/fact")
    start_reply_ingest(landed_replies(spark, sf_dir, folder), store, f"{folder}/quarantine",
                       f"{folder}/checkpoint").awaitTermination()
    return read_quarantine(spark, f"{folder}/quarantine").select("feed", "status")


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours that a stream closed over three runs, each of which finds a later part of the readings landed."""
    folder = scratch_dir(spark)
    readings, at = raw(spark, sf_dir), F.unix_timestamp("recorded_at")
    first, second = readings.agg(F.percentile_approx(at, [1 / 3, 2 / 3])).first()[0]
    stream = HourlyStream(spark, folder)
    # Every task writes its share of a part. The files of a part have no order, so a run takes all of them as one batch.
    for part in (at < first, (at >= first) & (at < second), at >= second):
        file_rows(readings.where(part)).write.mode("append").json(f"{folder}/landing")
        for query in stream.start(stream_raw(spark, f"{folder}/landing")):
            query.awaitTermination()
    return plain_time(stream.hours(), "hour")


def coverage_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month: exact numbers of cities and stations, and whether those from the kept sketches are within 3 % of them."""
    partials = kept_partials(spark, sf_dir)
    month = F.date_format("recorded_date", "yyyy-MM").alias("month")
    close = partials.coverage(by=month).withColumnsRenamed({"cities": "_cities", "stations": "_stations"})
    exact = partials._stored("rollup").groupBy(month).agg(
        F.count_distinct("city").alias("cities"), F.count_distinct("station").alias("stations"))
    return exact.join(close, "month").select("month", "cities", "stations", *[
        (F.abs(F.col(f"_{c}") - F.col(c)) <= 0.03 * F.col(c)).alias(f"{c}_close") for c in ("cities", "stations")])


def selection_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of very many chosen cities: every displayed name that has an even zone, among names that no city has."""
    stored = fact(spark, sf_dir)
    named = stored.select(city_name(F.col("city")).alias("city")).distinct()
    even = named.where(F.regexp_extract("city", r"(\d)", 1).isin("0", "2", "4", "6"))
    nobody = spark.range(100_000).select(F.concat(F.lit("Nowhere "), F.col("id")).alias("city"))
    return prepare(filter_stored(stored, even.unionByName(nobody)))


def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = raw(spark, sf_dir)
    text = F.when(F.col("reading_id") % 17 == 0, "x").otherwise(
        F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'"))
    texts = readings.select("reading_id", text.alias("recorded_at"))
    instant = to_instant("recorded_at", texts.schema["recorded_at"].dataType)
    return plain_time(texts.select("reading_id", instant.alias("recorded_at")), "recorded_at")


def on_raw(columns: Callable[[], list]) -> Query:
    # A function, since columns cannot be built before there is a session.
    return lambda spark, sf_dir: raw(spark, sf_dir).select("reading_id", *columns())


def on_fact(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(fact(spark, sf_dir))


def on_prepared(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(prepared(spark, sf_dir))


def on_latest(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(db.latest_by_city(fact(spark, sf_dir)))


def on_upsert(plan: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(clean_batch(spark, sf_dir, keep_key=True), stored_part(spark, sf_dir))


def on_responses(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(responses(spark, sf_dir))


def load_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was not deduplicated, against the table: every further reading of a key is skipped."""
    batch = cl.valid_readings(cl.type_readings(raw(spark, sf_dir), ["fetched_at"]))
    return up.load_counts(batch, stored_part(spark, sf_dir))


def filter_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fact(spark, sf_dir)
    return db.default_selection(stored, CHOSEN_CATEGORIES)


def entry(spark: SparkSession) -> DataFrame:
    """Latest reading of every city, worst first."""
    return queries()["latest_by_city"](spark, "/root/testdata/sf0.001")


def corpus_queries() -> dict[str, Query]:
    return {} if corpus is None else corpus.queries() | {"pipeline": corpus_pipeline.run}


def corpus_sql() -> dict[str, str]:
    if corpus is None:
        return {}
    whole = corpus_pipeline.ORACLE_SQL
    return corpus.oracle_sql() | ({"pipeline": whole} if whole else {})


def queries() -> dict[str, Query]:
    return corpus_queries() | {
        # Sources
        "ingest_responses": on_responses(response_columns),
        "ingest_ok": on_responses(lambda r: response_columns(landed.accepted(r))),
        "ingest_rejected": on_responses(lambda r: landed.rejected(r).select("feed", "status")),
        "ingest_flatten": on_responses(landed.ingest),
        "feed_list": feed_list,
        "scan_raw": scan_raw,
        "scan_clean": scan_clean,
        "scan_fact": scan_fact,
        "append_twice": append_twice,
        "stream_ingest": stream_ingest,
        "overview_from_stream": overview_from_stream,
        "stream_rejected": stream_rejected,
        "stream_hourly": stream_hourly,
        "hourly_from_partials": on_partials(lambda p: p.hourly_avg(), "hour"),
        "coverage_from_sketches": coverage_from_sketches,
        "overview_from_partials": on_partials(lambda p: rl.overview(p.read("rollup")), "last_seen"),
        "distribution_from_partials": on_partials(lambda p: rl.distribution(p.read("rollup"))),
        "latest_from_partials": on_partials(
            lambda p: lt.by_aqi(lt.latest_per_city(p.read("newest"))), "recorded_at", "fetched_at"),
        "recent_from_partials": on_partials(lambda p: p.recent_readings(2000), "recorded_at", "fetched_at"),
        # Cleaning
        "clean_city": on_raw(lambda: [cl.clean_city(F.col("city")).alias("city")]),
        "clean_station": on_raw(lambda: [cl.clean_station(F.col("station")).alias("station")]),
        "parse_event_time": parse_event_time,
        "cast_aqi": on_raw(lambda: [to_int(F.col("aqi")).alias("aqi")]),
        "cast_pollutants": on_raw(lambda: [to_float(F.col(p)).alias(p) for p in POLLUTANTS]),
        "aqi_band": lambda s, d: raw(s, d).select("reading_id", to_int(F.col("aqi")).alias("aqi")).withColumn(
            "aqi_category", category_of(F.col("aqi"))),
        "filter_valid_aqi": lambda s, d: cl.valid_readings(cl.type_readings(raw(s, d), ["reading_id"])),
        "dedup_readings": lambda s, d: dedup_readings(raw(s, d), ["reading_id"]),
        "clean": clean_batch,
        "quality_counts": lambda s, d: quality_counts(raw(s, d)),
        # Stored readings
        "stringify_clean": lambda s, d: stringify(cl.clean(raw(s, d), tie_breaker=["reading_id"])),
        "upsert_new": on_upsert(up.new_readings),
        "upsert_skipped": on_upsert(up.known_readings),
        "load_counts": on_upsert(up.load_counts),
        "load_repeats": load_repeats,
        "history_union": on_upsert(lambda batch, stored: up.history_union(stored, batch)),
        # Analysis form
        "prepare": prepared,
        "prepare_common_names": on_fact(lambda f: prepare(f, stored_names(f))),
        "display_name": on_raw(lambda: [city_name(F.col("city")).alias("city")]),
        "station_fallback": on_raw(lambda: [
            station_name(F.col("station"), city_name(F.col("city"))).alias("station")]),
        "aqi_band_range_join": lambda s, d: raw(s, d).select(
            "reading_id", to_number("aqi", RAW["aqi"].dataType).alias("aqi")
        ).withColumn("category", category_of_range(F.col("aqi"))),
        "category_lookup": on_prepared(lambda p: with_category_color(
            p.select("city", "fetched_at", "aqi_category"))),
        "pollutant_lookup": lambda s, d: with_pollutant_name(
            raw(s, d).select("reading_id", F.col("dominant_pollutant").alias("pollutant"))),
        # Selection
        "filter_selection": filter_selection,
        "selection_join": selection_join,
        "distinct_cities": on_fact(db.distinct_cities),
        "distinct_categories": on_fact(db.distinct_categories),
        "default_cities": on_fact(db.default_cities),
        # Monitoring
        "latest_by_city": on_latest(lt.by_aqi),
        "status_panel": on_latest(lt.status_panel),
        "peak_city": on_latest(lt.peak_city),
        "delta_to_threshold": on_latest(lt.delta_to_threshold),
        # Documented in the surveyed application's texts, not computed there.
        "alert_flags": on_latest(hr.alert_flags),
        "hourly_avg": lambda s, d: plain_time(hr.hourly_avg(fact(s, d)), "hour"),
        "rolling_avg_2h": lambda s, d: plain_time(hr.rolling_avg(fact(s, d)), "recorded_at"),
        "freshness": on_prepared(sm.freshness),
        "kpi_summary": on_prepared(sm.kpi_summary),
        "kpi_rounded": on_prepared(sm.kpi_rounded),
        "aqi_trend": on_prepared(sm.aqi_trend),
        "aqi_trend_flag": on_prepared(lambda p: sm.aqi_trend_flag(sm.aqi_trend(p))),
        "network_coverage": on_fact(db.network_coverage),
        "network_coverage_approx": on_fact(db.coverage_estimate_holds),
        "overview": on_fact(lambda f: rl.overview(rl.rollup(f))),
        "category_distribution": on_prepared(sm.category_distribution),
        # Lists, series, reshaping
        "recent_readings": on_fact(sr.recent_readings),
        "monitoring_log": on_fact(db.monitoring_log),
        "export_rows": on_fact(lambda f: export_rows(db.monitoring_log(f))),
        "time_series": on_prepared(sr.time_series),
        "city_series": on_fact(lambda f: db.city_series(f, CHOSEN_CITY, CHOSEN_POLLUTANT)),
        "pollutant_profile": on_fact(lambda f: db.pollutant_profile(f, CHOSEN_CITY)),
        "pollutant_long": on_prepared(pf.pollutant_long),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB twins."""
    return oracle_queries() | corpus_sql()
