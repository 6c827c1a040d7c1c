"""Physical plans: what must hold for the same queries on a large cluster."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from hazeworks.operators import latest as lt
from hazeworks.operators import series as sr
from hazeworks.operators import summary as sm
from hazeworks.operators.clean import clean
from hazeworks.operators.dedup import dedup_readings
from hazeworks.operators.prepare import prepare, stored_names
from hazeworks.operators.rollup import rollup
from hazeworks.operators.rollup import trend as rl_trend
from hazeworks.operators.upsert import new_readings
from hazeworks.plans import dashboard as db
from hazeworks.sinks.fact import BatchDates, FactStore

QUERIES = {k: q for k, q in entry_module.queries().items() if k not in entry_module.corpus_queries()}
WRITING = {"scan_raw", "scan_clean", "scan_fact", "append_twice", "stream_ingest"} | {n for n in QUERIES if n.endswith("_from_partials")}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(plan, kind="hashpartitioning"):
    return len(re.findall(rf"Exchange {kind}\(", plan))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    store = FactStore(spark, str(tmp_path_factory.mktemp("store") / "fact"))
    store.create()
    store.append_new(entry_module.clean_batch(spark, sf_dir, keep_key=True))
    return store


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop", "ExistingRDD"):
        assert operator not in plan


def test_dedup_limits_keys_before_the_shuffle(spark, sf_dir):
    plan = plan_of(dedup_readings(entry_module.raw(spark, sf_dir), ["reading_id"]))
    assert exchanges(plan) == 1
    below = plan[plan.index("Exchange"):]
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", below)


def test_hot_key_sends_one_row_per_task(spark):
    rows, tasks = 30_000, 6
    hot = spark.range(0, rows, 1, tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id"))).alias("city"),
        F.lit("2026-01-01T00:00:00Z").alias("recorded_at"), F.lit("s").alias("station"),
        F.col("id").cast("string").alias("aqi"), *[F.lit(1.0).alias(p) for p in ("pm25", "pm10", "o3", "no2", "co")],
        F.lit("o3").alias("dominant_pollutant"))
    result = clean(hot)
    assert result.count() == rows * 2 // 3 + 1
    execution = result._jdf.queryExecution()
    execution.toRdd().count()
    written = shuffled_rows(execution.executedPlan())
    assert written <= rows * 2 // 3 + tasks


def test_hot_city_sends_one_row_per_task(spark):
    rows, tasks = 30_000, 6
    city = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 50))
    latest = lt.latest_per_city(spark.range(0, rows, 1, tasks).select(
        city.alias("city"), F.timestamp_seconds("id").alias("fetched_at"),
        F.timestamp_seconds("id").alias("recorded_at"), F.lit("s").alias("station"),
        F.col("id").cast("int").alias("aqi")))
    assert latest.where("city = 'hot'").first()["aqi"] == (rows - 1) // 3 * 3
    execution = latest._jdf.queryExecution()
    execution.toRdd().count()
    assert shuffled_rows(execution.executedPlan()) <= 51 * tasks


def test_one_ingestion_time_is_still_sorted_by_many_tasks(spark):
    rows = 20_000
    load = spark.range(0, rows, 1, 6).select(
        F.lit("2026-05-14 12:00:00").cast("timestamp").alias("fetched_at"), F.lit(1).alias("aqi"),
        F.lit("one").alias("city"), F.timestamp_seconds("id").alias("recorded_at"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        spread = sr.time_series(load).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in spread) < rows / 3


def shuffled_rows(plan):
    """Rows written by the first shuffle of an executed adaptive plan."""
    node = plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan
    stack = [node]
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("ShuffleQueryStage"):
            node = node.shuffle()
            return node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    raise AssertionError("no shuffle")


def test_upsert_shuffles_each_side_once(spark, sf_dir, store, no_broadcast):
    readings = entry_module.raw(spark, sf_dir).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    batch = clean(readings, carry=["fetched_at"], tie_breaker=["reading_id"], keep_key=True)
    plan = plan_of(new_readings(batch, store.read()))
    assert "SortMergeJoin" in plan and exchanges(plan) == 2


def test_table_reads_only_what_is_needed(spark, store):
    dates = BatchDates(1, (date(2024, 1, 5),), True)
    plan = plan_of(store.read_dates(dates).where(F.col("city") == "x").select("aqi"))
    assert re.search(r"PartitionFilters: \[\(recorded_date#\d+ IN|PartitionFilters: \[\(\(?recorded_date", plan)
    assert "EqualTo(city,x)" in plan and "ReadSchema: struct<city:string,aqi:int>" in plan


def test_aggregates_read_only_their_columns(spark, store):
    assert "ReadSchema: struct<aqi_category:string>" in plan_of(sm.category_distribution(prepare(store.read())))
    assert "ReadSchema: struct<aqi:int,pm25:float>" in plan_of(sm.kpi_summary(prepare(store.read())))
    assert "ReadSchema: struct<aqi:int,fetched_at:timestamp>" in plan_of(sm.aqi_trend(prepare(store.read())))


def test_trend_runs_a_shuffled_input_once(spark, sf_dir):
    trend = sm.aqi_trend(entry_module.prepared(spark, sf_dir))
    trend.collect()
    assert "ReusedExchange" in trend._jdf.queryExecution().executedPlan().toString()


def test_top_k_never_sorts_the_table(spark, store):
    fact = store.read()
    latest = db.latest_by_city(fact)
    for frame in (sr.recent_readings(fact), db.monitoring_log(fact), prepare(sr.recent_readings(fact)),
                  lt.status_panel(latest), lt.peak_city(latest), db.default_cities(fact)):
        plan = plan_of(frame)
        assert "TakeOrderedAndProject" in plan and exchanges(plan, "rangepartitioning") == 0


def test_latest_aggregates_before_the_shuffle(spark, store):
    plan = plan_of(lt.latest_per_city(store.read()))
    assert "partial_max(struct" in plan and exchanges(plan) == 1


def test_names_are_computed_after_the_reduction(spark, store):
    for frame in (db.latest_by_city(store.read()), db.distinct_cities(store.read())):
        plan = plan_of(frame)
        first_name, last_exchange = plan.rindex("initcap"), plan.rindex("Exchange hashpartitioning(city")
        assert first_name < last_exchange


def test_rollup_is_a_hash_aggregation(spark, store):
    plan = plan_of(rollup(store.read()))
    assert "SortAggregate" not in plan and exchanges(plan) == 1


def scanned_rows(node):
    """Rows that the file scans of an executed plan gave, subqueries aside."""
    if node.nodeName().startswith("Scan parquet"):
        return [node.metrics().apply("numOutputRows").value()]
    if "AdaptiveSparkPlan" in node.nodeName():
        children = [node.finalPhysicalPlan()]
    elif "QueryStage" in node.nodeName():
        children = [node.plan()]
    else:
        children = [node.children().apply(i) for i in range(node.children().size())]
    return [rows for child in children for rows in scanned_rows(child)]


def test_trend_over_a_rollup_skips_old_rows(spark, store, tmp_path):
    fact = store.read()
    rollup(fact).write.parquet(str(tmp_path / "rollup"))
    partials = spark.read.parquet(str(tmp_path / "rollup"))
    trend = rl_trend(partials, fact)
    assert trend.first() == sm.aqi_trend(prepare(fact)).first()
    execution = trend._jdf.queryExecution()
    execution.toRdd().count()
    groups, recent = sorted(scanned_rows(execution.executedPlan()), reverse=True)
    assert groups == partials.count() and recent < fact.count() / 5


def test_name_lookup_lists_names_once(spark, store):
    named = prepare(store.read(), stored_names(store.read()))
    named.collect()
    plan = plan_of(named)
    assert "ReusedExchange" in plan and exchanges(plan, "rangepartitioning") == 0


def test_selections_reach_the_file_scan(spark, store):
    fact = store.read()
    city = db.distinct_cities(fact).first()["city"]
    tables = db.refresh(fact, cities=[city], categories=["Good"], location=city)
    for frame in (db.city_series(fact, city, "pm25"), db.pollutant_profile(fact, city), db.default_selection(fact),
                  db.monitoring_log(fact, cities=[city]), *(tables[t] for t in ("series", "log", "pollutant_series"))):
        pushed = [line for line in plan_of(frame).splitlines() if "PushedFilters" in line]
        assert pushed and all("city" in line.split("PushedFilters")[1] for line in pushed)
        assert "SortMergeJoin" not in plan_of(frame)


def test_long_form_does_not_shuffle(spark, store):
    from hazeworks.operators.profile import pollutant_long
    plan = plan_of(pollutant_long(prepare(store.read())))
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan


def test_recent_rows_skip_old_row_groups(spark, store, tmp_path):
    from hazeworks.plans.partials import Partials
    from hazeworks.sinks.fact import batch_dates

    partials = Partials(store, str(tmp_path / "partials"))
    partials.update(batch_dates(store.read()))
    recent = partials.recent_readings(20)
    assert recent.collect() == sr.recent_readings(store.read(), 20).collect()
    execution = recent._jdf.queryExecution()
    execution.toRdd().count()
    assert max(scanned_rows(execution.executedPlan())) < store.read().count() / 5
    partials.update(batch_dates(store.read()))  # again: nothing twice
    assert partials.read("hours").agg({"rows": "sum"}).first()[0] == store.read().count()
