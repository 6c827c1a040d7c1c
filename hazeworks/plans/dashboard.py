"""The monitoring refresh over stored readings.

Display names cost several string operations per value. Where an aggregate allows it, the plans here
reduce by *stored* name first, name the few rows left, and reduce again; selections are resolved to
stored names and filter those; where every row needs its name, names can be looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators import latest as lt
from hazeworks.operators import profile as pf
from hazeworks.operators import rollup as rl
from hazeworks.operators import selection as sl
from hazeworks.operators import series as sr
from hazeworks.operators import summary as sm
from hazeworks.operators.prepare import category_label, city_name, prepare, station_name


def latest_by_city(fact: DataFrame) -> DataFrame:
    """Latest reading per displayed city, unordered."""
    return lt.latest_per_city(prepare(lt.latest_per_city(fact)))


def newest_readings(fact: DataFrame, *within: str) -> DataFrame:
    """Latest reading per stored city and category, named: what any selection's latest rows come from."""
    newest = lt.latest_per(fact, *within, "city", "aqi_category")
    return prepare(newest, keep=within)


def _named_cities(fact: DataFrame) -> DataFrame:
    return fact.select("city").distinct().select(city_name(F.col("city")).alias("city"))


def distinct_cities(fact: DataFrame) -> DataFrame:
    return sl.distinct_values(_named_cities(fact), "city")


def distinct_categories(fact: DataFrame) -> DataFrame:
    labels = fact.select(category_label(F.col("aqi_category")).alias("aqi_category"))
    return sl.distinct_values(labels, "aqi_category")


def default_cities(fact: DataFrame, count: int = 3) -> DataFrame:
    return sl.first_values(_named_cities(fact), "city", count)


def network_coverage(fact: DataFrame) -> DataFrame:
    pairs = fact.select("city", "station").distinct()
    named = pairs.withColumn("city", city_name(F.col("city")))
    return sm.network_coverage(
        named.select("city", station_name(F.col("station"), F.col("city")).alias("station")))


def coverage_estimate_holds(fact: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """Whether the sketched counts of stored names are within the tolerance of the exact ones."""
    both = sm.network_coverage(fact).unionByName(sm.network_coverage_approx(fact))
    return both.agg(*[
        (F.max(c) - F.min(c) <= F.greatest(F.lit(2.0), F.max(c) * tolerance)).alias(f"{c}_close") for c in both.columns])


def monitoring_log(
    fact: DataFrame,
    pollutant: str = "pm25",
    max_rows: int | None = sr.LOG_SIZE,
    cities: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """The newest rows of a selection: top-k first, names afterwards. Without `max_rows` all rows, in no order."""
    chosen = sl.filter_stored(fact, cities, categories)
    return sr.log_table(prepare(sr.recent_readings(chosen, max_rows)), pollutant)


def city_series(fact: DataFrame, city: str, pollutant: str) -> DataFrame:
    """One pollutant of one displayed city, read by its stored spellings."""
    return sr.city_series(prepare(sl.filter_stored(fact, [city])), city, pollutant)


def pollutant_profile(fact: DataFrame, city: str) -> DataFrame:
    """The measured pollutants of a displayed city's latest reading, read by its stored spellings."""
    return pf.pollutant_profile(prepare(sl.filter_stored(fact, [city])), city)


def default_selection(fact: DataFrame, categories: Sequence[str] | None = None, count: int = 3) -> DataFrame:
    """Prepared readings of the first cities in sort order, the selection a monitor starts with."""
    cities = [row["city"] for row in default_cities(fact, count).collect()]
    return prepare(sl.filter_stored(fact, cities, categories))


def refresh(
    fact: DataFrame,
    *,
    cities: Sequence[str] | DataFrame | None = None,
    categories: Sequence[str] | None = None,
    first_cities: int | None = None,
    pollutant: str = "pm25",
    location: str | None = None,
    max_rows: int | None = sr.LOG_SIZE,
    row_limit: int | None = None,
    names: DataFrame | None = None,
    partials: DataFrame | None = None,
    newest: DataFrame | None = None,
    spellings: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every table of the monitor, lazily, for a selection of displayed cities and categories.

    None means no restriction; `first_cities=3` selects the first three cities, as a monitor starts. The selection is
    resolved to stored names once, here, and filters the stored columns. `row_limit` bounds all outputs to the newest
    rows (`operators.series.RECENT_LIMIT` gives the classic view); by default nothing is cut.

    Each table is a query of its own. A caller that shows many of them first writes small tables, `rollup(fact)` and
    `newest_readings(fact)`, and passes what it reads back as `partials` and `newest`; `names`, from
    `stored_names(fact)`, pays where most rows are shown; `spellings`, kept beside the store, spares a scan of the city
    column for each selection. Six tables then come from the rollup and five from the newest
    readings, the trend reads one hour, and only series and log still read the stored rows.
    """
    fact = sr.recent_readings(fact, row_limit)
    partials = rl.rollup(fact) if partials is None else partials
    newest = newest_readings(fact) if newest is None else newest
    if first_cities is not None:
        cities = [row["city"] for row in sl.first_values(partials, "city", first_cities).collect()]
    stored = sl.filter_stored(fact, cities, categories, spellings)

    def select(rows: DataFrame) -> DataFrame:
        return sl.filter_selection(rows, cities, categories)

    chosen, totals, candidates = prepare(stored, names), select(partials), select(newest)
    overview = rl.overview(totals)
    latest = lt.latest_per_city(candidates)
    trend = rl.trend(totals, chosen)
    tables = {
        "cities": sl.distinct_values(partials, "city"),
        "categories": sl.distinct_values(partials, "aqi_category"),
        "overview": overview,
        "kpi": sm.rounded(overview),
        "freshness": sm.shown_freshness(overview),
        "distribution": rl.distribution(totals),
        "latest": lt.by_aqi(latest),
        "latest_ascending": lt.by_aqi(latest, worst_first=False),
        "locations": sl.distinct_values(latest, "city"),
        "status": lt.status_panel(latest),
        "peak": lt.peak_city(latest),
        "gauge": lt.delta_to_threshold(lt.worst(latest)),
        "trend": trend,
        "trend_flag": sm.aqi_trend_flag(trend),
        # A chart needs no total order; `time_series` sorts where one is wanted.
        "series": sr.time_series(chosen, ordered=False),
        "log": sr.log_table(prepare(sr.recent_readings(stored, max_rows), names), pollutant),
    }
    if location is not None:
        tables["profile"] = pf.pollutant_profile(candidates, location)
        tables["pollutant_series"] = sr.city_series(
            prepare(sl.filter_stored(stored, [location], names_from=spellings)), location, pollutant)
    return tables
