"""The batch load: raw readings -> clean -> append what is new."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeworks.operators.clean import clean
from hazeworks.operators.quality import key_counts
from hazeworks.plans.partials import Partials
from hazeworks.sinks.fact import FactStore, LoadResult, batch_dates


def load_raw(
    raw: DataFrame,
    store: FactStore,
    *,
    fetched_at: datetime | None = None,
    allow_empty: bool = False,
    partials: Partials | None = None,
) -> LoadResult:
    """Clean a batch and append its new readings; then bring the small tables beside them up to date, if given.

    The dates to prune the table by come from hashed key counts over three columns, so the full rows
    are cleaned and shuffled once, by the write. A load that was cut off, even between the two steps, is run again:
    known keys are skipped, and the small tables of the batch's dates are computed from what is stored.
    """
    keys = key_counts(raw).where(F.col("valid_rows") > 0)
    dates = batch_dates(keys)
    result = store.append_new(clean(raw, keep_key=True), fetched_at=fetched_at, dates=dates, allow_empty=allow_empty)
    if partials is not None and dates.rows:
        partials.update(dates)
    return result
