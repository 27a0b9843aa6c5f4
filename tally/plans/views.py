"""Register the activity reports as session views (the source's view DDL)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tally.plans import loans as N

VIEW_NAMES = ("temp_acceleration_events", "temp_upsizes", "temp_loan_snapshots")


def register_activity_views(t: Mapping[str, DataFrame], as_of: dt.date,
                            with_collections: bool = True) -> dict[str, DataFrame]:
    """``createOrReplaceTempView`` for acceleration events, upsizes and snapshots.

    The snapshot view is the collections variant (with the date added to
    collections) unless ``with_collections`` is False. Views stay lazy: each
    query against them runs the report plan with the query's own filters.
    """
    snapshots = (N.loan_snapshots_collections(t, as_of) if with_collections
                 else N.loan_snapshots_current(t, as_of))
    frames = {
        "temp_acceleration_events": N.acceleration_events(t, as_of),
        "temp_upsizes": N.upsizes(t),
        "temp_loan_snapshots": snapshots,
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames
