"""Interval join: events that fall within a horizon after an anchor date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_horizon(anchors: DataFrame, events: DataFrame, keys: Sequence[str],
                   anchor_date: str, event_date: str, horizon_days: int) -> DataFrame:
    """Inner join of ``anchors`` and ``events`` on ``keys`` where
    ``anchor_date <= event_date <= anchor_date + horizon_days`` (both ends in).

    Plans as a sort-merge (or AQE broadcast) join on the equality keys with
    the date range as a residual condition, so it scales like an equi-join;
    a hot key is split by AQE's skew-join handling.  Output: all anchor
    columns plus the event columns that are not keys.
    """
    cond = [anchors[k] == events[k] for k in keys]
    cond += [
        events[event_date] >= anchors[anchor_date],
        events[event_date] <= F.date_add(anchors[anchor_date], horizon_days),
    ]
    rest = [events[c] for c in events.columns if c not in keys]
    return anchors.join(events, cond, "inner").select(*[anchors[c] for c in anchors.columns], *rest)
