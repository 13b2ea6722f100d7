"""Daily refresh: only what a new day can still change is built again.

Payments count for ``horizon_days`` after a letter, so on a given day only
the extraction dates of the last ``horizon_days`` can get further payments.
A refresh builds the case, client and payment tables (K02-K05) for those
dates alone and replaces just their folders; all older dates stay as they
are.  The daily rate is built anew: its many-to-many product join lets a new
case change the rate of any date.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.materialize import Store
from ..sources.schemas import DATED
from ..sources.tables import Tables
from . import reports as R
from .pipeline import SINKS, Monitor

BY_DATE = "extraction_date"
DATED_SINKS = tuple(n for n in SINKS if n != "pre_lit_daily_provision")


def between(tables: Tables, first: dt.date | None = None, last: dt.date | None = None) -> Tables:
    """The tables with only the rows of the days ``first`` to ``last``; tables without a day are whole."""
    def cut(name: str) -> DataFrame:
        df, day = tables[name], DATED.get(name)
        if day and first:
            df = df.where(F.col(day) >= F.lit(first))
        if day and last:
            df = df.where(F.col(day) <= F.lit(last))
        return df
    return Tables.from_frames({n: (lambda n=n: cut(n)) for n in tables.names()})


def open_since(as_of: dt.date, cfg: C.MonitorConfig = C.DEFAULT, late_days: int = 0) -> dt.date:
    """The first extraction date that may change after a run that knew all
    up to ``as_of``, if rows come at most ``late_days`` after their day."""
    return as_of - dt.timedelta(days=cfg.horizon_days + late_days)


def refresh(tables: Tables, out: str, as_of: dt.date, cfg: C.MonitorConfig = C.DEFAULT, late_days: int = 0,
            report_format: str = "parquet") -> dict[str, DataFrame]:
    """Bring the tables of an earlier ``run(..., partition_sinks=True)`` in
    ``out``, which knew all up to ``as_of``, to what ``tables`` say now.

    All tables are built aside first and then replace the folders of their
    dates, so a failure while building leaves ``out`` as it was.  A date that
    has lost all its rows loses its folder.  Returns both reports, rebuilt.
    """
    spark = tables[next(iter(tables.names()))].sparkSession
    since = open_since(as_of, cfg, late_days)
    later = replace(cfg, arms=tuple(replace(a, start=max(a.start, since)) for a in cfg.arms),
                    payment_start=max(cfg.payment_start, since))
    store = Store(spark, out)
    aside = Store(spark, f"{store.root}/_work/refresh-{uuid.uuid4().hex}")
    new = Monitor(between(tables, first=since), later, aside)
    built = {name: new.shared(name) for name in DATED_SINKS}
    whole = Monitor(tables, cfg, aside)
    rate = whole.shared("pre_lit_daily_provision")
    for name, df in built.items():
        _replace_dates(df, store.path(name), since)
    m = Monitor(tables, cfg, store, work=aside)
    m._stored.update({name: store.get(name, df.schema) for name, df in built.items()})
    m._stored["pre_lit_daily_provision"] = store.put("pre_lit_daily_provision", rate)
    reports = {"daily_recovery": m.daily_recovery(), "repaid_clients": m.repaid_clients()}
    out_store = Store(spark, out, report_format)
    back = {name: out_store.put(name, df) for name, df in reports.items()}
    return {**back, "repaid_clients": R.in_report_order(back["repaid_clients"])}


def _replace_dates(df: DataFrame, path: str, since: dt.date) -> None:
    """Put ``df`` in place of the dates from ``since`` on of the table in ``path``, laid out by date."""
    spark = df.sparkSession
    before = {r[0] for r in spark.read.schema(df.schema).parquet(path).where(F.col(BY_DATE) >= F.lit(since))
              .select(BY_DATE).distinct().collect()}  # a date each, of a window of days
    (df.hint("rebalance", BY_DATE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BY_DATE).parquet(path))
    gone = before - {r[0] for r in df.select(BY_DATE).distinct().collect()}
    for day in gone:  # a date without any row is not written, so its folder is taken away
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BY_DATE}={day.isoformat()}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
