"""Named queries over the driver data directories.

Each entry takes ``(spark, sf_dir)``, derives the campaign tables from the
driver tables in ``sf_dir`` and returns the DataFrame of one step of the
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..config import DEFAULT
from ..operators.materialize import Store
from ..sources.bucketed import BucketedStore, with_buckets
from ..sources.fixtures import fixture_tables
from . import reports as R
from .pipeline import Monitor, run
from .refresh import between, refresh


def _on(build: Callable[[Monitor], DataFrame], **options) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = replace(DEFAULT, **options)
        return build(Monitor(fixture_tables(spark, sf_dir), cfg, Store(spark)))
    return run


def _as_csv(name: str, build: Callable[[Monitor], DataFrame]) -> Callable[[Monitor], DataFrame]:
    """A report as the CSV sink writes it, read back."""
    return lambda m: Store(m.store.spark, f"{m.store.root}/csv", "csv").put(name, build(m))


#: Buckets of the queries that keep letter results, payments and the base in buckets of the case.
BUCKETS = 16


def _in_buckets(build: Callable[[Monitor], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = BucketedStore(spark, BUCKETS)
        return build(Monitor(with_buckets(fixture_tables(spark, sf_dir), store), store=store))
    return run_query


#: The day up to which the run before a refresh knows its inputs.
REFRESHED_FROM = dt.date(2019, 12, 3)


def _refreshed(spark: SparkSession, sf_dir: str) -> Store:
    """The tables of a run that knew the inputs up to a day, refreshed with all of them."""
    tables, out = fixture_tables(spark, sf_dir), Store(spark).root
    run(between(tables, last=REFRESHED_FROM), out, partition_sinks=True)
    refresh(tables, out, REFRESHED_FROM)
    return Store(spark, out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_clients": _on(lambda m: m.clients()),
    "q02_product_groups": _on(lambda m: m.product_groups()),
    "q03_client_products": _on(lambda m: m.client_products()),
    "q04_provision": _on(lambda m: m.provision()),
    "q05_daily_provision_rate": _on(lambda m: m.daily_provision_rate()),
    "q06_monitor_base": _on(lambda m: m.base()),
    "q07_monitor_base_client": _on(lambda m: m.base_client()),
    "q08_monitor_payment": _on(lambda m: m.payment()),
    "q09_monitor_payment_cum": _on(lambda m: m.payment_cum()),
    "q10_daily_recovery": _on(lambda m: m.daily_recovery()),
    "a10_debt_paid": _on(lambda m: m.debt_paid()),
    "q11_repaid_clients": _on(lambda m: m.repaid_clients()),
    "q12_provision_coverage": _on(lambda m: m.provision_coverage()),
    "q13_provision_dump": _on(lambda m: m.shared("pre_lit_daily_provision").select("*")),
    "q14_distinct_channels": _on(lambda m: R.distinct_values(m.t.dc_product, "skp_product_channel")),
    "q15_distinct_product_codes": _on(lambda m: R.distinct_values(m.t.dc_product, "code_product")),
    # the options of the product join
    "q03_client_products_case": _on(lambda m: m.client_products(), product_join="case"),
    "q03_client_products_product_date": _on(lambda m: m.client_products(), product_join="product_date"),
    "q05_daily_provision_rate_case": _on(lambda m: m.daily_provision_rate(), product_join="case"),
    "q05_daily_provision_rate_product_date": _on(lambda m: m.daily_provision_rate(), product_join="product_date"),
    # distinct counts at three levels from one set of bitmaps
    "a07_distinct_rollup": _on(lambda m: m.distinct_rollup()),
    # orders, as a column
    "o01_repaid_clients_ranked": _on(lambda m: m.repaid_clients_ranked()),
    "o02_provision_coverage_ranked": _on(lambda m: m.provision_coverage_ranked()),
    # what the joins lose, and whether the sides they take to be N:1 are
    "d08_case_losses": _on(lambda m: m.case_losses()),
    "d08_payment_losses": _on(lambda m: m.payment_losses()),
    "d08_client_losses": _on(lambda m: m.client_losses()),
    "s_key_report": _on(lambda m: m.key_report()),
    # joins on the case over tables in buckets of it
    "q06_monitor_base_bucketed": _in_buckets(lambda m: m.base()),
    "q08_monitor_payment_bucketed": _in_buckets(lambda m: m.payment()),
    # a run of an earlier day, refreshed
    "k05_refreshed_payment_cum": lambda spark, sf_dir: _refreshed(spark, sf_dir).get("monitor_payment_cum"),
    "k07_refreshed_repaid_clients": lambda spark, sf_dir: _refreshed(spark, sf_dir).get("repaid_clients"),
    # the sinks, written and read back
    "k01_pre_lit_daily_provision": _on(lambda m: m.shared("pre_lit_daily_provision")),
    "k02_monitor_base": _on(lambda m: m.shared("monitor_base")),
    "k03_monitor_base_client": _on(lambda m: m.shared("monitor_base_client")),
    "k04_monitor_payment": _on(lambda m: m.shared("monitor_payment")),
    "k05_monitor_payment_cum": _on(lambda m: m.shared("monitor_payment_cum")),
    "k06_daily_recovery_csv": _on(_as_csv("daily_recovery", lambda m: m.daily_recovery())),
    "k07_repaid_clients_csv": _on(_as_csv("repaid_clients", lambda m: m.repaid_clients())),
}
