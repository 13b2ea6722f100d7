"""The whole monitor: every dataset of one run, and the run that writes them.

:class:`Monitor` builds each dataset of the campaign monitor from one set of
input tables.  A dataset that several later steps read is written once to
a :class:`Store` and read back (the campaign SQL creates such datasets as
tables); a dataset read once stays inside the consumer's plan.  :func:`run`
writes all five tables of the campaign SQL into named sinks, then both
reports from them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.distinct import dense_numbers
from ..operators.materialize import Store
from ..operators.ordering import numbered
from ..operators.publish import Versions
from ..operators.quality import key_report
from ..sources.schemas import KEYS
from ..sources.tables import Tables
from . import monitor as M
from . import provision as P
from . import reports as R

SINKS = ("pre_lit_daily_provision", "monitor_base", "monitor_base_client", "monitor_payment",
         "monitor_payment_cum")


class Monitor:
    """Datasets of one monitor run.

    Methods named after a dataset return its plan.  A later step reads a
    dataset through :meth:`shared` when it is one of several readers (the
    dataset is then written to ``store`` on first use and read back) or
    through :meth:`stored` when it only needs the dataset once (a stored
    copy is used if there is one, else the plan).  With ``store=None``
    nothing is written and every step is one lazy plan.  ``work`` takes the
    datasets that are no sinks (default: ``store``).
    """

    def __init__(self, tables: Tables, cfg: C.MonitorConfig = C.DEFAULT,
                 store: Store | None = None, partition_by: dict | None = None,
                 work: Store | None = None):
        self.t, self.cfg, self.store, self.work = tables, cfg, store, work or store
        self.partition_by = partition_by or {}
        self._plans: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def _plan(self, name, build):
        if name not in self._plans:
            self._plans[name] = build()
        return self._plans[name]

    def shared(self, name: str) -> DataFrame:
        if self.store is None:
            return self.stored(name)
        if name not in self._stored:
            store = self.store if name in SINKS else self.work
            self._stored[name] = store.put(name, getattr(self, _BUILDERS[name])(),
                                           self.partition_by.get(name))
        return self._stored[name]

    def stored(self, name: str) -> DataFrame:
        if name in self._stored:
            return self._stored[name]
        return getattr(self, _BUILDERS[name])()

    # provision branch
    def clients(self):
        return self._plan("clients", lambda: P.clients(self.t, self.cfg))

    def product_groups(self):
        return self._plan("product_groups", lambda: P.product_groups(
            self.shared("clients"), self.t, self.cfg, keep_case=self.cfg.product_join == "case"))

    def client_products(self):
        return self._plan("client_products", lambda: P.client_products(
            self.shared("clients"), self.t, self.cfg, self.shared("product_groups")))

    def product_weights(self):
        return self._plan("product_weights", lambda: P.product_weights(
            self.shared("clients"), self.t, self.cfg, self.stored("product_groups")))

    def numbered_clients(self):
        """The clients table with dense numbers of cases and clients; without
        a store (nothing is written then) keys stand for themselves."""
        cl = self.shared("clients")
        if self.work is None:
            return cl
        return P.numbered_clients(cl, *self._numbers(cl, "clients"))

    def _numbers(self, rows, name):
        order = ["extraction_date", "property", "pilot"]
        return (dense_numbers(rows, "skp_credit_case", order, self.work, f"{name}_cases", "case_no"),
                dense_numbers(rows, "skp_client", order, self.work, f"{name}_clients", "client_no"))

    def provision(self):
        return self._plan("provision", lambda: P.provision(
            self.shared("numbered_clients"), self.t, self.cfg, self.shared("product_weights")))

    def daily_provision_rate(self):
        # the weights are read once, so they stay in the plan
        totals = P.provision_totals(self.shared("clients"), self.t, self.cfg, self.stored("product_weights"))
        return self._plan("rate", lambda: P.daily_provision_rate(totals, self.cfg))

    # letter base and payments
    def base(self):
        return self._plan("base", lambda: M.monitor_base(self.t, self.cfg))

    def base_client(self):
        return self._plan("base_client",
                          lambda: M.monitor_base_client(self.shared("monitor_base")))

    def payment(self):
        return self._plan("payment", lambda: M.monitor_payment(
            self.shared("monitor_base"), M.eligible_payments(self.t, self.cfg), self.cfg))

    def payment_cum(self):
        return self._plan("cum", lambda: M.monitor_payment_cum(self.stored("monitor_payment")))

    # reports
    def daily_recovery(self):
        base = self.shared("monitor_base")
        if "monitor_payment" in self._stored:
            payment = self._stored["monitor_payment"]
        else:  # read once: aggregate the pairs straight to segment x day
            payment = M.payment_pairs(base, M.eligible_payments(self.t, self.cfg), self.cfg)
        return R.daily_recovery(base, payment, self.cfg, self._stored.get("monitor_base_client"))

    def debt_paid(self):
        return R.debt_paid(self.stored("monitor_base_client"),
                           self.stored("monitor_payment_cum"))

    def repaid_clients(self):
        return R.repaid_clients(self.shared("monitor_base_client"), self.stored("monitor_payment_cum"),
                                self.stored("pre_lit_daily_provision"), self.cfg)

    def distinct_rollup(self):
        base = self.shared("monitor_base")
        numbered = P.numbered_clients(base, *self._numbers(base, "base"))
        return R.distinct_rollup(self.work.put("numbered_base", numbered))

    # audits: what the joins lose
    def case_losses(self):
        return M.case_losses(self.t, self.work, self.cfg)

    def payment_losses(self):
        return R.payment_losses(self.stored("monitor_payment"), self.work)

    def client_losses(self):
        return R.client_losses(self.stored("monitor_base_client"), self.stored("pre_lit_daily_provision"), self.work)

    def key_report(self):
        """How far the tables that joins take to have one row per key do."""
        reports = [key_report(self.t[n], n, keys) for n, keys in KEYS.items()]
        return reduce(DataFrame.unionByName, reports)

    # orders
    def repaid_clients_ranked(self):
        return R.ranked(self.repaid_clients(), self.work, "repaid_clients_ranked")

    def provision_coverage_ranked(self):
        order = [F.col("extraction_date"), F.col("property")]
        return numbered(self.provision_coverage(), order, self.work, "coverage_ranked", "report_rank")

    def provision_coverage(self):
        return R.provision_coverage(self.shared("pre_lit_daily_provision"))


_BUILDERS = {
    "clients": "clients",
    "numbered_clients": "numbered_clients",
    "product_groups": "product_groups",
    "product_weights": "product_weights",
    "pre_lit_daily_provision": "daily_provision_rate",
    "monitor_base": "base",
    "monitor_base_client": "base_client",
    "monitor_payment": "payment",
    "monitor_payment_cum": "payment_cum",
}


def run(tables: Tables, out: str, cfg: C.MonitorConfig = C.DEFAULT,
        report_format: str = "parquet", partition_sinks: bool = False,
        versioned: bool = False) -> dict[str, DataFrame]:
    """Build every table of the monitor into ``out`` (overwriting) and write
    the two reports next to them; returns the reports read back, report 2
    sorted.  Datasets that are no sinks go to ``<out>/_work``.  With
    ``report_format="csv"`` the reports have a header and ``\\N`` for NULL.

    With ``versioned`` the tables go to a folder of their own and become the
    current version of :class:`Versions` under ``out`` when both reports are
    there, so a run that fails leaves those of the run before.

    ``partition_sinks`` lays the case/client/payment tables out by
    ``extraction_date`` so readers of a date range prune folders."""
    spark = tables[next(iter(tables.names()))].sparkSession
    versions = Versions(spark, out) if versioned else None
    store = versions.begin() if versions else Store(spark, out)
    by_date = {n: ["extraction_date"] for n in SINKS if n != "pre_lit_daily_provision"}
    m = Monitor(tables, cfg, store, by_date if partition_sinks else None, Store(spark, f"{store.root}/_work"))
    for name in SINKS:
        m.shared(name)
    reports = {"daily_recovery": m.daily_recovery(), "repaid_clients": m.repaid_clients()}
    out_store = Store(spark, store.root, report_format)
    back = {name: out_store.put(name, df) for name, df in reports.items()}
    if versions:
        versions.publish(store)
    return {**back, "repaid_clients": R.in_report_order(back["repaid_clients"])}
