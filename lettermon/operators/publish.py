"""Tables published together: readers see all of a run's tables or all of the run's before."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .materialize import Store

_POINTER = "seq long, version string, published timestamp"


class Versions:
    """Versions of a set of tables under ``root``, on any file system Spark writes.

    A run writes into a folder of its own (:meth:`begin`) and, when all its
    tables are there, appends one row that names it to a small pointer table
    (:meth:`publish`): one file, which a job either commits or not.  A run
    that fails before leaves only a folder that nothing names; readers
    (:meth:`read`) go on with the version before.  Nothing is overwritten, so
    a reader that has opened a version keeps it until it is cleared away.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _pointers(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_POINTER).parquet(f"{self.root}/published")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def history(self) -> list[str]:
        """Published versions, the newest first."""
        rows = self._pointers()
        if rows is None:
            return []
        return [r["version"] for r in rows.orderBy(F.desc("seq"), F.desc("published"), F.desc("version")).collect()]

    def current(self) -> str | None:
        return next(iter(self.history()), None)

    def path(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    def begin(self) -> Store:
        """A store for the tables of a new version, not yet published."""
        return Store(self.spark, self.path(uuid.uuid4().hex), self.fmt)

    def publish(self, store: Store) -> str:
        """Make the tables written to ``store`` the current version."""
        version = store.root.rsplit("/", 1)[1]
        rows = self._pointers()
        last = 0 if rows is None else rows.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        now = dt.datetime.now(dt.timezone.utc)
        self.spark.createDataFrame([(last + 1, version, now)], _POINTER).coalesce(1).write.mode("append").parquet(
            f"{self.root}/published")
        return version

    def read(self, name: str, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return Store(self.spark, self.path(version), self.fmt).get(name)

    def expired(self, keep: int = 2) -> list[str]:
        """Folders of published versions beyond the newest ``keep``, which may be deleted once no reader has them."""
        return [self.path(v) for v in self.history()[keep:]]
