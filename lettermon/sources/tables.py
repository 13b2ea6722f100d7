"""Input tables: one loader, declared types, light normalisation."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from ..operators.materialize import Store
from ..operators.quality import checked
from .schemas import EMPTY_AS_NULL, KEYS, SCHEMAS


def conform(df: DataFrame, name: str, zone: str | None = None) -> DataFrame:
    """Project ``df`` onto the declared schema of table ``name``.

    Only declared columns are kept (so the Parquet scan reads nothing else),
    each is cast to its declared type when it differs (a timestamp becomes
    its date, in ``zone`` if given, else in the session's time zone), and
    empty strings in free-text code columns become NULL.
    """
    blanks = EMPTY_AS_NULL.get(name, ())
    have = {f.name.lower(): f.dataType for f in df.schema.fields}
    cols = []
    for f in SCHEMAS[name].fields:
        is_type = have.get(f.name.lower())
        c = F.col(f.name)
        if zone and isinstance(is_type, TimestampType) and isinstance(f.dataType, DateType):
            c = F.to_date(F.convert_timezone(None, F.lit(zone), c))
        elif is_type != f.dataType:
            c = c.cast(f.dataType)
        if f.name in blanks:
            c = F.nullif(c, F.lit(""))
        cols.append(c.alias(f.name) if f.name in blanks or is_type != f.dataType else f.name)
    return df.select(*cols)


class Tables:
    """Named input DataFrames, conformed to :data:`SCHEMAS`.

    Build with :meth:`from_parquet` (one ``<root>/<name><suffix>`` file or
    folder per table), :meth:`from_catalog` (metastore tables) or
    :meth:`from_frames` (DataFrames, or zero-argument callables returning
    one).  Tables are opened and conformed on first use only, so a plan
    that needs three inputs never touches the other thirteen.  ``zone`` is
    the time zone in which timestamps become dates (default: the session's).
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], zone: str | None = None):
        missing = sorted(set(SCHEMAS) - set(frames))
        if missing:
            raise ValueError(f"missing input tables: {missing}")
        self._sources, self._zone = dict(frames), zone
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            src = self._sources[name]
            self._frames[name] = conform(src() if callable(src) else src, name, self._zone)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in SCHEMAS:
            raise AttributeError(name)
        return self[name]

    def names(self):
        return list(SCHEMAS)

    def with_checked_keys(self, policy: str, quarantine: Store) -> "Tables":
        """These tables with those of :data:`KEYS` held against their keys on
        first use (see :func:`..operators.quality.checked`)."""
        return Tables({n: (lambda n=n: checked(self[n], n, KEYS[n], policy, quarantine) if n in KEYS else self[n])
                       for n in SCHEMAS})

    @classmethod
    def from_frames(cls, frames, zone: str | None = None) -> "Tables":
        return cls(frames, zone)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, suffix: str = "", zone: str | None = None) -> "Tables":
        """``root`` may be any URI that Spark reads; nothing but Spark opens it."""
        root = root.rstrip("/")
        return cls({n: (lambda n=n: spark.read.parquet(f"{root}/{n}{suffix}")) for n in SCHEMAS}, zone)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str] | None = None,
                     zone: str | None = None) -> "Tables":
        """``names`` maps our table name to a catalog identifier."""
        names = names or {}
        return cls({n: (lambda n=n: spark.table(names.get(n, n))) for n in SCHEMAS}, zone)
