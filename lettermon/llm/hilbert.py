"""Sharding along a Hilbert curve, DataFrame functions only.

Several metadata dimensions are quantised by their quantiles to a grid of
``2^bits`` cells a side.  The Hilbert curve visits all cells so that
neighbours on the curve are neighbours in the grid; rows sorted by their
place on it and cut into runs make shards that are compact in every
dimension at once, so that files can be pruned by any of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, numbered

SHARDS = 8


def curve_table(dims: int) -> list[list[tuple[int, int]]]:
    """The curve as a state machine: ``table[state][corner]`` is the order of
    that corner's sub-cube and the state inside it.

    A state is how the cube is turned: an entry corner and a direction.  The
    corners are visited in Gray code order; the rules of entry corners and
    directions are those of Hamilton (2006).
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return (x >> by | x << (dims - by)) & (size - 1)

    def entry(i: int) -> int:
        return 0 if i == 0 else (j := 2 * ((i - 1) // 2)) ^ j >> 1

    def direction(i: int) -> int:
        if i == 0:
            return 0
        at = i - 1 if i % 2 == 0 else i
        return ((at + 1 & -(at + 1)).bit_length() - 1) % dims

    states, table = {(0, 0): 0}, []
    todo = [(0, 0)]
    while todo:
        corner, axis = todo.pop(0)
        row = [(0, 0)] * size
        for i in range(size):
            place = turn(i ^ i >> 1, -(axis + 1)) ^ corner
            inner = (corner ^ turn(entry(i), -(axis + 1)), (axis + direction(i) + 1) % dims)
            if inner not in states:
                states[inner] = len(states)
                todo.append(inner)
            row[place] = (i, states[inner])
        table.append(row)
    return table


def curve_index(cells: list[Column], bits: int) -> Column:
    """Place on the curve of a grid cell (its coordinates as integers below ``2^bits``)."""
    dims = len(cells)
    table = curve_table(dims)
    # order and next state of (state, corner), packed into one number
    steps = F.array(*[F.lit(order * len(table) + inner) for row in table for order, inner in row])
    size, states = 1 << dims, len(table)

    def corner(level: Column) -> Column:
        return sum((F.call_function("shiftright", c.cast("int"), level).bitwiseAND(F.lit(1)) * F.lit(1 << d)
                    for d, c in enumerate(cells)), F.lit(0))

    def step(acc: Column, level: Column) -> Column:
        packed = F.element_at(steps, (acc["state"] * size + corner(level) + 1).cast("int"))
        return F.struct((acc["place"] * size + F.floor(packed / states)).cast("long").alias("place"),
                        (packed % states).cast("int").alias("state"))
    start = F.struct(F.lit(0).cast("long").alias("place"), F.lit(0).cast("int").alias("state"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["place"])


def text_ranks(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with each of the string columns ``names`` replaced by the place
    of its whole value among the column's distinct values in byte order,
    from 0; null stays null.  Only distinct values are sorted, by range."""
    for name in names:
        values = numbered(df.select(F.col(name).alias("__value")).where(F.col(name).isNotNull()).distinct(), ["__value"], "__place")
        # written, so that its size is known and a small one is sent to all tasks
        values = materialise(values, f"ranks-{name}")
        df = (df.join(values, F.col(name) == F.col("__value"), "left")
              .withColumn(name, F.col("__place")).drop("__value", "__place"))
    return df


def quantised(df: DataFrame, dims: Mapping[str, Column], bits: int, accuracy: int = 10_000) -> list[Column]:
    """Cell coordinates of each dimension (integer columns; null comes
    first): how many of the ``2^bits - 1`` quantile cuts lie below.  The cuts
    are an aggregate over all rows; only they reach the driver."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(F.coalesce(c.cast("long"), F.lit(-1)), shares, accuracy).alias(n)
                    for n, c in dims.items()]).first()
    out = []
    for name, c in dims.items():
        value = F.coalesce(c.cast("long"), F.lit(-1))
        out.append(sum(((value > cut).cast("int") for cut in cuts[name] or []), F.lit(0)))
    return out


def hilbert_shards(df: DataFrame, dims: Mapping[str, Column], ties: list[Column], shards: int = SHARDS,
                   bits: int = 4, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``df`` (default: all), ``curve``, ``shard`` and ``slot``.

    The rows, sorted by their place on the curve and then by ``ties``, are
    cut into ``shards`` runs whose counts differ by one at most; ``slot`` is
    the place in the run, from 0.  ``dims`` are integer columns, null first.
    Rows that tie in everything are neighbours in an unspecified order; an
    empty table gives no rows.  Equal rows need no common task: the sort is
    by range, and only the ranges' counts meet.  Columns of ``df`` named
    ``curve``, ``shard`` or ``slot`` make way for those of the result.
    """
    columns = [c for c in (df.columns if columns is None else columns) if c.lower() not in ("curve", "shard", "slot")]
    cells = quantised(df, dims, bits)
    keyed = df.select(*columns, curve_index(cells, bits).alias("curve"),
                      *[t.alias(f"__tie{i}") for i, t in enumerate(ties)])
    ranked = numbered(keyed, ["curve", *[f"__tie{i}" for i in range(len(ties))]], "__rank")
    total = ranked.count()
    shard = F.floor(F.col("__rank") * shards / F.lit(max(total, 1))).cast("int")
    # the first rank of a shard: the least r with floor(r * shards / total) = shard
    first = F.floor((F.col("shard") * F.lit(total) + (shards - 1)) / F.lit(shards)).cast("long")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("__rank") - first)
            .select(*columns, "curve", "shard", "slot"))


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    source: str = "source", shards: int = SHARDS, bits: int = 4) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size`` (UTF-8 bytes of the
    text plus 1; null: 1), ``text_crc32`` (null counts as empty), ``curve``,
    ``shard`` and ``slot``; the dimensions are language, source (both by
    their whole names in byte order) and size.

    The law is ``rows``: shard counts differ by one at most, however large a
    source or a group of copies is.  Equal texts of one language and source
    share a cell and stand together in it (ties are in the order of size,
    checksum and id, null ids first).
    """
    value = F.col(text).cast("string")
    meta = docs.select(F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(value), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce(value, F.lit("")).cast("binary")).alias("text_crc32"),
                       F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    meta = materialise(meta, "shard-names")  # the texts are read once; the ranks read this
    meta = materialise(text_ranks(meta, "lang", "source"), "shard-keys")  # the cuts and the sort read this
    dims = {"lang": F.col("lang"), "source": F.col("source"), "size": F.col("size")}
    ties = [F.col("size"), F.col("text_crc32"), F.col("doc_id")]
    return hilbert_shards(meta, dims, ties, shards, bits, ["doc_id", "size", "text_crc32"])


def write_shards(df: DataFrame, shards: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write the rows of ``df`` under ``path``, a folder per shard, each file
    sorted by slot, so that readers prune files by the dimensions' ranges.
    ``key`` has to be unique and not null in both."""
    (df.join(shards.select(key, "shard", "slot"), key)
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
