"""Exact dedup: a stream into disk-backed keyed state, DataFrame functions only.

The rows' digests run as a stream into a keyed aggregation whose state is
kept by RocksDB and never expires: per digest, how many rows had it, and of
the row that stays its stable identifier and the content locator (file and
row) under which its full text can be read.  Rows that hit a digest seen
before are then compared in their full bytes.  Digests that stand for more
than one text are split by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import FILE, ROW, located, materialise, scratch, without

BLANKS = r"[\x20\x09-\x0D]+"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Bits of the filter of digests that were hit, as powers of two.
LEAST_BITS, MOST_BITS = 12, 23

#: Memory of all state stores of an executor together, in MB.
STORES_MB = 256


def normalised(text: Column) -> Column:
    """The text without spaces, tabs and line ends; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, "")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _stay() -> Column:
    """Order of the rows of a group: the smallest is the one that stays."""
    return F.struct((-F.col("points")).alias("short"), F.col("doc_id").isNull().alias("none"), "doc_id", FILE, ROW)


def keyed_state(rows: DataFrame, key: str, value: Column, batch: int = 64 << 30) -> DataFrame:
    """``key``, ``n`` and the least ``value`` of every key, kept as streaming state.

    ``rows`` is written to the shared folder and read as a stream of at most
    ``batch`` bytes at a time; the checkpoint beside it makes the run
    restartable.  The state is then read as a table.
    """
    spark = rows.sparkSession
    source, checkpoint = scratch(spark, "digests"), scratch(spark, "state")
    rows.write.parquet(source)
    own = _stateful_session(spark)
    stream = own.readStream.schema(rows.schema).option("maxBytesPerTrigger", batch).parquet(source)
    state = stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("least"))
    (state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    kept = own.read.format("statestore").load(checkpoint)
    buffers = kept.schema["value"].dataType.names  # one of the count, one of the least value
    count, least = (next(x for x in buffers if x.startswith(kind)) for kind in ("count", "min"))
    table = kept.select(F.col(f"key.{key}").alias(key), F.col(f"value.{count}").alias("n"),
                        F.col(f"value.{least}").alias("least"))
    path = scratch(spark, "state-table")
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose state store is RocksDB."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.files.maxPartitionBytes"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    # a store takes the disk it fills: with many small stores, space set aside beforehand would be most of it
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # the stores of an executor share one bound on their memory; beyond it they write to disk
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", str(STORES_MB))
    return own


def member_filter(values: DataFrame, column: str) -> Callable[[Column], Column]:
    """A condition that holds for every value of ``column`` and for few others.

    The values' hashes set bits of an array of at most ``2 ** MOST_BITS``
    bits, which goes to the tasks as one value of the plan.  With more values
    than bits it holds for nearly everything, which costs work only."""
    bits = min(max((16 * values.count()).bit_length(), LEAST_BITS), MOST_BITS)
    spark, words = values.sparkSession, 1 << (bits - 6)

    def place(value: Column) -> Column:
        return F.xxhash64(value).bitwiseAND(F.lit((1 << bits) - 1))
    at = place(F.col(column))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    filled = values.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    every = spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set")).unionByName(filled)
    merged = every.groupBy("word").agg(F.bit_or("set").alias("set"))
    # as many rows as the array has words, whatever the data
    stored = materialise(merged.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "set"))), lambda x: x["set"]).alias("sets")),
                         "members")
    sets = stored.select("sets").scalar()
    return lambda value: F.getbit(F.get(sets, F.shiftright(place(value), 6).cast("int")),
                                  place(value).bitwiseAND(F.lit(63)).cast("int")) == 1


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``digest``, ``keep_id``,
    ``group_size``, ``kept`` and the row's place ``__file``, ``__row``.

    Texts are equal if they are after the removal of spaces, tabs and line
    ends; null counts as empty, so null and blank texts are one group.  Of
    equal texts the row with the most code points stays, then the smallest
    id (null last), then the first place, so of repeated rows one stays.  An
    empty table gives no rows.
    """
    docs = located(docs).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), FILE, ROW)
    plain = docs.select("doc_id", FILE, ROW, F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).alias("points"),
                        normalised(F.col("text")).alias("plain"))
    rows = materialise(plain.select("doc_id", FILE, ROW, "points", digest(F.col("plain")).alias("digest")), "rows")
    groups = keyed_state(rows, "digest", _stay())
    hits = groups.where(F.col("n") > 1).select("digest")

    # full bytes of the hits: only texts whose digest may be a hit leave the task that reads them, copies collapse
    # there, and the texts alone are regrouped, so a large group of copies can be split
    may_hit = member_filter(hits, "digest")
    texts = (plain.select(digest(F.col("plain")).alias("digest"), "plain").where(may_hit(F.col("digest")))
             .join(hits, "digest", "left_semi").select("plain").distinct())
    mixed = materialise(texts.groupBy(digest(F.col("plain")).alias("digest")).agg(F.count(F.lit(1)).alias("texts"))
                        .where(F.col("texts") > 1).select("digest"), "mixed-digests")
    out = rows.join(groups, "digest")
    if not mixed.isEmpty():  # digests of several texts: their rows go by the text itself
        split = plain.withColumn("digest", digest(F.col("plain"))).join(mixed, "digest", "left_semi")
        parts = split.groupBy("digest", "plain").agg(F.count(F.lit(1)).alias("n"), F.min(_stay()).alias("least"))
        named = split.join(parts, ["digest", "plain"]).select("digest", "doc_id", FILE, ROW, "points", "n", "least")
        out = out.join(mixed, "digest", "left_anti").unionByName(named)
    kept = (F.col(FILE) == F.col(f"least.{FILE}")) & (F.col(ROW) == F.col(f"least.{ROW}"))
    return out.select("doc_id", "digest", F.col("least.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
                      kept.alias("kept"), FILE, ROW)


def exact_survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay; same columns."""
    def copies(located_docs: DataFrame) -> DataFrame:
        gone = exact_groups(located_docs.drop(FILE, ROW), doc_id, text).where(~F.col("kept")).select(FILE, ROW)
        return materialise(gone, "copies")
    return without(docs, copies)
