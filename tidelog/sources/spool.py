"""The message log on storage: reading it as a table, opening it as a stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.messages import MESSAGE_ID, envelope, raw_id
from tidelog.operators.replay import AFTER_MESSAGE, replay
from tidelog.operators.resume import locate_ids, padded, resume_filter
from tidelog.schema import DEFAULT_HEADER_PREFIX, ID_PREFIX, OK, PLACE_DIGITS, RAW_MESSAGE
from tidelog.sources.datasource import FORMAT, register


# Columns that a published log does not store: they follow from a row's place in it.
_PLACED = ("spool_seq", "rgmid")
_STORED = T.StructType([*RAW_MESSAGE.fields, T.StructField("status", T.StringType())])
_COMMITS = T.StructType([
    *(f for f in _STORED.fields if f.name not in _PLACED), T.StructField("commit", T.LongType())
])


def check_log(spark: SparkSession, path: str) -> bool:
    """Refuse a folder whose files are something else than messages; whether it is a published log."""
    try:
        have = spark.read.parquet(path).schema
    except AnalysisException:  # nothing there yet
        return False
    kinds = {f.name: f.dataType for f in have.fields}
    published = "commit" in kinds
    wrong = [
        f.name for f in RAW_MESSAGE.fields
        if not (published and f.name in _PLACED)
        and (f.name not in kinds or kinds[f.name].typeName() != f.dataType.typeName())
    ]
    if wrong:
        raise ValueError(f"{path} is not a message log: {', '.join(wrong)} missing or of another type")
    return published


def read_queue(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """The whole log as a bounded table of raw messages, or what comes after a position.

    A published log's positions are in its files' names, so files that end before are not opened.
    """
    good = F.col("status").isNull() | (F.col("status") == OK)
    if not check_log(spark, path):
        rows = spark.read.schema(_STORED).parquet(path).where(good)
        rows = rows if after is None else rows.where(F.col("spool_seq") > after)
        return rows.select(*RAW_MESSAGE.names)
    rows = spark.read.schema(_COMMITS).parquet(path).where(good)
    name = F.col("_metadata.file_name")
    first = F.substring(name, 1, PLACE_DIGITS).cast("long")
    place = first + F.col("_metadata.row_index")
    if after is not None:
        length = F.substring_index(F.substring(name, PLACE_DIGITS + 2, 20), "-", 1).cast("long")
        rows = rows.where(first + length > after + 1).where(place > after)
    digits = F.lpad(place.cast("string"), PLACE_DIGITS, "0")
    placed = {"spool_seq": place, "rgmid": F.concat(F.lit(ID_PREFIX), digits)}
    return rows.select([placed.get(c, F.col(c)).alias(c) for c in RAW_MESSAGE.names])


def position_of(message_id: str | None) -> int | None:
    """The position that an id of a published log stands for; None for any other id."""
    digits = (message_id or "").removeprefix(ID_PREFIX)
    own = message_id == ID_PREFIX + digits and len(digits) == PLACE_DIGITS and digits.isdecimal()
    return int(digits) if own else None


def stream_raw(
    spark: SparkSession, path: str, partitions: int = 1, batch_size: int = 0,
    columns: list[str] | None = None, after: int | None = None,
) -> DataFrame:
    """The log as a stream of raw messages in order of position.

    With a batch size a micro-batch holds at most so many messages for each of ``partitions`` consumers
    (0: one per core), however long the log's files are; a consumer is a task. A batch size of 0 sets no
    bound. ``columns`` reads fewer of them, ``after`` starts behind a position. A file that comes late,
    with positions that the stream has passed, fails it.
    """
    if partitions < 0:
        raise ValueError("partitions must be >= 0")
    if batch_size < 0:
        raise ValueError("batch size must be >= 0")
    check_log(spark, path)
    register(spark)
    options = {
        "path": path, "batchSize": batch_size,
        "partitions": partitions or spark.sparkContext.defaultParallelism,
        "startPosition": 0 if after is None else after + 1,
    }
    if columns is not None:
        options["columns"] = ",".join(columns)
    return spark.readStream.format(FORMAT).options(**options).load()


def resume(
    raw: DataFrame,
    checkpoints: DataFrame,
    log: DataFrame,
    offset_indicator: str = MESSAGE_ID,
    replay: bool = False,
) -> DataFrame:
    """The restart rule for checkpoints taken with an offset indicator.

    Message ids order as text. The ids of any other indicator are looked up in ``log``, and their
    positions are compared.
    """
    if replay or offset_indicator == MESSAGE_ID:
        return resume_filter(raw, checkpoints, replay=replay)
    indicated = log.withColumn("_indicated", raw_id(offset_indicator))
    located = locate_ids(checkpoints, indicated, "_indicated")
    placed = raw.withColumn("_place", padded("spool_seq"))
    return resume_filter(placed, located, "_place").drop("_place")


def open_queue(
    spark: SparkSession,
    path: str,
    partitions: int = 1,
    batch_size: int = 0,
    include_headers: bool = False,
    offset_indicator: str = MESSAGE_ID,
    strict: bool = True,
    header_prefix: str = DEFAULT_HEADER_PREFIX,
    replay_strategy: str | None = None,
    replay_start_time: str | None = None,
    replay_timezone: str | None = "UTC",
    replay_message_id: str | None = None,
    checkpoints: DataFrame | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Streaming envelope rows of a log, replayed and resumed as asked.

    ``checkpoints`` switches the restart filter on, unless a replay is asked for.
    """
    after = position_of(replay_message_id) if replay_strategy == AFTER_MESSAGE else None
    raw = stream_raw(spark, path, partitions, batch_size, after=after)
    raw = replay(raw, replay_strategy, replay_start_time, replay_timezone, replay_message_id)
    if checkpoints is not None:
        log = read_queue(spark, path)
        raw = resume(raw, checkpoints, log, offset_indicator, replay_strategy is not None)
    return envelope(raw, include_headers, offset_indicator, strict, header_prefix, keep)


def stream_parquet(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Any Parquet folder as a stream, with the schema a batch read of it finds."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
