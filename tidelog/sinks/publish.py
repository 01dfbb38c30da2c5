"""Publishing rows as messages, as one batch or as a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.publishing import (
    as_raw,
    bind_columns,
    publish_envelope,
    publish_validate,
    reject_report,
    split_rejects,
)
from tidelog.schema import DEFAULT_HEADER_PREFIX, FAILED, OK, PUBLISHED_FIELDS, RAW_MESSAGE
from tidelog.sources.datasource import FORMAT, register


@dataclass(frozen=True)
class Publisher:
    """What every publish form shares: overrides, headers, and what a bad row does.

    ``mode`` is ``strict`` (bad rows fail the job, which names them) or ``report`` (they are stored as
    rejects).
    """

    topic: str | None = None
    message_id: str | None = None
    include_headers: bool = False
    header_prefix: str = DEFAULT_HEADER_PREFIX
    mode: str = "strict"
    keep: tuple[str, ...] = ()

    def __post_init__(self):
        if self.mode not in ("strict", "report"):
            raise ValueError("mode is strict or report")

    def checked(self, df: DataFrame) -> DataFrame:
        """Bound rows with ``status`` and ``reason``."""
        bound = bind_columns(
            df, self.topic, self.message_id, self.include_headers, self.keep
        )
        return publish_validate(bound, self.header_prefix, strict=self.mode == "strict")

    def messages(self, df: DataFrame) -> DataFrame:
        """Outgoing messages of the publishable rows."""
        good, _ = split_rejects(self.checked(df))
        return publish_envelope(good, self.header_prefix, keep=self.keep)

    def rejects(self, df: DataFrame) -> DataFrame:
        return reject_report(self.checked(df))

    def log_rows(self, df: DataFrame) -> DataFrame:
        """Every row as the log stores it: good ones as messages, bad ones with status and reason.

        Positions and ids are those of the place that rows get in the log, so they are null here.
        """
        bound = bind_columns(df, self.topic, self.message_id, self.include_headers, self.keep)
        checked = publish_validate(bound, self.header_prefix)
        rows = publish_envelope(
            checked, self.header_prefix, keep=(*self.keep, "status", "reason")
        ).withColumn("_place", F.lit(None).cast("long"))
        kept = (*self.keep, "status", "reason")
        extra = [f.name for f in PUBLISHED_FIELDS.fields if f.name not in kept]
        more = [c for c in self.keep if c not in RAW_MESSAGE.names]
        return as_raw(rows, "_place", keep=(*extra, "status", "reason", *more))


def _counts() -> list[Column]:
    good = F.col("status") == OK
    return [
        F.count("*").alias("published"),
        F.count_if(good).alias("acknowledged"),
        F.count_if(~good).alias("failed"),
    ]


def publish(
    df: DataFrame,
    path: str,
    publisher: Publisher = Publisher(),
    save_mode: str = "append",
    writer: str | None = None,
    batch: int | None = None,
) -> dict[str, int]:
    """Write ``df`` to a log that :func:`tidelog.sources.spool.read_queue` reads back.

    Rows are checked once and written once. Each gets the next position of the log, without gaps, and an
    id made of it; all become readable at once. In ``strict`` mode bad rows fail the job, and none of its
    rows are in the log. In ``report`` mode bad rows are stored too, where readers pass them over and
    :func:`read_rejects` finds them. Appended unless ``save_mode`` is ``overwrite``, which starts a new
    log. A ``batch`` of a ``writer`` that is in the log already adds nothing. Returns how many rows were
    published, acknowledged and failed, counted while they were written.
    """
    register(df.sparkSession)
    return publish_rows(publisher.log_rows(df), path, publisher, save_mode, writer, batch)


def publish_rows(
    rows: DataFrame,
    path: str,
    publisher: Publisher,
    save_mode: str = "append",
    writer: str | None = None,
    batch: int | None = None,
) -> dict[str, int]:
    """:func:`publish` for rows that :meth:`Publisher.log_rows` made, in a session that knows the format."""
    counts = Observation()
    out = rows.observe(counts, *_counts()).write.format(FORMAT).mode(save_mode).options(
        path=path, strict=publisher.mode == "strict"
    )
    if batch is not None:
        out = out.options(writer=writer, batch=batch)
    out.save()
    got = counts.get
    if got["published"] != got["acknowledged"] + got["failed"]:
        raise RuntimeError(f"rows are missing: {got}")
    return got


def read_rejects(spark: SparkSession, path: str, *more: str) -> DataFrame:
    """Rows that could not be published to a log, with ``Id``, ``status``, ``reason`` and ``more``."""
    stored = spark.read.schema(T.StructType(RAW_MESSAGE.fields + PUBLISHED_FIELDS.fields))
    return stored.parquet(path).where(F.col("status") == FAILED).select(
        F.col("correlation_id").alias("Id"), "status", "reason", *more
    )


def publish_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per commit of a published log: its first position, who wrote it, and how many of its rows were
    published, acknowledged and failed. Only one column is read.

    ``writer`` is a stream's query id or a job of its own, ``batch`` the stream's batch (else 0).
    """
    stored = spark.read.schema("status string, commit long").parquet(path)
    name = F.split(F.col("_metadata.file_name"), "-")
    return stored.groupBy(
        F.col("commit").alias("first_position"), F.get(name, F.lit(2)).alias("writer"),
        F.get(name, F.lit(3)).cast("long").alias("batch"),
    ).agg(*_counts())


def publish_stream(
    df: DataFrame, path: str, checkpoint: str, publisher: Publisher = Publisher()
) -> DataStreamWriter:
    """A writer that appends a stream to a log, exactly once; the caller starts it.

    Every micro-batch is a commit: its rows get the next positions, without gaps, and a batch that runs
    again after it was committed adds nothing. Bad rows are dealt with as :func:`publish` does;
    :func:`publish_counts` counts them by batch.
    """
    register(df.sparkSession)
    return (
        publisher.log_rows(df).writeStream.format(FORMAT)
        .outputMode("append")
        .options(path=path, strict=publisher.mode == "strict", checkpointLocation=checkpoint)
    )
