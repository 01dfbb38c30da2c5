"""Message queues as append-only Parquet logs, on PySpark."""

from tidelog.options import QueueReader, QueueWriter
from tidelog.schema import RAW_MESSAGE, envelope_schema

__all__ = ["QueueReader", "QueueWriter", "RAW_MESSAGE", "envelope_schema"]
