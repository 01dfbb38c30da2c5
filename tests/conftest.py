import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidelog.schema import RAW_MESSAGE  # noqa: E402

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tidelog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "Asia/Kolkata")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def message(i, **over):
    """One raw message as a dict; fields can be overridden."""
    row = {f.name: None for f in RAW_MESSAGE.fields}
    row.update(
        spool_seq=i,
        rgmid=f"rmid1:{i:018d}",
        correlation_id=f"corr-{i}",
        application_message_id=f"app-{i}",
        destination="orders/new",
        sender_ts=START + timedelta(seconds=i),
        receive_ts=START + timedelta(seconds=i + 1),
        expiration=0,
        time_to_live=0,
        priority=1,
        redelivered=False,
        is_text=True,
        text_body="a plain body",
        user_props={},
    )
    row.update(over)
    return row


def frame(spark, rows):
    values = [tuple(r[f.name] for f in RAW_MESSAGE.fields) for r in rows]
    return spark.createDataFrame(values, RAW_MESSAGE)


@pytest.fixture(scope="session")
def hundred(spark):
    """100 messages: 91 with text, 5 with an attachment, 4 with content; five user properties."""
    def one(i):
        props = {
            "colour": "amber",
            "checked": "true",
            "absent": None,
            "blank": "",
            "ordinal": str(i),
        }
        body = "a plain body"
        if i <= 90:
            return message(i, user_props=props)
        if i <= 95:
            return message(i, user_props=props, is_text=False, text_body=None,
                           attachment=body.encode())
        return message(i, user_props=props, is_text=False, text_body=None, content=body.encode())

    return frame(spark, [one(i) for i in range(100)]).cache()
