"""Object-store notifications as rows of arrived objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIRECT = (
    "array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>,"
    " Sns: struct<Message: string>>>"
)
EVENT_SCHEMA = (
    f"Records {_DIRECT}, data struct<bucket: string, name: string>,"
    f" requestPayload struct<Records: {_DIRECT}>"
)
MESSAGE_SCHEMA = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)

DIRECT, TOPIC, STORAGE, UNKNOWN = "S3_TRIGGER", "SNS_S3_TRIGGER", "GCS_TRIGGER", "UNSUPPORTED"


def arrived_objects(events: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per object of each notification: ``event_source, bucket, object_key``.

    Takes the JSON text of direct notifications, of those wrapped in a topic message or in
    ``requestPayload``, and of the ``data.bucket``/``data.name`` form. The columns of ``events`` are
    kept, so ``payload`` is the raw event. Text of any other shape gives one row of source
    ``UNSUPPORTED``.
    """
    event = F.from_json(F.col(payload), EVENT_SCHEMA)
    records = F.coalesce(event["requestPayload"]["Records"], event["Records"])

    def found(source: str, bucket: Column, key: Column) -> Column:
        return F.struct(
            F.lit(source).alias("event_source"), bucket.alias("bucket"), key.alias("object_key")
        )

    def decoded(key: Column) -> Column:
        return F.coalesce(F.try_url_decode(key), key)

    def direct(source: str, items: Column) -> Column:
        return F.transform(
            items, lambda r: found(source, r["s3"]["bucket"]["name"], decoded(r["s3"]["object"]["key"]))
        )

    topic = F.flatten(
        F.transform(
            records,
            lambda r: F.coalesce(
                direct(TOPIC, F.from_json(r["Sns"]["Message"], MESSAGE_SCHEMA)["Records"]),
                F.array(found(UNKNOWN, F.lit(None).cast("string"), F.lit(None).cast("string"))),
            ),
        )
    )
    first = F.get(records, F.lit(0))
    objects = (
        F.when(first["s3"].isNotNull(), direct(DIRECT, records))
        .when(first["Sns"].isNotNull(), topic)
        .when(event["data"].isNotNull(), F.array(found(STORAGE, event["data"]["bucket"], event["data"]["name"])))
        .otherwise(F.array(found(UNKNOWN, F.lit(None).cast("string"), F.lit(None).cast("string"))))
    )
    return events.select("*", F.inline(objects))
