"""Record layouts; delimited files bind their columns by position."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


SENSOR = _record(id=T.StringType(), ts=T.LongType(), vc=T.IntegerType())
BEHAVIOR = _record(
    user_id=T.LongType(),
    item_id=T.LongType(),
    category_id=T.IntegerType(),
    behavior=T.StringType(),
    ts=T.LongType(),
)
MARKETING = _record(
    user_id=T.LongType(), behavior=T.StringType(), channel=T.StringType(), ts=T.LongType()
)
AD_CLICK = _record(
    user_id=T.LongType(),
    ad_id=T.LongType(),
    province=T.StringType(),
    city=T.StringType(),
    ts=T.LongType(),
)
ACCESS_LOG = _record(
    ip=T.StringType(),
    user_id=T.StringType(),
    event_time=T.TimestampType(),
    method=T.StringType(),
    url=T.StringType(),
)
LOGIN = _record(
    user_id=T.LongType(), ip=T.StringType(), event_type=T.StringType(), ts=T.LongType()
)
ORDER = _record(
    order_id=T.LongType(), event_type=T.StringType(), tx_id=T.StringType(), ts=T.LongType()
)
RECEIPT = _record(tx_id=T.StringType(), pay_channel=T.StringType(), ts=T.LongType())
MESSAGE = _record(
    key=T.BinaryType(),
    value=T.BinaryType(),
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
)
