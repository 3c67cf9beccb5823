"""Table schemas shared by the whole library.

``MESSAGE`` is the durable log.  ``SUBSCRIPTION`` says what to read, ``PROGRESS`` how far
each subscription (a *split*) got, ``ACK`` and ``DELIVERY`` are the acknowledgement ledger.
"""

from __future__ import annotations

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("headers", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("reply_to", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

SUBSCRIPTION = T.StructType(
    [
        T.StructField("split_id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("consumer_name_prefix", T.StringType()),
        T.StructField("durable_name", T.StringType()),
        T.StructField("start_sequence", T.LongType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("max_messages_to_read", T.LongType()),
        T.StructField("ack_behavior", T.StringType()),
        T.StructField("ack_wait", T.LongType()),  # nanoseconds
        T.StructField("inactive_threshold", T.LongType()),  # nanoseconds
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("threshold_percent", T.IntegerType()),
    ]
)

PROGRESS = T.StructType(
    [
        T.StructField("split_id", T.StringType()),
        T.StructField("last_emitted_seq", T.LongType()),
        T.StructField("last_reply_to", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("finished", T.BooleanType()),
    ]
)

ACK = T.StructType(
    [
        T.StructField("consumer", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("acked_at", T.TimestampNTZType()),
    ]
)

DELIVERY = T.StructType(
    [
        T.StructField("consumer", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("delivered_at", T.TimestampNTZType()),
        T.StructField("attempt", T.IntegerType()),
    ]
)

# Acknowledgement behaviours, and those of them that never acknowledge.
ACK_BEHAVIORS = ["NoAck", "NoAckUnordered", "AckAll", "AllButDoNotAck", "ExplicitButDoNotAck"]
NO_ACK = ["NoAck", "NoAckUnordered"]
CUMULATIVE = ["AckAll", "AllButDoNotAck"]
EXPLICIT = ["ExplicitButDoNotAck"]

# Fixed value: body of an acknowledgement message.
ACK_BODY = "+ACK"

# Rows of one (stream, seq // SEQ_BUCKET) group are at most this many: sequence numbers
# are unique within a stream.  Windows over a split run per bucket, never over a split.
SEQ_BUCKET = 1 << 20
