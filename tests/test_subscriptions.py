import json
import zlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from subjectlog.operators import subscriptions as S
from subjectlog.schema import SUBSCRIPTION
from subjectlog.sources.documents import load_subscriptions, load_targets

BASE = {"stream": "s", "subject": "a.b"}


@pytest.mark.parametrize(
    "extra,error",
    [
        ({"stream": ""}, S.STREAM_REQUIRED),
        ({"stream": None}, S.STREAM_REQUIRED),
        ({"subject": ""}, S.SUBJECT_REQUIRED),
        ({"start_sequence": 1, "start_time": datetime(2024, 1, 1)}, S.TWO_STARTS),
        ({"ack_wait": 5}, S.ACK_WAIT_WITHOUT_ACK),
        ({"ack_behavior": "NoAckUnordered", "ack_wait": 5}, S.ACK_WAIT_WITHOUT_ACK),
        ({"durable_name": "d"}, S.DURABLE_WITHOUT_ACK),
        ({"ack_behavior": "whatever", "durable_name": "d"}, S.DURABLE_WITHOUT_ACK),
        ({"ack_behavior": "AckAll", "durable_name": "d", "consumer_name_prefix": "p"}, S.DURABLE_AND_PREFIX),
    ],
)
def test_invalid_subscriptions(spark, extra, error):
    with pytest.raises(ValueError, match=error):
        S.subscriptions(spark, [BASE | extra])


@pytest.mark.parametrize(
    "column,given,want",
    [
        ("start_sequence", 0, -1),
        ("start_sequence", 7, 7),
        ("max_messages_to_read", -9, -1),
        ("batch_size", 0, -1),
        ("threshold_percent", 0, -1),
        ("threshold_percent", None, -1),
        ("threshold_percent", 101, 100),
        ("threshold_percent", 100, 100),
        ("inactive_threshold", 0, None),
        ("inactive_threshold", -5, None),
        ("inactive_threshold", 5, 5),
        ("ack_behavior", None, "NoAck"),
        ("ack_behavior", "EXPLICITBUTDONOTACK", "ExplicitButDoNotAck"),
        ("ack_behavior", "nonsense", "NoAck"),
        ("durable_name", "", None),
        ("consumer_name_prefix", "", None),
    ],
)
def test_coercion(spark, column, given, want):
    assert S.subscriptions(spark, [BASE | {column: given}]).head()[column] == want


def test_waits_and_zones(spark):
    row = S.subscriptions(spark, [BASE | {"ack_behavior": "AckAll", "ack_wait_ms": 3}]).head()
    assert row.ack_wait == 3_000_000
    east = datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2)))
    assert S.subscriptions(spark, [BASE | {"start_time": east}]).head().start_time == datetime(2024, 1, 1)
    with pytest.raises(ValueError, match="unknown"):
        S.subscriptions(spark, [BASE | {"nope": 1}])


def test_sources_are_all_bounded_or_not_at_all(spark):
    with pytest.raises(ValueError, match=S.MIXED_BOUNDS):
        S.subscriptions(spark, [BASE, BASE | {"max_messages_to_read": 3}])
    with pytest.raises(ValueError, match=S.NO_SUBSCRIPTION):
        S.subscriptions(spark, [])
    with pytest.raises(ValueError, match=S.NO_SUBJECTS):
        S.require_subjects(["", None])


def test_split_id_is_a_checksum_of_the_parts(spark):
    given = BASE | {"start_time": datetime(2024, 1, 1, 0, 0, 5, 999999), "ack_behavior": "AckAll", "ack_wait": 9}
    row = S.subscriptions(spark, [given]).head()
    second = int(datetime(2024, 1, 1, 0, 0, 5, tzinfo=timezone.utc).timestamp())
    text = f"a.b--s--na--na---1--{second}---1--AckAll--9--na---1---1"
    assert row.split_id.split("-")[0] == f"{zlib.crc32(text.encode()):X}"


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_split_id_ignores_the_session_zone(spark, zone):
    given = [BASE | {"start_time": datetime(2024, 3, 10, 2, 30)}]
    want = S.subscriptions(spark, given).head()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = S.subscriptions(spark, given).head()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want


def test_add_keeps_one_row_per_id(spark):
    one = S.subscriptions(spark, [BASE])
    more = S.subscriptions(spark, [BASE, BASE | {"subject": "c"}])
    assert S.add(one, more).count() == 2
    copies = S.copy_for(more, F.concat(F.lit("copy."), "subject"))
    assert S.add(more, copies).count() == 4


def test_json_leaves_defaults_out(spark):
    plain = S.subscriptions(spark, [BASE]).select(S.subscription_json()).head()[0]
    assert json.loads(plain) == {"stream_name": "s", "subject": "a.b"}
    full = S.subscriptions(
        spark, [BASE | {"ack_behavior": "AckAll", "start_time": datetime(2024, 1, 1, 1, 2, 3, 4), "max_messages_to_read": 5}]
    )
    assert json.loads(full.select(S.subscription_json()).head()[0]) == {
        "stream_name": "s",
        "subject": "a.b",
        "start_time": "2024-01-01T01:02:03.000004000Z",
        "max_messages_to_read": 5,
        "ack_behavior": "AckAll",
    }


def test_documents(spark, tmp_path):
    documents = {
        "one.json": {
            "converter": "utf8",
            "subscriptions": [
                {"stream_name": "A", "subject": "a", "max_messages_to_read": 100, "start_sequence": 101, "extra": True},
                {"stream_name": "B", "subject": "b", "max_messages_to_read": "50", "start_time": "2025-04-08T00:38:32.109526400Z"},
                {"stream_name": "C", "subject": "c", "start_time": "2025-04-08T02:00:00+02:00", "threshold_percent": 175},
            ],
        },
        "two.json": {"subscriptions": [{"stream_name": "D", "subject": "d", "ack_behavior": "ackall", "ack_wait": 7}]},
    }
    for name, document in documents.items():
        (tmp_path / name).write_text(json.dumps(document, indent=2))
    rows = {r.stream: r for r in load_subscriptions(spark, str(tmp_path)).collect()}
    assert set(rows) == {"A", "B", "C", "D"}
    assert (rows["A"].max_messages_to_read, rows["A"].start_sequence) == (100, 101)
    assert rows["B"].max_messages_to_read == -1  # a quoted number is no number
    assert rows["B"].start_time == datetime(2025, 4, 8, 0, 38, 32, 109526)
    assert rows["C"].start_time == datetime(2025, 4, 8) and rows["C"].threshold_percent == 100
    assert (rows["D"].ack_behavior, rows["D"].ack_wait) == ("AckAll", 7)
    assert load_subscriptions(spark, str(tmp_path)).schema.names == SUBSCRIPTION.names
    (tmp_path / "one.json").write_text("{broken")
    with pytest.raises(Exception):
        load_subscriptions(spark, str(tmp_path)).collect()


@pytest.mark.parametrize(
    "document,want",
    [
        ({"subjects": ["a", "", "b"]}, ["a", "b"]),
        ({"subjects": [], "subject": "a, b,,c,,"}, ["", " b", "a", "c"]),
        ({"subject": "a"}, ["a"]),
        ({"subject": " "}, []),
        ({"subject": ","}, []),
        ({"subjects": ["x"], "subject": "a"}, ["x"]),
        ({"subjects": [""], "subject": "a"}, []),
    ],
)
def test_target_documents(spark, tmp_path, document, want):
    (tmp_path / "sink.json").write_text(json.dumps(document))
    assert sorted(r.subject for r in load_targets(spark, str(tmp_path)).collect()) == want
