import json
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import moment, rows

from tickloom.sources import decode_ticks, encode_ticks, parse_messages

GOOD = '{"symbol":"A","price":1.5,"volume":3,"timestamp":"2024-01-01T00:00:01.000002"}'


def messages(spark, *texts):
    data = [(None if t is None else bytearray(t, "utf8"),) for t in texts]
    return spark.createDataFrame(data, "value binary")


def field(**changes):
    values = {"symbol": '"A"', "price": "1.5", "volume": "3", "timestamp": '"2024-01-01T00:00:00"'}
    values.update(changes)
    return "{" + ",".join(f'"{k}":{v}' for k, v in values.items() if v is not None) + "}"


BAD = {
    "not json": "malformed message",
    '{"symbol":"A"': "malformed message",
    "{}": "missing symbol, price, volume, timestamp",
    field(price='"x"'): "malformed message",
    field(volume="3.7"): "malformed message",
    field(volume="99999999999"): "malformed message",
    field(timestamp='"bad"'): "malformed message",
    GOOD + " and more": "malformed message",
    GOOD + GOOD: "malformed message",
    f"{GOOD}, {GOOD}": "malformed message",
    f"[{GOOD}]": "malformed message",
    GOOD + "]": "malformed message",
    GOOD + ',"x":1': "malformed message",
    GOOD + "}": "malformed message",
    "": "malformed message",
    field(price="NaN"): "price is not a number",
    field(price="Infinity"): "price is not a number",
    field(symbol=None): "missing symbol",
    field(volume=None, timestamp="null"): "missing volume, timestamp",
}


@pytest.mark.parametrize("text", BAD)
def test_bad_message_is_quarantined_whole(spark, text):
    ticks, rejected = decode_ticks(messages(spark, text, GOOD))
    assert rows(rejected) == [(text, BAD[text])]
    assert ticks.count() == 1


def test_empty_message(spark):
    ticks, rejected = decode_ticks(messages(spark, None))
    assert (ticks.count(), rows(rejected)) == (0, [(None, "empty message")])


def test_every_message_lands_once(spark):
    all_texts = [*BAD, GOOD, GOOD, None]
    ticks, rejected = decode_ticks(messages(spark, *all_texts))
    assert ticks.count() + rejected.count() == len(all_texts)


def test_extra_field_is_ignored(spark):
    ticks, _ = decode_ticks(messages(spark, GOOD.replace("{", '{"venue":"X",')))
    assert ticks.count() == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_naive_times_are_utc_in_any_session(spark, zone):
    texts = ["2024-01-01T12:00:00", "2024-01-01T12:00:00.000000", "2024-01-01T12:00:00Z",
             "2024-01-01T14:00:00+02:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        sent = messages(spark, *[field(timestamp=f'"{t}"') for t in texts])
        ticks, _ = decode_ticks(sent)
        seconds = {r[0] for r in ticks.selectExpr("unix_seconds(timestamp)").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seconds == {1704110400}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_round_trip_in_any_session(spark, make_ticks, zone, kind):
    """Also for local times that a change of clocks leaves out or has twice."""
    times = ["2024-03-10T02:30:00.000001", "2024-03-10T07:00:00", "2024-11-03T01:30:00", "2024-11-03T05:30:00"]
    sent = make_ticks([("A", "1.00", n, t) for n, t in enumerate(times)])
    sent = sent.withColumn("timestamp", sent.timestamp.cast(kind))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        if kind == "timestamp":
            sent = make_ticks([("A", "1.00", n, t) for n, t in enumerate(times)]).selectExpr(
                "symbol", "price", "volume", "timestamp_micros(unix_micros(to_timestamp(string(timestamp) || 'Z'))) AS timestamp"
            )
        texts = [json.loads(r.value)["timestamp"] for r in encode_ticks(sent).orderBy("value").collect()]
        back = decode_ticks(encode_ticks(sent))[0].selectExpr("unix_micros(timestamp)").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    full = sorted(t if "." in t else t + ".000000" for t in times)
    assert sorted(texts) == full
    epoch = datetime(1970, 1, 1)
    assert sorted(r[0] for r in back) == [round((datetime.fromisoformat(t) - epoch) / timedelta(microseconds=1)) for t in full]


def test_round_trip_keeps_microseconds(spark, make_ticks):
    sent = make_ticks([("A", "6.55", 3, "00:00:07.179575"), ("B", "6.50", 4, "00:00:00")])
    ticks, _ = decode_ticks(encode_ticks(sent))
    back = ticks.selectExpr("symbol", "price", "volume", "cast(timestamp as timestamp_ntz)")
    assert rows(back) == [
        ("A", 6.55, 3, moment("00:00:07.179575")),
        ("B", 6.5, 4, moment("00:00:00")),
    ]


def test_double_prices_are_sent_with_two_decimals(spark, make_ticks):
    sent = make_ticks([("A", "6.556", 3, "00:00:00")], price="double")
    text = encode_ticks(sent).selectExpr("cast(value as string)").first()[0]
    assert text == (
        '{"symbol":"A","price":6.56,"volume":3,"timestamp":"2024-01-01T00:00:00.000000"}'
    )


def test_filters_do_not_parse_again(spark):
    ticks, _ = decode_ticks(messages(spark, GOOD))
    plan = ticks._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_parsed_rows_keep_message_and_fields(spark):
    row = parse_messages(messages(spark, GOOD)).first()
    assert (row.symbol, row.price, row.volume, row.value, row.reason) == ("A", 1.5, 3, GOOD, None)


def test_any_symbol_and_time_survive(spark, make_ticks):
    draw = random.Random(11)
    alphabet = 'Aé€"\\{}[],: \n\t\u2028\U0001f4c8'
    sent = [
        (
            "".join(draw.choices(alphabet, k=draw.randrange(1, 8))),
            f"{draw.randrange(-(10**9), 10**9) / 100:.2f}",
            draw.randrange(-(2**31), 2**31),
            moment("00:00:00") + timedelta(microseconds=draw.randrange(-(10**16), 10**16)),
        )
        for _ in range(400)
    ]
    ticks, rejected = decode_ticks(encode_ticks(make_ticks(sent)))
    back = ticks.selectExpr(
        "symbol", "cast(price as decimal(18,2))", "volume", "cast(timestamp as timestamp_ntz)"
    )
    assert rejected.count() == 0
    assert rows(back) == sorted(((s, Decimal(p), v, t) for s, p, v, t in sent), key=repr)
