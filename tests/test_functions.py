import json
import math
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commutewell.functions.dates import as_date, as_moment, year_of
from commutewell.functions.geo import distance_to_office_km, haversine_km
from commutewell.functions.text import congratulation, full_name, strip
from commutewell.functions.wire import (
    avro_schema,
    decode,
    from_avro_payload,
    from_json_payload,
    payload,
    schema_id,
)


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2026-01-02 03:04:05", date(2026, 1, 2)),
        ("2026-01-02", date(2026, 1, 2)),
        ("04/05/2026", date(2026, 5, 4)),
        ("6/1/1962", date(1962, 1, 6)),
        (" 6/1/1962 ", date(1962, 1, 6)),
        ("04/05/2026 10:11:12", date(2026, 5, 4)),
        ("31/2/2020", None),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_dates_from_mixed_text(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(as_date(F.col("d"))).first()[0] == day
    assert df.select(year_of(df, "d")).first()[0] == (day.year if day else None)


def test_moment_keeps_the_time(spark):
    df = spark.createDataFrame([("2026-01-02 03:04:05",), ("4/5/2026 10:11:12",), ("x",)], "d string")
    found = [r[0] for r in df.select(as_moment(F.col("d"))).collect()]
    assert found == [datetime(2026, 1, 2, 3, 4, 5), datetime(2026, 5, 4, 10, 11, 12), None]


def test_year_of_typed_columns(spark):
    df = spark.createDataFrame([(date(2025, 12, 31), datetime(2026, 1, 1))], "d date, t timestamp_ntz")
    assert tuple(df.select(year_of(df, "d"), year_of(df, "t")).first()) == (2025, 2026)


def test_strip_equals_python(spark):
    samples = ["  a ", "\t\na b\r\n", " x　", "\x1cq\x85", "", "   ", "é  "]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(strip(F.col("s"))).collect()] == [s.strip() for s in samples]


@pytest.mark.parametrize(
    ("first", "last", "comment", "message"),
    [
        ("Lou", "Durand", None, "Bravo Lou Durand !"),
        ("Lou", "Durand", "", "Bravo Lou Durand !"),
        ("Lou", "Durand", "Top", "Bravo Lou Durand ! c'est Top !"),
        ("Lou", "Durand", " ", "Bravo Lou Durand ! c'est   !"),
        (None, "Durand", None, "Bravo Durand !"),
        ("Lou", None, None, "Bravo Lou !"),
        ("", "", "Top", "Bravo Collaborateur ! c'est Top !"),
        (None, None, None, "Bravo Collaborateur !"),
        ("  ", "\t", None, "Bravo Collaborateur !"),
        ("  Lou", "Durand  ", None, "Bravo Lou Durand !"),
    ],
)
def test_congratulation(spark, first, last, comment, message):
    df = spark.createDataFrame([(first, last, comment)], "p string, n string, c string")
    assert df.select(congratulation(F.col("p"), F.col("n"), F.col("c"))).first()[0] == message


def test_full_name_is_never_null(spark):
    df = spark.createDataFrame([(None, None)], "p string, n string")
    assert df.select(full_name(F.col("p"), F.col("n"))).first()[0] == "Collaborateur"


@pytest.mark.parametrize(
    ("points", "km"),
    [
        ((0.0, 0.0, 0.0, 0.0), 0.0),
        ((0.0, 0.0, 0.0, 180.0), math.pi * 6371),  # half the equator
        ((90.0, 0.0, 0.0, 77.0), math.pi / 2 * 6371),  # pole to equator
        ((0.0, 10.0, 0.0, 11.0), math.pi / 180 * 6371),  # one degree of the equator
        ((10.0, 179.5, 10.0, -179.5), 109.505),  # across the date line
        ((48.8566, 2.3522, 51.5074, -0.1278), 343.6),  # Paris to London
    ],
)
def test_known_distances(spark, points, km):
    df = spark.createDataFrame([points], "a double, b double, c double, d double")
    assert df.select(haversine_km(*map(F.col, "abcd"))).first()[0] == pytest.approx(km, rel=1e-3, abs=1e-9)


def test_distance_agrees_with_the_law_of_cosines(spark):
    there, back = (43.6, 3.9, -33.9, 18.4), (-33.9, 18.4, 43.6, 3.9)
    df = spark.createDataFrame([there, back], "a double, b double, c double, d double")
    found = [r[0] for r in df.select(haversine_km(*map(F.col, "abcd"))).collect()]
    a, b, c, d = map(math.radians, there)
    angle = math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(b - d))
    assert found == pytest.approx([6371 * angle] * 2)


def test_haversine_of_missing_coordinates(spark):
    df = spark.createDataFrame([(None, 3.9), (43.6, None)], "a double, b double")
    assert [r[0] for r in df.select(distance_to_office_km(F.col("a"), F.col("b"))).collect()] == [None, None]


RECORD = T.StructType([T.StructField("id", T.IntegerType(), False), T.StructField("name", T.StringType())])


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value binary")


def framed(record, number=7):
    return bytearray(b"\x00" + number.to_bytes(4, "big") + json.dumps(record).encode())


def test_decode_strips_the_header(spark):
    df = frame(spark, framed({"id": 1, "name": "é"}), framed({"id": 2}))
    assert [tuple(r) for r in decode(df, from_json_payload(RECORD)).collect()] == [(1, "é"), (2, None)]


def test_decode_of_header_only_null_and_garbage(spark):
    df = frame(spark, bytearray(b"\x00\x00\x00\x00\x07"), None, bytearray(b"\x00\x00\x00\x00\x07{nonsense"))
    assert [tuple(r) for r in decode(df, from_json_payload(RECORD)).collect()] == [(None, None)] * 3


def test_header_fields(spark):
    df = frame(spark, framed({}, 7), framed({}, 300), None)
    assert [r[0] for r in df.select(schema_id(F.col("value"))).collect()] == [7, 300, None]
    assert df.select(payload(F.col("value"))).first()[0] == b"{}"


def test_decode_of_one_schema_only(spark):
    df = frame(spark, framed({"id": 1}, 7), framed({"id": 2}, 8))
    assert [r.id for r in decode(df, from_json_payload(RECORD), only_schema=8).collect()] == [2]


def test_avro_schema_of_a_record():
    schema = json.loads(avro_schema(RECORD, "r"))
    assert schema["fields"] == [
        {"name": "id", "type": "int"},
        {"name": "name", "type": ["null", "string"], "default": None},
    ]


def test_avro_codec(spark):
    # id 1 as zigzag, branch 1 of the union, a string of two bytes; then id 2 with branch 0
    header = b"\x00\x00\x00\x00\x07"
    messages = frame(spark, bytearray(header + b"\x02\x02\x04" + "é".encode()), bytearray(header + b"\x04\x00"))
    try:
        records = decode(messages, from_avro_payload(avro_schema(RECORD)))
    except AnalysisException as error:
        assert error.getCondition() == "AVRO_NOT_LOADED_SQL_FUNCTIONS_UNUSABLE"
        pytest.skip("Spark's Avro module is not on the class path")
    assert [tuple(r) for r in records.collect()] == [(1, "é"), (2, None)]


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("2026-01-31", "2026-01-31"), (" 2026-01-31 08:00:00\t", "2026-01-31"), ("\t31/1/2026", "2026-01-31"), ("31/01/2026 08:00:00", "2026-01-31"),
        ("2026-01-31T08:00:00", "2026-01-31"), ("45321", None), ("2026", None), ("2026-05", None), ("2026-01-01 foo", None), ("31/2/2026", None),
        ("2026-02-30", None), ("1/13/2026", None), ("", None), (None, None),
    ],
)
def test_only_the_two_notations_are_dates(spark, text, date):
    from commutewell.functions.dates import as_date, as_moment

    row = spark.createDataFrame([(text,)], "t string").select(as_date(F.col("t")), as_moment(F.col("t"))).first()
    assert (None if row[0] is None else str(row[0])) == date and (row[1] is None) == (date is None)


def test_any_header_has_a_schema_id(spark):
    from commutewell.functions.wire import schema_id

    values = [(bytearray(b"\x00\xff\xff\xff\xff{}"),), (bytearray(b"\x00\x00\x00\x00\x07{}"),), (bytearray(b"\x00\x01"),), (None,)]
    found = [r[0] for r in spark.createDataFrame(values, "value binary").select(schema_id(F.col("value"))).collect()]
    assert found == [2**32 - 1, 7, None, None]


def test_a_place_listed_twice_doubles_nothing(spark):
    from commutewell.operators.lookup import geocode

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, address string")
    places = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 9.0)], "address string, lat double")
    assert sorted(map(tuple, geocode(df, places, "address").select("id", "lat").collect())) == [(1, 1.0), (2, None), (3, None)]
