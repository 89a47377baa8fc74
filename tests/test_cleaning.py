import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse.functions import expressions as E
from lanepulse.functions import times
from lanepulse.operators import cleaning, reshape


def flat(spark, rows):
    """Flat events from partial dicts; fields not given are NULL."""
    full = [tuple(r.get(c) for c in S.FLAT_EVENT_COLUMNS) for r in rows]
    return spark.createDataFrame(full, S.FLAT_EVENT)


def event(sensor, harmonic, **other):
    return {"unieke_id": sensor, "voertuigsnelheid_harmonisch_klasse2": harmonic, **other}


@pytest.mark.parametrize("sensor,harmonic,spec,kept", [
    ("31", "86", "17, 31", True),
    ("44", "86", "17, 31", False),
    ("44", "86", "*", True),
    ("44", "252", "*", False),
    ("44", "254", "*", False),
    ("44", None, "*", True),
    ("31", "252", "17, 31", False),
    (None, "86", "17, 31", False),
    (None, "86", "*", True),
    ("3", "86", "31", False),
])
def test_filter_cases(spark, sensor, harmonic, spec, kept):
    df = flat(spark, [event(sensor, harmonic)])
    assert cleaning.matches_filter(df, spec).count() == int(kept)
    tagged = cleaning.tag_disposition(df.withColumn("recordId", F.lit("a")), spec).first()
    assert (tagged.recordId, tagged.result) == ("a", "Ok" if kept else "Dropped")
    assert (tagged.data is not None) == kept


def test_allow_list_from_a_table(spark):
    df = flat(spark, [event("1", "80"), event("2", "80"), event("3", "252")])
    ids = spark.createDataFrame([("2",), ("2",), ("3",)], "sensor string")
    assert [r.unieke_id for r in cleaning.matches_filter(df, ids).collect()] == ["2"]


def test_class_removal(spark):
    row = {"unieke_id": "1"}
    for n, harmonic in zip(S.CLASSES, ("252", "80", "254", "252", None)):
        intensity, mean, harm = S.class_columns(n)
        row |= {intensity: "1", mean: "2", harm: harmonic}
    cleaned = cleaning.remove_non_measurements(flat(spark, [row])).first().asDict()
    for n in S.CLASSES:
        values = [cleaned[c] for c in S.class_columns(n)]
        expected = [None] * 3 if n in (1, 4) else ["1", "2", row[S.class_columns(n)[2]]]
        assert values == expected


def test_disposition_payload_is_the_cleaned_event(spark):
    df = flat(spark, [event("1", "80", voertuigsnelheid_harmonisch_klasse5="252",
                            verkeersintensiteit_klasse5="9")])
    tagged = cleaning.tag_disposition(df.withColumn("recordId", F.lit("r")), "*").first()
    assert json.loads(tagged.data) == {
        "unieke_id": "1", "voertuigsnelheid_harmonisch_klasse2": "80"}


def test_dispositions_are_counted_on_the_way(spark):
    df = flat(spark, [event("1", "80"), event("2", "252"), event("3", "90")])
    seen = Observation("dispositions")
    tagged = cleaning.tag_disposition(df.withColumn("recordId", F.col("unieke_id")), "*")
    assert cleaning.observe_dispositions(tagged, seen).count() == 3
    assert seen.get == {"records": 3, "ok": 2}


@pytest.mark.parametrize("record,expected", [
    ({"unieke_id": "12", "tijd_waarneming": 1700000007}, (12, 1700000007)),
    ({"unieke_id": 12, "tijd_waarneming": "1700000007"}, (12, 1700000007)),
    ({"unieke_id": "x", "tijd_waarneming": 4_000_000_000}, (None, 4_000_000_000)),
    ({}, (None, None)),
])
def test_numbers_may_be_quoted(spark, record, expected):
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    row = cleaning.parse_events(df).first()
    assert (row.unieke_id, row.tijd_waarneming) == expected


def test_input_row_types_and_lengths(spark):
    record = {"beschrijvende_id": "H123456789", "tijd_laatst_gewijzigd": "t" * 40}
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    parsed = cleaning.parse_events(df)
    assert len(parsed.columns) == 18
    assert [f.dataType for f in parsed.schema] == [f.dataType for f in S.INPUT_ROW]
    assert parsed.first().beschrijvende_id == "H1234567"
    assert len(parsed.first().tijd_laatst_gewijzigd) == 32


def test_clean_input(spark):
    record = {"unieke_id": "812", "tijd_waarneming": 1700000007,
              "voertuigsnelheid_rekenkundig_klasse2": "120", "rekendata_bezettingsgraad": "6"}
    df = spark.createDataFrame([(json.dumps(record),)], "value string")
    row = cleaning.clean_input(cleaning.parse_events(df)).select(
        "uniqueId", "speed", "bezettingsgraad", F.unix_seconds("recordTimestamp")).first()
    assert tuple(row) == (812, 120, 6, 1700000007)


@pytest.mark.parametrize("text,instant,wall_clock", [
    ("2023-11-14T23:13:20+01:00", "1700000000", "1700003600"),
    ("2023-11-15T08:30:00+01:00", "1700033400", "1700037000"),
    ("2023-11-15T08:30:00Z", "1700037000", "1700037000"),
    ("no time", None, None),
    (None, None, None),
])
def test_observation_times(spark, new_york, text, instant, wall_clock):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        times.observed_epoch(F.col("t")), times.observed_epoch(F.col("t"), "wall_clock"))
    assert tuple(row.first()) == (instant, wall_clock)
    with pytest.raises(ValueError):
        times.observed_epoch(F.col("t"), "other")


def test_zoneless_micros_round_trip(spark, new_york):
    df = spark.sql("SELECT timestamp_ntz'2020-03-08 02:30:00.123456' AS t")
    micros = times.epoch_micros(df, "t")
    row = df.select(
        micros.alias("us"), times.epoch_millis(df, "t").alias("ms"),
        times.utc_wall_clock(micros).cast("string").alias("back"),
        F.unix_micros(times.as_utc_instant(df, "t")).alias("again")).first()
    assert row.us == row.again == 1583634600123456
    assert row.ms == 1583634600123
    assert row.back == "2020-03-08 02:30:00.123456"


@pytest.mark.parametrize("value,text", [
    (2.0, "2"), (-3.0, "-3"), (2.5, "2.5"), (-1.5, "-1.5"), (None, None),
])
def test_number_text(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(E.normalize_number(F.col("v"))).first()[0] == text


def test_expressions(spark):
    df = spark.createDataFrame([(None, "{}")], "n long, j string")
    row = df.select(
        E.composite_key(F.lit("SPEED_AVG"), F.col("n")).alias("key"),
        E.decode_payload(E.encode_payload(F.col("j"))).alias("payload"),
        E.landed_name(F.lit("s3a://b/xml/input/12.5.xml"), "xml/input/", "json/input/", ".json")
        .alias("name"),
        times.now_epoch_seconds(5).alias("s"), times.now_epoch_millis(6).alias("ms"),
        (times.now_epoch_millis() / 1000 - times.now_epoch_seconds()).alias("gap"),
    ).first()
    assert row.key == "SPEED_AVG_None"
    assert row.payload == "{}"
    assert row.name == "json/input/12.5.json"
    assert (row.s, row.ms) == (5, 6)
    assert 0 <= row.gap < 1


def test_strip_marker_everywhere(spark):
    df = spark.sql("""SELECT 'a@b' AS `@x`, array(struct('@1' AS `@k`, 2 AS n)) AS arr,
        map('@m', '@v') AS m, cast(null AS struct<`@q`: string>) AS s""")
    row = reshape.strip_marker(df).first().asDict(recursive=True)
    assert row == {"x": "ab", "arr": [{"k": "1", "n": 2}], "m": {"m": "v"}, "s": None}


def test_pivot_keeps_the_last_of_a_class_and_nulls_missing_ones(spark):
    entry = "struct<klasse_id:string,verkeersintensiteit:string," \
            "voertuigsnelheid_rekenkundig:string,voertuigsnelheid_harmonisch:string>"
    df = spark.createDataFrame(
        [(1, [("2", "1", "2", "3"), ("7", "7", "7", "7"), ("2", "4", "5", "6")]), (2, None)],
        f"id int, meetdata array<{entry}>")
    rows = {r.id: r.asDict() for r in reshape.pivot_classes(df).collect()}
    assert [rows[1][c] for c in S.class_columns(2)] == ["4", "5", "6"]
    for n in (1, 3, 4, 5):
        assert [rows[1][c] for c in S.class_columns(n)] == [None] * 3
    assert [rows[2][c] for c in S.class_columns(2)] == [None] * 3


def test_flatten_nested(spark):
    df = spark.sql("SELECT 1 AS a, struct(2 AS b, struct(3 AS d) AS c) AS s")
    flat_df = reshape.flatten_struct(df, "s")
    assert flat_df.columns == ["a", "s_b", "s_c_d"]
    assert tuple(flat_df.first()) == (1, 2, 3)


def test_english_names():
    assert S.ENGLISH_NAMES["unieke_id"] == "sensor_id"
