import gzip
import hashlib
import itertools
import json

import pytest
from pyspark.sql import functions as F

from lanepulse import schemas as S
from lanepulse import storage
from lanepulse.operators import output, reshape, stations
from lanepulse.plans import adapters as A
from lanepulse.plans import round_trips, traffic
from lanepulse.sinks import files
from lanepulse.sinks import tables as keyed
from lanepulse.sources import events, ramp, snapshots, tables


def station_xml(sensor, classes, time="2023-11-15T08:30:00+01:00"):
    data = "".join(
        f'<meetdata klasse_id="{n}"><verkeersintensiteit>{i}</verkeersintensiteit>'
        f"<voertuigsnelheid_rekenkundig>{m}</voertuigsnelheid_rekenkundig>"
        f"<voertuigsnelheid_harmonisch>{h}</voertuigsnelheid_harmonisch></meetdata>"
        for n, i, m, h in classes)
    return (
        f'<meetpunt beschrijvende_id="H18L20" unieke_id="{sensor}"><lve_nr>12</lve_nr>'
        f"<tijd_waarneming>{time}</tijd_waarneming>"
        f"<tijd_laatst_gewijzigd>{time}</tijd_laatst_gewijzigd>"
        "<actueel_publicatie>0</actueel_publicatie><beschikbaar>1</beschikbaar>"
        f"<defect>0</defect><geldig>0</geldig>{data}<rekendata><bezettingsgraad>9"
        "</bezettingsgraad><beschikbaarheidsgraad>100</beschikbaarheidsgraad>"
        "<onrustigheid>0</onrustigheid></rekendata></meetpunt>")


def snapshot_file(folder, name, *bodies):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(
        '<?xml version="1.0" encoding="UTF-8"?><miv schemaVersion="1.0.0">'
        "<tijd_publicatie>2023-11-15T09:00:00.5+01:00</tijd_publicatie>"
        + "".join(bodies) + "</miv>")


@pytest.fixture
def xml_folder(tmp_path):
    folder = tmp_path / "xml" / "input"
    snapshot_file(
        folder, "4711.xml",
        station_xml(614, [(2, 0, 0, 252), (3, 2, 70, 68)]), station_xml(615, [(2, 3, 87, 84)]))
    (folder / "notes.txt").write_text("not a snapshot")
    return folder


def test_snapshot_xml(spark, xml_folder):
    rows = snapshots.read_snapshot_xml(spark, str(xml_folder))
    assert rows.count() == 2
    flat = {r.unieke_id: r for r in reshape.to_flat_events(rows, mode="wall_clock").collect()}
    assert flat["614"].tijd_waarneming == "1700037000"
    assert flat["614"].voertuigsnelheid_harmonisch_klasse2 == "252"
    assert flat["615"].voertuigsnelheid_rekenkundig_klasse2 == "87"
    assert flat["615"].voertuigsnelheid_rekenkundig_klasse1 is None
    kept = traffic.measurements_from_events(traffic.events_from_snapshot(rows), "*").collect()
    assert [(r.uniqueId, r.speed, r.bezettingsgraad) for r in kept] == [(615, 87, 9)]


def test_snapshot_json_and_landing(spark, xml_folder, tmp_path):
    named = snapshots.with_landed_name(snapshots.read_snapshot_xml(spark, str(xml_folder)))
    assert {r.landed_name for r in named.collect()} == {"json/input/4711.json"}
    files.land_json(named, str(tmp_path / "landed"))
    back = spark.read.schema(S.SNAPSHOT_STATION).json(str(tmp_path / "landed"))
    assert back.count() == 2

    document = {"miv": {"meetpunt": [
        {"@unieke_id": "704", "@beschrijvende_id": "H1", "tijd_waarneming":
         "2023-11-14T23:13:20+01:00", "meetdata": [
             {"@klasse_id": "2", "verkeersintensiteit": "4",
              "voertuigsnelheid_rekenkundig": "93", "voertuigsnelheid_harmonisch": "91"}],
         "rekendata": {"bezettingsgraad": "8"}},
        {"@unieke_id": "705", "meetdata": []},
    ]}}
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(document, indent=1))
    flat = reshape.to_flat_events(snapshots.read_snapshot_json(spark, str(folder)))
    first = flat.where("unieke_id = '704'").first()
    assert flat.count() == 2
    assert (first.voertuigsnelheid_rekenkundig_klasse2, first.rekendata_bezettingsgraad,
            first.tijd_waarneming) == ("93", "8", "1700000000")


def test_raw_landing(spark, xml_folder, tmp_path):
    raw = snapshots.read_raw_documents(spark, str(xml_folder), ingest_ms=77)
    files.land_raw(raw, str(tmp_path / "bronze"))
    row = spark.read.parquet(str(tmp_path / "bronze")).first()
    assert (row["name"], row.ingest_ms) == (f"xml/input/77-{hashlib.md5(row.source_file.encode()).hexdigest()[:12]}.xml", 77)
    assert row.document == (xml_folder / "4711.xml").read_text()
    assert row.source_file.endswith("4711.xml")


def test_events_jsonl_with_corrupt_lines(spark, tmp_path):
    path = tmp_path / "events"
    path.mkdir()
    (path / "a.json").write_text('{"unieke_id": 5, "tijd_waarneming": "7"}\nnot json\n')
    rows = events.read_events_jsonl(spark, str(path), corrupt_col="_corrupt").cache()
    assert {(r.unieke_id, r.tijd_waarneming, r._corrupt) for r in rows.collect()} == {
        ("5", "7", None), (None, None, "not json")}
    files.append_jsonl(rows.where("_corrupt IS NULL").drop("_corrupt"), str(tmp_path / "out"))
    files.append_jsonl(rows.where("_corrupt IS NULL").drop("_corrupt"), str(tmp_path / "out"))
    assert events.read_events_jsonl(spark, str(tmp_path / "out")).count() == 2


def test_publish_groups(spark, tmp_path):
    df = spark.range(250).selectExpr("cast(id as string) AS unieke_id").coalesce(1)
    files.publish_events(df, str(tmp_path / "p"), group=100)
    parts = list((tmp_path / "p").glob("part-*"))
    assert len(parts) == 3
    assert spark.read.text(str(tmp_path / "p")).count() == 250


STATION = {
    "@unieke_id": "4411", "beschrijvende_id": "H1", "volledige_naam": "Noordbrug",
    "lengtegraad_EPSG_4326": "3,5125", "breedtegraad_EPSG_4326": "50,75",
}


def config(spark, *changes):
    rows = [{**STATION, **c} for c in changes]
    return spark.createDataFrame(
        [tuple(r.get(c) for c in S.STATION_CONFIG.fieldNames()) for r in rows], S.STATION_CONFIG)


def test_geojson_feature(spark):
    row = stations.geojson_features(config(spark, {})).first()
    assert json.loads(row.json) == {
        "type": "Feature", "id": "4411",
        "geometry": {"type": "Point", "coordinates": [3.5125, 50.75]},
        "properties": {"name": "Noordbrug - 4411"},
    }


def test_geojson_document(spark, tmp_path):
    cfg = config(spark, {}, {"@unieke_id": "812"}, {"@unieke_id": "812"}, {"@unieke_id": "1"})
    files.write_geojson(cfg, str(tmp_path / "map"), ["812", "4411"])
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "map")).collect()]
    document = json.loads(line)
    assert document["type"] == "FeatureCollection"
    assert [f["id"] for f in document["features"]] == ["4411", "812", "812"]


def test_locations_round_trip(spark, tmp_path):
    built = stations.build_locations(config(spark, {})).coalesce(1)
    files.write_locations(built, str(tmp_path / "loc"))
    (part,) = (tmp_path / "loc").glob("part-*")
    assert part.read_text().splitlines()[0] == "locatieId\tlocatie\tid\tlongitude\tlatitude"
    rows = tables.read_locations(spark, str(tmp_path / "loc")).collect()
    assert [tuple(r) for r in rows] == [
        ("Noordbrug-4411", "Noordbrug", 4411, 3.5125, 50.75)]


def test_station_config_xml(spark, tmp_path):
    (tmp_path / "cfg.xml").write_text(
        '<mivconfig><meetpunt unieke_id="229"><beschrijvende_id>H291L10</beschrijvende_id>'
        "<volledige_naam>Oost</volledige_naam><lengtegraad_EPSG_4326>4,45</lengtegraad_EPSG_4326>"
        "<breedtegraad_EPSG_4326>51,21</breedtegraad_EPSG_4326></meetpunt></mivconfig>")
    row = stations.build_locations(
        snapshots.read_station_config(spark, str(tmp_path))).first()
    assert tuple(row) == ("Oost-229", "Oost", 229, 4.45, 51.21)


def _items(spark, *rows):
    base = {f: None for f in S.STATE.fieldNames()}
    full = [{**base, "uniqueId": k, "outputType": "SPEED_AVG", "currentSpeed": v}
            for k, v in rows]
    return spark.createDataFrame([tuple(r.values()) for r in full], S.STATE)


def _speeds(spark, path):
    return {r.uniqueId: r.currentSpeed for r in tables.scan_state(spark, path).collect()}


def test_keyed_table_merges_and_survives_replays(spark, tmp_path):
    path = str(tmp_path / "state")
    assert _speeds(spark, path) == {}
    keyed.write_state(spark, path, _items(spark, ("1", 10), ("2", 20)), 0)
    keyed.write_state(spark, path, _items(spark, ("2", 21), ("3", 30)), 1)
    assert _speeds(spark, path) == {"1": 10, "2": 21, "3": 30}
    keyed.write_state(spark, path, _items(spark, ("2", 22)), 1)
    assert _speeds(spark, path) == {"1": 10, "2": 22}
    for batch in range(2, 8):
        keyed.write_state(spark, path, _items(spark, ("4", batch)), batch)
    assert storage.versions(spark, path) == [5, 6, 7]
    assert _speeds(spark, path) == {"1": 10, "2": 22, "4": 7}


def test_unfinished_version_is_ignored(spark, tmp_path):
    path = tmp_path / "state"
    keyed.write_state(spark, str(path), _items(spark, ("1", 10)), 0)
    (path / "v=1").mkdir()
    assert _speeds(spark, str(path)) == {"1": 10}


def test_cleared_table_stays_clear_for_the_next_batch(spark, tmp_path):
    path = str(tmp_path / "state")
    for batch in range(3):
        keyed.write_state(spark, path, _items(spark, (str(batch), batch)), batch)
    keyed.clear_table(spark, path, S.STATE)
    assert _speeds(spark, path) == {}
    keyed.write_state(spark, path, _items(spark, ("9", 9)), 3)
    assert _speeds(spark, path) == {"9": 9}


def test_key_scan_reads_keys_only(spark, tmp_path):
    path = str(tmp_path / "state")
    keyed.write_state(spark, path, _items(spark, ("1", 10)))
    plan = tables.scan_keys(tables.scan_state(spark, path), S.STATE_KEYS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<uniqueId:string,outputType:string>" in text


def test_result_records_round_trip(spark, tmp_path):
    row = dict.fromkeys(S.RESULT_COLUMNS)
    row |= {"outputType": "SPEED_AVG", "uniqueId": 1, "recordTimestamp": 5}
    results = spark.createDataFrame([tuple(row.values())], S.RESULT)
    assert output.decode_results(output.encode_results(results)).first() == results.first()
    payload = json.loads(files.dashboard_payload(results).first().value)
    assert payload == [{"outputType": "SPEED_AVG", "uniqueId": 1, "recordTimestamp": 5,
                        "outputType_recordTimestamp": "SPEED_AVG_5"}]
    parts = output.route(results.withColumn("outputType", F.lit("OTHER")))
    assert all(df.count() == 0 for df in parts.values())
    assert output.route(results)["SPEED_AVG"].count() == 1


def test_speed_ramp(spark):
    sensors = spark.createDataFrame([("a", "x"), ("b", "y")], "unieke_id string, lve_nr string")
    rows = ramp.speed_ramp(sensors, 1000, 2).where("unieke_id = 'a'").orderBy("step").collect()
    speeds = [r.voertuigsnelheid_rekenkundig_klasse2 for r in rows]
    steps = [b - a for a, b in itertools.pairwise(speeds)]
    assert speeds[0] == 120 and [(k, len(list(g))) for k, g in itertools.groupby(steps)] == [
        (0, 10), (-5, 4), (-10, 6), (-2, 14)]
    assert [r.voertuigsnelheid_harmonisch_klasse2 for r in rows] == speeds
    assert [r.tijd_waarneming for r in rows] == [1000 + 2 * i for i in range(35)]
    assert rows[0].lve_nr == "x"


def test_work_folder_uses_the_shared_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert storage.work_folder(spark, "x").startswith(shared + "/x-")


def test_compressed_snapshots_are_read_whole_and_land_under_their_name(spark, xml_folder, tmp_path):
    folder = tmp_path / "xml" / "input" / "packed"
    folder.mkdir(parents=True)
    text = (xml_folder / "4711.xml").read_text()
    with gzip.open(folder / "12.a.xml.gz", "wt") as f:
        f.write(text)
    named = snapshots.with_landed_name(snapshots.read_snapshot_xml(spark, str(folder), glob=None))
    assert {r.landed_name for r in named.collect()} == {"json/input/packed/12.a.json"}
    files.land_json(named, str(tmp_path / "landed"), compression="gzip")
    assert list((tmp_path / "landed").rglob("*.json.gz"))
    assert spark.read.schema(S.SNAPSHOT_STATION).json(str(tmp_path / "landed")).count() == 2
    raw = snapshots.read_raw_documents(spark, str(folder), glob=None, ingest_ms=77)
    assert [r.document for r in raw.collect()] == [text]


def test_written_snapshots_are_compressed(spark, tmp_path, monkeypatch):
    kept = {}
    monkeypatch.setattr(round_trips.storage, "work_folder", lambda s, p: kept.setdefault(p, str(tmp_path / p)))
    round_trips.snapshot_xml(spark, "/root/testdata/sf0.001")
    assert list((tmp_path / "snapshot-xml").glob("*.xml.gz")) and not list((tmp_path / "snapshot-xml").glob("*.xml"))


def test_json_snapshots_hold_documents_of_bounded_size_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(round_trips.storage, "work_folder", lambda s, p: str(tmp_path / p))
    sf_dir = "/root/testdata/sf0.001"
    flat = round_trips.snapshot_json(spark, sf_dir)
    numbers = [int(r[0]) for r in A.snapshot_stations(spark, sf_dir).select("`@unieke_id`").collect()]
    assert flat.count() == len(numbers)
    documents = [json.load(gzip.open(p)) for p in (tmp_path / "snapshot-json").glob("part-*")]
    assert len(documents) == len({n // round_trips.STATIONS_PER_FILE for n in numbers})
    assert sum(map(len, documents)) == len({n // round_trips.STATIONS_PER_DOCUMENT for n in numbers})
    assert all(len(d["miv"]["meetpunt"]) <= round_trips.STATIONS_PER_DOCUMENT for f in documents for d in f)
