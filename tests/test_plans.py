"""The physical plans the operators are built for."""

import re

import pytest
from pyspark.sql import functions as F

import fixtures as X
from lanepulse.operators import cleaning, output, slices, state, windows
from lanepulse.plans import adapters, traffic

SF_DIR = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """The plan as it ran, after adaptive changes."""
    df.toPandas()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"(?<!Reused)Exchange (hashpartitioning\(.*?\)|SinglePartition|\w+)", text)


@pytest.fixture
def measurements(spark):
    return adapters.measurements(spark, SF_DIR)


@pytest.fixture
def locations(spark):
    return adapters.locations(spark, SF_DIR)


def test_windows_scan_once_and_never_partition_by_sensor_alone(measurements):
    text = final_plan(windows.speed_readings(measurements, **adapters.WINDOWS))
    assert text.count("FileScan") == 1
    assert "ReusedExchange" in text
    # The frames and LAG share one Window; the other one has a row per slice.
    assert len(re.findall(r"[-+] Window \[", text)) == 2
    assert re.search(r"Window \[lag\(speed.*RangeFrame.*\[uniqueId#\d+, _slice#\d+L\]", text)


def test_crowded_instants_keep_all_copies(spark):
    rows = [(1, float(X.START), 50, 5)] * 50 + X.sequence([10, 20, 30])
    assert windows.speed_readings(X.measurements(spark, rows)).count() == 53


def test_partial_aggregation_comes_before_the_first_shuffle(measurements):
    text = planned(windows.collapse_instants(measurements))
    assert text.index("functions=[sum(") < text.index("Exchange") < text.index("partial_sum")


def test_change_detection_keeps_the_partitioning(measurements, locations):
    text = planned(traffic.jam_versions(measurements, locations, **adapters.WINDOWS))
    shuffles = [e for e in exchanges(text) if "_slice" in e]
    assert len(shuffles) == 1
    assert any("_edge" in e for e in exchanges(text))


def test_results_explode_once(measurements, locations):
    text = planned(output.traffic_output(
        windows.speed_profile(measurements, **adapters.WINDOWS)
        .withColumn("trafficJamIndicator", F.lit(0)).withColumn("speedDiffIndicator", F.lit(0)),
        locations))
    assert text.count("Generate explode(array(struct") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_large_location_table_is_not_broadcast(spark, measurements, locations):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = planned(output.enrich_location(measurements, locations))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze")
    adapters.flat_events(spark, SF_DIR).write.parquet(path)
    events = spark.read.parquet(path)
    text = planned(traffic.measurements_from_events(events, "1, 2"))
    assert "PushedFilters" in text and "unieke_id" in text.split("PushedFilters")[1]
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert len(schema.split(",")) == 5
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_state_needs_no_list_of_unknown_length(measurements, locations):
    items = traffic.traffic_state(measurements, locations, **adapters.WINDOWS)
    assert "collect_list" not in planned(state.current_situation(items))


def test_edge_rows_are_two_per_slice(spark):
    rows = [(1, i * 1000, i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "k int, t long, flag int").withColumn(
        slices.SLICE, F.floor(F.col("t") / 100_000))
    seen = slices.previous_in_slices(df, ["k"], ["t"], F.col("flag"), "before")
    got = {r.t: r.before for r in seen.collect()}
    assert got == {i * 1000: (i - 1) % 2 if i else None for i in range(1000)}


def test_filter_has_no_shuffle(spark):
    text = planned(cleaning.preprocess(adapters.flat_events(spark, SF_DIR), "*"))
    assert "Exchange" not in text
