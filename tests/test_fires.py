from conftest import as_set, dicts

from airshed.operators import fires
from airshed.operators.quality import order_frequency

DDL = (
    "OBJECTID bigint, FIELD_AGENCY_FIRE_ID string, FIELD_AGENCY_CODE string, FIELD_STAGE_OF_CONTROL_STATUS string, "
    "FIELD_AGENCY_FIRE_CAUSE string, FIELD_SYSTEM_FIRE_CAUSE string, FIELD_RESPONSE_TYPE string, FIELD_FIRE_SIZE string, "
    "FIELD_LATITUDE string, FIELD_LONGITUDE string"
)
# Counts of the published snapshot.
STAGES = {"EX": 481, "BM": 115, "OC": 29, "BH": 10, "UC": 6}
CAUSES = {("LTG", "L"): 421, ("HUM", "H"): 220}
RESPONSES = {"FUL": 496, "MON": 111, "MNP": 16, "MOD": 15, "MDP": 2, "-1": 1}


def spread(counts):
    return [k for k, n in counts.items() for _ in range(n)]


def snapshot(spark):
    data = [
        (i, f"F{i}", "ON", s, c[0], c[1], r, "0.1" if i else "313930.0", "48.5", "-89.0")
        for i, (s, c, r) in enumerate(zip(spread(STAGES), spread(CAUSES), spread(RESPONSES)))
    ]
    return spark.createDataFrame(data, DDL)


def test_published_snapshot_counts(spark):
    raw = snapshot(spark)
    cleaned = fires.clean_fires(raw)
    freq = {(r["field_name"], r["code_value"]): r["record_count"] for r in fires.fire_code_frequency(raw).collect()}
    assert {k[1]: n for k, n in freq.items() if k[0] == "FIELD_STAGE_OF_CONTROL_STATUS"} == STAGES
    assert {k[1]: n for k, n in freq.items() if k[0] == "FIELD_RESPONSE_TYPE"} == RESPONSES
    assert freq[("FIELD_AGENCY_FIRE_CAUSE", "LTG")] == 421 and freq[("FIELD_AGENCY_CODE", "ON")] == 641
    ordered = order_frequency(fires.fire_code_frequency(raw), fires.CODED_FIELDS).collect()
    assert [r["code_value"] for r in ordered][:6] == ["EX", "BM", "OC", "BH", "UC", "LTG"]
    checks = {r["check_name"]: r["value"] for r in fires.validation_report(cleaned).collect()}
    assert checks == {
        "total_records": 641.0, "missing_fire_ids": 0.0, "duplicate_objectids": 0.0, "missing_latitude": 0.0,
        "missing_longitude": 0.0, "missing_fire_size": 0.0, "minimum_fire_size_hectares": 0.1,
        "maximum_fire_size_hectares": 313930.0, "confirmed_stage_records": 526.0, "provisional_stage_records": 115.0,
        "unmapped_stage_records": 0.0, "cause_codes_requiring_review": 220.0,
    }
    assert fires.active_only(cleaned).count() == 160
    assert fires.unknown_codes(raw).collect()[0].asDict() == {
        "field_name": "FIELD_SYSTEM_FIRE_CAUSE", "code_value": "L", "record_count": 421,
    }
    assert as_set(fires.provisional_codes_seen(raw)) == [("FIELD_STAGE_OF_CONTROL_STATUS", "BM", 115)]


def test_interpretation_of_odd_codes(spark):
    data = [
        (1, None, "ON", " BM ", "LTG", "H", "MNP", "n/a", None, "x"), (2, "a ", "ON", None, None, "L", None, None, "1", "2"),
        (3, "b", "ON", "ZZ", "LTG", "L", "FUL", "5", "1", "2"),
    ]
    got = {r["OBJECTID"]: r for r in dicts(fires.clean_fires(spark.createDataFrame(data, DDL)))}
    assert (got[1]["stage_of_control_mapping_status"], got[1]["is_active_fire"], got[1]["response_type_label"]) == ("Provisional", True, "Unmapped")
    assert got[1]["FIELD_STAGE_OF_CONTROL_STATUS"] == " BM " and got[1]["fire_size_hectares"] is None and got[1]["longitude"] is None
    assert (got[2]["stage_of_control_display_label"], got[2]["is_active_fire"], got[2]["fire_id"]) == ("Unmapped", False, "a")
    assert [got[i]["cause_interpretation_provisional"] for i in (1, 2, 3)] == ["Unmapped", "Unmapped", "Lightning"]


def test_geometry_stands_in_only_for_an_absent_column(spark):
    with_attr = spark.sql("select 1 as OBJECTID, cast(null as string) as FIELD_LATITUDE, 9D as geometry_latitude, 8D as geometry_longitude")
    r = fires.clean_fires(with_attr).first()
    assert (r["latitude"], r["longitude"]) == (None, 8.0)
    assert r["cause_mapping_status"] == "Requires review"


def test_sentinels_and_instants(spark):
    df = spark.sql(
        "select * from values (-1D, '1785449040000'), (0D, 'x'), (cast(null as double), null) as t(FIELD_LOCATION, FIELD_STATUS_DATE)"
    ).selectExpr("*", "0D as geometry_latitude", "0D as geometry_longitude")
    got = [(r["FIELD_LOCATION_is_minus_one"], str(r["status_datetime_utc"])) for r in fires.clean_fires(df).collect()]
    assert sorted(got) == [(False, "None"), (False, "None"), (True, "2026-07-30 22:04:00")]


def test_snapshot_diff_against_the_snapshot_before(spark):
    data = [
        ("a", 1, "OC", 1.0), ("a", 4, "BH", 1.0), ("a", 9, "BH", 1.0), ("b", 1, "OC", 2.0), ("b", 9, "OC", 2.0), ("c", 4, None, 3.0),
        ("c", 9, None, 4.0), ("d", 4, "UC", 0.0),
    ]
    df = spark.createDataFrame(data, "fire_id string, n int, stage string, size double")
    assert as_set(fires.snapshot_diff(df, "fire_id", "n", ["stage", "size"])) == sorted(
        [
            ("a", 4, "changed", "stage"), ("b", 4, "gone", None), ("c", 4, "new", None), ("d", 4, "new", None),
            ("b", 9, "new", None), ("c", 9, "changed", "size"), ("d", 9, "gone", None),
        ],
        key=repr,
    )
    latest = fires.latest_state(df, "fire_id", ["n"])
    assert sorted((r["fire_id"], r["n"]) for r in latest.collect()) == [("a", 9), ("b", 9), ("c", 9), ("d", 4)]
