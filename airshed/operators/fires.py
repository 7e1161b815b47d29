"""Active-fire records: interpretation beside the source fields, reports, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.config import (
    ACTIVE_STAGE_CODES,
    CODED_FIELDS,
    DOCUMENTED_CAUSE_CODES,
    FIRE_CHECKS,
    INSTANT_FIELDS,
    RESPONSE_CODES,
    SENTINEL_FIELDS,
    STAGE_CODES,
    TEXT_FIELDS,
)
from airshed.functions.moments import epoch_ms_to_utc
from airshed.functions.text import number_sql
from airshed.operators.grouping import latest, literal_rows
from airshed.operators.quality import code_frequency


def number(field: str) -> str:
    return number_sql(f"trim(cast({field} as string))")


def _labels(code: str, pairs: list[tuple[str, str]]) -> str:
    """Label of a code, null when unknown."""
    cases = " ".join(f"when '{c}' then '{label}'" for c, label in pairs)
    return f"case {code} {cases} end"


def stage_columns(code: str) -> dict[str, str]:
    """Confirmed and provisional readings of the stage code, kept in separate columns."""
    confirmed = _labels(code, [(c, label) for c, label, status in STAGE_CODES if status == "Confirmed"])
    provisional = _labels(
        code, [(c, label) for c, label, status in STAGE_CODES if status == "Provisional"]
    )
    active = ", ".join(f"'{c}'" for c in ACTIVE_STAGE_CODES)
    return {
        "stage_of_control_label": confirmed,
        "stage_of_control_label_provisional": provisional,
        "stage_of_control_mapping_status": f"case when {provisional} is not null then 'Provisional'"
        f" when {confirmed} is not null then 'Confirmed' else 'Unmapped' end",
        "stage_of_control_display_label": f"coalesce({confirmed}, {provisional}, 'Unmapped')",
        "is_active_fire": f"coalesce({code} in ({active}), false)",
    }


def response_label(code: str) -> str:
    return f"coalesce({_labels(code, RESPONSE_CODES)}, 'Unmapped')"


def cause_columns(agency: str, system: str) -> dict[str, str]:
    """Only the pair LTG with L is read, as lightning; L alone is never rolled up."""
    lightning = f"{agency} = 'LTG' and {system} = 'L'"
    return {
        "cause_interpretation_provisional": f"if({lightning}, 'Lightning', 'Unmapped')",
        "cause_mapping_status": f"if({lightning}, 'High-confidence provisional', 'Requires review')",
    }


def sentinel_columns(columns: list[str]) -> dict[str, str]:
    return {f"{f}_is_minus_one": f"coalesce({f} = -1, false)" for f in SENTINEL_FIELDS if f in columns}


def clean_fires(raw: DataFrame) -> DataFrame:
    """Source fields unchanged, plus every cleaned or interpreted column the input allows."""
    have = raw.columns
    texts = {new: f"trim(cast({old} as string))" for new, old in TEXT_FIELDS.items() if old in have}
    extra: dict[str, str] = {}
    if "stage_of_control_code" in texts:
        extra |= stage_columns("stage_of_control_code")
    if "response_type_code" in texts:
        extra["response_type_label"] = response_label("response_type_code")
    if "FIELD_FIRE_SIZE" in have:
        extra["fire_size_hectares"] = number("FIELD_FIRE_SIZE")
    # The point's own coordinates stand in only when the attribute column is absent altogether.
    for new, old, fallback in (
        ("latitude", "FIELD_LATITUDE", "geometry_latitude"),
        ("longitude", "FIELD_LONGITUDE", "geometry_longitude"),
    ):
        extra[new] = number(old) if old in have else fallback
    known = "agency_fire_cause_code" in texts and "system_fire_cause_code" in texts
    extra |= cause_columns(
        "agency_fire_cause_code" if known else "cast(null as string)",
        "system_fire_cause_code" if known else "cast(null as string)",
    )
    extra |= sentinel_columns(have)
    cleaned = raw.selectExpr("*", *[f"{e} as {n}" for n, e in texts.items()])
    cleaned = cleaned.selectExpr("*", *[f"{e} as {n}" for n, e in extra.items()])
    return cleaned.withColumns(
        {new: epoch_ms_to_utc(F.col(old)) for new, old in INSTANT_FIELDS.items() if old in have}
    )


def active_only(cleaned: DataFrame) -> DataFrame:
    return cleaned.where("is_active_fire")


def fire_code_frequency(raw: DataFrame) -> DataFrame:
    return code_frequency(raw, CODED_FIELDS)


def validation_report(cleaned: DataFrame) -> DataFrame:
    """The (check_name, value) table. Two aggregates: the checks, and duplicates by id size."""

    status = "double(count_if(stage_of_control_mapping_status = '{}'))"
    values = [
        "double(count(1))",
        "double(count_if(FIELD_AGENCY_FIRE_ID is null))",
        "double(count_if(latitude is null))",
        "double(count_if(longitude is null))",
        "double(count_if(fire_size_hectares is null))",
        "min(fire_size_hectares)",
        "max(fire_size_hectares)",
        status.format("Confirmed"),
        status.format("Provisional"),
        status.format("Unmapped"),
        "double(count_if(cause_mapping_status = 'Requires review'))",
    ]
    checks = dict(zip(FIRE_CHECKS, values, strict=True))
    one_row = cleaned.agg(*[F.expr(c).alias(name) for name, c in checks.items()])
    report = one_row.unpivot([], list(checks), "check_name", "value")
    duplicates = (
        cleaned.groupBy("OBJECTID")
        .agg((F.count(F.lit(1)) - 1).alias("extra"))
        .agg(F.coalesce(F.sum("extra"), F.lit(0)).cast("double").alias("value"))
        .select(F.lit("duplicate_objectids").alias("check_name"), "value")
    )
    return report.unionByName(duplicates)


def _known(spark, field_codes: list[tuple[str, str]]) -> DataFrame:
    return literal_rows(spark, ["field_name", "code_value"], field_codes)


def unknown_codes(raw: DataFrame) -> DataFrame:
    """Stage codes in no table, and system causes outside the documented set."""
    stage, cause = "FIELD_STAGE_OF_CONTROL_STATUS", "FIELD_SYSTEM_FIRE_CAUSE"
    known = _known(
        raw.sparkSession,
        [(stage, c) for c, _, _ in STAGE_CODES]
        + [(cause, c) for c in DOCUMENTED_CAUSE_CODES]
        + [(stage, "<MISSING>"), (cause, "<MISSING>")],
    )
    return code_frequency(raw, [stage, cause]).join(known, ["field_name", "code_value"], "left_anti")


def provisional_codes_seen(raw: DataFrame) -> DataFrame:
    stage = "FIELD_STAGE_OF_CONTROL_STATUS"
    known = _known(raw.sparkSession, [(stage, c) for c, _, s in STAGE_CODES if s == "Provisional"])
    return code_frequency(raw, [stage]).join(known, ["field_name", "code_value"], "left_semi")


# --- snapshots ---------------------------------------------------------------------------------


def latest_state(history: DataFrame, key: str, as_of: list[str]) -> DataFrame:
    """Latest known state per event."""
    return latest(history, [key], as_of)


def snapshot_steps(snapshots: DataFrame, number: str) -> DataFrame:
    """(previous_no, snapshot_no) for consecutive snapshots: one row per snapshot taken."""
    taken = snapshots.agg(F.array_sort(F.collect_set(number)).alias("taken"))
    return (
        taken.select("taken", F.posexplode("taken").alias("at", "previous_no"))
        .select("previous_no", F.try_element_at("taken", F.col("at") + 2).alias("snapshot_no"))
        .where(F.col("snapshot_no").isNotNull())
    )


def snapshot_diff(snapshots: DataFrame, key: str, number: str, compared: list[str]) -> DataFrame:
    """Each snapshot against the one taken before it: fires new, gone and changed.

    A snapshot has at most one row per fire. Each row is read once and counts as "now" of its own
    snapshot and as "before" of the next one; a single aggregate over (fire, snapshot) pairs the two.
    """
    steps = snapshot_steps(snapshots, number)
    # Per snapshot number (one small row each): whether one was taken before it, and the next one.
    places = (
        steps.select(F.col("snapshot_no").alias("__no"), F.lit(True).alias("__later"), F.lit(None).cast(steps.schema["snapshot_no"].dataType).alias("__next"))
        .unionByName(steps.select(F.col("previous_no").alias("__no"), F.lit(None).cast("boolean").alias("__later"), F.col("snapshot_no").alias("__next")))
        .groupBy("__no")
        .agg(F.max("__later").alias("__later"), F.max("__next").alias("__next"))
    )
    state = F.struct(*[F.col(c) for c in compared])
    nothing = F.lit(None).cast(snapshots.select(state.alias("s")).schema["s"].dataType)
    as_now = F.struct(F.col(number).alias("snapshot_no"), state.alias("now"), nothing.alias("before"))
    as_before = F.struct(F.col("__next").alias("snapshot_no"), nothing.alias("now"), state.alias("before"))
    roles = F.array_compact(F.array(F.when(F.col("__later"), as_now), F.when(F.col("__next").isNotNull(), as_before)))
    paired = (
        snapshots.join(F.broadcast(places), F.col(number) == F.col("__no"))
        .select(key, F.inline(roles))
        .groupBy(key, "snapshot_no")
        .agg(F.max("now").alias("now"), F.max("before").alias("before"))
    )
    changes = F.array_compact(
        F.array(
            *[
                F.when(~F.col(f"now.{c}").eqNullSafe(F.col(f"before.{c}")), F.lit(c))
                for c in compared
            ]
        )
    )
    return (
        paired.withColumn(
            "change",
            F.when(F.col("before").isNull(), "new")
            .when(F.col("now").isNull(), "gone")
            .when(F.size(changes) > 0, "changed"),
        )
        .where(F.col("change").isNotNull())
        .select(
            key,
            "snapshot_no",
            "change",
            F.when(F.col("change") == "changed", F.array_join(changes, ",")).alias("changed_fields"),
        )
    )
