"""The star schema as one build: models written as versions, checked there, and published together at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farebox.operators.checks import RESULT, CheckFailed, run_other_checks, watched
from farebox.operators.tables import replace_table
from farebox.operators.versions import Version, discard, publish, stage
from farebox.plans import marts, staging
from farebox.schemas import AMOUNTS

CHECK_RESULTS = "check_results"


class Build:
    """Models of one build. Each is stored as a version that is not in force and checked there: checks on rows are counted
    while it is written, others read what was written. ``finish`` publishes all of them; a failed check ends the build."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        self.versions: list[Version] = []
        self.outcomes: list[tuple] = []

    def judge(self, model: str, outcomes: list[tuple]) -> None:
        self.outcomes += [(model, *o) for o in outcomes]
        failed = [f"{check}({column})" for check, column, *_, passed in outcomes if not passed]
        if failed:
            raise CheckFailed("; ".join(failed))

    def check(self, model: str, *frames: DataFrame) -> None:
        """Checks of rows that the build doesn't store."""
        self.judge(model, [tuple(r) for frame in frames for r in frame.collect()])

    def put(self, model: str, rows: DataFrame, checks: list) -> DataFrame:
        """Store a model and check it; returns the stored rows, which later models are made of."""
        counted, row_outcomes = watched(rows, checks)
        version = stage(counted, f"{self.database}.{model}")
        self.versions.append(version)
        stored = self.spark.table(version.table)
        if checks:
            self.judge(model, row_outcomes() + run_other_checks(stored, checks))
        return stored

    def finish(self) -> None:
        for version in self.versions:
            publish(version, self.spark)

    def __enter__(self) -> Build:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.finish()
        else:
            for version in self.versions:
                discard(self.spark, version)
        rows = self.spark.createDataFrame(self.outcomes, f"model string, {RESULT}")
        replace_table(rows.coalesce(1), f"{self.database}.{CHECK_RESULTS}")


def build_marts(
    spark: SparkSession, database: str, root: str, green_raw: DataFrame, yellow_raw: DataFrame,
    payment_types: DataFrame, zone_lookup: DataFrame,
) -> None:
    """Store the star schema in ``database``, whose tables lie under ``root``, and run every declared check.

    Seeds are checked first, then staging, then each model on what was stored. No model is published before all are made and
    checked: the first failed check ends the build with ``CheckFailed``, and every model, the failed one included, keeps what
    the last good build stored. The outcomes of the checks of this build, good or not, are the rows of ``check_results``.
    Models are published one after the other, each in one action; running the build again replaces all of them.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}'")
    with Build(spark, database) as build:
        build.check("payment_type_lookup", marts.check_payment_types(payment_types))
        zones = build.put("dim_zones", marts.dim_zones(zone_lookup), marts.dim_zones_checks())

        # staging is not stored, and counting it below the shuffle of the trips could count a repeated task twice
        green = staging.stg_green_tripdata(green_raw, uncast=AMOUNTS)
        yellow = staging.stg_yellow_tripdata(yellow_raw, uncast=AMOUNTS)
        build.check("staging", marts.check_stg_trips(green), marts.check_stg_trips(yellow))

        trips = build.put("int_trips", marts.int_trips(marts.int_trips_unioned(green, yellow), payment_types), marts.int_trips_checks())
        build.put("dim_vendors", marts.dim_vendors(trips), [])
        build.put("dim_payment_types", marts.dim_payment_types(payment_types), [])
        build.put("fct_trips", marts.fct_trips(trips, zones), marts.fct_trips_checks(zones))
        build.put("fct_monthly_zone_revenue", marts.monthly_zone_revenue(trips, zones), marts.monthly_revenue_checks())
