"""Run metrics as a table: one row per run, from which alerts and shares are derived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits beyond which a run raises an alert.
SLOW_SECONDS = 300.0
MAX_FILTERED_PCT = 20.0

#: Runs that a run is compared with, and how far it may lie above their medians.
DEVIATION_SPAN = 5
MAX_RATIO = 1.5
MAX_EXCESS_PCT = 5.0

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_duration_seconds", T.DoubleType()),
        T.StructField("stage_durations", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("input_rows", T.MapType(T.StringType(), T.LongType())),
        T.StructField("output_rows", T.LongType()),
        T.StructField("rows_filtered", T.LongType()),
        T.StructField("data_quality_passed", T.BooleanType()),
        T.StructField("data_quality_warnings", T.LongType()),
        T.StructField("data_quality_errors", T.LongType()),
        T.StructField("segments", T.MapType(T.StringType(), T.LongType())),
        T.StructField("errors", T.ArrayType(T.StringType())),
    ]
)


def total_input(input_rows: Column) -> Column:
    """Rows of all inputs of a run."""
    return F.aggregate(F.map_values(input_rows), F.lit(0).cast("bigint"), lambda a, n: a + n)


def filtered_pct(runs: DataFrame) -> Column:
    """Rows removed as a percentage of all input rows; 0 without input."""
    share = F.try_divide(
        runs["rows_filtered"].cast("double"), total_input(runs["input_rows"]).cast("double")
    )
    return F.coalesce(share * 100.0, F.lit(0.0))


def run_alerts(
    runs: DataFrame,
    slow_seconds: float = SLOW_SECONDS,
    max_filtered_pct: float = MAX_FILTERED_PCT,
) -> DataFrame:
    """``run_id, alert, detail``: one row for every limit a run has broken, over all history."""
    has_rows = (F.size("input_rows") > 0) & (F.col("output_rows") > 0)
    pct = filtered_pct(runs)
    seconds = F.col("total_duration_seconds")

    def alert(when: Column, name: str, detail: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("alert"), detail.alias("detail")))

    checks = F.array(
        alert(
            seconds > slow_seconds,
            "SLOW",
            F.format_string(
                f"took %d s, limit {slow_seconds:.0f} s", F.round(seconds).cast("bigint")
            ),
        ),
        alert(
            has_rows & (pct > max_filtered_pct),
            "HIGH FILTER RATE",
            F.format_string("%.1f%% rows filtered", F.round(pct, 1)),
        ),
        alert(
            ~F.col("data_quality_passed"),  # NULL, if never checked, raises nothing
            "DATA QUALITY",
            F.format_string("%d errors", F.col("data_quality_errors")),
        ),
        alert(
            F.col("status") == "FAILED", "PIPELINE FAILED", F.array_join("errors", "; ")
        ),
    )
    return runs.select("run_id", F.inline(F.filter(checks, lambda a: a.isNotNull())))


def _shares(runs: DataFrame, kind: str, parts: str, whole: str) -> DataFrame:
    pct = F.try_divide(F.col("part").cast("double"), F.col(whole).cast("double")) * 100.0
    return runs.select(
        "run_id", whole, F.explode(parts).alias("name", "part")
    ).select(
        "run_id",
        F.lit(kind).alias("kind"),
        "name",
        F.col("part").cast("double").alias("amount"),
        F.round(F.coalesce(pct, F.lit(0.0)), 4).alias("pct"),
    )


def run_shares(runs: DataFrame) -> DataFrame:
    """Each stage's share of the run time and each segment's share of the output, per run."""
    return _shares(runs, "stage", "stage_durations", "total_duration_seconds").unionByName(
        _shares(runs, "segment", "segments", "output_rows")
    )


def run_deviations(
    runs: DataFrame,
    span: int = DEVIATION_SPAN,
    max_ratio: float = MAX_RATIO,
    max_excess_pct: float = MAX_EXCESS_PCT,
) -> DataFrame:
    """Every run against the median of the last ``span`` runs before it that did not fail.

    ``usual_seconds`` and ``usual_filtered_pct`` are those medians, NULL without such a run;
    ``deviates`` if the run took more than ``max_ratio`` times as long, or filtered more than
    ``max_excess_pct`` points more. Runs are ordered by timestamp, then id: one row per run, a table
    that grows by runs and not by data.
    """
    before = Window.orderBy("timestamp", "run_id").rowsBetween(-span, -1)
    measured = runs.select(
        "run_id",
        "timestamp",
        F.col("status") != "FAILED",
        F.col("total_duration_seconds").alias("seconds"),
        filtered_pct(runs).alias("pct"),
    ).toDF("run_id", "timestamp", "fine", "seconds", "pct")

    def usual(measure: str) -> Column:
        return F.percentile(F.when(F.col("fine"), F.col(measure)), 0.5).over(before)

    ratio = F.try_divide(F.col("seconds"), F.col("usual_seconds"))
    excess = F.col("pct") - F.col("usual_pct")
    return (
        measured.select("*", usual("seconds").alias("usual_seconds"), usual("pct").alias("usual_pct"))
        .select(
            "run_id",
            F.round("seconds", 4).alias("seconds"),
            F.round("usual_seconds", 4).alias("usual_seconds"),
            F.round("pct", 4).alias("filtered_pct"),
            F.round("usual_pct", 4).alias("usual_filtered_pct"),
            F.coalesce((ratio > max_ratio) | (excess > max_excess_pct), F.lit(False)).alias("deviates"),
        )
    )


def append_runs(runs: DataFrame, path: str) -> None:
    """Add runs to the JSON history at ``path``; each append is new files, none is rewritten."""
    runs.select(*RUN_SCHEMA.names).write.mode("append").json(path)


def read_runs(spark, path: str) -> DataFrame:
    """The run history written by :func:`append_runs`."""
    return spark.read.schema(RUN_SCHEMA).json(path)
