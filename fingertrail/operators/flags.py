"""Rule flags of sequences, broadcast to their rows, and consistency reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.flags import contradictions, join_flags, parse_flags, resolve_conflicts
from fingertrail.functions.phases import (PATTERN_PARTS, any_phase, flag_if, flag_list, is_phase,
                                          pattern_parts, strict_pattern)
from fingertrail.operators.groups import Previous, Touches
from fingertrail.operators.metrics import TOUCH
from fingertrail.operators.segment import FINGER, SEQUENCE
from fingertrail.schema import TRACING_PHASES, TRACING_ROW_FLAGS, time_order

MAX_GAP = 100.0  # compared with raw ``time``, whatever its unit


def _false(name: str):
    return F.coalesce(F.col(name), F.lit(False))


def apply_flag_rules(touches: Touches, max_gap: float = MAX_GAP) -> Touches:
    """Add ``flags`` to every row of segmented data (Coloring rules, Tracing rules, or both).

    A sequence belongs to the touch of its first row in time. If that touch follows the strict
    pattern, the Coloring rules are skipped; completeness flags apply in any case.
    """
    columns = touches.columns
    order = time_order(columns)
    by_touch = "Touchdata_id" in columns and "event_index" in columns

    def present(name):
        return F.max(F.col(name).isNotNull()) if name in columns else F.max(F.lit(False))

    rows = touches.arrange(FINGER, order).totals(
        ["session_id"], _began=any_phase("Began"), _b=any_phase("B"), _distance=present("distance"),
        _frame=present("camFrame"), _color=present("color"), _completion=present("completionPerc"),
        _any_ended=any_phase("Ended"), _any_s=any_phase("S"))
    tracing = (F.col("_distance") & F.col("_frame")) | F.col("_b")
    coloring = (F.col("_color") & F.col("_completion")) | F.col("_began")
    rows = rows.with_columns(_tracing=tracing | ~coloring, _coloring=coloring | ~tracing)

    if by_touch:
        rows = (rows.totals(TOUCH, **pattern_parts(F.col("event_index")))
                .with_columns(_valid=strict_pattern() & F.col("Touchdata_id").isNotNull())
                .drop(*PATTERN_PARTS))
    else:
        rows = (rows.totals(SEQUENCE, **pattern_parts(F.struct(*order)))
                .with_columns(_valid=strict_pattern()).drop(*PATTERN_PARTS))

    rows = rows.running(within=SEQUENCE, _before=Previous(F.col("time")))
    in_time = F.struct(*order)
    in_touch = F.struct("event_index", *order) if by_touch else in_time
    total_distance = F.sum("distance") if "distance" in columns else F.sum(F.lit(None).cast("double"))
    rows = rows.totals(
        SEQUENCE,
        _touch_valid=F.min_by("_valid", in_time),
        _first_index=F.min_by("touchPhase", in_touch),
        _first_time=F.min_by("touchPhase", in_time),
        _ended=F.max(F.when(is_phase("Ended"), F.col("time"))),
        _s=F.max(F.when(is_phase("S"), F.col("time"))),
        _start=F.min("time"), _n=F.count(F.lit(1)), _canceled=any_phase("Canceled"),
        _gap=F.max(F.coalesce(F.col("time") - F.col("_before") > max_gap, F.lit(False))),
        _has_e=any_phase("E"), _invalid=F.max(~is_phase(*TRACING_PHASES)),
        _moved=total_distance,
        _interrupted=F.max("sequence_interrupted"), _orphaned=F.max("orphaned_events"),
        _ends=F.max("multiple_end_events"), _improper=F.max("improper_sequence_order"))

    only_ended = F.col("_any_ended") & ~F.col("_any_s")
    end = F.when(only_ended, F.col("_ended")).otherwise(F.coalesce("_ended", "_s"))
    broken = F.col("_coloring") & ~F.col("_touch_valid")
    several = F.col("_n") > 1
    flags = flag_list([
        flag_if(broken & F.coalesce(F.col("_first_index") != "Began", F.lit(True)), "missing_Began"),
        flag_if(broken & F.col("_ended").isNull(), "missing_Ended"),
        flag_if(broken & F.col("_gap"), "sequence_gap"),
        flag_if(broken & (end - F.col("_start") < 0.01), "short_duration"),
        flag_if(broken & (F.col("_n") < 3), "too_few_points"),
        flag_if(broken & F.col("_canceled"), "has_canceled"),
        flag_if(F.col("_tracing") & F.coalesce(F.col("_first_time") != "B", F.lit(True)), "missing_B"),
        flag_if(F.col("_tracing") & ~F.col("_has_e"), "missing_E"),
        flag_if(F.col("_tracing") & F.col("_invalid"), "invalid_TouchPhase"),
        # a column without values sums to zero where the session records distances at all
        flag_if(F.col("_tracing") & F.col("_distance") & several
                & (F.coalesce(F.col("_moved"), F.lit(0.0)) == 0), "zero_distance"),
        flag_if(F.col("_tracing") & F.col("_gap"), "time_gap"),
        flag_if(F.col("_interrupted"), "sequence_interrupted"),
        flag_if(F.col("_orphaned"), "orphaned_events"),
        flag_if(F.col("_ends"), "multiple_end_events"),
        flag_if(F.col("_improper"), "improper_sequence_order"),
    ])
    outside = (F.when(F.col("orphaned_events"), "orphaned_events")
               .when(F.col("_coloring"), "missing_Began").otherwise("missing_B"))
    helpers = ["_began", "_b", "_distance", "_frame", "_color", "_completion", "_any_ended", "_any_s",
               "_tracing", "_coloring", "_valid", "_before", "_touch_valid", "_first_index",
               "_first_time", "_ended", "_s", "_start", "_n", "_canceled", "_gap", "_has_e", "_invalid",
               "_moved", "_interrupted", "_orphaned", "_ends", "_improper", "_flags"]
    return (rows.with_columns(_flags=flags)
            .with_columns(flags=F.when(F.col("seqId") > 0, join_flags(resolve_conflicts(F.col("_flags"))))
                          .otherwise(outside))
            .drop(*helpers))


def sequence_flag_table(touches: Touches) -> DataFrame:
    """Flags per sequence of flagged rows; group 0 carries none, as in the metrics table."""
    table = touches.filter(F.col("seqId") > 0).aggregate(SEQUENCE, flags=F.max("flags"))
    return table


def attach_metric_flags(metrics: DataFrame, flags: DataFrame) -> DataFrame:
    """Metrics with the flags of their sequence."""
    return (metrics.join(flags, SEQUENCE, "left")
            .withColumn("flags", F.coalesce("flags", F.lit(""))))


def apply_tracing_flag_rules(touches: Touches) -> Touches:
    """Row flags of Tracing data: each row names its own issues."""
    names = [flag_if(F.col(name), name) for name in TRACING_ROW_FLAGS]
    return touches.with_columns(flags=F.concat_ws(",", *names))


def tracing_sequence_flags(metrics: DataFrame) -> DataFrame:
    """Sequence flags of Tracing metrics; group 0 has none."""
    sources = ["hasOrphanedFinger", "isUnterminated", "hasOverlappingFingers", "hasPhantomMove"]
    names = [flag_if((F.col("seqId") > 0) & F.col(source), name)
             for source, name in zip(sources, TRACING_ROW_FLAGS)]
    return metrics.withColumn("flags", F.concat_ws(",", *names))


def validate_flag_consistency(touches: Touches) -> DataFrame:
    """Sequences whose first row carries contradicting flags."""
    order = F.struct(*time_order(touches.columns))
    first = touches.filter(F.col("seqId") > 0).aggregate(
        SEQUENCE, flags=F.min_by("flags", order), nPoints=F.count(F.lit(1)))
    found = contradictions(F.split("flags", ","))
    return (first.withColumn("_found", found).filter(F.size("_found") > 0)
            .select(*SEQUENCE, "flags", F.array_join("_found", ", ").alias("contradictions"), "nPoints"))


def flag_consistency_summary(touches: Touches) -> DataFrame:
    """Per session: number of sequences (distinct seqId without 0) and of contradictions."""
    # two-step distinct: (session, seqId) first, so a large session is combined before it meets
    numbers = (touches.rows().select("session_id", "seqId").distinct()
               .groupBy("session_id").agg((F.count("seqId") - 1).alias("total_sequences")))
    found = (validate_flag_consistency(touches).groupBy("session_id")
             .agg(F.count(F.lit(1)).alias("contradictions_found")))
    return (numbers.join(found, "session_id", "left")
            .withColumn("contradictions_found", F.coalesce("contradictions_found", F.lit(0))))


def flag_consistency_totals(summary: DataFrame) -> DataFrame:
    """The corpus line: files, files with contradictions, contradictions."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("contradictions_found") > 0).alias("files_with_contradictions"),
        F.coalesce(F.sum("contradictions_found"), F.lit(0)).alias("total_contradictions"))


def row_flag_list(touches: Touches) -> Touches:
    """Parsed flags of every row."""
    return touches.with_columns(flag_list=parse_flags(F.col("flags")))


def sequence_flag_sets(touches: Touches, keys: list[str] | None = None) -> DataFrame:
    """Distinct flags per sequence and whether there are any.

    Flags are exploded and made distinct before they are collected, so the collected list is bounded
    by the flag vocabulary whatever the size of the sequence.
    """
    keys = keys or TOUCH
    sequences = touches.rows().filter(F.col(keys[-1]).isNotNull())
    names = (sequences.select(*keys, F.explode_outer(parse_flags(F.col("flags"))).alias("flag"))
             .distinct())
    return (names.groupBy(*keys)
            .agg(F.array_sort(F.collect_list("flag")).alias("flag_set"))
            .withColumn("has_flags", F.size("flag_set") > 0))
