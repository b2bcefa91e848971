"""Counts, summaries and comparisons over flagged and labelled events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fingertrail.functions.flags import contains_text
from fingertrail.operators.flags import sequence_flag_sets
from fingertrail.operators.groups import (Position, Quantile, RunningMaxBefore, RunningSum, Touches,
                                          hot_quantiles, split_sessions)
from fingertrail.operators.metrics import TOUCH
from fingertrail.operators.segment import SEQUENCE
from fingertrail.schema import ALL_FLAGS, TRACING_ROW_FLAGS
from fingertrail.sources.sinks import PART_EVENTS, touch_parts

# Flags counted by the completeness report.
COMPLETENESS_REPORT = ["missing_Began", "missing_Ended", "missing_B", "missing_E", "sequence_interrupted",
                       "improper_sequence_order", "multiple_end_events", "orphaned_events"]


def _flagged() -> Column:
    return F.coalesce(F.col("flags"), F.lit("")) != ""


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, digits), F.lit(0.0))


def percent_text(part: Column, whole: Column) -> Column:
    """Two decimals and a percent sign."""
    return F.format_string("%.2f%%", percent(part, whole).cast("double"))


def count_flagged_rows(df: DataFrame) -> DataFrame:
    """Per session: flagged rows, rows and their percentage."""
    table = df.groupBy("session_id").agg(F.count_if(_flagged()).alias("flagged_rows"),
                                         F.count(F.lit(1)).alias("total_rows"))
    return table.withColumn("flagged_percentage", percent(F.col("flagged_rows"), F.col("total_rows")))


def flag_row_counts(df: DataFrame) -> DataFrame:
    """Per session and flag that occurs in it: rows whose text contains the name.

    The test is a plain substring test, so ``missing_E`` also counts rows with ``missing_Ended`` once
    ``missing_E`` itself occurs. The flag names form a fixed list, hence one conditional count each.
    """
    names = F.split("flags", ",")
    table = df.groupBy("session_id").agg(
        *[F.count_if(contains_text(F.col("flags"), f)).alias(f"n_{f}") for f in ALL_FLAGS],
        *[F.max(F.coalesce(F.array_contains(names, f), F.lit(False))).alias(f"has_{f}") for f in ALL_FLAGS])
    pairs = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f"n_{f}").alias("rows"),
                               F.col(f"has_{f}").alias("_has")) for f in ALL_FLAGS])
    return (table.select("session_id", F.explode(pairs).alias("_p")).select("session_id", "_p.*")
            .filter("_has").drop("_has"))


def corpus_summary(df: DataFrame, data_type: Column) -> DataFrame:
    """One line per session: type, flagged rows, percentage text and one column per flag.

    A flag that does not occur in the session stays null, as in a table joined from per-file lines.
    """
    names = F.split("flags", ",")

    def rows_with(flag):
        own = F.max(F.coalesce(F.array_contains(names, flag), F.lit(False)))
        return F.when(own, F.count_if(contains_text(F.col("flags"), flag))).alias(f"flag_{flag}")

    table = df.groupBy("session_id").agg(
        F.first(data_type).alias("data_type"), F.count_if(_flagged()).alias("flagged_rows"),
        F.count(F.lit(1)).alias("total_rows"), *[rows_with(f) for f in ALL_FLAGS])
    share = percent(F.col("flagged_rows"), F.col("total_rows"))
    return table.select(
        F.col("session_id").alias("filename"), "data_type", "flagged_rows", "total_rows",
        F.concat(share.cast("string"), F.lit("%")).alias("flagged_percentage"),
        *[f"flag_{f}" for f in ALL_FLAGS])


def high_flag_sessions(df: DataFrame, limit: float = 10.0) -> DataFrame:
    """Sessions with their alert level: more than ``limit`` percent of rows flagged, or not."""
    table = count_flagged_rows(df)
    return table.withColumn("alert", F.when(F.col("flagged_percentage") > limit, "high").otherwise("normal"))


def completeness(df: DataFrame) -> DataFrame:
    """Completeness of Coloring sessions.

    Sequences are touches where the data has touch ids, else (finger, seqId > 0). The number of
    incomplete sequences is the largest of the per-flag counts, not their union.
    """
    by_touch = "Touchdata_id" in df.columns
    keys = TOUCH if by_touch else SEQUENCE
    belongs = F.col("Touchdata_id").isNotNull() if by_touch else F.col("seqId") > 0
    per_sequence = df.groupBy(*keys, belongs.alias("_in")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(contains_text(F.col("flags"), f)).alias(f"_n_{f}") for f in COMPLETENESS_REPORT])
    table = per_sequence.groupBy("session_id").agg(
        F.sum("_rows").alias("total_rows"), F.count_if(F.col("_in")).alias("total_sequences"),
        F.coalesce(F.sum(F.when(~F.col("_in"), F.col("_rows"))), F.lit(0)).alias("rows_with_no_sequence"),
        *[F.sum(f"_n_{f}").alias(f) for f in COMPLETENESS_REPORT],
        *[F.count_if(F.col("_in") & (F.col(f"_n_{f}") > 0)).alias(f"sequences_with_{f}")
          for f in COMPLETENESS_REPORT])
    worst = F.greatest(*[F.col(f"sequences_with_{f}") for f in COMPLETENESS_REPORT])
    total = F.col("total_sequences")
    return table.select(
        "session_id", "total_rows", "total_sequences", "rows_with_no_sequence",
        (total - worst).alias("complete_sequences"), worst.alias("incomplete_sequences"),
        percent_text(total - worst, total).alias("percent_complete_sequences"),
        *COMPLETENESS_REPORT, *[f"sequences_with_{f}" for f in COMPLETENESS_REPORT],
        *[percent_text(F.col(f"sequences_with_{f}"), total).alias(f"percent_sequences_with_{f}")
          for f in COMPLETENESS_REPORT])


def tracing_completeness(df: DataFrame) -> DataFrame:
    """Row counts of the Tracing flags per session."""
    table = df.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(_flagged()).alias("flagged_rows"),
        *[F.count_if(contains_text(F.col("flags"), f)).alias(f) for f in TRACING_ROW_FLAGS])
    return table.withColumn("flagged_percentage", percent_text(F.col("flagged_rows"), F.col("total_rows")))


def processing_statistics(enhanced: DataFrame, columns_before: int, by: list[str]) -> DataFrame:
    """Per session: points, touches, added columns and value counts of label columns as maps.

    Rows are first reduced to one per (touch, label values); maps are bounded by the vocabularies.
    """
    cells = enhanced.groupBy(*TOUCH, *by).agg(F.count(F.lit(1)).alias("_n"))
    totals = (cells.groupBy(*TOUCH).agg(F.sum("_n").alias("_n")).groupBy("session_id")
              .agg(F.sum("_n").alias("points"), F.count("Touchdata_id").alias("sequences")))
    result = totals.withColumn("features_added", F.lit(len(enhanced.columns) - columns_before))
    for name in by:
        counts = (cells.filter(F.col(name).isNotNull()).groupBy("session_id", name)
                  .agg(F.sum("_n").alias("_n")))
        maps = counts.groupBy("session_id").agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "_n")))).alias(f"{name}_counts"))
        result = result.join(maps, "session_id", "left")
    return result


def label_distribution(df: DataFrame, labels: list[str]) -> DataFrame:
    """Sequences per value of each label, by the label of the first event of a sequence."""
    first = df.groupBy(*TOUCH).agg(*[F.min_by(label, "event_index").alias(label) for label in labels])
    cells = first.groupBy(*labels).agg(F.count(F.lit(1)).alias("_n"))
    values = F.array(*[F.struct(F.lit(label).alias("label"), F.col(label).cast("string").alias("value"))
                       for label in labels])
    return (cells.select(F.explode(values).alias("_v"), "_n").select("_v.*", "_n")
            .groupBy("label", "value").agg(F.sum("_n").alias("sequences")))


def cleaning_summary(df: DataFrame, marks: tuple[str, ...] = ("outlier", "imputed", "duplicate", "invalid_phase")) -> DataFrame:
    """Per session: rows with any cleaning mark."""
    marked = F.lit(False)
    for name in marks:
        marked = marked | F.coalesce(F.col(name), F.lit(False))
    table = df.groupBy("session_id").agg(F.count_if(marked).alias("flagged_rows"),
                                         F.count(F.lit(1)).alias("total_rows"))
    return table.withColumn("flagged_percentage", percent(F.col("flagged_rows"), F.col("total_rows")))


def sequence_sizes(touches: Touches) -> DataFrame:
    """Per sequence: points, duration, distinct flags, and whether it has any.

    A sequence is a touch; where events have no touch ids, it is a finger's sequence, and events outside of
    sequences (seqId 0) or without a finger are left out.
    """
    if "Touchdata_id" in touches.columns:
        keys, rows = TOUCH, touches.filter(F.col("Touchdata_id").isNotNull())
    else:
        keys, rows = SEQUENCE, touches.filter((F.col("seqId") > 0) & F.col("fingerId").isNotNull())
    sizes = rows.aggregate(keys, points=F.count(F.lit(1)), duration=F.max("time") - F.min("time"))
    return sizes.join(sequence_flag_sets(rows, keys), keys)


def compare_flagged(touches: Touches) -> DataFrame:
    """Flagged against other sequences: number, share, mean and median size and duration."""
    sizes = sequence_sizes(touches)
    groups = sizes.groupBy("has_flags").agg(
        F.count(F.lit(1)).alias("sequences"), F.avg("points").alias("mean_points"),
        F.avg("duration").alias("mean_duration"))
    medians = grouped_medians(sizes, "has_flags", ["points", "duration"], touches.hot_rows, touches.at_most)
    total = groups.agg(F.sum("sequences").alias("_all"))
    return (groups.join(medians, "has_flags").join(F.broadcast(total))  # one row
            .select("has_flags", "sequences", percent(F.col("sequences"), F.col("_all")).alias("share"),
                    "mean_points", "median_points", "mean_duration", "median_duration"))


def grouped_medians(df: DataFrame, group: str, values: list[str], hot_rows: int,
                    at_most: int | None = None) -> DataFrame:
    """Exact medians of a few groups of any size.

    Up to ``hot_rows`` rows in all, a percentile aggregate does it. Beyond, its buffer would gather a
    group's distinct values in one task, so counted values are ranked along range chunks instead.
    """
    if (df.count() if at_most is None else at_most) <= hot_rows:
        return df.groupBy(group).agg(*[F.percentile(v, 0.5).alias(f"median_{v}") for v in values])
    wanted = {f"median_{v}": Quantile(F.col(v), 0.5) for v in values}
    return hot_quantiles(df, [group], wanted, hot_rows)


def flag_sequence_counts(sizes: DataFrame) -> DataFrame:
    """Sequences per flag."""
    return (sizes.select(F.explode("flag_set").alias("flag")).groupBy("flag")
            .agg(F.count(F.lit(1)).alias("sequences")))


def pack_sequences(touches: Touches, part_events: int = PART_EVENTS) -> DataFrame:
    """Per touch: ordered points, distinct flags and whether it has any, for plotting.

    A touch of more than ``part_events`` points continues in further parts.
    """
    points = touch_parts(touches.rows(), ["x", "y", "time", "touchPhase"], part_events)
    return points.withColumnRenamed("events", "points").join(sequence_flag_sets(touches), TOUCH)


def packing_totals(sizes: DataFrame) -> DataFrame:
    """Corpus totals of the packed sequences."""
    table = sizes.agg(F.count(F.lit(1)).alias("total_sequences"),
                      F.count_if("has_flags").alias("flagged_sequences"))
    return table.select("total_sequences", "flagged_sequences",
                        (F.col("total_sequences") - F.col("flagged_sequences")).alias("normal_sequences"),
                        percent(F.col("flagged_sequences"), F.col("total_sequences"), 1).alias("flagged_percentage"))


def normalised_time(touches: Touches, keys: list[str] | None = None) -> Touches:
    """Time of every event on a 0..1 scale of its session; only touches of more than one event."""
    rows = touches.totals(["session_id"], _min=F.min("time"), _max=F.max("time"))
    rows = rows.totals(keys or TOUCH, _n=F.count(F.lit(1))).filter(F.col("_n") > 1)
    span = F.col("_max") - F.col("_min")
    return rows.with_columns(norm_time=F.try_divide(F.col("time") - F.col("_min"), span)).drop("_min", "_max", "_n")


def time_ticks(df: DataFrame) -> DataFrame:
    """Quartile marks of the time scale of each session, as text."""
    spans = df.groupBy("session_id").agg(F.min("time").alias("_min"), F.max("time").alias("_max"))
    span = F.col("_max") - F.col("_min")
    return spans.select("session_id", *[
        F.format_string("%.1fs", F.col("_min") + span * q).alias(f"tick_{int(q * 100)}")
        for q in (0.0, 0.25, 0.5, 0.75, 1.0)])


def sequence_listing(df: DataFrame) -> DataFrame:
    """Distinct touches, or distinct (finger, seqId) where there are no touch ids."""
    if "Touchdata_id" in df.columns:
        return df.select(*TOUCH).filter(F.col("Touchdata_id").isNotNull()).distinct()
    return df.select(*SEQUENCE).distinct()


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """Equal-width histogram over the values between ``low`` and ``high`` (default: their range).

    The last bin includes its upper edge. Empty bins are not listed.
    """
    values = df.select(F.col(column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if low is not None:
        values = values.filter(F.col("_v").between(low, high))
    bounds = values.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    binned = values.join(F.broadcast(bounds))  # one row
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide(F.col("_v") - F.col("_lo"), width), F.lit(0.0))))
    return binned.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def merge_ranges(ranges: DataFrame, hot_rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Merge overlapping or adjacent integer ranges (session_id, start, end) of each session.

    A range opens an island when it starts after every earlier end plus one. Candidate islands are
    counted along the order; the running maximum end is a carry like any other.
    """
    placed = split_sessions(ranges, hot_rows, at_most).arrange(["session_id"], ["start", "end"])
    placed = placed.running(_reach=RunningMaxBefore(F.col("end")))
    opens = F.coalesce(F.col("start") > F.col("_reach") + 1, F.lit(True))
    placed = placed.with_columns(_opens=opens.cast("long")).running(_island=RunningSum(F.col("_opens")))
    merged = placed.rows().groupBy("session_id", "_island").agg(F.min("start").alias("start"),
                                                                F.max("end").alias("end"))
    return merged.select("session_id", "start", "end")


def flagged_row_ranges(touches: Touches, order: list[str]) -> DataFrame:
    """Stretches of flagged rows of each session, as row numbers in the given order."""
    rows = touches.arrange(["session_id"], order).running(_row=Position()).filter(_flagged()).rows()
    return merge_ranges(rows.select("session_id", F.col("_row").alias("start"), F.col("_row").alias("end")),
                        touches.hot_rows, touches.at_most)
