"""Monitoring analytics over predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uelumen.functions import times
from uelumen.functions.text import first_of
from uelumen.operators import scans

BUFFER_ROWS = 3000
MAX_POINTS = 80
SHIFT_MS = 7 * 3600 * 1000
# Bucket sizes of a chart in seconds.
BUCKETS = (1, 2, 5, 10, 15, 30, 60, 120, 300, 600)


def latest(predictions: DataFrame, *, key: str = "prediction_id", arrival: str = "arrival", fallback: Column | None = None, keep: int = BUFFER_ROWS) -> DataFrame:
    """The buffer: the last arrival of each id (a missing id falls back), of these the newest ``keep``."""
    ident = F.col(key) if fallback is None else F.coalesce(F.when(F.col(key) != "", F.col(key)), fallback)
    whole = F.struct(*predictions.columns)
    last = predictions.groupBy(ident.alias("ul_id")).agg(F.max_by(whole, F.col(arrival)).alias("r")).select("r.*")
    return last.orderBy(F.col(arrival).desc()).limit(keep)


def display_flag(predictions: DataFrame, threshold: float) -> DataFrame:
    """``display_anomaly`` by a display threshold; ``is_anomaly`` stays."""
    return predictions.withColumn("display_anomaly", F.col("anomaly_score") >= threshold)


def kpis(predictions: DataFrame, *, flag: str = "is_anomaly", score: str = "anomaly_score", ue: str = "ue_key") -> DataFrame:
    """n, subscribers, anomalous subscribers, anomalies, rate (0 if empty), mean score (what is no number is left out)."""
    hit = F.coalesce(F.col(flag), F.lit(False))
    value = F.col(score).try_cast("double")
    return predictions.agg(
        F.count("*").alias("n"), F.count_distinct(ue).alias("n_ue"), F.count_distinct(F.when(hit, F.col(ue))).alias("n_anomalous_ue"), F.count_if(hit).alias("n_anomalies"),
        F.coalesce(F.count_if(hit) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)).alias("anomaly_rate"), F.avg(F.nanvl(value, F.lit(None))).alias("mean_score"),
    )


def per_model(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(F.count("*").alias("n"), F.count_if("is_anomaly").alias("n_anomalies"))


def longest_runs(rows: DataFrame, *, ue: str = "ue_key", flag: str = "is_anomaly", order: tuple[str, ...] = ("window_end_event_time",), block: Column | None = None) -> DataFrame:
    """(ue, longest_run): the most consecutive flagged rows of each subscriber, 0 if none.

    Each block of a subscriber (an hour where it isn't given) is summarised by itself, and summaries merge: no task sorts a subscriber.
    """
    block = scans.default_block(rows, order[0], scans.HOUR_MS) if block is None else block
    runs = scans.merge_blocks(scans.block_runs(rows, ue, list(order), F.coalesce(F.col(flag), F.lit(False)), block), ue)
    return runs.select(ue, F.col("runs.best").alias("longest_run"))


def severity(run: Column) -> Column:
    return F.when(run >= 3, "high").when(run >= 2, "repeated").otherwise("watch")


def report_order(ue: str = "ue_key") -> list[Column]:
    """Longest run, top score and most alerts first."""
    return [F.col("longest_run").desc(), F.col("max_score").desc(), F.col("anomaly_count").desc(), F.col(ue)]


def alert_summary(predictions: DataFrame, *, ue: str = "ue_key", flag: str = "is_anomaly", score: str = "anomaly_score", order: tuple[str, ...] = ("window_end_event_time", "arrival"), arrival: str = "arrival") -> DataFrame:
    """A row per subscriber with an alert: counts, top score and its window, latest window and its score, run, severity.

    Top and latest are those of the alerts alone, whatever other windows scored or came later; of equals the first arrival counts. The run is over all rows.
    """
    hit = F.coalesce(F.col(flag), F.lit(False))
    first = (-F.col(arrival)).alias("a")
    alert = lambda c: F.when(hit, c)
    best = alert(F.struct(F.col(score).alias("by"), first))
    last = alert(F.struct(*[c for c in order if c != arrival], first))
    grouped = predictions.groupBy(ue).agg(
        F.count_if(hit).alias("anomaly_count"), F.count("*").alias("total_count"), F.max(alert(F.col(score))).alias("max_score"), F.max_by("window_end_event_time", best).alias("max_score_window_end"),
        F.max_by("window_end_event_time", last).alias("latest_window_end"), F.max_by(score, last).alias("latest_score"),
    ).filter("anomaly_count > 0")
    out = grouped.join(longest_runs(predictions, ue=ue, flag=flag, order=order), ue)
    return out.withColumn("severity", severity(F.col("longest_run"))).orderBy(*report_order(ue))


def pyramid(rows: DataFrame, *, ts_ms: str, score: str, arrival: str = "arrival", shift_ms: int = SHIFT_MS) -> DataFrame:
    """(size, bucket, n, from_ms, to_ms, row): for every usual bucket size the highest-score row (first of equals) of each bucket on the local clock.

    Rows are reduced to seconds first; only these make the wider buckets. Pyramids of parts of the rows merge: see :func:`merge_pyramids`.
    """
    best = F.max_by("row", F.struct(F.col("row")[score], (-F.col("row")[arrival]).alias("a"))).alias("row")
    told = [F.sum("n").alias("n"), F.min("from_ms").alias("from_ms"), F.max("to_ms").alias("to_ms"), best]
    own = rows.select(F.floor((F.col(ts_ms) + shift_ms) / 1000).alias("second"), F.lit(1).cast("long").alias("n"), F.col(ts_ms).alias("from_ms"), F.col(ts_ms).alias("to_ms"), F.struct(*rows.columns).alias("row"))
    seconds = own.groupBy("second").agg(*told).withColumn("size", F.explode(F.array(*map(F.lit, BUCKETS))))
    return seconds.groupBy("size", F.floor(F.col("second") / F.col("size")).alias("bucket")).agg(*told)


def merge_pyramids(one: DataFrame, other: DataFrame, *, score: str, arrival: str = "arrival") -> DataFrame:
    best = F.max_by("row", F.struct(F.col("row")[score], (-F.col("row")[arrival]).alias("a"))).alias("row")
    return one.union(other).groupBy("size", "bucket").agg(F.sum("n").alias("n"), F.min("from_ms").alias("from_ms"), F.max("to_ms").alias("to_ms"), best)


def bucket_seconds(span: Column, points: int = MAX_POINTS) -> Column:
    """The first usual bucket of at least span / points seconds, else the next multiple of the largest."""
    need = span / points
    return F.coalesce(*[F.when(need <= b, F.lit(b)) for b in BUCKETS], (F.ceil(need / BUCKETS[-1]) * BUCKETS[-1])).cast("long")


def zoom(levels: DataFrame, *, score: str, arrival: str = "arrival", points: int = MAX_POINTS, from_ms: int | None = None, to_ms: int | None = None) -> DataFrame:
    """The chart's rows out of a pyramid, for the whole time or for the seconds of a part of it: the level that its span asks for."""
    held = levels if from_ms is None else levels.filter((F.col("to_ms") >= from_ms) & (F.col("from_ms") <= to_ms))
    span = held.filter("size = 1").agg((F.max("to_ms") - F.min("from_ms")).alias("ms")).scalar()
    size = bucket_seconds(span / 1000, points)
    chosen = held.withColumn("ul_size", size).filter(F.col("size") == F.least(F.col("ul_size"), F.lit(BUCKETS[-1])))
    wide = chosen.groupBy(F.floor(F.col("bucket") * F.col("size") / F.col("ul_size")).alias("bucket"))
    return wide.agg(F.max_by("row", F.struct(F.col("row")[score], (-F.col("row")[arrival]).alias("a"))).alias("r")).select("r.*")


def downsample(rows: DataFrame, *, ts_ms: str, score: str, arrival: str = "arrival", points: int = MAX_POINTS, shift_ms: int = SHIFT_MS) -> DataFrame:
    """The highest-score row (first of equals) of each time bucket on the local clock; all rows if there are few."""
    few = rows.agg((F.count("*") <= points).alias("few")).scalar()
    levels = pyramid(rows, ts_ms=ts_ms, score=score, arrival=arrival, shift_ms=shift_ms)
    return rows.filter(few).union(zoom(levels, score=score, arrival=arrival, points=points).filter(~few))


def placed(rows: DataFrame, order: list[Column], block: Column, name: str = "place") -> DataFrame:
    """``rows`` with their place in an order of all, from 0. ``block`` is the number of a stretch of that order; each stretch is a task's."""
    return scans.numbered(rows, [], order, block, name)


def padded_domain(rows: DataFrame, ts_ms: str) -> DataFrame:
    """(from_ms, to_ms): the time range with 10 s at either end for one point, else 3 % but at least 5 s."""
    low, high = F.min(ts_ms), F.max(ts_ms)
    pad = F.when(low == high, 10_000.0).otherwise(F.greatest(F.lit(5_000.0), (high - low) * 0.03))
    return rows.agg((low - pad).alias("from_ms"), (high + pad).alias("to_ms"))


def evidence_table(predictions: DataFrame, zone: str = "Asia/Ho_Chi_Minh") -> DataFrame:
    """A row per top event with display columns: its own field, else its display field, else ``-``."""
    rows = predictions.select("prediction_id", F.posexplode("top_evidence_events").alias("rank", "e"))
    event = F.col("e.event")
    shown = lambda n: F.try_element_at(event["display_fields"], F.lit(n))
    return rows.select(
        "prediction_id", "rank", F.col("e.timestep").alias("timestep"), F.col("e.raw_contribution").alias("contribution"), first_of(times.clock(shown("event_time"), zone)).alias("event_time"), first_of(shown("event_name"), event["event_id"]).alias("event"),
        first_of(shown("event_result_label"), event["event_result"]).alias("result"), first_of(event["duration_ms"]).alias("duration"), first_of(event["sub_cause_code"]).alias("sub_cause"), first_of(shown("tac")).alias("tac"), first_of(shown("eci")).alias("eci"),
    )


def history(predictions: DataFrame, ue_key: str | None = None) -> DataFrame:
    """Predictions (of a subscriber) by window end, the oldest first; those of one time by model."""
    rows = predictions if ue_key is None else predictions.filter(F.col("ue_key") == ue_key)
    return rows.orderBy(F.col("window_end_event_time").asc_nulls_last(), "model")


def chart_points(rows: DataFrame, *, ts_ms: str, score: str, **options) -> DataFrame:
    """Points of the chart in order of time: one for each bucket, with what a label shows."""
    return downsample(rows, ts_ms=ts_ms, score=score, **options).withColumn("label", score_label(F.col(score))).orderBy(ts_ms)


def score_label(score: Column) -> Column:
    """Three decimals."""
    return F.format_string("%.3f", F.round(score.cast("double"), 3))


def rate_label(rate: Column) -> Column:
    """Percent with two decimals."""
    return F.format_string("%.2f%%", F.round(rate.cast("double") * 100, 2))
