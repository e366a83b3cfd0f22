"""Model scoring of gold samples: a pluggable model interface, and prediction records.

A model is any picklable object with ``model_name``, ``model_display_name``, ``selected_seed``, ``default_threshold``,
``score_policy``, ``forward_passes_per_window`` and ``raw_scores(x_cat, x_num) -> (raw score, contributions)`` for a whole
batch. The trained models are not public; :class:`DeviationModel` is a deterministic stand-in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uelumen.functions import times

TOP = 5
THRESHOLD = 0.975
#: Calibration keeps this many quantiles of the raw scores, so a model has one size for any corpus.
QUANTILES = 1000


@dataclass
class DeviationModel:
    """Mean absolute deviation of the features from calibration means, in standard deviations, by time step."""

    model_name: str = "deviation"
    model_display_name: str = "Deviation"
    selected_seed: int | None = None
    default_threshold: float = THRESHOLD
    score_policy: str = "mean_timestep"
    forward_passes_per_window: int = 1
    means: Sequence[float] = (0.0,) * 6
    deviations: Sequence[float] = (1.0,) * 6
    weights: Sequence[float] = (1.0,) * 6
    reference: Sequence[float] = field(default_factory=tuple)  # quantiles of calibration scores

    def raw_scores(self, x_cat: np.ndarray, x_num: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.concatenate([x_cat.astype(float), x_num.astype(float)], axis=2)
        z = np.abs(x - np.asarray(self.means)) / np.asarray(self.deviations) * np.asarray(self.weights)
        steps = z.mean(axis=2)
        return steps.mean(axis=1), steps

    def normalise(self, raw: np.ndarray) -> np.ndarray:
        """Share of the calibration scores that are not above: their empirical distribution."""
        if not len(self.reference):
            return np.zeros(len(raw))
        return np.searchsorted(np.asarray(self.reference), raw, side="right") / len(self.reference)


def timestep_table(gold: DataFrame) -> DataFrame:
    """(sample_id, t, f0..f5) of every time step, numbers as double."""
    steps = gold.select("sample_id", F.posexplode(F.arrays_zip("model_input.x_cat", "model_input.x_num")).alias("t", "z"))
    return steps.select("sample_id", "t", *[F.col("z.x_cat")[i].cast("double").alias(f"f{i}") for i in range(4)], *[F.col("z.x_num")[i].cast("double").alias(f"f{4 + i}") for i in range(2)])


def calibrate(gold: DataFrame, **names) -> DeviationModel:
    """The stand-in model of a calibration set: one aggregate for its means, one for its score quantiles."""
    names.setdefault("weights", (1.0,) * 6)
    row = timestep_table(gold).agg(*[F.avg(f"f{i}").alias(f"m{i}") for i in range(6)], *[F.stddev_pop(f"f{i}").alias(f"s{i}") for i in range(6)]).first()
    model = DeviationModel(means=[row[f"m{i}"] or 0.0 for i in range(6)], deviations=[row[f"s{i}"] or 1.0 for i in range(6)], **names)
    scored = score(gold, [model]).agg(F.percentile_approx("raw_score", [i / QUANTILES for i in range(1, QUANTILES + 1)], 10 * QUANTILES).alias("q")).first()
    model.reference = sorted(scored["q"] or [])
    return model


SCORE = (
    "sample_id string, model string, model_display_name string, selected_seed int, score_policy string, forward_passes_per_window int, raw_score double, anomaly_score double, "
    "anomaly_threshold double, contributions array<double>"
)


def score(gold: DataFrame, models: Sequence, threshold: float | None = None) -> DataFrame:
    """A row per sample and model. Samples stay in place: every task scores its batch with all models."""
    shipped = gold.sparkSession.sparkContext.broadcast(list(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x_cat, x_num = (np.array(batch.column(n).to_pylist()) for n in ("x_cat", "x_num"))
            for m in shipped.value:
                raw, steps = m.raw_scores(x_cat, x_num)
                n, limit = len(raw), m.default_threshold if threshold is None else threshold
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("sample_id"), pa.array([m.model_name] * n), pa.array([m.model_display_name] * n), pa.array([m.selected_seed] * n, pa.int32()), pa.array([m.score_policy] * n),
                        pa.array([m.forward_passes_per_window] * n, pa.int32()), pa.array(raw), pa.array(m.normalise(raw)), pa.array([float(limit)] * n), pa.array(list(steps), pa.list_(pa.float64())),
                    ],
                    names=[c.split()[0] for c in SCORE.split(", ")],
                )

    return gold.select("sample_id", "model_input.x_cat", "model_input.x_num").mapInArrow(run, SCORE)


def top_steps(contributions: Column, k: int = TOP) -> Column:
    """Indices of the ``k`` largest contributions, the first of equals first."""
    paired = F.transform(contributions, lambda c, i: F.struct((-c).alias("c"), i.alias("i")))
    return F.transform(F.slice(F.array_sort(paired), 1, k), lambda p: p["i"])


def top_evidence(indices: Column, contributions: Column, events: Column) -> Column:
    """struct(timestep, raw_contribution, event) by position; indices outside the events are skipped, a missing contribution is null."""
    made = F.transform(indices, lambda ix, rank: F.struct(ix.alias("timestep"), F.get(contributions, rank).alias("raw_contribution"), F.get(events, ix).alias("event")))
    return F.filter(made, lambda x: x["timestep"].isNotNull() & (x["timestep"] >= 0) & (x["timestep"] < F.size(events)))


def prediction_id(sample: Column, model: Column, seed: Column) -> Column:
    return F.concat_ws("::", sample, model, F.coalesce(seed.cast("string"), F.lit("None")))


def predictions(gold: DataFrame, models: Sequence, *, threshold: float | None = None, inference_time: Column | None = None) -> DataFrame:
    """Prediction records: one per sample and model, with the evidence of its top time steps."""
    rows = score(gold, models, threshold).join(gold.select("sample_id", "ue_key", "imsi", "feature_version", "window_start_event_time", "window_end_event_time", "sequence_length", "stride", "evidence"), "sample_id")
    rows = rows.withColumn("top_timestep_indices", top_steps(F.col("contributions")))
    rows = rows.withColumn("top_timestep_raw_contributions", F.transform("top_timestep_indices", lambda i: F.get(F.col("contributions"), i)))
    return rows.select(
        F.lit("anomaly-prediction-v2").alias("prediction_schema_version"), prediction_id(F.col("sample_id"), F.col("model"), F.col("selected_seed")).alias("prediction_id"), "sample_id", "ue_key", "imsi", "feature_version",
        "window_start_event_time", "window_end_event_time", "sequence_length", "stride", "model", "model_display_name", "selected_seed", "score_policy", "forward_passes_per_window", "raw_score", "anomaly_score",
        F.lit(False).alias("anomaly_score_is_probability"), "anomaly_threshold", (F.col("anomaly_score") >= F.col("anomaly_threshold")).alias("is_anomaly"), "top_timestep_indices", "top_timestep_raw_contributions",
        top_evidence(F.col("top_timestep_indices"), F.col("top_timestep_raw_contributions"), F.col("evidence.events")).alias("top_evidence_events"), (times.now_iso() if inference_time is None else inference_time).alias("inference_time"),
    )


def prediction_fault(columns: list[str]) -> Column:
    """What is wrong with a prediction record, or null."""
    forbidden = [c for c in ("conformal_p_value", "alpha") if c in columns]
    score_, limit = F.col("anomaly_score"), F.col("anomaly_threshold")
    checks = [
        (F.lit(bool(forbidden)), "legacy field"),
        (~score_.between(0, 1), "anomaly_score"),
        (~limit.between(0, 1), "anomaly_threshold"),
        (F.col("is_anomaly") != (score_ >= limit), "is_anomaly"),
        (F.col("anomaly_score_is_probability"), "anomaly_score_is_probability"),
    ]
    out = F.lit(None).cast("string")
    for fault, name in reversed(checks):
        out = F.when(F.coalesce(fault, F.lit(True)), name).otherwise(out)
    return out


def empirical_scores(df: DataFrame, raw: str, by: list[str]) -> DataFrame:
    """``anomaly_score``: the share of rows of the group with a raw score not above, exactly."""
    return df.withColumn("anomaly_score", F.cume_dist().over(Window.partitionBy(*by).orderBy(raw)))
