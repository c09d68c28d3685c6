"""From model outputs back to energies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from duoscope.functions import names
from duoscope.operators.matching import DATA_KEYS, without_nan_keys


def energy_scale(norm: DataFrame) -> DataFrame:
    """Mean and std of the logarithmic energy: the first row of the norm."""
    return norm.filter("pos = 0").select("mean", "std")


def adjust_energy(predictions: DataFrame, norm: DataFrame) -> DataFrame:
    """Undoes z-score and logarithm of ``dl`` and, where present, ``mc_truth``."""
    scale = energy_scale(norm).select(F.struct("mean", "std")).scalar()
    columns = [c for c in ("dl", "mc_truth") if c in predictions.columns]
    return predictions.withColumns(
        {c: F.exp(F.col(c) * scale["std"] + scale["mean"]) for c in columns}
    )


def adjust_many(predictions: Sequence[DataFrame], norm: DataFrame) -> DataFrame:
    """Adjusted energies of several inputs in one table."""
    return adjust_energy(reduce(DataFrame.unionByName, predictions), norm)


def score(events: DataFrame, make_predict_fn: Callable, n_features: int, batch_size: int = 1024) -> DataFrame:
    """Adds ``dl``, the output of a caller-supplied model on the feature array."""
    model = predict_batch_udf(
        make_predict_fn,
        return_type=DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[n_features]],
    )
    return events.withColumn("dl", model("pix"))


@dataclass(frozen=True)
class Imputed:
    """All events with their estimate, and per run how many have none."""

    rows: DataFrame
    status: DataFrame


def impute_energy(
    events: DataFrame, energies: DataFrame, on: Sequence[str] = ("run", *DATA_KEYS)
) -> Imputed:
    """Attaches the estimated energy by event keys, or by position with ``on=("run", "seq")``.

    Every event stays one row. It has no estimate (null) if there is none for its
    keys or several; ``status`` counts both, and ``ok`` holds where neither occurs.
    """
    estimates = (
        without_nan_keys(energies, on)
        .groupBy(*on)
        .agg(F.count("*").alias("_n"), F.first("dl").alias("_dl"))
    )
    rows = events.join(estimates, list(on), "left")
    several = F.coalesce(F.col("_n") > 1, F.lit(False))
    status = rows.groupBy("run").agg(
        F.count("*").alias("n_events"),
        F.count_if(F.col("_n").isNull()).alias("n_missing"),
        F.count_if(several).alias("n_repeated"),
        F.every(F.coalesce(F.col("_n") == 1, F.lit(False))).alias("ok"),
    )
    energy = F.when(~several, F.col("_dl")).alias("energy_est")
    return Imputed(rows.select(*events.columns, energy), status)


def is_prediction_input(name: Column, mode: str) -> Column:
    """Prediction file of the mode, neither stacked nor adjusted already?"""
    if mode not in ("data", "mc"):
        raise ValueError(f"mode must be data or mc, not {mode}")
    base = names.base_name(name)
    mark = names.VALIDATION_MARK if mode == "mc" else names.APPLICATION_MARK
    return (
        base.contains(mark)
        & ~base.startswith(names.MERGED_PREFIX)
        & ~base.endswith(names.IMPUTE_SUFFIX)
        & ~base.endswith(names.VALIDATE_SUFFIX)
        & base.endswith(names.TEXT_SUFFIX)
    )


def prediction_inputs(files: DataFrame, mode: str, name: str = "name") -> DataFrame:
    """The distinct prediction files of one mode."""
    return files.filter(is_prediction_input(F.col(name), mode)).dropDuplicates([name])


def energy_diff(
    imputed: DataFrame,
    original: DataFrame,
    on: Sequence[str] = ("run", "seq"),
    tol: float = 1.5e-2,
    value: str = "dl",
) -> DataFrame:
    """Per run: largest difference, whether all stay below ``tol``, whether all are equal.

    ``n_rows`` pairs are compared. Rows that only ``original`` has are allowed and
    counted; rows that only ``imputed`` has are counted and make a run neither close
    nor exact.
    """
    left = imputed.select(*on, F.col(value).alias("_a"), F.lit(True).alias("_in_a"))
    right = original.select(*on, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    gap = F.abs(F.col("_a") - F.col("_b"))
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    foreign = F.col("_in_b").isNull()
    return left.join(right, list(on), "full_outer").groupBy("run").agg(
        F.count_if(both).alias("n_rows"),
        F.count_if(foreign).alias("n_only_imputed"),
        F.count_if(F.col("_in_a").isNull()).alias("n_only_original"),
        F.max(gap).alias("max_diff"),
        F.count_if(gap >= tol).alias("n_above"),
        F.every(F.when(both, F.coalesce(gap < tol, F.lit(False))).otherwise(~foreign)).alias("close"),
        F.every(
            F.when(both, F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).otherwise(~foreign)
        ).alias("exact"),
    )
