"""z-scores of features, energy and pointing with a stored norm."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duoscope.functions.arrays import (
    INF_CAP,
    array_scaler,
    finite,
    log_energy,
    pointing_az,
    pointing_zd,
    scaled,
)
from duoscope.operators.statistics import CHANNELS, REAL_PIXELS, feature_stats

# A norm has one row per feature; anything longer is not a norm.
MAX_NORM_ROWS = 1_000_000


def norm_arrays(norm: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and std by position.

    The norm has the width of one event row and does not grow with the events;
    the size is checked before it is read.
    """
    rows = norm.select("pos", "mean", "std").limit(MAX_NORM_ROWS + 1).toPandas()
    if len(rows) > MAX_NORM_ROWS:
        raise ValueError(f"a norm has one row per feature, not more than {MAX_NORM_ROWS}")
    rows = rows.sort_values("pos")
    if rows["pos"].tolist() != list(range(len(rows))):
        raise ValueError("norm positions must run from 0 without gaps")
    return rows["mean"].to_numpy("f8", na_value=np.nan), rows["std"].to_numpy("f8", na_value=np.nan)


def pass_through_tail(mean: np.ndarray, std: np.ndarray, skip: int):
    """Leaves the last ``skip`` features unscaled."""
    mean, std = mean.copy(), std.copy()
    if skip:
        mean[-skip:], std[-skip:] = 0.0, 0.0
    return mean, std


def normalize_pointing(events: DataFrame, cap: float = INF_CAP) -> DataFrame:
    return events.withColumns(
        {
            "zd": finite(pointing_zd(F.col("zd")), cap),
            "az": finite(pointing_az(F.col("az")), cap),
        }
    )


def normalize_energy(events: DataFrame, mean: float, std: float, cap: float = INF_CAP) -> DataFrame:
    z = scaled(log_energy(F.col("energy")), F.lit(float(mean)), F.lit(float(std)))
    return events.withColumn("energy", finite(z, cap))


def normalize_pixels(
    events: DataFrame,
    norm: DataFrame,
    mc: bool,
    skip_tail: int = 0,
    inf_cap: float = INF_CAP,
    pointing: str = "constants",
) -> DataFrame:
    """z-scores with a norm whose position 0 is the energy and 1.. are the features.

    Observed events have no energy, so only the feature rows apply to them.
    Features with std 0 pass through; NaN becomes 0, infinities ``inf_cap``.
    ``pointing`` is scaled with its constants, or left ``raw``. ``skip_tail=3``
    leaves the last three features as they are, as older outputs have them.
    """
    if pointing not in ("constants", "raw"):
        raise ValueError(f"pointing must be constants or raw, not {pointing}")
    mean, std = norm_arrays(norm)
    features = slice(1, len(mean) - 2)
    scale = array_scaler(*pass_through_tail(mean[features], std[features], skip_tail), inf_cap)
    out = events.withColumn("pix", scale("pix"))
    if mc:
        out = normalize_energy(out, mean[0], std[0], inf_cap)
    return normalize_pointing(out, inf_cap) if pointing == "constants" else out


def normalize_own(events: DataFrame, skip_tail: int = 0, inf_cap: float = INF_CAP) -> DataFrame:
    """Simulated events with their own statistics; pointing stays raw."""
    norm = feature_stats(events, mc=True)
    return normalize_pixels(events, norm, True, skip_tail, inf_cap, pointing="raw")


def normalize_camera(
    events: DataFrame,
    norm: DataFrame | None = None,
    n_real: int = REAL_PIXELS,
    compat: bool = False,
    inf_cap: float = INF_CAP,
) -> DataFrame:
    """Simulated events scaled with one mean and std per channel.

    A feature is scaled where its own std is not 0; energy and pointing use their
    own statistics. ``compat`` takes the first channel's constants for all four.
    """
    if norm is None:
        norm = feature_stats(events, mc=True)
    mean, std = norm_arrays(norm)
    n_features = len(mean) - 3
    channel = np.arange(n_features) % len(CHANNELS)
    own = std[1 : n_features + 1]
    # The camera's constants come from the norm just read: one pass over the events.
    per_channel = [
        np.bincount(channel, values, len(CHANNELS)) / n_real for values in (mean[1 : n_features + 1], own)
    ]
    if compat:
        channel = np.zeros(n_features, int)
    mu = per_channel[0][channel]
    sd = np.where(own == 0, 0.0, per_channel[1][channel])
    out = normalize_energy(events.withColumn("pix", array_scaler(mu, sd, inf_cap)("pix")), mean[0], std[0], inf_cap)

    def pointing(name: str, pos: int):
        return finite(scaled(F.col(name), F.lit(float(mean[pos])), F.lit(float(std[pos]))), inf_cap)

    return out.withColumns(
        {"zd": pointing("zd", n_features + 1), "az": pointing("az", n_features + 2)}
    )
