"""Array and scalar expressions on event rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Centre and width of the pointing angles, largest half float.
AZ_CENTRE, AZ_WIDTH = 180.0, 105.0
ZD_CENTRE, ZD_WIDTH = 45.0, 26.0
INF_CAP = 65504.0


def interleave(pix1, pix2) -> Column:
    """Feature by feature: even positions from M1, odd ones from M2."""
    return F.flatten(F.zip_with(pix1, pix2, lambda a, b: F.array(a, b)))


def log_energy(energy) -> Column:
    """Natural logarithm with the floating point conventions for 0 and below."""
    e = energy.cast("double")
    return (
        F.when(F.isnan(e), e)
        .when(e == 0, F.lit(float("-inf")))
        .when(e < 0, F.lit(float("nan")))
        .otherwise(F.ln(e))
    )


def finite(x, cap: float = INF_CAP) -> Column:
    """NaN becomes 0, infinities the largest finite value."""
    inf = float("inf")
    return F.when(F.isnan(x), 0.0).when(x == inf, cap).when(x == -inf, -cap).otherwise(x)


def finite_array(pix, cap: float = INF_CAP) -> Column:
    return F.transform(pix, lambda x: finite(x, cap)).cast("array<float>")


def pointing_zd(zd) -> Column:
    return (zd - ZD_CENTRE) / ZD_WIDTH


def pointing_az(az) -> Column:
    return (az - AZ_CENTRE) / AZ_WIDTH


def scaled(x, mean, std) -> Column:
    """z-score; a constant feature (std 0) passes through unchanged."""
    return F.when(std == 0, x).otherwise((x - mean) / F.when(std == 0, 1.0).otherwise(std))


def array_scaler(mean, std, cap: float = INF_CAP):
    """Arrow function ``pix -> z-scores`` for one mean and std per position.

    The two arrays have the width of one event row, whatever the number of
    events; they travel with the function. Positions with std 0 pass through,
    the result is made finite. Measured on rows of 6,400 features this is about
    three times as fast as ``zip_with`` plus ``transform``, which are
    interpreted.
    """
    mean, std = np.asarray(mean, "f8"), np.asarray(std, "f8")
    shift = np.where(std == 0, 0.0, mean)
    width = np.where(std == 0, 1.0, std)

    @F.arrow_udf("array<float>")
    def scale(pix: pa.Array) -> pa.Array:
        lengths = pix.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
        if np.any((lengths > 0) & (lengths != len(shift))):
            raise ValueError(f"event rows must have {len(shift)} features")
        flat = pix.flatten().to_numpy(zero_copy_only=False).astype("f8")
        with np.errstate(invalid="ignore", over="ignore"):
            z = (flat.reshape(-1, len(shift)) - shift) / width
            z = np.nan_to_num(z.astype("f4"), copy=False, nan=0.0, posinf=cap, neginf=-cap)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("i4")
        mask = pix.is_null() if pix.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()), mask=mask)

    return scale
