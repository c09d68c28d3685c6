"""The whole way from calibrated events to energies.

Selection stores what several later steps read; joining, scaling and scoring are lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from duoscope.operators.energy import adjust_energy, score
from duoscope.operators.matching import DATA_KEYS, MC_KEYS
from duoscope.operators.normalise import normalize_camera, normalize_pixels
from duoscope.operators.selection import select_events
from duoscope.operators.statistics import REAL_PIXELS, feature_stats
from duoscope.operators.stereo import accepted_rows, position_status, positions, stereo_of_kept
from duoscope.sources.shared import listed, written

METHODS = (None, "pixelwise", "camerawise")


@dataclass(frozen=True)
class Preprocessed:
    """What each step produced; steps that were switched off are None."""

    status: DataFrame | None = None
    stereo: DataFrame | None = None
    norm: DataFrame | None = None
    normalized: DataFrame | None = None
    energies: DataFrame | None = None


def resolve_norm(mode: str, norm: DataFrame | None, stereo: DataFrame) -> DataFrame:
    """The given norm, or one built from simulated events; observed events need a given one.

    Either is stored, for it is read several times.
    """
    if norm is None and mode != "mc":
        raise ValueError("observed events need a norm from simulation")
    return written(feature_stats(stereo, mc=True) if norm is None else norm, "norm")


def preprocess(
    mode: str,
    events: DataFrame,
    stereo_keys: DataFrame | None = None,
    valid: DataFrame | None = None,
    norm: DataFrame | None = None,
    normalize: str | None = "pixelwise",
    make_predict_fn: Callable | None = None,
    n_features: int | None = None,
    n_real: int = REAL_PIXELS,
    stored: bool = False,
) -> Preprocessed:
    """Select events, join the telescopes, normalise, score, turn scores into energies.

    ``mode`` is ``data`` or ``mc`` and sets the key columns and the telescope whose
    keys are kept. Without ``stereo_keys`` the events count as selected already and
    are paired by position, in the runs where :func:`position_status` allows it;
    ``status`` tells about all runs. Without ``make_predict_fn`` nothing is scored. ``stored``
    says that events and stereo keys are tables on disk.
    """
    if mode not in ("data", "mc"):
        raise ValueError(f"mode must be data or mc, not {mode}")
    if normalize not in METHODS:
        raise ValueError(f"normalize must be one of {METHODS}, not {normalize}")
    mc = mode == "mc"
    if normalize == "camerawise" and not mc:
        raise ValueError("camera-wise scaling is defined for simulated events")
    if normalize is not None and norm is None and not mc:
        raise ValueError("observed events need a norm from simulation")
    if normalize is None and make_predict_fn is not None:
        raise ValueError("scores need normalised events")
    keys, owner = (MC_KEYS, "M2") if mc else (DATA_KEYS, "M1")
    if stereo_keys is not None:
        match = select_events(events, stereo_keys, valid, keys, stored=stored)
        status, kept = match.status, match.kept
    else:
        places = positions(events)
        status = listed(position_status(events, places), "position-status")
        kept = accepted_rows(places, status)
    stereo = stereo_of_kept(events, kept, keys_from=owner)
    if normalize is None:
        return Preprocessed(status, stereo)
    if norm is None and mc:
        # Read twice, for the statistics and for scaling: joined once.
        stereo = written(stereo, "stereo")
    norm = resolve_norm(mode, norm, stereo)
    if normalize == "camerawise":
        normalized = normalize_camera(stereo, norm, n_real)
    else:
        normalized = normalize_pixels(stereo, norm, mc)
    if make_predict_fn is None:
        return Preprocessed(status, stereo, norm, normalized)
    scored = score(normalized, make_predict_fn, n_features)
    linking = ["energy"] if mc else list(DATA_KEYS)
    predictions = scored.select("run", "sseq", *linking, "dl")
    if mc:
        predictions = predictions.withColumnRenamed("energy", "mc_truth")
    return Preprocessed(status, stereo, norm, normalized, adjust_energy(predictions, norm))
