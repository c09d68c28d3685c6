"""Prediction files to energy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.functions import names
from duoscope.operators.energy import adjust_energy, is_prediction_input
from duoscope.sources.events import with_seq
from duoscope.sources.shared import written
from duoscope.sources.tables import read_predictions, write_energies


def energies(
    spark: SparkSession,
    path: str,
    norm: DataFrame,
    mode: str = "data",
    out: str | None = None,
    outputs=("impute", "validate"),
    by: str = "run",
) -> DataFrame:
    """Reads the prediction files of one mode, adjusts the energies, writes them to ``out``.

    ``by`` says whether the outputs go by run or by prediction file (see :func:`write_energies`).
    With ``out`` the result is stored once: what is returned is read, not worked out again.
    """
    run = F.substring_index(names.time_token(F.col("name")), ".", 1)
    rows = with_seq(
        read_predictions(spark, path, mode)
        .filter(is_prediction_input(F.col("name"), mode))
        .withColumn("run", run),
        ["run"],
    )
    adjusted = adjust_energy(rows, norm)
    if out is not None:
        adjusted = written(adjusted, "energies")
        write_energies(adjusted, out, outputs, stored=True, by=by)
    return adjusted
