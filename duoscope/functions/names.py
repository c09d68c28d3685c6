"""Columns derived from event file names.

A file name carries date, telescope, run, subrun and processing step, e.g.
``20161008_M1_05057440.005_Y_Source.csv`` (observed data) or
``GA_M1_za35to50_8_1740993_Y_wr.csv`` (simulation). Every function takes the
name as a column and returns a column, so the work stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markers inside file names and names of produced files.
MC_MARK = "GA_"
STEPS = ("Y", "I", "S", "Q")
FILTER_PREFIX = "eventfiltered_"
MERGED_PREFIX = "merged_"
VALIDATION_MARK = "_validation_val.txt"
APPLICATION_MARK = "_application.txt"
IMPUTE_SUFFIX = "_adjusted_impute.txt"
VALIDATE_SUFFIX = "_adjusted_validate.txt"
TEXT_SUFFIX = ".txt"
SPAN_MARK = "_TO_"


def base_name(name) -> Column:
    """Last path element."""
    return F.element_at(F.split(name, "/"), -1)


def source_name(path) -> Column:
    """The last path element that carries a step letter.

    A file written by Spark is a directory of parts, possibly a ``key=value``
    one, so the name may sit above the last element; folders above it may carry
    step letters too.
    """
    return F.regexp_extract(path, r"^(?:.*/)?(?:\w+=)?([^/=]*_[YISQ]_[^/]*)", 1)


def _has_step(name, step: str) -> Column:
    return name.contains(f"_{step}_")


def _token(name, index: int) -> Column:
    return F.get(F.split(name, "_"), index)


def is_mc(name) -> Column:
    return base_name(name).contains(MC_MARK)


def run_of(name, full: bool = False) -> Column:
    """Run number; with ``full`` the subrun part (``05057440.005``) stays."""
    base = base_name(name)
    calibrated = _token(base, 2)
    return (
        F.when(is_mc(name) & _has_step(base, "S"), _token(base, 3))
        .when(is_mc(name), _token(base, 4))
        .when(
            _has_step(base, "Y") | _has_step(base, "I"),
            calibrated if full else F.substring_index(calibrated, ".", 1),
        )
        .when(_has_step(base, "S") | _has_step(base, "Q"), _token(base, 1))
        .otherwise(F.raise_error(F.concat(F.lit("no run in file name: "), base)))
    )


def subrun_of(name) -> Column:
    """Digits after the dot of the run token, null where there are none."""
    return F.get(F.split(run_of(name, full=True), r"\."), 1)


def telescope_of(name) -> Column:
    tel = F.regexp_extract(base_name(name), "_(M[12])_", 1)
    return F.when(tel != "", tel)


def step_of(name) -> Column:
    base = base_name(name)
    return F.coalesce(*[F.when(_has_step(base, s), F.lit(s)) for s in STEPS])


def _token_before(base, steps) -> Column:
    """Token in front of the first of ``steps`` that the name contains."""
    heads = [F.when(_has_step(base, s), F.substring_index(base, f"_{s}_", 1)) for s in steps]
    return F.substring_index(F.coalesce(*heads), "_", -1)


def id_of(name) -> Column:
    base = base_name(name)
    return F.coalesce(
        _token_before(base, ("Q", "Y", "S")),
        F.raise_error(F.concat(F.lit("no id in file name: "), base)).cast("string"),
    )


def time_token(name) -> Column:
    base = base_name(name)
    return F.coalesce(
        _token_before(base, ("Y", "I")),
        F.raise_error(F.concat(F.lit("no time in file name: "), base)).cast("string"),
    )


def span_label(first_name, last_name) -> Column:
    return F.concat(time_token(first_name), F.lit(SPAN_MARK), time_token(last_name))


def span_name(first_name, last_name) -> Column:
    """Name of a stacked file: that of the first one with its time replaced by the span."""
    base = base_name(first_name)
    step = F.when(_has_step(base, "Y"), "_Y_").otherwise("_I_")
    tail = F.substring(base, F.instr(base, step), F.length(base))
    stem = F.when(
        is_mc(first_name), F.concat_ws("_", F.lit("GA"), _token(base, 1), _token(base, 2))
    ).otherwise(F.regexp_extract(base, r"^(.*?_M[12])_", 1))
    return F.concat(stem, F.lit("_"), span_label(first_name, last_name), tail)


def batch_spans(files: DataFrame, batch: str = "batch", name: str = "name") -> DataFrame:
    """One row per batch of files: label and name of the stacked output."""
    ends = files.groupBy(batch).agg(
        F.min(name).alias("first_name"), F.max(name).alias("last_name"), F.count("*").alias("n_files")
    )
    first, last = F.col("first_name"), F.col("last_name")
    return ends.select(
        batch,
        "n_files",
        span_label(first, last).alias("span"),
        span_name(first, last).alias("span_name"),
    )


def run_level_name(name, prefix: bool = False) -> Column:
    """Name without the subrun; with ``prefix`` the name of the selected events."""
    base = base_name(name)
    plain = F.when(
        ~is_mc(name) & (_has_step(base, "Y") | _has_step(base, "I")),
        F.regexp_replace(base, r"^([^_]*_[^_]*_[^_.]*)\.[^_]*_", "$1_"),
    ).when(is_mc(name) | _has_step(base, "S"), base)
    plain = F.coalesce(
        plain, F.raise_error(F.concat(F.lit("no run-level name for: "), base)).cast("string")
    )
    return F.concat(F.lit(FILTER_PREFIX), plain) if prefix else plain


def energy_name(name, suffix: str = IMPUTE_SUFFIX) -> Column:
    """Output name of the energies of one prediction file, by its number of dots."""
    base = base_name(name)
    parts = F.split(base, r"\.")
    first = F.get(parts, 0)
    n = F.size(parts)
    stem = (
        F.when(n == 2, first)
        .when((n == 3) & ~base.contains("._I_"), first)
        .when(n == 3, F.substring_index(F.substring_index(base, "._I_", 1), "_", -1))
        .when((n == 4) & ~base.contains(SPAN_MARK) & ~is_mc(name), first)
        .when(n == 5, F.concat_ws(".", first, F.get(parts, 1)))
        .otherwise(F.raise_error(F.concat(F.lit("no output name for: "), base)))
    )
    return F.concat(stem, F.lit(suffix))


def number_key(name) -> Column:
    """Sort key: the first group of digits."""
    base = base_name(name)
    return F.when(
        ~base.startswith(MC_MARK), F.regexp_extract(base, r"(\d+)", 1).cast("long")
    ).otherwise(F.raise_error(F.lit("simulated files have no numeric order")).cast("long"))


def batch_key(name) -> Column:
    """Date (observed) or first five digits of the run (simulated)."""
    base = base_name(name)
    run = F.when(_has_step(base, "S"), _token(base, 3)).otherwise(_token(base, 4))
    return F.when(base.startswith(MC_MARK), F.substring(run, 1, 5)).otherwise(_token(base, 0))


def with_name_parts(files: DataFrame, name: str = "name") -> DataFrame:
    """Adds run, subrun, tel, step and is_mc."""
    col = F.col(name)
    return files.select(
        "*",
        run_of(col).alias("run"),
        subrun_of(col).alias("subrun"),
        telescope_of(col).alias("tel"),
        step_of(col).alias("step"),
        is_mc(col).alias("is_mc"),
    )


def step_check(files: DataFrame, name: str = "name") -> DataFrame:
    """How many files belong to each step, and whether all share one."""
    steps = files.groupBy(step_of(F.col(name)).alias("step")).agg(F.count("*").alias("n_files"))
    counted = steps.agg(F.count("*").alias("n_steps")).select("n_steps")
    return steps.withColumn("single_step", counted.scalar() == 1)


def split_telescopes(files: DataFrame, name: str = "name") -> tuple[DataFrame, DataFrame]:
    tel = telescope_of(F.col(name))
    return files.filter(tel == "M1"), files.filter(tel == "M2")
