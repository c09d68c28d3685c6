"""File-name columns over the derived file list, in all documented name shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duoscope.functions import names
from workload import sql as q
from workload import tables as t
from workload.registry import query

# Shapes of file names; the placeholders are filled from the file list.
CALIBRATED = "20240101_{tel}_{run}.{subrun}_Y_Src-W0.40+215.csv"
CLEANED = "20240101_{tel}_{run}.{subrun}_I_Src-W0.40+215_mergecols.csv"
SELECTED = "eventfiltered_20240101_{run}.{subrun}_Y_Src-W0.40+035.csv"
STEREO = "20240101_{run}_S_Src-W0.40+215.csv"
IMAGED = "20240101_{run}_Q_Src-W0.40+215.csv"
MC_TELESCOPE = "GA_{tel}_za35to50_8_{run}_Y_wr.csv"
MC_STEREO = "GA_za05to35_8_{run}to{run}_S_wr_2.csv"
ALL = (CALIBRATED, CLEANED, SELECTED, STEREO, IMAGED, MC_TELESCOPE, MC_STEREO)
WITH_TIME = (CALIBRATED, CLEANED, MC_TELESCOPE)

# Shapes of prediction file names, by number of dots.
DATA_APPLICATION = "normalized_20240101_{run}.{subrun}_I_Src-W0.40+215.hdf5_application.txt"
RUN_APPLICATION = "normalized_eventfiltered_20240101_{run}_I_Src-W0.40+035.hdf5_application.txt"
MC_VALIDATION = "normalized_GA_{tel}_za05to35_8_{run}_Y_wr.hdf5_validation_val.txt"
NO_SUBRUN = "normalized_20240101_{run}._I_Src.hdf5"
ONE_DOT = "GA_{tel}_za05to35_8_{run}_Y_w0.txt"
STACKED = "merged_20240101_{run}.{subrun}_I_Src-W0.40+215.hdf5_application.txt"
ADJUSTED = "normalized_20240101_{run}_I_Src_application.txt_adjusted_impute.txt"
ENERGY_SHAPES = (DATA_APPLICATION, RUN_APPLICATION, MC_VALIDATION, NO_SUBRUN, ONE_DOT)

FILE_PARTS = (q.BASE, q.CALIB, q.FILES)


def fill(template: str) -> Column:
    column = F.lit(template)
    for part in ("tel", "run", "subrun"):
        column = F.replace(column, F.lit("{%s}" % part), F.col(part))
    return column


def fill_sql(template: str) -> str:
    text = f"'{template}'"
    for part in ("tel", "run", "subrun"):
        text = f"replace({text}, '{{{part}}}', {part})"
    return text


def listed(spark, sf_dir, templates) -> DataFrame:
    files = t.file_names(spark, sf_dir).select("run", "tel", "subrun")
    filled = F.array(*[fill(x) for x in templates])
    return files.select(F.explode(filled).alias("name")).distinct()


def expected(values: dict[str, str], out: str) -> str:
    """One select per shape, with the value that is known from the placeholders."""
    parts = [
        f"select distinct {fill_sql(shape)} as name, {value} as {out} from files" for shape, value in values.items()
    ]
    return q.sql(*FILE_PARTS, select=" union ".join(parts))


@query(expected({shape: ("run || 'to' || run" if shape == MC_STEREO else "run") for shape in ALL}, "run"))
def run_of(spark, sf_dir):
    return listed(spark, sf_dir, ALL).select("name", names.run_of(F.col("name")).alias("run"))


@query(
    expected(
        {
            shape: "run || '.' || subrun" if "{subrun}" in shape else "run"
            for shape in ALL
            if shape != MC_STEREO
        },
        "full_run",
    )
)
def full_run_of(spark, sf_dir):
    shapes = [s for s in ALL if s != MC_STEREO]
    return listed(spark, sf_dir, shapes).select(
        "name", names.run_of(F.col("name"), full=True).alias("full_run")
    )


@query(expected({s: "tel" if "{tel}" in s else "cast(null as varchar)" for s in ALL}, "tel"))
def telescope_of(spark, sf_dir):
    return listed(spark, sf_dir, ALL).select("name", names.telescope_of(F.col("name")).alias("tel"))


@query(
    expected(
        {
            CALIBRATED: "'Y'",
            CLEANED: "'I'",
            SELECTED: "'Y'",
            STEREO: "'S'",
            IMAGED: "'Q'",
            MC_TELESCOPE: "'Y'",
            MC_STEREO: "'S'",
        },
        "step",
    )
)
def step_of(spark, sf_dir):
    return listed(spark, sf_dir, ALL).select("name", names.step_of(F.col("name")).alias("step"))


@query(
    q.sql(
        *FILE_PARTS,
        select="""select 'Y' as step, count(*) as n_files, false as single_step from files
 union all select 'I', count(*), false from files""",
    )
)
def step_check(spark, sf_dir):
    return names.step_check(listed(spark, sf_dir, (CALIBRATED, CLEANED)))


@query(
    expected(
        {
            CALIBRATED: "run || '.' || subrun",
            SELECTED: "run || '.' || subrun",
            STEREO: "run",
            IMAGED: "run",
            MC_TELESCOPE: "run",
            MC_STEREO: "run || 'to' || run",
        },
        "id",
    )
)
def id_of(spark, sf_dir):
    shapes = (CALIBRATED, SELECTED, STEREO, IMAGED, MC_TELESCOPE, MC_STEREO)
    return listed(spark, sf_dir, shapes).select("name", names.id_of(F.col("name")).alias("id"))


@query(
    q.sql(
        *FILE_PARTS,
        select="""select run as batch, count(*) as n_files,
 run || '.' || min(subrun) || '_TO_' || run || '.' || max(subrun) as span,
 '20240101_M1_' || run || '.' || min(subrun) || '_TO_' || run || '.' || max(subrun)
  || '_Y_Src-W0.40+215.csv' as span_name
 from files where tel = 'M1' group by run""",
    )
)
def span_label(spark, sf_dir):
    m1, _ = names.split_telescopes(listed(spark, sf_dir, (CALIBRATED,)))
    return names.batch_spans(m1.withColumn("batch", names.run_of(F.col("name"))))


@query(
    expected(
        {
            CALIBRATED: "'eventfiltered_20240101_' || tel || '_' || run || '_Y_Src-W0.40+215.csv'",
            CLEANED: "'eventfiltered_20240101_' || tel || '_' || run || '_I_Src-W0.40+215_mergecols.csv'",
            MC_TELESCOPE: f"'eventfiltered_' || {fill_sql(MC_TELESCOPE)}",
        },
        "run_level",
    )
)
def run_level_name(spark, sf_dir):
    return listed(spark, sf_dir, WITH_TIME).select(
        "name", names.run_level_name(F.col("name"), prefix=True).alias("run_level")
    )


@query(
    expected(
        {
            DATA_APPLICATION: "'normalized_20240101_' || run || '.' || subrun || '_I_Src-W0_adjusted_impute.txt'",
            RUN_APPLICATION: "'normalized_eventfiltered_20240101_' || run || '_I_Src-W0_adjusted_impute.txt'",
            MC_VALIDATION: "'normalized_GA_' || tel || '_za05to35_8_' || run || '_Y_wr_adjusted_impute.txt'",
            NO_SUBRUN: "run || '_adjusted_impute.txt'",
            ONE_DOT: "'GA_' || tel || '_za05to35_8_' || run || '_Y_w0_adjusted_impute.txt'",
        },
        "energy_name",
    )
)
def energy_name(spark, sf_dir):
    return listed(spark, sf_dir, ENERGY_SHAPES).select(
        "name", names.energy_name(F.col("name")).alias("energy_name")
    )


@query(
    expected({"run{run}_{subrun}_I_Src.txt": "cast(run as bigint)", CALIBRATED: "cast(20240101 as bigint)"}, "number")
)
def number_key(spark, sf_dir):
    shapes = ("run{run}_{subrun}_I_Src.txt", CALIBRATED)
    return listed(spark, sf_dir, shapes).select(
        "name", names.number_key(F.col("name")).alias("number")
    )


@query(expected({s: "true" if "GA_" in s else "false" for s in ALL}, "is_mc"))
def is_mc(spark, sf_dir):
    return listed(spark, sf_dir, ALL).select("name", names.is_mc(F.col("name")).alias("is_mc"))


@query(
    expected(
        {s: "substr(run, 1, 5)" if "GA_" in s else "'20240101'" for s in ALL if s != SELECTED}, "batch"
    )
)
def batch_key(spark, sf_dir):
    shapes = [s for s in ALL if s != SELECTED]
    return listed(spark, sf_dir, shapes).select("name", names.batch_key(F.col("name")).alias("batch"))


@query(
    q.sql(
        *FILE_PARTS,
        select="""select replace(name, '_Y_Src.csv', '_Y_Src-W0.40+215.csv') as name, run, subrun, tel, 'Y' as step, false as is_mc
 from files""",
    )
)
def name_parts(spark, sf_dir):
    """All columns that a calibrated file's name carries."""
    files = t.file_names(spark, sf_dir).select(fill(CALIBRATED).alias("name"))
    return names.with_name_parts(files)
