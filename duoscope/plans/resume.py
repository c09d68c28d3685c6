"""The preparation as stages on disk that go on where the last attempt ended.

Every stage keeps a manifest of the runs it has finished. An attempt writes the rows of its
runs into a folder of its own and adds to the manifest after that; rows of an attempt that the
manifest does not name for a run do not count. A repeated call therefore works on the runs that
are missing, stage by stage, and reads nothing of the others but the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duoscope.functions.names import batch_key
from duoscope.operators.energy import adjust_energy, score
from duoscope.operators.matching import ACCEPTED, DATA_KEYS, MC_KEYS
from duoscope.operators.normalise import normalize_pixels
from duoscope.operators.selection import from_nth_file, select_events
from duoscope.operators.stereo import attach_position, stereo_of_positions
from duoscope.sources.events import PART, listed_files, parse_calib, text_of, with_seq, write_filtered
from duoscope.sources.shared import listed, many_folders
from duoscope.sources.tables import write_energies

STAGES = ("converted", "selected", "stereo", "normalized", "energies")
MANIFEST = "run string, status string, n_rows long, attempt string"


@dataclass(frozen=True)
class Manifest:
    """Runs that a stage has finished: run, status, n_rows, and the attempt that wrote their rows."""

    spark: SparkSession
    path: str

    def done(self, stage: str) -> DataFrame:
        """One row per run; the last attempt's, should two have added one."""
        try:
            rows = self.spark.read.schema(f"{MANIFEST}, at timestamp").parquet(f"{self.path}/{stage}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)
        last = F.max_by(F.struct("status", "n_rows", "attempt"), "at").alias("_last")
        return rows.groupBy("run").agg(last).select("run", "_last.*")

    def commit(self, stage: str, rows: DataFrame) -> None:
        """Adds runs whose rows are on disk."""
        rows.select(
            "run", "status", F.col("n_rows").cast("long"), "attempt", F.current_timestamp().alias("at")
        ).coalesce(1).write.mode("append").parquet(f"{self.path}/{stage}")

    def missing(self, stage: str, runs: DataFrame) -> DataFrame:
        """The ``runs`` that the stage has not finished."""
        todo = runs.select("run").distinct().join(self.done(stage).select("run"), "run", "left_anti")
        return listed(todo, "todo")


@dataclass
class Preparation:
    """Stages below ``out``; see :meth:`run`."""

    spark: SparkSession
    out: str
    mode: str = "data"

    def __post_init__(self):
        if self.mode not in ("data", "mc"):
            raise ValueError(f"mode must be data or mc, not {self.mode}")
        self.manifest = Manifest(self.spark, f"{self.out}/manifest")

    @property
    def keys(self):
        return MC_KEYS if self.mode == "mc" else DATA_KEYS

    def table(self, stage: str) -> DataFrame:
        """The rows of the runs that a stage has finished."""
        done = self.manifest.done(stage).filter("n_rows > 0").select("run", F.col("attempt").alias("_attempt"))
        with many_folders(self.spark):
            # The partition column is text whatever its values look like.
            rows = self.spark.read.parquet(f"{self.out}/{stage}").drop("attempt")
            schema = rows.schema.add("attempt", "string")
            rows = self.spark.read.schema(schema).parquet(f"{self.out}/{stage}")
        here = (F.col("_run") == F.col("run")) & (F.col("_attempt") == F.col("attempt"))
        return rows.join(done.withColumnRenamed("run", "_run"), here, "left_semi").drop("attempt", PART)

    def _write(self, stage: str, rows: DataFrame) -> tuple[DataFrame, str]:
        """Rows in the folder of a new attempt, and its name."""
        attempt = uuid.uuid4().hex
        path = f"{self.out}/{stage}/attempt={attempt}"
        if "pix" in rows.columns:
            return write_filtered(rows, path), attempt
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path), attempt

    def _finish(self, stage: str, rows: DataFrame, todo: DataFrame) -> None:
        """Writes the rows of the runs in ``todo``, then says so; a run without rows is finished as well."""
        stored, attempt = self._write(stage, rows)
        counts = stored.groupBy("run").agg(F.count("*").alias("n_rows"))
        found = todo.join(counts, "run", "left").select(
            "run",
            F.lit("ok").alias("status"),
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
            F.lit(attempt).alias("attempt"),
        )
        self.manifest.commit(stage, found)

    def convert(
        self, path: str, valid: DataFrame | None = None, first_file: int = 1, batch: str | None = None
    ) -> None:
        """Event files to rows by run. Only files of valid subruns are opened, from the n-th by name on.

        ``batch`` keeps to the files of one date, or of simulated runs that begin with five digits.
        """
        files = listed_files(self.spark, path)
        if batch is not None:
            files = files.filter(batch_key(F.col("name")) == batch)
        if first_file > 1:
            files = from_nth_file(files, first_file)
        if valid is not None:
            files = files.join(listed(valid.select("run", "subrun").distinct(), "valid"), ["run", "subrun"], "left_semi")
        todo = self.manifest.missing("converted", files)
        if todo.isEmpty():
            return
        lines = text_of(self.spark, files.join(todo, "run", "left_semi"))
        rows = with_seq(parse_calib(lines.select("*", F.monotonically_increasing_id().alias("split_row"))))
        self._finish("converted", rows, todo)

    def batches(self, path: str) -> DataFrame:
        """batch, n_files, n_runs: the units of work below a path, by date or beginning of the run."""
        files = listed_files(self.spark, path).withColumn("batch", batch_key(F.col("name")))
        return files.groupBy("batch").agg(F.count("*").alias("n_files"), F.count_distinct("run").alias("n_runs"))

    def select(self, events: DataFrame, stereo_keys: DataFrame, valid: DataFrame | None = None) -> None:
        """Selected events of both telescopes with their position, or of neither.

        A run with missing files is not finished: it is looked at again next time.
        """
        todo = self.manifest.missing("selected", stereo_keys)
        if todo.isEmpty():
            return
        here = [df if df is None else df.join(todo, "run", "left_semi") for df in (events, stereo_keys, valid)]
        match = select_events(here[0], here[1], here[2], self.keys)
        _, attempt = self._write("selected", attach_position(here[0], match.kept))
        per_run = match.status.groupBy("run").agg(
            F.min(F.when(~F.col("status").isin(*ACCEPTED), F.col("status"))).alias("_failed"),
            F.max(F.col("status") == "missing_files").alias("_open"),
            F.sum("n_kept").alias("n_rows"),
        )
        self.manifest.commit(
            "selected",
            per_run.filter(~F.col("_open")).select(
                "run", F.coalesce("_failed", F.lit("ok")).alias("status"), "n_rows", F.lit(attempt).alias("attempt")
            ),
        )

    def _next(self, stage: str, before: str) -> tuple[DataFrame, DataFrame] | None:
        """The runs that ``before`` has rows for and ``stage`` lacks, with these rows."""
        ready = self.manifest.done(before).filter("status = 'ok' and n_rows > 0")
        todo = self.manifest.missing(stage, ready)
        if todo.isEmpty():
            return None
        return todo, self.table(before).join(todo, "run", "left_semi")

    def stereo(self) -> None:
        work = self._next("stereo", "selected")
        if work is not None:
            todo, rows = work
            self._finish("stereo", stereo_of_positions(rows, "M2" if self.mode == "mc" else "M1"), todo)

    def normalize(self, norm: DataFrame) -> None:
        work = self._next("normalized", "stereo")
        if work is not None:
            todo, rows = work
            self._finish("normalized", normalize_pixels(rows, norm, self.mode == "mc"), todo)

    def energies(self, norm: DataFrame, make_predict_fn: Callable, n_features: int, outputs=("impute", "validate")) -> None:
        work = self._next("energies", "normalized")
        if work is None:
            return
        todo, rows = work
        linking = ["energy"] if self.mode == "mc" else list(DATA_KEYS)
        scored = score(rows, make_predict_fn, n_features).select("run", "sseq", *linking, "dl")
        if self.mode == "mc":
            scored = scored.withColumnRenamed("energy", "mc_truth")
        adjusted = adjust_energy(scored, norm)
        write_energies(adjusted, f"{self.out}/lines", outputs, order="sseq")
        stored, attempt = self._write("energies", adjusted)
        counts = stored.groupBy("run").agg(F.count("*").alias("n_rows"))
        self.manifest.commit(
            "energies", counts.select("run", F.lit("ok").alias("status"), "n_rows", F.lit(attempt).alias("attempt"))
        )

    def run(
        self,
        stereo_keys: DataFrame,
        norm: DataFrame,
        events: DataFrame | None = None,
        text: str | None = None,
        valid: DataFrame | None = None,
        make_predict_fn: Callable | None = None,
        n_features: int | None = None,
        until: str = STAGES[-1],
        first_file: int = 1,
        batch: str | None = None,
    ) -> "Preparation":
        """All stages up to ``until``, each for the runs it lacks.

        The events come as a table or as text files below ``text``, which are converted
        first, from the file with number ``first_file`` on, those of ``batch`` alone if there is one
        (see :meth:`batches`). Without a model nothing is scored.
        """
        if until not in STAGES:
            raise ValueError(f"until must be one of {STAGES}, not {until}")
        if (events is None) == (text is None):
            raise ValueError("give either a table of events or text files")
        steps = STAGES[: STAGES.index(until) + 1]
        if text is not None:
            self.convert(text, valid, first_file, batch)
            if "selected" in steps:
                events = self.table("converted")
        if "selected" in steps:
            self.select(events, stereo_keys, valid)
        if "stereo" in steps:
            self.stereo()
        if "normalized" in steps:
            self.normalize(norm)
        if "energies" in steps and make_predict_fn is not None:
            self.energies(norm, make_predict_fn, n_features)
        return self
