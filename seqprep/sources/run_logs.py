"""Run logs: lines written from interval and summary rows, and read back as typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqprep.functions.scalars import LOG_NAME_TIME, fixed_text, log_name_time, summary_line

# The step line and the labels of the summary lines.
STEP_LINE = "[Step %d] | TPS: %s tokens/sec | Loss: %s | LR : %s | Duration for 1 Step: %s sec"
STEP_PATTERN = (
    r"\[Step (\d+)\] \| TPS: (\S+) tokens/sec \| Loss: (\S+) \| LR : (\S+)"
    r" \| Duration for 1 Step: (\S+) sec"
)
TOTAL = "Total Duration:"
LOADING = "  Model Loading Duration:"
TRAIN = "  Train Duration:"
EVALUATION = "  Evaluation Duration:"
ESTIMATED = "Total Estimated Duration:"
AVG_TPS = "Avg TPS:"
SUMMARY_PATTERN = (
    r"^\s*(Total Duration|Model Loading Duration|Train Duration|Evaluation Duration"
    r"|Total Estimated Duration|Avg TPS):\s+(.*)$"
)
MARK_PATTERN = r"^(Start|End): (.*)$"
ELAPSED_PATTERN = r"(?:(-?\d+) days?, )?(\d+):(\d{2}):(\d{2}(?:\.\d+)?)"
# Numbers of lines of one run that go to one file.
LINES_PER_FILE = 1_000_000
# Reading tasks for each task of an exchange, at most.
READS_PER_TASK = 8
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

LOG_NAME_PATTERN = r"([^/=]*?)_?(\d{6}_\d{6})\.log"


def step_line() -> Column:
    """The log line of an interval row."""
    return F.format_string(
        STEP_LINE,
        "step",
        fixed_text(F.col("tps"), 2),
        fixed_text(F.col("loss"), 6),
        fixed_text(F.coalesce("learning_rate", F.lit(0.0)), 8),
        fixed_text(F.col("seconds_per_step"), 2),
    )


def elapsed_text(days: Column, rest: Column) -> Column:
    """Days and seconds as ``[D day[s], ]H:MM:SS[.ffffff]``."""
    micros = F.round(rest * 1_000_000).cast("bigint")
    whole = F.floor(micros / 1_000_000).cast("bigint")
    fraction = (micros % 1_000_000).cast("bigint")
    prefix = F.when(days == 0, "").otherwise(
        F.format_string("%d day%s, ", days, F.when(F.abs(days) == 1, "").otherwise("s"))
    )
    clock = F.format_string(
        "%d:%02d:%02d",
        F.floor(whole / 3600).cast("bigint"),
        (F.floor(whole / 60) % 60).cast("bigint"),
        whole % 60,
    )
    part = F.when(fraction == 0, "").otherwise(F.format_string(".%06d", fraction))
    return F.concat(prefix, clock, part)


def summary_lines(epochs: int) -> Column:
    """The report of a summary row with its estimate, as an array of lines."""
    elapsed = elapsed_text(F.col("estimated_days"), F.col("estimated_rest_seconds"))
    return F.array(
        summary_line(TOTAL, F.col("total_seconds"), " seconds"),
        summary_line(LOADING, F.col("warm_up_seconds"), " seconds"),
        summary_line(TRAIN, F.col("train_seconds"), " seconds"),
        summary_line(EVALUATION, F.col("eval_seconds"), " seconds"),
        F.concat(F.rpad(F.lit(ESTIMATED), 30, " "), F.lit(" "), elapsed, F.lit(f" for {epochs} epochs")),
        summary_line(AVG_TPS, F.col("avg_tps"), " tps"),
    )


def log_file_name(run: Column, started: Column) -> Column:
    """``<run>_<time>.log``: runs of one place may start in the same second."""
    return F.concat(run, F.lit("_"), F.date_format(started, LOG_NAME_TIME), F.lit(".log"))


def write_run_logs(lines: DataFrame, path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """Write ``(run_id, started, ord, line)`` as one log folder per run.

    ``ord`` numbers the lines of a run. A run's log is one file up to ``lines_per_file`` numbers;
    a longer run is written by as many tasks as it has such pieces. Many runs mean many small
    files, so the number of writing tasks is kept even where the lines themselves are few.
    """
    piece = F.floor(F.col("ord") / F.lit(lines_per_file))
    name = log_file_name(F.col("run_id").cast("string"), F.col("started"))
    named = lines.select(name.alias("log"), "ord", "line")
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = named.repartition(tasks, "log", piece)
    ordered = placed.sortWithinPartitions("log", "ord").drop("ord")
    ordered.write.mode("overwrite").partitionBy("log").text(path)


def write_packed_logs(lines: DataFrame, path: str) -> None:
    """Write ``(run_id, started, ord, line)`` as one table of all logs, in the order of log and line.

    Its files follow the size of the lines, not the number of runs, and a log is found by the bounds of
    its name in them; a very long log is spread over as many files as it fills.
    """
    name = log_file_name(F.col("run_id").cast("string"), F.col("started"))
    named = lines.select(name.alias("log"), F.col("ord").cast("bigint").alias("ord"), "line")
    placed = named.repartitionByRange("log", "ord").sortWithinPartitions("log", "ord")
    placed.write.mode("overwrite").parquet(path)


def read_packed_logs(spark: SparkSession, path: str, keep_unknown: bool = False) -> DataFrame:
    """The typed records of a table of :func:`write_packed_logs`, as :func:`read_run_logs` has them."""
    rows = spark.read.schema("log string, ord bigint, line string").parquet(path)
    return _typed(
        rows.select("line", F.col("log").alias("_file"), F.lit(0).cast("bigint").alias("block"), F.col("ord").alias("place")),
        keep_unknown,
    )


def read_run_logs(spark: SparkSession, path: str, keep_unknown: bool = False) -> DataFrame:
    """Typed records of all log lines under ``path``.

    A step may stand behind a progress bar on its line.

    ``run`` and ``started`` come from the log's name, ``<run>_<time>.log`` or ``<time>.log``.
    ``kind`` is step, summary or mark; an estimate is returned in seconds. Lines of no known form are
    left out, or with ``keep_unknown`` returned as ``line`` with the kind unknown, so that they can be
    counted. ``block`` and ``place`` order the lines of a log.

    Folder names are not taken for a column, which would cost the driver a parse of each, and the number
    of tasks that list and read does not follow that of the folders.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Files are listed here, and not when the rows are read.
    before = spark.conf.get(_LISTING, None)
    spark.conf.set(_LISTING, str(READS_PER_TASK * tasks))
    try:
        raw = spark.read.option("recursiveFileLookup", "true").text(path)
    finally:
        spark.conf.unset(_LISTING) if before is None else spark.conf.set(_LISTING, before)
    lines = raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return _typed(lines.coalesce(READS_PER_TASK * tasks), keep_unknown)


def _fields(text: Column, gate: str, pattern: str, groups: int) -> Column:
    """The groups of a pattern over the whole text by one pass, or NULL; looked for behind a plain ``gate``."""
    marked = F.regexp_replace(text, f"(?s)^{pattern}$", _CUT.join(f"${i + 1}" for i in range(groups)))
    parts = F.when(text.contains(gate), F.split(marked, _CUT))
    return F.when(F.size(parts) == groups, F.transform(parts, lambda x: F.nullif(x, F.lit(""))))


_CUT = "\x01"


def _typed(lines: DataFrame, keep_unknown: bool) -> DataFrame:
    """``line, _file, block, place`` to typed records: each line is matched once, by the pattern of its kind."""
    line = F.translate("line", _CUT, " ")
    step = _fields(line, "[Step ", f".*?{STEP_PATTERN}.*", 5)
    other = _fields(line, ":", f"(?:{SUMMARY_PATTERN[1:-1]}|{MARK_PATTERN[1:-1]})", 4)
    cut = lines.withColumn("_step", step).withColumn("_other", F.when(F.col("_step").isNull(), other))
    kind = (
        F.when(F.col("_step").isNotNull(), "step")
        .when(F.get("_other", 0).isNotNull(), "summary")
        .when(F.col("_other").isNotNull(), "mark")
        .otherwise("unknown")
    )
    cut = cut.withColumn("kind", kind)
    cut = cut if keep_unknown else cut.filter("kind <> 'unknown'")
    label, value = F.get("_other", 0), F.get("_other", 1)
    estimate = label == ESTIMATED.rstrip(":")
    clock = F.when(estimate, _fields(value, ":", f"{ELAPSED_PATTERN}.*", 4))
    cut = cut.withColumn("_clock", clock)
    part = lambda i: F.get("_clock", i).try_cast("double")
    elapsed = F.coalesce(part(0), F.lit(0.0)) * 86_400 + part(1) * 3_600 + part(2) * 60 + part(3)
    plain = F.substring_index(value, " ", 1).try_cast("double")
    time = F.regexp_extract(F.col("_file"), LOG_NAME_PATTERN, 2)
    run = F.regexp_extract(F.col("_file"), LOG_NAME_PATTERN, 1)
    figure = lambda i: F.get("_step", i).try_cast("double")
    return cut.select(
        F.nullif(run, F.lit("")).alias("run"),
        time.alias("log"),
        log_name_time(time).alias("started"),
        "kind",
        F.get("_step", 0).try_cast("bigint").alias("step"),
        figure(1).alias("tps"),
        figure(2).alias("loss"),
        figure(3).alias("learning_rate"),
        figure(4).alias("seconds_per_step"),
        F.coalesce(label, F.get("_other", 2)).alias("label"),
        F.when(estimate, elapsed).otherwise(plain).alias("value"),
        F.get("_other", 3).alias("mark"),
        F.when(F.col("kind") == "unknown", F.col("line")).alias("line"),
        "block",
        "place",
    )
