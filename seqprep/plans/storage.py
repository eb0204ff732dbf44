"""Shared storage: where lineage is cut and where written tables live."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes a scan task reads by default.
TASK_BYTES = 128 * 1024 * 1024
# Stored bytes of a table that go to one piece where its rows are dealt out; they are several times that in text.
PIECE_BYTES = 16 * 1024 * 1024
LEAST_PIECES = 4

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the driver and the
    executors are one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="seqprep-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor, unlike a cached copy."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
    return df.checkpoint(eager=True)


def write_new(df: DataFrame, label: str) -> str:
    """Write ``df`` as a new parquet table in the shared folder; its path."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` read back from a new table, for several column-pruned passes."""
    return df.sparkSession.read.schema(df.schema).parquet(write_new(df, label))


def fingerprint(source: DataFrame, **parameters: object) -> str:
    """Name of a materialised table: its source files and the parameters that shaped it.

    ``source`` is a table read from files. Their names, sizes and times come from the file system, listed
    by Spark without a look into them, and are combined into one number, in any order.
    """
    paths = source.inputFiles()
    digest: list = [0, None]
    if paths:
        listed = source.sparkSession.read.format("binaryFile").load(paths)
        file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        digest = list(listed.agg(F.count("*"), F.sum(file)).first())
    content = json.dumps([[str(part) for part in digest], sorted(parameters.items())], default=str)
    return hashlib.sha256(content.encode()).hexdigest()[:32]


def _hadoop_path(spark: SparkSession, path: str) -> tuple:
    """A path and its file system, whatever storage it names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its success marker at ``path``."""
    marker, storage = _hadoop_path(spark, f"{path}/_SUCCESS")
    return storage.exists(marker)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders at ``path``; none if there is no such folder."""
    found, storage = _hadoop_path(spark, path)
    return [x.getPath().getName() for x in storage.listStatus(found)] if storage.exists(found) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table that this library wrote, if it is there."""
    found, storage = _hadoop_path(spark, path)
    storage.delete(found, True)


def read_spread(spark: SparkSession, path: str, *key: str) -> DataFrame:
    """Read parquet; rows of a table too small to reach every core are exchanged by ``key``.

    A table with enough files or bytes for all cores is read as it lies, without an exchange.
    """
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    found, storage = _hadoop_path(spark, path)
    content = storage.getContentSummary(found)
    if content.getFileCount() >= cores or content.getLength() >= cores * TASK_BYTES:
        return rows
    return rows.repartition(cores, *key)


def pieces_of(spark: SparkSession, path: str) -> int:
    """In how many pieces a table is dealt out, so that the size of a piece does not grow with it."""
    found, storage = _hadoop_path(spark, path)
    return max(LEAST_PIECES, -(-storage.getContentSummary(found).getLength() // PIECE_BYTES))


MANIFEST = "_manifest.json"


def materialise(
    df: DataFrame,
    path: str,
    name: str,
    partition_by: tuple[str, ...] = ("split",),
    parameters: Mapping[str, object] | None = None,
) -> DataFrame:
    """Write ``df`` once under ``path/name`` and read it from there from then on.

    ``name`` is normally a :func:`fingerprint`. The table is written aside, with a manifest of its schema
    and ``parameters``, and takes its name by one rename: of two writers one wins, and both read its
    table. What an interrupted writer left, without its success marker or manifest, is replaced. A table of that name
    with another schema or other parameters is refused. No shuffle is added: each task writes its own
    rows of each split.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/{name}"
    if not _is_finished(spark, target):
        aside = f"{path.rstrip('/')}/_{name}-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(aside)
        _write_text(spark, f"{aside}/{MANIFEST}", json.dumps(_manifest(df, parameters)))
        _commit(spark, aside, target)
    _check_manifest(spark, target, _manifest(df, parameters))
    return spark.read.schema(df.schema).parquet(target)


def _is_finished(spark: SparkSession, path: str) -> bool:
    manifest, storage = _hadoop_path(spark, f"{path}/{MANIFEST}")
    return is_complete(spark, path) and storage.exists(manifest)


def _manifest(df: DataFrame, parameters: Mapping[str, object] | None) -> dict:
    columns = {f.name: f.dataType.simpleString() for f in df.schema}
    return {"columns": columns, "parameters": json.loads(json.dumps(dict(parameters or {}), default=str))}


def _check_manifest(spark: SparkSession, path: str, wanted: dict) -> None:
    found = json.loads(_read_text(spark, f"{path}/{MANIFEST}"))
    for part in wanted:
        if found[part] != wanted[part]:
            names = {**found[part], **wanted[part]}
            other = sorted(n for n in names if found[part].get(n) != wanted[part].get(n))
            raise ValueError(f"{path} was written with other {part}: {', '.join(other)}")


def _commit(spark: SparkSession, aside: str, target: str) -> None:
    """Give a finished table its name, unless another writer was first."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, _ = _hadoop_path(spark, aside)
    goal, storage = _hadoop_path(spark, target)
    if storage.exists(goal) and not _is_finished(spark, target):
        storage.delete(goal, True)
    context = hadoop.FileContext.getFileContext(storage.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    # Without the option to overwrite, the rename fails where the name is taken.
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(source, goal, options)
    except Py4JJavaError:
        if not _is_finished(spark, target):
            raise
        storage.delete(source, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    found, storage = _hadoop_path(spark, path)
    stream = storage.create(found, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def _read_text(spark: SparkSession, path: str) -> str:
    found, storage = _hadoop_path(spark, path)
    stream = storage.open(found)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
