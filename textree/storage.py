"""Session set-up and the shared folder in which stages are written and read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textree")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="textree-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete through the Hadoop file system that owns ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass(frozen=True)
class Stored:
    """A frame that was written to the shared folder, and where it lies."""

    df: DataFrame
    path: str

    def release(self) -> None:
        delete_path(self.df.sparkSession, self.path)


@dataclass
class Scope:
    """What was stored while this scope was the innermost open one, by path."""

    made: dict[str, Stored] = field(default_factory=dict)
    kept: set[str] = field(default_factory=set)

    def keep(self, *frames: DataFrame) -> None:
        """The tables that ``frames`` read outlive the scope; they pass to the scope around it, if there is one."""
        read = {path for frame in frames for path in tables_read(frame)}
        self.kept |= {path for path in self.made if _plain(path) in read}

    def release(self) -> None:
        """Delete all that is still owned, kept tables included."""
        for stored in self.made.values():
            stored.release()
        self.made.clear()


_SCOPE: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def scope() -> Iterator[Scope]:
    """Owns the tables stored inside the ``with`` block and deletes them at its end, but those read by frames given to
    ``keep``. Those are deleted with the scope around it or by ``release``. A block that fails keeps nothing.

    Frames are lazy: one that is used after the block must be kept.
    """
    outer, own = _SCOPE.get(), Scope()
    token = _SCOPE.set(own)
    try:
        yield own
    except BaseException:
        own.kept.clear()
        raise
    finally:
        _SCOPE.reset(token)
        for path in [p for p in own.made if p not in own.kept]:
            own.made.pop(path).release()
        if outer is not None:
            outer.made |= own.made


def _plain(path: str) -> str:
    """A path without scheme and doubled slashes, as plans and settings write it differently."""
    return "/" + path.split(":", 1)[-1].strip("/")


def tables_read(df: DataFrame) -> set[str]:
    """Folders that the plan of ``df`` reads, without listing their files."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    found = set()
    for at in range(leaves.size()):
        leaf = leaves.apply(at)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            found |= {_plain(roots.apply(i).toString()) for i in range(roots.size())}
    return found


def store(df: DataFrame, name: str = "stage") -> Stored:
    """Write ``df`` as parquet and read it back: lineage ends here and survives lost executors.

    Inside a ``scope`` the table belongs to it.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    stored = Stored(spark.read.schema(df.schema).parquet(path), path)
    if (owner := _SCOPE.get()) is not None:
        owner.made[path] = stored
    return stored


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin repartitioning of a plain scan, only where it has fewer pieces than there are cores.

    For scans alone: asking one for its partitions runs nothing, while a plan with shuffles would run them.
    A table in many pieces is left as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
