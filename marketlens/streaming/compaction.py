"""Few files for event tables that are written batch by batch.

Every batch of a stream is a folder. A compaction rewrites the batches that can change no
more (a later one follows) by table and day below `_compacted`, and then commits a manifest:
one small file, named by its version, that says up to which batch of each query the rewritten
folders hold all rows. Readers take the newest manifest, its folders, and the batches after
it, so they see each row once before, during and after. What is rewritten but not committed
is in no manifest and is never read.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERY, BATCH = "query", "batch_id"
_MANIFESTS, _COMPACTED = "_manifest", "_compacted"


class CommitConflict(RuntimeError):
    """Another compaction committed first; nothing was changed."""


@dataclass
class Manifest:
    version: int = 0
    upto: dict[str, int] = field(default_factory=dict)  # last batch held, by query
    folders: list[str] = field(default_factory=list)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def _listed(spark: SparkSession, pattern: str) -> list:
    fs, hadoop_path = _file_system(spark, pattern)
    return list(fs.globStatus(hadoop_path) or [])


def manifest(spark: SparkSession, path: str) -> Manifest:
    """The newest committed manifest; an empty one if nothing was compacted yet."""
    names = [s.getPath().toString() for s in _listed(spark, f"{path}/{_MANIFESTS}/[0-9]*.json")]
    if not names:
        return Manifest()
    return Manifest(**json.loads(spark.read.text(max(names), wholetext=True).first()[0]))


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    """Writes beside, then renames to a name that must be free: all or nothing."""
    jvm = spark._jvm
    fs, folder = _file_system(spark, f"{path}/{_MANIFESTS}")
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(asdict(new)).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    final = jvm.org.apache.hadoop.fs.Path(folder, f"{new.version:012d}.json")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(final), options)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(final):
            raise CommitConflict(f"version {new.version} of {path} exists") from error
        raise


def batches(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Ids of the batch folders by query, ascending."""
    found: dict[str, list[int]] = {}
    for status in _listed(spark, f"{path}/{QUERY}=*/{BATCH}=*"):
        folder = status.getPath()
        query = folder.getParent().getName().split("=", 1)[1]
        found.setdefault(query, []).append(int(folder.getName().split("=", 1)[1]))
    return {query: sorted(ids) for query, ids in found.items()}


def _after(spark: SparkSession, path: str, known: Manifest) -> DataFrame | None:
    """Rows of the batches that no compacted folder holds."""
    later = [
        f"{path}/{QUERY}={query}/{BATCH}={number}"
        for query, ids in batches(spark, path).items()
        for number in ids
        if number > known.upto.get(query, -1)
    ]
    return spark.read.option("basePath", path).parquet(*later) if later else None


def _held(spark: SparkSession, path: str, folders: list[str]) -> list[DataFrame]:
    return [spark.read.parquet(f"{path}/{folder}") for folder in folders]


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the tables at `path`, each once, with `table`, `query` and `batch_id`."""
    known = manifest(spark, path)
    parts = [f.drop("day") for f in _held(spark, path, known.folders)]
    rest = _after(spark, path, known)
    if rest is not None:
        parts.append(rest.withColumns({QUERY: F.col(QUERY).cast("string"), BATCH: F.col(BATCH).cast("bigint")}))
    if not parts:
        raise ValueError(f"no event tables at {path}")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def compact(spark: SparkSession, path: str, merge_after: int = 8) -> Manifest:
    """Rewrites closed batches and commits; returns the manifest in force.

    Each table and day gets as few files as its size asks for. After `merge_after` compacted
    folders all of them are rewritten into one. Compactions that run at the same time do no
    harm: the first to commit wins, the others raise `CommitConflict`.
    """
    known = manifest(spark, path)
    closed = {query: ids[-1] - 1 for query, ids in batches(spark, path).items()}
    upto = known.upto | {q: last for q, last in closed.items() if last > known.upto.get(q, -1)}
    rest = _after(spark, path, known)
    if rest is None or upto == known.upto:
        return known
    ready = F.lit(False)
    for query, last in upto.items():
        ready = ready | ((F.col(QUERY).cast("string") == query) & (F.col(BATCH) <= last))
    rows = rest.withColumns({QUERY: F.col(QUERY).cast("string"), BATCH: F.col(BATCH).cast("bigint")}).where(ready)
    folders = list(known.folders)
    if len(folders) >= merge_after:
        for held in _held(spark, path, folders):
            rows = rows.unionByName(held.drop("day"))
        folders = []
    folder = f"{_COMPACTED}/{known.version + 1:012d}-{uuid.uuid4().hex}"
    dated = rows.withColumn("day", F.expr("try_cast(event_ts as date)"))
    dated.hint("rebalance", "table", "day").write.partitionBy("table", "day").parquet(f"{path}/{folder}")
    new = Manifest(known.version + 1, upto, [*folders, folder])
    _commit(spark, path, new)
    return new


def clean(spark: SparkSession, path: str, older_than: float = 3600.0) -> int:
    """Deletes batch folders that are compacted, and compacted folders no manifest in force
    names, once they are `older_than` seconds old: readers that began before the commit are
    done by then. Returns the number of folders deleted."""
    known, limit, gone = manifest(spark, path), (time.time() - older_than) * 1000, 0
    fs, _ = _file_system(spark, path)
    for status in _listed(spark, f"{path}/{QUERY}=*/{BATCH}=*") + _listed(spark, f"{path}/{_COMPACTED}/*"):
        folder = status.getPath()
        if folder.getName().startswith(f"{BATCH}="):
            query = folder.getParent().getName().split("=", 1)[1]
            idle = int(folder.getName().split("=", 1)[1]) <= known.upto.get(query, -1)
        else:
            idle = f"{_COMPACTED}/{folder.getName()}" not in known.folders
        if idle and status.getModificationTime() <= limit:
            fs.delete(folder, True)
            gone += 1
    return gone
