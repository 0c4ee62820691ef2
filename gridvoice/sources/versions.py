"""Tables that are replaced without a moment in which they cannot be read.

A table is a folder of immutable version folders and of pointers, small numbered files of which the last names the present version. A
new version is written whole, checked, and only then does its pointer appear, by one rename to a name that was free. (A rename over an
old pointer is atomic in some stores only.) A reader resolves the pointer once and stays on its version; a writer that fails leaves
every reader where it was, and of two writers of one number the second fails.

The pointer also carries facts that must change together with the rows: a batch number, a note of what was loaded.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTERS = "_pointers"


class Overtaken(RuntimeError):
    """Another writer published the same number first."""


class Rejected(RuntimeError):
    """A new version failed its check; the table is as it was."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    rows: int
    schema: T.StructType
    at: float
    facts: Mapping[str, object] = field(default_factory=dict)


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if it is not there."""
    fs, to_path = _files(spark, path)
    if not fs.exists(to_path(path)):
        return None
    stream = fs.open(to_path(path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place, then move it there in one step; the place must be free."""
    jvm = spark._jvm
    fs, to_path = _files(spark, path)
    target = to_path(path)
    aside = to_path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    target, aside = fs.makeQualified(target), fs.makeQualified(aside)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(aside, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        fs.delete(aside, False)
        raise Overtaken(f"{path} was published by another writer") from error


def pointers(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and path of the pointers there are."""
    fs, to_path = _files(spark, root)
    folder = to_path(f"{root}/{POINTERS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted((int(n[: -len(".json")]), f"{root}/{POINTERS}/{n}") for n in names if n.endswith(".json") and n[0] != ".")


def current(spark: SparkSession, root: str) -> Version | None:
    """The version that is published now, or None for a table without any."""
    text = None
    while text is None:  # a pointer may be dropped between the listing and the reading, and then there is a newer one
        found = pointers(spark, root)
        if not found:
            return None
        text = read_text(spark, found[-1][1])
    found = json.loads(text)
    schema = T.StructType.fromJson(found["schema"])
    return Version(found["number"], f"{root}/{found['folder']}", found["rows"], schema, found["at"], found["facts"])


def read(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The rows of one version, the present one unless it is given. The frame stays on it whatever is published later."""
    version = version or current(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.schema(version.schema).parquet(version.path)


def publish(
    df: DataFrame,
    root: str,
    facts: Mapping[str, object] | None = None,
    min_rows: int = 0,
    check: Callable[[DataFrame], bool] | None = None,
    partition_by: Sequence[str] = (),
) -> Version:
    """Write a new version and make it the present one.

    Rows are counted while they are written. With fewer than ``min_rows``, or if ``check`` of the written rows is false,
    ``Rejected`` is raised and nothing changes; the same holds for any error on the way.
    """
    spark = df.sparkSession
    before = current(spark, root)
    number = before.number + 1 if before else 1
    folder = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
    counted = Observation(f"rows_{uuid.uuid4().hex}")
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/{folder}")
    # partition columns come last when a partitioned table is read
    last = [f for f in df.schema.fields if f.name in partition_by]
    schema = T.StructType([f for f in df.schema.fields if f.name not in partition_by] + last)
    version = Version(number, f"{root}/{folder}", int(counted.get["rows"]), schema, time.time(), dict(facts or {}))
    if version.rows < min_rows:
        raise Rejected(f"{version.rows} rows where at least {min_rows} are expected")
    if check is not None and not check(read(spark, root, version)):
        raise Rejected("the check of the new rows failed")
    pointer = {"number": number, "folder": folder, "rows": version.rows, "at": version.at, "facts": version.facts}
    put_new(spark, f"{root}/{POINTERS}/{number:08d}.json", json.dumps(pointer | {"schema": schema.jsonValue()}))
    return version


def folders(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Number and name of every version folder there is, published or not."""
    fs, to_path = _files(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(to_path(root)) if s.isDirectory()]
    return sorted((int(n[1:].split("-")[0]), n) for n in names if n.startswith("v"))


def prune(spark: SparkSession, root: str, keep: int = 2, min_age: float = 0.0) -> list[str]:
    """Drop old versions: all but the present one and the ``keep - 1`` numbers before it, and what failed writers left.

    ``min_age`` in seconds spares folders that were changed lately, for readers and writers that are still at work.
    """
    now = current(spark, root)
    fs, to_path = _files(spark, root)
    for number, path in pointers(spark, root):
        if now and number < now.number:
            fs.delete(to_path(path), False)
    present = now.path.rsplit("/", 1)[1] if now else None
    dropped = []
    for number, name in folders(spark, root):
        kept = name == present or (now and now.number - keep < number < now.number)
        path = to_path(f"{root}/{name}")
        if kept or time.time() - fs.getFileStatus(path).getModificationTime() / 1000 < min_age:
            continue
        fs.delete(path, True)
        dropped.append(name)
    return dropped
