"""Files under names of their own: a data source that writes each text to the file that its row names.

Rows are (name, text); the name is a path below the target.  Each task streams its rows to files on
any file system that Arrow knows (local and mounted folders, HDFS, S3, GCS), one open at a time;
rows that follow each other with one name go to one file.  A file is written below a folder of the
run and moved to its name when it is whole, so no reader sees a half of it.  Before a task moves
files it lists their names in that folder.  A task that runs again writes the same names again; a
job that fails removes what all its tasks have listed, those of lost executors as well, and leaves a
mark by which a task that still runs sees that it has to remove its own; a job that succeeds removes
the lists and leaves ``_SUCCESS``.  Names come and go with the rows: nothing is gathered anywhere,
and the driver never reads names but those of a failed job, list by list.

Defined cases: a null text is an empty file, which Spark's readers give no row for; a null or empty
name, and one that leaves the target (absolute, or with empty parts, ``.`` or ``..``), is an error;
of rows with one name that do not follow each other one stays, whichever is written last; files that
were there before are replaced (a job that fails removes those that it had replaced), and with mode
``overwrite`` the whole target goes first.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "glossa_named"
#: What belongs to runs that are not done; Spark's readers pass over names that begin so.
PENDING = "_named"
#: Names in one list; files that a failed job removes at a time.
LISTED, THREADS = 1000, 16
#: Bytes that a reading task holds at a time, besides one file.
READ_AT_ONCE = 4 << 20


@dataclass
class Written(WriterCommitMessage):
    files: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    files, root = fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:", path) else (fs.LocalFileSystem(), path)
    return files, root.rstrip("/")


def _checked(name: str | None) -> str:
    if not name or any(part in ("", ".", "..") for part in name.split("/")) or name.split("/")[0] == PENDING:
        raise ValueError(f"not a name below the target: {name!r}")
    return name


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.run = path, uuid.uuid4().hex
        if overwrite:
            files, root = _opened(path)
            if files.get_file_info(root).type == fs.FileType.Directory:
                files.delete_dir_contents(root)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _opened(self.path)
        task = TaskContext.get()
        own = f"{root}/{PENDING}/{self.run}/{task.partitionId()}-{task.taskAttemptId()}"
        files.create_dir(own)
        made, lists, folders, at, stream, recent = 0, 0, set(), None, None, []

        def close() -> None:
            if stream is not None:
                stream.close()
                files.move(f"{own}/open", f"{root}/{at}")

        def stop_if_aborted() -> None:
            if self._aborted(files, root):
                for names in recent:  # of lists that may be gone already
                    self._deleted(files, root, names)
                self._removed(files, root, own)
                raise RuntimeError("the job has failed")

        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, LISTED):
                    stop_if_aborted()
                    rows = batch.slice(start, LISTED)
                    names = [_checked(n) for n in rows.column(0).to_pylist()]
                    recent = [*recent[-1:], names]
                    with files.open_output_stream(f"{own}/{lists}.json") as out:
                        out.write(json.dumps(sorted(set(names))).encode())
                    lists += 1
                    for name, text in zip(names, rows.column(1), strict=True):
                        if name != at:
                            close()
                            folder = f"{root}/{name}".rpartition("/")[0]
                            if folder not in folders:
                                files.create_dir(folder)
                                folders.add(folder)
                            at, stream, made = name, files.open_output_stream(f"{own}/open"), made + 1
                        if text.is_valid:
                            stream.write(text.as_buffer())
            close()
        finally:
            if stream is not None and not stream.closed:
                stream.close()
            stop_if_aborted()
        return Written(made)

    def _aborted(self, files: fs.FileSystem, root: str) -> bool:
        return files.get_file_info(f"{root}/{PENDING}/{self.run}.aborted").type == fs.FileType.File

    @staticmethod
    def _deleted(files: fs.FileSystem, root: str, names: list[str]) -> None:
        def delete(name: str) -> None:
            if files.get_file_info(f"{root}/{name}").type == fs.FileType.File:
                files.delete_file(f"{root}/{name}")

        with ThreadPoolExecutor(THREADS) as pool:
            list(pool.map(delete, set(names)))

    def _removed(self, files: fs.FileSystem, root: str, own: str) -> None:
        """The files that a task has listed go, and then its lists."""
        for info in files.get_file_info(fs.FileSelector(own, allow_not_found=True)):
            if info.path.endswith(".json"):
                with files.open_input_stream(info.path) as listed:
                    self._deleted(files, root, json.loads(listed.read()))
        if files.get_file_info(own).type == fs.FileType.Directory:
            files.delete_dir(own)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _opened(self.path)
        self._done(files, root)
        files.create_dir(root)
        with files.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _opened(self.path)
        files.create_dir(f"{root}/{PENDING}")
        with files.open_output_stream(f"{root}/{PENDING}/{self.run}.aborted"):
            pass
        for info in files.get_file_info(fs.FileSelector(f"{root}/{PENDING}/{self.run}", allow_not_found=True)):
            self._removed(files, root, info.path)
        self._done(files, root)

    def _done(self, files: fs.FileSystem, root: str) -> None:
        """The run's own folder goes, and the folder of all runs if it is empty."""
        for folder in (f"{root}/{PENDING}/{self.run}", f"{root}/{PENDING}"):
            inside = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            if files.get_file_info(folder).type == fs.FileType.Directory and (folder.endswith(self.run) or not inside):
                files.delete_dir(folder)


class NamedFiles(DataSource):
    """Writes (name, text) rows to files below the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"], overwrite)


def write_named(rows: DataFrame, path: str, name: Column, body: Column, *, mode: str = "append", order: list[Column] | None = None) -> None:
    """Each row's text in the file that it names.

    With ``order`` many rows may have one name: its texts follow each other in that order in the one
    file, which one task streams, as a file has one writer.
    """
    rows.sparkSession.dataSource.register(NamedFiles)
    named = rows.select(name.cast("string").alias("name"), body.cast("string").alias("text"), *[x.alias(f"order{k}") for k, x in enumerate(order or [])])
    if order is not None:
        keys = [F.col(f"order{k}") for k in range(len(order))]
        named = named.repartition("name").sortWithinPartitions("name", *keys)
    named.select("name", "text").write.format(FORMAT).mode(mode).save(path)


def write_parts(rows: DataFrame, path: str, name: Column, body: Column, by: list[Column], suffix: str = "") -> None:
    """Texts of one name in the order of ``by``, in files ``name.0007suffix`` of a task's share each, so that no task has to write all of a name; the numbers follow the order."""
    named = rows.select(name.cast("string").alias("name"), body.cast("string").alias("text"), *[x.alias(f"by{k}") for k, x in enumerate(by)])
    keys = ["name", *[f"by{k}" for k in range(len(by))]]
    ranges = named.repartitionByRange(*keys).sortWithinPartitions(*keys)
    write_named(ranges, path, F.concat("name", F.lit("."), F.lpad(F.spark_partition_id().cast("string"), 5, "0"), F.lit(suffix)), F.col("text"))


def _listed(path: str) -> Iterator[tuple[str, int]]:
    """(name, size) of the files below a folder but those that Spark's readers pass over."""
    files, root = _opened(path)
    open_folders = [root]
    while open_folders:
        for info in files.get_file_info(fs.FileSelector(open_folders.pop())):
            if info.base_name[0] in "_.":
                continue
            if info.type == fs.FileType.Directory:
                open_folders.append(info.path)
            elif info.size:
                yield info.path[len(root) + 1 :], info.size


def named_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, name, size) of the files below a folder that are not empty, each top folder listed by a task; the driver sees the top level only."""
    files, root = _opened(path)
    tops = [info for info in files.get_file_info(fs.FileSelector(root)) if info.base_name[0] not in "_."]
    plain = [(path, info.base_name, info.size) for info in tops if info.type == fs.FileType.File and info.size]
    folders = [info.base_name for info in tops if info.type == fs.FileType.Directory]
    schema = "folder string, name string, size bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top in batch.column(0).to_pylist():
                found = list(_listed(f"{path.rstrip('/')}/{top}"))
                for at in range(0, len(found), 10_000):
                    some = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.repeat(path, len(some)), pa.array([f"{top}/{n}" for n, _ in some], pa.string()), pa.array([size for _, size in some], pa.int64())], ["folder", "name", "size"])

    listed = spark.createDataFrame([(f,) for f in folders], "top string").repartition(max(len(folders), 1), "top").mapInArrow(run, schema)
    return listed.union(spark.createDataFrame(plain, schema))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, texts, held = [], [], 0
        for folder, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            files, root = _opened(folder)
            with files.open_input_stream(f"{root}/{name}") as stream:
                texts.append(stream.read().decode("utf-8", "replace"))
            names.append(name)
            held += len(texts[-1])
            if held > READ_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["name", "text"])
                names, texts, held = [], [], 0
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["name", "text"])


def read_named(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of the files below a folder, but empty and hidden ones.

    Small files in great number cost Spark's own reader some milliseconds and a share of a task
    each, and the driver a list of them all; here tasks list them and open them one after another.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return named_files(spark, path).repartition(n, "name").select("folder", "name").mapInArrow(_texts, "name string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for folder, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            files, root = _opened(folder)
            digest = hashlib.md5()
            for part in parts:
                with files.open_input_stream(f"{root}/{part}") as stream:
                    while chunk := stream.read(READ_AT_ONCE):
                        digest.update(chunk)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["name", "digest"])


def named_digests(spark: SparkSession, path: str, name: Column) -> DataFrame:
    """(name, digest): the MD5 of the files that one ``name`` (by their own ``name``) stands for, in the order of their own; files of any size stream through."""
    parts = named_files(spark, path).groupBy(name.alias("of"), "folder").agg(F.array_sort(F.collect_list("name")).alias("parts"))
    rows = parts.select(F.col("of").alias("name"), "folder", "parts")
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").mapInArrow(_digests, "name string, digest string")
