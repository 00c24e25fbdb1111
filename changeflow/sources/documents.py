"""Text files under a root, found by glob, as rows."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions.text import normalise_newlines
from changeflow.session import path_exists, qualified

# Disjoint prefixes keep the three families of artefacts apart.
REPORT_GLOBS = ["triage/**/*.md"]
CONCLUSION_GLOBS = ["conclusions/**/*.md"]
CONFIRMATION_GLOBS = ["confirmations/**/*.md"]


def glob_pattern(glob: str) -> str:
    """A path glob as an anchored regular expression. `**/` spans folders.

    Like the shell, a wildcard does not match a leading dot.
    """
    visible = r"(?!\.)"
    out = []
    for part in re.findall(r"\*\*/|\*+|\?|[^*?]+", glob.strip()):
        if part == "**/":
            out.append(rf"(?:{visible}[^/]+/)*")
        elif part.startswith("*"):
            out.append((visible if not out or out[-1].endswith(("/", "/)*")) else "") + "[^/]*")
        elif part == "?":
            out.append("[^/]")
        else:
            out.append(re.escape(part))
    return "^" + "".join(out) + "$"


def _folders(globs: list[str]) -> list[str]:
    """The folders below which the globs can match, none inside another."""
    fixed = []
    for glob in globs:
        parts = glob.strip().split("/")[:-1]
        wild = next((i for i, p in enumerate(parts) if set(p) & set("*?")), len(parts))
        fixed.append("/".join(parts[:wild]))
    return [f for f in sorted(set(fixed)) if not any(f != g and (g == "" or f.startswith(g + "/")) for g in fixed)]


# Names that Spark's readers do not list.
HIDDEN = re.compile(r"(?!_metadata|_common_metadata)(?:\.|_(?!.*=)|.*\._COPYING_$)", re.DOTALL)
# What a task reads on average. It gets them in pieces of one folder, of up to so many files and, but for a larger one, bytes.
FILES_A_READ, BYTES_A_READ = 1000, 8 << 20
FILES_A_PIECE, BYTES_A_PIECE = 250, 2 << 20


def scan_texts(spark: SparkSession, root: str, globs: list[str]) -> DataFrame:
    """`path` (relative to the root), `content`, `readable` of matching files.

    Only folders and file names the globs can match are read. One scan serves
    all globs, so a file matched twice still yields one row. Bytes that are not
    UTF-8 leave `readable` false and `content` null: such files are set aside,
    never decoded with replacement characters.
    """
    base = qualified(spark, root)
    folders = [f"{base}/{f}".rstrip("/") for f in _folders(globs)]
    folders = [f for f in folders if path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], "path string, content string, readable boolean")
    read = _read_by_tasks if _known_to_arrow(base) else _read_by_spark
    text = F.col("content").cast("string")
    readable = F.is_valid_utf8(text)
    return read(spark, base, folders, globs).select(
        "path",
        F.when(readable, normalise_newlines(text)).alias("content"),
        readable.alias("readable"),
    )


def _read_by_spark(spark: SparkSession, base: str, folders: list[str], globs: list[str]) -> DataFrame:
    """`path, content` by Spark's own reader: it knows every store, but the driver holds and deals all files."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    names = {g.strip().rsplit("/", 1)[-1] for g in globs}
    if len(names) == 1:
        reader = reader.option("pathGlobFilter", names.pop())
    files = reader.load(folders).withColumn("path", F.expr(f"substring(path, {len(base) + 2})"))
    matches = functools.reduce(operator.or_, [F.col("path").rlike(glob_pattern(g)) for g in globs])
    return files.filter(matches).select("path", "content")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a qualified path, and the path in it."""
    if uri.startswith("file:/"):  # not encoded, so no URI to Arrow
        return fs.LocalFileSystem(), uri.removeprefix("file:").rstrip("/")
    store, path = fs.FileSystem.from_uri(uri)
    return store, path.rstrip("/")


def _known_to_arrow(uri: str) -> bool:
    try:
        store, path = _store(uri)
        return store.get_file_info(path).type == fs.FileType.Directory
    except (OSError, ValueError, ImportError):
        return False


def _listed(store: fs.FileSystem, top: str, folder: str, globs: list[str]) -> tuple[list[str], list[tuple[str, int]]]:
    """What lies directly in a folder: its folders, and its matching files (relative to the root) with their bytes.

    As Spark's readers do, this leaves out hidden names and empty files.
    """
    shown = [f for f in store.get_file_info(fs.FileSelector(folder)) if not HIDDEN.match(f.base_name)]
    inner = [f.path for f in shown if f.type == fs.FileType.Directory]
    matches = re.compile("|".join(glob_pattern(g) for g in globs)).search
    filled = [f for f in shown if f.type == fs.FileType.File and f.size and (f.base_name[0] != "_" or "=" in f.base_name)]
    files = [(f.path[len(top) + 1 :], f.size) for f in filled]
    return sorted(inner), sorted((path, size) for path, size in files if matches(path))


def _pieces(files: list[tuple[str, int]]) -> Iterator[list[str]]:
    paths, total = [], 0
    for path, size in files:
        if paths and (len(paths) == FILES_A_PIECE or total + size > BYTES_A_PIECE):
            yield paths
            paths, total = [], 0
        paths.append(path)
        total += size
    if paths:
        yield paths


def _read_by_tasks(spark: SparkSession, base: str, folders: list[str], globs: list[str]) -> DataFrame:
    """`path, content`, listed and read by tasks. The driver sees folders, and counts of files and bytes.

    Spark's own reader holds every file in the driver and, counting 4 MB for opening one, gives a task a few small files
    only. Here folders are listed a level at a time, then once more for the paths, which are dealt in pieces of one folder.
    """
    store, top = _store(base)

    def frame(some: list[str]) -> DataFrame:
        return spark.createDataFrame([(f,) for f in some], "folder string").coalesce(-(-len(some) // 16))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                inner, files = _listed(store, top, folder, globs)
                more = [None] * len(inner)
                count, total = pa.array([len(files), *more], pa.int64()), pa.array([sum(n for _, n in files), *more], pa.int64())
                yield pa.record_batch({"folder": pa.array([folder, *inner]), "files": count, "bytes": total})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for n, paths in enumerate(_pieces(_listed(store, top, folder, globs)[1])):
                    yield pa.record_batch({"folder": [folder], "piece": [n], "paths": [paths]})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for paths in batch.column("paths").to_pylist():
                texts = []
                for path in paths:
                    with store.open_input_file(f"{top}/{path}") as file:
                        texts.append(file.read())
                yield pa.record_batch({"path": paths, "content": texts})

    level, holding, count, total = [_store(f)[1] for f in folders], [], 0, 0
    while level:
        rows = frame(level).mapInArrow(look, "folder string, files bigint, bytes bigint").collect()
        level = [r["folder"] for r in rows if r["files"] is None]
        holding += [r["folder"] for r in rows if r["files"]]
        count += sum(r["files"] or 0 for r in rows)
        total += sum(r["bytes"] or 0 for r in rows)
    if not holding:
        return spark.createDataFrame([], "path string, content binary")
    dealt = frame(sorted(holding)).mapInArrow(cut, "folder string, piece bigint, paths array<string>")
    tasks = max(-(-count // FILES_A_READ), -(-total // BYTES_A_READ), min(count, spark.sparkContext.defaultParallelism))
    return dealt.repartition(tasks, "folder", "piece").mapInArrow(read, "path string, content binary")


# Files that one task writes, into a folder of its own: bounds both a task and a listing.
FILES_A_TASK = 1000
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
DROP_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_texts(rows: DataFrame, folder: str, name: str, value: str) -> None:
    """One file per name, `<folder>/<task>/name=<name, URL-encoded>.txt`, with a line per row.

    Spark's own writer makes a folder, a file and a checksum for each and, without native Hadoop libraries, starts a
    process for every one of them. Here a task opens its files itself, so they cost it no more than their bytes; rows
    are dealt by name, as many tasks as the files need. A task that is run again replaces its own files. The shuffled
    copy of the texts goes once the files are there, not when the driver happens to collect its garbage.
    """
    tasks = max(1, -(-rows.count() // FILES_A_TASK))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        own = f"{base}/{TaskContext.get().partitionId():07d}"
        store.create_dir(own, recursive=True)
        last, out, n = None, None, 0
        for batch in batches:
            for called, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None or called != last:
                    if out is not None:
                        out.close()
                    last, n = called, n + 1
                    out = store.open_output_stream(f"{own}/name={quote(called or NO_NAME, safe='')}.txt")
                out.write((line.as_py() or b"") + b"\n")
        if out is not None:
            out.close()
        yield pa.record_batch({"files": pa.array([n], pa.int64())})

    lines = rows.select(F.col(name).alias("name"), F.col(value).cast("binary").alias("line"))
    dealt = lines.repartition(tasks, "name").sortWithinPartitions("name")
    conf = rows.sparkSession.conf
    before = conf.get(DROP_SHUFFLE, None)
    conf.set(DROP_SHUFFLE, "true")
    try:
        dealt.mapInArrow(write, "files bigint").agg(F.sum("files")).first()
    finally:
        conf.set(DROP_SHUFFLE, before) if before else conf.unset(DROP_SHUFFLE)


def unreadable(scan: DataFrame) -> DataFrame:
    return scan.filter(~F.col("readable")).select("path", F.lit("not UTF-8").alias("skip_reason"))
