"""Trees of files listed and read by tasks; no list of names passes through the driver.

The folders of the first level are a table; a task lists what is below each of its folders, names and
lengths, and the files are dealt out again to be read.  Stores are opened by ``pyarrow.fs`` from their
URI (local files, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

LISTED = "path_parts array<string>, length long, modified long"
READ_BYTES = 8 << 20
# Folders without names to look for in a listing of modules.
NO_MODULES = ("__pycache__",)


def store(uri: str):
    """(file system, path in it) of a URI or an absolute local path."""
    from pyarrow import fs

    if uri.startswith("file:"):  # file:/x, file:///x
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/").rstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.rstrip("/")
    return fs.FileSystem.from_uri(uri.rstrip("/"))


def _children(files, folder: str) -> list:
    from pyarrow.fs import FileSelector

    return sorted(files.get_file_info(FileSelector(folder, allow_not_found=True)), key=lambda x: x.base_name)


def walk(files, folder: str, patterns: list[str]) -> Iterator:
    """The files below a folder whose path has one component per pattern."""
    first, rest = patterns[0], patterns[1:]
    if not rest and not set("*?[") & set(first):
        found = [files.get_file_info(f"{folder}/{first}")]
    else:
        found = [x for x in _children(files, folder) if fnmatchcase(x.base_name, first)]
    for x in found:
        if not rest and x.is_file:
            yield x
        elif rest and not x.is_file and x.type.name == "Directory":
            yield from walk(files, x.path, rest)


def _rows(infos, levels: int | None, root: str) -> pa.RecordBatch:
    infos = list(infos)
    parts = [x.path[len(root) :].strip("/").split("/") for x in infos]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(parts, pa.list_(pa.string())),
            pa.array([x.size if x.is_file else None for x in infos], pa.int64()),
            pa.array([x.mtime_ns for x in infos], pa.int64()),
        ],
        names=["path_parts", "length", "modified"],
    )


def first_level(spark: SparkSession, root: str) -> DataFrame:
    """``folder``: names of the folders right below the root, listed by a task."""

    def run(batches):
        files, base = store(root)
        for batch in batches:
            for _ in range(batch.num_rows):
                names = [x.base_name for x in _children(files, base) if not x.is_file]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], names=["folder"])

    return spark.range(1, numPartitions=1).mapInArrow(run, "folder string")


def list_files(spark: SparkSession, root: str, depth_glob: str) -> DataFrame:
    """``path_parts``, ``length`` and ``modified`` (ns) of every file at ``root/depth_glob``; one task per run of folders.

    No match, or no such root, gives an empty table.  Names with a leading ``_`` or ``.`` are listed too.
    """
    patterns = depth_glob.split("/")
    if len(patterns) < 2:
        raise ValueError("the pattern needs a folder and a file")

    def run(batches):
        files, base = store(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                if fnmatchcase(folder, patterns[0]):
                    yield _rows(walk(files, f"{base}/{folder}", patterns[1:]), len(patterns), base)

    return _dealt(first_level(spark, root)).mapInArrow(run, LISTED)


def list_tree(spark: SparkSession, root: str) -> DataFrame:
    """Every file and folder below the root, at any depth; ``length`` is null for a folder."""

    def run(batches):
        from pyarrow.fs import FileSelector

        files, base = store(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                below = files.get_file_info(FileSelector(f"{base}/{folder}", recursive=True, allow_not_found=True))
                yield _rows([files.get_file_info(f"{base}/{folder}"), *below], None, base)

    return _dealt(first_level(spark, root)).mapInArrow(run, LISTED)


def _dealt(df: DataFrame) -> DataFrame:
    """Names dealt out evenly, so that a folder or a group of many files is no task's alone."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 1))


def read_files(spark: SparkSession, root: str, listed: DataFrame) -> DataFrame:
    """``path_parts`` and ``content`` (bytes) of listed files.  A file without bytes is not opened."""

    def run(batches):
        files, base = store(root)
        for batch in batches:
            paths, texts, held = [], [], 0
            for parts, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                content = b""
                if length:
                    with files.open_input_stream("/".join([base, *parts])) as f:
                        content = f.read()
                paths.append(parts)
                texts.append(content)
                held += len(content)
                if held > READ_BYTES:
                    yield _contents(paths, texts)
                    paths, texts, held = [], [], 0
            yield _contents(paths, texts)

    rows = _dealt(listed.filter("length is not null").select("path_parts", "length"))
    return rows.mapInArrow(run, "path_parts array<string>, content binary")


def _contents(paths, texts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(paths, pa.list_(pa.string())), pa.array(texts, pa.binary())], names=["path_parts", "content"]
    )


def write_files(df: DataFrame, root: str, path_parts: str, content: str) -> None:
    """Write one file per row below the root.  A task that runs again writes the same bytes again."""

    def run(batches):
        files, base = store(root)
        for batch in batches:
            for parts, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                files.create_dir("/".join([base, *parts[:-1]]), recursive=True)
                with files.open_output_stream("/".join([base, *parts])) as f:
                    f.write(text or b"")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = df.select(F.col(path_parts), F.col(content).cast("binary"))
    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


# --- listings to check targets against -----------------------------------------------------------


def top_level_names(source: bytes) -> set[str]:
    """Names that a module's statements bind at top level, also inside ``if``, ``try``, ``with`` and loops.

    Nothing is executed.  A star import binds names unknown; a source that is no Python raises.
    """
    import ast

    names = set()

    def bind(target):
        for node in ast.walk(target):
            if isinstance(node, ast.Name) and isinstance(node.ctx, ast.Store):
                names.add(node.id)

    def visit(body):
        for node in body:
            if isinstance(node, ast.FunctionDef | ast.AsyncFunctionDef | ast.ClassDef):
                names.add(node.name)
                continue
            if isinstance(node, ast.Import | ast.ImportFrom):
                names.update((a.asname or a.name.split(".")[0]) for a in node.names if a.name != "*")
                continue
            if isinstance(node, ast.Assign | ast.AnnAssign | ast.AugAssign | ast.Expr):
                if not (isinstance(node, ast.AnnAssign) and node.value is None):
                    bind(node)
                continue
            if isinstance(node, ast.Delete):
                names.difference_update(x.id for x in node.targets if isinstance(x, ast.Name))
                continue
            for part in (getattr(node, "target", None), getattr(node, "test", None), getattr(node, "iter", None)):
                if part is not None:
                    bind(part)
            for item in getattr(node, "items", ()):
                if item.optional_vars is not None:
                    bind(item.optional_vars)
            for block in ("body", "orelse", "finalbody"):
                visit(getattr(node, block, ()))
            for handler in (*getattr(node, "handlers", ()), *getattr(node, "cases", ())):
                if getattr(handler, "pattern", None) is not None:
                    names.update(x.name for x in ast.walk(handler.pattern) if getattr(x, "name", None))
                visit(handler.body)

    visit(ast.parse(source).body)
    return names


def module_listing(spark: SparkSession, root: str, package: str = "apps", listed: DataFrame | None = None) -> DataFrame:
    """``module``, ``attr`` and ``error``: what the Python sources below the root bind at top level.

    ``root`` is the folder of ``package``.  A module that binds nothing or is no Python has one row without
    ``attr``; ``error`` says why it cannot be read.  ``listed`` is an earlier ``list_tree``.
    """
    listed = list_tree(spark, root) if listed is None else listed
    sources = listed.filter(F.element_at("path_parts", -1).endswith(".py") & ~F.arrays_overlap("path_parts", F.array(*map(F.lit, NO_MODULES))))

    def run(batches):
        for batch in batches:
            modules, attrs, errors = [], [], []
            for parts, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = [package, *parts[:-1], parts[-1].removesuffix(".py")]
                module, error = ".".join(parts[:-1] if parts[-1] == "__init__" else parts), None
                try:
                    found = sorted(top_level_names(content)) or [None]
                except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
                    found, error = [None], type(e).__name__
                modules += [module] * len(found)
                attrs += found
                errors += [error] * len(found)
            columns = [pa.array(x, pa.string()) for x in (modules, attrs, errors)]
            yield pa.RecordBatch.from_arrays(columns, names=["module", "attr", "error"])

    return read_files(spark, root, sources).mapInArrow(run, "module string, attr string, error string")


def static_listing(spark: SparkSession, root: str, listed: DataFrame | None = None) -> DataFrame:
    """``static_path``: the folders below the root, relative to it."""
    listed = list_tree(spark, root) if listed is None else listed
    return listed.filter("length is null").select(F.array_join("path_parts", "/").alias("static_path"))


# --- the same tree as a stream ---------------------------------------------------------------------


def utf8(content: Column) -> Column:
    """Bytes as text; null when they are not UTF-8, so that one file cannot stop the job."""
    return F.try_validate_utf8(content.cast("string"))


class Folders(InputPartition):
    def __init__(self, names: list[str], start: int, end: int):
        self.names, self.start, self.end = names, start, end


class TreeStream(DataSourceStreamReader):
    """Files by the time they were last written: a batch has those after its start, up to its end.

    An offset is a time, so what is kept does not grow with the tree.  The driver lists the folders of the
    first level only, to deal them out; tasks list what is below.  ``lag`` seconds are left before now, for
    clocks that differ and writes that are not done.  A file that arrives with an older time is not seen.
    """

    FOLDERS = 64

    def __init__(self, options):
        self.root, self.patterns = options["path"], options["glob"].split("/")
        self.lag = int(float(options.get("lag", "0")) * 1e9)

    def initialOffset(self) -> dict:
        return {"modified": 0}

    def latestOffset(self) -> dict:
        import time

        return {"modified": time.time_ns() - self.lag}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        files, base = store(self.root)
        names = [x.base_name for x in _children(files, base) if not x.is_file and fnmatchcase(x.base_name, self.patterns[0])]
        low, high = start["modified"], end["modified"]
        return [Folders(names[i : i + self.FOLDERS], low, high) for i in range(0, len(names), self.FOLDERS)]

    def read(self, partition: Folders):
        files, base = store(self.root)
        for name in partition.names:
            for x in walk(files, f"{base}/{name}", self.patterns[1:]):
                if partition.start < x.mtime_ns <= partition.end:
                    content = b""
                    if x.size:
                        with files.open_input_stream(x.path) as f:
                            content = f.read()
                    yield x.path[len(base) :].strip("/").split("/"), content

    def commit(self, end: dict) -> None:
        pass


class TreeSource(DataSource):
    """``spark.readStream.format("file_tree").option("glob", "*/*/name").load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def schema(self) -> str:
        return "path_parts array<string>, content binary"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TreeStream(self.options)


def stream_files(spark: SparkSession, root: str, depth_glob: str, lag: float = 0) -> DataFrame:
    """``path_parts`` and ``content`` of the files at ``root/depth_glob`` as they arrive, those without bytes too."""
    spark.dataSource.register(TreeSource)
    reader = spark.readStream.format(TreeSource.name()).option("glob", depth_glob).option("lag", str(lag))
    return reader.load(root)
