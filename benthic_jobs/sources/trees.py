"""Trees of very many files: listed, read and written by tasks, so that the driver holds no file names.

A tree is listed level by level: the folders of a level are rows, dealt to tasks by a hash of their path, and each is listed
once, in frames. The driver knows how many folders a level has, and nothing else. Files are dealt anew by their path before they
are read, so one folder with most of the files is no hot task. A file is read whole by one task.

Paths are relative to the root, with ``/`` between names, so that names with blanks or percent signs need no quoting. Names that
begin with ``.`` or ``_`` are not listed, as in Spark's own readers; links are followed. An empty root gives no rows, a
root that isn't there is an error. What can't be listed or read for good (no permission, gone since, no UTF-8) is a row with a
``problem``; any other error fails the task, which is tried again.
"""

from __future__ import annotations

import errno
import os
from collections.abc import Callable, Iterator
from fnmatch import translate
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stored

ENTRY = "path string, name string, is_folder boolean, size long, modified timestamp, problem string"
#: Folders that a task lists at most, files and bytes that a task reads, about; a larger file stands alone.
FOLDERS, FILES, BYTES = 500, 1_000, 64_000_000
#: Entries of a folder that are handed on at a time.
ENTRIES = 10_000
#: Tasks for each core that list folders, few as they may be, and that write files.
SHARE = 4
#: Bytes of text that are handed on at a time.
FRAME = 8_000_000


def entries(spark: SparkSession, root: str) -> DataFrame:
    """All files and folders under ``root`` as ``ENTRY`` rows."""
    level = stored(_listed(spark.createDataFrame([("",)], "path string"), root, must=True), "tree")
    every = level
    while folders := level.where("is_folder AND problem IS NULL").count():
        below = _dealt(level.where("is_folder AND problem IS NULL").select("path"), -(-folders // FOLDERS))
        level = stored(_listed(below, root), "tree")
        every = every.unionByName(level)
    return every


def files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """The files whose name fits ``glob``, with the folders that can't be listed as rows with a problem."""
    fits = ~F.col("is_folder") & F.col("name").rlike(f"^{translate(glob)}")
    return entries(spark, root).where(fits | F.col("problem").isNotNull())


def _listed(folders: DataFrame, root: str, *, must: bool = False) -> DataFrame:
    """What stands in each of the folders; a folder that can't be listed comes again, with a problem."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for path in batch["path"]:
                try:
                    for infos in _found(store, f"{base.rstrip('/')}/{path}" if path else base):
                        rows = []
                        for i in infos:
                            if not i.base_name.startswith((".", "_")):
                                folder = i.type == fs.FileType.Directory
                                rows.append((f"{path}/{i.base_name}".lstrip("/"), i.base_name, folder, None if folder else i.size, i.mtime, None))
                        if rows:
                            yield _frame(rows)
                except (FileNotFoundError, NotADirectoryError, PermissionError) as e:
                    if must:
                        raise
                    yield _frame([(path, path.rsplit("/", 1)[-1], True, None, None, type(e).__name__)])

    def _frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["path", "name", "is_folder", "size", "modified", "problem"])
        return out.assign(size=out["size"].astype("Int64"), modified=pd.to_datetime(out["modified"], utc=True))

    return folders.select("path").mapInPandas(run, ENTRY)


def _found(store, folder: str, size: int = ENTRIES) -> Iterator[list]:
    """What stands in a folder, so many entries at a time. A folder of a file system is read as it goes on; other stores answer at once."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as names:
            while some := [e.path for e in islice(names, size)]:
                yield [i for i in store.get_file_info(some) if i.type != fs.FileType.NotFound]
    else:
        infos = store.get_file_info(fs.FileSelector(folder))
        for at in range(0, len(infos), size):
            yield infos[at : at + size]


def texts(listing: DataFrame, root: str) -> DataFrame:
    """(path, text, problem) for each row of a listing (path, size, problem); rows with a problem keep it."""
    n, size = listing.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        columns = ["path", "text", "problem"]
        for batch in batches:
            rows, held = [], 0
            for path, problem in zip(batch["path"], batch["problem"]):
                text = None
                if problem is None:
                    try:
                        with store.open_input_stream(f"{base.rstrip('/')}/{path}") as f:
                            text = f.read().decode()
                    except (FileNotFoundError, PermissionError, UnicodeDecodeError) as e:
                        problem = type(e).__name__
                rows.append((path, text, problem))
                held += len(text or "")
                if held > FRAME:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    dealt = listing.select("path", "problem").repartition(max(1, -(-n // FILES), size // BYTES), "path")
    return dealt.mapInPandas(run, "path string, text string, problem string")


def _dealt(rows: DataFrame, least: int = 1) -> DataFrame:
    """Rows by a hash of their path to some tasks for each core: short rows of few input files are much work."""
    return rows.repartition(max(least, SHARE * rows.sparkSession.sparkContext.defaultParallelism), "path")


def write_texts(rows: DataFrame, root: str) -> int:
    """Each row (path, text) as a file under ``root``; a null text is empty. Returns the number of files.

    A path should stand in one row. A task that is tried again writes the same files with the same contents.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()
        for batch in batches:
            for path, text in zip(batch["path"], batch["text"]):
                at = f"{base.rstrip('/')}/{path}"
                folder = at.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                with store.open_output_stream(at) as f:
                    f.write((text or "").encode())
            yield pd.DataFrame({"n": [len(batch)]})

    return _dealt(rows.select("path", "text")).mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_empty(paths: DataFrame, root: str) -> int:
    """Each row (path) as an empty file under ``root``, to be listed and not to be written to. Returns the number of rows.

    A file system holds a fixed number of files, but more names: there, most paths are further names (hard links) of a file of
    another row. A path that is there already has to be empty, as after a task that is tried again.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        put = _linked() if isinstance(store, fs.LocalFileSystem) else lambda at: store.open_output_stream(at).close()
        made: set[str] = set()
        for batch in batches:
            for path in batch["path"]:
                at = f"{base.rstrip('/')}/{path}"
                folder = at.rsplit("/", 1)[0]
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                put(at)
            yield pd.DataFrame({"n": [len(batch)]})

    return _dealt(paths.select("path")).mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _linked() -> Callable[[str], None]:
    """Puts an empty file at a path: a link to the last one that is a file of its own, or such a one if that takes no link (more)."""
    file = None

    def put(at: str) -> None:
        nonlocal file
        try:
            try:
                if file:
                    return os.link(file, at)
            except OSError as e:
                if e.errno not in (errno.EMLINK, errno.EPERM, errno.ENOTSUP, errno.ENOSYS):
                    raise
            open(at, "x").close()
            file = at
        except FileExistsError:
            if os.path.getsize(at):
                raise

    return put
