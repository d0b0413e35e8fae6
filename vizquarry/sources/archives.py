"""Packaged workbooks: open each archive on an executor, one row out per file."""

from __future__ import annotations

import io
import lzma
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vizquarry import fixed

SCANNED = (
    "path string, member string, n_workbook_members int, xml binary, extracts array<string>, error string"
)
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("member", pa.string()),
        ("n_workbook_members", pa.int32()),
        ("xml", pa.binary()),
        ("extracts", pa.list_(pa.string())),
        ("error", pa.string()),
    ]
)
#: Rows and bytes of workbooks that leave a task together.
_BATCH_ROWS, _BATCH_BYTES = 1024, 1 << 20
_DAMAGE = (
    zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, lzma.LZMAError, struct.error,
    EOFError, KeyError, OSError, RuntimeError, ValueError,
)


def _open(path: str, handle) -> dict:
    """One row for a workbook file; of an archive, only its directory and the workbook member are read.

    ``handle`` gives a seekable file when called, and may raise; whatever is wrong with a file becomes its error.
    """
    row = dict.fromkeys(_ARROW.names)
    row.update(path=path, n_workbook_members=0, extracts=[])
    try:
        if path.lower().endswith(fixed.WORKBOOK_SUFFIX):
            with handle() as file:
                row.update(member=path.rsplit("/", 1)[-1], n_workbook_members=1, xml=file.read())
            return row
        with handle() as file, zipfile.ZipFile(file) as archive:
            names = archive.namelist()
            books = [n for n in names if n.lower().endswith(fixed.WORKBOOK_SUFFIX)]
            row["extracts"] = [n for n in names if n.lower().endswith(fixed.EXTRACT_SUFFIX)]
            row["n_workbook_members"] = len(books)
            if books:
                row.update(member=books[0], xml=archive.read(books[0]))
            else:
                row["error"] = f"no {fixed.WORKBOOK_SUFFIX} member in the archive"
    except _DAMAGE as why:
        row["error"] = f"{type(why).__name__}: {why}"
    return row


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of few bytes: a task holds small workbooks together and a large one alone."""
    held: list[dict] = []
    size = 0
    for row in rows:
        more = len(row["xml"] or b"")
        if held and (len(held) == _BATCH_ROWS or size + more > _BATCH_BYTES):
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held, size = [], 0
        held.append(row)
        size += more
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def _open_batches(batches):
    for batch in batches:
        paths, contents = batch.column("path"), batch.column("content")
        yield from _batches(
            _open(paths[i].as_py(), lambda content=contents[i]: io.BytesIO(content.as_py())) for i in range(batch.num_rows)
        )


def _handle(path: str):
    """A seekable file of any store pyarrow reaches; paths as Spark's file source gives them."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file:///") else path)
    return store.open_input_file(place)


def _open_paths(batches):
    for batch in batches:
        yield from _batches(_open(path, lambda path=path: _handle(path)) for path in batch.column("path").to_pylist())


def scan_archives(files: DataFrame) -> DataFrame:
    """(path, content) to one row per file; a damaged file gives a row with ``error`` set."""
    return files.select("path", "content").mapInArrow(_open_batches, SCANNED)


def read_corpus(spark: SparkSession, location: str) -> DataFrame:
    """Scan every ``.twb`` / ``.twbx`` below ``location``, however large.

    Spark only lists the files. Each is opened on an executor through a seekable handle, so a packaged workbook
    costs its directory and its workbook member; the extracts that make it large are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[tT][wW][bB]*")
        .load(location)
    )
    return files.select("path").mapInArrow(_open_paths, SCANNED)


def without_extract(corpus: DataFrame) -> DataFrame:
    """Workbooks that carry no extract: they read a live connection and hold no rows of their own."""
    return corpus.where(F.col("error").isNull() & (F.size("extracts") == 0))


def tables_of(extract_tables: DataFrame, catalog: str, schema: str, workbooks: DataFrame) -> DataFrame:
    """Sorted distinct full table names per workbook, with a stated fallback where there is none.

    ``extract_tables`` holds (workbook_id, table_name); names are sanitized as the ingest does.
    """
    from vizquarry.functions.names import sanitize

    quoted = F.format_string(f"`{catalog}`.`{schema}`.`%s`", sanitize("table_name"))
    listed = (
        extract_tables.select("workbook_id", quoted.alias("table_path"))
        .distinct()
        .groupBy("workbook_id")
        .agg(F.array_sort(F.collect_list("table_path")).alias("paths"))
    )
    fallback = F.array(F.lit(fixed.NO_TABLE_PATHS % (catalog, schema)))
    return workbooks.select("workbook_id").join(listed, "workbook_id", "left").select(
        "workbook_id", F.coalesce("paths", fallback).alias("table_paths")
    )
