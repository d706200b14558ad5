"""A sink of JSON arrays, one file for each input file and status: <stem>/<status>.json, indented by 2.

Each file is written by one task as its rows come, so its size is bounded by no memory. Tasks write below a temporary folder of
the job; the commit moves the files of the tasks that succeeded to their names and deletes the rest, and an abort deletes all, so a repeated or lost
task leaves nothing behind. The path has to be one that the driver and all executors see. Characters of stems and statuses
that don't belong into a file's name are written as in URLs.
"""

from __future__ import annotations

import datetime
import decimal
import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


def _filesystem(uri: str):
    """(pyarrow file system, path in it)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _plain(x):
    if isinstance(x, (datetime.date, datetime.datetime)):
        return x.isoformat()
    if isinstance(x, decimal.Decimal):
        return str(x)
    if isinstance(x, (bytes, bytearray)):
        return bytes(x).decode("utf-8", "replace")
    raise TypeError(f"no JSON for {type(x).__name__}")


@dataclass
class Written(WriterCommitMessage):
    #: Where each file is, and where it belongs.
    files: list[tuple[str, str]]


class ArrayWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool) -> None:
        self.path, self.stem, self.status = options["path"], options["stem"], options.get("status")
        self.name, self.order = options.get("name", "records"), options["order"]
        self.columns = [c for c in schema.names if c not in (self.stem, self.status, self.order)]
        self.overwrite, self.work = overwrite, f"_temporary-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        fs, base = _filesystem(self.path)
        files, name, out = [], None, None
        try:
            for r in rows:
                to = posixpath.join(quote(str(r[self.stem]), safe=" "), quote(str(r[self.status]) if self.status else self.name, safe=" ") + ".json")
                if to != name:
                    if out:
                        out.write(b"\n]")
                        out.close()
                    name, at = to, posixpath.join(base, self.work, uuid.uuid4().hex)
                    fs.create_dir(posixpath.dirname(at))
                    out = fs.open_output_stream(at)
                    files.append((at, to))
                    between = b"[\n"
                record = {c: v for c, v in r.asDict(recursive=True).items() if c in self.columns}
                out.write(between + json.dumps([record], ensure_ascii=False, indent=2, default=_plain)[2:-2].encode())
                between = b",\n"
            if out:
                out.write(b"\n]")
        finally:
            if out:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = _filesystem(self.path)
        files = [f for m in messages if m for f in m.files]
        if self.overwrite:
            from pyarrow.fs import FileSelector, FileType

            for info in fs.get_file_info(FileSelector(base, allow_not_found=True)):
                if posixpath.basename(info.path) != self.work:
                    (fs.delete_dir if info.type == FileType.Directory else fs.delete_file)(info.path)
        for at, to in files:
            fs.create_dir(posixpath.dirname(posixpath.join(base, to)))
            fs.move(at, posixpath.join(base, to))
        self._clear(fs, base)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_filesystem(self.path))

    def _clear(self, fs, base: str) -> None:
        fs.create_dir(posixpath.join(base, self.work))
        fs.delete_dir(posixpath.join(base, self.work))


class JsonArrays(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_arrays"

    def writer(self, schema: StructType, overwrite: bool) -> ArrayWriter:
        return ArrayWriter(dict(self.options), schema, overwrite)


def write_arrays(df: DataFrame, path: str, stem: str = "src_stem", status: str | None = "quality", order: str = "place", name: str = "records", mode: str = "overwrite") -> None:
    """One array a stem and status (or one of that name a stem), of the columns but these and `order`, which sorts it. mode: overwrite empties the folder, append replaces the files of the stems and statuses that come."""
    df.sparkSession.dataSource.register(JsonArrays)
    by = [stem, *([status] if status else [])]
    out = df.repartition(*by).sortWithinPartitions(*by, order).write.format("json_arrays").mode(mode).option("path", path).option("stem", stem).option("order", order).option("name", name)
    (out.option("status", status) if status else out).save()
