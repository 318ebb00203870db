"""Large files as a batch data source: a partition streams its file in chunks of 1 MiB, so that no file is ever one cell.

`digests` gives length, SHA-256 and magic bytes of each file, `chunks` its content in numbered chunks. A read that fails with an I/O error begins anew after
1, 2, 4 ... times `wait` seconds; a file that still fails, or has more than `most` bytes, is a row with an error, not a failed job. Addresses are
what Arrow's file systems open (local paths, file:, s3:, gs:, hdfs:, abfs:) and http(s). A folder stands for all files below it.
"""

from __future__ import annotations

import hashlib
import os
import time
import urllib.request
from collections.abc import Callable, Iterator
from contextlib import closing
from typing import Any

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

CHUNK = 1 << 20
DIGESTS = "file string, bytes long, modified timestamp, sha256 string, magic_ok boolean, error string"
CHUNKS = "file string, chunk long, content binary"
NAMES = "file string, bytes long"


def is_web(path: str) -> bool:
    return path.startswith(("http://", "https://"))


def opened(path: str):
    """A stream of bytes; close it after use."""
    if is_web(path):
        return urllib.request.urlopen(path, timeout=90)  # noqa: S310  the caller names the address
    system, inner = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    return system.open_input_stream(inner)


def listed(path: str) -> list[tuple[str, Any, int | None]]:
    """Files below a path, or the file itself, with the time of their last change and their length. Local ones are named as Spark does, `file:/...`."""
    if is_web(path):
        return [(path, None, None)]
    local = ":" not in path.split("/")[0]
    system, inner = (fs.LocalFileSystem(), os.path.abspath(path)) if local else fs.FileSystem.from_uri(path)
    one = system.get_file_info(inner)
    found = [one] if one.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
    head = "file:" if isinstance(system, fs.LocalFileSystem) else path.removesuffix(inner)
    return sorted((head + x.path, x.mtime, x.size) for x in found if x.type == fs.FileType.File and not x.base_name.startswith((".", "_")))


def streamed(path: str, chunk: int, open_: Callable = opened) -> Iterator[bytes]:
    with closing(open_(path)) as stream:
        while body := stream.read(chunk):
            yield bytes(body)


def digest(path: str, chunk: int = CHUNK, most: int | None = None, magic: bytes = b"", attempts: int = 4, wait: float = 1, open_: Callable = opened, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """(bytes, sha256, magic_ok, error) of a file that is read once, in chunks."""
    for n in range(attempts):
        size, sha, head = 0, hashlib.sha256(), b""
        try:
            for body in streamed(path, chunk, open_):
                size += len(body)
                if most is not None and size > most:
                    return size, None, None, f"more than {most} bytes"
                head += body[: max(len(magic) - len(head), 0)]
                sha.update(body)
            return size, sha.hexdigest(), head == magic, None
        except OSError as e:
            if n + 1 == attempts:
                return None, None, None, f"{type(e).__name__}: {e}"[:500]
            sleep(wait * 2**n)
    raise ValueError("no attempts")


class FilePartition(InputPartition):
    def __init__(self, path: str, modified: Any, size: int | None):
        self.path, self.modified, self.size = path, modified, size


class FileReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[FilePartition]:
        return [FilePartition(*x) for x in listed(self.options["path"])] or [FilePartition("", None, None)]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        if not partition.path:
            return
        if self.options.get("kind") == "names":
            yield partition.path, partition.size
            return
        o, chunk = self.options, int(self.options.get("chunk", CHUNK))
        if o.get("kind") == "chunks":
            for n, body in enumerate(streamed(partition.path, chunk)):
                yield partition.path, n, body
            return
        most = int(o["most"]) if "most" in o else None
        size, sha, magic_ok, error = digest(partition.path, chunk, most, bytes.fromhex(o.get("magic", "")), int(o.get("attempts", 4)), float(o.get("wait", 1)))
        yield partition.path, size, partition.modified, sha, magic_ok, error


class StreamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "streamed_files"

    def schema(self) -> str:
        return {"chunks": CHUNKS, "names": NAMES}.get(self.options.get("kind"), DIGESTS)

    def reader(self, schema) -> FileReader:
        return FileReader(self.options)


def _load(spark: SparkSession, **options) -> DataFrame:
    ship(spark)
    spark.dataSource.register(StreamedFiles)
    return spark.read.format("streamed_files").options(**{k: str(v) for k, v in options.items() if v is not None}).load()


def digests(spark: SparkSession, path: str, magic: bytes = b"", most: int | None = None, attempts: int = 4, wait: float = 1, chunk: int = CHUNK) -> DataFrame:
    """DIGESTS of every file below a path."""
    return _load(spark, path=path, magic=magic.hex(), most=most, attempts=attempts, wait=wait, chunk=chunk)


def chunks(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """CHUNKS of every file below a path, in any order."""
    return _load(spark, path=path, kind="chunks", chunk=chunk)


def names(spark: SparkSession, path: str) -> DataFrame:
    """NAMES of every file below a path, empty ones too, which Spark's own readers leave out."""
    return _load(spark, path=path, kind="names")
