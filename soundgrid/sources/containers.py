"""Members of archives as rows, from Spark's ``binaryFile`` reader: one archive is opened by one task."""

from __future__ import annotations

import fnmatch
import gzip
import io
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundgrid.shipping import mapped
from soundgrid.sources.registry import kind_sniff

SCHEMA = "path string, member string, crc long, size long, content binary, problem string"


def opened(kind: str, data: bytes, path: str) -> Iterator[tuple[str, bytes]]:
    """Names and contents of an archive's files; a bare file is its own member."""
    if kind == "zip":
        with zipfile.ZipFile(io.BytesIO(data)) as archive:
            yield from ((m.filename, archive.read(m)) for m in archive.infolist() if not m.is_dir())
    elif kind == "gzip":
        raw = gzip.decompress(data)
        try:
            with tarfile.open(fileobj=io.BytesIO(raw)) as archive:
                yield from ((m.name, archive.extractfile(m).read()) for m in archive if m.isfile())
        except tarfile.ReadError:
            yield path.rsplit("/", 1)[-1].removesuffix(".gz"), raw
    else:
        yield path.rsplit("/", 1)[-1], data


def members(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """A row for each member whose name matches: ``path, member, crc, size, content``. An archive that can't be read is a row with its ``problem``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = found.select("path", kind_sniff(F.col("content")).alias("kind"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    rows += [(p, name, zlib.crc32(body), len(body), body, None) for name, body in opened(kind, data, p) if fnmatch.fnmatch(name.lower(), glob.lower())]
                except (zipfile.BadZipFile, OSError, EOFError, zlib.error, tarfile.TarError) as wrong:
                    rows.append((p, None, None, None, None, str(wrong)))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "member", "crc", "size", "content", "problem"])

    return mapped(found, run, SCHEMA)


def checked(rows: DataFrame, expect: int | None = None) -> DataFrame:
    """Archives to refuse: unreadable, with no member, or with another number than expected; ``path, members, problem``."""
    per = rows.groupBy("path").agg(F.count("member").alias("members"), F.max("problem").alias("problem"))
    wrong = (F.col("members") == 0) if expect is None else (F.col("members") != expect)
    return per.filter(F.col("problem").isNotNull() | wrong)
