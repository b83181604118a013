"""WARC archives: write pages with Spark's text writer, read them with a Python data source.

A record ends with two line breaks, which is what the text writer puts after each row: a row is a
whole record, and any file system Spark writes to will do. The reader plans one partition per
file. Filters on record type and header fields are pushed into it; it parses the headers of a record
first, and seeks past the payload of records that do not pass, or if no payload is asked for.

Equal payloads of ``MIN_REVISIT`` bytes or more are stored once: the page with the largest id has the
response, the others are ``revisit`` records that name it.

Defined results: null html is an empty payload; a page without id is written as a response and never
referred to; URLs are stored with line breaks and controls removed, null as an empty value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
)

from kinfold.session import materialize

MIN_REVISIT = 1000
SALTS = 16  # tasks a common digest is dealt to
_ID = "urn:page:"
_COLUMNS = {  # column -> header field
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "payload_bytes": "X-Payload-Length",
}
_SCHEMA = ", ".join(f"{c} string" for c in _COLUMNS) + ", payload binary"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``page_id, url, payload, digest, size, refers_to`` (null: a response) of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
    groups = (
        base.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept_id"), F.count("*").alias("n"))
        .where("n > 1")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    groups = materialize(groups, "payloads").select("digest", "kept_id", salts)
    salted = base.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    other = F.col("page_id") != F.col("kept_id")
    return salted.join(groups, ["digest", "salt"], "left").select(
        *base.columns, F.when(other, F.col("kept_id")).alias("refers_to")
    )


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``with_revisits`` rows as WARC 1.1 records, one file per task."""
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x1f\x7f]", "")
    block = F.when(F.col("refers_to").isNull(), F.col("payload").cast("string")).otherwise("")
    kind = F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")
    fields = (
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.concat(F.lit(f"<{_ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        ("WARC-Refers-To", F.concat(F.lit(f"<{_ID}"), F.col("refers_to"), F.lit(">"))),
        ("WARC-Target-URI", clean),
        ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        ("X-Payload-Length", F.col("size").cast("string")),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    record = F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit("\r\n\r\n"), block)
    pages.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class WarcReader(DataSourceReader):
    """One partition per file below ``path``; see ``read_warc``."""

    def __init__(self, options: dict) -> None:
        self._uri = options["path"]
        self._payload = options.get("payload", "true").lower() == "true"
        self._wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take equality and IN over header fields; return what Spark has to check itself."""
        for f in filters:
            field = _COLUMNS.get(f.attribute[0]) if isinstance(f, (EqualTo, In)) else None
            if field is None:
                yield f
                continue
            values = {str(v) for v in (f.value if isinstance(f, In) else (f.value,))}
            self._wanted[field] = self._wanted.get(field, values) & values

    def partitions(self) -> Sequence[InputPartition]:
        fs, root = pa.fs.FileSystem.from_uri(self._uri)
        found = fs.get_file_info(pa.fs.FileSelector(root, recursive=True))
        names = (i for i in found if i.is_file and not i.base_name.startswith(("_", ".")))
        return [_File(i.path) for i in names if i.size] or [_File("")]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        fs, _ = pa.fs.FileSystem.from_uri(self._uri)
        rows: list[tuple] = []
        held = 0
        with fs.open_input_file(partition.path) as raw, pa.BufferReader(b"") as _:
            for head, at, size in self._records(raw):
                if any(head.get(f, "") not in v for f, v in self._wanted.items()):
                    continue
                payload = None
                if self._payload:
                    raw.seek(at)
                    payload = raw.read(size)
                    held += size
                rows.append((*(head.get(f) for f in _COLUMNS.values()), payload))
                if held > 8 << 20 or len(rows) >= 4096:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _records(raw: pa.NativeFile) -> Iterator[tuple[dict[str, str], int, int]]:
        """Headers, payload place and payload size of the records of a file."""
        at, end = 0, raw.size()
        while at < end:
            raw.seek(at)
            head = raw.read(2048)
            while (stop := head.find(b"\r\n\r\n")) < 0:
                more = raw.read(2048)
                if not more:
                    raise ValueError(f"record at byte {at} has no end of headers")
                head += more
            lines = head[:stop].decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no record at byte {at}: {lines[0][:40]!r}")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            yield fields, at + stop + 4, size
            at += stop + 4 + size + 4

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * len(_COLUMNS) + [pa.binary()]
        arrays = [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*_COLUMNS, "payload"])


class WarcSource(DataSource):
    """``spark.read.format("warc")``; options ``path`` (a URI) and ``payload`` (false: null)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> WarcReader:  # noqa: ARG002
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records with header fields as strings and the payload as bytes."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    uri = path if "://" in path else f"file://{path.removeprefix('file:')}"
    return spark.read.format("warc").option("path", uri).option("payload", str(payload)).load()


def page_number(column: str):
    """The page id in a record id."""
    return F.try_element_at(
        F.regexp_extract_all(column, F.lit(f"<{_ID}(-?[0-9]+)>")), F.lit(1)
    ).cast("long")
