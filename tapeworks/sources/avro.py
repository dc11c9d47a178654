"""The lake's files: Avro containers of envelopes, read and written without a JVM package.

Only what the lake needs of the public container format is here: null and deflate codecs, records of
strings, bytes, longs and maps of strings, each possibly optional. Files are found and read by
Spark, so they can lie wherever it reads; tasks write theirs through Arrow's file systems.
"""

from __future__ import annotations

import io
import json
import os
import struct
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import config, schemas

MAGIC = b"Obj\x01"
SCHEMA = {
    "type": "record",
    "name": "Envelope",
    "fields": [
        {"name": "subscription_name", "type": "string"},
        {"name": "message_id", "type": "string"},
        {"name": "publish_time", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "data", "type": "bytes"},
        {"name": "attributes", "type": {"type": "map", "values": "string"}},
    ],
}


def _long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _blob(data: bytes) -> bytes:
    return _long(len(data)) + data


def _text(text: str) -> bytes:
    return _blob(text.encode())


def _map(values: dict[str, str]) -> bytes:
    body = b"".join(_text(k) + _text(v) for k, v in values.items())
    return (_long(len(values)) + body if values else b"") + _long(0)


class Reader:
    """Values from the bytes of a container."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        part = self.data[self.at : self.at + n]
        if len(part) < n:
            raise EOFError("the container is cut short")
        self.at += n
        return part

    def long(self) -> int:
        n = shift = 0
        while True:
            byte = self.take(1)[0]
            n |= (byte & 127) << shift
            if byte < 128:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def blob(self) -> bytes:
        return self.take(self.long())

    def blocks(self, read) -> Iterator:
        """Values of an array or map, which come in counted blocks."""
        while n := self.long():
            if n < 0:
                self.long()
            for _ in range(abs(n)):
                yield read()

    def value(self, kind):
        if isinstance(kind, list):
            return self.value(kind[self.long()])
        name = kind["type"] if isinstance(kind, dict) else kind
        if name == "null":
            return None
        if name in ("long", "int"):
            return self.long()
        if name == "string":
            return self.blob().decode()
        if name == "bytes":
            return self.blob()
        if name == "boolean":
            return self.take(1) == b"\x01"
        if name == "double":
            return struct.unpack("<d", self.take(8))[0]
        if name == "map":
            return dict(self.blocks(lambda: (self.blob().decode(), self.value(kind["values"]))))
        if name == "record":
            return {f["name"]: self.value(f["type"]) for f in kind["fields"]}
        raise ValueError(f"unknown kind {name!r}")


def records(data: bytes) -> Iterator[dict]:
    """Records of one container."""
    r = Reader(data)
    if r.take(4) != MAGIC:
        raise ValueError("not an Avro container")
    meta = dict(r.blocks(lambda: (r.blob().decode(), r.blob())))
    schema, codec, sync = json.loads(meta["avro.schema"]), meta.get("avro.codec", b"null"), r.take(16)
    if codec not in (b"null", b"deflate"):
        raise ValueError(f"unknown codec {codec!r}")
    while r.at < len(data):
        n, body = r.long(), r.blob()
        block = Reader(zlib.decompress(body, -15) if codec == b"deflate" else body)
        for _ in range(n):
            yield block.value(schema)
        if r.take(16) != sync:
            raise ValueError("a block does not end where it should")


class Container:
    """Collects envelopes to the bytes of one file."""

    def __init__(self, codec: str = "deflate") -> None:
        self.codec, self.sync = codec, os.urandom(16)
        self.out = io.BytesIO()
        self.out.write(MAGIC + _map_of_bytes({"avro.schema": json.dumps(SCHEMA).encode(), "avro.codec": codec.encode()}) + self.sync)
        self.block, self.n = [], 0

    def add(self, subscription_name: str, message_id: str, publish_time: int, data: bytes, attributes: dict[str, str]) -> None:
        self.block.append(_text(subscription_name) + _text(message_id) + _long(publish_time) + _blob(data) + _map(attributes))
        self.n += 1
        if len(self.block) == 1000:
            self.flush()

    def flush(self) -> None:
        if self.block:
            body = b"".join(self.block)
            if self.codec == "deflate":
                body = zlib.compress(body, 6, -15)
            self.out.write(_long(len(self.block)) + _blob(body) + self.sync)
            self.block = []

    @property
    def size(self) -> int:
        return self.out.tell() + sum(map(len, self.block))

    def bytes(self) -> bytes:
        self.flush()
        return self.out.getvalue()


def _map_of_bytes(values: dict[str, bytes]) -> bytes:
    return _long(len(values)) + b"".join(_text(k) + _blob(v) for k, v in values.items()) + _long(0)


_ROW = "subscription_name string, message_id string, publish_us bigint, data binary, attributes string"


def read_envelopes(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """Envelopes of the lake (folders dt=YYYY-MM-DD), or of the days given, whose folders alone are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "false").option("pathGlobFilter", "*.avro").load(path)
    if first_day is not None:
        files = files.where(F.col("dt").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["subscription_name", "message_id", "publish_us", "data", "attributes", "dt"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.date32()]
        for batch in batches:
            for content, dt in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                for e in records(content.as_py()):
                    rows.append((e["subscription_name"], e["message_id"], e["publish_time"], e["data"], json.dumps(e["attributes"]), dt))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    found = files.select("content", F.col("dt").cast("date").alias("dt")).mapInArrow(run, _ROW + ", dt date")
    return found.select("subscription_name", "message_id", F.timestamp_micros("publish_us").alias("publish_time"), "data", "attributes", "dt").to(schemas.ENVELOPE)


def write_envelopes(envelopes: DataFrame, path: str, most_bytes: int = config.LAKE_FILE_BYTES, most_seconds: int = config.LAKE_FILE_SECONDS) -> list[str]:
    """Write envelopes (subscription_name, message_id, publish_time, data) as containers named by the time of their
    first message, dt=YYYY-MM-DD/hh_mm_ss_*.avro. A file is closed at a size, or when its messages span
    a time. A task that is tried again writes files of the same names. Returns the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        files, root = fs.FileSystem.from_uri(path)
        part, written = TaskContext.get().partitionId(), []
        now: Container | None = None
        begun = 0

        def close() -> None:
            moment = datetime.fromtimestamp(begun / 1e6, UTC)
            folder = f"{root}/dt={moment:%Y-%m-%d}"
            files.create_dir(folder, recursive=True)
            name = f"{folder}/{moment:%H_%M_%S}_{part:05d}_{len(written):05d}.avro"
            with files.open_output_stream(name) as out:
                out.write(now.bytes())
            written.append(name)

        for batch in batches:
            for subscription, message_id, moment, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                day = moment // 86_400_000_000 != begun // 86_400_000_000
                if now is not None and (now.size >= most_bytes or moment - begun >= most_seconds * 1_000_000 or day):
                    close()
                    now = None
                if now is None:
                    now, begun = Container(), moment
                now.add(subscription, message_id, moment, data, {})
        if now is not None and now.n:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(written, pa.string())], names=["file"])

    rows = envelopes.select("subscription_name", "message_id", F.unix_micros("publish_time").alias("publish_us"), "data")
    return [r.file for r in rows.sortWithinPartitions("publish_us", "message_id").mapInArrow(run, "file string").collect()]
