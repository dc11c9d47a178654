"""Reading: raw tables, the lake of envelopes, seeds, recorded sessions and streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from tapeworks import config, schemas
from tapeworks.functions.timing import arrived_since


def scan_raw(spark: SparkSession, path: str, channel: str, as_of, days: int | None = config.LOOKBACK_DAYS) -> DataFrame:
    """A raw table. The arrival bound is mandatory; ``days=None`` must be said to read it all."""
    rows = spark.read.schema(schemas.RAW[channel]).parquet(path)
    return rows if days is None else rows.where(arrived_since(F.col("publish_time"), F.lit(as_of).cast("timestamp"), days))


def scan_lake(spark: SparkSession, path: str, channel: str, first_day: str, last_day: str) -> DataFrame:
    """Raw rows decoded from the lake's envelopes of the days given; only their folders are read."""
    return _decoded(spark.read.schema(schemas.ENVELOPE).parquet(path).where(F.col("dt").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))), channel)


def _decoded(rows: DataFrame, channel: str) -> DataFrame:
    body = F.from_json(F.decode("data", "UTF-8"), schemas.CHANNELS[channel]).alias("body")
    return rows.select(body, "subscription_name", "message_id", "publish_time", "attributes").select("body.*", "subscription_name", "message_id", "publish_time", "attributes").to(schemas.RAW[channel])


def scan_avro_lake(spark: SparkSession, path: str, channel: str, first_day: str, last_day: str) -> DataFrame:
    """The same from a lake of Avro containers."""
    from tapeworks.sources.avro import read_envelopes

    return _decoded(read_envelopes(spark, path, first_day, last_day), channel)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DIM_PRODUCTS).csv(path, header=True)


def inline_products(spark: SparkSession, products: tuple[str, ...] = config.TRACKED_PRODUCTS) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, products))).alias("product_id"))


def read_session(spark: SparkSession, path: str, received_at=None) -> DataFrame:
    """A recorded session, one JSON message a line, numbered in file order (one file, one order)."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line_no", "line")).where("trim(line) <> ''")
    parsed = lines.select("line_no", F.from_json("line", schemas.SESSION).alias("m")).select("line_no", "m.*")
    return parsed if received_at is None else parsed.withColumn("received_at", F.lit(received_at).cast("timestamp"))


def stream_messages(spark: SparkSession, path: str, channel: str = "trades", max_files: int | None = None) -> DataFrame:
    """A stream of JSON messages with a fixed schema; files stand for the bus."""
    reader = spark.readStream.schema(schemas.CHANNELS[channel])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


class _BusReader(SimpleDataSourceStreamReader):
    def __init__(self, pull: Callable, fields: list[str], most: int) -> None:
        self.pull, self.fields, self.most = pull, fields, most

    def _rows(self, messages: list[dict]) -> Iterator[tuple]:
        return iter([tuple(m.get(f) for f in self.fields) for m in messages])

    def initialOffset(self) -> dict:
        return {"at": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found = self.pull(start["at"], start["at"] + self.most)
        return self._rows(found), {"at": start["at"] + len(found)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return self._rows(self.pull(start["at"], end["at"]))

    def commit(self, end: dict) -> None:
        pass


def bus(pull: Callable[[int, int], list[dict]], channel: str = "trades") -> type[DataSource]:
    """A stream over a bus that can be read again: ``pull(from, to)`` gives the messages at these positions,
    as many as there are. A query that starts anew from its checkpoint asks for the same ones, so
    each is processed once whatever breaks. Register it with ``spark.dataSource.register``; the option
    ``most`` bounds a batch."""

    class Bus(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"bus_{channel}"

        def schema(self):
            return schemas.CHANNELS[channel]

        def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
            return _BusReader(pull, schemas.CHANNELS[channel].names, int(self.options.get("most", 1000)))

    return Bus


class _PagePart(InputPartition):
    def __init__(self, after: int, before: int) -> None:
        super().__init__(None)
        self.after, self.before = after, before


class _PageReader(DataSourceReader):
    def __init__(self, fetch: Callable, after: int, before: int, parts: int, wait: float) -> None:
        self.fetch, self.after, self.before, self.parts, self.wait = fetch, after, before, parts, wait

    def partitions(self) -> list[InputPartition]:
        """Ranges of ids, each paged by a task of its own."""
        width = max(1, -(-(self.before - self.after - 1) // self.parts))
        return [_PagePart(at, min(at + width + 1, self.before)) for at in range(self.after, max(self.after + 1, self.before - 1), width)]

    def read(self, partition: _PagePart) -> Iterator[tuple]:
        """Newest first, page by page, until the cursor passes the range or a page is empty; so long between
        two pages that all tasks together ask no oftener than once in ``wait`` seconds."""
        import time

        cursor = partition.before
        while cursor > partition.after + 1:
            page = self.fetch(cursor)
            if not page:
                return
            for row in page:
                if partition.after < row["trade_id"] < partition.before:
                    yield row["trade_id"], row["price"], row["size"], row["side"], row["time"]
            cursor = min(row["trade_id"] for row in page)
            if cursor > partition.after + 1:
                time.sleep(self.wait * self.parts)


def paged_trades(fetch: Callable[[int], list[dict]]) -> type[DataSource]:
    """A data source over a paginated trades endpoint. ``fetch(before_id)`` returns a page, newest
    first. Register it with ``spark.dataSource.register`` and give options ``after``, ``before``, and
    ``parts`` (tasks) and ``wait`` (seconds between pages) where the defaults don't do."""

    class PagedTrades(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_trades"

        def schema(self) -> str:
            return "trade_id bigint, price string, size string, side string, time string"

        def reader(self, schema) -> DataSourceReader:
            return _PageReader(fetch, int(self.options["after"]), int(self.options["before"]), int(self.options.get("parts", 1)), float(self.options.get("wait", config.PAGE_WAIT_SECONDS)))

    return PagedTrades


def fetch_page(endpoint: str, product: str, before: int, rows: int = config.PAGE_ROWS, open_url: Callable | None = None) -> list[dict]:
    """One page of a product's trades with ids below ``before``, newest first, from a JSON endpoint."""
    import json
    from urllib.parse import urlencode
    from urllib.request import Request, urlopen

    address = f"{endpoint.rstrip('/')}/products/{product}/trades?" + urlencode({"limit": rows, "after": before})
    with (open_url or urlopen)(Request(address, headers={"User-Agent": "tapeworks"})) as answer:
        return json.load(answer)
