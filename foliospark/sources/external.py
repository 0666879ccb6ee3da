"""Tables of SQLite files and of paged JSON services, as Spark data sources."""

from __future__ import annotations

import json
import sqlite3
import urllib.parse
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class _Part(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class Sqlite(DataSource):
    """Options: path, table, partitions. Rows are dealt to tasks by ranges of rowid; only the schema's columns are read.
    The file must lie where every executor sees it."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SqliteReader(self.options, schema)


class _SqliteReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.path, self.table, self.parts = options["path"], options["table"].replace('"', '""'), int(options.get("partitions", "8"))
        self.columns = ", ".join('"' + n.replace('"', '""') + '"' for n in schema.names)

    def _rows(self, sql: str, *values):
        db = sqlite3.connect(f"file:{urllib.parse.quote(self.path)}?mode=ro", uri=True)
        try:
            yield from db.execute(sql, values)
        finally:
            db.close()

    def partitions(self):
        ((low, high),) = self._rows(f'SELECT min(rowid), max(rowid) FROM "{self.table}"')
        if low is None:
            return [_Part(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [_Part(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition):
        yield from self._rows(f'SELECT {self.columns} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', partition.low, partition.high)


class Rest(DataSource):
    """Options: url with {page}, pages (their number, from 1), items (the key of the list in an answer, if it isn't the
    answer itself), timeout (seconds, 5), attempts (2). A page is a task; fields a record lacks are null. A page that
    fails after its attempts fails the read, unless tolerant is true."""

    @classmethod
    def name(cls) -> str:
        return "rest_json"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _RestReader(self.options, schema)


class _RestReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.url, self.pages, self.items = options["url"], int(options["pages"]), options.get("items")
        self.timeout, self.attempts, self.tolerant = float(options.get("timeout", "5")), int(options.get("attempts", "2")), options.get("tolerant", "false") == "true"
        self.names = schema.names

    def partitions(self):
        return [_Part(n, n + 1) for n in range(1, self.pages + 1)]

    def read(self, partition):
        for left in reversed(range(self.attempts)):
            try:
                with urllib.request.urlopen(self.url.replace("{page}", str(partition.low)), timeout=self.timeout) as answer:
                    found = json.load(answer)
                break
            except (OSError, ValueError):
                if left:
                    continue
                if self.tolerant:
                    return
                raise
        for row in found[self.items] if self.items else found:
            yield tuple(row.get(n) for n in self.names)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, partitions: int = 8) -> DataFrame:
    spark.dataSource.register(Sqlite)
    return spark.read.format("sqlite").schema(schema).options(path=path, table=table, partitions=partitions).load()


def read_rest(spark: SparkSession, url: str, pages: int, schema: str, **options) -> DataFrame:
    spark.dataSource.register(Rest)
    return spark.read.format("rest_json").schema(schema).options(url=url, pages=pages, **options).load()
