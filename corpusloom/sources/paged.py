"""Paginated listings that have been landed as files, one page each, as a data source.

``spark.read.format("landed_pages").schema(...).option("path", folder).load()`` reads the files
``1.json``, ``2.json``, ... of a folder.  Pages are divided into ranges, one per partition.  A
listing ends at the first page that isn't full; with ``overflow`` set to ``error``, one that is
still full at the last allowed page is an error, with ``stop`` it is cut there.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class PageRange(InputPartition):
    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class LandedPages(DataSource):
    """Options: path, per_page (100), max_pages (20), pages_per_task (4), overflow (error or stop)."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagesReader(schema, self.options)


class PagesReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = schema.names
        self.folder = options["path"]
        self.per_page, self.max_pages, self.step = (int(options.get(k, d)) for k, d in (("per_page", 100), ("max_pages", 20), ("pages_per_task", 4)))
        self.strict = options.get("overflow", "error") == "error"

    def _page(self, number: int) -> list[dict]:
        path = os.path.join(self.folder, f"{number}.json")
        if not os.path.exists(path):
            return []
        with open(path, encoding="utf-8") as f:
            return json.load(f)

    def partitions(self) -> list[InputPartition]:
        if self.strict and len(self._page(self.max_pages)) >= self.per_page:
            raise ValueError(f"the listing goes on after page {self.max_pages}")
        return [PageRange(i, min(i + self.step - 1, self.max_pages)) for i in range(1, self.max_pages + 1, self.step)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        # A page counts only when the one before it is full.
        if partition.first > 1 and len(self._page(partition.first - 1)) < self.per_page:
            return
        for number in range(partition.first, partition.last + 1):
            rows = self._page(number)
            for row in rows:
                yield tuple(row.get(n) for n in self.names)
            if len(rows) < self.per_page:
                return


def register(spark) -> None:
    spark.dataSource.register(LandedPages)
