"""A paged JSON service as a Spark source, in batch and as a stream.

Such a service gives full pages, then one that is short or empty. Where its number of rows is not known, the first page that
is not full is searched for by doubling and halving, which asks for about 2 log2(pages) pages on the driver; after that
every page is a partition of its own. There is no largest number of pages.

As a stream its offset is (page, row): the pages before are read, and of this page so many rows. A run reads on from the
offset of the checkpoint, ends at the page that is short, and the next run takes up that page where it ended.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


class PagedJson(DataSource):
    """Options: url with {page}, {first} and {last} in it, size (of a page, 1000), field (of the rows, "rows"), and rows
    (total number of rows) where it is known."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "page int, row string"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(Pages(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStreamReader(Pages(self.options))


class Pages:
    """The pages of a service, counted from 0."""

    def __init__(self, options: dict):
        self.url, self.size, self.rows, self.field = options["url"], int(options.get("size", 1000)), int(options.get("rows", 0)), options.get("field", "rows")
        if self.size < 1:
            raise ValueError("a page has one row at least")

    def fetch(self, k: int) -> list:
        with urllib.request.urlopen(self.url.format(page=k + 1, first=k * self.size + 1, last=(k + 1) * self.size), timeout=60) as answer:
            return json.load(answer).get(self.field) or []

    def end(self, start: int = 0) -> tuple[int, int]:
        """The first page from start on that is not full, and its number of rows."""
        if self.rows:
            return divmod(self.rows, self.size)
        known: dict[int, int] = {}

        def full(k: int) -> bool:
            known[k] = len(self.fetch(k))
            return known[k] >= self.size

        low, step = start, 1  # all pages before low are full
        while full(low + step - 1):
            low, step = low + step, 2 * step
        high = low + step - 1  # this one is not
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if full(middle) else (low, middle)
        return low, known[low]

    def read(self, k: int, start: int, end: int | None) -> Iterator[tuple[int, str]]:
        for row in self.fetch(k)[start:end]:
            yield k + 1, json.dumps(row, ensure_ascii=False)


class PagedReader(DataSourceReader):
    def __init__(self, pages: Pages):
        self.pages = pages

    def partitions(self) -> list[InputPartition]:
        page, rows = self.pages.end()
        return [InputPartition(k) for k in range(page + (rows > 0))]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        return self.pages.read(partition.value, 0, None)


class PagedStreamReader(DataSourceStreamReader):
    def __init__(self, pages: Pages):
        self.pages, self.known = pages, 0

    def initialOffset(self) -> dict:
        return {"page": 0, "row": 0}

    def latestOffset(self) -> dict:
        self.known, row = self.pages.end(self.known)
        return {"page": self.known, "row": row}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """One for each page from start to end; of the first and last only the rows that are new."""
        self.known = max(self.known, start["page"])
        parts = []
        for k in range(start["page"], end["page"] + (end["row"] > 0)):
            first, last = start["row"] if k == start["page"] else 0, end["row"] if k == end["page"] else self.pages.size
            if first < last:
                parts.append(InputPartition((k, first, last)))
        return parts

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        return self.pages.read(*partition.value)

    def commit(self, end: dict) -> None:
        """Nothing is held for pages that are read."""
