"""A Python data source for APIs that return logs in pages by block.

Any transport fits: the option `transport` names a function "module:function" that takes (from_block, to_block, options)
and returns (rows, next_block, archive_height), rows being tuples of the schema. Partitions are block ranges, so pages of
different ranges are read in parallel; each range retries on its own and Spark retries the task."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition


def transport_of(options: dict) -> Callable:
    module, name = options["transport"].split(":")
    return getattr(importlib.import_module(module), name)


def with_retries(call: Callable, attempts: int = 3, pauses: tuple[float, ...] = (1.0, 3.0), sleep: Callable = time.sleep):
    """Calls again after a failure, with growing pauses; the last failure is raised."""
    for i in range(attempts):
        try:
            return call()
        except Exception:
            if i + 1 == attempts:
                raise
            sleep(pauses[min(i, len(pauses) - 1)])


def pages(options: dict, start: int, end: int) -> Iterator[tuple]:
    """Rows of blocks start .. end - 1: pages follow each other until the range or the archive ends."""
    fetch, at = transport_of(options), start
    pause = float(options.get("pause", 1.0))
    while at < end:
        rows, following, height = with_retries(lambda at=at: fetch(at, end, options), int(options.get("attempts", 3)), (pause, 3 * pause))
        yield from rows
        if following <= at or following > height:
            break
        at = following


class BlockRange(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start, self.end = start, end


def ranges(first: int, last: int, options: dict) -> list[BlockRange]:
    """Ranges of blocks_per_partition blocks, each read by a task of its own."""
    step = max(1, int(options.get("blocks_per_partition", 10_000)))
    return [BlockRange(a, min(a + step, last)) for a in range(first, last, step)] or [BlockRange(first, first)]


class LogReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self) -> list[BlockRange]:
        return ranges(int(self.options.get("from_block", 0)), int(self.options["to_block"]), self.options)

    def read(self, partition: BlockRange) -> Iterator[tuple]:
        return pages(self.options, partition.start, partition.end)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are blocks; a micro-batch holds the blocks up to the tip less the finality margin, in ranges that tasks
    read in parallel. The driver only asks for the tip."""

    def __init__(self, options: dict):
        self.options = dict(options)
        self.first = int(self.options.get("from_block", 0))

    def initialOffset(self) -> dict:
        return {"block": self.first}

    def latestOffset(self) -> dict:
        _, _, height = with_retries(lambda: transport_of(self.options)(self.first, self.first, self.options), int(self.options.get("attempts", 3)))
        return {"block": max(self.first, height - int(self.options.get("finality", 0)) + 1)}

    def partitions(self, start: dict, end: dict) -> list[BlockRange]:
        return ranges(start["block"], end["block"], self.options)

    def read(self, partition: BlockRange) -> Iterator[tuple]:
        return pages(self.options, partition.start, partition.end)


class PagedLogs(DataSource):
    """spark.read.format("paged_logs").schema(...).option("transport", "package.module:function")..."""

    @classmethod
    def name(cls) -> str:
        return "paged_logs"

    def schema(self) -> str:
        return "network string, block_number long, block_timestamp timestamp_ntz, tx_hash string, log_index long, address string, topic0 string, topic1 string, topic2 string, topic3 string, data string"

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)
