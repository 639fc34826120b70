"""Cells sent to a key-value store in bounded batches, by a data source writer.

A task sends its cells in batches of at most ``batch`` fields. A batch groups the
fields by hash and goes out as one call where the client has pipelines. A failed
batch is sent again, which is harmless, as setting a field twice is. Each task
reports what it sent; when all have, the job commits, and only then the marker
hash, if one is asked for, tells readers that the whole set is there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

BATCH = 1_000
RETRIES = 3
WAIT_S = 0.2


@dataclass
class Sent(WriterCommitMessage):
    """What one task sent."""

    fields: int
    calls: int
    retried: int


def batches(rows: Iterator[Row], size: int) -> Iterator[dict[str, dict[str, str]]]:
    """``{key: {field: value}}`` with at most ``size`` fields each; a field without a value is left out."""
    held: dict[str, dict[str, str]] = {}
    count = 0
    for row in rows:
        if row["value"] is None:
            continue
        held.setdefault(row["key"], {})[row["field"]] = row["value"]
        count += 1
        if count == size:
            yield held
            held, count = {}, 0
    if held:
        yield held


def send(client: object, batch: dict[str, dict[str, str]]) -> int:
    """Set the fields of a batch; returns the number of calls that took."""
    pipelined = getattr(client, "pipeline", None)
    if pipelined is None:
        for key, fields in batch.items():
            client.hset(key, mapping=fields)
        return len(batch)
    calls = pipelined(transaction=False)
    for key, fields in batch.items():
        calls.hset(key, mapping=fields)
    calls.execute()
    return 1


class CellWriter(DataSourceWriter):
    """Sends the cells of each task and, at the end, the marker."""

    def __init__(self, connect: Callable[[], object], batch: int, retries: int, marker: str | None):
        self.connect, self.batch, self.retries, self.marker = connect, batch, retries, marker

    def write(self, iterator: Iterator[Row]) -> Sent:
        client = self.connect()
        fields = calls = retried = 0
        try:
            for batch in batches(iterator, self.batch):
                for attempt in range(self.retries + 1):
                    try:
                        calls += send(client, batch)
                        break
                    except Exception:
                        if attempt == self.retries:
                            raise
                        retried += 1
                        time.sleep(WAIT_S * 2**attempt)
                        _close(client)
                        client = self.connect()
                fields += sum(map(len, batch.values()))
        finally:
            _close(client)
        return Sent(fields, calls, retried)

    def commit(self, messages: list[Sent | None]) -> None:
        if self.marker is None:
            return
        client = self.connect()
        try:
            client.hset(self.marker, mapping={"fields": str(sum(m.fields for m in messages if m)), "complete": "1"})
        finally:
            _close(client)

    def abort(self, messages: list[Sent | None]) -> None:
        """Nothing is taken back: fields that were set are right, and a repeated job sets the rest."""


def send_cells(
    cells: DataFrame,
    connect: Callable[[], object],
    batch: int = BATCH,
    retries: int = RETRIES,
    marker: str | None = None,
) -> None:
    """Set all cells in a key-value store, from the tasks.

    ``connect`` returns a client with ``hset(key, mapping=fields)`` and, where it
    has them, ``pipeline(transaction=False)`` and ``close()``. It is called once
    in a task, and again after a failed call.
    """
    name = f"cells_{uuid.uuid4().hex}"

    class Cells(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> CellWriter:
            return CellWriter(connect, batch, retries, marker)

    cells.sparkSession.dataSource.register(Cells)
    cells.select("key", "field", "value").write.format(name).mode("append").save()


def _close(client: object) -> None:
    close = getattr(client, "close", None)
    if close is not None:
        close()
