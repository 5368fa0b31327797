"""Run a stream over everything available now and read back what it wrote.

State and output live in the shared folder, so a lost executor or a restart continues
from the last committed micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.session import fresh_path
from tidemark.sinks.keyed import KeyedTable

BatchWriter = Callable[[DataFrame, int], None]
#: Ends bounded input: lands what moves the watermark past every row.
End = Callable[[], None]


#: Seconds between looks at the progress of a run.
LOOK = 2


class LateRowsDropped(RuntimeError):
    """Rows came further behind the watermark than the delay allows and were lost."""


@dataclass
class Progress:
    """What the micro-batches of a stream added up to; the engine keeps only the latest."""

    batches: int = 0
    dropped: int = 0
    most_state_rows: int = 0

    def follow(self, query: StreamingQuery) -> None:
        """Until the query has ended, batch by batch."""
        seen = -1
        ended = False
        while not ended:
            ended = query.awaitTermination(LOOK)
            for batch in query.recentProgress:
                if batch.batchId > seen:
                    seen = batch.batchId
                    self.batches += 1
                    self.dropped += sum(o.numRowsDroppedByWatermark for o in batch.stateOperators)
                    self.most_state_rows = max(self.most_state_rows, sum(o.numRowsTotal for o in batch.stateOperators))


def _run(writer: DataStreamWriter, progress: Progress) -> None:
    """Start, wait until everything available now is done, and check that nothing was lost."""
    progress.follow(writer.trigger(availableNow=True).start())
    if progress.dropped:
        raise LateRowsDropped(
            f"{progress.dropped} rows came behind the watermark: give the source's disorder as delay, or route late rows"
        )


def _finish(writer: DataStreamWriter, end: End | None, progress: Progress | None) -> None:
    """Everything available now, then what the end of the input lets out.

    The number of state partitions is the session's shuffle partitions and stays what it
    is for the life of a checkpoint.
    """
    progress = progress or Progress()
    _run(writer, progress)
    if end is not None:
        end()
        _run(writer, progress)


def drain(
    stream: DataFrame, label: str, path: str | None = None, checkpoint: str | None = None,
    end: End | None = None, progress: Progress | None = None,
) -> DataFrame:
    """Append mode: every row once, exactly-once into Parquet files.

    With ``end`` windows and timers that are open at the end of the input come out too.
    ``progress`` is told of every micro-batch.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, label)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or fresh_path(spark, f"{label}-state"))
    )
    _finish(writer, end, progress)
    return spark.read.schema(stream.schema).parquet(path)


def drain_batches(
    stream: DataFrame, write: BatchWriter, label: str, mode: str = "append",
    checkpoint: str | None = None, end: End | None = None, progress: Progress | None = None,
) -> None:
    """Hand every micro-batch to ``write``; it may be replayed under the same number."""
    state = checkpoint or fresh_path(stream.sparkSession, f"{label}-state")
    writer = (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", state)
    )
    _finish(writer, end, progress)


def drain_updates(
    stream: DataFrame, keys: list[str], label: str, checkpoint: str | None = None,
    path: str | None = None, progress: Progress | None = None,
) -> DataFrame:
    """Update mode: changed results per micro-batch; the last one per key is returned."""
    table = KeyedTable(stream.sparkSession, keys, [], path, stream.schema)
    drain_batches(stream, table.upsert_batch, label, "update", checkpoint, progress=progress)
    return table.read()


def drain_latest(
    stream: DataFrame, keys: list[str], order: list[str], label: str, end: End | None = None
) -> DataFrame:
    """Append mode where later rows of a key supersede earlier ones."""
    table = KeyedTable(stream.sparkSession, keys, order, schema=stream.schema)
    drain_batches(stream, table.upsert_batch, label, end=end)
    return table.read()
