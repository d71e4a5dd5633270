"""Repeated batch runs, driven by a stream of new documents.

The text operators are stateless and work on a streaming DataFrame as they are. A whole run skips what earlier runs
converted, which needs the tables written so far; so each micro-batch is one ordinary run, named after the stream and
its number. If a micro-batch is repeated after a failure, it overwrites its own partition; streams with different names keep
out of each other's way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from inkmill.plans.convert import run_batch


def convert_stream(docs: DataFrame, target: str, name: str, **options) -> DataStreamWriter:
    """A writer to start with the trigger and checkpoint location of your choice; `options` are those of `run_batch`.

    `name` has to stay the same when the stream starts again from its checkpoint, and to be new with a new checkpoint.
    """

    def run(batch: DataFrame, number: int) -> None:
        run_batch(batch, target, run_id=f"{name}-{number:08d}", **options)

    return docs.writeStream.foreachBatch(run)
