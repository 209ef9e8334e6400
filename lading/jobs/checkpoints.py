"""The checkpoint of a copy as a log that the copying tasks write themselves.

After every so many handled objects, and at its end, a task writes their keys as a small Parquet file
into the folder of the run and attempt. A run that dies so loses no more than that many keys per task. The
table of handled keys is all files of a run; those of a run that is resumed are put together first.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext

from .store import ObjectRoot

EVERY = 100


@dataclass(frozen=True)
class CheckpointLog:
    store: str
    folder: str
    source_bucket: str
    target_bucket: str
    every: int = EVERY

    def through(self, results: Iterator[dict]) -> Iterator[dict]:
        """The results, whose keys are written as they pass; failed ones are not handled."""
        root, keys, number = ObjectRoot(self.store), [], 0
        context = TaskContext.get()
        name = f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}"

        def write() -> None:
            nonlocal number
            table = pa.table({
                "source_bucket": pa.array([self.source_bucket] * len(keys), pa.string()),
                "target_bucket": pa.array([self.target_bucket] * len(keys), pa.string()),
                "key": pa.array(keys, pa.string())})
            sink = pa.BufferOutputStream()
            pq.write_table(table, sink)
            root.write(f"{self.folder}/{name}-{number:06d}.parquet", [sink.getvalue().to_pybytes()])
            number += 1
            keys.clear()

        for result in results:
            if result["success"]:
                keys.append(result["key"])
                if len(keys) >= self.every:
                    write()
            yield result
        if keys:
            write()
