"""Files that tasks write and read themselves, in the shared folder of work tables.

A task names its files after its own attempt and reports them in its rows. Only rows of
successful attempts reach the stored index, so files of lost attempts are never read.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI or an absolute path."""
    return fs.FileSystem.from_uri(root)


def attempt_name(kind: str, number: int = 0) -> str:
    context = TaskContext.get()
    return f"{context.partitionId():06d}-{number:05d}-{context.taskAttemptId()}.{kind}"
