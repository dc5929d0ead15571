"""What several corpus operators share: table access, scratch tables, connected components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..operators.components import Workspace as Scratch
from ..operators.components import connected_components as components

__all__ = ["Scratch", "components", "give_back", "make_room", "table", "union_all", "worker_stores"]

worker_stores: dict[str, Callable[[], None]] = {}  # what clears the stores that operators keep in a worker from task to task


def give_back() -> None:
    """Returns freed memory to the machine: a worker stays for later stages, which need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library is glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def make_room() -> None:
    """Clears the stores of other operators at the start of a task; they fill again when theirs run."""
    for clear in worker_stores.values():
        clear()
    give_back()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
