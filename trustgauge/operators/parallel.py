"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item, Result = TypeVar("Item"), TypeVar("Result")

# Iterative fits are chains of short jobs that leave most of a cluster idle.
PARALLEL_FITS = 5


def side_by_side(
    spark: SparkSession, job: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Results in the order of the items; at most PARALLEL_FITS jobs submit at a time."""
    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), items))
