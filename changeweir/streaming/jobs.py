"""Running independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import SparkSession


def together(spark: SparkSession, *steps: Callable[[], object]) -> list[object]:
    """Run independent steps at once, so their tasks share the executors; results in order."""
    results: list[object] = [None] * len(steps)
    failures: list[BaseException] = []

    def run(i: int) -> None:
        try:
            results[i] = steps[i]()
        except BaseException as e:  # raised again below, in the caller's thread
            failures.append(e)

    workers = [InheritableThread(target=run, args=(i,), session=spark) for i in range(len(steps))]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    if failures:
        raise failures[0]
    return results
