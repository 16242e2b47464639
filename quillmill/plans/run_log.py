"""What a run says of itself: log lines, progress, and a table of its steps."""

from __future__ import annotations

import logging
import sys
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

_FORMAT = "%(asctime)s | %(levelname)-8s | %(name)s | %(message)s"


def logger(name: str, level: str = "INFO", path: str | None = None) -> logging.Logger:
    """A logger to the console, and to a file of the driver if there is a path; asking again adds no handler."""
    out = logging.getLogger(f"quillmill.{name}")
    out.setLevel(level)
    out.propagate = False
    if not out.handlers:
        for handler in [logging.StreamHandler(sys.stderr), *([logging.FileHandler(path)] if path else [])]:
            handler.setFormatter(logging.Formatter(_FORMAT))
            out.addHandler(handler)
    return out


@dataclass
class RunLog:
    """The steps of a run, one after another: what ran, how long, how many rows, and what failed."""

    run_id: str
    steps: list[tuple] = field(default_factory=list)

    @contextmanager
    def step(self, name: str) -> Iterator[dict]:
        """Time a step; the caller may set `rows` in the dict it gets. An error is recorded and raised."""
        said: dict = {"rows": None}
        log, began = logger("run"), time.perf_counter()
        log.info("%s: %s", self.run_id, name)
        try:
            yield said
        except Exception as e:
            self.steps.append((self.run_id, len(self.steps), name, time.perf_counter() - began, said["rows"], str(e)[:500]))
            log.error("%s: %s failed: %s", self.run_id, name, e)
            raise
        self.steps.append((self.run_id, len(self.steps), name, time.perf_counter() - began, said["rows"], None))
        log.info("%s: %s took %.1f s, %s rows", self.run_id, name, self.steps[-1][3], said["rows"])

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.steps, "run_id string, nth int, step string, seconds double, rows long, error string")

    def summary(self) -> str:
        """Lines for the console."""
        shown = [f"{n + 1:>3}. {step:<30} {seconds:>8.1f} s  {'failed' if error else '' if rows is None else rows}" for _, n, step, seconds, rows, error in self.steps]
        return "\n".join([f"run {self.run_id}", *shown, f"     {'total':<30} {sum(s[3] for s in self.steps):>8.1f} s"])
