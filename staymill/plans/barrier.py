"""Fits whose tasks run side by side and exchange arrays."""

from __future__ import annotations

import base64
import os
import pickle
import shutil
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

from staymill.functions.session import scratch_path

TASK_BYTES = 64 << 20  # bytes of rows that a task holds, about
WAIT = 0.0005  # seconds between two looks for a file

Gather = Callable[[np.ndarray], list[np.ndarray]]


def tasks_for(df: DataFrame, size: int, each: int = TASK_BYTES) -> int:
    """As many tasks as `size` bytes take, at most one per slot: a barrier stage starts all of its tasks or none."""
    return max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-size // each)))


@contextmanager
def meeting_place(spark: SparkSession) -> Iterator[str | None]:
    """A folder for the files of a fit if the scratch folder is a mounted one, removed afterwards; otherwise None."""
    place = urlparse(scratch_path(spark, "meeting"))
    folder = unquote(place.path) if place.scheme in ("", "file") and place.netloc in ("", "localhost") else None
    try:
        yield folder
    finally:
        if folder:
            shutil.rmtree(folder, ignore_errors=True)


class Alone:
    """A single task."""

    def __call__(self, values: np.ndarray) -> list[np.ndarray]:
        return [values]


class Messages:
    """Exchange by `allGather`, which takes up to a second each time."""

    def __init__(self, context: BarrierTaskContext, tasks: int):
        self.context, self.me, self.tasks = context, context.partitionId(), tasks

    def __call__(self, values: np.ndarray) -> list[np.ndarray]:
        sent = self.context.allGather(base64.b64encode(np.ascontiguousarray(values, float).tobytes()).decode("ascii"))
        return [np.frombuffer(base64.b64decode(m), float).reshape(values.shape) for m in sent]

    def deal(self, parts: Sequence[bytes]) -> list[bytes]:
        """One part for each task; those that the tasks have for this one."""
        sent = self.context.allGather(base64.b64encode(pickle.dumps(list(parts))).decode("ascii"))
        return [pickle.loads(base64.b64decode(m))[self.me] for m in sent]


class Files:
    """Exchange by files in a folder that all tasks reach: each writes one file a round and reads those of the others.

    Who has all files of a round knows that everyone has read those of the round before, and removes its own of that round.
    If a task is lost, Spark ends the others of its stage, also those that wait here."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.folder, self.me, self.tasks, self.round = folder, me, tasks, 0
        os.makedirs(folder, exist_ok=True)

    def _path(self, task: int, round_: int) -> str:
        return f"{self.folder}/{round_}-{task}"

    def _write(self, parts: Sequence[bytes]) -> None:
        path = self._path(self.me, self.round)
        with open(f"{path}.part", "wb") as f:
            for p in parts:
                f.write(p)
        os.replace(f"{path}.part", path)

    def _read(self, task: int, start: int = 0, size: int = -1) -> bytes:
        path = self._path(task, self.round)
        while True:
            try:
                with open(path, "rb") as f:
                    f.seek(start)
                    return f.read(size)
            except FileNotFoundError:
                time.sleep(WAIT)

    def _done(self) -> None:
        if self.round:
            os.remove(self._path(self.me, self.round - 1))
        self.round += 1

    def __call__(self, values: np.ndarray) -> list[np.ndarray]:
        sent = np.ascontiguousarray(values, float)
        self._write([sent.tobytes()])
        got = [sent if k == self.me else np.frombuffer(self._read(k), float).reshape(sent.shape) for k in range(self.tasks)]
        self._done()
        return got

    def deal(self, parts: Sequence[bytes]) -> list[bytes]:
        """One part for each task; those that the tasks have for this one."""
        self._write([np.cumsum([0, *map(len, parts)]).astype(np.int64).tobytes(), *parts])
        got, head = [], 8 * (self.tasks + 1)
        for k in range(self.tasks):
            if k == self.me:
                got.append(parts[k])
                continue
            a, b = np.frombuffer(self._read(k, 8 * self.me, 16), np.int64)
            got.append(self._read(k, head + int(a), int(b - a)))
        self._done()
        return got


def gatherer(folder: str | None = None) -> Gather:
    """Inside a barrier task: send an array of doubles, get those of all tasks in the order of tasks."""
    context = BarrierTaskContext.get()
    tasks = len(context.getTaskInfos())
    if tasks == 1:
        return Alone()
    if not folder:
        return Messages(context, tasks)
    run = context.allGather(uuid.uuid4().hex)[0]  # a stage that runs again meets in another folder
    return Files(f"{folder}/{run}", context.partitionId(), tasks)


def is_first() -> bool:
    return BarrierTaskContext.get().partitionId() == 0


def total(gather: Gather, values: np.ndarray) -> np.ndarray:
    return np.sum(gather(values), axis=0)


def uniform(keys: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from integer keys."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / float(1 << 53)
