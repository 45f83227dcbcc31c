"""A dense network for two classes: ReLU units, dropout, a validation share, patience, and the best weights kept.

One barrier job trains it: every task holds its share of the rows, mini-batches are drawn by a hash of key and epoch, each
task works out the gradient of its rows of a batch, the tasks sum them, and all take the same Adam step. Batches,
dropout and validation rows follow from the keys, so the result depends on the number of tasks by rounding only.

Rows are kept by their filled slots; a batch becomes a matrix of the slots that it fills, and meets those weights alone."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill import schema as S
from staymill.functions.hashing import unit
from staymill.functions.session import materialise
from staymill.functions.vectors import Rows, rows_of, unwrapped
from staymill.plans.barrier import Gather, gatherer, is_first, meeting_place, tasks_for, total, uniform

Layers = list[tuple[np.ndarray, np.ndarray]]
TASK_BYTES = 512 << 20  # filled slots that a task holds, about: batches are many and small, so few tasks should meet for each
JUDGED = 2000  # rows that pass forward at once


@dataclass
class Settings:
    hidden: tuple[int, ...] = (64, 32, 16)
    epochs: int = 60
    batch: int = 512
    dropout: float = 0.3  # after the first layer
    validation: float = 0.2
    patience: int = 10
    rate: float = 1e-3
    seed: int = S.SEED


def held_out(key: str = S.KEY, share: float = 0.2, seed: int = S.SEED) -> Column:
    """The rows that only judge when to stop."""
    return unit(key, seed + 1) < share


def start(width: int, s: Settings) -> Layers:
    """Uniform weights by the sizes of both sides, no bias."""
    rng = np.random.default_rng(s.seed)
    sizes = [width, *s.hidden, 1]
    limits = [np.sqrt(6 / (a + b)) for a, b in zip(sizes, sizes[1:])]
    return [(rng.uniform(-limit, limit, (a, b)), np.zeros(b)) for a, b, limit in zip(sizes, sizes[1:], limits)]


def forward(layers: Layers, x: np.ndarray, mask: np.ndarray | None = None) -> list[np.ndarray]:
    """Outputs of all layers, the last one as log-odds."""
    outs = [x]
    for i, (w, b) in enumerate(layers):
        z = outs[-1] @ w + b
        if i < len(layers) - 1:
            z = np.maximum(z, 0)
            if i == 0 and mask is not None:
                z = z * mask
        outs.append(z)
    return outs


def gradient(layers: Layers, x: np.ndarray, y: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    """Summed gradient of the log-loss over the rows, all layers in one array."""
    outs = forward(layers, x, mask)
    delta = (1 / (1 + np.exp(-outs[-1])) - y[:, None])
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.concatenate([(outs[i].T @ delta).ravel(), delta.sum(axis=0)]))
        if i:
            delta = (delta @ layers[i][0].T) * (outs[i] > 0)
            if i == 1 and mask is not None:
                delta = delta * mask
    return np.concatenate(parts[::-1])


def _flat(layers: Layers) -> np.ndarray:
    return np.concatenate([np.concatenate([w.ravel(), b]) for w, b in layers])


def _shaped(flat: np.ndarray, like: Layers) -> Layers:
    out, at = [], 0
    for w, b in like:
        out.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
        at += w.size + b.size
    return out


def _part(layers: Layers, slots: np.ndarray) -> Layers:
    """Layers for a matrix that has only these slots."""
    (w, b), *rest = layers
    return [(w[slots], b), *rest]


def margins(layers: Layers, x: Rows, pick: np.ndarray) -> np.ndarray:
    """Log-odds of the picked rows."""
    out = np.zeros(len(pick))
    for a in range(0, len(pick), JUDGED):
        matrix, slots = x.block(pick[a : a + JUDGED])
        out[a : a + JUDGED] = forward(_part(layers, slots), matrix)[-1][:, 0]
    return out


def _loss(layers: Layers, x: Rows, y: np.ndarray, pick: np.ndarray) -> np.ndarray:
    m = margins(layers, x, pick)
    return np.array([(np.logaddexp(0, m) - y[pick] * m).sum(), float(len(pick))])


def train(x: Rows, y: np.ndarray, held: np.ndarray, keys: np.ndarray, s: Settings, gather: Gather) -> tuple[Layers, list[tuple[float, float | None]]]:
    """(best layers, (training loss, validation loss) per epoch), the same in every task."""
    layers = start(x.width, s)
    p = _flat(layers)
    m, v, step = np.zeros_like(p), np.zeros_like(p), 0
    learn, judge = np.flatnonzero(~held), np.flatnonzero(held)
    ks = keys[learn]
    rows = int(total(gather, np.array([float(len(learn))]))[0])
    batches = max(1, round(rows / s.batch))
    units = np.arange(s.hidden[0], dtype=np.int64)
    best, best_p, best_at, history = np.inf, p, 0, []
    for epoch in range(s.epochs):
        batch = (uniform(ks, s.seed * 1009 + epoch) * batches).astype(np.int64)
        order = np.argsort(batch, kind="stable")
        edge = np.searchsorted(batch[order], np.arange(batches + 1))
        for b in range(batches):
            pick = order[edge[b] : edge[b + 1]]
            mask = None
            if s.dropout:
                drawn = uniform((ks[pick][:, None] * 131 + units[None, :]).ravel(), s.seed * 2003 + epoch).reshape(len(pick), -1)
                mask = (drawn >= s.dropout) / (1 - s.dropout)
            matrix, slots = x.block(learn[pick])
            part, inner = gradient(_part(layers, slots), matrix, y[learn[pick]], mask), len(slots) * s.hidden[0]
            g = np.zeros(len(p) + 1)
            g[: x.width * s.hidden[0]].reshape(x.width, -1)[slots] = part[:inner].reshape(len(slots), -1)
            g[x.width * s.hidden[0] : -1], g[-1] = part[inner:], len(pick)
            g = total(gather, g)
            if not g[-1]:
                continue
            step += 1
            g = g[:-1] / g[-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            p = p - s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
            layers = _shaped(p, layers)
        sums = total(gather, np.stack([_loss(layers, x, y, learn), _loss(layers, x, y, judge)]))
        now, check = (float(a / n) if n else None for a, n in sums)
        history.append((now, check))
        judged = now if check is None else check
        if judged < best:
            best, best_p, best_at = judged, p, epoch
        elif epoch - best_at >= s.patience:
            break
    return _shaped(best_p, layers), history


_ROWS = "slot array<int>, value array<float>, y double, held boolean, k long"
_LAYERS = "layer int, inputs int, w array<double>, b array<double>, loss array<double>, held_loss array<double>"


def _job(batches: Iterator[pa.RecordBatch], width: int, s: Settings, folder: str | None) -> Iterator[pa.RecordBatch]:
    gather = gatherer(folder)
    parts = [
        (*[np.asarray(b.column(c).flatten()) for c in ("slot", "value")], np.asarray(pc.list_value_length(b.column("slot"))), *[np.asarray(b.column(c).to_numpy(zero_copy_only=False)) for c in ("y", "held", "k")])
        for b in batches if b.num_rows
    ]
    blank = (np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64))
    slot, value, counts, y, held, keys = (np.concatenate(p) for p in zip(blank, *parts))
    del parts
    layers, history = train(Rows(np.append(0, np.cumsum(counts)), slot, value, width), y, held, keys, s, gather)
    if is_first():
        loss, check = [h[0] for h in history], [h[1] for h in history]
        rows = [{"layer": i, "inputs": w.shape[0], "w": w.ravel().tolist(), "b": b.tolist(), "loss": loss, "held_loss": check} for i, (w, b) in enumerate(layers)]
        numbers = pa.list_(pa.float64())
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("layer", pa.int32()), ("inputs", pa.int32()), ("w", numbers), ("b", numbers), ("loss", numbers), ("held_loss", numbers)]))


class Network(Estimator):
    """Estimator over a vector column and a 0/1 label; rows need an integer key."""

    def __init__(self, settings: Settings, features: str = "features", label: str = "label", key: str = S.KEY, tasks: int | None = None):
        super().__init__()
        self.settings, self.features, self.label, self.key, self.tasks = settings, features, label, key, tasks

    def _fit(self, df: DataFrame) -> NetworkModel:
        s = self.settings
        frame = df.select(unwrapped(df, self.features).alias("x"), F.col(self.label).cast("double").alias("y"), held_out(self.key, s.validation, s.seed).alias("held"), F.col(self.key).cast("long").alias("k"))
        width = frame.select(F.max(F.coalesce("x.size", F.size("x.values")))).first()[0]  # a dense vector has no size of its own
        if not width:
            raise ValueError("no rows to fit on")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = rows_of(b.column("x"))
                first, filled = pa.array(x.first, pa.int32()), [pa.array(x.slot, pa.int32()), pa.array(x.value, pa.float32())]
                yield pa.RecordBatch.from_arrays([*[pa.ListArray.from_arrays(first, v) for v in filled], *[b.column(c) for c in ("y", "held", "k")]], names=["slot", "value", "y", "held", "k"])

        packed = materialise(frame.mapInArrow(pack, _ROWS), "packed")
        rows, slots = packed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("slot")), F.lit(0))).first()
        tasks = self.tasks or tasks_for(packed, 8 * slots + 32 * rows, TASK_BYTES)
        with meeting_place(df.sparkSession) as folder:
            trained = packed.repartition(tasks, "k").mapInArrow(lambda it: _job(it, width, s, folder), _LAYERS, barrier=True)
            return NetworkModel.of(materialise(trained, "layers"), self.features)


class NetworkModel(Model, MLWritable, MLReadable):
    """Layers, and the losses of every epoch."""

    def __init__(self, layers: Layers | None = None, history: list | None = None, features: str = "features"):
        super().__init__()
        self.layers, self.history, self.features = layers or [], history or [], features

    @classmethod
    def of(cls, table: DataFrame, features: str) -> NetworkModel:
        rows = table.orderBy("layer").collect()  # the model
        layers = [(np.array(r["w"]).reshape(r["inputs"], -1), np.array(r["b"])) for r in rows]
        return cls(layers, list(zip(rows[0]["loss"], rows[0]["held_loss"])), features)

    def copy(self, extra=None) -> NetworkModel:
        return NetworkModel(self.layers, self.history, self.features)

    def _transform(self, df: DataFrame) -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast(self.layers)

        @F.arrow_udf("double")
        def margin(column: pa.Array) -> pa.Array:
            x = rows_of(column)
            x = Rows(x.first, x.slot, x.value.astype(np.float32), x.width)
            return pa.array(margins(held.value, x, np.arange(len(x))), mask=column.is_null().to_numpy(zero_copy_only=False))

        m = F.col("_margin")
        p = 1 / (1 + F.exp(-m))
        return df.withColumn("_margin", margin(unwrapped(df, self.features))).withColumns({
            "rawPrediction": array_to_vector(F.array(-m, m)), "probability": array_to_vector(F.array(1 - p, p)), "prediction": (m > 0).cast("double"),
        }).drop("_margin")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: NetworkModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        state = {"features": m.features, "history": m.history, "inputs": [len(w) for w, _ in m.layers]}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=state)
        rows = [(i, json.dumps([w.ravel().tolist(), b.tolist()])) for i, (w, b) in enumerate(m.layers)]
        self.sparkSession.createDataFrame(rows, "layer int, data string").write.parquet(f"{path}/layers")


class _Reader(MLReader):
    def load(self, path: str) -> NetworkModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = [json.loads(r["data"]) for r in self.sparkSession.read.parquet(f"{path}/layers").orderBy("layer").collect()]
        layers = [(np.array(w).reshape(n, -1), np.array(b)) for (w, b), n in zip(rows, meta["inputs"])]
        model = NetworkModel(layers, [tuple(h) for h in meta["history"]], meta["features"])
        model._resetUid(meta["uid"])
        return model
