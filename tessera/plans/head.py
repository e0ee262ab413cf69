"""A working predictor of crops: features by a fixed backbone, and a softmax head trained over the whole table.

Features are made by Arrow batches from the pixels of crops. Every epoch is one pass: tasks return the sum of the weighted
gradients of their rows, one row a task, and the driver takes a step of AdamW. The head is as small as features are wide,
so nothing that leaves a task grows with the data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import png

#: Patches a side of a crop, and crops that go through the backbone at a time.
SIDE, BATCH = 14, 32


def patch_features(pixels: np.ndarray) -> np.ndarray:
    """The stand-in backbone: mean and spread of every patch and band, patch by patch."""
    size = pixels.shape[0] // SIDE
    cells = pixels[: size * SIDE, : size * SIDE].reshape(SIDE, size, SIDE, size, -1).astype(np.float32) / 255
    return np.concatenate([cells.mean((1, 3)), cells.std((1, 3))], axis=-1).reshape(SIDE * SIDE, -1)


def with_features(crops: DataFrame, backbone=patch_features, image: str = "image") -> DataFrame:
    """Adds features: the mean over a crop's tokens. backbone gives (tokens, width) of an array of pixels."""
    @F.pandas_udf("array<float>")
    def made(images: pd.Series) -> pd.Series:
        out: list = []
        for at in range(0, len(images), BATCH):
            out += [backbone(png.decode(x)).mean(0).astype(np.float32) for x in images.iloc[at : at + BATCH]]
        return pd.Series(out)

    return crops.withColumn("features", made(image))


@dataclass
class Head:
    weights: np.ndarray  # (width + 1, classes), the bias last
    mean: np.ndarray
    spread: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.spread
        return z @ self.weights[:-1] + self.weights[-1]


@dataclass(frozen=True)
class Recipe:
    epochs: int = 50
    warmup: int = 5
    rate: float = 0.05
    decay: float = 1e-3
    clip: float = 1.0
    patience: int = 7


def learning_rate(recipe: Recipe, epoch: int) -> float:
    """A linear rise, then half a cosine."""
    if epoch < recipe.warmup:
        return recipe.rate * (epoch + 1) / recipe.warmup
    part = min(1.0, (epoch - recipe.warmup) / max(1, recipe.epochs - recipe.warmup))
    return recipe.rate * 0.5 * (1 + np.cos(np.pi * part))


def _pass(rows: DataFrame, head: Head, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One pass over (label, features): sum of gradients, counts (label, predicted), and weighted loss, over all rows."""
    import pyarrow as pa

    shape = head.weights.shape

    def run(batches):
        total, cells, loss, mass = np.zeros(shape), np.zeros((shape[1], shape[1])), 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False).astype(int)
            x = np.asarray(batch.column(1).to_pylist(), np.float64)
            logits = head.logits(x)
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w, at = weight[y], np.arange(len(y))
            loss += float(-(w * np.log(p[at, y] + 1e-12)).sum())
            mass += float(w.sum())
            np.add.at(cells, (y, logits.argmax(1)), 1)
            d = p * w[:, None]
            d[at, y] -= w
            total += np.vstack([((x - head.mean) / head.spread).T @ d, d.sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([cells.tobytes()]), pa.array([loss]), pa.array([mass])], names=["g", "c", "loss", "mass"])

    # one row a task
    found = rows.select("label", "features").mapInArrow(run, "g binary, c binary, loss double, mass double").collect()
    mass = max(1e-12, sum(r["mass"] for r in found))
    add = lambda name, shape: sum(np.frombuffer(bytes(r[name])).reshape(shape) for r in found)
    return add("g", shape) / mass, add("c", (shape[1], shape[1])), sum(r["loss"] for r in found) / mass


def f1(cells: np.ndarray) -> float:
    """F1 of class 1 from counts (label, predicted); 0 for 0 / 0."""
    whole = cells[1].sum() + cells[:, 1].sum()
    return float(2 * cells[1, 1] / whole) if whole else 0.0


class Checkpoint:
    """The state of a training run in one small file, replaced after every epoch and gone when training has ended."""

    def __init__(self, spark: SparkSession, path: str | None):
        self.path = path and spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        self.jvm = spark.sparkContext._jvm
        self.store = path and self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def load(self) -> dict | None:
        if not self.path or not self.store.exists(self.path):
            return None
        stream = self.store.open(self.path)
        try:
            return json.loads(bytes(self.jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode())
        finally:
            stream.close()

    def save(self, state: dict) -> None:
        if self.path:
            part = self.path.suffix(".part")
            stream = self.store.create(part, True)
            stream.write(bytearray(json.dumps(state).encode()))
            stream.close()
            self.store.delete(self.path, False)
            self.store.rename(part, self.path)

    def drop(self) -> None:
        if self.path:
            self.store.delete(self.path, False)


def train(rows: DataFrame, held: DataFrame, weights: DataFrame, checkpoint: str | None = None, recipe: Recipe = Recipe(), stop_after: int | None = None) -> Head:
    """The head of the best epoch by F1 on held-out rows; both tables have label and features.

    Training resumes at the epoch after the one that the checkpoint holds. stop_after leaves after so many epochs, as a
    run that is cut off does.
    """
    kept = Checkpoint(rows.sparkSession, checkpoint)
    state = kept.load()
    weight = np.asarray([r["weight"] for r in weights.orderBy("label").collect()])  # a row a class
    if state is None:
        width = len(rows.select("features").first()["features"])
        x = [F.col("features")[k].cast("double") for k in range(width)]
        stats = rows.agg(*(F.avg(c).alias(f"m{k}") for k, c in enumerate(x)), *(F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(x))).first()
        zero = np.zeros((width + 1, len(weight))).tolist()
        state = {"epoch": 0, "weights": zero, "m": zero, "v": zero, "best": zero, "f1": -1.0, "at": 0, "mean": [stats[f"m{k}"] for k in range(width)], "spread": [max(1e-6, stats[f"s{k}"]) for k in range(width)]}
    head = Head(np.asarray(state["weights"]), np.asarray(state["mean"]), np.asarray(state["spread"]))
    m, v, best = (np.asarray(state[k]) for k in ("m", "v", "best"))
    done = 0
    while state["epoch"] < recipe.epochs and state["epoch"] - state["at"] < recipe.patience:
        if stop_after is not None and done >= stop_after:
            return Head(best, head.mean, head.spread)
        g, _, _ = _pass(rows, head, weight)
        g *= min(1.0, recipe.clip / max(1e-12, float(np.sqrt((g * g).sum()))))
        step = state["epoch"] + 1
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        head.weights = head.weights - learning_rate(recipe, state["epoch"]) * (move + recipe.decay * head.weights)
        score = f1(_pass(held, head, weight)[1])
        if score > state["f1"]:
            best, state["f1"], state["at"] = head.weights.copy(), score, step
        state |= {"epoch": step, "weights": head.weights.tolist(), "m": m.tolist(), "v": v.tolist(), "best": best.tolist()}
        kept.save(state)
        done += 1
    kept.drop()
    return Head(best, head.mean, head.spread)


def predict(rows: DataFrame, head: Head) -> DataFrame:
    """Adds prob_daninha and pred, by Arrow batches."""
    @F.pandas_udf("prob_daninha double, pred int")
    def judged(features: pd.Series) -> pd.DataFrame:
        logits = head.logits(np.asarray(features.tolist(), np.float64))
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        return pd.DataFrame({"prob_daninha": p[:, 1], "pred": logits.argmax(1).astype("int32")})

    return rows.withColumn("judged", judged("features")).select("*", "judged.*").drop("judged")


def fit(rows: DataFrame, held: DataFrame, weights: DataFrame, checkpoint: str | None = None):
    """For cycle.crop_audit: a function that adds the predictions of a head trained on rows."""
    head = train(rows, held, weights, checkpoint)
    return lambda crops: predict(crops, head)
