"""Functions around training: schedules, probabilities, class weights, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.geometry import col


def learning_rate(epoch: Column | str, warmup: int, epochs: int) -> Column:
    """Factor of the base rate: a linear rise, then half a cosine."""
    epoch = col(epoch)
    progress = F.least(F.greatest((epoch - warmup) / max(epochs - warmup, 1), F.lit(0.0)), F.lit(1.0))
    fall = 0.5 * (1 + F.cos(F.pi() * progress))
    return F.when(epoch < warmup, (epoch + 1) / warmup).otherwise(fall) if warmup > 0 else fall


def softmax(logits: Column | str) -> Column:
    logits = col(logits)
    raised = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def argmax(values: Column | str) -> Column:
    """Index from 0 of the first greatest value."""
    values = col(values)
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def class_weight(total: Column, count: Column, classes: int = 2, low: float = 0.1, high: float = 20.0) -> Column:
    """Inverse frequency, held within limits; an absent class counts once."""
    return F.least(F.greatest(total / (classes * F.greatest(count, F.lit(1))), F.lit(low)), F.lit(high))


def metric(metrics: Column, mask: str, box: str) -> Column:
    """The mask metric, else the box metric, else 0."""
    return F.coalesce(F.try_element_at(metrics, F.lit(mask)), F.try_element_at(metrics, F.lit(box)), F.lit(0.0))
