"""What the classifiers share: the held-out fold, bounded training samples, Adam."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: str = "doc_id"):
    """crc32(doc_id as text) mod 5 is 0; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def sample_by_class(rows: DataFrame, label: str, key: str | list[str], per_class: int) -> DataFrame:
    """At most ``per_class`` distinct rows of each class, those with the least hash of
    ``key``: the same rows on every run. Repeated rows count once and a null key is a
    key. A first filter by hash, at the rate that a class's number of keys asks for,
    leaves a few times as many rows as are wanted, so no task gathers a class as a whole."""
    keys = [key] if isinstance(key, str) else key
    order = F.xxhash64(*keys, F.lit(7))
    rates = rows.groupBy(label).agg(F.least(F.lit(1.0), F.lit(4.0 * per_class + 100) / F.approx_count_distinct(order)).alias("_rate"))
    near = rows.join(F.broadcast(rates), label).where(F.pmod(order, F.lit(1 << 40)) < F.col("_rate") * float(1 << 40)).drop("_rate").distinct()
    turn = F.row_number().over(Window.partitionBy(label).orderBy(F.pmod(order, F.lit(1 << 40)), *keys))
    return near.withColumn("_turn", turn).where(F.col("_turn") <= per_class).drop("_turn")


class Adam:
    """Adam's update for a dictionary of arrays, in place."""

    def __init__(self, params: dict[str, np.ndarray], rate: float = 3e-3, decay: float = 0.0):
        self.params, self.rate, self.decay, self.t = params, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = g + self.decay * self.params[k]
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            self.params[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(self.params[k].dtype)
