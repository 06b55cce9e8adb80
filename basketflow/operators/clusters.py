"""k-means whose result does not depend on how the rows lie, and a model that can be kept.

Starting centres come from the rows with the smallest hashes of their key, a sample that is the same
under any number of partitions; k-means++ picks among them. Rounds then go over all rows. Features
are scaled and fixed to a millionth, so that sums are whole numbers: they come out the same in any
order of addition, and with them the centres.

A round is one aggregate of k rows. Its centres are constants of the next, so nothing is broadcast and
no row leaves generated code.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 20         # as many as the usual default
TOLERANCE = 1e-4    # centres that move less have settled
SAMPLE = 2000       # rows that starting centres are picked from
UNIT = 1_000_000    # parts of a scaled feature that are told apart


@dataclass(frozen=True)
class Clusters:
    """Features (SQL), their means and deviations, and the centres in scaled terms."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]

    def scaled(self) -> list[str]:
        return [_scaled(f, m, d) for f, m, d in zip(self.features, self.means, self.deviations)]

    def distances(self) -> list[str]:
        """Squared distance to each centre."""
        return _distances(self.scaled(), self.centres)

    def nearest(self) -> str:
        """Number of the nearest centre, the first of equally near ones."""
        return _nearest(self.distances())

    def clustered(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("cluster_id", F.expr(self.nearest()))

    def pipeline(self, names: list[str] | None = None) -> PipelineModel:
        """A Spark ML model to save and load: adds ``cluster_id``, and the clusters' names if given."""
        columns = [f"{self.nearest()} AS cluster_id"]
        stages = [_stage(columns)]
        if names:
            listed = ", ".join("'" + n.replace("'", "\\'") + "'" for n in names)
            stages.append(_stage([f"element_at(array({listed}), cluster_id + 1) AS segment"]))
        return PipelineModel(stages)


def _stage(columns: list[str]) -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _scaled(feature: str, mean: float, deviation: float) -> str:
    """Whole millionths of a deviation from the mean; 0 for a feature that never varies."""
    if not deviation:
        return "0D"
    return f"rint(({feature} - {mean!r}D) / {deviation!r}D * {UNIT}D)"


def _distances(scaled: list[str], centres) -> list[str]:
    return ["(" + " + ".join(f"pow({s} / {UNIT}D - ({x!r}D), 2D)" for s, x in zip(scaled, c)) + ")"
            for c in centres]


def _nearest(distances: list[str]) -> str:
    if len(distances) == 1:
        return "0"
    every = ", ".join(distances)
    return f"CAST(array_position(array({every}), least({every})) - 1 AS INT)"


def _spread(rows: DataFrame, features: list[str]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Mean and sample deviation of each feature, from exact decimal sums."""
    fixed = [F.expr(f).cast("decimal(18,6)").alias(f"f{i}") for i, f in enumerate(features)]
    row = rows.select(*fixed).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"f{i}").alias(f"s{i}") for i in range(len(features))],
        *[F.sum((F.col(f"f{i}") * F.col(f"f{i}")).cast("decimal(38,12)")).alias(f"q{i}")
          for i in range(len(features))]).first()
    means, deviations = [], []
    for i in range(len(features)):
        if not row.n:
            means.append(0.0)
            deviations.append(0.0)
            continue
        total, squares = row[f"s{i}"], row[f"q{i}"]
        apart = squares - total * total / row.n
        means.append(float(total / row.n))
        deviations.append(float(apart / (row.n - 1)) ** 0.5 if row.n > 1 and apart > 0 else 0.0)
    return tuple(means), tuple(deviations)


def _apart(a, b) -> float:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def _starting(points: list[tuple[float, ...]], k: int, seed: int) -> list[tuple[float, ...]]:
    """k-means++ among sampled points: far ones are likelier, equal ones are picked once."""
    draw = random.Random(seed)
    distinct = sorted(set(points))
    if len(distinct) <= k:
        return distinct
    centres = [points[draw.randrange(len(points))]]
    while len(centres) < k:
        weights = [min(_apart(p, c) for c in centres) for p in points]
        centres.append(draw.choices(points, weights)[0])
    return centres


def fit_clusters(rows: DataFrame, features: list[str], key: str, k: int, seed: int = 42) -> Clusters:
    """Cluster all ``rows``. They are read once a round: pin them if they are dear to make."""
    means, deviations = _spread(rows, features)
    model = Clusters(tuple(features), means, deviations, ())
    scaled = rows.select(key, *[F.expr(s).alias(f"z{i}") for i, s in enumerate(model.scaled())])
    names = [f"z{i}" for i in range(len(features))]
    sample = scaled.orderBy(F.xxhash64(F.lit(seed), key), key).limit(SAMPLE).collect()
    centres = _starting([tuple(r[n] / UNIT for n in names) for r in sample], k, seed)
    for _ in range(ROUNDS if centres else 0):
        own = F.expr(_nearest(_distances(names, centres)))
        groups = scaled.groupBy(own.alias("cluster_id")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col(z).cast("bigint")).alias(z) for z in names])
        moved = list(centres)
        for g in groups.collect():              # k rows
            moved[g.cluster_id] = tuple(g[z] / UNIT / g.n for z in names)
        shift = max(_apart(a, b) for a, b in zip(centres, moved))
        centres = moved
        if shift < TOLERANCE ** 2:
            break
    return Clusters(tuple(features), means, deviations, tuple(centres))
