"""Topic distances and map coordinates (V7).

Distances are Jensen-Shannon divergences between the topics' term
distributions; coordinates come from classical scaling of their matrix.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_TOPICS = 2000  # topics of a map: its k x k matrix is scaled on the driver


def topic_distances(terms: DataFrame) -> DataFrame:
    """``topic_a, topic_b, distance`` for every pair a < b of the topics in
    ``terms`` (topic, term_idx, prob).

    A term that one topic alone holds adds prob * ln 2 / 2, so only terms that
    two topics share meet in the join; a term has a topic's row once, so a
    group has k rows at most.  Sums are partial before the exchange; the
    result has k * (k - 1) / 2 rows.
    """
    held = terms.where(F.col("prob") > 0).select("topic", "term_idx", F.col("prob").cast("double").alias("prob"))
    a = held.select(F.col("topic").alias("topic_a"), "term_idx", F.col("prob").alias("p"))
    b = held.select(F.col("topic").alias("topic_b"), F.col("term_idx").alias("b_idx"), F.col("prob").alias("q"))
    shared = a.join(b, (F.col("term_idx") == F.col("b_idx")) & (F.col("topic_a") < F.col("topic_b")))
    middle = (F.col("p") + F.col("q")) / 2
    gain = F.col("p") * F.log(F.col("p") / middle) + F.col("q") * F.log(F.col("q") / middle)
    both = shared.groupBy("topic_a", "topic_b").agg(F.sum(gain).alias("gain"), F.sum(F.col("p") + F.col("q")).alias("common"))
    mass = held.groupBy("topic").agg(F.sum("prob").alias("mass"))
    # one row of k topics, opened into the pairs that the result has
    one = mass.agg(F.array_sort(F.collect_list(F.struct("topic", "mass"))).alias("all"))
    firsts = one.select("all", F.posexplode("all").alias("i", "a"))
    pairs = firsts.select("a", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b")).select(
        F.col("a.topic").alias("a"), F.col("a.mass").alias("mass_a"), F.col("b.topic").alias("b"), F.col("b.mass").alias("mass_b")
    )
    joined = pairs.join(both, (F.col("a") == F.col("topic_a")) & (F.col("b") == F.col("topic_b")), "left")
    alone = F.col("mass_a") + F.col("mass_b") - F.coalesce("common", F.lit(0.0))
    distance = (F.coalesce("gain", F.lit(0.0)) + F.log(F.lit(2.0)) * alone) / 2
    return joined.select(F.col("a").alias("topic_a"), F.col("b").alias("topic_b"), F.greatest(distance, F.lit(0.0)).alias("distance"))


def classical_scaling(distances: np.ndarray, dimensions: int = 2) -> np.ndarray:
    """Points whose squared distances come closest to those of the matrix:
    leading eigenvectors of the doubly centred squares.  An axis points to its
    largest coordinate; axes without spread are zero."""
    squares = -0.5 * distances**2
    centred = squares - squares.mean(axis=0) - squares.mean(axis=1)[:, None] + squares.mean()
    values, vectors = np.linalg.eigh(centred)
    out = np.zeros((len(distances), dimensions))
    for axis, k in enumerate(np.argsort(values)[::-1][:dimensions]):
        if values[k] > 1e-15:
            line = vectors[:, k] * np.sqrt(values[k])
            out[:, axis] = line * (1 if line[np.argmax(np.abs(line))] > 0 else -1)
    return out


def topic_map(distances: DataFrame, prevalence: DataFrame) -> DataFrame:
    """``topic, x, y, prevalence, size_rank``: the map's circles, ranked by
    ``prevalence`` (topic, prevalence), ties by topic.

    The k x k matrix is scaled on the driver: k is a model parameter
    (``MOST_TOPICS`` at most), whatever the corpus.
    """
    sizes = prevalence.select("topic", "prevalence").limit(MOST_TOPICS + 1).collect()
    if len(sizes) > MOST_TOPICS:
        raise ValueError(f"a topic map has at most {MOST_TOPICS} topics")
    topics = sorted(r["topic"] for r in sizes)
    place = {t: i for i, t in enumerate(topics)}
    matrix = np.zeros((len(topics), len(topics)))
    for r in distances.collect():
        matrix[place[r["topic_a"]], place[r["topic_b"]]] = matrix[place[r["topic_b"]], place[r["topic_a"]]] = r["distance"]
    points = classical_scaling(matrix)
    size = {r["topic"]: r["prevalence"] for r in sizes}
    by_size = sorted(topics, key=lambda t: (-(size[t] or 0.0), t))
    rank = {t: i + 1 for i, t in enumerate(by_size)}
    rows = [(int(t), float(points[place[t], 0]), float(points[place[t], 1]), size[t], rank[t]) for t in topics]
    return distances.sparkSession.createDataFrame(rows, "topic int, x double, y double, prevalence double, size_rank int")
