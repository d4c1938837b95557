"""SVD++ factors of a rating graph, by batch gradient steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.operators.skew import HEAVY_ROWS, lookup_join
from sightline.session import cut


def _seeded(rank: int, seed: int, kind: str) -> Column:
    """Small start values fixed by vertex, position and seed."""
    grain = 10_000
    cells = [
        F.pmod(F.xxhash64("id", F.lit(kind), F.lit(k), F.lit(seed)), F.lit(grain)) for k in range(rank)
    ]
    return F.array(*[(c / float(grain) - 0.5) * 0.2 for c in cells])


def _moved(values: str, gradient: str, rate: float, decay: float) -> Column:
    return F.zip_with(values, gradient, lambda x, g: x + rate * (g - decay * x))


def svd_plus_plus(
    graph,
    rank: int = 10,
    maxIter: int = 2,
    minValue: float = 0.0,
    maxValue: float = 5.0,
    gamma1: float = 0.007,
    gamma2: float = 0.007,
    gamma6: float = 0.005,
    gamma7: float = 0.015,
    rating: str = "weight",
    seed: int = 0,
    min_heavy: int = HEAVY_ROWS,
) -> tuple[DataFrame, list[float]]:
    """Factors of sources and targets of rated edges, and the loss before each step.

    Predictions are mean + source bias + target bias + q . (p + |N|^-1/2 sum y),
    held within the given bounds. A step follows the mean gradient over the
    edges of a vertex, so its length does not grow with their number. The
    result has ``id``, ``kind`` (source or target), the factors ``column1``, the
    implicit factors ``column2`` (targets only), the bias ``column3`` and the
    norm ``column4``. The loss is the mean squared error.
    """
    edges = cut(graph.edges.select("src", "dst", F.col(rating).cast("double").alias("r")))
    mean, size = edges.agg(F.avg("r"), F.count("*")).first()
    if mean is None:
        raise ValueError("the graph has no rated edges")

    def side(end: str) -> DataFrame:
        own = edges.groupBy(F.col(end).alias("id")).agg(
            (F.avg("r") - mean).alias("bias"), (1.0 / F.sqrt(F.count("*"))).alias("norm")
        )
        return own.withColumns(
            {"f": _seeded(rank, seed, end), "y": _seeded(rank, seed, f"{end}:implicit")}
        )

    sources, targets = cut(side("src").drop("y")), cut(side("dst"))
    losses = []
    for _ in range(maxIter):
        implied = lookup_join(
            edges.select("src", "dst"),
            targets.select(F.col("id").alias("dst"), "y"),
            "dst",
            min_rows=min_heavy,
            at_most=size,
        )
        sums = implied.groupBy(F.col("src").alias("id")).agg(
            F.array(*[F.sum(F.col("y")[k]) for k in range(rank)]).alias("ys")
        )
        full = F.zip_with("f", F.transform("ys", lambda v: v * F.col("norm")), lambda x, v: x + v)
        users = sources.join(sums, "id").select(
            F.col("id").alias("src"), full.alias("p"), F.col("bias").alias("bu"), F.col("norm").alias("nu")
        )
        items = targets.select(F.col("id").alias("dst"), F.col("f").alias("q"), F.col("bias").alias("bi"))
        rated = lookup_join(edges, users, "src", min_rows=min_heavy, at_most=size)
        rated = lookup_join(
            rated, items, "dst", min_rows=min_heavy, at_most=size, counted=edges
        )
        dot = F.aggregate(F.zip_with("p", "q", lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
        guess = F.lit(mean) + F.col("bu") + F.col("bi") + dot
        guess = F.greatest(F.lit(minValue), F.least(F.lit(maxValue), guess))
        rated = rated.withColumn("err", F.col("r") - guess)

        def message(end: str, factors: str, implicit: Column) -> Column:
            pull = F.transform(factors, lambda v: v * F.col("err"))
            return F.struct(
                F.lit(end).alias("kind"), F.col(end).alias("id"), F.col("err").alias("err"),
                pull.alias("g"), implicit.alias("gy"),
            )

        # Both ends learn from one pass over the rated edges.
        messages = rated.select(
            F.inline(
                F.array(
                    message("src", "q", F.lit(0.0)),
                    message("dst", "p", F.col("err") * F.col("nu")),
                )
            )
        )
        slopes = cut(
            messages.groupBy("kind", "id").agg(
                F.avg("err").alias("e"),
                F.avg("gy").alias("ey"),
                F.array(*[F.avg(F.col("g")[k]) for k in range(rank)]).alias("g"),
                F.sum(F.col("err") * F.col("err")).alias("sq"),
                F.count("*").alias("n"),
            )
        )
        total = slopes.where(F.col("kind") == "src").agg(F.sum("sq"), F.sum("n")).first()
        losses.append(total[0] / total[1])
        bias = (F.col("bias") + gamma1 * (F.col("e") - gamma6 * F.col("bias"))).alias("bias")
        f = _moved("f", "g", gamma2, gamma7).alias("f")
        of = {
            kind: slopes.where(F.col("kind") == kind).select("id", "e", "ey", "g")
            for kind in ("src", "dst")
        }
        sources = cut(sources.join(of["src"], "id").select("id", bias, "norm", f))
        gy = F.transform("f", lambda v: v * F.col("ey"))
        y = F.zip_with("y", gy, lambda v, g: v + gamma2 * (g - gamma7 * v)).alias("y")
        targets = cut(targets.join(of["dst"], "id").select("id", bias, "norm", f, y))

    def shown(frame: DataFrame, kind: str, implicit: Column) -> DataFrame:
        return frame.select(
            "id",
            F.lit(kind).alias("kind"),
            F.col("f").alias("column1"),
            implicit.cast("array<double>").alias("column2"),
            F.col("bias").alias("column3"),
            F.col("norm").alias("column4"),
        )

    factors = shown(sources, "source", F.lit(None)).unionByName(
        shown(targets, "target", F.col("y"))
    )
    return factors, losses
