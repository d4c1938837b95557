"""Near copies among vectors by PCA-ordered tiled comparison.

Unit vectors are turned to their principal axes. A tree over the leading
coordinates and the norm of the rest deals them into tiles, and two tiles meet
only if their boxes come close enough. Within a pair of tiles, blocks accumulate
products over the leading coordinates first. What the rest can still add is at
most the product of the suffix norms, so most pairs stop after a few coordinates.

Links stay where they are found: a task reports for each vector how many links
it met and the first vector of its group there, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.components import components
from sightline.llm.sums import finite, lists, matrix, summed, usual_length
from sightline.session import cut

COSINE = 0.95
# Coordinates after which a block looks whether pairs can still reach the cosine.
STAGES = (8, 16, 32)
# Vectors in a tile, and in a block that is compared at once.
TILE_VALUES = 1 << 19
MOST_TILE, LEAST_TILE = 8192, 2048
BLOCK = 1024
# The tree is fitted on so many vectors and has so many leaves at most. Fuller leaves give several tiles.
FIT_ROWS = 16_384
MOST_DEPTH = 12
# Rounding that bounds allow for; products this near to the cosine are taken again, term by term.
SLACK = 1e-9


def units(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, u): every row with its unit vector, null if the row cannot link.

    A row can link if it has an id and its vector is neither null, empty nor
    zero, holds no null or non-finite entry and has the most frequent length.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    able = F.col("vec_id").isNotNull() & finite("v") & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(able, F.col("v")))
    rows = rows.withColumn("v", F.when(F.size("v") == usual_length(rows.where("v is not null"), "v"), F.col("v")))
    # By the largest entry first, so that squares neither overflow nor vanish.
    rows = rows.withColumn("m", F.array_max(F.transform("v", lambda x: F.abs(x))))
    rows = rows.withColumn("v", F.transform("v", lambda x: x / F.col("m")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.withColumn("m", norm).select("vec_id", F.transform("v", lambda x: x / F.col("m")).alias("u"))


def axes(entries: DataFrame, width: int) -> np.ndarray:
    """Principal axes as columns, from one pass that sums the second moments."""

    def part(batch: pa.RecordBatch) -> np.ndarray:
        u = matrix(batch.column("u"), width)
        return (u.T @ u).reshape(-1)

    return np.linalg.eigh(summed(entries, part, width * width).reshape(width, width))[1][:, ::-1].copy()


def leading(y: np.ndarray) -> np.ndarray:
    """The leading coordinates and the norm of the rest; distances here are at most those of the vectors."""
    first = STAGES[0]
    return np.column_stack([y[:, :first], np.sqrt(np.square(y[:, first:]).sum(axis=1))])


class Tree:
    """Median splits by the widest leading coordinate, as arrays in heap order."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.at = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        inside = {1: points}
        for node in range(1, 1 << depth):
            mine = inside.pop(node)
            if len(mine):
                self.axis[node] = int(np.argmax(mine.var(axis=0)))
                self.at[node] = np.median(mine[:, self.axis[node]])
            right = mine[:, self.axis[node]] > self.at[node]
            inside[2 * node], inside[2 * node + 1] = mine[~right], mine[right]

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - (1 << self.depth)


def boxes_meet(box: np.ndarray, others: np.ndarray, cosine: float) -> np.ndarray:
    """Which boxes (lows, then highs) come close enough to ``box`` for a link."""
    half = len(box) // 2
    gap = np.maximum(0, np.maximum(others[:, :half] - box[half:], box[:half] - others[:, half:]))
    return np.square(gap).sum(axis=1) <= 2 - 2 * cosine + SLACK


def reaching(a: np.ndarray, b: np.ndarray, cosine: float, above: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all rows of two blocks whose product is ``cosine`` or more.

    ``above`` asks for i < j only, where both blocks are one.
    """
    ends = [s for s in STAGES if s < a.shape[1]] + [a.shape[1]]
    rest = [[np.sqrt(np.square(x[:, e:]).sum(axis=1)) for e in ends] for x in (a, b)]
    sums, start, k = np.zeros((len(a), len(b))), 0, 0
    while True:
        sums += a[:, start : ends[k]] @ b[:, start : ends[k]].T
        alive = sums + np.outer(rest[0][k], rest[1][k]) >= cosine - SLACK
        if above:
            alive = np.triu(alive, 1)
        start, k = ends[k], k + 1
        left = np.count_nonzero(alive)
        if k == len(ends) or 4 * left < alive.size:
            break
    i, j = np.nonzero(alive)
    sums = sums[i, j]
    while k < len(ends) and len(i):
        sums += np.einsum("ij,ij->i", a[i, start : ends[k]], b[j, start : ends[k]])
        alive = sums + rest[0][k][i] * rest[1][k][j] >= cosine - SLACK
        i, j, sums = i[alive], j[alive], sums[alive]
        start, k = ends[k], k + 1
    close = np.abs(sums - cosine) < 2 * SLACK
    sums[close] = np.einsum("ij,ij->i", a[i[close]], b[j[close]])
    return i[sums >= cosine], j[sums >= cosine]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking ``i`` with ``j``; a label is the least position of its group."""
    while True:
        x, y = label[i], label[j]
        apart = x != y
        if not apart.any():
            return label
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def met(table: pa.Table, width: int, cosine: float) -> pa.Table:
    """(key, links, root) of the vectors of two tiles, or of one, that link there."""
    table = table.sort_by([("side", "ascending"), ("key", "ascending")])
    y, key = matrix(table.column("y"), width), table.column("key").to_numpy()
    n, side = table.column("n").to_numpy(), table.column("side").to_numpy()
    links, label = np.zeros(len(key), np.int64), np.arange(len(key))
    first = int((side == 0).sum())
    own = first == len(key)
    for at in range(0, first, BLOCK):
        until = min(at + BLOCK, first)
        for to in range(at if own else first, len(key), BLOCK):
            i, j = reaching(y[at:until], y[to : to + BLOCK], cosine, own and to == at)
            if len(i):
                i, j = i + at, j + to
                # Counts of rows, far below the 2^53 that doubles hold.
                links += np.bincount(i, weights=n[j], minlength=len(key)).astype(np.int64)
                links += np.bincount(j, weights=n[i], minlength=len(key)).astype(np.int64)
                label = joined(label, i, j)
    some = links > 0
    return pa.table({"key": key[some], "links": links[some], "root": key[label[some]]})


def link(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Rows that cannot link (see ``units``) have no links and are their own
    component; a null id stays null and is kept. Equal unit vectors are compared
    once, however many rows hold them, and link with each other. Rows with one id
    are rows of their own. Products are taken on the principal axes, which agree
    with those of the vectors to about 1e-15. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    every = cut(units(vectors, id_column, vector_column))
    alone = every.where("u is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rows = every.where("u is not null")
    width = usual_length(rows, "u")
    found = rows.groupBy("u").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    # Written before use, so a key stays what it is.
    entries = cut(found.withColumn("key", F.monotonically_increasing_id()))
    count = entries.count()
    if not count:
        return alone.withColumn("kept", F.lit(True))
    tile = int(np.clip(TILE_VALUES // width, LEAST_TILE, MOST_TILE))
    turn = axes(entries, width)
    depth = int(np.clip(np.ceil(np.log2(count / tile)), 0, MOST_DEPTH))
    share = min(1 << 20, int((1 << 20) * FIT_ROWS / count))
    sample = entries.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share).select("u").toArrow()
    tree = Tree(leading(matrix(sample.column("u"), width) @ turn), depth)

    def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Row by row, so that a vector's coordinates do not depend on its batch.
            y = np.einsum("ij,jk->ik", matrix(batch.column("u"), width), turn)
            lead = leading(y)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), pa.array(tree.leaf(lead), pa.int32()), lists(lead), lists(y)],
                ["key", "n", "leaf", "lead", "y"],
            )

    placed = cut(entries.mapInArrow(turned, "key long, n long, leaf int, lead array<double>, y array<double>"))
    sizes = np.zeros(1 << tree.depth, np.int64)
    for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect():
        sizes[r["leaf"]] = r["n"]
    pieces = np.maximum(1, -(-sizes // tile))
    before = np.r_[0, np.cumsum(pieces)[:-1]]

    # One row for each leaf, at most 2 ** MOST_DEPTH.
    leaves = spark.createDataFrame(list(enumerate(zip(before.tolist(), pieces.tolist(), strict=True))), "leaf int, at struct<first long, n long>")
    spread = F.col("at.first") + F.pmod(F.xxhash64("key"), F.col("at.n"))
    tiled = placed.join(F.broadcast(leaves), "leaf").select(spread.alias("tile"), "key", "n", "lead", "y")
    ends = [f(F.get("lead", F.lit(c))) for f in (F.min, F.max) for c in range(min(STAGES[0], width) + 1)]
    # One box for some thousand vectors reaches the driver.
    held = sorted(tiled.groupBy("tile").agg(F.array(*ends).alias("box")).collect())
    names = np.array([r["tile"] for r in held], np.int64)
    boxes = np.array([r["box"] for r in held])

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                others = np.flatnonzero(boxes_meet(boxes[k], boxes[k:], cosine)) + k
                pair = others + k * len(names)
                both = np.r_[np.full(len(others), k), others[others != k]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[both]),
                        pa.array(np.r_[pair, pair[others != k]]),
                        pa.array(np.r_[np.zeros(len(others)), np.ones((others != k).sum())].astype(np.int32)),
                    ],
                    ["tile", "pair", "side"],
                )

    pairs = spark.range(len(names)).mapInArrow(partners, "tile long, pair long, side int")
    visits = tiled.drop("lead").join(pairs, "tile").drop("tile")

    def compare(table: pa.Table) -> pa.Table:
        return met(table, width, cosine)

    compared = cut(visits.groupBy("pair").applyInArrow(compare, "key long, links long, root long"))
    links = compared.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(compared.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")))
    grouped = cut(entries.select("key", "least").join(roots, "key"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("first"))
    linked = grouped.join(smallest, "root").join(links, "key").select("key", "first", "links")
    known = entries.join(linked, "key", "left").select(
        "u", F.coalesce("first", "least").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    some = rows.join(known, "u").select("vec_id", "n_links", "component_id")
    return some.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
