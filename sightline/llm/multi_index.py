"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in two halves, each quantised with its own centroids, so that k
centroids a half give k * k cells. A query goes through pairs of centroids by
summed distance with a heap until the cells hold its share of entries, and these
are reranked by the exact inner product. The share is chosen by measured recall.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.session import cut

NEAREST = 20
# Rows that the centroids are fitted on, and queries that the share is measured on.
FIT_ROWS = 20_000
MEASURED = 128
MOST_CENTROIDS = 128
RECALL = 0.96
# Entries and queries that one task holds and compares at a time.
BLOCK, QUERY_BLOCK = 16_384, 16_384
# Products, pairs scored exactly, routes and found rows held at once.
PRODUCTS_AT_ONCE, PAIRS_AT_ONCE, ROUTES_AT_ONCE, FOUND_AT_ONCE = 1 << 20, 1 << 15, 1 << 12, 1 << 18
# Queries of one task that chooses cells, which is plain Python.
ROUTED_BY_TASK = 512
_SHARES = (0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): rows with an id and a non-zero vector of finite components.

    Where lengths differ, vectors of the most frequent even length take part, the
    shorter one at a tie.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 1))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Plain k-means, seeded by spread rows; empty centroids stay where they are."""
    found = x[np.unique(np.linspace(0, len(x) - 1, k).astype(int))].copy()
    for _ in range(rounds):
        near = np.argmin((found**2).sum(1) - 2 * x @ found.T, axis=1)
        counts = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, x)
        found[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return found


def quantise(x: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """Cell of every vector."""
    half = x.shape[1] // 2
    near = [
        np.argmin((book**2).sum(1) - 2 * part @ book.T, axis=1)
        for part, book in zip((x[:, :half], x[:, half:]), books, strict=True)
    ]
    return near[0] * len(books[1]) + near[1]


def traverse(query: np.ndarray, books: list[np.ndarray], counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of summed distance until they hold ``wanted`` entries.

    The distance of a centroid is its negative inner product with the query's
    half. The heap holds the frontier of pairs: (i, j) lets in (i + 1, j), and
    (i, j + 1) where i is 0.
    """
    half = len(query) // 2
    far = [-(book @ part) for book, part in zip(books, (query[:half], query[half:]), strict=True)]
    order = [np.argsort(f, kind="stable") for f in far]
    heap = [(far[0][order[0][0]] + far[1][order[1][0]], 0, 0)]
    cells, held = [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(order[0][i] * len(books[1]) + order[1][j])
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if i + 1 < len(order[0]):
            heapq.heappush(heap, (far[0][order[0][i + 1]] + far[1][order[1][j]], i + 1, j))
        if i == 0 and j + 1 < len(order[1]):
            heapq.heappush(heap, (far[0][order[0][0]] + far[1][order[1][j + 1]], 0, j + 1))
    return cells


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy()
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 2))


def _best(ids: np.ndarray, queries: np.ndarray, entries: np.ndarray, x: np.ndarray, top: int):
    """The ``top`` entries of every query: positions of queries, entry ids, scores."""
    scores = queries @ x.T
    keep = min(top, x.shape[0])
    cut_off = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
    # A hair below, so that products that only rounding tells apart all stay.
    q, e = np.nonzero(scores >= (cut_off - 1e-9 * np.abs(cut_off) - 1e-12)[:, None])
    # The order of summation of a matrix product depends on its shape; these do not.
    exact = np.empty(len(q))
    for at in range(0, len(q), PAIRS_AT_ONCE):
        some = slice(at, at + PAIRS_AT_ONCE)
        exact[some] = np.einsum("ij,ij->i", queries[q[some]], x[e[some]])
    return ids[q], entries[e], exact


def search(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    share: float | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``nearest`` found for every query.

    Equal scores go by smaller vec_id, and a query is no neighbour of its own id.
    Equal vectors are one entry that lists the smallest ids, as many as a query
    can use, so a vector that many rows share costs no more than one. Of rows
    with one id and one vector one takes part. Where cells hold fewer than
    ``nearest`` entries, all that exist are returned.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = cut(usable(vectors, id_column, vector_column))
    asked = cut(usable(queries, id_column, vector_column).dropDuplicates(["vec_id"]))
    count = rows.count()
    if not count or asked.isEmpty():
        return empty
    ids = F.slice(F.sort_array(F.collect_set("vec_id")), 1, nearest + 1)
    few = rows.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(256)).alias("_part")).agg(ids.alias("ids"))
    ids = F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, nearest + 1)
    entries = few.groupBy("v").agg(ids.alias("ids"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("v").toArrow()
    x = _matrix(sample.column("v"))
    half = x.shape[1] // 2
    k = int(np.clip(np.sqrt(np.sqrt(count)) * 2, 2, MOST_CENTROIDS))
    books = [centroids(x[:, :half], min(k, len(x))), centroids(x[:, half:], min(k, len(x)))]
    cells = len(books[0]) * len(books[1])

    def filed(batches):
        for batch in batches:
            cell = quantise(_matrix(batch.column("v")), books)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), batch.column("ids"), batch.column("v")], ["cell", "ids", "v"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    index = cut(entries.mapInArrow(filed, f"cell int, ids array<{kind}>, v array<double>"))
    # One number for each cell, of which there are at most MOST_CENTROIDS squared.
    sizes = np.zeros(cells, np.int64)
    for r in index.groupBy("cell").agg(F.count("*").alias("n")).collect():
        sizes[r["cell"]] = r["n"]
    if share is None:
        share = _measured_share(index, asked, books, sizes, nearest)
    wanted = max(nearest + 1, int(np.ceil(share * sizes.sum())))
    # Cells with the same first centroid are one group, which a query visits as a whole: its vector
    # moves once for each group and not for each cell.
    width = len(books[1])
    blocks = np.maximum(1, -(-sizes.reshape(-1, width).sum(axis=1) // BLOCK))
    n_asked = asked.count()
    parts = -(-n_asked // QUERY_BLOCK)

    pieces = spark.createDataFrame(pd.DataFrame({"group": np.arange(len(blocks)), "blocks": blocks}), "group int, blocks int")
    # At most MOST_CENTROIDS rows. Entries are repeated for each part of the queries, so that a task holds few of both.
    dealt = index.withColumn("group", F.floor(F.col("cell") / width).cast("int")).join(F.broadcast(pieces), "group").select(
        "group",
        F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "cell",
        "ids",
        "v",
    )
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    # A query takes milliseconds to route, and a small table is one file.
    visits = asked.repartition(-(-n_asked // ROUTED_BY_TASK)).mapInArrow(
        _router(books, sizes, wanted, blocks), f"vec_id {kind}, v array<double>, group int, block int, cells array<int>"
    )
    visits = visits.select(part, "*")

    keys = ("group", "block", "part")
    found = visits.groupBy(*keys).cogroup(dealt.groupBy(*keys))
    found = found.applyInArrow(_reranker(nearest), "query_id long, vec_id long, score double")
    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _router(books: list[np.ndarray], counts: np.ndarray, wanted: int, blocks: np.ndarray):
    """Queries to one row for each group they visit and block of it, in batches of bounded size."""
    width = len(books[1])

    def routed(batches):
        def routes(batch, who, groups, which, cells):
            columns = [batch.column(c).take(pa.array(who, pa.int64())) for c in ("vec_id", "v")]
            columns += [pa.array(groups, pa.int32()), pa.array(which, pa.int32()), pa.array(cells, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "group", "block", "cells"])

        for batch in batches:
            found = ([], [], [], [])
            for k, vector in enumerate(_matrix(batch.column("v"))):
                cells = np.sort(np.array(traverse(vector, books, counts, wanted), np.int32))
                for some in np.split(cells, np.flatnonzero(np.diff(cells // width)) + 1):
                    group = int(some[0]) // width
                    for b in range(blocks[group]):
                        for column, value in zip(found, (k, group, b, some), strict=True):
                            column.append(value)
                if len(found[0]) >= ROUTES_AT_ONCE:
                    yield routes(batch, *found)
                    found = ([], [], [], [])
            if found[0]:
                yield routes(batch, *found)

    return routed


def _reranker(nearest: int):
    """Queries and entries of one group to the ``nearest`` entries of every query, cell by cell."""

    def reranked(left: pa.Table, right: pa.Table) -> pa.Table:
        out, held = [_found([], [], [])], 0
        if left.num_rows and right.num_rows:
            who, vectors, x = left.column("vec_id").to_numpy(), _matrix(left.column("v")), _matrix(right.column("v"))
            lists = right.column("ids").combine_chunks()
            sizes, ids = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            asking = left.column("cells").combine_chunks()
            row = np.repeat(np.arange(len(who)), np.diff(asking.offsets.to_numpy()))
            cell, asked_cell = right.column("cell").to_numpy(), asking.flatten().to_numpy()
            for one in np.unique(cell):
                entries, rows = np.flatnonzero(cell == one), row[asked_cell == one]
                at_once = max(1, PRODUCTS_AT_ONCE // len(entries))
                for at in range(0, len(rows), at_once):
                    some = rows[at : at + at_once]
                    q, e, score = _best(who[some], vectors[some], entries, x[entries], nearest + 1)
                    n = sizes[e]
                    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    q, e, score = np.repeat(q, n), ids[np.repeat(starts[e], n) + within], np.repeat(score, n)
                    other = q != e
                    out.append(_found(q[other], e[other], score[other]))
                    held += out[-1].num_rows
                    if held > FOUND_AT_ONCE:
                        out = [_first(pa.concat_tables(out), nearest)]
                        # What is left is at most `nearest` for each query; as much again may come before the next turn.
                        held = -out[0].num_rows
        return _first(pa.concat_tables(out), nearest)

    return reranked


def _found(query, entry, score) -> pa.Table:
    columns = [pa.array(query, pa.int64()), pa.array(entry, pa.int64()), pa.array(score, pa.float64())]
    return pa.table(columns, ["query_id", "vec_id", "score"])


def _first(table: pa.Table, top: int) -> pa.Table:
    """The first ``top`` rows of every query by score and id."""
    q, e, s = (table.column(c).to_numpy() for c in ("query_id", "vec_id", "score"))
    if not len(q):
        return table
    order = np.lexsort((e, -s, q))
    q = q[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    place = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return table.take(pa.array(order[place < top]))


def _measured_share(index: DataFrame, asked: DataFrame, books: list, sizes: np.ndarray, nearest: int) -> float:
    """The least share of entries at which sampled queries reach the recall sought.

    The sampled queries are compared with every entry, a bounded set against all
    rows in blocks. Each of their true neighbours then tells at which share the
    traversal reaches its cell.
    """
    some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(MEASURED).select("vec_id", "v").toArrow()
    who, queries = some.column("vec_id").to_numpy(), _matrix(some.column("v"))

    def compared(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            q, e, score = _best(np.arange(len(who)), queries, np.arange(len(x)), x, nearest + 1)
            cells = batch.column("cell").to_numpy()
            first = np.array([ids[0] for ids in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(first[e], pa.int64()), pa.array(score), pa.array(cells[e], pa.int32())],
                ["query", "vec_id", "score", "cell"],
            )

    found = index.mapInArrow(compared, "query long, vec_id long, score double, cell int")
    place = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("_rank", F.row_number().over(place)).where(F.col("_rank") <= nearest + 1).collect()
    reached = []
    for k in range(len(who)):
        order = traverse(queries[k], books, sizes, int(sizes.sum()))
        upto = np.cumsum(sizes[order]) - sizes[order]
        at = dict(zip(order, upto / max(1, sizes.sum()), strict=True))
        reached += [at[r["cell"]] for r in best if r["query"] == k and r["vec_id"] != who[k]]
    reached = np.array(reached)
    return next((s for s in _SHARES if not len(reached) or (reached < s).mean() >= RECALL), 1.0)
