"""Spelling variants of the words of a corpus, by dense prefix-suffix tiling.

Two words differ by one edit exactly if their common prefix and suffix together
reach the longer length less one. Words of a length and of the one below meet in
tiles: the longer length is cut into three segments, and all words that agree
before and after a segment share its tile. The segment that the common prefix of
a pair ends in is the one tile where the pair counts. Inside, words are rows of
padded matrices of code points, compared block by block.

A tile with too many words is dealt again by single positions. What agrees in
all but one position is at most an alphabet of words, so no tile stays large.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.session import cut

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One code point goes missing from the runs of a document whose hash this divides.
TYPO = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form is so many times as frequent as its variant.
TIMES = 5
SEGMENTS = 3
# Words from which on a tile is dealt again by positions.
FULL = 4096
# Rows of tiles that one task takes at a time, cells and rows of its matrices.
TASK_ROWS = 100_000
CELLS = 1 << 22
DENSE = 32
BLOCK = 256
_GROUPED = "word string, n_near long, best_n long, best string"


def words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): how often each word of at least six code points occurs, from five times on.

    Only A-Z are lower-cased. A null text has no words; a null id hashes as empty.
    """
    folded = F.translate(F.col(text_column), UPPER, LOWER)
    runs = F.explode(F.regexp_extract_all(folded, F.lit(LETTERS), F.lit(0)))
    found = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), runs.alias("run"))
    found = found.where(F.char_length("run") >= LEAST_LENGTH)
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    counts = found.select(F.when(h % TYPO == 0, short).otherwise(F.col("run")).alias("word")).groupBy("word")
    return counts.agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_COUNT) & (F.char_length("word") >= LEAST_LENGTH))


def _tiles(rows: DataFrame, segments: Column) -> DataFrame:
    """A row for each of ``segments`` (longer, first, last), with the tile that the word has there."""
    seg = rows.withColumn("s", F.explode(segments)).select("word", "n", "s.*")
    before = F.substring("word", F.lit(1), F.col("first"))
    after = F.col("longer") - F.col("last")
    behind = F.substring("word", F.char_length("word") - after + 1, after)
    return seg.withColumn("tile", F.xxhash64("longer", "first", "last", before, behind))


def tiles(table: DataFrame) -> DataFrame:
    """(word, n, longer, first, last, tile), full tiles dealt by positions."""

    def third(k: int, longer: Column) -> Column:
        ends = [F.floor(longer * j / SEGMENTS).cast("int") for j in (k, k + 1)]
        return F.struct(longer.alias("longer"), ends[0].alias("first"), ends[1].alias("last"))

    length = F.char_length("word")
    coarse = cut(_tiles(table, F.array(*[third(k, length + d) for d in (0, 1) for k in range(SEGMENTS)])))
    sizes = cut(coarse.groupBy("tile").agg(F.count("*").alias("size")).where("size > 1"))
    single = F.transform(
        F.sequence(F.col("_first"), F.col("_last") - 1),
        lambda p: F.struct(F.col("_longer").alias("longer"), p.alias("first"), (p + 1).alias("last")),
    )
    usual = coarse.join(sizes.where(F.col("size") <= FULL).select("tile"), "tile", "left_semi")
    full = coarse.join(sizes.where(F.col("size") > FULL).select("tile"), "tile", "left_semi")
    full = full.select("word", "n", *[F.col(c).alias(f"_{c}") for c in ("longer", "first", "last")])
    return usual.unionByName(_tiles(full, single))


def _matrices(found: np.ndarray, longer: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, padded behind, and of the words reversed."""
    cells = found.astype(f"<U{longer}").view(np.uint32).reshape(len(found), longer)
    lengths = (cells != 0).sum(axis=1)
    at = lengths[:, None] - 1 - np.arange(longer)
    return cells, np.where(at >= 0, np.take_along_axis(cells, np.maximum(at, 0), axis=1), 0)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two matrices."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def _candidates(tile: np.ndarray, width: int):
    """Positions (i, j) of all pairs within tiles, in blocks; ``tile`` is sorted."""
    starts = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    sizes = np.diff(np.r_[starts, len(tile)])
    step = max(1, CELLS // width)
    # Small tiles: every row with the one s rows on, all tiles at once.
    size = np.repeat(sizes, sizes)
    for s in range(1, min(DENSE, int(sizes.max(initial=0)))):
        i = np.flatnonzero((tile[s:] == tile[:-s]) & (size[s:] <= DENSE))
        for at in range(0, len(i), step):
            yield i[at : at + step], i[at : at + step] + s
    # Larger ones: block by block.
    for start, count in zip(starts[sizes > DENSE], sizes[sizes > DENSE], strict=True):
        for a in range(0, count, BLOCK):
            rows = np.arange(a, min(a + BLOCK, count))
            for b in range(a, count, BLOCK):
                i, j = (x.ravel() for x in np.meshgrid(rows, np.arange(b, min(b + BLOCK, count)), indexing="ij"))
                i, j = (i[i < j], j[i < j]) if a == b else (i, j)
                for at in range(0, len(i), step):
                    yield start + i[at : at + step], start + j[at : at + step]


def _compared(longer: int, tile: np.ndarray, first: np.ndarray, last: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, sorted by tile, that are one edit apart and belong in their tile."""
    ahead, reversed_ = _matrices(found, longer)
    full = ahead[:, -1] != 0
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in _candidates(tile, longer):
        # Pairs of two shorter words have tiles of their own.
        some = full[i] | full[j]
        i, j = i[some], j[some]
        prefix = _common(ahead[i], ahead[j])
        here = (prefix >= first[i]) & (prefix < last[i]) & (first[i] == first[j]) & (last[i] == last[j])
        i, j, prefix = i[here], j[here], prefix[here]
        near = prefix + _common(reversed_[i], reversed_[j]) >= longer - 1
        left.append(i[near])
        right.append(j[near])
    return np.concatenate(left), np.concatenate(right)


def _near(table: pa.Table) -> pa.Table:
    """For each word of a bucket of tiles: near words met there, and the most frequent of these."""
    columns = {c: table.column(c).to_numpy() for c in ("longer", "first", "last", "tile", "n")}
    found = np.array(table.column("word").to_pylist(), object)
    order = np.lexsort((columns["tile"], columns["longer"]))
    found, columns = found[order], {c: v[order] for c, v in columns.items()}
    left, right = [], []
    longer, tile = columns["longer"], columns["tile"]
    fresh = np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]) | (longer[1:] != longer[:-1])]) if len(tile) else np.zeros(0, np.int64)
    upto = np.r_[fresh, len(tile)]
    at = 0
    while at < len(fresh):
        # Whole tiles of one length, as many as the matrices may hold.
        to = at + 1
        width = longer[fresh[at]]
        while to < len(fresh) and longer[fresh[to]] == width and (upto[to + 1] - fresh[at]) * width <= CELLS:
            to += 1
        part = slice(fresh[at], upto[to])
        i, j = _compared(int(width), tile[part], columns["first"][part], columns["last"][part], found[part])
        left.append(i + part.start)
        right.append(j + part.start)
        at = to
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    i, j = np.r_[i, j], np.r_[j, i]
    n = columns["n"]
    # The best near word first: most frequent, then in code-point order.
    order = np.lexsort((found[j].astype(str) if len(j) else j, -n[j], i))
    i, j = i[order], j[order]
    firsts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, np.int64)
    return pa.table(
        {
            "word": pa.array(found[i[firsts]], pa.string()),
            "n_near": pa.array(np.diff(np.r_[firsts, len(i)]), pa.int64()),
            "best_n": pa.array(n[j[firsts]], pa.int64()),
            "best": pa.array(found[j[firsts]], pa.string()),
        }
    )


def near_words(table: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word with near words."""
    dealt = cut(tiles(table))
    spark = table.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), dealt.count() // TASK_ROWS + 1)
    bucketed = dealt.withColumn("bucket", F.pmod("tile", F.lit(buckets)))
    found = bucketed.groupBy("bucket").applyInArrow(_near, _GROUPED)
    # The least of (-n, word) is the most frequent, ties by code points.
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    met = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return met.select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the end of the chain of forms.

    A round doubles the steps taken. Counts grow at least fivefold with each form,
    so chains are short and free of circles.
    """
    found = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = cut(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.drop("moved")


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the corpus.

    Words are those of ``words``. Documents without text add none, repeated rows
    count each, and other columns do not matter. No words, no rows.
    """
    table = cut(words(docs, id_column, text_column))
    near = table.join(near_words(table), "word", "left")
    enough = F.col("best_n") >= TIMES * F.col("n")
    judged = cut(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best")).alias("form"),
            F.when(enough, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
