"""Removal of long repeated passages by distributed prefix doubling.

A position is ranked by ever longer strings that start there, and leaves as soon
as its rank is unique. Sorting every position of the corpus for every length
would move the text many times over, so the first round ranks 32-byte strings at
anchors only: the least string among all those inside a 200-byte window is the
same wherever that window stands, so a window can repeat only if its anchor's
rank does. The positions that share an anchor make up a block. The second round
ranks whole blocks (sorted beside their neighbours); equal ones are settled. The
last round ranks the 200 bytes at each position of the blocks still open.

All documents with one text are one text here. A text that two documents have is
repeated from end to end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import whole_text
from sightline.llm.kernels import Spans, U, pair
from sightline.session import cut

LENGTH = 200
ANCHOR = 32
WINDOW = LENGTH - ANCHOR + 1
# Bytes of open blocks that one task of the last round should hold.
BUCKET_BYTES = 16_000_000
# Blocks of one anchor beyond which their positions are dealt to several tasks.
HOT_BLOCKS = 20_000
# Texts longer than this are ranked in overlapping stretches.
STRETCH = 1 << 23


def _blocks(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor rank, block rank, anchor, first and last window start of every block."""
    spans = Spans(data)
    ranks = spans.every(ANCHOR)
    count = len(ranks)
    # Leading bits of the rank, then the position: among equal ranks the leftmost is least.
    valued = ((ranks >> U(24)) << U(24)) | np.arange(count, dtype=np.uint64)
    rows = np.concatenate([valued, np.full(-count % WINDOW, ~U(0), np.uint64)]).reshape(-1, WINDOW)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[: count - WINDOW + 1], before[WINDOW - 1 : count])
    anchor = (least & U(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    last = np.r_[first[1:], len(anchor)] - 1
    anchor = anchor[first]
    block = pair(spans.between(first, last + LENGTH), (anchor - first).astype(np.uint64))
    return ranks[anchor], block, anchor, first, last


def _ranked(texts: DataFrame) -> DataFrame:
    """(rank, block, key, at): at packs the anchor and the distances to first and last start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], []]
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                if len(data) < LENGTH or key in sent:
                    continue
                if len(sent) < 5_000_000:
                    sent.add(key)
                # Stretches overlap by a window less one byte, so each window is in one of them.
                for base in range(0, len(data) - LENGTH + 1, STRETCH):
                    rank, block, anchor, first, last = _blocks(data[base : base + STRETCH + LENGTH - 1])
                    at = ((anchor + base) << 16) | ((anchor - first) << 8) | (last - first)
                    for part, value in zip(
                        parts, (rank.view(np.int64), block.view(np.int64), np.full(len(at), key), at), strict=True
                    ):
                        part.append(value)
            if parts[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(p), pa.int64()) for p in parts], ["rank", "block", "key", "at"]
                )

    return texts.mapInArrow(run, "rank long, block long, key long, at long")


def _packed(texts: DataFrame) -> DataFrame:
    """(key, data): compressed texts of at least ``LENGTH`` bytes, each once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            keys, data = [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                raw = text.as_buffer()
                if len(raw) < LENGTH or key in sent:
                    continue
                if len(sent) < 5_000_000:
                    sent.add(key)
                keys.append(key)
                data.append(press.compress(raw))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())], ["key", "data"])

    return texts.mapInArrow(run, "key long, data binary")


def _cut_out(asked: DataFrame) -> DataFrame:
    """(rank, key, at, bytes) of the blocks asked for, from (key, data, blocks)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_up = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, data, blocks in zip(
                batch.column("key").to_pylist(), batch.column("data"), batch.column("blocks").to_pylist(), strict=True
            ):
                raw = open_up.decompress(data.as_py())
                for b in blocks:
                    first = (b["at"] >> 16) - (b["at"] >> 8 & 255)
                    for column, value in zip(
                        out, (b["rank"], key, b["at"], raw[first : first + (b["at"] & 255) + LENGTH]), strict=True
                    ):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["rank", "key", "at", "bytes"]
            )

    return asked.mapInArrow(run, "rank long, key long, at long, bytes binary")


def _positions(table: pa.Table) -> pa.Table:
    """Runs (key, first, last) of window starts whose 200 bytes come twice among the blocks given.

    Windows are compared within their anchor's rank and at the same distance from it.
    """
    rank, key, at, part, parts = (table.column(c).to_numpy() for c in ("rank", "key", "at", "part", "parts"))
    first = (at >> 16) - (at >> 8 & 255)
    count = (at & 255) + 1
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    base = np.r_[0, np.cumsum(count + LENGTH - 1)][:-1]
    of = np.repeat(np.arange(len(at)), count)
    step = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    distance = (at[of] >> 8 & 255) - step
    mine = distance % parts[of] == part[of]
    of, step, distance = of[mine], step[mine], distance[mine]
    if not len(of):
        return pa.table({c: np.zeros(0, np.int64) for c in ("key", "first", "last")})
    window = Spans(data).every(LENGTH)[base[of] + step]
    place = pair(rank.view(np.uint64)[of], distance.astype(np.uint64))
    start = first[of] + step
    order = np.lexsort((start, key[of], place, window))
    w, p, k, s = window[order], place[order], key[of][order], start[order]
    fresh = np.r_[True, (w[1:] != w[:-1]) | (p[1:] != p[:-1]) | (k[1:] != k[:-1]) | (s[1:] != s[:-1])]
    w, p, k, s = w[fresh], p[fresh], k[fresh], s[fresh]
    same = (w[1:] == w[:-1]) & (p[1:] == p[:-1])
    twice = np.r_[False, same] | np.r_[same, False]
    k, s = k[twice], s[twice]
    order = np.lexsort((s, k))
    k, s = k[order], s[order]
    starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (s[1:] != s[:-1] + 1)]) if len(k) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(k)] - 1 if len(k) else starts
    return pa.table({"key": k[starts], "first": s[starts], "last": s[ends]})


def _kept(met: DataFrame) -> DataFrame:
    """Results per text from (key, data, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_up = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, numbers, texts = [], [], []
            for data, spans in zip(batch.column("data"), batch.column("spans").to_pylist(), strict=True):
                raw = open_up.decompress(data.as_py())
                pieces, upto, end, number = [], 0, -1, 0
                for s in sorted((s["first"], s["last"] + LENGTH) for s in spans):
                    if s[0] > end:
                        number += 1
                        pieces.append(raw[max(upto, 0) : s[0]])
                    end = max(end, s[1])
                    upto = end
                pieces.append(raw[upto:])
                left = b"".join(pieces)
                removed.append(len(raw) - len(left))
                numbers.append(number)
                texts.append(left)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(removed, pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array(texts, pa.binary()),
                ],
                ["key", "removed", "spans", "left"],
            )

    return met.mapInArrow(run, "key long, removed long, spans long, left binary")


def _repeated(keyed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Packed texts, and (key, first, last) runs of repeated window starts of all texts.

    A text's key is a 64-bit hash of it; with a thousand million texts two get
    one key about once in forty corpora.
    """
    spark = keyed.sparkSession
    texts = keyed.select("key", "text")
    by_rank = Window.partitionBy("rank")
    by_block = by_rank.orderBy("block", "key", "at")
    ranked = _ranked(texts).select(
        "*",
        F.lag("block").over(by_block).alias("_before"),
        F.lead("block").over(by_block).alias("_after"),
        (F.min("block").over(by_rank) != F.max("block").over(by_rank)).alias("several"),
    )
    equal = (F.col("_before") == F.col("block")) | (F.col("_after") == F.col("block"))
    ranked = ranked.where(F.col("_before").isNotNull() | F.col("_after").isNotNull()).select(
        "rank",
        "key",
        "at",
        F.coalesce(equal, F.lit(False)).alias("settled"),
        # One block of each content stands for it in the last round.
        (F.col("several") & ~F.coalesce(F.col("_before") == F.col("block"), F.lit(False))).alias("asked"),
    )
    shared = cut(ranked)
    packed = cut(_packed(texts))
    asked = shared.where("asked")
    wanted = asked.groupBy("key").agg(F.collect_list(F.struct("rank", "at")).alias("blocks"))
    crowds = asked.groupBy("rank").agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_BLOCKS)
    # At most one in HOT_BLOCKS rows; joined by size, not forced.
    opened = _cut_out(packed.join(wanted, "key")).join(crowds, "rank", "left")
    parts = F.least(F.lit(WINDOW), F.ceil(F.coalesce("_n", F.lit(1)) / HOT_BLOCKS)).cast("int")
    opened = opened.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    total = asked.agg(F.sum(F.col("at").bitwiseAND(255) + LENGTH)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_BYTES + 1)
    dealt = opened.withColumn("bucket", F.pmod(F.xxhash64("rank", "part"), F.lit(buckets)).cast("int"))
    late = dealt.groupBy("bucket").applyInArrow(_positions, "key long, first long, last long")
    first = F.shiftright("at", 16) - F.shiftright("at", 8).bitwiseAND(255)
    early = shared.where("settled").select(
        "key", first.alias("first"), (first + F.col("at").bitwiseAND(255)).alias("last")
    )
    return packed, early.unionByName(late)


def _left(keyed: DataFrame) -> DataFrame:
    """What is left of each text that loses something."""
    packed, runs = _repeated(keyed)
    spans = runs.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return _kept(packed.join(spans, "key"))


def remove(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    A null text counts as empty, and nothing of a text under 200 bytes goes. Every
    row has its result, rows with equal or null ids too; equal texts of 200 bytes
    or more are removed whole. ``trimmed`` gives the remaining texts themselves.
    """
    keyed = docs.select(F.col(id_column).alias("_id"), whole_text(text_column).alias("text"))
    keyed = keyed.withColumn("key", F.xxhash64("text"))
    left = _left(keyed)
    changed = left.select("key", "removed", F.col("spans").alias("n"), F.sha2("left", 256).alias("sha"))
    changed = cut(changed.dropDuplicates(["key"]))
    rows = cut(
        keyed.select(
            F.col("_id").alias("doc_id"),
            "key",
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2(F.encode("text", "UTF-8"), 256).alias("whole"),
        )
    )
    copied = rows.groupBy("key").agg((F.count("*") > 1).alias("copied")).where("copied")
    met = rows.join(changed, "key", "left").join(copied, "key", "left")
    gone = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= LENGTH)
    return met.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("sha", "whole")).alias("kept_sha256"),
    )


def trimmed(docs: DataFrame, text_column: str = "text", length_column: str = "n_chars") -> DataFrame:
    """``docs`` with repeated passages taken out of the texts, and their length set anew.

    Bytes left over of a character that a passage has cut through go too. Null
    texts stay null. Every row stays, also when nothing is left of its text.
    """
    text = F.col(text_column)
    keyed = docs.select(whole_text(text_column).alias("text")).withColumn("key", F.xxhash64("text"))
    left = _left(keyed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [v.decode("utf-8", "ignore") for v in batch.column("left").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["_key", "_left"])

    changed = cut(left.mapInArrow(run, "_key long, _left string").dropDuplicates(["_key"]))
    copied = keyed.where(F.octet_length("text") >= LENGTH).groupBy("key").agg(F.count("*").alias("_n")).where("_n > 1")
    copied = cut(copied.select(F.col("key").alias("_copied")))
    rows = docs.select(F.struct("*").alias("_row"), F.xxhash64(whole_text(text_column)).alias("_key"))
    met = rows.join(changed, "_key", "left").join(copied, F.col("_key") == F.col("_copied"), "left")
    old = F.col("_row")[text_column]
    new = F.when(F.col("_copied").isNotNull(), F.lit("")).otherwise(F.coalesce("_left", old))
    columns = [c for c in docs.columns]
    out = met.select(*[(new if c == text_column else F.col("_row")[c]).alias(c) for c in columns])
    if length_column in columns:
        out = out.withColumn(length_column, F.length(text).cast(docs.schema[length_column].dataType))
    return out.select(*columns)
