"""Packing token sequences by shortest-pack-first over the histogram of lengths.

Documents are cut into full sequences and one rest. The rests are counted by
length. Lengths are placed longest first, each into the shortest pack that takes
it, for all packs of one pattern at once. Patterns then meet the documents again
by length and rank. The driver sees one count for each length, whatever the table.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sightline.llm.common import ranked, tokenizer_text, union_all, whole_text
from sightline.session import cut

MAX_TOKENS = 2048
END_ID = 1
# Bytes of runs and ids that a task remembers; bytes of text that it splits at once.
REMEMBERED_BYTES = 48 << 20
SLICE_BYTES = 8 << 20
# Runs encoded in one call.
JOINED = 2_000
# Bytes by kind: 1 white space, 2 letter, 3 digit, 4 other mark, 5 apostrophe; 0 control and beyond ASCII.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[32, *range(9, 14)]] = 1
_KIND[33:127] = [2 if chr(b).isalpha() else 3 if chr(b).isdigit() else 5 if chr(b) == "'" else 4 for b in range(33, 127)]
# Bytes that begin no white space: neither that of ASCII nor, in UTF-8, any beyond it.
_SOLID = np.ones(256, dtype=bool)
_SOLID[[*range(33), 0xC2, 0xE1, 0xE2, 0xE3]] = False
# A run that keeps its ids between two line ends: no white space or control but one space in front.
PLAIN = r"^ ?[^\x00-\x20\x7f-\xa0\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]+$"
_PIECE_FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
]


def _cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of runs whose ids are those they have in any text; ``bounds`` are the ends of texts.

    This kind of tokenizer leaves the last white space before a word to the word,
    if it is a space, or lets it stand alone. So texts fall apart before it, and
    after it if it is no space. They also do where letters, digits and marks
    meet, unless an apostrophe is in front.
    """
    kind = _KIND[data]
    front, back = kind[:-1], kind[1:]
    fresh = np.zeros(len(data) + 1, dtype=bool)
    fresh[:-2] = (front == 1) & _SOLID[data[1:]]
    fresh[bounds[1:-1] - 1] = False
    fresh[1:-1] |= fresh[:-2] & (data[:-1] != 32)
    fresh[1:-1] |= (front > 1) & (front < 5) & (back > 1) & (np.minimum(front, 4) != np.minimum(back, 4))
    fresh[bounds] = True
    return np.flatnonzero(fresh)


class _Encoder:
    """Ids of texts. A distinct run is encoded once as long as it is remembered."""

    def __init__(self, source: str):
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self.ids("\n")
        self.forget()

    def forget(self) -> None:
        """Known runs, how many ids each has, and these."""
        self.known, self.numbers, self.flat = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self, runs: pa.Array) -> None:
        """Remember the ids of ``runs``. Plain ones are joined by line ends, which stand alone between them."""
        plain = pc.match_substring_regex(runs, PLAIN)
        found, numbers, others = [], [], [runs.filter(pc.invert(plain))]
        joined = runs.filter(plain)
        kept = []
        for at in range(0, len(joined), JOINED):
            part = joined.slice(at, JOINED)
            ids = self.ids("\n".join(part.to_pylist()))
            line = ids == self.line[0]
            ends = np.flatnonzero(line)
            if len(self.line) > 1 or len(ends) != len(part) - 1:
                others.append(part)
                continue
            kept.append(part)
            found.append(ids[~line])
            numbers.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
        for part in others:
            each = [self.ids(run) for run in part.to_pylist()]
            found += each
            numbers.append(np.array([len(ids) for ids in each], np.int32))
        self.known = pa.concat_arrays([self.known, *kept, *others])
        self.numbers = np.concatenate([self.numbers, *numbers]).astype(np.int32)
        self.flat = np.concatenate([self.flat, *found])

    def slice(self, data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Ids of every text of a slice; ``data`` is their UTF-8 and ``bounds`` where they begin and end."""
        if self.known.nbytes + self.flat.nbytes + self.numbers.nbytes > REMEMBERED_BYTES:
            self.forget()
        starts = _cuts(data, bounds)
        runs = pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        missing = pc.invert(pc.is_in(runs.dictionary, value_set=self.known))
        self.learn(runs.dictionary.filter(missing))
        of = pc.index_in(runs.dictionary, value_set=self.known).to_numpy()[runs.indices.to_numpy()]
        numbers = self.numbers[of]
        upto = np.concatenate([[0], np.cumsum(numbers, dtype=np.int64)])
        # The place of every id among the known ones, as the run it belongs to has them elsewhere.
        shift = (np.cumsum(self.numbers, dtype=np.int64) - self.numbers)[of] - upto[:-1]
        ids = self.flat[np.arange(upto[-1]) + np.repeat(shift, numbers)].tobytes()
        at = (4 * upto[np.searchsorted(starts, bounds)]).tolist()
        return [ids[a:b] for a, b in pairwise(at)]

    def __call__(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of every text of a column without nulls."""
        column = column.cast(pa.large_string())
        special = np.zeros(len(column), dtype=bool)
        for s in self.special:
            special |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        ends = np.cumsum(pc.binary_length(column).to_numpy())
        first = 0
        while first < len(column):
            before = ends[first - 1] if first else 0
            after = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            part = column.slice(first, after - first)
            _, offsets, data = part.buffers()
            bounds = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
            data = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
            coded = self.slice(data, bounds - bounds[0]) if len(data) else [b""] * len(part)
            for k, ids in enumerate(coded):
                # Special tokens set apart what lies between them; the library sees to it.
                yield self.ids(part[k].as_py()).tobytes() if special[first + k] else ids
            first = after


@cache
def _encoder(source: str) -> _Encoder:
    """Each worker builds it once."""
    return _Encoder(source)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    max_tokens: int = MAX_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of every document, closing id included.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for. A
    null text counts as empty and gives one piece that holds the closing id.
    """
    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).select(
        "doc_id", whole_text("text").alias("text")
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    if with_ids:
        schema += ", ids array<int>"
    end = array("I", [END_ID]).tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer)
        for batch in batches:
            rows, columns, ids = [], [[], [], [], []], []
            for k, found in enumerate(encode(batch.column("text"))):
                found += end
                for at in range(0, len(found), 4 * max_tokens):
                    piece = found[at : at + 4 * max_tokens]
                    rows.append(k)
                    for column, value in zip(
                        columns, (at // 4, len(piece) // 4, zlib.crc32(piece), len(found) // 4), strict=True
                    ):
                        column.append(value)
                    if with_ids:
                        ids.append(array("I", piece).tolist())
            arrays = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
            arrays += [pa.array(c, t) for c, (_, t) in zip(columns, _PIECE_FIELDS, strict=True)]
            names = ["doc_id", *(n for n, _ in _PIECE_FIELDS)]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
        # The worker may wait long for its next task, beside others and the JVM.
        encode.forget()
        pa.default_memory_pool().release_unused()

    return chosen.mapInArrow(cut_up, schema)


def patterns(counts: dict[int, int], room: int) -> list[tuple[int, list[int]]]:
    """Shortest-pack-first: (number of packs, lengths in each) for a histogram of lengths.

    Packs of one pattern are one entry of the heap, with the room left as its
    key. A length takes the shortest packs, those with most room; where more
    packs share a pattern than there are rests left, the entry is split. Full
    packs leave the heap.
    """
    done: list[tuple[int, list[int]]] = []
    heap: list[tuple[int, int, int, list[int]]] = []
    made = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if heap and -heap[0][0] >= length:
                space, _, packs, held = heapq.heappop(heap)
                fits = (-space) // length
                # As many of this length as fit, or as are left, go into each pack.
                each = min(fits, max(1, left // packs))
                used = min(packs, left // each)
                if used < packs:
                    heapq.heappush(heap, (space, made := made + 1, packs - used, held))
                left -= used * each
                packs, held, space = used, held + [length] * each, space + length * each
            else:
                each = min(room // length, left)
                packs = left // each
                left -= packs * each
                held, space = [length] * each, length * each - room
            if space:
                heapq.heappush(heap, (space, made := made + 1, packs, held))
            else:
                done.append((packs, held))
    return done + [(packs, held) for _, _, packs, held in sorted(heap)]


def place(lengths: DataFrame, room: int = MAX_TOKENS) -> DataFrame:
    """``lengths`` (doc_id, start, length, …) with sequence_id and offset.

    Pieces as long as a sequence have one of their own. The others are packed;
    ties of length go by doc_id and start. Repeated rows are placed each.
    """
    spark = lengths.sparkSession
    numbered = ranked(lengths, "length", ["doc_id", "start", "ids_crc32"], "rank")
    histogram = {r["length"]: r["n"] for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(room, 0)
    # (length, first rank, rank after, first sequence, offset): one row for each place in a pattern.
    rows, upto, sequence = [(room, 0, full, 0, 0)], dict.fromkeys(histogram, 0), full
    for packs, held in patterns(histogram, room):
        offset = 0
        for length in held:
            rows.append((length, upto[length], upto[length] + packs, sequence, offset))
            upto[length] += packs
            offset += length
        sequence += packs
    by_length: dict[int, list[tuple[int, ...]]] = {}
    for length, *rest in rows:
        by_length.setdefault(length, []).append(tuple(rest))
    # One row for each length, so at most `room` rows.
    table = spark.createDataFrame(
        [(n, v) for n, v in by_length.items()],
        "length long, places array<struct<first: long, after: long, sequence: long, offset: long>>",
    )
    met = numbered.join(table, "length")
    at = F.filter("places", lambda p: (p["first"] <= F.col("rank")) & (F.col("rank") < p["after"]))
    met = met.withColumn("place", F.get(at, F.lit(0)))
    return met.select(
        *lengths.columns,
        (F.col("place.sequence") + F.col("rank") - F.col("place.first")).alias("sequence_id"),
        F.col("place.offset").alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer_file: str = "byte_bpe_50k.json",
    tokenizer_folder: str | None = None,
    max_tokens: int = MAX_TOKENS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every piece of every document with its place.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. The
    ids themselves come from ``pieces(…, with_ids=True)``, by doc_id and start. An
    empty table gives an empty result.
    """
    tokenizer = tokenizer_text(tokenizer_file, tokenizer_folder)
    return place(cut(pieces(docs, tokenizer, max_tokens, id_column, text_column)), max_tokens)
