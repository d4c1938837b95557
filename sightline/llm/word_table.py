"""BPE over a table of distinct words.

Texts are split into words in Spark tasks. Each block of documents asks once for
each of its distinct words; requests meet by word, where every distinct word of
the corpus is encoded once, and the answers go back to the block. There ids are
put in the order of the words and pieces are looked up by id. Requests, answers
and texts travel packed, as one row for many words.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import tokenizer_text, whole_text

# Documents of one block; a block's words are in memory at once.
BLOCK_BITS = 11
# How this kind of tokenizer splits text; a fixed value of the public format.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@cache
def _splitter(source: str):
    """A function from text to words; special tokens are words of their own.

    Characters that came into Unicode after its version 3.2 are classed by the
    tokenizer itself, as libraries differ in the version they know.
    """
    import regex
    from tokenizers import Tokenizer

    form = json.loads(source)
    form["pre_tokenizer"] = form["pre_tokenizer"]["pretokenizers"][0]
    own = Tokenizer.from_str(json.dumps(form))
    old = unicodedata.ucd_3_2_0.category
    newer = regex.compile("[^" + "".join(regex.escape(chr(c), literal_spaces=True) for c in range(0xD800) if old(chr(c)) != "Cn") + "]").search

    special = sorted((t["content"] for t in json.loads(source)["added_tokens"]), key=len, reverse=True)
    parts = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
    words = regex.compile(WORD).findall

    def plain(text: str) -> list[str]:
        if newer(text):
            return [w for w, _ in own.pre_tokenizer.pre_tokenize_str(own.normalizer.normalize_str(text))]
        # Capital sigma has two lower-case forms in context; the tokenizer knows one.
        return words(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def split(text: str) -> list[str]:
        if parts is None or not any(s in text for s in special):
            return plain(text)
        return [w for k, part in enumerate(parts(text)) for w in ([part] if k % 2 else plain(part))]

    return split


@cache
def _encoder(source: str):
    """A tokenizer for single words: they are normalised and split already."""
    from tokenizers import Tokenizer

    form = json.loads(source)
    form["normalizer"] = None
    form["pre_tokenizer"] = form["pre_tokenizer"]["pretokenizers"][-1]
    tokenizer = Tokenizer.from_str(json.dumps(form))
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda word: tokenizer.encode(word, add_special_tokens=False).ids


@cache
def _pieces(source: str) -> dict[int, str]:
    """The id-to-piece table, special tokens included: as many rows as the vocabulary."""
    form = json.loads(source)
    return {i: p for p, i in form["model"]["vocab"].items()} | {t["id"]: t["content"] for t in form["added_tokens"]}


def _blocked(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    return docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"), block.alias("block"))


def _requests(texts: DataFrame, source: str, buckets: int) -> DataFrame:
    """(bucket, block, words): the distinct words of a block that fall into a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, press = _splitter(source), zstandard.ZstdCompressor(level=3)

        def packed(block: int, words: set[str]) -> pa.RecordBatch:
            by_bucket: dict[int, list[str]] = {}
            for w in sorted(words):
                by_bucket.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
            data = [press.compress("\n".join(w).encode()) for w in by_bucket.values()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(by_bucket), pa.int32()),
                    pa.array([block] * len(data), pa.int64()),
                    pa.array(data, pa.binary()),
                ],
                ["bucket", "block", "words"],
            )

        now, words = None, set()
        for batch in batches:
            for block, text in zip(batch.column("block").to_pylist(), batch.column("text"), strict=True):
                if block != now:
                    if words:
                        yield packed(now, words)
                    now, words = block, set()
                words.update(split(text.as_py()))
        if words:
            yield packed(now, words)

    return texts.select("block", "text").mapInArrow(run, "bucket int, block long, words binary")


def _answers(requests: DataFrame, source: str) -> DataFrame:
    """(block, words, counts, ids) for each request; a word is encoded where it is first met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, open_up, press = _encoder(source), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        known: dict[str, array] = {}
        for batch in batches:
            rows = []
            for words in batch.column("words").to_pylist():
                counts, ids = array("I"), array("I")
                for w in open_up.decompress(words).decode().split("\n"):
                    found = known.get(w)
                    if found is None:
                        found = known[w] = array("I", encode(w))
                    counts.append(len(found))
                    ids.extend(found)
                rows.append((press.compress(counts.tobytes()), press.compress(ids.tobytes())))
            counts, ids = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("words"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
                ["block", "words", "counts", "ids"],
            )

    return requests.mapInArrow(run, "block long, words binary, counts binary, ids binary")


def _chunks(texts: DataFrame, kind: str) -> DataFrame:
    """(block, doc_ids, lengths, data): documents of a block, compressed together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            starts = [k for k in range(len(blocks)) if not k or blocks[k] != blocks[k - 1]]
            ids, lengths, data = [], [], []
            for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
                raw = [t.as_buffer().to_pybytes() for t in batch.column("text")[a:b]]
                ids.append(batch.column("doc_id")[a:b].to_pylist())
                lengths.append([len(r) for r in raw])
                data.append(press.compress(b"".join(raw)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([blocks[k] for k in starts], pa.int64()),
                    pa.array(ids, pa.list_(batch.column("doc_id").type)),
                    pa.array(lengths, pa.list_(pa.int64())),
                    pa.array(data, pa.binary()),
                ],
                ["block", "doc_ids", "lengths", "data"],
            )

    return texts.mapInArrow(run, f"block long, doc_ids array<{kind}>, lengths array<long>, data binary")


def coded(
    docs: DataFrame,
    tokenizer_file: str = "word_bpe_49k.json",
    tokenizer_folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, ids_text (decimal ids joined by spaces) and decoded for every row.

    A null text counts as empty; it has no tokens, and both texts are empty. The
    rows of a block are told by their place in the input. Should a task that is
    run again find rows in another order, words missing among its answers are
    encoded on the spot, so results never depend on it.
    """
    spark = docs.sparkSession
    source = tokenizer_text(tokenizer_file, tokenizer_folder)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = _blocked(docs, id_column, text_column)
    id_type = texts.schema["doc_id"].dataType
    kind = id_type.simpleString()
    asked = _requests(texts, source, buckets).repartition(buckets, "bucket")
    answers = _answers(asked, source).groupBy("block")
    chunks = _chunks(texts, kind).groupBy("block")

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        open_up, split, pieces = zstandard.ZstdDecompressor(), _splitter(source), _pieces(source)
        encode = _encoder(source)

        def entry(ids) -> tuple[int, str, str]:
            return len(ids), " ".join(map(str, ids)), " ".join([pieces[i] for i in ids])

        class Known(dict):
            def __missing__(self, word: str) -> tuple[int, str, str]:
                found = self[word] = entry(encode(word))
                return found

        known = Known()
        for words, counts, ids in zip(*(right.column(c).to_pylist() for c in ("words", "counts", "ids")), strict=True):
            numbers, found = array("I", open_up.decompress(counts)), array("I", open_up.decompress(ids))
            upto = 0
            for w, n in zip(open_up.decompress(words).decode().split("\n"), numbers, strict=True):
                known[w] = entry(found[upto : upto + n])
                upto += n
        ids, tokens, id_texts, decoded = [], [], [], []
        for row in left.to_pylist():
            raw, at = open_up.decompress(row["data"]), 0
            for doc_id, length in zip(row["doc_ids"], row["lengths"], strict=True):
                found = [e for e in map(known.__getitem__, split(raw[at : at + length].decode())) if e[0]]
                at += length
                ids.append(doc_id)
                tokens.append(sum([e[0] for e in found]))
                id_texts.append(" ".join([e[1] for e in found]))
                decoded.append(" ".join([e[2] for e in found]))
        return pa.table(
            {
                "doc_id": pa.array(ids, left.column("doc_ids").type.value_type),
                "n_tokens": pa.array(tokens, pa.int64()),
                "ids_text": pa.array(id_texts, pa.string()),
                "decoded": pa.array(decoded, pa.string()),
            }
        )

    schema = f"doc_id {kind}, n_tokens long, ids_text string, decoded string"
    return chunks.cogroup(answers).applyInArrow(joined, schema)
