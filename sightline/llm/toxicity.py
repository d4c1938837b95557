"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text, one from toxic and one
from ordinary documents. A text is cut into windows, each window is compressed
with both, and the document is judged by how much shorter its windows get with
the toxic one. Thresholds are calibrated on labelled documents that the
dictionaries have not seen.

The labelled sample stays in Spark: codes are counted there by class and fold,
and only the few that enter a dictionary, and the features of labelled documents,
reach the driver.

Windows are written as one 8-byte code for every six bytes of lower-cased text
with the spaces at word ends. A shared short string is then one long match, where
zstandard's plain matching would save a byte or none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import whole_text
from sightline.llm.kernels import LOWER, SPACES, grams
from sightline.llm.sums import lists, matrix
from sightline.session import cut

GRAM = 6
WINDOW = 128
LEVEL = 1
# Bounds on the labelled documents and bytes that the classifier is fitted on.
FIT_DOCUMENTS = 8_000
FIT_BYTES = 28_000_000
FOLDS = 3
# Of the commonest codes of ordinary text, so many are looked at.
COMMON_CODES = 1024
# A code tells toxic text if so large a share of toxic documents has it, and is
# so many times as frequent there as among ordinary documents.
LEAST_SHARE = 0.015
LEAST_RATIO = 6.0
DICTIONARY_CODES = 8192
ORDINARY_CODES = 64
FEATURES = 6
THRESHOLD = 0.3


def codes(text: str) -> np.ndarray:
    """One code for every position of the folded text."""
    data = np.frombuffer(f" {text} ".encode(), np.uint8)
    folded = LOWER[data].copy()
    folded[SPACES[data]] = 32
    return grams(folded, GRAM)


def _dictionary(content: np.ndarray) -> bytes:
    """Content of a dictionary, most frequent codes last, where matches are cheapest."""
    return content.tobytes() or bytes(64)


def train(counts: np.ndarray, documents: np.ndarray) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary.

    ``counts`` has a row for each code: the code, and the numbers of ordinary and
    of toxic documents with it. ``documents`` has the numbers of documents.
    """
    keys, others, ours = counts
    ordinary, toxic = np.maximum(1, documents)
    tells = (ours >= max(3, LEAST_SHARE * toxic)) & (ours / toxic > LEAST_RATIO * (others + 0.5) / ordinary)
    order = np.lexsort((keys[tells], ours[tells]))
    common = (others > 0) & (others / ordinary >= ours / toxic)
    by_use = np.lexsort((keys[common], others[common]))
    return (
        _dictionary(keys[tells][order][-DICTIONARY_CODES:].view(np.uint64)),
        _dictionary(keys[common][by_use][-ORDINARY_CODES:].view(np.uint64)),
    )


@cache
def _compressors(toxic: bytes, ordinary: bytes):
    made = []
    for content in (toxic, ordinary):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
            )
        )
    return made


def gains(found: np.ndarray, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Bytes saved by the toxic dictionary over the ordinary one, for every window."""
    with_toxic, with_ordinary = _compressors(toxic, ordinary)
    data = memoryview(found.tobytes())
    step = 8 * WINDOW
    windows = [data[i : i + step] for i in range(0, len(data), step)] or [data]
    return np.array([len(with_ordinary.compress(w)) - len(with_toxic.compress(w)) for w in windows], np.float64)


def features(saved: np.ndarray) -> np.ndarray:
    """What the calibration sees of a document's windows."""
    top = np.sort(saved)[::-1]
    return np.array(
        [
            top[0],
            top[: 2].mean(),
            top[: max(1, len(top) // 5)].mean(),
            saved.mean(),
            10 * (saved >= 8).mean(),
            np.log1p(len(saved)),
        ]
    ).clip(-60, 120)


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Logistic weights over the features, by Newton steps with a small penalty."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + 1e-2 * w
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return {"centre": centre, "scale": scale, "weights": w}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    z = np.column_stack([(x - model["centre"]) / model["scale"], np.ones(len(x))]) @ model["weights"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _counted(sample: DataFrame) -> DataFrame:
    """code and the number of documents with it: n0_f of ordinary, n1_f of toxic ones in fold f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("toxic").to_numpy() * FOLDS + batch.column("fold").to_numpy()
            for kind in np.unique(kinds):
                found = [np.unique(codes(batch.column("text")[int(k)].as_py())) for k in np.flatnonzero(kinds == kind)]
                code, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), pa.array(np.full(len(code), kind), pa.int32()), pa.array(n, pa.int64())],
                    ["code", "kind", "n"],
                )

    found = sample.mapInArrow(run, "code long, kind int, n long").groupBy("code")
    return found.agg(
        *[F.sum(F.when(F.col("kind") == c * FOLDS + f, F.col("n")).otherwise(0)).alias(f"n{c}_{f}") for c in (0, 1) for f in range(FOLDS)]
    )


def fit(sample: DataFrame) -> dict:
    """Fit dictionaries and calibration on rows (doc_id, text, toxic, weight).

    ``weight`` is the number of labelled rows that a row stands for.

    Dictionaries for the calibration leave out one fold of documents, which the
    calibration then uses; the final ones see all. Without both classes every
    score is the share of toxic rows.
    """
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int"))
    documents = np.zeros((2, FOLDS), np.int64)
    for r in sample.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect():
        documents[r["toxic"], r["fold"]] = r["n"]
    if not documents.sum(axis=1).all():
        return {"constant": float(documents[1].sum() > 0)}
    counted = cut(_counted(sample))
    ordinary, toxic = (sum(F.col(f"n{c}_{f}") for f in range(FOLDS)) for c in (0, 1))
    totals = [int(v) for v in documents.sum(axis=1)]
    # What can enter a dictionary: at most bytes of the sample over the least count, and COMMON_CODES.
    least = max(3, LEAST_SHARE * (totals[1] - documents[1].max()))
    telling = counted.where((toxic >= least) & (toxic / totals[1] > ordinary / totals[0]))
    common = counted.where(ordinary / totals[0] >= toxic / totals[1]).orderBy(ordinary.desc(), "code").limit(COMMON_CODES)
    rows = telling.unionByName(common).toArrow()
    keys = rows.column("code").to_numpy()
    counts = np.array([[rows.column(f"n{c}_{f}").to_numpy() for f in range(FOLDS)] for c in (0, 1)])

    def made(seen: list[int]) -> tuple[bytes, bytes]:
        return train((keys, *counts[:, seen].sum(axis=1)), documents[:, seen].sum(axis=1))

    folds = [made([f for f in range(FOLDS) if f != left]) for left in range(FOLDS)]

    def seen_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                features(gains(codes(t.as_py()), *folds[f])) for t, f in zip(batch.column("text"), batch.column("fold").to_pylist(), strict=True)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([lists(np.array(rows)), batch.column("toxic"), batch.column("weight")], ["x", "toxic", "weight"])

    # FEATURES numbers for each of at most FIT_DOCUMENTS documents.
    seen = sample.mapInArrow(seen_by, "x array<double>, toxic int, weight double").toArrow()
    x = matrix(seen.column("x"), FEATURES)
    y, weight = (seen.column(c).to_numpy().astype(np.float64) for c in ("toxic", "weight"))
    # In one order, so that sums do not depend on that of the tasks.
    order = np.lexsort((weight, y, *x.T))
    model = calibrate(x[order], y[order], weight[order])
    model["toxic"], model["ordinary"] = made(list(range(FOLDS)))
    return model


def held_out(doc_id, modulus: int = 4, remainder: int = 2):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, text_column: str, id_column: str) -> DataFrame:
    """(doc_id, text, toxic, weight) of at most ``FIT_DOCUMENTS`` labelled documents within ``FIT_BYTES``.

    A document is taken by a hash of its id, so the sample does not depend on the
    order of rows. Rows without label or id are left out; of several texts with one
    id the least counts.
    """
    marked = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.where(~held_out("doc_id"))
    half = FIT_DOCUMENTS // 2
    spread = F.xxhash64("doc_id")
    picked = [marked.where(F.col("toxic") == c).orderBy(spread, "doc_id").limit(half) for c in (0, 1)]
    chosen = cut(picked[0].unionByName(picked[1]))
    texts = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    # At most FIT_DOCUMENTS rows of two numbers.
    met = cut(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))
    total = met.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > FIT_BYTES:
        met = met.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < int((1 << 20) * FIT_BYTES / total))
    known = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    taken = {r["toxic"]: r["n"] for r in met.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = [float(known.get(c, 0) / max(1, taken.get(c, 0))) for c in (0, 1)]
    # Spread over tasks by bytes, as codes take eight times those of the text.
    tasks = max(1, min(total, FIT_BYTES) // 1_000_000)
    weight = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    return cut(met.withColumn("weight", weight).repartition(tasks, "doc_id"))


def score(docs: DataFrame, model: dict, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of every row; null texts are scored as empty ones."""
    chosen = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "constant" in model:
                scores = np.full(batch.num_rows, model["constant"])
            elif batch.num_rows:
                rows = [features(gains(codes(t.as_py()), model["toxic"], model["ordinary"])) for t in batch.column("text")]
                scores = probability(model, np.array(rows))
            else:
                scores = np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return chosen.mapInArrow(run, f"doc_id {kind}, score double")


def judge(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels are learnt from rows outside the held-out quarter only. Repeated rows
    are scored each; without labels the score is 0.
    """
    model = fit(labelled_sample(docs, labels, text_column, id_column))
    return score(docs, model, id_column, text_column).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold, with all their columns."""
    model = fit(labelled_sample(docs, labels, text_column, id_column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if "constant" in model:
                clean = np.full(batch.num_rows, model["constant"] < THRESHOLD)
            elif batch.num_rows:
                rows = [features(gains(codes(t.as_py() or ""), model["toxic"], model["ordinary"])) for t in batch.column(text_column)]
                clean = probability(model, np.array(rows)) < THRESHOLD
            else:
                clean = np.zeros(0, bool)
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
