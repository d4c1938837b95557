"""Quality scores: kernel ridge over document statistics, calibrated by isotonic regression.

Every document is described by some statistics of its whole text. Random Fourier
features turn them into a space where a linear fit acts as one with a Gaussian
kernel. Each partition sums its own normal equations, Spark adds those up, and the
driver solves one system of fixed size. Half of the labelled documents calibrate
what the other half has fitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import whole_text
from sightline.llm.kernels import SPACES, pair, word_hashes
from sightline.llm.sums import summed
from sightline.session import cut

STATISTICS = 18
FOURIER = 320
RIDGE = 1e-3
# Width of the kernel in units of the standardised statistics.
WIDTH = 4.0
# Raw scores are counted in so many steps between -1 and 2 before the calibration.
STEPS = 3000
# Share of the raw score in the result, so that calibrated ties keep their order.
RAW_SHARE = 0.02
THRESHOLD = 0.3
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def statistics(text: str) -> np.ndarray:
    """Statistics of a text; all zero but defined for an empty one."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    size = max(1, len(data))
    found = word_hashes(data)
    n = max(1, len(found))
    letters = max(1, int(counts[_LETTERS].sum()))
    distinct, times = np.unique(found, return_counts=True)
    windows = found
    for step in (1, 2, 4):
        windows = pair(windows[:-step], windows[step:]) if len(windows) > step else windows[:0]
    repeated = len(windows) - len(np.unique(windows))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    shares = counts[counts > 0] / size
    return np.array(
        [
            np.log1p(len(found)),
            (len(data) - int(counts[SPACES].sum())) / n,
            np.log1p(100 * counts[_SYMBOLS].sum() / n),
            np.log1p(100 * counts[33] / n),
            np.log1p(100 * counts[124] / n),
            counts[65:91].sum() / letters,
            counts[48:58].sum() / size,
            (counts[44] + counts[46]) / n,
            counts[128:].sum() / size,
            len(distinct) / n,
            (found[1:] == found[:-1]).sum() / n,
            repeated / n,
            times.max() / n if len(times) else 0.0,
            (len(lines) - len(set(lines))) / max(1, len(lines)),
            np.log1p(len(found) / max(1, len(lines))),
            -(shares * np.log(shares)).sum(),
            min(len(found), 20) / 20,
            counts[47] / n + counts[64] / n,
        ],
        np.float64,
    )


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and statistics of every row; a null text counts as empty."""
    chosen = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column("text")]
            values = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            offsets = pa.array(np.arange(len(found) + 1) * STATISTICS, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, values)], ["doc_id", "statistics"]
            )

    return chosen.mapInArrow(run, f"doc_id {kind}, statistics array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("statistics").flatten().to_numpy().reshape(-1, STATISTICS)


def _directions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_305)
    return rng.normal(size=(STATISTICS, FOURIER)) / WIDTH, rng.uniform(0, 2 * np.pi, FOURIER)


def fourier(x: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    directions, shifts = _directions()
    z = np.clip((x - centre) / scale, -8, 8)
    # Products term by term: those of a matrix product depend on the other rows.
    turned = np.einsum("ij,jk->ik", z, directions) + shifts
    return np.column_stack([np.sqrt(2 / FOURIER) * np.cos(turned), np.ones(len(x))])


def raw_score(z: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.einsum("ij,j->i", z, weights)


def _moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    at = [F.get("statistics", F.lit(i)) for i in range(STATISTICS)]
    row = labelled.agg(*[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    values = np.array([0.0 if v is None else v for v in row], np.float64)
    return values[:STATISTICS], values[STATISTICS:] + 1e-6


def _equations(labelled: DataFrame, centre: np.ndarray, scale: np.ndarray) -> dict[int, np.ndarray]:
    """Normal equations of each half, as one matrix with the right side as last column."""

    def part(batch: pa.RecordBatch) -> np.ndarray:
        half = batch.column("half").to_numpy()
        z, y = fourier(_matrix(batch), centre, scale), batch.column("label").to_numpy()
        return np.concatenate(
            [(z[half == h].T @ np.column_stack([z[half == h], y[half == h]])).reshape(-1) for h in (0, 1)]
        )

    total = summed(labelled, part, 2 * (FOURIER + 1) * (FOURIER + 2)).reshape(2, FOURIER + 1, FOURIER + 2)
    return {0: total[0], 1: total[1]}


def solve(equations: np.ndarray) -> np.ndarray:
    a, b = equations[:, :-1], equations[:, -1]
    rows = max(1.0, a[-1, -1])
    return np.linalg.solve(a + RIDGE * rows * np.eye(len(a)) / FOURIER, b)


def isotonic(step: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over steps in order: middles and means of the blocks."""
    blocks: list[list[float]] = []
    for s, k, t in zip(step, n, total, strict=True):
        blocks.append([s * k, k, t])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def _steps(raw: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((raw + 1) / 3 * STEPS), 0, STEPS - 1)


def fit(labelled: DataFrame) -> dict:
    """Fit on rows (statistics, label, half). Without both classes all scores are one share."""
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return {"constant": float(next(iter(counts), 0))}
    centre, scale = _moments(labelled)
    halves = _equations(labelled, centre, scale)
    crossed = [solve(halves[1]), solve(halves[0])]

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, half = fourier(_matrix(batch), centre, scale), batch.column("half").to_numpy()
            raw = np.where(half == 0, raw_score(z, crossed[0]), raw_score(z, crossed[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(_steps(raw).astype(np.int32)), batch.column("label")], ["step", "label"]
            )

    # At most STEPS rows reach the driver.
    steps = labelled.mapInArrow(binned, "step int, label int").groupBy("step")
    rows = sorted(steps.agg(F.count("*").alias("n"), F.sum("label").alias("t")).collect())
    at, mean = isotonic(*[np.array(c, np.float64) for c in zip(*rows, strict=True)])
    return {"centre": centre, "scale": scale, "weights": solve(halves[0] + halves[1]), "at": at, "mean": mean}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    raw = raw_score(fourier(x, model["centre"], model["scale"]), model["weights"])
    level = np.interp((raw + 1) / 3 * STEPS, model["at"], model["mean"])
    return np.clip((1 - RAW_SHARE) * level + RAW_SHARE / (1 + np.exp(-np.clip(4 * raw - 2, -30, 30))), 0, 1)


def held_out(doc_id: str, modulus: int = 5, remainder: int = 0):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels other than 0 and 1 and labels of unknown documents are left out; of
    several labels of one document the largest counts. Without both classes among
    the labels every score is the one class, or 0.
    """
    found = cut(described(docs, id_column, text_column))
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
    marked = marked.agg(F.max("quality").cast("int").alias("label")).where(~held_out("doc_id"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    model = fit(cut(found.join(marked, "doc_id").select("statistics", "label", half)))
    kind = found.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = probability(model, _matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return found.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
