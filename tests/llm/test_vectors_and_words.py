"""Whitening, tiled comparison and spelling variants against brute force."""

import collections
import re
import zlib

import numpy as np
import pytest

from sightline.llm import spelling, tiled_cosine, whitening

VECTORS = "vec_id long, embedding array<float>, key string, n string, root string"


@pytest.fixture(scope="module")
def rows():
    dice = np.random.default_rng(8)
    base = dice.normal(size=(60, 12))
    near = np.repeat(base[:6], 40, axis=0) + dice.normal(size=(240, 12)) * 0.08
    data = [(i, [float(x) for x in v.astype("float32")]) for i, v in enumerate(np.concatenate([base, near]))]
    data += [(300 + k, data[7][1]) for k in range(30)]
    data += [(400, [2 * x for x in data[7][1]]), (7, data[9][1])]
    data += [(500, None), (501, []), (502, [0.0] * 12), (503, [float("nan")] + [1.0] * 11), (504, [None] * 12)]
    data += [(505, [float("inf")] * 12), (506, [1.0] * 5), (None, data[3][1])]
    return data


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VECTORS).repartition(3).cache()


def able(v):
    return v is not None and len(v) == 12 and None not in v and np.isfinite(v).all()


@pytest.mark.parametrize("tile", [8192, 64])
def test_tiled_cosine_against_brute_force(vectors, rows, monkeypatch, tile):
    monkeypatch.setattr(tiled_cosine, "MOST_TILE", tile)
    monkeypatch.setattr(tiled_cosine, "LEAST_TILE", tile)
    monkeypatch.setattr(tiled_cosine, "BLOCK", 16)
    some = [(i, np.array(v, float)) for i, v in rows if i is not None and able(v) and any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in some])
    linked = u @ u.T >= 0.95
    label = list(range(len(some)))
    for i, j in zip(*np.nonzero(linked), strict=True):
        low, high = sorted((label[i], label[j]))
        label = [low if x == high else x for x in label]
    first = {}
    for (i, _), x in zip(some, label, strict=True):
        first[x] = min(first.get(x, i), i)
    want = [(i, int(linked[k].sum()) - 1, first[label[k]], first[label[k]] == i) for k, (i, _) in enumerate(some)]
    want += [(i, 0, i, True) for i, v in rows if not (i is not None and able(v) and any(v))]
    got = [tuple(r) for r in tiled_cosine.link(vectors).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_whitening_against_a_dense_solver(vectors, rows):
    kept = [(i, np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000) for i, v in rows if able(v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    got = collections.defaultdict(list)
    for r in whitening.whiten(vectors).collect():
        got[r["vec_id"], r["component"]].append(r)
    assert sum(map(len, got.values())) == 12 * len(kept)
    white = {c: collections.defaultdict(list) for c in range(1, 13)}
    for i, x in kept:
        for c in range(1, 13):
            white[c][i].append(((n * x - sums) / n) @ axes[:, c - 1] / np.sqrt(values[c - 1]))
            r = got[i, c][0]
            assert (r["n"], r["identity_error"] < 1e-9) == (n, True)
            assert r["explained"] == pytest.approx(values[c - 1] / values.sum())
    deviations = collections.Counter((i, int(((n * x - sums) ** 2).sum())) for i, x in kept)
    assert collections.Counter((r["vec_id"], r["deviation"]) for rs in got.values() for r in rs if r["component"] == 1) == deviations
    for c, of in white.items():
        sign = np.sign(of[1][0] * got[1, c][0]["whitened"])
        for i, expected in of.items():
            assert sorted(sign * r["whitened"] for r in got[i, c]) == pytest.approx(sorted(expected), abs=1e-9)


def test_whitening_filters_and_certifies(spark):
    dice = np.random.default_rng(4)
    x = dice.normal(size=(500, 40)) * np.linspace(1.0, 1.6, 40)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(dict)
    for r in whitening.whiten(frame, components=3).collect():
        found[r["vec_id"]][r["component"]] = r["whitened"]
    whole = np.floor(64 * x)
    centred = whole - whole.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / 500)
    for c in (1, 2, 3):
        want = centred @ axes[:, -c] / np.sqrt(values[-c])
        got = np.array([found[i][c] for i in range(500)])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8


def test_vectors_without_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert tiled_cosine.link(none).collect() == []
    assert whitening.whiten(none).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], "", "", "")] * 2, VECTORS)
    assert whitening.whiten(one).collect() == []
    assert [tuple(r) for r in tiled_cosine.link(one).collect()] == [(1, 1, 1, True)] * 2


def variants_by_hand(rows):
    counts = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    near = {w: [v for v in words if v != w and edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("full", [4096, 3])
def test_spelling_against_brute_force(spark, monkeypatch, full):
    # A low bound sends tiles through the split by positions.
    monkeypatch.setattr(spelling, "FULL", full)
    monkeypatch.setattr(spelling, "DENSE", 4)
    monkeypatch.setattr(spelling, "BLOCK", 3)
    dice = np.random.default_rng(6)
    words = ["correct", "corect", "correctly", "CORRECT", "coérect", "aaaaaa", "aaaaaaa", "aaaaaaaa", "bbbbbbbbbbbbbbbbbbbbbbbbb"]
    words += ["cornect", "borrect", "correcs", "corrects", "aaaaab", "baaaaa", "bbbbbbbbbbbbbbbbbbbbbbbb", "short", "x" * 3000]
    share = dice.dirichlet(np.ones(len(words)) * 0.4)
    rows = [(None if i % 50 == 0 else i, " ".join(dice.choice(words, 30, p=share)) + ", İx") for i in range(400)]
    rows += [(7, rows[7][1]), (8, None), (9, ""), (10, " ".join(words * 6))]
    frame = spark.createDataFrame([(i, t, "w", 1, "f") for i, t in rows], "doc_id long, text string, word string, n int, form string")
    got = {tuple(r) for r in spelling.variants(frame.repartition(3)).collect()}
    assert got == variants_by_hand(rows)
    assert spelling.variants(frame.limit(0)).collect() == []


def test_sums_take_few_tasks_in_a_wide_shuffle(spark):
    """Small slices are added by a few tasks, however many partitions a shuffle has."""
    from sightline.llm.sums import SLICE, summed

    context, before = spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    size = 64 * SLICE
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        context.setJobGroup("sums", "sums")
        total = summed(spark.range(0, 100, 1, 3), lambda batch: np.full(size, float(batch.num_rows)), size)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert total.tolist() == [100.0] * size
    status = context.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("sums") for s in status.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) <= 8


def test_whitening_passes_over_few_parts_need_no_shuffle(spark, monkeypatch):
    """A pass over a small fit list is one stage; the sums are those of the shuffle, bit for bit."""
    from sightline.llm import sums

    rows = spark.range(0, 300, 1, 3)
    part = lambda batch: np.sqrt(batch.column("id").to_numpy().astype(float).sum() + np.arange(700))
    few = sums.summed(rows, part, 700, 3)
    assert few.tobytes() == sums.summed(rows, part, 700).tobytes()
    vectors = spark.createDataFrame([(i, [float((i * k) % 7) for k in (1, 2, 3)]) for i in range(40)], "vec_id long, embedding array<double>")
    given, summed = [], sums.summed
    monkeypatch.setattr(whitening, "summed", lambda *a: given.append(a[3]) or summed(*a))
    assert whitening.whiten(vectors).count() == 120 and set(given) == {1}
    plans = []
    monkeypatch.setattr(type(rows), "repartition", lambda *a: plans.append(a))
    sums.summed(rows, part, 700, 3)
    assert plans == []
