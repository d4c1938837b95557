"""Exact similarity join of documents on word shingles, by PartEnum signatures.

Two sets of sizes a and b with Jaccard similarity 3/4 or more differ in at most
(a + b) / 7 elements. The hashed domain of elements is cut into parts. With more
parts than differences, two similar sets agree on some part; with spare parts
they agree on one even after each set sets aside its least telling ones. The
part, with the elements a set has in it, is a signature, and similar sets of one
size band share one.

Only sets that can link at all get that far: a set lacks at most a quarter of its
elements in a similar one, so if more of them are in no other set, none is
similar. One half of the domain of elements is enough to tell most such sets.

Groups of sets sharing a signature overlap, so they are joined to units. Every
set is sent to its unit once for each block of it, where common elements are
counted exactly, and a block writes the links of a forest, not all its pairs.
Copies are one set throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.llm.common import whole_text
from sightline.llm.kernels import U, mix, pair, shingles
from sightline.session import cut

WORDS = 5
# Similar: 100 * common >= 75 * union.
PERCENT = 75
# Signatures that one bucket of the shuffle should hold.
BUCKET_SIGNATURES = 2_000_000
# Sets with at most so many possible differences enumerate subsets of parts.
ENUMERATED = 5
# Share of parts that a larger set may set aside.
SPARE = 0.22
# Sets and elements in one block of a unit.
BLOCK, BLOCK_ELEMENTS = 2048, 1_000_000
# An element in at least so many sets of two blocks is counted by matrices, so many elements at once.
DENSE, COLUMNS = 32, 4096
_ONE = np.ones(1, np.uint64)


@cache
def band(i: int) -> tuple[int, int]:
    """First and last size of a band; a similar set is in the same band or in the next."""
    first = 1
    for _ in range(i):
        first = first * 4 // 3 + 1
    return first, first * 4 // 3


@cache
def band_of(size: int) -> int:
    i = 0
    while band(i)[1] < size:
        i += 1
    return i


def signatures(found: np.ndarray, seed: int = 0) -> np.ndarray:
    """All signatures of a set of hashes: those of its own band and of the one below."""
    home = band_of(len(found))
    out = []
    for i in (home, home - 1):
        # A pair is compared in the band of its smaller set.
        if i < 0 or len(found) * PERCENT > 100 * band(i)[1]:
            continue
        last = band(i)[1]
        most = (last + last * 100 // PERCENT) * (100 - PERCENT) // (100 + PERCENT)
        salt = mix(_ONE * U(1_000_003 * i + seed + 17))
        if most <= ENUMERATED:
            out.append(_subsets(found, most, salt))
        else:
            out.append(_parts(found, most, salt))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _subsets(found: np.ndarray, most: int, salt: np.ndarray) -> np.ndarray:
    """Leave out ``most`` of ``most + 3`` parts, in all ways: one way leaves out all differences."""
    parts = most + 3 if most else 1
    of = (mix(found ^ salt) % U(parts)).astype(np.int64)
    sums = np.array([np.add.reduce(mix(found[of == p] + salt)) for p in range(parts)], np.uint64)
    kept = [list(c) for c in combinations(range(parts), parts - most)]
    return np.array([mix(salt + U(k) + pair(sums[c].cumsum()[-1:], sums[c][:1]))[0] for k, c in enumerate(kept)], np.uint64)


def _parts(found: np.ndarray, most: int, salt: np.ndarray) -> np.ndarray:
    """One signature for each part, but for the spare ones with fewest elements.

    Similar sets agree on more parts than are spare. Setting aside the first of
    each in one order of all signatures therefore keeps a common one.
    """
    parts = int((most + 1) / (1 - SPARE)) + 2
    spare = parts - most - 1
    of = (mix(found ^ salt) % U(parts)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    counts = np.bincount(of, minlength=parts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found[order] + salt), dtype=np.uint64)])
    ends = np.cumsum(counts)
    made = mix(pair(sums[ends] - sums[ends - counts] + salt, np.arange(parts, dtype=np.uint64)))
    return made[np.lexsort((made, counts))[spare:]]


def set_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a, b = np.add.reduce(mix(found + U(3))), np.bitwise_xor.reduce(mix(found ^ U(0x5851F42D4C957F2D)))
    return int(np.int64(mix(_ONE * a)[0].astype(np.int64))), int(np.int64(mix(_ONE * b)[0].astype(np.int64)))


def reduced(found: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit rest of hashes, each two once."""
    bucket, rest = found % U(buckets), (found // U(buckets) >> U(8)).astype(np.uint32)
    both = np.unique(bucket << U(32) | rest)
    return (both >> U(32)).astype(np.int32), both.astype(np.uint32)


class _Packer:
    """Gathers the hashes of sets and packs them by bucket: keys, a number for each and so many 32-bit rests."""

    schema = "bucket int, keys binary, numbers binary, rests binary"
    fields = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary()), ("rests", pa.binary())])

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, key: int, found: np.ndarray) -> int:
        bucket, rest = reduced(found, self.buckets)
        self.parts.append((np.full(len(rest), key, np.int64), bucket, rest))
        return len(rest)

    def rows(self) -> pa.RecordBatch:
        if not sum(len(x[0]) for x in self.parts):
            return pa.RecordBatch.from_pylist([], self.fields)
        key, bucket, rest = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(bucket, kind="stable")
        key, bucket, rest = key[order], bucket[order], rest[order]
        firsts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])])
        upto = np.r_[firsts, len(key)]
        numbers = np.diff(upto).astype(np.uint32)
        of = bucket[firsts]
        cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True])
        packed = [
            (key[firsts[a:b]].tobytes(), numbers[a:b].tobytes(), rest[upto[a] : upto[b]].tobytes())
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        columns = [pa.array(c, pa.binary()) for c in zip(*packed, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(of[cuts[:-1]], pa.int32()), *columns], schema=self.fields)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and rests of one bucket, sorted by rest and key, each two once."""
    column = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    key = np.repeat(column("keys", np.int64), column("numbers", np.uint32))
    rest = column("rests", np.uint32)
    order = np.lexsort((key, rest))
    key, rest = key[order], rest[order]
    fresh = np.r_[True, (rest[1:] != rest[:-1]) | (key[1:] != key[:-1])] if len(rest) else np.zeros(0, bool)
    return key[fresh], rest[fresh]


def _sets(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, n and key of the set of every row, and rows with a bucket: half the domain of elements, packed.

    ``own`` is the number of elements of a set that are sent. A task sends a set
    once, however many copies it meets.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, int] = {}
        for batch in batches:
            made, packer = [], _Packer(buckets)
            for text in batch.column("text"):
                found = shingles(text.as_py(), WORDS)
                key = set_key(found)[0] if len(found) else 0
                own = sent.get(key) if len(found) else 0
                if own is None:
                    # Sorted, so the lower half of the domain comes first.
                    own = packer.add(key, found[: np.searchsorted(found, U(1 << 63))])
                    if len(sent) < 1_000_000:
                        sent[key] = own
                made.append((len(found), key, own))
            n, key, own = (pa.array(c, pa.int64()) for c in (zip(*made, strict=True) if made else ([], [], [])))
            ids, halves = batch.column("doc_id"), packer.rows()
            names = ["doc_id", "n", "key", "own", *halves.schema.names]
            none = [pa.nulls(len(ids), x.type) for x in halves.schema]
            yield pa.RecordBatch.from_arrays([ids, n, key, own, *none], names)
            if len(halves):
                none = [pa.nulls(len(halves), x) for x in (ids.type, *[pa.int64()] * 3)]
                yield pa.RecordBatch.from_arrays([*none, *halves.columns], names)

    return docs.mapInArrow(run, f"doc_id {kind}, n long, key long, own long, {_Packer.schema}")


def _shared(halves: DataFrame, buckets: int) -> DataFrame:
    """key and m of the sets of which other sets have m > 0 elements in the half sent."""

    def met(table: pa.Table) -> pa.Table:
        key, rest = _unpacked(table)
        again = rest[1:] == rest[:-1]
        several = np.concatenate([[False], again]) | np.concatenate([again, [False]]) if len(rest) else np.zeros(0, bool)
        key, m = np.unique(key[several], return_counts=True)
        part = key % buckets
        order = np.argsort(part, kind="stable")
        key, m, part = key[order], m[order].astype(np.int64), part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
        ends = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.table(
            {
                "part": pa.array(part[cuts[:-1]], pa.int64()),
                "keys": pa.array([key[a:b].tobytes() for a, b in ends], pa.binary()),
                "ms": pa.array([m[a:b].tobytes() for a, b in ends], pa.binary()),
            }
        )

    def summed(table: pa.Table) -> pa.Table:
        keys, ms = (np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("keys", "ms"))
        key, at = np.unique(keys, return_inverse=True)
        m = np.zeros(len(key), np.int64)
        np.add.at(m, at, ms)
        return pa.table({"key": key, "m": m})

    parts = halves.groupBy("bucket").applyInArrow(met, "part long, keys binary, ms binary")
    return parts.groupBy("part").applyInArrow(summed, "key long, m long")


def _contents(docs: DataFrame, wanted: DataFrame, keyed: DataFrame) -> DataFrame:
    """key, n and elements of the wanted sets, read off one document each."""
    one = keyed.join(wanted, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    chosen = docs.join(one, "doc_id").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(k, shingles(t.as_py(), WORDS)) for k, t in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True)]
            # Of several rows with one id, only those with the wanted set.
            made = [(k, s) for k, s in made if len(s) and set_key(s)[0] == k]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in made], pa.int64()),
                    pa.array([len(s) for _, s in made], pa.int64()),
                    pa.array([s.tobytes() for _, s in made], pa.binary()),
                ],
                ["key", "n", "elements"],
            )

    return chosen.mapInArrow(run, "key long, n long, elements binary").dropDuplicates(["key"])


def _packed(contents: DataFrame, buckets: int) -> DataFrame:
    """Signatures of sets, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packer = _Packer(buckets)
            for key, found in zip(batch.column("key").to_pylist(), batch.column("elements"), strict=True):
                packer.add(key, signatures(np.frombuffer(found.as_buffer(), np.uint64)))
            yield packer.rows()

    return contents.select("key", "elements").mapInArrow(run, _Packer.schema)


def _groups(table: pa.Table) -> pa.Table:
    """Groups of sets sharing a signature, each list of members once: rows (group, key)."""
    key, sig = _unpacked(table)
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(sig)])
    out_group, out_key, seen = [], [], set()
    for at, size in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
        members = key[at : at + size]
        name = set_key(members.view(np.uint64))[0]
        if name not in seen:
            seen.add(name)
            out_group.append(np.full(size, name, np.int64))
            out_key.append(members)
    empty = np.zeros(0, np.int64)
    return pa.table(
        {
            "group": np.concatenate(out_group) if out_group else empty,
            "key": np.concatenate(out_key) if out_key else empty,
        }
    )


def _units(groups: DataFrame) -> DataFrame:
    """(unit, key): groups (group, key, n) that overlap are one unit, apart by their least size.

    All sets of a group are in one unit, at most (4/3)^3 apart in size.
    """
    least = groups.groupBy("group").agg(F.min("n").alias("_n"), F.min("key").alias("_first"))
    level = F.floor(F.log("_n") / F.log(F.lit(4 / 3)))
    met = groups.join(least, "group").select(level.alias("level"), "_first", "key").distinct()
    node = lambda c: F.xxhash64("level", c)
    nodes = cut(met.select(node("_first").alias("a"), node("key").alias("b"), "key"))
    roots = _components(nodes.select("a", "b").distinct())
    members = nodes.select("b", "key").distinct()
    return members.join(roots, members["b"] == roots["key"]).select(F.col("root").alias("unit"), members["key"])


def _common(row: np.ndarray, column: np.ndarray, first: int, skip: int, rows: int, kind: type) -> np.ndarray:
    """Numbers of common elements of the rows below ``first`` and those from ``skip`` on.

    ``row`` and ``column`` are the ones of a matrix, sorted by column and row.
    """
    found = np.zeros((first, rows - skip), kind)
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    counts = np.diff(np.r_[starts, len(column)])
    each = np.repeat(counts, counts)
    few = (each > 1) & (each < DENSE)
    r, c = row[few], column[few]
    for k in range(1, DENSE):
        same = np.flatnonzero(c[k:] == c[:-k])
        if not len(same):
            break
        left, right = r[same], r[same + k]
        met = (left < first) & (right >= skip)
        found += np.bincount(left[met].astype(np.int64) * (rows - skip) + right[met] - skip, minlength=found.size).reshape(found.shape)
    if skip == 0:
        found += found.T
    r, c = row[each >= DENSE], np.unique(column[each >= DENSE], return_inverse=True)[1]
    for at in range(0, int(c.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(c, [at, at + COLUMNS])
        ones = np.zeros((rows, COLUMNS), kind)
        ones[r[a:b], c[a:b] - at] = 1
        found += ones[:first] @ ones[skip:].T
    return found


def _linked(table: pa.Table) -> pa.Table:
    """Links (a, b) that connect what is similar in one block of a unit, or across two: a forest of them."""
    table = table.sort_by("side")
    key, side = table.column("key").to_numpy(), table.column("side").to_numpy()
    held = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("elements")]
    n = np.array([len(x) for x in held], np.int64)
    rows, first, skip = len(key), int((side <= 1).sum()), int((side < 1).sum())
    kind = np.float32 if n.max(initial=0) < 1 << 24 else np.float64
    column = np.unique(np.concatenate(held), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row = np.repeat(np.arange(rows, dtype=np.int32), n)[order]
    common = _common(row, column[order], first, skip, rows, kind).astype(np.int64)
    union = n[:first, None] + n[None, skip:] - common
    similar = np.zeros((rows, rows), bool)
    similar[:first, skip:] = 100 * common >= PERCENT * union
    similar |= similar.T
    a, b = [], []
    new = np.ones(rows, bool)
    for start in range(rows):
        if not new[start]:
            continue
        new[start] = False
        found = [start]
        while found:
            at = found.pop()
            near = np.flatnonzero(similar[at] & new)
            new[near] = False
            found.extend(near.tolist())
            a.append(np.full(len(near), key[at]))
            b.append(key[near])
    empty = [np.zeros(0, np.int64)]
    return pa.table({"a": np.concatenate(a or empty), "b": np.concatenate(b or empty)})


def _links(units: DataFrame, contents: DataFrame) -> DataFrame:
    """Links (a, b) that connect all similar sets of each unit.

    A unit is cut into blocks of bounded size. Every block, and every two, meet
    in a task of their own.
    """
    members = units.join(contents.select("key", "n"), "key")
    sized = members.groupBy("unit").agg(F.count("*").alias("_m"), F.sum("n").alias("_e"))
    blocks = F.greatest(F.ceil(F.col("_m") / BLOCK), F.ceil(F.col("_e") / BLOCK_ELEMENTS)).cast("int")
    met = units.join(sized, "unit").withColumn("own", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    # Side 0 and 2 for the first and second of two blocks, 1 where both are one.
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(
            F.least(k, F.col("own")).alias("x"),
            F.greatest(k, F.col("own")).alias("y"),
            F.when(k == F.col("own"), 1).when(F.col("own") < k, 0).otherwise(2).alias("side"),
        ),
    )
    sent = met.join(contents.select("key", "elements"), "key").select("unit", "key", "elements", F.inline(pairs))
    return sent.groupBy("unit", "x", "y").applyInArrow(_linked, "a long, b long")


def _contracted(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components, a the smallest key that a partition of ``links`` connects with b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = up
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        keys = list(root)
        yield pa.RecordBatch.from_arrays([pa.array([find(x) for x in keys], pa.int64()), pa.array(keys, pa.int64())], ["a", "b"])

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def _flat(up: DataFrame) -> DataFrame:
    """(key, root) of trees (key, root), where a root may be a key itself: now the root of the whole tree."""
    while True:
        above = up.select(F.col("key").alias("_key"), F.col("root").alias("_root"))
        met = up.join(above, up["root"] == above["_key"], "left")
        moved = cut(met.select("key", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        up = moved.select("key", "root")
        if moved.where("moved").isEmpty():
            return up


def _components(links: DataFrame) -> DataFrame:
    """(key, root) of every linked key: smallest key reachable.

    In a round each key hangs from the least one it is linked with, if that is
    smaller, and the trees become the keys of the next round. What hangs leaves
    the rounds, and only links between trees go on, so all rounds together join
    about as many rows as the first. Two rounds at least halve the keys.
    """
    # Partitions settle what they hold first, by the larger key, as the smallest may be in all.
    links = cut(_contracted(links.repartition("b")).where("a <> b"))
    trees: list[DataFrame] = []
    while not links.isEmpty():
        up = _flat(cut(links.groupBy(F.col("b").alias("key")).agg(F.min("a").alias("root"))))
        trees.append(up)
        for end in ("a", "b"):
            named = up.select(F.col("key").alias(end), F.col("root").alias("_root"))
            links = links.join(named, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
        links = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rooted = trees.pop() if trees else links.select(F.col("b").alias("key"), F.col("a").alias("root"))
    while trees:
        up = trees.pop()
        named = rooted.select(F.col("key").alias("_key"), F.col("root").alias("_root"))
        below = up.join(named, up["root"] == named["_key"], "left").select("key", F.coalesce("_root", "root").alias("root"))
        rooted = cut(rooted.unionByName(below))
    return rooted.unionByName(rooted.select(F.col("root").alias("key"), "root").distinct())


def link(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    A null text counts as empty. Documents without words link with nothing and
    carry their own id, as does a row with a null id. Of rows with one id each is
    kept; they link by their texts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).alias("doc_id"), whole_text(text_column).alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A text has about one element for each six bytes, and half of them are sent.
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(width, size // 12 // BUCKET_SIGNATURES + 1)
    made = cut(_sets(texts, buckets))
    sets = made.where("bucket is null").select("doc_id", "n", "key", "own")
    halves = made.where("bucket is not null").select("bucket", "keys", "numbers", "rests")
    shared = _shared(halves.repartition(buckets, "bucket"), buckets)
    keyed = sets.where("n > 0").select("doc_id", "key")
    # A set lacks at most a quarter of its elements in a similar one.
    distinct = sets.where("n > 0").select("key", "n", "own").distinct().join(shared, "key", "left")
    lacking = F.col("own") - F.coalesce("m", F.lit(0))
    possible = distinct.where(lacking <= F.floor(F.col("n") * (100 - PERCENT) / 100)).select("key", "n")
    possible = cut(possible)
    contents = cut(_contents(texts, possible, keyed))
    elements = possible.agg(F.sum("n")).first()[0] or 0
    buckets = max(width, elements // BUCKET_SIGNATURES + 1)
    packed = _packed(contents, buckets).repartition(buckets, "bucket")
    found = packed.groupBy("bucket").applyInArrow(_groups, "group long, key long")
    groups = cut(found.join(possible, "key").distinct())
    units = cut(_units(groups))
    roots = _components(cut(_links(units, contents)))
    rooted = cut(keyed.join(roots, "key", "left").select("doc_id", F.coalesce("root", "key").alias("root")))
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(names, "root").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    return sets.join(named, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def thin(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of linked documents, the one with the smallest id.

    Rows with a null id stay. Of several rows with one id one stays.
    """
    linked = cut(link(docs, id_column, text_column))
    stay = linked.where("component_id = doc_id").select(F.col("doc_id").alias("_stay")).distinct()
    kept = docs.join(stay, docs[id_column] == stay["_stay"], "left_semi")
    counts = linked.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n"))
    if not counts.where("_n > 1").isEmpty():
        kept = kept.dropDuplicates([id_column])
    return kept.unionByName(docs.where(F.col(id_column).isNull()))
