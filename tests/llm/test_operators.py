"""Corpus operators against brute force on small tables with nulls, ties, copies and long texts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from sightline.llm import (
    block_labeller,
    jaccard_join,
    multi_index,
    packing,
    quality_classifier,
    quality_rules,
    sharding,
    suffix_dedup,
    toxicity,
    word_table,
)
from sightline.llm.common import tokenizer_path

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("_key", T.StringType()),
        T.StructField("_n", T.StringType()),
    ]
)


def _texts():
    dice = random.Random(5)
    names = [f"w{i}" for i in range(400)]
    base = [" ".join(dice.choice(names) for _ in range(120)) for _ in range(12)]
    near = base[0].split()
    near[60] = "other"
    passage = " ".join(dice.choice(names) for _ in range(70))
    long = " ".join(dice.choice(names) for _ in range(6000))
    some = [None, "", " \t\n", "one two", "One TWO", "héllo wörld “quoted” 12'34", "x" * 450]
    some += base + [" ".join(near), base[1], base[1], long]
    some += [base[2] + " " + passage, base[3] + " " + passage, passage[:199], "It's  9 o'clock\n\n<s> don't ﬁne"]
    return some


@pytest.fixture(scope="module")
def texts():
    return _texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, None if i % 3 else "u", None if i == 4 else "en", "hot", t, None if t is None else len(t), "k", "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    kinds = "doc_id long, toxic int, quality int"
    return spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(30)] + [(None, None, None)], kinds)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_sharding_keeps_equal_texts_together(docs, texts):
    rows = sharding.assign(docs, 4).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    home, slots, sizes = {}, collections.defaultdict(list), collections.Counter()
    for r in rows:
        text = texts[r["doc_id"]] or ""
        data = text.encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert home.setdefault(text, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The long text is a shard of its own; the other three are near equal.
    rest = sorted(sizes.values())[:3]
    assert max(rest) - min(rest) <= 1100


def test_multi_index_against_brute_force(spark):
    dice = np.random.default_rng(3)
    rows = [(i, [float(v) for v in dice.normal(size=8).astype("float32")], "x") for i in range(300)]
    rows += [(300, None, "x"), (301, [0.0] * 8, "x"), (302, [float("nan")] + [1.0] * 7, "x"), (303, [None] * 8, "x")]
    rows.append((304, rows[7][1], "x"))
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    asked = vectors.where("vec_id % 20 = 0")
    good = {r[0]: np.array(r[1]) for r in rows if r[0] not in (300, 301, 302, 303)}
    want = {}
    for q in (i for i in good if i % 20 == 0):
        order = sorted((-float(good[q] @ v), i) for i, v in good.items() if i != q)
        want[q] = [i for _, i in order[:20]]
    whole = collections.defaultdict(list)
    for r in sorted(multi_index.search(vectors, asked, share=1.0).collect(), key=lambda r: r["rank"]):
        whole[r["query_id"]].append(r["vec_id"])
        assert r["score"] == pytest.approx(float(good[r["query_id"]] @ good[r["vec_id"]]), abs=1e-12)
    assert dict(whole) == want
    found = [(r["query_id"], r["vec_id"]) for r in multi_index.search(vectors, asked).collect()]
    hits = sum(v in want[q] for q, v in found)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_multi_index_holds_little_at_once(spark, monkeypatch):
    dice = np.random.default_rng(4)
    data = dice.normal(size=(400, 8)).round(1)
    data[100:140] = data[100]
    books = [multi_index.centroids(data[:, :4], 6), multi_index.centroids(data[:, 4:], 6)]
    counts = np.bincount(multi_index.quantise(data, books), minlength=36)
    asked = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(data.tolist())], ["vec_id", "v"])
    cells = sum(len(multi_index.traverse(v, books, counts, 300)) for v in data)
    monkeypatch.setattr(multi_index, "ROUTES_AT_ONCE", 50)
    found = list(multi_index._router(books, counts, 300, np.full(6, 2))([asked]))
    assert max(b.num_rows for b in found) < 50 + 12
    # A vector moves once for each group and block, whatever the number of cells.
    assert sum(b.num_rows for b in found) <= 400 * 12
    assert sum(len(c) for b in found for c in b.column("cells").to_pylist()) == 2 * cells
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(data.tolist())], "vec_id long, embedding array<double>")
    want = {(r["query_id"], r["rank"]): r["vec_id"] for r in multi_index.search(vectors, vectors, share=0.7).collect()}
    for name, size in (("BLOCK", 16), ("QUERY_BLOCK", 64), ("PRODUCTS_AT_ONCE", 64), ("PAIRS_AT_ONCE", 7), ("FOUND_AT_ONCE", 100)):
        monkeypatch.setattr(multi_index, name, size)
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in multi_index.search(vectors, vectors, share=0.7).collect()}
    assert got == want and len(got) == 400 * 20


def _measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    signs = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), signs, len(lines) - len(set(lines)), len(covered)


def test_quality_rules_measure_whole_texts(spark, docs, texts):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    again = "a b c d e f g h i j\n" * 9
    more = spark.createDataFrame([(900, "u", None, None, again, 1, "k", "n")], DOCS)
    got = {r["doc_id"]: r for r in quality_rules.judge(docs.unionByName(more)).collect()}
    assert len(got) == len(texts) + 1
    for i, text in [*enumerate(texts), (900, again)]:
        want = _measured(text)
        assert tuple(got[i][n] for n in names) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert got[i]["base_failed"] == failed
        assert not (failed and got[i]["kept"])
    assert all(got[i]["kept"] for i in range(7, 19))


def test_quality_rules_keep_what_they_judge_well(docs, none):
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in quality_rules.judge(docs).collect() if r["kept"]}
    assert quality_rules.keep(none).collect() == []


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(str(tokenizer_path("byte_bpe_50k.json")))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(docs).collect():
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in enumerate(texts):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048


def test_packing_encodes_each_run_once_as_the_library_does(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    from sightline.llm.common import tokenizer_text

    source = tokenizer_text("byte_bpe_50k.json")
    coder, encoder = Tokenizer.from_str(source), packing._Encoder(source)
    dice = random.Random(8)
    parts = ["a", "B", "é", "ß", "1", "9", "'s", "'", "don't", ".", "#", " ", " ", "  ", "\n", "\r\n", "\t", "\x0b", "\x1c", "\x85", "\xa0"]
    parts += ["\u2003", "\u3000", "字", "\U0001f600", "\u0301", "²", "“", "ế", "<|endoftext|>", "\0"]
    texts = ["", *("".join(dice.choices(parts, k=dice.randrange(30))) for _ in range(1500)), ""]
    want = [np.array(coder.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert list(encoder(pa.array(["cut off", *texts]).slice(1))) == want
    monkeypatch.setattr(packing, "SLICE_BYTES", 4000)
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 2000)
    assert list(encoder(pa.array(texts))) == want
    # Words met before cost no call of the library; nothing stays when a task ends.
    monkeypatch.undo()
    encoder.forget()
    calls, ids = [], encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda text: calls.append(text) or ids(text))
    list(encoder(pa.array(["one two three,###", "two one three"] * 500)))
    assert sorted(" ".join(calls).split("\n")) == sorted(["one", " two", " three", ",###", "two", " one"])
    encoder.forget()
    assert len(encoder.known) == len(encoder.flat) == 0


def test_word_table_is_the_tokenizer(docs, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(str(tokenizer_path("word_bpe_49k.json")))
    coder.no_truncation()
    coder.no_padding()
    got = {r["doc_id"]: r for r in word_table.coded(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        ids = coder.encode(text or "", add_special_tokens=False).ids
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_text"] == " ".join(map(str, ids))
        assert got[i]["decoded"] == coder.decode(ids, skip_special_tokens=False)


def test_suffix_dedup_against_brute_force(docs, texts):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[k : k + 200] for t in data for k in range(len(t) - 199))
    got = {r["doc_id"]: r for r in suffix_dedup.remove(docs).collect()}
    cut = {r["doc_id"]: r for r in suffix_dedup.trimmed(docs).collect()}
    for i, text in enumerate(data):
        gone = bytearray(len(text))
        for k in range(len(text) - 199):
            if seen[text[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        left = bytes(b for b, x in zip(text, gone, strict=True) if not x)
        runs = sum(1 for k in range(len(text)) if gone[k] and (k == 0 or not gone[k - 1]))
        row = got[i]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(text), sum(gone), runs)
        assert row["kept_sha256"] == hashlib.sha256(left).hexdigest()
        assert (cut[i]["text"] or "") == left.decode("utf-8", "ignore")


def test_jaccard_join_against_brute_force(docs, texts):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))
    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link(docs).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert {r["doc_id"] for r in jaccard_join.thin(docs).collect()} == set(root)


def test_jaccard_join_writes_a_forest_of_links(spark, monkeypatch):
    """Many variants of one text in several components: links grow with the sets, not with their pairs (op8, pipeline)."""
    dice = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(150):
        words = list(base)
        # Up to 12 changed words change up to 60 shingles: some variants link, some do not.
        for k in dice.sample(range(200), dice.randint(0, 12)):
            words[k] = f"c{dice.randint(0, 3)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(texts)))
    for j, b in enumerate(sets):
        for i, a in enumerate(sets[:j]):
            if 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    links, make = [], jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda *a: links.append(make(*a)) or links[-1])
    # By several blocks.
    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.link(docs).collect()} == dict(enumerate(root))
    assert links[0].count() < 10 * len(texts)


def test_jaccard_join_rounds_of_components_shrink(spark, monkeypatch):
    """What is settled leaves the rounds: a chain in random order does not come back whole in each (op8, pipeline)."""
    names = random.Random(21).sample(range(10**9), 24)
    chain = spark.createDataFrame([(min(p), max(p)) for p in zip(names, names[1:], strict=False)], "a long, b long")
    written, cut = [], jaccard_join.cut

    def counted(frame):
        made = cut(frame)
        written.append(made.count())
        return made

    monkeypatch.setattr(jaccard_join, "cut", counted)
    # As if each link were in a partition of its own.
    monkeypatch.setattr(jaccard_join, "_contracted", lambda links: links)
    got = {r["key"]: r["root"] for r in jaccard_join._components(chain).collect()}
    assert got == dict.fromkeys(names, min(names))
    assert sum(written) < 9 * len(names)


@pytest.mark.parametrize("dense", [2, 4, 1000])
@pytest.mark.parametrize("sides", [[1], [0, 2]])
def test_jaccard_join_block_keeps_components(monkeypatch, dense, sides):
    """Common elements are counted exactly by matrices and by pairs; the links are a forest."""
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 7)
    dice = random.Random(12)
    sets = [np.array(sorted({*range(40)} ^ {dice.randrange(60) for _ in range(dice.randint(0, 7))}), np.uint64) for _ in range(30)]
    side = [dice.choice(sides) for _ in sets]
    block = pa.table({"key": pa.array(range(30), pa.int64()), "side": side, "elements": [s.tobytes() for s in sets]})
    found = jaccard_join._linked(block).to_pydict()

    def parts(links):
        root = list(range(30))
        for a, b in links:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
        return root

    close = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b))
    all_links = [(i, j) for j in range(30) for i in range(j) if (side[i] == 1 or side[i] != side[j]) and close(sets[i], sets[j])]
    links = list(zip(found["a"], found["b"], strict=True))
    assert set(map(tuple, map(sorted, links))) <= set(all_links)
    assert parts(links) == parts(all_links)
    assert len(links) == 30 - len(set(parts(all_links))) < len(all_links)


def test_block_labeller_reads_pages(spark):
    page = "<html><body><nav><a>Home</a></nav><article><p>First  part&amp;{0}</p><p>Second\n part</p></article><footer>End</footer></body></html>"
    rows = [(i, "u", page.replace("{0}", str(i))) for i in range(60)] + [(60, None, None), (61, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in block_labeller.extract(pages).collect()}
    assert got[60]["text"] == got[61]["text"] == "" and len(got) == 62
    assert got[7]["text"] == "First part&7\n\nSecond part"
    assert got[7]["n_chars"] == len(got[7]["text"])


@pytest.mark.parametrize("judge", [toxicity.judge, quality_classifier.judge])
def test_classifiers_score_every_text(docs, labels, texts, judge):
    modulus, left = (4, 2) if judge is toxicity.judge else (5, 0)
    got = {r["doc_id"]: r for r in judge(docs, labels).collect()}
    assert len(got) == len(texts)
    for i, r in got.items():
        assert 0 <= r["score"] <= 1
        assert r["predicted"] == (r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % modulus == left)
    # Equal texts get equal scores.
    assert got[8]["score"] == got[20]["score"] == got[21]["score"]


@pytest.mark.parametrize("name", ["sharding", "rules", "packing", "words", "suffixes", "join", "thin", "trimmed", "toxic", "quality"])
def test_empty_tables(none, labels, name):
    run = {
        "sharding": sharding.assign,
        "rules": quality_rules.judge,
        "packing": packing.pack,
        "words": word_table.coded,
        "suffixes": suffix_dedup.remove,
        "join": jaccard_join.link,
        "thin": jaccard_join.thin,
        "trimmed": suffix_dedup.trimmed,
        "toxic": lambda d: toxicity.judge(d, labels),
        "quality": lambda d: quality_classifier.judge(d, labels),
    }[name]
    assert run(none).collect() == []


def test_pipeline_hands_python_small_batches(spark, monkeypatch):
    """Rows reach Python by bytes, not by whole splits of the table (pipeline)."""
    import corpus_pipeline

    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat('x', 2000) AS text")

    def sizes(docs, *_):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

        return docs.mapInArrow(run, "n long")

    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: docs)
    for (_, stage), (module, name) in zip(
        corpus_pipeline.STAGES[1:], [("toxicity", "keep"), ("jaccard_join", "thin"), ("suffix_dedup", "trimmed"), ("packing", "pack")], strict=True
    ):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        monkeypatch.setattr(getattr(corpus_pipeline, module), name, sizes)
        assert max(r["n"] for r in stage(spark, docs, "").collect()) < 3_000_000
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
