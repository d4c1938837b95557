"""Quality rules whose thresholds follow each language and source.

Every document gets exact counts. Ratios of them go into quantile sketches: a
histogram over buckets that keep the six leading bits of an integer, so that two
sketches merge by adding counts and a quantile is off by less than 1 in 64. A
rule rejects what lies far above the bulk of its own language and source. All of
it is DataFrame functions; a sketch row is a row of a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightline.llm.common import words
from sightline.session import cut

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
# Ratios are held in ten-thousandths.
SCALE = 10_000
# A sketch with fewer documents than this leaves the decision to the one above it.
MIN_SKETCH_ROWS = 100
# A value is rejected above median + max(SPREADS * (q75 - q25), least distance).
SPREADS = 3
LEAST_DISTANCE = {"symbols": 400, "dup_lines": 5000, "repeats": 3000}
_BITS = 6


def bucket(value: Column) -> Column:
    """The lower end of the bucket of a whole number: its six leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - _BITS, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _combined(hashes: str, distance: int) -> Column:
    """Hashes of runs twice as long: each combined with the one ``distance`` further on."""
    run = F.col(hashes)
    pairs = F.transform(run, lambda h, i: F.xxhash64(h, F.get(run, i + distance)))
    return F.slice(pairs, 1, F.greatest(F.size(run) - distance, F.lit(0)))


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """The counts of each document, with its language and source.

    Null texts count as empty. Rows are kept as they are, repeated ids included.
    With ``carry`` the column ``row`` holds the row itself.
    """
    row = [F.struct("*").alias("row")] if carry else []
    carried = ["row"] if carry else []
    text = F.col("text")
    base = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        *row,
    )
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    # Each step names its arrays, as a lambda would evaluate an inlined expression for every element.
    step = base.select(
        *carried,
        "doc_id",
        "lang",
        "source",
        words(text).alias("words"),
        lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    step = step.select(
        "*",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    ).drop("words", "lines")
    # Hashes of one word, then of two, four and eight.
    for distance in (1, 2, 4):
        step = step.withColumn("longer", _combined("hashes", distance)).drop("hashes")
        step = step.withColumnRenamed("longer", "hashes")
    # Only texts in which some window comes twice go on: windows are sorted by hash together
    # with their position, equal neighbours mark repeats, and the stretches they cover add up.
    step = step.withColumn("repeats", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    paired = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("pairs", F.when(F.col("repeats"), paired)).drop("hashes")
    pairs = F.col("pairs")
    marked = F.filter(
        pairs,
        lambda p, k: (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"]),
    )
    step = step.withColumn("starts", F.when(F.col("repeats"), F.sort_array(F.transform(marked, lambda p: p["i"]))))
    starts = F.col("starts")
    step = step.withColumn(
        "covers",
        F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))),
    )
    total = F.aggregate("covers", F.lit(0).cast("long"), lambda a, x: a + x)
    return step.select(
        *carried,
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        F.when(F.col("repeats"), total).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.expr(f"{part} * {SCALE} div greatest({whole}, 1)")


SIGNALS = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def sketches(measured: DataFrame) -> DataFrame:
    """Sketch rows (lang, source, signal, bucket, n), at most some hundred buckets each."""
    signals = F.explode(
        F.map_from_arrays(
            F.array(*[F.lit(s) for s in SIGNALS]),
            F.array(*[bucket(_ratio(*SIGNALS[s])) for s in SIGNALS]),
        )
    ).alias("signal", "bucket")
    rows = measured.select("lang", "source", signals)
    return rows.groupBy("lang", "source", "signal", "bucket").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows and quartiles of every sketch."""
    group = Window.partitionBy(*keys, "signal")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A window holds the buckets of one sketch, of which there are a few hundred at most.
    ranks = sketch.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("rows"))

    def quantile(quarter: int, name: str) -> Column:
        reached = F.col("upto") * 4 >= F.col("rows") * quarter
        return F.min(F.when(reached, F.col("bucket"))).alias(name)

    return ranks.groupBy(*keys, "signal").agg(
        F.max("rows").alias("rows"), quantile(1, "q25"), quantile(2, "q50"), quantile(3, "q75")
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source with the threshold of each signal.

    A group with few documents takes the sketch of its language, a language
    with few documents that of the whole table.
    """
    fine = quantiles(sketch, ["lang", "source"])
    by_lang = quantiles(merge(sketch, ["lang"]), ["lang"])
    every = quantiles(merge(sketch, []), [])
    least = F.lit(0)
    for s, distance in LEAST_DISTANCE.items():
        least = F.when(F.col("signal") == s, distance).otherwise(least)
    limit = F.col("q50") + F.greatest((F.col("q75") - F.col("q25")) * SPREADS, least)
    fine = fine.select("lang", "source", "signal", "rows", limit.alias("limit"))
    by_lang = by_lang.select(F.col("lang").alias("_lang"), F.col("signal").alias("_signal"), F.col("rows").alias("_rows"), limit.alias("_limit"))
    # Three rows, one for each signal.
    every = every.select(F.col("signal").alias("_s"), limit.alias("_all"))
    met = fine.join(by_lang, fine["lang"].eqNullSafe(by_lang["_lang"]) & (fine["signal"] == by_lang["_signal"]))
    met = met.join(F.broadcast(every), met["signal"] == every["_s"])
    taken = (
        F.when(F.col("rows") >= MIN_SKETCH_ROWS, F.col("limit"))
        .when(F.col("_rows") >= MIN_SKETCH_ROWS, F.col("_limit"))
        .otherwise(F.col("_all"))
    )
    columns = [F.max(F.when(F.col("signal") == s, taken)).alias(f"max_{s}") for s in SIGNALS]
    return met.groupBy("lang", "source").agg(*columns)


def _judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    limits = limits.select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"max_{s}" for s in SIGNALS]
    )
    met = measured.join(
        limits, measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"]), "left"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    far = F.lit(False)
    for s, (part, whole) in SIGNALS.items():
        far = far | (_ratio(part, whole) > F.col(f"max_{s}"))
    return met.withColumn("base_failed", failed).withColumn("kept", ~failed & ~far)


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    Null language and source are groups of their own. Documents without words
    fail the base rule. An empty table gives an empty result.
    """
    measured = cut(measures(docs, id_column, text_column))
    return _judged(measured, thresholds(sketches(measured))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The counts are written once beside the rows, so that no text is shuffled and
    the filter is not pushed into the expressions that count. Null language and
    source are groups of their own; an empty table gives an empty result.
    """
    measured = cut(measures(docs, id_column, text_column, carry=True))
    judged = _judged(measured, thresholds(sketches(measured)))
    return judged.where("kept").select("row.*")
