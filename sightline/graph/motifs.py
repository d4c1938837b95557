"""Structural patterns such as ``(a)-[e]->(b); (b)-[f]->(c); !(c)-[]->(a)``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightline.operators.skew import lookup_join
from sightline.session import cut

_EDGE = re.compile(r"^(!?)\((\w*)\)-\[(\w*)\]->\((\w*)\)$")
_VERTEX = re.compile(r"^\((\w+)\)$")


@dataclass
class _Term:
    negated: bool
    src: str
    edge: str
    dst: str


def _terms(pattern: str) -> tuple[list[_Term], list[str], list[str]]:
    """Edge terms, lone vertex names and all given names in order of appearance."""
    terms, lone, names = [], [], []
    unnamed = 0

    def note(name: str) -> str:
        nonlocal unnamed
        if name:
            if name not in names:
                names.append(name)
            return name
        unnamed += 1
        return f"_any{unnamed}"

    for text in filter(None, (part.strip() for part in pattern.split(";"))):
        text = re.sub(r"\s+", "", text)
        edge, vertex = _EDGE.match(text), _VERTEX.match(text)
        if edge:
            bang, src, name, dst = edge.groups()
            if bang and name:
                raise ValueError(f"a negated edge cannot be named: {text!r}")
            if bang:
                terms.append(_Term(True, src or "_any", "", dst or "_any"))
            else:
                src = note(src)
                name = note(name)
                terms.append(_Term(False, src, name, note(dst)))
        elif vertex:
            lone.append(note(vertex.group(1)))
        else:
            raise ValueError(f"not a motif term: {text!r}")
    return terms, lone, names


def find(graph, pattern: str) -> DataFrame:
    """One row per occurrence, a struct column per name in the pattern.

    Every edge term is an equi-join on the vertices it shares with the terms
    before it, every negated term an anti join. Vertices are joined to the edges
    that name them first, before terms multiply the rows, and edges of longer
    patterns whose ends meet no other term leave. A pattern that falls into
    unconnected parts would need a cross join and is refused.
    """
    terms, lone, names = _terms(pattern)
    present = [t for t in terms if not t.negated]
    packed = graph.vertices.select("id", F.struct(*graph.vertices.columns).alias("v"))
    if not present:
        if len(lone) != 1 or terms:
            raise ValueError("a motif needs an edge term or one vertex")
        return packed.select(F.col("v").alias(lone[0]))

    rows: DataFrame | None = None
    bound: set[str] = set()
    wanted = [n for n in names if not any(n == t.edge for t in present)]
    reachable = {n for t in present for n in (t.src, t.dst)}
    for name in wanted:
        if name not in reachable:
            raise ValueError(f"vertex {name!r} shares no edge with the rest of the motif")
    positive = list(present)
    edges, packed = cut(graph.edges), cut(packed)
    size = edges.count()
    if len(positive) > 2:
        marks = {c: cut(edges.select(F.col(c).alias("_mark")).distinct()) for c in ("src", "dst")}
    while present:
        term = next((t for t in present if not bound or {t.src, t.dst} & bound), None)
        if term is None:
            raise ValueError("the motif falls into parts that share no vertex")
        present.remove(term)
        source = edges.where(F.col("src") == F.col("dst")) if term.src == term.dst else edges
        if len(positive) > 2:
            for end, name in (("src", term.src), ("dst", term.dst)):
                for other in {c for t in positive if t is not term for c, n in (("src", t.src), ("dst", t.dst)) if n == name}:
                    if other != end:
                        source = source.join(marks[other], F.col(end) == F.col("_mark"), "left_semi")
        columns = [F.col("src").alias(f"id:{term.src}")]
        if term.dst != term.src:
            columns.append(F.col("dst").alias(f"id:{term.dst}"))
        if not term.edge.startswith("_any"):
            columns.append(F.struct(*graph.edges.columns).alias(term.edge))
        piece = source.select(*columns)
        for name in dict.fromkeys((term.src, term.dst)):
            if name in wanted and name not in bound:
                side = packed.select(F.col("id").alias(f"id:{name}"), F.col("v").alias(name))
                plain = edges.select(F.col("src" if name == term.src else "dst").alias(f"id:{name}"))
                piece = lookup_join(piece, side, f"id:{name}", at_most=size, counted=plain)
        shared = [f"id:{n}" for n in dict.fromkeys((term.src, term.dst)) if n in bound]
        rows = piece if rows is None else rows.join(piece, shared)
        bound |= {term.src, term.dst}

    for term in (t for t in terms if t.negated):
        ends = [(c, n) for c, n in (("src", term.src), ("dst", term.dst)) if n != "_any"]
        if not ends or any(n not in bound for _, n in ends):
            raise ValueError("a negated edge must end at vertices bound elsewhere")
        barred = edges.select(*[F.col(c).alias(f"id:{n}") for c, n in ends]).distinct()
        rows = rows.join(barred, [f"id:{n}" for _, n in ends], "left_anti")

    return rows.select(*names)
