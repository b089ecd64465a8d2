"""Near-duplicate vectors: exact cosine links by a subspace pigeonhole join.

Unit vectors u, v have cosine >= t just when |u - v|^2 <= T = 2 (1 - t).  A fixed orthogonal rotation spreads the
difference over all coordinates; the rotated coordinates are cut into blocks of ``BLOCK`` and a block of b of the d
coordinates gets the budget T * b / d.  A linked pair is within budget in one block at least, or the sum would be
above T.

* Equal vectors of one label are one class; only classes are joined, and a class counts with its size.
* Range join per block: the block's first coordinate, in cells as wide as the square root of the budget, differs by
  one cell at most.  Large cells are cut into chunks of about ``CHUNK`` classes and every pair of chunks of a cell,
  or of a cell and the next, is one group of bounded size.
* In a group: block distances by matrix products, then the union of candidates exactly, in double precision.  A pair
  that is within budget in several blocks counts in the first of them only, so no pair is counted twice.
* A group returns its classes with their partial link counts and one root each, never its pairs.

Every sum over coordinates runs in one fixed order, so that a vector has the same coordinates in every group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import pack, save, ship
from .graph import components

MIN_COSINE = 0.93
BLOCK = 8
CHUNK = 4096
#: For rounding in squared distances; what it lets through is still checked exactly.
SLACK = 1e-9


@lru_cache(8)
def _rotation(dim: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))[0]


def _blocks(dim: int, min_cosine: float) -> list[tuple[int, int, float]]:
    """(first coordinate, end, budget) of every block."""
    total = 2 * (1 - min_cosine)
    return [(a, min(a + BLOCK, dim), total * (min(a + BLOCK, dim) - a) / dim + SLACK) for a in range(0, dim, BLOCK)]


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    total = np.zeros(len(scaled))
    for k in range(scaled.shape[1]):
        total += scaled[:, k] ** 2
    return scaled / np.sqrt(total)[:, None]


def _rotate(units: np.ndarray) -> np.ndarray:
    turn, out = _rotation(units.shape[1]), np.zeros_like(units)
    for k in range(units.shape[1]):
        out += units[:, k, None] * turn[k]
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and digest of the vectors that can be compared."""
    for batch in batches:
        rows, digests = [], []
        for valid, vector in zip(batch.column("usable"), batch.column("vector"), strict=True):
            x = vector.values if valid.as_py() else None
            if x is None or not len(x) or x.null_count:
                x = None
            else:
                x = x.to_numpy() + 0  # -0.0 becomes 0.0
                x = x if np.isfinite(x).all() and x.any() else None
            rows.append(None if x is None else x.tobytes())
            digests.append(None if x is None else xxhash.xxh3_128_digest(rows[-1]))
        yield pa.record_batch([batch.column("id"), batch.column("label"), pack(rows), pack(digests)], ["id", "label", "vector", "digest"])


def _cells(min_cosine: float, item: str):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v.as_buffer()) for v in batch.column("vector")]) // np.dtype(item).itemsize
            for dim in np.unique(dims):
                rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                turned = _rotate(_unit(_matrix(rows.column("vector"), item)))
                cells = np.stack([np.floor(turned[:, a] / np.sqrt(budget)) for a, _, budget in _blocks(int(dim), min_cosine)], axis=1)
                yield pa.record_batch([*rows.columns, pa.array(np.full(len(cells), dim, np.int32)), pa.array(list(cells.astype(np.int32)), pa.list_(pa.int32()))],
                                      [*rows.schema.names, "dim", "cells"])
    return cells


def _matrix(column, item: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), item).reshape(len(column), -1).astype(np.float64)


def _link(min_cosine: float, item: str, schema: pa.Schema):
    def link(key: tuple, table: pa.Table) -> pa.Table:
        block = key[1].as_py()
        table = table.combine_chunks()
        table = table.take(pa.array(np.argsort(table["side"].to_numpy(), kind="stable")))
        unit = _unit(_matrix(table["vector"], item))
        turned, size = _rotate(unit), table["size"].to_numpy()
        n, split = len(unit), int((table["side"].to_numpy() == 0).sum())
        alone = table["alone"][0].as_py()  # a chunk with itself
        blocks = _blocks(unit.shape[1], min_cosine)
        a, b, budget = blocks[block]
        mine = turned[:, a:b]
        norm = (mine * mine).sum(axis=1)
        degree, pairs = np.zeros(n), []
        first_right = 0 if alone else split
        for start in range(0, split, 256):
            stop = min(start + 256, split)
            near = norm[start:stop, None] + norm[first_right:] - 2 * (mine[start:stop] @ mine[first_right:].T) <= budget + SLACK
            x, y = np.nonzero(near)
            x, y = x + start, y + first_right
            if alone:
                x, y = x[x < y], y[x < y]
            for at in range(0, len(x), 65_536):  # candidates are checked in slices of bounded size
                i, j = x[at:at + 65_536], y[at:at + 65_536]
                for k, (c, d, most) in enumerate(blocks[:block + 1]):
                    apart = np.zeros(len(i))
                    for e in range(c, d):
                        apart += (turned[i, e] - turned[j, e]) ** 2
                    kept = apart <= most if k == block else apart > most
                    i, j = i[kept], j[kept]
                cosine = np.zeros(len(i))
                for e in range(unit.shape[1]):
                    cosine += unit[i, e] * unit[j, e]
                i, j = i[cosine >= min_cosine], j[cosine >= min_cosine]
                degree += np.bincount(i, size[j], n) + np.bincount(j, size[i], n)
                if len(i):
                    pairs.append(_forest(i, j, n))
        linked = np.flatnonzero(degree)
        root = np.arange(n)
        if pairs:
            node, to = _forest(*(np.concatenate(p) for p in zip(*pairs, strict=True)), n)
            root[node] = to
        ids, own = table["rep"].combine_chunks(), table["class"].combine_chunks()
        return pa.table([ids.take(pa.array(linked)), own.take(pa.array(linked)), pa.array(degree[linked].astype(np.int64)), ids.take(pa.array(root[linked]))], schema=schema)
    return link


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what the links i-j connect, one at most for each node."""
    root = np.arange(n)
    while True:
        before = root.copy()
        least = np.minimum(root[i], root[j])
        for side in (i, j):
            np.minimum.at(root, side, least)
            np.minimum.at(root, before[side], least)
        root = root[root]
        if (root == before).all():
            node = np.flatnonzero(root != np.arange(n))
            return node, root[node]


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    Vectors are compared only with vectors of the same label and length.  ``n_links`` counts the other rows with
    cosine >= ``min_cosine``, copies included; ``component_id`` is the smallest id reachable over links.  A row
    whose id, label or vector is null, whose vector is empty or zero or holds a null or non-finite component, links
    with nothing (its component is its own id).  Rows that repeat an id each count as a row.  An empty table gives an
    empty one; other columns are not read.
    """
    ship(vectors.sparkSession)
    base = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    base = base.withColumn("usable", F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    types = {f.name: f.dataType for f in base.schema.fields}
    item = "<f4" if types["vector"].elementType.typeName() == "float" else "<f8"
    if item == "<f8":
        base = base.withColumn("vector", F.col("vector").cast("array<double>"))
    id_type, label_type = types["id"].simpleString(), types["label"].simpleString()
    rows = save(base.mapInArrow(_parse, f"id {id_type}, label {label_type}, vector binary, digest binary"), "vectors")

    classes = rows.where("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("id").alias("rep"), F.count("*").alias("size"), F.first("vector").alias("vector"))
    classes = save(classes.mapInArrow(_cells(min_cosine, item), f"label {label_type}, digest binary, rep {id_type}, size long, vector binary, dim int, cells array<int>"), "classes")

    parts = classes.select("label", "dim", "rep", "digest", "size", "vector", F.posexplode("cells").alias("block", "cell"))
    where = ["label", "dim", "block"]
    order = Window.partitionBy(*where).orderBy("cell")  # a unit vector has few cells: 2 / sqrt(budget)
    chunks = parts.groupBy(*where, "cell").count().select(*where, "cell", F.ceil(F.col("count") / CHUNK).cast("int").alias("k"))
    beside = lambda step: F.coalesce(F.when(step("cell").over(order) - F.col("cell") == (1 if step is F.lead else -1), step("k").over(order)), F.lit(0))
    chunks = save(chunks.select(*where, "cell", "k", beside(F.lag).alias("k_before"), beside(F.lead).alias("k_after")), "cells")

    placed = parts.join(chunks, [*where, "cell"]).withColumn("chunk", F.pmod(F.xxhash64("digest"), F.col("k")).cast("int"))
    upto = "transform(filter(sequence(0, greatest({n}, 1) - 1), i -> i < {n}{more}), i -> named_struct('at', {at}, 'beside', {beside}, 'left', {left}, 'right', {right}, 'side', {side}, 'alone', {alone}))"
    groups = F.concat(
        F.expr(upto.format(n="k", more=" and i >= chunk", at="cell", beside="false", left="chunk", right="i", side=0, alone="i = chunk")),
        F.expr(upto.format(n="k", more=" and i < chunk", at="cell", beside="false", left="i", right="chunk", side=1, alone="false")),
        F.expr(upto.format(n="k_after", more="", at="cell", beside="true", left="chunk", right="i", side=0, alone="false")),
        F.expr(upto.format(n="k_before", more="", at="cell - 1", beside="true", left="i", right="chunk", side=1, alone="false")))
    schema = f"rep {id_type}, class long, degree long, root {id_type}"
    arrow = pa.schema([("rep", to_arrow_type(types["id"])), ("class", pa.int64()), ("degree", pa.int64()), ("root", to_arrow_type(types["id"]))])
    found = placed.withColumn("g", F.explode(groups)).select(
        "label", "block", "dim", "g.at", "g.beside", "g.left", "g.right", "g.side", "g.alone", "rep", F.xxhash64("label", "digest").alias("class"), "size", "vector")
    found = save(found.groupBy("label", "block", "dim", "at", "beside", "left", "right").applyInArrow(_link(min_cosine, item, arrow), schema), "linked")

    # Two classes may have the same smallest id (a repeated id with other vectors): one node, two degrees.
    place = components(found.where("rep != root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    degree = found.groupBy("class").agg(F.sum("degree").alias("degree"))
    sized = classes.select("label", "digest", "rep", "size", F.xxhash64("label", "digest").alias("class")).join(degree, "class", "left").join(place, F.col("rep") == F.col("node"), "left").select(
        "label", "digest", (F.col("size") - 1 + F.coalesce("degree", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component"))
    return rows.select("id", "label", "digest").join(sized, ["label", "digest"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"))
