"""Near-duplicate embeddings by an epsilon grid order join.

Vectors of a label are sorted by the cells of a grid on their leading principal dimensions, whose
side is the largest distance of two linked vectors. The sorted sequence is cut into blocks. Two blocks
are joined only if some of their cells touch; a task then halves the two sequences recursively and
skips intervals whose bounding boxes are provably too far apart. Projections never lengthen a
distance, so nothing that is linked is skipped, and what is left is compared in full.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.llm.components import components
from loadkit.session import materialise

SIMILARITY = 0.93
#: Principal dimensions whose cells sort and join blocks, and those whose boxes skip intervals.
GRID, LEADING = 3, 8
#: Vectors in a block, and in an interval that is compared in full.
BLOCK, LEAF = 2_048, 256
#: Added to distances that decide what to skip, far above the rounding of sums.
SLACK = 1e-9


def _reach(similarity: float) -> float:
    """The distance of two unit vectors of this cosine."""
    return float(np.sqrt(2 - 2 * similarity)) + SLACK


def is_usable(vector: Column) -> Column:
    """Whether a vector has a direction: finite, without nulls, and neither empty nor zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    nonzero = F.exists(vector, lambda x: x.cast("double") != 0.0)
    return F.coalesce(finite & nonzero, F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The vectors of a batch, all of one dimension, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = batch.column("dim").to_numpy()
    for dim in np.unique(sizes):
        yield int(dim), batch.filter(pa.array(sizes == dim))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension of vectors (vector, dim), the axes along which unit vectors vary most.

    Tasks add up products of components; the driver gets a square of numbers for each dimension.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in _by_dimension(batch):
                rows = unit(_matrix(part.column("vector")))
                rows = np.hstack([rows, np.ones((len(rows), 1))])
                sums[dim] = sums.get(dim, 0) + rows.T @ rows
        for dim, square in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(square.size, dim)),
                    pa.array(np.arange(square.size)),
                    pa.array(square.ravel()),
                ],
                names=["dim", "at", "total"],
            )

    found = vectors.select("vector", "dim").mapInArrow(products, "dim bigint, at bigint, total double")
    squares: dict[int, dict[int, float]] = {}
    for row in found.groupBy("dim", "at").agg(F.sum("total").alias("total")).collect():
        squares.setdefault(row["dim"], {})[row["at"]] = row["total"]
    axes = {}
    for dim, cells in squares.items():
        square = np.array([cells[i] for i in range((dim + 1) ** 2)]).reshape(dim + 1, dim + 1)
        mean = square[:dim, dim] / square[dim, dim]
        _, vectors_of = np.linalg.eigh(square[:dim, :dim] / square[dim, dim] - np.outer(mean, mean))
        axes[dim] = vectors_of[:, ::-1][:, : min(LEADING, dim)].T.copy()
    return axes


def blocks_of(vectors: DataFrame, axes: dict[int, np.ndarray], similarity: float) -> DataFrame:
    """Cut the vectors (node, label, vector, dim, copies) into blocks in grid order.

    Returns block, label, dim, nodes, copies, rows (doubles), cells and near (cells and those beside).
    """
    side = _reach(similarity)

    def cells_of(part: pa.RecordBatch, dim: int) -> np.ndarray:
        shift = unit(_matrix(part.column("vector"))) @ axes[dim][:GRID].T
        cells = np.zeros((part.num_rows, GRID), np.int32)
        cells[:, : shift.shape[1]] = np.floor(shift / side)
        return cells

    def add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dimension(batch):
                cells = cells_of(part, dim)
                columns = [pa.array(np.ascontiguousarray(cells[:, i])) for i in range(GRID)]
                names = [*part.schema.names, *cell_names]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=names)

    cell_names = [f"c{i}" for i in range(GRID)]
    schema = T.StructType(
        vectors.schema.fields + [T.StructField(c, T.IntegerType()) for c in cell_names]
    )
    # Written once: the bounds of a range partitioning are sampled, which must not run the task twice.
    placed = materialise(vectors.mapInArrow(add_cells, schema), "cells")
    order = ["label", "dim", *cell_names, "node"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                for at in range(0, part.num_rows, BLOCK):
                    yield _block(part.slice(at, BLOCK), key, cell_names)

        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            dims = batch.column("dim").to_numpy()
            turn = np.flatnonzero((labels[1:] != labels[:-1]) | (dims[1:] != dims[:-1])) + 1
            for a, b in itertools.pairwise([0, *turn.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if key != (labels[a], dims[a]) or sum(h.num_rows for h in held) >= BLOCK:
                    yield from flush()
                    key, held = (labels[a], dims[a]), []
                held.append(batch.slice(a, b - a))
        yield from flush()

    made = placed.mapInArrow(
        cut,
        "label string, dim bigint, nodes binary, copies binary, rows binary,"
        " cells array<string>, near array<string>",
    )
    return materialise(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _block(part: pa.RecordBatch, key: tuple, cell_names: list[str]) -> pa.RecordBatch:
    cells = np.unique(np.stack([part.column(c).to_numpy() for c in cell_names], 1), axis=0)
    steps = np.array(list(itertools.product((-1, 0, 1), repeat=GRID)))
    near = np.unique((cells[:, None] + steps[None]).reshape(-1, GRID), axis=0)
    told = lambda rows: [",".join(map(str, row)) for row in rows.tolist()]
    values = [
        [key[0]],
        [int(key[1])],
        [part.column("node").to_numpy().astype("<i8").tobytes()],
        [part.column("copies").to_numpy().astype("<i8").tobytes()],
        [_matrix(part.column("vector")).tobytes()],
        [told(cells)],
        [told(near)],
    ]
    names = ["label", "dim", "nodes", "copies", "rows", "cells", "near"]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=names)


def block_pairs(blocks: DataFrame) -> DataFrame:
    """a <= b: the pairs of blocks of one label of which cells touch, from an equi-join on cells."""
    keys = ["label", "dim", "cell"]
    left = blocks.select("label", "dim", F.col("block").alias("a"), F.explode("cells").alias("cell"))
    right = blocks.select("label", "dim", F.col("block").alias("b"), F.explode("near").alias("cell"))
    return left.join(right, keys).filter("a <= b").select("a", "b").distinct()


class _Sequence:
    """A block's vectors with the boxes of its intervals."""

    def __init__(self, nodes: bytes, copies: bytes, rows: bytes, dim: int, axes: np.ndarray) -> None:
        self.nodes, self.copies = np.frombuffer(nodes, "<i8"), np.frombuffer(copies, "<i8")
        self.rows = unit(np.frombuffer(rows).reshape(-1, dim))
        self.shift = self.rows @ axes.T
        self.links = np.zeros(len(self.nodes), np.int64)

    def box(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.shift[start:end]
        return part.min(0), part.max(0)


def join_sequences(a: _Sequence, b: _Sequence, similarity: float) -> list[tuple[int, int]]:
    """Count the links of all vectors of two sequences, and return edges that join what is linked.

    The edges form a forest, however many links there are.
    """
    reach, same, parent = _reach(similarity), a is b, {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def compare(i: int, j: int, k: int, m: int) -> None:
        hits = a.rows[i:j] @ b.rows[k:m].T >= similarity
        if same and i == k:
            np.fill_diagonal(hits, False)
        if not hits.any():
            return
        a.links[i:j] += hits @ b.copies[k:m]
        if not (same and i == k):
            b.links[k:m] += hits.T @ a.copies[i:j]
        for x, y in _stars(hits):
            x, y = root(int(a.nodes[i + x])), root(int(b.nodes[k + y]))
            if x != y:
                parent[max(x, y)] = min(x, y)

    def descend(i: int, j: int, k: int, m: int) -> None:
        if same and k < i:
            return
        (low, high), (low2, high2) = a.box(i, j), b.box(k, m)
        gap = np.maximum(0, np.maximum(low - high2, low2 - high))
        if gap @ gap > reach * reach:
            return
        if j - i <= LEAF and m - k <= LEAF:
            compare(i, j, k, m)
        elif same and i == k:
            middle = (i + j) // 2
            descend(i, middle, k, middle)
            descend(i, middle, middle, m)
            descend(middle, j, middle, m)
        elif j - i >= m - k:
            descend(i, (i + j) // 2, k, m)
            descend((i + j) // 2, j, k, m)
        else:
            descend(i, j, k, (k + m) // 2)
            descend(i, j, (k + m) // 2, m)

    descend(0, len(a.nodes), 0, len(b.nodes))
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def _stars(hits: np.ndarray) -> Iterator[tuple[int, int]]:
    """Few of the hits of a matrix that connect the same rows and columns as all of them."""
    left = hits.copy()
    while left.any():
        i = int(left.any(1).argmax())
        rows, columns = np.zeros(len(left), bool), left[i].copy()
        rows[i] = True
        for j in np.flatnonzero(columns):
            yield i, int(j)
        while True:
            reached = left[:, columns].any(1) & ~rows
            if not reached.any():
                break
            for r in np.flatnonzero(reached):
                yield int(r), int((left[r] & columns).argmax())
            rows |= reached
            fresh = left[rows].any(0) & ~columns
            for j in np.flatnonzero(fresh):
                yield int((left[:, j] & rows).argmax()), int(j)
            columns |= fresh
        left[rows] = False


def linked(blocks: DataFrame, axes: dict[int, np.ndarray], similarity: float) -> DataFrame:
    """kind 'links': node and number of linked vectors; kind 'edge': two nodes of one component."""
    side = lambda x: blocks.select(
        F.col("block").alias(x), "dim", F.struct("nodes", "copies", "rows").alias(f"{x}_side")
    )
    pairs = block_pairs(blocks)
    both = pairs.join(side("a"), "a").join(side("b").drop("dim"), "b")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                take = lambda s, d=dim: _Sequence(s["nodes"], s["copies"], s["rows"], d, axes[d])
                a = take(row["a_side"])
                b = a if row["a"] == row["b"] else take(row["b_side"])
                edges = join_sequences(a, b, similarity)
                found = [("edge", x, y) for x, y in edges]
                for side in (a,) if a is b else (a, b):
                    at = np.flatnonzero(side.links)
                    found += [("links", int(side.nodes[i]), int(side.links[i])) for i in at]
                kinds, x, y = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.string()), pa.array(x, pa.int64()), pa.array(y, pa.int64())],
                    names=["kind", "x", "y"],
                )

    return materialise(both.mapInArrow(join, "kind string, x bigint, y bigint"), "linked")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Per row of `vectors`: vec_id, n_links, component_id, kept.

    Two vectors are linked when their labels are equal and not null, their dimensions are equal, and
    their cosine is at least `similarity`. Vectors that are null, empty, zero, or hold null or
    non-finite components, and rows without an id, are linked with nothing: n_links 0 and a component
    of their own. Repeated vectors are joined once and count each. Ids are expected to be unique; of
    rows repeated under one id, each counts as another vector.
    """
    rows = vectors.select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & is_usable(F.col("vector"))
    # One node for each different vector of a label; its number is fixed by writing it.
    groups = rows.filter(usable).groupBy("label", "vector").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies")
    )
    nodes = materialise(
        groups.select(
            F.monotonically_increasing_id().alias("node"),
            "label",
            "vector",
            F.size("vector").cast("bigint").alias("dim"),
            "copies",
            "first",
        ),
        "nodes",
    )
    axes = principal_axes(nodes)
    found = linked(blocks_of(nodes.drop("first"), axes, similarity), axes, similarity)
    links = found.filter("kind = 'links'").groupBy(F.col("x").alias("node")).agg(F.sum("y").alias("links"))
    edges = found.filter("kind = 'edge'").select(F.col("x").alias("u"), F.col("y").alias("v"))
    member = components(edges).withColumnRenamed("vertex", "node")
    named = nodes.select("node", "first").join(member, "node")
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    of_node = (
        nodes.join(links, "node", "left")
        .join(member, "node", "left")
        .join(smallest, "component", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("smallest", "first").alias("component_id"),
        )
    )
    with_nodes = rows.withColumn("vector", F.when(usable, F.col("vector")))
    with_nodes = with_nodes.withColumn("label", F.when(F.col("vector").isNotNull(), F.col("label")))
    own = F.coalesce("component_id", "vec_id")
    return with_nodes.join(of_node, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
