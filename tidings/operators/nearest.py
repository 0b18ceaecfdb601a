"""Exact top-1 vector search as Spark jobs.

Queries and index rows are put into cells, and each query meets only the index rows of its cells. A
cell is cut into tiles of bounded size on both sides, so a cell that holds a third of all rows is
spread over many tasks; small cells share a tile. A tile yields one best row per query, never the
pairs it compared.

The nearest row is sought in the query's own cell first. What is found there is the least that a row
of another cell has to reach, and only cells that can hold such a row are visited afterwards.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.vectors import cosine_for_relevance, relevance

# Rows per side of a tile; memory of a tile is about (INDEX_ROWS + QUERY_ROWS) * dimension * 8 bytes.
INDEX_ROWS = 16384
QUERY_ROWS = 16384
# Queries held against pivots, against few items, or against one chunk of many items, at once; and against many items in double precision.
_STRIDE = 1024
_BLOCK = 256
_FEW_ITEMS = 512
_CHUNK = 256
# Vector entries of pairs compared at once in double precision.
_PAIR_ENTRIES = 1 << 20

# Copies of rows in the tiles that are dealt in one turn, for each row of both sides, at most about this many.
TURN_COPIES = 2

# Index rows that a query meets at least when it has to look beyond its own cell: fewer cost less than bringing the query there.
GROUP_ROWS = 8192

# Pivots are the only vectors that go through the driver. More of them make cells smaller; results don't depend on it.
MAX_PIVOTS = 1024

# Vectors are single precision, so scores are compared at this many places; the smallest key wins a tie.
_PLACES = 6
# Rows whose rounded cosines are equal differ by less than this.
_ROUNDING = 2 * 10.0**-_PLACES

_CELL = T.StructField("cell", T.IntegerType())


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    """Rows scaled to unit length, in double precision; a zero vector stays zero."""
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else None
    if n == 0 or flat is None or len(flat) == 0:
        return np.zeros((n, 1))
    rows = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    for start in range(0, n, _STRIDE):  # in place, so that a side of a tile is held once
        part = rows[start : start + _STRIDE]
        norms = np.linalg.norm(part, axis=1, keepdims=True)
        part /= np.where(norms > 0, norms, 1.0)
    return rows


def _best_of_all(wanted: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_best_in_cell` for few rows, with every cosine in double precision."""
    part = wanted @ items.T
    first = np.round(part, _PLACES).argmax(axis=1)
    return first, part[np.arange(len(part)), first], part.max(axis=1)


def _best_of_candidates(wanted: np.ndarray, items: np.ndarray, row: np.ndarray, col: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, position, cosine and highest cosine of the best of the pairs (row, col), which are in that order."""
    cos = np.empty(len(row))
    step = max(1, _PAIR_ENTRIES // items.shape[1])
    for k in range(0, len(row), step):
        cos[k : k + step] = np.einsum("ij,ij->i", wanted[row[k : k + step]], items[col[k : k + step]])
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    rounded, sizes = np.round(cos, _PLACES), np.diff(starts, append=len(row))
    ties = np.flatnonzero(rounded == np.repeat(np.maximum.reduceat(rounded, starts), sizes))
    at = ties[np.unique(row[ties], return_index=True)[1]]
    return row[at], col[at], cos[at], np.maximum.reduceat(cos, starts)


def _best_in_cell(wanted: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position and cosine of the best of ``items``, which are sorted by key, for each row of ``wanted``; the highest cosine.

    Single precision tells which items can be the best; only their cosines are computed in double precision. Rows with very
    many such items, as copies are, and rows that aren't numbers are compared with all items in double precision.
    """
    best, cos, top = np.empty(len(wanted), dtype=np.int64), np.empty(len(wanted)), np.empty(len(wanted))
    whole = lambda rows: _best_of_all(wanted[rows], items)
    if len(items) < _FEW_ITEMS:
        for start in range(0, len(wanted), _STRIDE):
            rows = slice(start, start + _STRIDE)
            best[rows], cos[rows], top[rows] = whole(rows)
        return best, cos, top
    # A product of unit rows of d entries is off by less than (d + 4) / 2^24, on both sides of a comparison.
    slack = np.float32(1.1 * 10.0**-_PLACES + 2 * (items.shape[1] + 4) * 2.0**-24 + 2.0**-22)
    rough, most = items.astype(np.float32), len(items) // 16
    chunks = [rough[k : k + _CHUNK] for k in range(0, len(items), _CHUNK)]
    for start in range(0, len(wanted), _STRIDE):
        part = wanted[start : start + _STRIDE].astype(np.float32)
        # Products are looked at while they are in the processor's cache: of a chunk only the highest is kept for each row.
        products, highs = np.empty((_CHUNK, len(part)), dtype=np.float32), np.empty((len(chunks), len(part)), dtype=np.float32)
        for chunk, high in zip(chunks, highs):
            np.matmul(chunk, part.T, out=products[: len(chunk)]).max(axis=0, out=high)
        limit = highs.max(axis=0) - slack
        counts, found = np.zeros(len(part), dtype=np.int64), []
        for k, chunk in enumerate(chunks):
            # Rows that have had too many items are not looked at again, so that few pairs are held.
            rows = np.flatnonzero((highs[k] >= limit) & (counts <= most))
            if len(rows):
                row, col = np.divmod(np.flatnonzero(part[rows] @ chunk.T >= limit[rows, None]), len(chunk))
                counts += np.bincount(rows[row], minlength=len(part))
                found.append((rows[row], col + k * _CHUNK))
        hard = (counts == 0) | (counts > most)
        if hard.any():
            rows = start + np.flatnonzero(hard)
            for k in range(0, len(rows), _BLOCK):
                some = rows[k : k + _BLOCK]
                best[some], cos[some], top[some] = whole(some)
        if not hard.all():
            row, col = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(row, kind="stable")
            order = order[~hard[row[order]]]
            at, first, exact, high = _best_of_candidates(wanted, items, row[order] + start, col[order])
            best[at], cos[at], top[at] = first, exact, high
    return best, cos, top


def _best_in_tile(queries: pa.Table, index: pa.Table) -> pa.Table:
    """Best index row of each query among those of its cell; the smallest key wins a tie.

    Only the vectors of one cell at a time are held in double precision.
    """
    index = index.sort_by([("cell", "ascending"), ("item_key", "ascending")])
    queries = queries.sort_by("cell")
    both = pa.chunked_array([*index["cell"].chunks, *queries["cell"].chunks], index["cell"].type)
    codes = both.combine_chunks().dictionary_encode().indices.to_numpy()
    ours, theirs = codes[index.num_rows :], codes[: index.num_rows]
    # Both sides are sorted by cell, so a cell is one range on either side.
    starts = {int(c): k for c, k in zip(*np.unique(theirs, return_index=True))}
    sizes = dict(zip(*(x.tolist() for x in np.unique(theirs, return_counts=True))))
    rows, found, cosines, tops = [], [], [], []
    for cell, at, n in zip(*(x.tolist() for x in np.unique(ours, return_index=True, return_counts=True))):
        if cell in starts:
            wanted = _matrix(queries["query_vec"].slice(at, n), n)
            items = _matrix(index["item_vec"].slice(starts[cell], sizes[cell]), sizes[cell])
            best, cos, top = _best_in_cell(wanted, items)
            rows.append(np.arange(at, at + n))
            found.append(best + starts[cell])
            cosines.append(cos)
            tops.append(top)
    rows, found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, found))
    return pa.table(
        {
            "query_key": queries["query_key"].take(pa.array(rows)),
            "item_key": index["item_key"].take(pa.array(found)),
            "cos": pa.array(np.concatenate(cosines) if cosines else np.zeros(0)),
            "top": pa.array(np.concatenate(tops) if tops else np.zeros(0)),
        }
    )


def _large_cells(rows: DataFrame, limit: int, name: str) -> DataFrame:
    """Cells too large for one tile, and into how many parts they are cut."""
    return (
        rows.groupBy("cell")
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > limit)
        .select("cell", F.ceil(F.col("_n") / limit).cast("int").alias(f"{name}_parts"), F.col("_n").alias(f"{name}_n"))
    )


def best_in_cells(
    queries: DataFrame,
    index: DataFrame,
    index_rows: int = INDEX_ROWS,
    query_rows: int = QUERY_ROWS,
    one_cell: bool = False,
    counted: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """``(query_key, item_key, cos, top)``: the index row of highest cosine among each query's cells.

    Of rows whose cosines are equal to six places the smallest key is taken; ``top`` is the highest of them all.

    ``queries`` has ``cell, query_key, query_vec`` (a query may be in several cells, unless ``one_cell``
    says that none is), ``index`` has ``cell, item_key, item_vec``. Queries whose cells hold no index row are absent.
    Rows per cell are counted first, on ``counted`` if given: the cells of both sides, from stored tables.

    The copies that travel to the tiles of large cells grow with the product of both sides. So the parts that queries are cut
    into take turns, as many as keep the copies of one turn near the number of rows; of each turn only its best rows are stored.
    """
    query_cells, index_cells = counted or (queries, index)
    large = _large_cells(index_cells, index_rows, "index").join(_large_cells(query_cells, query_rows, "query"), "cell", "full_outer")
    # As many rows as full tiles at most; Spark decides how to join them.
    large = storage.materialize(large, label="large-cells")
    parts = large.select("cell", "index_parts", "query_parts")
    # Cells of one tile share as many tiles as keep them small on both sides, and all tasks busy.
    n_index, n_queries = index_cells.count(), query_cells.count()
    needs = (-(-n // max(rows // 4, 1)) for n, rows in ((n_index, index_rows), (n_queries, query_rows)))
    packs = max(queries.sparkSession.sparkContext.defaultParallelism, *needs)
    turns = _turns(large, index_rows, query_rows, n_index + n_queries)

    def tiled(rows: DataFrame, own: str, key: str, other: str) -> DataFrame:
        """Each row in its own part, once for every part of the other side."""
        is_large = F.col("index_parts").isNotNull() | F.col("query_parts").isNotNull()
        mine, others = F.coalesce(own, F.lit(1)), F.coalesce(other, F.lit(1))
        return (
            rows.join(parts, "cell", "left")
            .withColumn("alone", F.when(is_large, F.col("cell")))
            .withColumn("pack", F.when(is_large, -1).otherwise(F.pmod(F.xxhash64("cell"), F.lit(packs))).cast("int"))
            .withColumn("own", F.pmod(F.xxhash64(key), mine).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
        )

    turn = F.pmod(F.when(F.col("pack") < 0, F.col("qp")).otherwise(F.col("pack")), F.lit(turns))
    left = tiled(queries, "query_parts", "query_key", "index_parts").select(
        "alone", "pack", F.col("own").alias("qp"), F.col("other").alias("ip"), "cell", "query_key", "query_vec"
    )
    right = tiled(index, "index_parts", "item_key", "query_parts").select(
        "alone", "pack", F.col("other").alias("qp"), F.col("own").alias("ip"), "cell", "item_key", "item_vec"
    )
    key_type = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"query_key {key_type(queries, 'query_key')}, item_key {key_type(index, 'item_key')}, cos double, top double"
    tiles = ["alone", "pack", "qp", "ip"]

    def found(left: DataFrame, right: DataFrame) -> DataFrame:
        rows = left.groupBy(*tiles).cogroup(right.groupBy(*tiles)).applyInArrow(_best_in_tile, schema)
        return rows if one_cell and parts.isEmpty() else _best_of(rows)  # in the first case each query was in a single tile

    if turns == 1:
        return found(left, right)
    best = [storage.materialize(found(left.where(turn == k), right.where(turn == k)), label="turn-best") for k in range(turns)]
    best = reduce(DataFrame.unionByName, best)
    return best if one_cell else _best_of(best)


def _turns(large: DataFrame, index_rows: int, query_rows: int, n: int) -> int:
    """In how many turns the tiles of large cells are dealt; ``n`` rows are on both sides. There are at most as many as parts of a cell's queries."""
    index_parts, query_parts = (F.coalesce(f"{side}_parts", F.lit(1)) for side in ("index", "query"))
    index_n, query_n = F.coalesce("index_n", F.lit(index_rows)), F.coalesce("query_n", F.lit(query_rows))
    copies, most = large.agg(F.sum(query_n * index_parts + index_n * query_parts), F.max(query_parts)).first()
    return min(most, math.ceil(copies / (TURN_COPIES * n))) if copies else 1


def _best_of(found: DataFrame) -> DataFrame:
    """The best row of each query; the smallest key wins a tie."""
    order = F.struct((-F.round("cos", _PLACES)).alias("order"), "item_key", "cos")
    best = found.groupBy("query_key").agg(F.min(order).alias("best"), F.max("top").alias("top"))
    return best.select("query_key", "best.item_key", "best.cos", "top")


def _choose_pivots(index: DataFrame, cell_rows: int, max_pivots: int) -> np.ndarray:
    """A repeatable choice of at most ``max_pivots`` index vectors, as unit rows: one per ``cell_rows`` index rows."""
    wanted = min(max_pivots, math.ceil(index.count() / cell_rows))
    if not wanted:
        return np.zeros((0, 0))
    # item_key breaks hash ties; TakeOrdered keeps `wanted` rows per task, not the index.
    rows = index.orderBy(F.xxhash64("item_key"), "item_key").limit(wanted).select("item_vec").collect()
    pivots = np.asarray([r.item_vec for r in rows], dtype=np.float64)
    norms = np.linalg.norm(pivots, axis=1, keepdims=True)
    return pivots / np.where(norms > 0, norms, 1.0)


def _assign_cells(rows: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the number of their nearest pivot and the angle to it."""
    schema = T.StructType([*rows.schema.fields, _CELL, T.StructField("angle", T.DoubleType())])

    def assign(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, _STRIDE):
                part = batch.slice(start, _STRIDE)
                unit = _matrix(pa.chunked_array([part.column(vector)]), part.num_rows)
                near = np.clip(unit @ pivots.T, -1.0, 1.0)
                cell = near.argmax(axis=1)
                angle = np.arccos(near[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(angle)],
                    names=[*batch.schema.names, "cell", "angle"],
                )

    return rows.mapInArrow(assign, schema)


def _cell_groups(assigned: DataFrame, pivots: np.ndarray, least: int = GROUP_ROWS) -> np.ndarray:
    """The group of each cell, numbered by one of its cells. Near cells go together until they hold ``least`` index rows."""
    sizes, group = np.zeros(len(pivots), dtype=np.int64), np.full(len(pivots), -1)
    # At most as many rows as there are pivots.
    for r in assigned.groupBy("cell").count().collect():
        sizes[r[0]] = r[1]
    for k in range(len(pivots)):
        if group[k] < 0:
            free = np.flatnonzero(group < 0)
            free = free[np.argsort(-(pivots[free] @ pivots[k]), kind="stable")]
            free = np.concatenate(([k], free[free != k]))
            group[free[: 1 + int(np.searchsorted(np.cumsum(sizes[free]), least))]] = k
    return group


def _reachable_cells(
    queries: DataFrame, pivots: np.ndarray, cells: list[int], low: np.ndarray, high: np.ndarray, groups: np.ndarray | None = None
) -> DataFrame:
    """``(query_key, cell)``: each query once per cell, other than its own, that may hold an index row of cosine ``floor`` or more.

    With ``groups``, the group of each cell, once per group with such a cell; ``cell`` is the group's number then.

    ``queries`` has query_key, query_vec, cell and floor. A cell is skipped only when geometry rules it out: by the
    triangle inequality on angles to its pivot, or because the query is further beyond the plane halfway to its own
    pivot than such a row can be. The second test holds for radii below a right angle.
    """
    schema = T.StructType([queries.schema["query_key"], _CELL])
    numbers = np.asarray(cells, dtype=np.int32)
    group = numbers if groups is None else groups[numbers]
    order = np.argsort(group, kind="stable")
    names, starts = np.unique(group[order], return_index=True)
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (pivots @ pivots[numbers].T)))
    slack = 1e-7  # rounding of the angles themselves; that of scores is in the floor

    def keep(near: np.ndarray, own: np.ndarray, floor: np.ndarray) -> np.ndarray:
        radius = np.arccos(np.clip(floor, -1.0, 1.0))[:, None]
        angle = np.arccos(near[:, numbers])
        ahead = near[np.arange(len(own)), own][:, None] - near[:, numbers]
        behind = (ahead <= np.sin(radius) * gaps[own] + slack) | (radius >= math.pi / 2)
        return (angle - radius <= high + slack) & (angle + radius >= low - slack) & behind & (numbers[None, :] != own[:, None])

    def reach(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, _STRIDE):
                batch = whole.slice(start, _STRIDE)
                rows = _matrix(pa.chunked_array([batch.column("query_vec")]), batch.num_rows)
                own, floor = np.asarray(batch.column("cell")).astype(np.int64), np.asarray(batch.column("floor"))
                reached = keep(np.clip(rows @ pivots.T, -1.0, 1.0), own, floor)
                row, col = np.nonzero(np.logical_or.reduceat(reached[:, order], starts, axis=1))
                keys = batch.column("query_key").take(pa.array(row))
                yield pa.RecordBatch.from_arrays([keys, pa.array(names[col].astype(np.int32))], names=["query_key", "cell"])

    return queries.select("query_key", "query_vec", "cell", "floor").mapInArrow(reach, schema)


def cells_to_visit(
    own: DataFrame, found: DataFrame, assigned: DataFrame, pivots: np.ndarray, least: float, groups: np.ndarray | None = None
) -> DataFrame:
    """The cells, beyond its own, that each query has to visit, or the ``groups`` of them, stored.

    A row there must reach the best of the query's own cell and the cosine ``least``; both are lowered by what
    rounding can hide.
    """
    # At most as many rows as there are pivots.
    extent = assigned.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high")).orderBy("cell").collect()
    floor = F.greatest(F.coalesce("top", F.lit(-1.0)), F.lit(least)) - _ROUNDING
    wanted = own.join(found.select("query_key", "top"), "query_key", "left").withColumn("floor", floor)
    # Only keys are stored: a query may be in many cells, its vector is stored once.
    low, high = (np.asarray([r[k] for r in extent]) for k in ("low", "high"))
    return storage.materialize(_reachable_cells(wanted, pivots, [r.cell for r in extent], low, high, groups), label="query-cells")


def nearest(
    queries: DataFrame,
    index: DataFrame,
    threshold: float | None = None,
    score: str = "relevance",
    cell_rows: int = INDEX_ROWS,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """``(query_key, item_key, cos, score)``: each query's nearest index row, smallest key on a tie.

    ``queries`` has ``query_key, query_vec``, ``index`` has ``item_key, item_vec``. ``score`` is
    ``relevance`` (1 - sqrt(2) (1 - cos)) or ``cosine``. With a ``threshold`` only neighbours of at
    least that score, rounded to six places, are returned; the highest cosine decides that, before a tie goes to a
    smaller key. The result is exact whatever ``cell_rows`` and
    ``max_pivots`` are; they set how many cells there are, at most ``max_pivots``, and so how many can be passed over.

    Both inputs are read more than once: pass stored tables, not fresh model output.
    """
    to_score = relevance if score == "relevance" else (lambda c: c)
    least = -1.0 if threshold is None else cosine_for_relevance(threshold) if score == "relevance" else threshold
    pivots = _choose_pivots(index, cell_rows, max_pivots)
    if not len(pivots):
        empty = f"query_key {queries.schema['query_key'].dataType.simpleString()}, item_key {index.schema['item_key'].dataType.simpleString()}, cos double, score double"
        return queries.sparkSession.createDataFrame([], empty)
    assigned = storage.materialize(_assign_cells(index.select("item_key", "item_vec"), "item_vec", pivots), label="index-cells")
    own = storage.materialize(_assign_cells(queries.select("query_key", "query_vec"), "query_vec", pivots).drop("angle"), label="own-cells")
    rows = assigned.drop("angle")
    best = best_in_cells(own, rows, one_cell=True)
    if len(pivots) > 1:  # there are other cells
        found = storage.materialize(best, label="own-best")
        # A query travels once per group of cells, and meets all rows of the group; cells are what is ruled out or not.
        groups = _cell_groups(assigned, pivots)
        visits = cells_to_visit(own, found, assigned, pivots, least, groups)
        grouped = rows.withColumn("cell", F.get(F.array(*map(F.lit, groups.tolist())), F.col("cell")))
        beyond = best_in_cells(visits.join(queries, "query_key"), grouped, counted=(visits, grouped))
        best = _best_of(found.unionByName(beyond))
    best = best.withColumn("score", to_score(F.col("cos")))
    if threshold is not None:
        best = best.where(F.round(to_score(F.col("top")), _PLACES) >= threshold)
    return best.drop("top")
