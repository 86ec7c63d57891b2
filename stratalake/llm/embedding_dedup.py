"""Near-duplicate embeddings by E8 lattice hashing.

Every table projects a unit vector to eight dimensions and decodes the projection to the nearest
point of the E8 lattice: its own cell. It probes, too, the neighbouring cells nearest to the
projection. Vectors meet where one's own cell is another's own or probed cell; cosines there are
computed in double precision, block against block, so that no candidate pair becomes a row. A pair
that meets more than once is counted in the first table, and there in one cell, which each block
decides from the two vectors alone. A cell with many vectors is dealt out in pairs of blocks of
bounded size.

What leaves a block is one count per vector and a spanning star of each group linked within it.
Equal vectors are one node with a weight.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component, and
vectors with a null label, link with nothing. Vectors of different lengths never link. Rows with
equal ids are separate vectors. Null ids count as vectors; a component's id is its least id that is
not null. An empty table gives no rows. Only the id, vector and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.textscan import mix
from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class LatticeParams:
    similarity: float = 0.98
    tables: int = 3
    probes: int = 6
    # Length of a unit vector's projection per dimension. At 0.9 a table finds about 95% of the
    # pairs at cosine 0.98, and more of closer ones.
    scale: float = 0.9
    # Vectors in a block.
    block: int = 256
    seed: int = 8


# ---- lattice ----

def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates and an even sum."""
    whole = np.rint(x)
    off = x - whole
    row, worst = np.arange(len(x)), np.abs(off).argmax(axis=1)
    odd = whole.sum(axis=1) % 2 != 0
    whole[row[odd], worst[odd]] += np.where(off[row, worst] >= 0, 1.0, -1.0)[odd]
    return whole


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8 or of D8 moved by one half in every coordinate."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


@lru_cache(maxsize=1)
def shortest_vectors() -> np.ndarray:
    """The 240 neighbours of the origin."""
    whole = [v for v in product((-1.0, 0.0, 1.0), repeat=8) if sum(map(abs, v)) == 2]
    half = [v for v in product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


@lru_cache(maxsize=8)
def _projections(dims: int, params: LatticeParams) -> np.ndarray:
    rng = np.random.default_rng([params.seed, dims])
    return rng.normal(size=(params.tables, dims, 8)) * params.scale


_ODD = np.random.default_rng(88).integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)


def _cell_hash(points: np.ndarray, table: int) -> np.ndarray:
    whole = np.rint(points * 2).astype(np.int64).view(np.uint64)
    return mix((whole * _ODD).sum(axis=-1, dtype=np.uint64) + np.uint64(table + 1)).view(np.int64)


def cells(unit: np.ndarray, params: LatticeParams) -> tuple[np.ndarray, np.ndarray]:
    """Own cells (rows, tables) and probed cells (rows, tables, probes) of unit vectors."""
    own = np.empty((len(unit), params.tables), dtype=np.int64)
    probed = np.empty((len(unit), params.tables, params.probes), dtype=np.int64)
    around = shortest_vectors()
    for t, projection in enumerate(_projections(unit.shape[1], params)):
        x = unit @ projection
        point = nearest_e8(x)
        own[:, t] = _cell_hash(point, t)
        nearest = np.argsort(-((x - point) @ around.T), axis=1, kind="stable")[:, : params.probes]
        probed[:, t] = _cell_hash(point[:, None, :] + around[nearest], t)
    return own, probed


def _unit(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


# ---- candidates ----

def _cell_rows(classes: DataFrame, params: LatticeParams) -> DataFrame:
    """(cid, kind, cell, cell_table, own): where each vector lies and looks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, cid, kind = (batch.column(n) for n in ("vector", "cid", "kind"))
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                for chosen in np.array_split(np.flatnonzero(sizes == size), -(-(sizes == size).sum() // 1024)):
                    own, probed = cells(_unit(vectors.take(pa.array(chosen))), params)
                    every = np.concatenate([own[:, :, None], probed], axis=2)
                    each = every.shape[1] * every.shape[2]
                    place = np.broadcast_to(np.arange(params.tables, dtype=np.int32)[None, :, None], every.shape)
                    first = np.zeros(every.shape, dtype=bool)
                    first[:, :, 0] = True
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(cid.to_numpy()[chosen], each)), pa.array(np.repeat(kind.to_numpy()[chosen], each)),
                        pa.array(every.ravel()), pa.array(place.ravel()), pa.array(first.ravel()),
                    ], names=["cid", "kind", "cell", "cell_table", "own"])

    return classes.select("cid", "kind", "vector").mapInArrow(
        run, "cid long, kind long, cell long, cell_table int, own boolean"
    )


_PLACE = ["kind", "cell", "cell_table", "task", "i", "j"]


def _dealt(rows: DataFrame, params: LatticeParams) -> DataFrame:
    """Rows of cells where a pair can meet, once for every pair of blocks they belong to.

    Task 0 holds a small cell whole. A larger one has tasks 1 (own block i with own block j) and 2
    (own block i with probing block j). Side 0 is compared with itself, where the task has no
    other side or is 0, and with side 1 or 2.
    """
    tally = rows.groupBy("kind", "cell", "cell_table").agg(
        F.count_if("own").alias("_n"), F.count_if(~F.col("own")).alias("_p")
    ).where("_n > 0 and _n + _p > 1")
    met = (
        rows.join(tally, ["kind", "cell", "cell_table"])
        .withColumn("_bn", F.ceil(F.col("_n") / params.block).cast("int"))
        .withColumn("_bp", F.ceil(F.col("_p") / params.block).cast("int"))
        .withColumn("_at", F.pmod(F.xxhash64("cid"), F.when(F.col("own"), F.col("_bn")).otherwise(F.col("_bp"))).cast("int"))
    )

    def places(count: str, task: int, i, j, side):
        numbers = F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda x: F.struct(
            F.lit(task).alias("task"), i(x).cast("int").alias("i"), j(x).cast("int").alias("j"), side(x).cast("int").alias("side")
        ))

    at = F.col("_at")
    small = F.array(F.struct(
        F.lit(0).alias("task"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(F.col("own"), 0).otherwise(2).alias("side")
    ))
    own = F.concat(
        places("_bn", 1, lambda x: F.least(x, at), lambda x: F.greatest(x, at), lambda x: F.when(at <= x, 0).otherwise(1)),
        places("_bp", 2, lambda x: at, lambda x: x, lambda x: F.lit(0)),
    )
    probing = places("_bn", 2, lambda x: x, lambda x: at, lambda x: F.lit(2))
    where = F.when((F.col("_bn") == 1) & (F.col("_bp") <= 1), small).when(F.col("own"), own).otherwise(probing)
    return met.withColumn("_where", F.explode(where)).select("cid", "kind", "cell", "cell_table", "_where.*")


# ---- verification ----

class _Block:
    """The vectors that meet in one task of one cell."""

    def __init__(self, key: tuple, cid, weight, side, vectors: pa.Array, params: LatticeParams):
        self.cell, self.table, self.task, self.same = key[1], key[2], key[3], key[4] == key[5]
        self.cid, self.weight, self.side, self.params = cid, weight, side, params
        self.unit = _unit(vectors)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        own, other = np.flatnonzero(self.side == 0), np.flatnonzero(self.side > 0)
        found = []
        if self.task == 0 or self.task == 1 and self.same:
            a, b = np.nonzero(np.triu(self.unit[own] @ self.unit[own].T >= self.params.similarity, 1))
            found.append((own[a], own[b]))
        if len(other):
            a, b = np.nonzero(self.unit[own] @ self.unit[other].T >= self.params.similarity)
            found.append((own[a], other[b]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2

    def _counted_here(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the pairs, those whose first meeting place this cell is."""
        used, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        own, probed = cells(self.unit[used], self.params)
        a, b = place[: len(a)], place[len(a) :]
        here = np.ones(len(a), dtype=bool)
        for t in range(self.table + 1):
            alike = own[a, t] == own[b, t]
            a_looks = (probed[a, t] == own[b, t][:, None]).any(axis=1)
            b_looks = (probed[b, t] == own[a, t][:, None]).any(axis=1)
            if t < self.table:
                here &= ~(alike | a_looks | b_looks)
            else:
                far = np.iinfo(np.int64).max
                least = np.minimum(np.where(a_looks, own[b, t], far), np.where(b_looks, own[a, t], far))
                here &= np.where(alike, own[a, t], least) == self.cell
        return here

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """cid, weight of newly counted links, and the first vector linked within this block."""
        a, b = self._pairs()
        links = np.zeros(len(self.cid), dtype=np.int64)
        root = np.arange(len(self.cid))
        for s in range(0, len(a), 1 << 16):
            x, y = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
            here = self._counted_here(x, y)
            np.add.at(links, x[here], self.weight[y[here]])
            np.add.at(links, y[here], self.weight[x[here]])
        while len(a):
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
            if (before == root).all():
                break
        used = np.flatnonzero((links > 0) | (root != np.arange(len(root))))
        return self.cid[used], links[used], self.cid[root[used]]


def _linked(dealt: DataFrame, classes: DataFrame, params: LatticeParams) -> DataFrame:
    """(cid, links, root) of every block."""
    rows = dealt.join(classes.select("cid", "weight", "vector"), "cid").select(*_PLACE, "side", "cid", "weight", "vector")
    laid = rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def blocks(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(edges) < 2:
                return
            table = table.slice(0, edges[-1]).combine_chunks()
            columns = [table.column(n).to_numpy() for n in [*_PLACE, "cid", "weight", "side"]]
            vectors = table.column("vector").chunk(0)
            out = []
            for s, e in zip(edges[:-1], edges[1:]):
                key = tuple(int(c[s]) for c in columns[:6])
                out.append(_Block(key, *(c[s:e] for c in columns[6:]), vectors.slice(s, e - s), params).result())
            cid, links, root = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(links), pa.array(root)], names=["cid", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            places = [held.column(n).to_numpy() for n in _PLACE]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in places], axis=0)) + 1
            # The last block may go on in the next batch.
            yield from blocks(held, np.concatenate([[0], changes]))
            if len(changes):
                held = held.slice(changes[-1])
        if held is not None:
            yield from blocks(held, np.array([0, held.num_rows]))

    return laid.mapInArrow(run, "cid long, links long, root long")


def link_embeddings(
    vectors: DataFrame, params: LatticeParams = LatticeParams(), vec_id: str = "vec_id",
    vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    staging = Staging(vectors.sparkSession)
    number = F.col("vector")
    usable = (
        F.col("label").isNotNull() & F.coalesce(F.size(number) > 0, F.lit(False))
        & F.forall(number, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        & F.exists(number, lambda x: x != 0)
    )
    named = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    kind = F.xxhash64("label", F.size("vector"))
    keyed = named.withColumn("kind", F.when(F.coalesce(usable, F.lit(False)), kind)).withColumn(
        "cid", F.when(F.col("kind").isNotNull(), F.xxhash64("kind", "vector"))
    )
    ids = staging.table(keyed.select("vec_id", "cid"))
    classes = staging.table(
        keyed.where(F.col("cid").isNotNull()).groupBy("cid", "kind", "vector")
        .agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"))
    )
    rows = staging.table(_cell_rows(classes, params))
    found = staging.table(_linked(_dealt(rows, params), classes, params))
    labels = components(found.select("cid", "root").distinct(), "cid", "root", staging)
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    whole = (
        classes.select("cid", "first", "weight").join(counts, "cid", "left")
        .join(labels.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
    )
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = whole.join(least, "component").select(
        "cid", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    result = ids.join(answer, "cid", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return result.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
