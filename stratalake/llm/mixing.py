"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; a document of it is to be taken target / source size
times, so it has a whole number of sure copies and a fractional one. Two fractional copies are
paired and words are moved between them at random, with the sum kept and each expectation
unchanged, until one copy is whole; the other is paired with the next. Documents are dealt into
groups of bounded size, each group leaves one residual, and residuals meet in a tree: a share of
the documents waits for every level, so that residuals always meet many fresh documents. Within a
group long documents come first, so that the residual shrinks. Only the last one of a source is
rounded alone, to the nearer side; what that leaves over or short is evened out by giving or taking
back single copies of the documents that fit best.

Defined cases: a null or empty text has size 0 and is taken 0 times; null is a source of its own,
last in order; a source without words has target 0. Repeated rows are separate units. Null ids are
ordinary ids. An empty table gives no rows. All random numbers come from the seed and the place in
the tree, so reruns agree whatever the partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import fits_broadcast
from stratalake.sources.staging import Staging

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixParams:
    # Weights of the sources in code-point order, repeating.
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    # Target words in all, as a multiple of the words there are.
    share: float = 1.5
    # Most copies of a document.
    most: float = 2.0
    seed: int = 7
    # Documents in a group, and residuals that meet in a node of the tree.
    group_size: int = 2048
    fan_in: int = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """Targets of sources, from (source, source_size): one row per source throughout.

    The target is min(cap, level * weight) with the one level at which the targets add up: what
    capped sources leave over is reshared by weight. Sorted by cap / weight, the capped ones come
    first, and the level follows from running sums.
    """
    kinds = len(params.weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_ratio", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sizes.withColumn("source_no", place)
        .withColumn("_weight", F.element_at(F.array(*map(F.lit, params.weights)), ((F.col("source_no") - 1) % kinds + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(params.most))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    running = (
        weighed.withColumn("_words", F.sum("source_size").over(whole) * F.lit(params.share))
        .withColumn("_rest", F.col("_words") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_weights", F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn("_level", F.col("_rest") / F.col("_weights"))
    )
    fits = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "source_no", "_level"))
    level = F.coalesce(F.min(fits).over(whole)["_level"], F.lit(float("inf")))
    return running.withColumn("target", F.least(F.col("_cap"), level * F.col("_weight"))).select(
        "source", "source_no", "source_size", "target"
    )


def _settle(size: np.ndarray, p: np.ndarray, rng: np.random.Generator, last: bool) -> np.ndarray:
    """Pair the copies in order; all come back whole but one, and with `last` that one too."""
    p, draws = p.copy(), rng.random(len(p))
    i = 0
    for j in range(1, len(p)):
        # Words that can move from i to j, and from j to i.
        give = min(p[i] * size[i], (1 - p[j]) * size[j])
        get = min((1 - p[i]) * size[i], p[j] * size[j])
        if draws[j] * (give + get) < get:
            i_whole, moved = give >= p[i] * size[i], give
            p[j] = 1.0 if not i_whole else p[j] + moved / size[j]
            p[i] = 0.0 if i_whole else p[i] - moved / size[i]
        else:
            i_whole, moved = get >= (1 - p[i]) * size[i], get
            p[j] = 0.0 if not i_whole else p[j] - moved / size[j]
            p[i] = 1.0 if i_whole else p[i] + moved / size[i]
        if i_whole:
            i = j
    if last and len(p):
        goal = float((p * size).sum())
        p[i] = np.floor(p[i] + 0.5)
        _even_out(size, p, goal)
    return p


def _even_out(size: np.ndarray, p: np.ndarray, goal: float) -> None:
    """Give and take back whole copies, each time of the document that comes nearest to what is
    missing or too much, as long as that helps. No document is touched twice."""
    free = np.ones(len(p), dtype=bool)
    while True:
        over = float((p * size).sum()) - goal
        usable = np.flatnonzero(free & (p == (1.0 if over > 0 else 0.0)))
        if not len(usable):
            return
        best = usable[np.abs(size[usable] - abs(over)).argmin()]
        if abs(abs(over) - size[best]) >= abs(over):
            return
        p[best] = 1.0 - p[best]
        free[best] = False


_EDGE = 1e-9


def _round_tree(units: DataFrame, params: MixParams, staging: Staging) -> DataFrame:
    """`units` (source_no, ..., size, p) with p whole."""
    keys = ["doc_id", "row_hash", "copy_no"]
    schema = units.schema

    def node(level: int, last: bool, drop: list[str]):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", *keys], ascending=[False, True, True, True], kind="stable", ignore_index=True)
            rng = np.random.default_rng([params.seed, level, int(key[0]), int(key[1])])
            p = _settle(rows["size"].to_numpy(dtype=float), rows["p"].to_numpy(), rng, last)
            p[p < _EDGE], p[p > 1 - _EDGE] = 0.0, 1.0
            return rows.assign(p=p).drop(columns=drop)

        return run

    per_source = units.groupBy("source_no").agg(F.count(F.lit(1)).alias("n"))
    most = per_source.agg(F.max("n")).first()[0] or 0
    groups = F.ceil(F.col("n") / params.group_size).cast("long")
    counted = units.join(F.broadcast(per_source) if fits_broadcast(per_source) else per_source, "source_no")
    open_units = counted.withColumn("_group", F.pmod(F.xxhash64(F.lit(params.seed), *keys), groups)).drop("n")
    open_schema = T.StructType([*schema.fields, T.StructField("_group", T.LongType())])
    settled = []
    level, span = 1, 1
    while span * params.group_size < most:
        # Groups divisible by the next span wait for it.
        above = span * params.fan_in
        waits = F.col("_group") % above == 0
        solved = staging.table(
            open_units.where(~waits).withColumn("_node", F.expr(f"_group div {span}"))
            .groupBy("source_no", "_node")
            .applyInPandas(node(level, False, ["_node"]), open_schema)
        )
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        settled.append(solved.where(~is_open).drop("_group"))
        passed = solved.where(is_open).withColumn("_group", F.expr(f"_group - _group % {above}"))
        open_units = open_units.where(waits).unionByName(passed)
        level, span = level + 1, above
    final = (
        open_units.withColumn("_node", F.lit(0).cast("long")).groupBy("source_no", "_node")
        .applyInPandas(node(level, True, ["_node", "_group"]), schema)
    )
    for part in settled:
        final = final.unionByName(part)
    return final


def mix(
    docs: DataFrame, params: MixParams = MixParams(), doc_id: str = "doc_id", text: str = "text",
    source: str = "source", row_hash: Column | None = None, staging: Staging | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, row_hash, copy_no, size, source_size, target, copies,
    taken. Rows alike in id, source, size and `row_hash` are numbered by copy_no."""
    staging = staging or Staging(docs.sparkSession)
    sized = docs.select(
        # As text, since pandas has no whole numbers with nulls.
        F.col(doc_id).cast("string").alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        (F.xxhash64(F.col(text)) if row_hash is None else row_hash).alias("row_hash"),
    )
    alike = staging.table(
        sized.groupBy("doc_id", "source", "size", "row_hash").agg(F.count(F.lit(1)).alias("rows"))
    )
    sizes = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = staging.table(source_targets(sizes, params))
    targets = targets.withColumnRenamed("source", "_source")
    side = F.broadcast(targets) if fits_broadcast(targets) else targets
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = staging.table(
        alike.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
        .withColumn("_times", times).withColumn("_sure", F.floor(F.col("_times") + F.lit(_EDGE)))
        .withColumn("p", F.greatest(F.lit(0.0), F.col("_times") - F.col("_sure"))).drop("_times")
    )
    is_open = (F.col("size") > 0) & (F.col("p") > 0)
    rounded = _round_tree(
        units.where(is_open).select("source_no", "doc_id", "row_hash", "copy_no", "size", "_sure", "source", "source_size", "target", "p"),
        params, staging,
    )
    whole = units.where(~is_open).withColumn("p", F.lit(0.0))
    everyone = rounded.unionByName(whole.select(rounded.columns))
    copies = F.when(F.col("size") > 0, F.col("_sure") + F.round("p")).otherwise(0).cast("long")
    return everyone.withColumn("copies", copies).select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType).alias("doc_id"), "source", "row_hash", "copy_no", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def take_mix(docs: DataFrame, params: MixParams = MixParams()) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken."""
    parts = [
        F.to_json(F.struct(F.col(f.name))) if isinstance(f.dataType, (T.MapType, T.VariantType)) else F.col(f.name)
        for f in docs.schema.fields
    ]
    row_hash = F.xxhash64(*parts)
    staging = Staging(docs.sparkSession)
    plan = staging.table(
        mix(docs, params, row_hash=row_hash, staging=staging).groupBy("doc_id", "row_hash")
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_alike"))
        .withColumnsRenamed({"doc_id": "_mix_id", "row_hash": "_mix_hash"})
    )
    keyed = docs.withColumn("_row_hash", row_hash).join(
        plan.where("_copies > 0"),
        (F.col("_row_hash") == F.col("_mix_hash")) & F.col("doc_id").eqNullSafe(F.col("_mix_id")),
    )
    # Rows alike in every column share their copies.
    single = keyed.where("_alike = 1")
    alike = keyed.where("_alike > 1").dropDuplicates(["_mix_id", "_mix_hash"])
    taken = single.unionByName(alike)
    return taken.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(
        *docs.columns
    )
