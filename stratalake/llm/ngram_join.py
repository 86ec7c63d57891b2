"""N-gram Jaccard self-join by token-combination prefixes.

A document's set holds its distinct shingles, as 64-bit hashes. Two sets with Jaccard similarity t
or more leave at most e = n - ceil(t * n) tokens of either unmatched, so they share a token of the
first e + 1 under any global order. Three things make that cheap:

* Order. Shingles that many documents hold come last. Which ones do is counted over all documents;
  the answer is kept as a bitmap of fixed size, and the order is defined by the bitmap, so that a
  collision in it costs time but no link.
* Combinations. Frequent tokens of a prefix are not indexed alone but in pairs within classes, and
  the prefix is extended until e deletions cannot break all of its single tokens and pairs: a class
  with m tokens counts m - 1. The number of classes follows the size of the set, so that a document
  has about as many pairs as tokens; documents at the edge of a size class index under both.
* Classes of equal sets are one node of the join, whatever their number.

Documents in one bucket of the index are candidates. Before their sets are compared, they must
share as many signatures as two sets of their sizes cannot do without: of a prefix of p tokens at
most n - o are unmatched if o tokens of n must be shared. That takes the signatures alone and drops
nearly all pairs that share a phrase by chance. Only sets of pairs that remain are gathered.

Pairs are verified in two rounds. In the first, each document meets the first document of each of
its buckets and, in a sixteenth of its buckets, another one drawn by hash, so that large families
hang together although few of their pairs were tested. Links are closed to components. The second
round tests all pairs between different components of a bucket: as rows in a small bucket, in blocks
of sets that one task compares as matrices where buckets are large. No pair that could join two
components is left out, and neither copies of one text nor large families are expanded to pairs.

Defined cases: null, empty or wordless texts have an empty set and link with nothing; with fewer
words than a shingle, the whole sequence is the one shingle. Rows with equal ids are separate
documents. Null ids take part, and have a null component unless linked to a document with an id. An
empty table gives no rows. Only the id and text columns are read. Shingles and sets are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.components import components
from stratalake.llm.textscan import Chunk, chunks, mix, span_hashes, window_hashes, words
from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class NgramJoinParams:
    shingle: int = 5
    similarity: Fraction = Fraction(3, 4)
    # A shingle held by more sets than this is frequent.
    frequent: int = 4
    # Bits of the bitmap of frequent shingles: 8 MB, whatever the corpus.
    bitmap_bits: int = 26
    # Bits of a document filter: 1 MB.
    filter_bits: int = 23
    # Ranges in which shingles are counted, one task each: a power of two.
    ranges: int = 512
    # Buckets with more members are compared in blocks of that many sets.
    small_bucket: int = 8
    block: int = 256


# ---- sets ----

def shingle_sets(chunk: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk, sorted within each row, and the bounds of the rows."""
    found = words(chunk)
    hashes = span_hashes(chunk, found.starts, found.ends, lower=True)
    row = found.row
    tokens = window_hashes(hashes, size)
    inside = row[: len(tokens)] == row[len(row) - len(tokens) :]
    tokens, of = tokens[inside], row[: len(tokens)][inside]
    counts = found.counts
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[found.first[i] : found.first[i + 1]]
        whole = window_hashes(own, len(own)) + np.uint64(len(own))
        tokens, of = np.concatenate([tokens, whole]), np.concatenate([of, [i]])
    order = np.lexsort((tokens, of))
    tokens, of = tokens[order], of[order]
    if len(tokens):
        fresh = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (of[1:] != of[:-1])])
        tokens, of = tokens[fresh], of[fresh]
    return tokens, np.searchsorted(of, np.arange(chunk.rows + 1))


def set_hashes(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash of each set, 0 for an empty one."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(tokens), dtype=np.uint64)])
    sizes = np.diff(bounds)
    own = mix(sums[bounds[1:]] - sums[bounds[:-1]] + sizes.astype(np.uint64))
    return np.where(sizes > 0, own, np.uint64(0)).view(np.int64)


def documents_with_sets(docs: DataFrame, size: int) -> DataFrame:
    """The columns of `docs` other than its text, with set_hash and n_shingles."""
    kept = [c for c in docs.columns if c != "text"]
    schema = docs.select(kept).schema.add("set_hash", "long").add("n_shingles", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                tokens, bounds = shingle_sets(chunk, size)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(chunk.first_row, chunk.rows) for c in kept),
                    pa.array(set_hashes(tokens, bounds)), pa.array(np.diff(bounds).astype(np.int64)),
                ], names=[*kept, "set_hash", "n_shingles"])

    return docs.mapInArrow(run, schema)


# ---- frequent shingles ----

# Within its range, a shingle is counted by the next 32 bits.
_CELL_BITS = 32


def frequent_bitmap(docs: DataFrame, params: NgramJoinParams) -> np.ndarray:
    """Bit i: some shingle whose top bits are i is held by more than `frequent` different sets.

    Every task sends its cells as sorted arrays, one for each range of cells, with runs counted;
    every range is added up by one task, which returns its slice of the bitmap. Sets alike within
    a task count once. Gaps between cells travel byte plane by byte plane, which compresses well.
    """
    size, bits, limit, ranges = params.shingle, params.bitmap_bits, params.frequent, params.ranges
    range_bits = ranges.bit_length() - 1
    shift = np.uint64(64 - range_bits - _CELL_BITS)
    cells_schema = "part int, cells binary, counts binary"
    flush = 1 << 21

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        n = 0

        def send() -> pa.RecordBatch:
            own, counts = np.unique(np.concatenate(held), return_counts=True)
            edges = np.searchsorted(own, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(_CELL_BITS))
            low = (own & np.uint64((1 << _CELL_BITS) - 1)).astype("<u4")
            wide = np.minimum(counts, 65_535).astype(np.uint16)
            gaps = [
                np.diff(low[a:b], prepend=np.zeros(1, "<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()
                for a, b in zip(edges[:-1], edges[1:])
            ]
            tallies = [wide[a:b].tobytes() if (wide[a:b] > 1).any() else b"" for a, b in zip(edges[:-1], edges[1:])]
            held.clear()
            return pa.RecordBatch.from_pydict({
                "part": pa.array(range(ranges), pa.int32()), "cells": pa.array(gaps, pa.binary()),
                "counts": pa.array(tallies, pa.binary()),
            })

        for batch in batches:
            for chunk in chunks(batch.column("text")):
                tokens, bounds = shingle_sets(chunk, size)
                fresh = _first_seen(set_hashes(tokens, bounds), seen)
                held.append(tokens[np.repeat(fresh, np.diff(bounds))] >> shift)
                n += len(held[-1])
                if n >= flush:
                    yield send()
                    n = 0
        if held:
            yield send()

    slice_bits = (1 << bits) // ranges

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tally = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        todo: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> None:
            nonlocal own, tally
            joined = np.concatenate([own, *(x for x, _ in todo)])
            weights = np.concatenate([tally, *(w for _, w in todo)])
            own, place = np.unique(joined, return_inverse=True)
            tally = np.bincount(place, weights=weights, minlength=len(own)).astype(np.int64)
            todo.clear()

        for batch in batches:
            for raw, counts in zip(batch.column("cells"), batch.column("counts")):
                planes = np.frombuffer(raw.as_py(), dtype=np.uint8).reshape(4, -1)
                x = np.cumsum(np.ascontiguousarray(planes.T).view("<u4")[:, 0], dtype=np.uint32)
                w = np.frombuffer(counts.as_py(), dtype=np.uint16)
                todo.append((x, w.astype(np.int64) if len(w) else np.ones(len(x), dtype=np.int64)))
                if sum(len(x) for x, _ in todo) > max(1 << 20, len(own)):
                    merge()
        merge()
        marked = np.zeros(slice_bits, dtype=bool)
        marked[(own[tally > limit] >> np.uint32(_CELL_BITS - (bits - range_bits))).astype(np.int64)] = True
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([np.packbits(marked).tobytes()], pa.binary()),
            "counts": pa.array([b""], pa.binary()),
        })

    sent = docs.select("text").mapInArrow(cells, cells_schema)
    bitmap = np.zeros((1 << bits) // 8, dtype=np.uint8)
    # One row per part: the bitmap itself.
    for row in sent.groupBy("part").applyInArrow(add, cells_schema).collect():
        own = np.frombuffer(row["cells"], dtype=np.uint8)
        bitmap[row["part"] * len(own) : (row["part"] + 1) * len(own)] = own
    return bitmap


def _first_seen(hashes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Mark the nonempty sets that this task meets for the first time."""
    fresh = np.zeros(len(hashes), dtype=bool)
    for i, x in enumerate(hashes.tolist()):
        if x and x not in seen:
            seen.add(x)
            fresh[i] = True
    return fresh


# ---- signatures ----

def _is_frequent(tokens: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    place = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1


def _pairs_needed(tokens: np.ndarray, classes: int, need: int, scheme: int) -> np.ndarray:
    """Pairs within the classes of the shortest prefix of `tokens` that withstands need - 1
    deletions."""
    own = (mix(tokens ^ np.uint64(0xA5A5_5A5A_1234_8765)) % np.uint64(classes)).astype(np.int64)
    order = np.argsort(own, kind="stable")
    first = np.zeros(len(tokens), dtype=bool)
    first[order[np.concatenate([[True], own[order][1:] != own[order][:-1]])]] = True
    gained = np.cumsum(~first)
    length = int(np.searchsorted(gained, need)) + 1
    tokens, own = tokens[:length], own[:length]
    out = []
    order = np.argsort(own, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], own[order][1:] != own[order][:-1], [True]]))
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a > 1:
            group = tokens[order[a:b]]
            i, j = np.triu_indices(b - a, 1)
            low, high = np.minimum(group[i], group[j]), np.maximum(group[i], group[j])
            out.append(mix(mix(low + np.uint64(scheme + 1)) * np.uint64(0x9E3779B97F4A7C15) + high))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def signatures(
    tokens: np.ndarray, frequent: np.ndarray, similarity: Fraction
) -> tuple[np.ndarray, bool]:
    """Index entries of one set, given sorted tokens and which of them are frequent, and whether
    they are single tokens only."""
    n = len(tokens)
    spare = n - -(-similarity.numerator * n // similarity.denominator)
    if n * similarity.denominator < (n + 1) * similarity.numerator:
        return tokens[:0], True  # only an equal set is that similar
    rare, common = tokens[~frequent], tokens[frequent]
    single = rare[: spare + 1]
    need = spare + 1 - len(single)
    if need <= 0:
        return single, True
    scheme = n.bit_length() - 1
    schemes = [scheme]
    # A larger partner may be in the next size class.
    if n * similarity.denominator >= similarity.numerator << (scheme + 1):
        schemes.append(scheme + 1)
    pairs = [_pairs_needed(common, max(1, 1 << s >> 2), need, s) for s in schemes]
    return np.concatenate([single, *pairs]), False


def index_entries(docs: DataFrame, bitmap, params: NgramJoinParams) -> DataFrame:
    """(signature, set_hash, n, lead, rare) rows; sets alike within a task enter once. n is the
    size of the set, negative if pairs are among its signatures. `lead` marks the signatures one of
    which any set shares that is as large or larger, and similar. `rare` counts the set's rare
    tokens: in a family of near copies, the one with the fewest is nearest to all others."""
    size, bits, similarity = params.shingle, params.bitmap_bits, params.similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        own_bitmap = bitmap.value
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                tokens, bounds = shingle_sets(chunk, size)
                frequent = _is_frequent(tokens, own_bitmap, bits)
                hashes = set_hashes(tokens, bounds)
                common = np.concatenate([[0], np.cumsum(frequent)])[bounds]
                rare = (np.diff(bounds) - np.diff(common)).astype(np.int32)
                entries, owner, first, sizes = [], [], [], np.zeros(chunk.rows, dtype=np.int32)
                for i in np.flatnonzero(_first_seen(hashes, seen)):
                    a, b = bounds[i], bounds[i + 1]
                    found, single = signatures(tokens[a:b], frequent[a:b], similarity)
                    entries.append(found)
                    owner.append((i, len(found)))
                    first.append(np.arange(len(found)) < (_lead(b - a, similarity) if single else len(found)))
                    sizes[i] = b - a if single else a - b
                if entries:
                    of = np.repeat([x for x, _ in owner], [n for _, n in owner]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate(entries).view(np.int64)), pa.array(hashes[of]),
                        pa.array(sizes[of]), pa.array(np.concatenate(first)), pa.array(rare[of]),
                    ], names=["signature", "set_hash", "n", "lead", "rare"])

    return docs.select("text").mapInArrow(run, "signature long, set_hash long, n int, lead boolean, rare int")


def _lead(n: int, similarity: Fraction) -> int:
    """How far the first shared token of a set can lie, if the other set is as large or larger."""
    p, q = similarity.numerator, similarity.denominator
    return n - -(-2 * p * n // (p + q)) + 1


_ENTRY = ["set_hash", "n", "lead"]


def buckets(entries: DataFrame) -> DataFrame:
    """Entries of signatures that two or more different sets have, once each, with two partners in
    their bucket: the one with the fewest rare tokens as centre (c_) and one drawn by hash (o_). The
    centre itself has no row."""
    laid = entries.repartition("signature").sortWithinPartitions("signature", "rare", "set_hash")
    schema = "signature long" + "".join(
        f", {prefix}set_hash long, {prefix}n int, {prefix}lead boolean" for prefix in ("", "c_", "o_")
    )
    names = ["signature", *(f"{prefix}{c}" for prefix in ("", "c_", "o_") for c in _ENTRY)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last entry of the batches so far, and the centre of its bucket.
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, *entry = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            carried = last is not None
            if carried:
                sig = np.concatenate([[last[0]], sig])
                entry = [np.concatenate([[x], y]) for x, y in zip(last[1], entry)]
            own = entry[0]
            opens = np.concatenate([[True], sig[1:] != sig[:-1]])
            start = np.flatnonzero(opens)
            bucket = np.cumsum(opens) - 1
            centre = [e[start][bucket] for e in entry]
            if carried:
                for c, known in zip(centre, last[2]):
                    c[bucket == 0] = known
            # The other partner is drawn from what this batch holds of the bucket.
            draw = mix(own.view(np.uint64) ^ mix(sig.view(np.uint64)))
            order = np.lexsort((draw, bucket))
            other = [e[order[start]][bucket] for e in entry]
            fresh = np.concatenate([[not carried], (own[1:] != own[:-1]) | opens[1:]])
            keep = fresh & (own != centre[0])
            last = (sig[-1], [e[-1] for e in entry], [c[-1] for c in centre])
            if keep.any():
                columns = [pa.array(sig[keep])]
                for values in (entry, centre, other):
                    columns += [
                        pa.array(v[keep].astype(kind)) for v, kind in zip(values, (np.int64, np.int32, bool))
                    ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return laid.select("signature", *_ENTRY).mapInArrow(run, schema)


# ---- verification ----

def _filter_of(sets: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of fixed size, marked at the top bits of the given set hashes."""
    place = F.shiftrightunsigned("set_hash", 64 - bits) + 1
    rows = sets.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    width = 32_768 // 8
    for row in rows.collect():
        at = (row["bucket"] - 1) * width
        out[at : at + width] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def token_rows(docs: DataFrame, wanted: DataFrame, params: NgramJoinParams) -> DataFrame:
    """(set_hash, tokens) of the wanted sets; a filter of fixed size thins the rows out first."""
    bits, size = params.filter_bits, params.shingle
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, seen = shared.value, set()
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                tokens, bounds = shingle_sets(chunk, size)
                hashes = set_hashes(tokens, bounds)
                place = (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
                maybe = (marked[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                keep = np.flatnonzero(maybe)
                keep = keep[_first_seen(hashes[keep], seen)]
                if len(keep):
                    sizes = np.diff(bounds)[keep]
                    at = np.repeat(bounds[keep] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    sets = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens[at].view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[keep]), sets], names=["set_hash", "tokens"])

    rows = docs.select("text").mapInArrow(run, "set_hash long, tokens array<long>")
    return rows.join(wanted, "set_hash", "left_semi")


def verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. `sets` may hold a set several times, once
    for each task that met it."""
    left = sets.select(F.col("set_hash").alias("a"), F.col("tokens").alias("_a"))
    right = sets.select(F.col("set_hash").alias("b"), F.col("tokens").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - shared
    alike = both.where(shared * similarity.denominator >= union * similarity.numerator)
    return alike.select("a", "b").distinct()


# ---- the join ----

def _members(found: DataFrame) -> DataFrame:
    """(signature, set_hash, n, lead) of all sets in buckets, centres included."""
    centres = found.select("signature", *(F.col(f"c_{c}").alias(c) for c in _ENTRY))
    return found.select("signature", *_ENTRY).unionByName(centres.distinct())


def _may_meet(similarity: Fraction) -> Column:
    """Whether two entries of a bucket can be of similar sets, by their sizes and because the first
    token they share leads the smaller set."""
    a, b = F.abs("n"), F.abs("_n")
    sizes = F.least(a, b) * similarity.denominator >= F.greatest(a, b) * similarity.numerator
    leads = F.when(a < b, F.col("lead")).when(a > b, F.col("_lead")).otherwise(F.col("lead") | F.col("_lead"))
    return (F.col("set_hash") != F.col("_set_hash")) & sizes & leads


def _share_enough(similarity: Fraction) -> Column:
    """Whether sets with signatures _sa and _sb, of sizes _na and _nb, can be similar enough.

    For sets with single tokens only: of a's prefix at most n - o tokens are not in b, where o
    tokens must be shared, and those that are lie in b's prefix if a's ends first.
    """
    p, q = similarity.numerator, similarity.denominator
    both = F.col("_na") + F.col("_nb")
    shared = F.expr(f"({p} * (_na + _nb) + {p + q - 1}) div {p + q}")

    def needed(n: str) -> Column:
        spare = F.expr(f"{n} - ({p} * {n} + {q - 1}) div {q}")
        return spare + 1 - F.col(n) + shared

    single = (F.col("_na") > 0) & (F.col("_nb") > 0) & (both > 0)
    least = F.least(needed("_na"), needed("_nb"))
    return F.when(single, F.size(F.array_intersect("_sa", "_sb")) >= least).otherwise(True)


class _Join:
    """The rounds of verification and what they have in common."""

    def __init__(self, docs: DataFrame, params: NgramJoinParams, staging: Staging):
        self.docs, self.params, self.staging = docs, params, staging
        spark = docs.sparkSession
        bitmap = spark.sparkContext.broadcast(frequent_bitmap(docs, params))
        self.found = staging.table(buckets(index_entries(docs, bitmap, params)))
        self.held = staging.table(
            _members(self.found).groupBy("set_hash").agg(
                F.first("n").alias("n"), F.collect_set("signature").alias("signatures")
            )
        )
        empty = spark.createDataFrame([], "a long, b long")
        self.tested, self.links = empty, empty
        self.sets = spark.createDataFrame([], "set_hash long, tokens array<long>")
        self.labels = spark.createDataFrame([], "node long, component long")

    def gather(self, wanted: DataFrame) -> None:
        """Add the tokens of sets that are not held yet."""
        missing = self.staging.table(wanted.join(self.sets.select("set_hash"), "set_hash", "left_anti"))
        if not missing.isEmpty():
            gathered = self.staging.table(token_rows(self.docs, missing, self.params))
            self.sets = self.sets.unionByName(gathered)

    def verify(self, pairs: DataFrame) -> None:
        """Test pairs of sets (a, b) not tested before."""
        fresh = pairs.distinct().join(self.tested, ["a", "b"], "left_anti")

        def side(name: str) -> DataFrame:
            return self.held.select(
                F.col("set_hash").alias(name), F.col("n").alias(f"_n{name}"), F.col("signatures").alias(f"_s{name}")
            )

        likely = fresh.join(side("a"), "a").join(side("b"), "b").where(_share_enough(self.params.similarity))
        likely = self.staging.table(likely.select("a", "b"))
        if likely.isEmpty():
            return
        self.tested = self.tested.unionByName(likely)
        self.gather(likely.select(F.explode(F.array("a", "b")).alias("set_hash")).distinct())
        links = self.staging.table(verified(likely, self.sets, self.params.similarity))
        if not links.isEmpty():
            self.links = self.links.unionByName(links)
            self.labels = components(self.links, "a", "b", self.staging)

    def _pairs(self, met: DataFrame) -> DataFrame:
        """(a, b), ordered, of entries that meet and can be of similar sets."""
        return met.where(_may_meet(self.params.similarity)).select(
            F.least("set_hash", "_set_hash").alias("a"), F.greatest("set_hash", "_set_hash").alias("b")
        )

    def open_buckets(self) -> DataFrame:
        """Members, their components and their number, of buckets that hold several components."""
        named = _members(self.found).join(
            self.labels.withColumnRenamed("node", "set_hash"), "set_hash", "left"
        ).withColumn("component", F.coalesce("component", "set_hash"))
        several = self.staging.table(named.groupBy("signature").agg(
            F.min("component").alias("_x"), F.max("component").alias("_y"), F.count(F.lit(1)).alias("members")
        ).where("_x <> _y").drop("_x", "_y"))
        return self.staging.table(named.join(several, "signature"))

    def verify_families(self, rows: DataFrame) -> None:
        """Link the sets that meet in large buckets, across components.

        What lies outside the largest component of a unit is compared with all of it, block
        against block.
        """
        if rows.isEmpty():
            return
        counted = compared_units(rows, self.staging)

        def blocks(count: Column) -> Column:
            return F.ceil(count / self.params.block).cast("int")

        def dealt(own: Column, others: Column, side: int) -> DataFrame:
            at = F.pmod(F.xxhash64("set_hash"), own).cast("int")
            each = F.explode(F.sequence(F.lit(0), others - 1))
            place = [at.alias("i"), each.alias("j")] if side == 0 else [each.alias("i"), at.alias("j")]
            return counted.where((F.col("component") != F.col("_largest")) | F.lit(side == 1)).select(
                "unit", *place, F.lit(side).alias("side"), "set_hash", "component"
            )

        wanted = counted.select("set_hash").distinct()
        outside, whole = blocks(F.col("_all") - F.col("_most")), blocks(F.col("_all"))
        self.gather(wanted)
        sides = dealt(outside, whole, 0).unionByName(dealt(whole, outside, 1))
        # A set that several tasks met is held several times.
        sets = self.sets.join(wanted, "set_hash", "left_semi").dropDuplicates(["set_hash"])
        found = self.staging.table(_block_links(sides.join(sets, "set_hash"), self.params.similarity))
        if not found.isEmpty():
            self.links = self.links.unionByName(found)
            self.labels = components(self.links, "a", "b", self.staging)

    def run(self) -> DataFrame:
        """(node, component) of the sets linked to another one."""
        def partner(prefix: str) -> DataFrame:
            return self.found.select("signature", *_ENTRY, *(F.col(f"{prefix}{c}").alias(f"_{c}") for c in _ENTRY))

        drawn = partner("o_").where(F.pmod(F.xxhash64("signature"), F.lit(16)) == 0)
        self.verify(self._pairs(partner("c_").unionByName(drawn)))
        rows = self.open_buckets()
        small = rows.where(F.col("members") <= self.params.small_bucket)
        others = small.select("signature", *(F.col(c).alias(f"_{c}") for c in (*_ENTRY, "component")))
        met = small.join(others, "signature").where("set_hash < _set_hash and component <> _component")
        self.verify(self._pairs(met))
        self.verify_families(rows.where(F.col("members") > self.params.small_bucket))
        return self.labels


def _unit_sizes(members: DataFrame) -> DataFrame:
    """Number of sets of each unit, and number and name of its largest component."""
    shares = members.groupBy("unit", "family", "component").agg(F.count(F.lit(1)).alias("n"))
    return shares.groupBy("unit", "family").agg(
        F.sum("n").alias("_all"), F.max("n").alias("_most"),
        F.max_by("component", F.struct("n", "component")).alias("_largest"),
    )


def compared_units(rows: DataFrame, staging: Staging) -> DataFrame:
    """(unit, set_hash, component, _all, _most, _largest): what is to be compared with each other.

    Sets that meet in a bucket, directly or through others, are a family. It is one unit where that
    takes the fewest pairs, since its sets meet in many buckets; where a few buckets only hang
    together by sets they share, each of them is a unit of its own. So no more pairs are compared
    than are in the buckets.
    """
    first = staging.table(rows.groupBy("signature").agg(F.min("set_hash").alias("first")))
    meets = rows.join(first, "signature").select("set_hash", "first").distinct()
    family = components(meets, "set_hash", "first", staging).select(
        F.col("node").alias("set_hash"), F.col("component").alias("family")
    )
    placed = staging.table(
        rows.select("signature", "set_hash", "component").distinct().join(family, "set_hash")
    )

    def members(unit: str) -> DataFrame:
        return placed.select(F.col(unit).alias("unit"), "family", "set_hash", "component").distinct()

    def pairs(unit: str) -> DataFrame:
        number = (F.col("_all") - F.col("_most")).cast("double") * F.col("_all")
        return _unit_sizes(members(unit)).groupBy("family").agg(F.sum(number).alias(f"_by_{unit}"))

    apart = staging.table(
        pairs("family").join(pairs("signature"), "family").where("_by_signature < _by_family").select("family")
    )
    units = staging.table(
        members("family").join(apart, "family", "left_anti")
        .unionByName(members("signature").join(apart, "family", "left_semi"))
    )
    sizes = staging.table(_unit_sizes(units).where("_most < _all"))
    return staging.table(units.join(sizes, ["unit", "family"]).drop("family"))


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of x with all sets of y, some thousand shared tokens
    at a time."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(t) for t in sets])

    (xt, xr), (yt, yr) = flat(x), flat(y)
    shared = np.intersect1d(xt, yt)
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    for at in range(0, len(shared), 4096):
        own = shared[at : at + 4096]

        def incidence(tokens: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
            place = np.minimum(np.searchsorted(own, tokens), len(own) - 1)
            hit = own[place] == tokens
            matrix = np.zeros((n, len(own)), dtype=np.float32)
            matrix[row[hit], place[hit]] = 1
            return matrix

        out += incidence(xt, xr, len(x)) @ incidence(yt, yr, len(y)).T
    return out.astype(np.int64)


def _block_links(sides: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b): for every set of side 0 one link into each component of side 1 that it links with."""
    place = ["unit", "i", "j"]
    laid = sides.repartition(*place).sortWithinPartitions(*place, "side")

    def links(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        side, own, component = (block.column(n).to_numpy() for n in ("side", "set_hash", "component"))
        tokens = [t.values.to_numpy() for t in block.column("tokens")]
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(x) or not len(y):
            return own[:0], own[:0]
        size = np.array([len(t) for t in tokens])
        both = _overlaps([tokens[k] for k in x], [tokens[k] for k in y])
        either = size[x][:, None] + size[y][None, :] - both
        alike = both * similarity.denominator >= either * similarity.numerator
        alike &= component[x][:, None] != component[y][None, :]
        a, b = np.nonzero(alike)
        _, one = np.unique(np.stack([a, component[y][b]]), axis=1, return_index=True)
        return own[x][a[one]], own[y][b[one]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def solved(table: pa.Table, edges: np.ndarray) -> Iterator[pa.RecordBatch]:
            for s, e in zip(edges[:-1], edges[1:]):
                a, b = links(table.slice(s, e - s).combine_chunks())
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            places = [held.column(n).to_numpy() for n in place]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in places], axis=0)) + 1
            # The last block may go on in the next batch.
            yield from solved(held, np.concatenate([[0], changes]))
            if len(changes):
                held = held.slice(changes[-1])
        if held is not None:
            yield from solved(held, np.array([0, held.num_rows]))

    return laid.mapInArrow(run, "a long, b long")


def _with_components(docs: DataFrame, params: NgramJoinParams, staging: Staging) -> DataFrame:
    """Rows of `docs` without their text, with set_hash, n_shingles and component (of sets)."""
    rows = staging.table(documents_with_sets(docs, params.shingle))
    labels = _Join(docs.select("text"), params, staging).run()
    # Equal sets may be a large share of all rows; adaptive execution splits them.
    return rows.join(labels.withColumnRenamed("node", "set_hash"), "set_hash", "left").withColumn(
        "component", F.when(F.col("set_hash") != 0, F.coalesce("component", "set_hash"))
    )


def join_documents(docs: DataFrame, params: NgramJoinParams = NgramJoinParams()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least id reachable by links."""
    staging = Staging(docs.sparkSession)
    rows = staging.table(_with_components(docs.select("doc_id", "text"), params, staging))
    # Written, so that adaptive execution splits the rows of a large group.
    least = staging.table(
        rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("_least"))
    )
    return rows.join(least, "component", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def keep_one_per_group(docs: DataFrame, params: NgramJoinParams = NgramJoinParams()) -> DataFrame:
    """`docs` with one row of each group of linked documents: the one with the least id, null ids
    last. Rows without shingles all stay."""
    staging = Staging(docs.sparkSession)
    keyed = docs.withColumn("_row_key", F.xxhash64("doc_id", "text"))
    rows = staging.table(_with_components(keyed.select("doc_id", "_row_key", "text"), params, staging))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row_key")
    first = rows.where("component is not null").groupBy("component").agg(F.min(place).alias("_first"))
    stays = staging.table(
        first.select(F.col("_first.doc_id").alias("_id"), F.col("_first._row_key").alias("_key"))
    )
    alone = (F.col("_row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    repeated = rows.groupBy("doc_id", "_row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("_row_key").alias("_key")
    ).distinct()
    empty = rows.where("component is null").select(F.col("_row_key").alias("_key")).distinct()
    # Rows alike in id and text are in one group: one of them stays, for which they meet.
    once = stays.join(repeated, "_key", "left_anti")
    several = stays.join(repeated, "_key", "left_semi")
    return (
        keyed.join(once, alone, "left_semi")
        .unionByName(keyed.join(several, alone, "left_semi").dropDuplicates(["doc_id", "_row_key"]))
        .unionByName(keyed.join(empty, F.col("_row_key") == F.col("_key"), "left_semi"))
        .select(*docs.columns)
    )
