"""Near-duplicate line removal by a segment-partition edit join, in DataFrame functions only.

Lines are the newline-separated pieces of a text. Two lines of at least `min_chars` characters are
alike within `distance` edits. A line within tau edits of another holds at least one of the other's
tau + 1 even segments unchanged, near where it lies there: every line indexes its segments under
(length, segment number, content) and probes the few substrings of its own that can match a
segment of a line of the same length or up to tau shorter, with the positions cut from both ends.
Lines that share a key must agree in their counts of letters, up to two per edit, to be a candidate
pair; candidates are verified by edit distance in a band of 2 * tau + 1 diagonals, one bit each.

Of equal lines the first by (doc_id, hash of the text, line number) stays. A line is dropped, too, if
a line alike has its first occurrence earlier. Of shorter lines that hold a word only the first stays
with `short_repeats`; without it, and without a word, they all stay.

Defined cases: a null or empty text has no line that could be dropped. Rows that share a doc_id but
not the text are different documents. Rows that share both are one document, and each of them keeps
its lines, unless the id is null: then every row is a document of its own. Null ids come after all
others. An empty table gives no rows. Lines of equal 64-bit hash and length are equal, and so are
texts of one id with 61 equal bits of hash. Other columns pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.staging import Staging


@dataclass(frozen=True)
class LineDedupParams:
    distance: int = 2
    min_chars: int = 24
    # Whether equal lines of fewer characters are repeats, too. They are never compared by edits.
    short_repeats: bool = False
    # Bits of the filter that thins out lines before their texts are gathered.
    filter_bits: int = 23


WORD = r"[^\x20\x09-\x0D]"

# A document as one number: the id moved above zero, then bits of the hash of its text.
_HASH_BITS = 61


def _whole(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(20,0)")


def _document(doc_id: Column, text: Column) -> Column:
    place = F.coalesce(doc_id.cast("decimal(20,0)") + _whole(1 << 63), _whole(1 << 64))
    return (place * _whole(1 << _HASH_BITS) + F.shiftrightunsigned(F.xxhash64(text), 64 - _HASH_BITS)).cast("decimal(38,0)")


def _line_hash(line: Column) -> Column:
    return F.xxhash64(line, F.char_length(line))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def own_rows(docs: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """`docs` with _document and, where the id is null, a number _row; and (_document, _first_row).

    Rows without an id may have equal texts: the first of them is the one with the least hash of
    its other columns. Rows alike in all columns are told apart by where they were staged.
    """
    numbered = docs.withColumn("_document", _document(F.col("doc_id"), F.col("text")))
    known = numbered.where(F.col("doc_id").isNotNull()).withColumn("_row", F.lit(None).cast("long"))
    unknown = staging.table(
        numbered.where(F.col("doc_id").isNull()).withColumn("_row", F.monotonically_increasing_id())
    )
    hashed = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    first = staging.table(
        unknown.groupBy("_document").agg(F.min_by("_row", F.xxhash64(*hashed)).alias("_first_row"))
    )
    return known.unionByName(unknown), first


def _compared(line: Column, params: LineDedupParams) -> Column:
    long = F.char_length(line) >= params.min_chars
    return long | line.rlike(WORD) if params.short_repeats else long


def compared_lines(rows: DataFrame, params: LineDedupParams) -> DataFrame:
    """(_document, line_no, line, chars, line_hash) of every line that may be a repeat."""
    lines = rows.select("_document", F.posexplode(_split(F.col("text"))).alias("line_no", "line"))
    return lines.where(_compared(F.col("line"), params)).withColumns(
        {"chars": F.char_length("line"), "line_hash": _line_hash(F.col("line"))}
    )


def segment_keys(line: Column, chars: Column, tau: int) -> tuple[list[Column], list[Column]]:
    """Keys of a line's own segments, and of the substrings that may equal another line's."""
    parts = tau + 1

    def segment(length: Column, number: int) -> tuple[Column, Column]:
        """Start (from 1) and size of a segment of a line of that length: the longer ones last."""
        size, extra = F.floor(length / parts), length % parts
        shorter = parts - extra
        start = size * (number - 1) + F.greatest(F.lit(0), F.lit(number - 1) - shorter) + 1
        return start.cast("int"), (size + F.when(F.lit(number) > shorter, 1).otherwise(0)).cast("int")

    def key(length: Column, number: int, start: Column, size: Column) -> Column:
        return F.xxhash64(length, F.lit(number), F.substring(line, start, size))

    own, probes = [], []
    for shorter_by in range(parts):
        length = chars - shorter_by
        for number in range(1, parts + 1):
            start, size = segment(length, number)
            left, right = number - 1, parts - number
            for move in range(max(-left, shorter_by - right), min(left, shorter_by + right) + 1):
                found = key(length, number, start + move, size)
                (own if shorter_by == move == 0 else probes).append(found)
    return own, probes


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once: a lambda's argument is, a repeated expression not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def banded_distance(a: Column, b: Column, tau: int) -> Column:
    """Edit distance of two texts, or tau + 1 where it is larger. `a` is the longer one.

    Column by column of `b`, bit d stands for the diagonal d - tau: whether a cell equals its
    diagonal neighbour follows from the vertical differences and the matches by a few operations
    on the whole band. The distance is what the diagonal of the last cell starts with, plus the
    steps along it that cost one.
    """
    band = (1 << (2 * tau + 1)) - 1

    def inverse(bits: Column) -> Column:
        return bits.bitwiseXOR(F.lit(band))

    def step(state: Column, j: Column, texts: Column) -> Column:
        up, down, cost = state["up"], state["down"], state["cost"]
        matches = F.get(texts["b"], j)
        match = sum(
            (F.when(F.get(texts["a"], j + (d - tau)) == matches, 1 << d).otherwise(0) for d in range(2 * tau + 1)),
            F.lit(0),
        )

        def same_bits(match: Column) -> Column:
            carried = match.bitwiseAND(up) + up
            return carried.bitwiseXOR(up).bitwiseOR(match).bitwiseOR(down).bitwiseAND(F.lit(band))

        def moved(same: Column) -> Column:
            slid = F.shiftright(same, 1)
            return _let(down.bitwiseOR(inverse(same.bitwiseOR(up))), lambda right_up: F.struct(
                same.bitwiseAND(up).bitwiseOR(inverse(slid.bitwiseOR(right_up))).alias("up"),
                slid.bitwiseAND(right_up).alias("down"),
                (cost + F.when(same.bitwiseAND(texts["last"]) == 0, 1).otherwise(0)).alias("cost"),
            ))

        return _let(match, lambda bits: _let(same_bits(bits), moved))

    def walk(texts: Column) -> Column:
        start = F.struct(
            F.lit(band ^ ((1 << tau) - 1)).alias("up"), F.lit(0).alias("down"),
            (F.size(texts["a"]) - F.size(texts["b"])).alias("cost"),
        )
        columns = F.when(F.size(texts["b"]) > 0, F.sequence(F.lit(0), F.size(texts["b"]) - 1))
        walked = F.aggregate(
            F.coalesce(columns, F.array().cast("array<int>")), start,
            lambda state, j: F.when(state["cost"] > tau, state).otherwise(step(state, j, texts)),
        )
        return F.least(walked["cost"], F.lit(tau + 1))

    apart = F.char_length(a) - F.char_length(b)
    texts = F.struct(
        F.split(a, "").alias("a"), F.split(b, "").alias("b"),
        F.pow(F.lit(2), apart + tau).cast("int").alias("last"),
    )
    return F.when(apart > tau, tau + 1).otherwise(_let(texts, walk))


# Letters counted together, the frequent ones of European languages apart.
_LETTER_GROUPS = ("e", "a", "i", "n", "s", "t", "r", "o", "h", "l", "d", "u", "cm", "gpbfwvykzxjq", " ", "0-9")


def letter_counts(line: Column) -> Column:
    """Counts of groups of letters modulo 16, four bits each."""
    packed = F.lit(0).cast("long")
    for i, group in enumerate(_LETTER_GROUPS):
        count = F.regexp_count(line, F.lit(f"[{group}{group.upper() if group.isalpha() else ''}]")).cast("long")
        packed = packed.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(15)), 4 * i))
    return packed


def letters_apart(a: Column, b: Column) -> Column:
    """At least this many counts differ by one: twice the edit distance or less."""
    total = F.lit(0).cast("long")
    for i in range(len(_LETTER_GROUPS)):
        own, other = (F.shiftright(x, 4 * i).bitwiseAND(F.lit(15)) for x in (a, b))
        apart = F.abs(own - other)
        total = total + F.least(apart, 16 - apart)
    return total


def _crowded_keys(classes: DataFrame, own: list[str], probes: list[str]) -> DataFrame:
    """(key, line_hash, own) of the keys that several lines have and at least one as its own."""
    rows = classes.select("line_hash", F.explode(F.array(
        *(F.struct(F.col(c).alias("key"), F.lit(c in own).alias("own")) for c in (*own, *probes))
    )).alias("_entry")).select("line_hash", "_entry.*")
    key = Window.partitionBy("key")
    several = rows.withColumns({
        "_least": F.min("line_hash").over(key), "_most": F.max("line_hash").over(key), "_indexed": F.max("own").over(key),
    }).where("_least <> _most and _indexed")
    return several.groupBy("key", "line_hash").agg(F.max("own").alias("own"))


def _with_texts(lines: DataFrame, wanted: DataFrame, params: LineDedupParams) -> DataFrame:
    """(line_hash, line, first) of the wanted lines, one row each; first is (document, line number).

    The filter has a row for each 64 places at most: its size is fixed, whatever the corpus.
    """
    place = F.shiftrightunsigned("line_hash", 64 - params.filter_bits)
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    marks = (
        wanted.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word"))
        .agg(F.bit_or(bit).alias("_mask"))
    )
    thinned = (
        lines.select("line_hash", "line", "_document", "line_no", place.alias("_place"))
        .withColumn("_word_of", F.shiftright("_place", 6))
        .join(F.broadcast(marks), F.col("_word") == F.col("_word_of"))
        .where(F.col("_mask").bitwiseAND(bit) != 0)
    )
    # Combined before the join, where a common line would bring every occurrence to one task.
    each = thinned.groupBy("line_hash").agg(
        F.min("line").alias("line"), F.min(F.struct("_document", "line_no")).alias("first")
    )
    # An inner join: a semi join would be pushed below the filter and shuffle every line.
    return each.join(wanted, "line_hash")


def line_classes(rows: DataFrame, params: LineDedupParams, staging: Staging) -> DataFrame:
    """Different lines: line_hash, chars, first (document that holds it), keep."""
    lines = compared_lines(rows, params)
    is_long = F.col("chars") >= params.min_chars
    own, probes = segment_keys(F.col("line"), F.col("chars"), params.distance)
    names = [f"_k{i}" for i in range(len(own) + len(probes))]
    # Equal lines have equal keys: any aggregate that fits a hash table will do.
    classes = staging.table(
        lines.select(
            "line_hash", "chars", F.col("_document").alias("first"),
            *(F.when(is_long, k).alias(n) for k, n in zip([*own, *probes], names)),
        ).groupBy("line_hash", "chars").agg(F.min("first").alias("first"), *(F.min(n).alias(n) for n in names))
    )

    crowded = staging.table(_crowded_keys(classes.where(is_long), names[: len(own)], names[len(own) :]))
    wanted = crowded.select("line_hash").distinct()
    texts = staging.table(
        _with_texts(lines.where(is_long), wanted, params).withColumn("letters", letter_counts(F.col("line")))
    )
    # Only lines that share a key get this far: usually few.
    met = staging.table(crowded.join(texts.select("line_hash", "letters"), "line_hash"))
    indexed = met.where("own").select("key", F.col("line_hash").alias("_a"), F.col("letters").alias("_la"))
    probing = met.select("key", F.col("line_hash").alias("_b"), F.col("letters").alias("_lb"))
    near = letters_apart(F.col("_la"), F.col("_lb")) <= 2 * params.distance
    found = indexed.join(probing, "key").where((F.col("_a") != F.col("_b")) & near)
    pairs = staging.table(found.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())

    def side(name: str) -> DataFrame:
        return texts.select(
            F.col("line_hash").alias(name), F.col("line").alias(f"_{name}_line"), F.col("first").alias(f"_{name}_first")
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    a, b = F.col("_a_line"), F.col("_b_line")
    a_longer = F.char_length(a) >= F.char_length(b)
    long_side, short_side = F.when(a_longer, a).otherwise(b), F.when(a_longer, b).otherwise(a)
    distance = banded_distance(F.col("_long"), F.col("_short"), params.distance)
    alike = both.withColumn("_long", long_side).withColumn("_short", short_side).where(distance <= params.distance)
    later = staging.table(alike.select(
        F.when(F.col("_a_first") > F.col("_b_first"), F.col("a")).otherwise(F.col("b")).alias("line_hash")
    ).distinct())
    return classes.select("line_hash", "chars", "first").join(
        later.withColumn("_later", F.lit(True)), "line_hash", "left"
    ).withColumn("keep", F.col("_later").isNull()).drop("_later")


def kept_lines(rows: DataFrame, first: DataFrame, params: LineDedupParams, staging: Staging) -> DataFrame:
    """(_document, _kept, _first_row): the hashes of the compared lines that stay in a document."""
    kept = line_classes(rows, params, staging).where("keep").groupBy(F.col("first").alias("_document")).agg(
        F.collect_list("line_hash").alias("_kept")
    )
    return staging.table(kept.join(first, "_document", "left"))


def _hashes(params: LineDedupParams) -> Column:
    """Of the lines of a text in order, null for one that stays in any case."""
    return F.transform(_split(F.col("text")), lambda line: F.when(_compared(line, params), _line_hash(line)))


def _with_kept(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """Of rows without an id that have equal texts only the first keeps lines."""
    none = F.array().cast("array<bigint>")
    again = F.coalesce(F.col("_row") != F.col("_first_row"), F.lit(False))
    return rows.join(kept, "_document", "left").withColumn(
        "_kept", F.when(again, none).otherwise(F.coalesce("_kept", none))
    )


def _stays(hashes: Column, number: Column) -> Column:
    """A line without a hash stays, and a kept one where it stands first in its document."""
    own = F.get(hashes, number)
    return own.isNull() | (F.array_contains("_kept", own) & (F.array_position(hashes, own) == number + 1))


def dedup_lines(docs: DataFrame, params: LineDedupParams = LineDedupParams()) -> DataFrame:
    """`docs` with the lines that stay; documents that lose all their words go."""
    staging = Staging(docs.sparkSession)
    rows, first = own_rows(docs, staging)
    lines = _split(F.col("text"))
    left = _let(_hashes(params), lambda hashes: F.filter(lines, lambda line, i: _stays(hashes, i)))
    joined = _with_kept(rows, kept_lines(rows, first, params, staging))
    cut = joined.withColumn("_left", left).withColumn("_lost", F.size(lines) - F.size("_left"))
    text = F.when(F.col("_lost") > 0, F.array_join("_left", "\n")).otherwise(F.col("text"))
    emptied = (F.col("_lost") > 0) & ~F.coalesce(F.rlike(F.col("_text"), F.lit(WORD)), F.lit(False))
    return cut.withColumn("_text", text).where(F.col("text").isNull() | ~emptied).select(
        *(F.col("_text").alias("text") if c == "text" else F.col(c) for c in docs.columns)
    )


def dedup_report(docs: DataFrame, params: LineDedupParams = LineDedupParams()) -> DataFrame:
    """doc_id, n_lines, n_dropped and the numbers of the dropped lines, per document."""
    staging = Staging(docs.sparkSession)
    rows, first = own_rows(docs.select("doc_id", "text"), staging)
    kept = kept_lines(rows, first, params, staging)
    hashed = rows.withColumn("_hashes", F.coalesce(_hashes(params), F.array().cast("array<bigint>")))
    numbered = F.transform("_hashes", lambda own, i: F.when(~_stays(F.col("_hashes"), i), i))
    return _with_kept(hashed.drop("text"), kept).withColumn("dropped_lines", F.array_compact(numbered)).select(
        "doc_id", F.size("_hashes").cast("long").alias("n_lines"),
        F.size("dropped_lines").cast("long").alias("n_dropped"), "dropped_lines",
    )
