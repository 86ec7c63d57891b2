"""Exact medians of many columns without ever gathering a column's values in one place.

Each value becomes an integer (its count of smallest units, or a double's place in the order of
all doubles), and the two middle ranks are located in ever finer buckets: a histogram over all
values finds the bucket that holds a rank, the next histogram looks inside that bucket only, and
so on down to the unit. A histogram has a few million rows per column at most, whatever the
number of input rows, and is counted map-side, so values repeated very often or columns that are
all distinct (ids) cost the same. One task orders a column's buckets, and takes the totals from the
same shuffle, so that rows are counted once for each histogram and the histogram is read once.

Buckets are single units near zero, so ages, months and everyday amounts are settled by the first
histogram; adaptive execution then drops the later passes. Otherwise integers and decimals of up
to ten digits take a second pass, and wider types may take a third, which reads those types only.

Decimals of 19 to 38 digits are placed by the doubles next to them, and their buckets carry their
least and greatest value: a pass looks inside the one open bucket of a column, cut into a million
equal parts of its own range, whatever digits the values share. Ranks that fall into two buckets,
or on the ends of one, are settled at once. The few rows that a pass finds are looked up before
the next one, which computes and reads the open columns only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal, localcontext
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import case_rules, double_of_rank, double_to_rank, rank_to_double

_NARROW_TYPES = (T.ByteType, T.ShortType, T.IntegerType)

# Up to these sizes the first and the second histogram count single units.
_FIRST_EXACT = 1 << 20
_SECOND_EXACT = 1 << 38


def _scale(dtype: T.DataType) -> int:
    return dtype.scale if isinstance(dtype, T.DecimalType) else 0


def _is_narrow(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.DecimalType):
        return dtype.precision <= 10
    return isinstance(dtype, _NARROW_TYPES)


def _is_wide(dtype: T.DataType) -> bool:
    """Whether a value counts more units than a BIGINT holds."""
    return isinstance(dtype, T.DecimalType) and dtype.precision > 18


def _units(name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType):
        return (F.col(name) * F.lit(10 ** dtype.scale)).cast("bigint")
    if isinstance(dtype, T.IntegralType):
        return F.col(name).cast("bigint")
    return double_to_rank(F.col(name).cast("double"))


def _within(units: Column, size: int) -> Column:
    return units.between(-size, size - 1)


def _bucket(units: Column, level: int) -> Column:
    """Start of the bucket of a value: ascending with the value, each level refining the last."""
    def floor(bits: int) -> Column:
        return F.shiftleft(F.shiftright(units, bits), bits)

    if level == 0:
        # The widest buckets would start at 0 for values that lie above the finer ones.
        wide = F.when(units > 0, F.greatest(floor(42), F.lit(_SECOND_EXACT))).otherwise(floor(42))
        return (
            F.when(_within(units, _FIRST_EXACT), units)
            .when(_within(units, _SECOND_EXACT), floor(18)).otherwise(wide)
        )
    if level == 1:
        return F.when(_within(units, _SECOND_EXACT), units).otherwise(floor(21))
    return units


def _is_exact(start: Column, level: int) -> Column:
    """Whether the bucket is a single unit."""
    return _within(start, (_FIRST_EXACT, _SECOND_EXACT)[level])


def _histogram(rows: DataFrame, start: Column, *sought: str) -> DataFrame:
    """(column_id, *sought, start, n): values per bucket, counted map-side."""
    return rows.groupBy("column_id", *sought, start.alias("start")).agg(F.count(F.lit(1)).alias("n"))


def _holding(counted: DataFrame, *within: str, kept: Sequence[str] = ()) -> DataFrame:
    """The buckets in which the ranks `lower` and `upper` fall: (column_id, start, lower, upper,
    *kept).

    At most two rows per column remain, each with the ranks that are left to find inside its
    bucket, NULL if there is none. A task orders the buckets of one column, a number that the type
    bounds and the rows do not.
    """
    upwards = Window.partitionBy("column_id", *within).orderBy("start")
    upto = F.sum("n").over(upwards.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def left(rank: str) -> Column:
        reached = F.col(rank) - (F.col("upto") - F.col("n"))
        return F.when(reached.between(1, F.col("n")), reached).alias(rank)

    found = counted.withColumn("upto", upto).select("column_id", "start", left("lower"), left("upper"), *kept)
    return found.where(F.col("lower").isNotNull() | F.col("upper").isNotNull())


def _middle(
    histogram: DataFrame, only_incomplete: bool, kept: Sequence[str] = ()
) -> DataFrame:
    """The buckets of the middle ranks of each column. Totals come from the shuffle that orders
    the buckets, so the histogram is read once."""
    whole = Window.partitionBy("column_id")
    present = F.col("start").isNotNull()
    counted = histogram.select(
        "column_id", "start", "n", F.sum(F.when(present, F.col("n"))).over(whole).alias("present"),
        F.sum(F.when(present, 0).otherwise(F.col("n"))).over(whole).alias("missing"),
        *[c for c in kept if c != "n"],
    ).where(present)
    if only_incomplete:
        counted = counted.where(F.col("missing") > 0)
    return _holding(counted.withColumns({
        "lower": F.expr("(present + 1) div 2"), "upper": F.expr("present div 2 + 1"),
    }), kept=kept)


def _named_units(located: DataFrame, columns: Sequence[str]) -> DataFrame:
    def unit(rank: str) -> Column:
        return F.max(F.when(F.col(rank).isNotNull(), F.col("start"))).cast(_ANY).alias(rank)

    names = F.array(*map(F.lit, columns))
    return (
        located.groupBy("column_id").agg(unit("lower"), unit("upper"))
        .select(names[F.col("column_id")].alias("column_name"), "lower", "upper")
    )


def _stacked(df: DataFrame, units: Mapping[int, Column]) -> DataFrame:
    """(column_id, units): one row for each value. A number, not the name, tells columns apart:
    cheaper to hash for every value."""
    named = df.select(*[u.alias(f"_u{i}") for i, u in units.items()])
    pairs = [x for i in units for x in (F.lit(i), F.col(f"_u{i}"))]
    return named.select(F.stack(F.lit(len(units)), *pairs).alias("column_id", "units"))


def narrow_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The first histogram of columns that count units in a BIGINT: (column_id, start, n)."""
    types = {f.name: f.dataType for f in df.schema}
    stacked = _stacked(df, {i: _units(c, types[c]) for i, c in enumerate(columns)})
    return _histogram(stacked, _bucket(F.col("units"), 0))


def _middle_narrow(df: DataFrame, columns: Sequence[str], only_incomplete: bool) -> DataFrame:
    located = _middle(narrow_histogram(df, columns), only_incomplete)
    return _named_units(_descend(df, columns, located), columns)


def _descend(df: DataFrame, columns: Sequence[str], located: DataFrame) -> DataFrame:
    """The units of the middle ranks, from the first histogram's buckets that hold them."""
    types = {f.name: f.dataType for f in df.schema}
    units = {i: _units(c, types[c]) for i, c in enumerate(columns)}
    # Only types that can need the third histogram are read for it.
    deep = {i: u for i, u in units.items() if not _is_narrow(types[columns[i]])}

    def place(start: Column, level: int) -> Column:
        # Column and bucket as one number, the quickest join key. Single units share numbers,
        # but only with each other and never with a wider bucket, the only ones sought.
        return F.shiftright(start, (18, 21)[level]) * len(columns) + F.col("column_id")

    long = _stacked(df, units)
    for level in range(1, 3 if deep else 2):
        settled = _is_exact(F.col("start"), level - 1)
        # Two buckets per column at most, so the broadcast side has 2 * len(columns) rows.
        sought = located.where(~settled).select(
            place(F.col("start"), level - 1).alias("place"), "lower", "upper"
        )
        rows = long if level == 1 else _stacked(df, deep)
        held = rows.withColumn("place", place(_bucket(F.col("units"), level - 1), level - 1)).join(
            F.broadcast(sought), "place"
        )
        inside = _histogram(held, _bucket(F.col("units"), level), "lower", "upper")
        located = located.where(settled).unionByName(_holding(inside, "lower", "upper"))
    return located


_ANY = "decimal(38,0)"

# Doubles in a first bucket of wide decimals, 8,192 buckets per power of two, and later buckets.
_WIDE_FIRST_BITS = 39
_WIDE_PARTS = 1 << 20
_WIDE_KEPT = ("n", "least", "most")


def _wide_units(value: Column, scale: int) -> Column:
    """Count of smallest units; whole part and fraction apart, as their product has 38 digits."""
    # A remainder is exact; floor() would round to 34 digits.
    if not scale:
        return value.cast(_ANY)
    rest = value % F.lit(Decimal(1))
    ten = F.lit(Decimal(10) ** scale)
    return ((value - rest).cast(_ANY) * ten.cast(_ANY)).cast(_ANY) + (rest * ten).cast(_ANY)


def _wide_part(name: str, scale: int, least: Decimal, most: Decimal) -> Column:
    """Which equal part of the range from `least` to `most` holds the value; NULL outside it.

    Ascending with the value, as is each step: the exact distance, its double and the quotient.
    """
    dtype = T.DecimalType(38, scale)
    low, high = (F.lit(x).cast(dtype) for x in (least, most))
    with localcontext() as exact:
        exact.prec = 80
        width = most - least
        if scale > 6:
            # A difference in the type itself would be rounded.
            away = _wide_units(F.col(name), scale) - _wide_units(low, scale)
            width = width.scaleb(scale)
        else:
            away = F.col(name) - low
        part = F.floor(away.cast("double") / F.lit(float(width)) * F.lit(float(_WIDE_PARTS)))
    return F.when(F.col(name).between(low, high), part)


def _wide_histogram(values: DataFrame, parts: Mapping[int, Column]) -> DataFrame:
    """(column_id, start, n, least, most) of the columns _u0, _u1, ..., counted map-side."""
    placed = values.select(
        *[F.col(f"_u{i}") for i in parts], *[part.alias(f"_p{i}") for i, part in parts.items()]
    )
    stacked = placed.select(F.stack(
        F.lit(len(parts)), *[x for i in parts for x in (F.lit(i), F.col(f"_p{i}"), F.col(f"_u{i}"))]
    ).alias("column_id", "start", "units"))
    return stacked.groupBy("column_id", "start").agg(
        F.count(F.lit(1)).alias("n"), F.min("units").alias("least"), F.max("units").alias("most")
    )


def _wide_value(rank: int, n: int, least: Decimal, most: Decimal) -> Decimal | None:
    """The value of a rank in a bucket, if the ends of the bucket tell it."""
    return least if rank == 1 or least == most else most if rank == n else None


def _middle_wide(df: DataFrame, columns: Sequence[str], only_incomplete: bool) -> DataFrame:
    """The same for decimals of up to 38 digits and of one scale. A bucket's range shrinks to a
    millionth with each pass, so seven passes settle any values, and two or three most."""
    types = {f.name: f.dataType for f in df.schema}
    scale = types[columns[0]].scale
    dtype = T.DecimalType(38, scale)
    values = df.select(*[F.col(c).cast(dtype).alias(f"_u{i}") for i, c in enumerate(columns)])
    settled: list[tuple] = []
    first = {
        i: F.shiftright(double_to_rank(F.col(f"_u{i}").cast("double")), _WIDE_FIRST_BITS)
        for i in range(len(columns))
    }
    located = _middle(_wide_histogram(values, first), only_incomplete, _WIDE_KEPT)
    while True:
        # Two rows per column at most.
        found: dict[int, list] = {}
        for row in located.collect():
            found.setdefault(row["column_id"], []).append(row)
        still_open = {}
        for i, rows in found.items():
            lower, upper = (
                next(_wide_value(r[rank], *(r[k] for k in _WIDE_KEPT)) for r in rows if r[rank] is not None)
                for rank in ("lower", "upper")
            )
            if lower is None or upper is None:
                # Adjacent ranks in two buckets are the ends of these, so this one holds both.
                still_open[i] = rows[0]
            else:
                settled.append((i, lower, upper))
        if not still_open:
            break
        parts = {
            i: _wide_part(f"_u{i}", scale, row["least"], row["most"]) for i, row in still_open.items()
        }
        inside = _wide_histogram(values, parts).where(F.col("start").isNotNull())

        def sought(rank: str) -> Column:
            ranks = [still_open[i][rank] if i in still_open else None for i in range(len(columns))]
            return F.array(*[F.lit(r).cast("bigint") for r in ranks])[F.col("column_id")]

        located = _holding(
            inside.withColumns({"lower": sought("lower"), "upper": sought("upper")}), kept=_WIDE_KEPT
        )
    schema = T.StructType([
        T.StructField("column_name", T.StringType()),
        T.StructField("lower", dtype), T.StructField("upper", dtype),
    ])
    middle = df.sparkSession.createDataFrame([(columns[i], *ends) for i, *ends in settled], schema)
    return middle.select(
        "column_name", *[_wide_units(F.col(x), scale).cast(_ANY).alias(x) for x in ("lower", "upper")]
    )


def middle_units(
    df: DataFrame, columns: Sequence[str], only_incomplete: bool = False
) -> DataFrame:
    """(column_name, lower, upper): units of the two middle values of each column.

    Columns without any value give no row; with `only_incomplete` neither do columns without
    NULLs, for which the later passes then read nothing.
    """
    types = {f.name: f.dataType for f in df.schema}
    narrow = [c for c in columns if not _is_wide(types[c])]
    # A pass compares values of one type.
    wide = {s: [c for c in columns if _is_wide(types[c]) and _scale(types[c]) == s] for s in range(39)}
    parts = [_middle_narrow(df, narrow, only_incomplete)] if narrow else []
    parts += [_middle_wide(df, own, only_incomplete) for own in wide.values() if own]
    return reduce(DataFrame.unionByName, parts)


def _exact_midpoint(dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (_double(F.col("lower")) + _double(F.col("upper"))) / 2
    if _is_wide(dtype):
        # Both halves of the sum, which may have 39 digits.
        halves = F.col("lower").cast("double") / 2.0 + F.col("upper").cast("double") / 2.0
        return halves / F.lit(10.0 ** _scale(dtype))
    total = F.col("lower").cast("decimal(20,0)") + F.col("upper").cast("decimal(20,0)")
    return total.cast("double") / 2.0 / 10.0 ** _scale(dtype)


def _double(rank: Column) -> Column:
    return rank_to_double(rank.cast("bigint"))


def _midpoint_in_type(dtype: T.DataType) -> Column:
    """Half up, in units. Fails for middle values of 37 digits or more, rather than round them."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return _exact_midpoint(dtype).cast(dtype)
    apart = (F.col("upper") - F.col("lower")).cast(_ANY)
    odd = apart % F.lit(Decimal(2))
    low = (F.col("lower") + ((apart - odd) * F.lit(Decimal("0.5"))).cast(_ANY)).cast(_ANY)
    up = F.when((odd == 1) & (low >= 0), 1).otherwise(0)
    units = (low + up).cast(_ANY)
    scale = _scale(dtype)
    if not scale:
        return units.cast(dtype)
    if not _is_wide(dtype):
        return (units.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(dtype)
    if scale <= 6:
        return (units * F.lit(Decimal(1).scaleb(-scale))).cast(dtype)
    ten = F.lit(Decimal(10) ** scale).cast(_ANY)
    rest = (units % ten).cast(_ANY)
    whole = ((units - rest) / ten).cast(T.DecimalType(38 - scale, 0)).cast(dtype)
    return F.concat(
        F.when((units < 0) & (whole == 0), "-").otherwise(""), whole.cast(T.DecimalType(38 - scale, 0)).cast("string"),
        F.lit("."), F.lpad(F.abs(rest).cast("string"), scale, "0"),
    ).cast(dtype)


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, median double): the midpoint of the two middle values, NULLs skipped."""
    return _midpoints(middle_units(df, columns), df, columns)


def medians_of_histogram(df: DataFrame, columns: Sequence[str], histogram: DataFrame) -> DataFrame:
    """`column_medians` of columns whose first histogram is at hand (see `narrow_histogram`).

    The buckets that hold the middle ranks, two per column at most, are looked up at once. Of `df`
    only the columns that they do not settle are read, with range filters on their values.
    """
    located = [tuple(r) for r in _middle(histogram, False).select("column_id", "start", "lower", "upper").collect()]
    open_ids = sorted({r[0] for r in located if not -_FIRST_EXACT <= r[1] < _FIRST_EXACT})
    types = {f.name: f.dataType for f in df.schema}
    schema = "column_id int, start bigint, lower bigint, upper bigint"
    spark = df.sparkSession
    settled = spark.createDataFrame([r for r in located if r[0] not in open_ids], schema)
    found = _named_units(settled, columns)
    if open_ids:
        names = [columns[i] for i in open_ids]
        near = reduce(or_, [_near(columns[i], types[columns[i]], start) for i, start, *_ in located if i in open_ids])
        sought = spark.createDataFrame([(open_ids.index(i), *rest) for i, *rest in located if i in open_ids], schema)
        found = found.unionByName(_named_units(_descend(df.select(*names).where(near), names, sought), names))
    return _midpoints(found, df, columns)


def _near(name: str, dtype: T.DataType, start: int) -> Column:
    """A filter that keeps all values of a first bucket, and for most types few others."""
    width = 1 if -_FIRST_EXACT <= start < _FIRST_EXACT else 1 << 18 if -_SECOND_EXACT <= start < _SECOND_EXACT else 1 << 42
    least, most = start, start + width - 1
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # Beyond the finite numbers there is nothing to compare with.
        low, high = double_of_rank(least), double_of_rank(most)
        if not (math.isfinite(low) and math.isfinite(high)):
            return F.col(name).isNotNull()
        if isinstance(dtype, T.FloatType):
            return F.col(name).cast("double").between(low, high)
        return F.col(name).between(low, high)
    if isinstance(dtype, T.DecimalType):
        bound = 10**dtype.precision - 1
        low, high = (Decimal(max(-bound, min(bound, x))).scaleb(-dtype.scale) for x in (least, most))
        return F.col(name).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype))
    bits = 8 * {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4}.get(type(dtype), 8) - 1
    low, high = max(-(1 << bits), least), min((1 << bits) - 1, most)
    return F.col(name).between(F.lit(low).cast(dtype), F.lit(high).cast(dtype))


def counts_in_bigint(dtype: T.DataType) -> bool:
    """Whether `narrow_histogram` takes columns of this type."""
    return isinstance(dtype, T.NumericType) and not _is_wide(dtype)


def _midpoints(middle: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema}
    midpoint = case_rules(
        [(F.col("column_name") == c, _exact_midpoint(types[c])) for c in columns], None
    )
    return middle.select("column_name", midpoint.alias("median"))


def median_row(
    df: DataFrame, columns: Sequence[str], only_incomplete: bool = False, approx: bool = False
) -> DataFrame:
    """One row with each column's median, half-up in the column's own type."""
    types = {f.name: f.dataType for f in df.schema}
    if approx:
        medians = [F.percentile_approx(c, F.lit(0.5), F.lit(10_000)) for c in columns]
        return df.agg(*[m.cast(types[c]).alias(c) for m, c in zip(medians, columns)])

    def value(name: str) -> Column:
        matching = F.when(F.col("column_name") == name, _midpoint_in_type(types[name]))
        return F.max(matching).alias(name)

    return middle_units(df, columns, only_incomplete).agg(*map(value, columns))
