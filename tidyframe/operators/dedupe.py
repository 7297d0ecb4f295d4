"""De-duplication by key with a deterministic survivor, and its report.

Both strategies reduce each key *before* the shuffle, so a key that holds a
third of the table never reaches one reducer whole:

* ``window``    ``row_number() over (partition by key order by ...) = 1``;
  Catalyst plans a partial ``WindowGroupLimit`` on the map side.
* ``aggregate`` ``groupBy(key).agg(max_by(struct(row), struct(order)))``; a
  partial aggregate on the map side.  Any mix of directions and NULL
  placements works: keys sorted against the first key's direction are turned
  round (numbers, dates and times negated exactly, NaN handled; text, binary and
  booleans encoded so that the byte order is reversed), except nested values.
  It can also carry each key's row count
  (``count_col``), which lets a later observation report how many rows the
  dedupe removed without a second pass over the input.

Ties in the order are broken by the remaining columns, compared in the
direction of the first sort key (ascending when there is none), so reruns keep
the same row whatever the input file order, and both strategies agree.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from tidyframe.errors import SpecError, require_columns
from tidyframe.functions._util import col, own_name, pct, type_of

STRATEGIES = ("auto", "window", "aggregate", "any")
KEY_HASH = "__keep_key_hash"


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool = False
    # None = Spark's default (NULLs first ascending, last descending)
    nulls_first: bool | None = None

    @classmethod
    def parse(cls, text: str) -> SortKey:
        """``"o_orderdate desc"``, ``"-o_orderdate"``, ``"o_orderdate"``,
        optionally followed by ``nulls first`` / ``nulls last``."""
        t = text.strip()
        nulls = None
        m = re.search(r"\s+nulls\s+(first|last)\s*$", t, re.IGNORECASE)
        if m:
            nulls = m.group(1).lower() == "first"
            t = t[: m.start()].rstrip()
        if t.startswith("-"):
            return cls(t[1:].strip(), True, nulls)
        parts = t.rsplit(None, 1)
        if len(parts) == 2 and parts[1].lower() in ("asc", "desc"):
            return cls(parts[0], parts[1].lower() == "desc", nulls)
        return cls(t, False, nulls)

    @property
    def default_nulls(self) -> bool:
        return self.nulls_first is None or self.nulls_first == (not self.descending)

    def sort_col(self) -> Column:
        c = col(self.column)
        if self.descending:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_last() if self.nulls_first is False else c.asc_nulls_first()


def _orderable(dtype) -> bool:
    if isinstance(dtype, (MapType, VariantType)):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _parse_order(order_by: Sequence[str | SortKey] | None) -> list[SortKey]:
    return [o if isinstance(o, SortKey) else SortKey.parse(o) for o in (order_by or [])]


def keep_one(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | SortKey] | None = None,
    strategy: str = "auto",
    count_col: str | None = None,
) -> DataFrame:
    """One row per distinct ``keys`` (NULL keys form one group).

    ``order_by``: the first row in this order survives, e.g.
    ``["updated_at desc"]`` keeps the latest.  Without an order the survivor is
    still deterministic (smallest row by the other columns) unless
    ``strategy="any"`` asks for Spark's ``dropDuplicates`` (arbitrary survivor,
    cheapest).  ``count_col`` adds the number of input rows of each key
    (aggregate strategy only).
    """
    keys = list(keys)
    if not keys:
        raise SpecError("keep_one needs at least one key column")
    if strategy not in STRATEGIES:
        raise SpecError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    order = _parse_order(order_by)
    require_columns(df, keys + [o.column for o in order])
    keys = [own_name(df, k) for k in keys]  # as the frame spells them
    order = [replace(o, column=own_name(df, o.column)) for o in order]

    if strategy == "any":
        if order or count_col:
            raise SpecError("strategy='any' takes no order_by / count_col")
        return df.dropDuplicates(keys)

    # Long text keys: group by (xxhash64(keys), keys).  The groups are the same
    # (the hash is a function of the keys) but the map-side sort then orders by
    # a well-spread 64-bit prefix and compares whole strings only for true
    # duplicates, instead of texts that share their first bytes.
    hashed = any(isinstance(df.schema[k].dataType, (StringType, BinaryType)) for k in keys)
    if hashed:
        df = df.withColumn(KEY_HASH, F.xxhash64(*[col(k) for k in keys]))
        keys = [KEY_HASH] + keys

    if strategy == "auto":
        strategy = "aggregate" if count_col else "window"
    if strategy == "window":
        if count_col:
            raise SpecError("count_col needs strategy='aggregate'")
        out = _keep_by_window(df, keys, order)
    elif not aggregatable(df, order):
        raise SpecError("strategy='aggregate' cannot order nested or collated keys against the first "
                        "key's direction; use strategy='window'")
    else:
        out = _keep_by_aggregate(df, keys, order, count_col)
    return out.drop(KEY_HASH) if hashed else out


def _tie_breakers(df: DataFrame, used: set[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in used and _orderable(f.dataType)
    ]


def _keep_by_window(df: DataFrame, keys: list[str], order: list[SortKey]) -> DataFrame:
    used = set(keys) | {o.column for o in order}
    desc = bool(order) and order[0].descending
    sort = [o.sort_col() for o in order] + [
        col(c).desc() if desc else col(c).asc() for c in _tie_breakers(df, used)
    ]
    if not sort:  # only key columns: plain distinct
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*sort)
    rn = "__keep_rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


_NEGATABLE = (ByteType, ShortType, IntegerType, LongType, DecimalType, FloatType, DoubleType,
              DateType, TimestampType, TimestampNTZType, BinaryType, BooleanType)


def aggregatable(df: DataFrame, order: Sequence[SortKey]) -> bool:
    """Can ``max_by`` / ``min_by`` express this order?  Keys sorted against the
    first key's direction must have an inverted form: all but nested values and
    text under a collation, whose order is not that of its bytes."""
    if not order:
        return True
    first = order[0].descending
    return all(o.descending == first or _invertible(type_of(df, o.column)) for o in order)


def _invertible(dtype) -> bool:
    return isinstance(dtype, _NEGATABLE) or dtype == StringType()


def _turned_round(c: Column) -> Column:
    """Text or bytes whose order is the reverse: hex digits complemented, and an end mark
    above every digit, so that a value sorts after those it is the beginning of."""
    return F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def _negated(c: Column, dtype) -> Column:
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return -c.cast("decimal(38,0)")  # no overflow at the type's minimum
    if isinstance(dtype, (StringType, BinaryType)):
        return _turned_round(c)
    if isinstance(dtype, BooleanType):
        return ~c
    if isinstance(dtype, DateType):
        return -F.unix_date(c)
    if isinstance(dtype, TimestampType):
        return -F.unix_micros(c)
    if isinstance(dtype, TimestampNTZType):  # exact, no time zone involved
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return -F.timestamp_diff("MICROSECOND", epoch, c)
    return -c  # float, double, decimal


def _rank_fields(df: DataFrame, order: list[SortKey], descending: bool) -> list[Column]:
    """Struct fields whose natural order (the aggregate takes the largest when
    ``descending``, else the smallest) is the requested order, NULL placement
    and NaN included."""
    fields = []
    for o in order:
        c, dtype = col(o.column), df.schema[o.column].dataType
        nulls_first = (not o.descending) if o.nulls_first is None else o.nulls_first
        # True sorts after False: under max it wins, under min it loses
        fields.append(c.isNull() if nulls_first == descending else c.isNotNull())
        if o.descending == descending:
            fields.append(c)  # Spark's own order, NaN above every number
        else:
            if isinstance(dtype, (FloatType, DoubleType)):
                fields.append(~F.isnan(c))  # NaN moves to the other end too
            fields.append(_negated(c, dtype))
    return fields


def _keep_by_aggregate(
    df: DataFrame, keys: list[str], order: list[SortKey], count_col: str | None
) -> DataFrame:
    used = set(keys) | {o.column for o in order}
    payload = [c for c in df.columns if c not in keys]
    descending = bool(order) and order[0].descending
    ties = _tie_breakers(df, used)
    rank = [r.alias(f"__r{i}") for i, r in enumerate(_rank_fields(df, order, descending))]
    aggs = []
    if payload:
        # one struct is both rank and row, so a row crosses the shuffle once;
        # only columns without an order travel beside it
        beside = [c for c in payload if c not in ties]
        if all(_orderable(df.schema[c].dataType) for c in beside):
            row = F.struct(*rank, *[col(c) for c in ties + beside])
            pick = F.max(row) if descending else F.min(row)
        elif rank or ties:
            row = F.struct(*[col(c) for c in payload])
            by = F.struct(*rank, *[col(c) for c in ties])
            pick = F.max_by(row, by) if descending else F.min_by(row, by)
        else:
            pick = F.first(F.struct(*[col(c) for c in payload]))
        aggs.append(pick.alias("__keep_row"))
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    if not aggs:
        return df.dropDuplicates(keys)
    out = df.groupBy(*[col(k) for k in keys]).agg(*aggs)
    cols = [col(k) for k in keys]
    cols += [F.col("__keep_row").getField(c).alias(c) for c in payload]
    if count_col:
        cols.append(col(count_col))
    ordered = list(df.columns) + ([count_col] if count_col else [])
    return out.select(*cols).select(*[col(c) for c in ordered])


def dedupe_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, distinct keys (= rows after), removed, % removed.

    NULL keys count as one group, exactly like ``keep_one``.  One shuffle; each
    map task pre-counts its keys, so a hot key costs one row per task.
    """
    keys = list(keys)
    require_columns(df, keys)
    per_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).cast("bigint").alias("rows_after"),
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        pct(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")).alias(
            "pct_removed"
        ),
    )

