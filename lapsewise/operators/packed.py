"""Several columns packed into one number that sorts as they do.

``min`` and ``max`` of a struct or a string need a sort aggregate: their
buffers have no fixed width.  A packed row is a ``bigint``, so its ``min`` or
``max`` is a hash aggregate, and the row is read back from it.  Nulls sort
first, as they do in a struct.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import EXACT

#: Distinct strings that a column is coded for at most; a column with more is not packed.
DICTIONARY = 64
_LONG = 1 << 63
_DAY, _SECOND = 86_400_000_000, 1_000_000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EPOCH = "1970-01-01 00:00:00"


def _units(c: Column, dtype: T.DataType) -> Column | None:
    """The value as a long that sorts alike, or None for a type without one."""
    if isinstance(dtype, _WHOLE):
        return c.cast("long")
    if isinstance(dtype, T.BooleanType):
        return c.cast("int").cast("long")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):  # by its own clock, whatever zone the session has
        minutes = F.hour(c).cast("long") * 60 + F.minute(c)
        seconds = (F.extract(F.lit("SECOND"), c) * _SECOND).cast("long")
        return F.unix_date(c.cast("date")).cast("long") * F.lit(_DAY) + minutes * (60 * _SECOND) + seconds
    if isinstance(dtype, T.DecimalType) and dtype.precision <= 18:
        return (c * F.lit(Decimal(10**dtype.scale))).cast("long")
    return None


def _value(units: Column, dtype: T.DataType) -> Column:
    """What ``_units`` was taken from."""
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(units.cast("int"))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(units)
    if isinstance(dtype, T.TimestampNTZType):
        day = F.floor(units.cast(EXACT) / F.lit(Decimal(_DAY)))
        rest = ((units - day.cast("long") * F.lit(_DAY)).cast("decimal(18,0)") / F.lit(Decimal(_SECOND))).cast("decimal(18,6)")
        return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"), F.lit(0), F.lit(0), rest)
    if isinstance(dtype, T.DecimalType):
        return (units.cast(EXACT) / F.lit(Decimal(10**dtype.scale))).cast(dtype)
    return units.cast(dtype)


@dataclass(frozen=True)
class _Digit:
    """A column as a digit: its steps above ``low``, or its place in the sorted
    ``words``, after ``nulls``, which is 1 where null (0) needs a digit of its own."""

    name: str
    dtype: T.DataType
    radix: int
    nulls: int
    low: int = 0
    step: int = 1
    words: tuple[str, ...] | None = None

    def of(self) -> Column:
        c = F.col(self.name)
        if self.radix == 1:
            return F.lit(0).cast("long")
        if self.words is not None:
            digit = F.array_position(F.array(*[F.lit(w) for w in self.words]), c) - F.lit(1 - self.nulls)
        else:
            above = _units(c, self.dtype) - F.lit(self.low)
            digit = (above if self.step == 1 else F.call_function("div", above, F.lit(self.step))) + F.lit(self.nulls)
        return F.coalesce(digit.cast("long"), F.lit(0).cast("long")) if self.nulls else digit.cast("long")

    def read(self, digit: Column) -> Column:
        if self.radix == self.nulls:
            return F.lit(None).cast(self.dtype)
        place = digit - F.lit(self.nulls)
        if self.words is not None:
            value = F.get(F.array(*[F.lit(w) for w in self.words]), place.cast("int"))
        else:
            value = _value(place * F.lit(self.step) + F.lit(self.low), self.dtype)
        return (F.when(digit > 0, value) if self.nulls else value).cast(self.dtype)


def _product(digits: Sequence[_Digit]) -> int:
    out = 1
    for d in digits:
        out *= d.radix
    return out


class Packing:
    """Columns in order of weight, packed by ``pack`` and read back by ``unpack``."""

    def __init__(self, digits: Sequence[_Digit]):
        self.digits = list(digits)

    def pack(self) -> Column:
        out = self.digits[0].of()
        for d in self.digits[1:]:
            out = out * F.lit(d.radix).cast("long") + d.of()
        return out

    def unpack(self, packed: Column) -> dict[str, Column]:
        out, below = {}, _product(self.digits)
        for d in self.digits:
            below //= d.radix
            out[d.name] = d.read(F.call_function("div", packed, F.lit(below).cast("long")) % F.lit(d.radix).cast("long"))
        return out


def fit(df: DataFrame, cols: Sequence[str]) -> Packing | None:
    """A packing of ``cols`` for the rows of ``df``, which may hold more rows
    than are packed; None if a type has no whole-number form, a string column
    more than ``DICTIONARY`` values, or all digits together more than a long holds.

    One aggregate that combines map-side reads the range of every column, and
    another the distinct strings of each string column; timestamps on whole
    days or seconds count in those.
    """
    types = {f.name: f.dataType for f in df.schema.fields if f.name in cols}
    texts = [c for c in cols if isinstance(types[c], T.StringType)]
    if any(isinstance(types[c], T.StringType) and types[c] != T.StringType() for c in cols):  # a collation orders otherwise
        return None
    units = {c: _units(F.col(c), types[c]) for c in cols if c not in texts}
    if any(u is None for u in units.values()):
        return None
    words: dict[str, tuple[str, ...]] = {}
    for c in texts:
        seen = [r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(DICTIONARY + 1).collect()]
        if len(seen) > DICTIONARY:
            return None
        words[c] = tuple(sorted(seen, key=lambda w: w.encode()))
    clocks = [c for c in units if isinstance(types[c], (T.TimestampType, T.TimestampNTZType))]
    stats = [F.count_if(F.col(c).isNull()) for c in cols] + [f(u) for u in units.values() for f in (F.min, F.max)]
    stats += [F.bool_and(units[c] % F.lit(s) == 0) for c in clocks for s in (_DAY, _SECOND)]
    got = list(df.agg(*stats).first())
    # a column without any value has one digit, null
    nulls = {c: int(n > 0) for c, n in zip(cols, got, strict=False)}
    got = got[len(cols):]
    ranges = dict(zip(units, zip(got[0::2], got[1::2], strict=False), strict=False))
    whole = got[2 * len(units):]
    digits = []
    for c in cols:
        if c in words:
            digits.append(_Digit(c, types[c], max(len(words[c]) + nulls[c], 1), nulls[c], words=words[c]))
            continue
        low, high = ranges[c]
        step = 1
        if c in clocks:
            day, second = whole[2 * clocks.index(c): 2 * clocks.index(c) + 2]
            step = _DAY if day else _SECOND if second else 1
        radix = 1 if low is None else (high - low) // step + 1 + nulls[c]
        digits.append(_Digit(c, types[c], radix, 1 if low is None else nulls[c], low or 0, step))
    if any(d.radix >= _LONG or abs(d.low) + d.radix * d.step >= _LONG for d in digits) or _product(digits) >= _LONG:
        return None
    return Packing(digits)
