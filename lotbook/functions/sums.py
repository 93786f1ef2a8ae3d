"""Sums whose bits do not depend on the order of addition.

A DOUBLE is cut without loss into whole numbers of 24 bits, one per power of two, and these are
summed as BIGINTs: partial sums in any order and number give the same totals. The totals are put
together once, with one rounding, so the result is the DOUBLE nearest to the true sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

_BITS = 24
_MASK = (1 << _BITS) - 1
#: Powers of two of the parts, least first: fractions, then the whole number.
_NAMES = ("b0", "b1", "a0", "a1", "w0", "w1", "w2")


class ExactSum:
    """The sum of one column, in steps: ``parts`` over rows, ``merged`` over sums of parts (any
    number of times), ``value`` over the last of these.

    Exact for DOUBLEs below 2^63 down to multiples of 2^-96 (all that lies above 1e-13, and zero)
    and up to 2^39 rows of a group; what lies beyond is added as it comes, so infinities and NaN
    show. Nulls are left out; a group without values has a null sum. Columns of other types are
    exact as they are, and keep the type of their plain sum.
    """

    def __init__(self, df: DataFrame, column: str):
        self._column = column
        self._plain = not isinstance(df.schema[column].dataType, (DoubleType, FloatType))

    def _name(self, part: str) -> str:
        return f"_{self._column}_{part}"

    def parts(self) -> list[Column]:
        if self._plain:
            return [F.sum(self._column).alias(self._name("sum"))]
        x = F.col(self._column).cast("double")
        fits = F.abs(x) < F.lit(2.0**63)
        y = F.when(fits, x).otherwise(F.lit(0.0))
        whole = y.cast("bigint")
        high = (y - whole.cast("double")) * F.lit(2.0**48)
        a = high.cast("bigint")
        low = (high - a.cast("double")) * F.lit(2.0**48)
        b = low.cast("bigint")
        rest = (low - b.cast("double")) * F.lit(2.0**-96)
        cut = {
            "b0": b.bitwiseAND(_MASK),
            "b1": F.shiftright(b, _BITS),
            "a0": a.bitwiseAND(_MASK),
            "a1": F.shiftright(a, _BITS),
            "w0": whole.bitwiseAND(_MASK),
            "w1": F.shiftright(whole, _BITS).bitwiseAND(_MASK),
            "w2": F.shiftright(whole, 2 * _BITS),
        }
        sums = [F.sum(cell).alias(self._name(part)) for part, cell in cut.items()]
        rough = F.sum(F.when(fits, rest).otherwise(x)).alias(self._name("rough"))
        return [*sums, rough, F.count(x).alias(self._name("n"))]

    def merged(self) -> list[Column]:
        names = ["sum"] if self._plain else [*_NAMES, "rough", "n"]
        return [F.sum(self._name(part)).alias(self._name(part)) for part in names]

    def value(self) -> Column:
        if self._plain:
            return F.col(self._name("sum"))
        sums = {part: F.col(self._name(part)) for part in _NAMES}
        digits, carry = [], F.lit(0).cast("bigint")
        for part in _NAMES[:4]:
            total = sums[part] + carry
            digits.append(total.bitwiseAND(_MASK))
            carry = F.shiftright(total, _BITS)
        d0, d1, d2, d3 = digits
        whole = (
            _wide(sums["w2"]) * _power(48)
            + _wide(sums["w1"]) * _power(24)
            + _wide(sums["w0"] + carry)
        )
        fraction = _wide(d3) * _power(72) + _wide(d2) * _power(48) + _wide(d1) * _power(24) + _wide(d0)
        # All bits fit below 2^29. Beyond, 27 bits of the fraction suffice, the last of which says
        # whether anything is left: a tie is then no tie.
        exact = (whole * _power(96) + fraction).cast("double") * F.lit(2.0**-96)
        head = F.shiftleft(d3, 2) + F.shiftright(d2, 22)
        left = (d2.bitwiseAND((1 << 22) - 1) + d1 + d0 != 0).cast("bigint")
        short = (whole * _power(27) + _wide(2 * head + left)).cast("double") * F.lit(2.0**-27)
        total = F.when(F.abs(whole) < _power(29), exact).otherwise(short)
        return F.when(F.col(self._name("n")) > 0, total + F.col(self._name("rough")))


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _power(n: int) -> Column:
    return F.expr(f"{1 << n}BD")
