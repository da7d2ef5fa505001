"""Sums of doubles that do not depend on the order in which tasks finish.

A finite double is cut into limbs of ``BITS`` bits at fixed places of the binary scale. Limbs of one place are added
as longs, which is exact, in any order and over any number of steps. At the end the limbs of a sum are carried into
one number, which is rounded once: the result is the double nearest to the true sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of a limb. Sums of 2**43 limbs of one place fit a long.
BITS = 20
#: Limbs that hold all bits of a double, wherever they begin.
_LIMBS = 5
# Beyond these sizes values are scaled by a power of two before they are cut, so that no step overflows.
_LARGE, _SMALL, _PLACES = 2.0**900, 2.0**-900, 10


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _power(bits: Column) -> Column:
    """2 ** bits, in doubles."""
    return F.pow(F.lit(2.0), bits)


def limbs(number: Column) -> Column:
    """The limbs of a double as array<struct<place:int,limb:bigint>>, without zeros.

    0 has none. NULL, NaN and infinities give NULL.
    """

    def cut(x: Column) -> Column:
        moved = F.when(F.abs(x) > _LARGE, _PLACES).when(F.abs(x) < _SMALL, -_PLACES).otherwise(0)
        return _with(moved, lambda by: _with(x * _power(-BITS * by), lambda y: from_top(y, by)))

    def from_top(y: Column, by: Column) -> Column:
        # One place higher than the logarithm says, which may be off by a little.
        top = F.floor(F.log2(F.abs(y)) / BITS).cast("int") + 1
        nothing = F.struct(y.alias("rest"), F.array().cast("array<struct<place:int,limb:bigint>>").alias("limbs"))

        def step(top: Column) -> Callable[[Column, Column], Column]:
            def one(state: Column, i: Column) -> Column:
                size = _power(BITS * (top - i))
                limb = F.struct((top - i + by).alias("place"), (state["rest"] / size).cast("bigint").alias("limb"))
                return _with(limb, lambda own: F.struct(
                    (state["rest"] - own["limb"] * size).alias("rest"), F.concat(state["limbs"], F.array(own)).alias("limbs")
                ))

            return one

        places = F.sequence(F.lit(0), F.lit(_LIMBS - 1))
        return _with(top, lambda t: F.filter(F.aggregate(places, nothing, step(t), lambda s: s["limbs"]), lambda own: own["limb"] != 0))

    empty = F.array().cast("array<struct<place:int,limb:bigint>>")
    finite = F.abs(number) < float("inf")
    return F.when(finite & (number != 0), _with(number, cut)).when(finite, empty)


def rounded(sums: Column) -> Column:
    """The double nearest to the sum whose limbs are a map<int,bigint> by place; 0 for an empty map."""

    def carried(raw: Column, sign: int) -> Column:
        nothing = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("limbs"))

        def step(state: Column, limb: Column) -> Column:
            total = state["carry"] + sign * limb
            return F.struct(
                F.shiftright(total, BITS).alias("carry"),
                F.concat(state["limbs"], F.array(total.bitwiseAND(F.lit((1 << BITS) - 1)).cast("bigint"))).alias("limbs"),
            )

        return F.aggregate(raw, nothing, step)

    def of(m: Column) -> Column:
        lowest = F.array_min(F.map_keys(m))
        # Four more places, into which a sum of longs is carried.
        places = F.sequence(lowest, F.array_max(F.map_keys(m)) + 4)
        raw = F.transform(places, lambda p: F.coalesce(F.element_at(m, p), F.lit(0).cast("bigint")))

        def signed(raw: Column) -> Column:
            # A negative sum ends with a negative carry: its opposite is carried instead.
            up = carried(raw, 1)
            return F.when(up["carry"] < 0, -from_digits(F.reverse(carried(raw, -1)["limbs"]), lowest)).otherwise(
                from_digits(F.reverse(up["limbs"]), lowest)
            )

        return _with(raw, signed)

    def from_digits(digits: Column, lowest: Column) -> Column:
        """Digits from the highest to the lowest, the last one of place ``lowest``."""

        def whole(d: Column) -> Column:
            first = F.array_position(F.transform(d, lambda x: x > 0), True).cast("int")
            return _with(first, lambda f: F.when(f == 0, 0.0).otherwise(value(d, f)))

        def value(d: Column, f: Column) -> Column:
            a, b, c, e = [F.coalesce(F.get(d, f - 1 + k), F.lit(0).cast("bigint")) for k in range(4)]
            below = F.exists(F.slice(d, f + 4, F.size(d)), lambda x: x != 0)

            def window(w: Column) -> Column:
                # 60 bits from the first one on, the last of which is set if anything lies below.
                top = F.call_function("shiftleft", (a * (1 << BITS) + b) * (1 << BITS) + c, BITS - w)
                bits = top.bitwiseOR(F.call_function("shiftright", e, w))
                left = (F.call_function("shiftleft", F.call_function("shiftright", e, w), w) != e) | below
                whole = bits.bitwiseOR(F.when(left, 1).otherwise(0).cast("bigint")).cast("double")
                power = BITS * (lowest + F.size(d) - f - 2) - (BITS - w)
                return _with(power, lambda p: whole * _power(F.floor(p / 2)) * _power(p - F.floor(p / 2)))

            return _with(F.length(F.bin(a)), window)

        return _with(digits, whole)

    return F.when(F.size(sums) == 0, 0.0).otherwise(_with(sums, of))
