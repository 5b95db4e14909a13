"""Sums of doubles that do not depend on the order of the rows.

A double is split, without error, into a whole number and two 40-bit integers
of its fraction. These are summed as decimals, which is exact in any order, and
put together once at the end. What a value has beyond 2^-80 is cut off in the
same way in every row; values from 2^-27 on have nothing there. NaN, infinite
values and those from 2^62 on are summed as doubles beside it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Step between the parts, and the bound of values that are split.
STEP, BOUND = float(2**40), float(2**62)
#: Bits of a limb, and the limbs of each part. Their sums as longs are exact for 2^42 rows.
LIMB_BITS, LIMBS = 21, {"whole": 3, "high": 2, "low": 2}


def exact_parts(value: str | Column) -> dict[str, Column]:
    """The parts of a value by name; each is summed on its own."""
    parts, other = _split(value)
    return {**{name: part.cast("decimal(19,0)") for name, part in parts.items()}, "other": other}


def _split(value: str | Column) -> tuple[dict[str, Column], Column]:
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    split = F.abs(x) < BOUND  # false for NaN, which is larger than everything
    whole = F.when(split, x).cast("bigint")
    rest = (F.when(split, x) - whole) * STEP
    high = rest.cast("bigint")
    low = ((rest - high) * STEP).cast("bigint")
    return {"whole": whole, "high": high, "low": low}, F.when(~split, x)


def exact_sums(name: str, value: str | Column) -> list[Column]:
    """Aggregates that hold the sum of a value: one for each part, called after `name`."""
    return [F.sum(part).alias(f"{name}_{kind}") for kind, part in exact_parts(value).items()]


def limb_sums(name: str, value: str | Column) -> list[Column]:
    """Aggregates like `exact_sums` for many rows: longs, which are added up much faster than decimals.

    `from_limbs` makes the columns of `exact_sums` of them.
    """
    parts, other = _split(value)
    low_bits, sums = F.lit((1 << LIMB_BITS) - 1), []
    for kind, part in parts.items():
        for i in range(LIMBS[kind]):
            limb = F.shiftright(part, LIMB_BITS * i)
            limb = limb.bitwiseAND(low_bits) if i < LIMBS[kind] - 1 else limb
            sums.append(F.sum(limb).alias(f"{name}_{kind}{i}"))
    return [*sums, F.sum(other).alias(f"{name}_other")]


def from_limbs(name: str) -> list[Column]:
    """The columns of `exact_sums`, the same numbers in the same types, out of those of `limb_sums`."""
    whole = []
    for kind, limbs in LIMBS.items():
        total = F.lit(0)
        for i in range(limbs):
            total = total + (F.col(f"{name}_{kind}{i}").cast("decimal(20,0)") * F.lit(1 << LIMB_BITS * i)).cast("decimal(38,0)")
        whole.append(total.cast("decimal(29,0)").alias(f"{name}_{kind}"))
    return [*whole, F.col(f"{name}_other")]


def exact_total(name: str, again: bool = True) -> Column:
    """The sum, rounded once, out of the columns of `exact_sums`; of several rows of them, unless `again` is False."""
    of = lambda kind: F.sum(f"{name}_{kind}") if again else F.col(f"{name}_{kind}")
    whole, high, low = (of(kind).cast("double") for kind in ("whole", "high", "low"))
    total = whole + (high / STEP + low / (STEP * STEP))
    other = of("other")
    return F.when(other.isNull(), total).otherwise(other + F.coalesce(total, F.lit(0.0)))
