"""Sums and averages of doubles that do not depend on the order of the rows.

Adding doubles rounds after every step, so ``sum`` and ``avg`` differ in the
last bits with the order in which partial results arrive, and a tie between
two averages can flip from run to run. Here each value is cut into a whole
part and three fractions of 24 bits, which are exact whole numbers; their sums
are sums of longs, the same in any order and under any partial aggregation.
The result is put together once, at the end, from numbers that only depend on
the exact total.

A value of magnitude below 2^31 counts exactly down to steps of 2^-72: every
double of at least 2^-20 is exact, the digits of smaller ones beyond 2^-72
(about 2e-22) are cut off. Larger values, NaN and infinities are added as
doubles beside that. A sum of magnitude below 2^29 is the correctly rounded
one. NULL counts nowhere; a group without values gives NULL.

All of it is plain expressions and five sums, so aggregation stays partial
and code-generated.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktally.functions.values import as_col

LIMIT = float(1 << 31)
STEP = 1 << 24
LIMBS = ("whole", "high", "middle", "low", "other")


def limbs(col: Column | str) -> list[Column]:
    """The parts of a value, named as in ``LIMBS``: four longs, and the value
    itself where it is too large or not finite (else NULL)."""
    value = as_col(col).cast("double")
    inside = F.abs(value) < F.lit(LIMIT)
    rest = F.abs(value)
    parts = []
    for name in LIMBS[:4]:
        part = F.floor(rest)
        parts.append(F.when(inside, F.when(value < 0, -part).otherwise(part)).alias(name))
        # Taking off the whole part and moving the point are exact.
        rest = (rest - part) * F.lit(float(STEP))
    return [*parts, F.when(~inside, value).alias("other")]


def limb_sums(parts: list[Column | str]) -> Column:
    """Aggregate: the sums of ``limbs`` (or of such sums) as one struct."""
    return F.struct(*[F.sum(as_col(p)).alias(name) for p, name in zip(parts, LIMBS)])


def add_limbs(state: Column | str) -> Column:
    """Aggregate: the sum of structs made by ``limb_sums``."""
    return limb_sums([as_col(state)[name] for name in LIMBS])


def limbs_total(state: Column | str) -> Column:
    """The sum as a double, from a struct made by ``limb_sums``; NULL if
    nothing was added."""
    s = as_col(state)
    # Carry from the lowest part upwards, so that equal totals have equal
    # parts whatever values they came from.
    step = F.lit(STEP)
    middle = s["middle"] + _steps(s["low"])
    high = s["high"] + _steps(middle)
    upper = (s["whole"] + _steps(high)).cast("double") + F.pmod(high, step).cast("double") / F.lit(float(STEP))
    lower = (F.pmod(middle, step) * step + F.pmod(s["low"], step)).cast("double") / F.lit(float(STEP) ** 3)
    return F.when(s["whole"].isNull(), s["other"]).otherwise(upper + lower + F.coalesce(s["other"], F.lit(0.0)))


def _steps(col: Column) -> Column:
    """How many steps a long holds, rounded down."""
    return F.shiftright(col, 24)


def exact_sum(col: Column | str) -> Column:
    """Aggregate: the sum of a column of doubles, the same for any order."""
    return limbs_total(limb_sums(limbs(col)))


def exact_avg(col: Column | str) -> Column:
    """Aggregate: ``exact_sum`` divided once by the number of values."""
    return exact_sum(col) / F.count(as_col(col))


def exact_avg_where(parts: list[Column | str], col: Column | str, hit: Column) -> Column:
    """Aggregate: ``exact_avg`` of the rows where ``hit`` holds, from the
    ``limbs`` of the column, which several such averages share."""
    chosen = [F.when(hit, as_col(p)) for p in parts]
    return limbs_total(limb_sums(chosen)) / F.count(F.when(hit, as_col(col)))
