"""Several facts joined on one shared key, without running the product.

Joining independent facts on a date, minute or station multiplies their rows: with 10^9 rides and 10^6 delays a day the
join has 10^15 rows. Each fact is summed per key first; a row of fact f then stands for as many joined rows as the
other facts have under that key.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODES = ("literal", "independent")


@dataclass(frozen=True)
class Fact:
    """Rows plus the aggregates wanted per key.

    ``totals`` are additive aggregates (sums and counts of a column), repeated once per joined row in literal mode.
    ``distinct`` are aggregates a repeated row does not change (distinct counts, minima, maxima).
    """

    rows: DataFrame
    totals: Mapping[str, Column] = field(default_factory=dict)
    distinct: Mapping[str, Column] = field(default_factory=dict)


def fan_out(dim: DataFrame, key: str, facts: Mapping[str, Fact], mode: str = "literal") -> DataFrame:
    """``dim`` LEFT JOIN every fact on ``key``, as one row per dimension row.

    ``mode='literal'`` gives the totals of the row-by-row join, ``'independent'`` each fact's own totals. Totals are
    decimals: products of counts outgrow a bigint.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    out = dim
    for name, fact in facts.items():
        per_key = fact.rows.groupBy(key).agg(
            F.count(F.lit(1)).alias(f"_n_{name}"),
            *[c.alias(a) for a, c in fact.totals.items()],
            *[c.alias(a) for a, c in fact.distinct.items()],
        )
        out = out.join(per_key, key, "left")

    def joined_rows(name: str) -> Column:
        return F.greatest(F.coalesce(F.col(f"_n_{name}"), F.lit(0)), F.lit(1)).cast("decimal(19,0)")

    result = [F.col(c) for c in dim.columns]
    for name, fact in facts.items():
        others = [joined_rows(g) for g in facts if g != name and mode == "literal"]
        for alias in fact.totals:
            total = F.col(alias)
            if others:
                total = reduce(lambda a, b: (a * b).cast("decimal(38,2)"), others, total.cast("decimal(38,2)"))
            result.append(total.alias(alias))
        result += [F.col(a) for a in fact.distinct]
    return out.select(*result)


def mean(total: str, n: str) -> Column:
    """AVG over fanned-out totals, from its sum and count columns."""
    return F.try_divide(F.sum(total).cast("double"), F.sum(n).cast("double"))


def whole(total: str) -> Column:
    """SUM over fanned-out totals as a whole decimal, which a bigint cannot hold; NULL if no row contributes."""
    return F.sum(F.col(total).cast("decimal(38,0)"))
