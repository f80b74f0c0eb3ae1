"""Exact interpolated quantiles by narrowing from mergeable sketches.

The built-in exact ``percentile`` keeps every distinct value of the table in one task. Here each round asks a quantile
sketch (``percentile_approx``, merged across tasks) for two values around each wanted rank among the values still possible,
counts exactly what lies below, at and between them, and either has the answer or goes on strictly between the two. Each round leaves
about 2 / ``accuracy`` of the values, whatever their distribution, and excludes two values at least, so it always
ends. Only sketches and counts reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def exact_quantiles(
    df: DataFrame, columns: dict[str, Column], probs: list[float], accuracy: int = 10_000,
) -> dict[str, list[float | None]]:
    """Quantiles of each named expression; None where there is no value.

    Nulls and NaN are missing values; infinities are the smallest and largest values. The expressions are written once; a round
    takes one sketch per column and bounds, for all wanted ranks between them, and one job of counts for all columns.
    """
    names, slack = list(columns), 2.0 / accuracy
    if not names:
        return {}
    values = cut_lineage(df.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(n) for n, c in columns.items()]))
    around = lambda at: [min(1.0, max(0.0, at + d)) for d in (-slack, slack)]
    sketch = lambda n, low, high, ats: F.percentile_approx(_inside(n, low, high), F.array(*[F.lit(x) for at in ats for x in around(at)]), accuracy)
    first = values.agg(*[F.count(n) for n in names], *[sketch(n, None, None, probs) for n in names]).first()
    counts = dict(zip(names, first[:len(names)]))

    # Per (column, rank): open bounds of the values still possible, how many lie below, how many are inside, and two values around the rank.
    open_ranks, found = {}, {}
    for n, pairs in zip(names, first[len(names):]):
        for i, p in enumerate(probs if counts[n] else []):
            for rank in {math.floor(p * (counts[n] - 1)), math.ceil(p * (counts[n] - 1))}:
                open_ranks[n, rank] = (None, None, 0, counts[n], *pairs[2 * i:2 * i + 2])
    while open_ranks:
        asked = list({(n, low, high, a, b) for (n, _), (low, high, _, _, a, b) in open_ranks.items()})
        tallies = []
        for n, low, high, a, b in asked:
            x, a, b = _inside(n, low, high), F.lit(float(a)), F.lit(float(b))
            tallies += [F.count_if(x < a), F.count_if(x == a), F.count_if((x > a) & (x < b)), F.count_if(x == b)]
        tally = values.agg(*[t.alias(f"t{i}") for i, t in enumerate(tallies)]).first()
        seen = {key: tally[4 * i:4 * i + 4] for i, key in enumerate(asked)}
        left: dict[tuple, list] = {}
        for (n, at_rank), (low, high, below, inside, a, b) in open_ranks.items():
            less, at_a, between, at_b = seen[n, low, high, a, b]
            rank = at_rank - below
            if rank < less:
                left.setdefault((n, low, a, below, less), []).append(at_rank)
            elif rank < less + at_a:
                found[n, at_rank] = a
            elif rank < less + at_a + between:
                left.setdefault((n, a, b, below + less + at_a, between), []).append(at_rank)
            elif a != b and rank < less + at_a + between + at_b:
                found[n, at_rank] = b
            else:
                past = less + at_a + between + (at_b if a != b else 0)
                left.setdefault((n, b, high, below + past, inside - past), []).append(at_rank)
        open_ranks = {}
        if left:
            bounds = list(left)
            pairs = values.agg(*[sketch(n, low, high, [(rank - below + 0.5) / inside for rank in left[key]]).alias(f"q{i}")
                                 for i, key in enumerate(bounds) for n, low, high, below, inside in [key]]).first()
            for key, own in zip(bounds, pairs):
                n, low, high, below, inside = key
                for i, rank in enumerate(left[key]):
                    open_ranks[n, rank] = (low, high, below, inside, *own[2 * i:2 * i + 2])

    def interpolated(n: str, p: float) -> float | None:
        if not counts[n]:
            return None
        position = p * (counts[n] - 1)
        low, high = found[n, math.floor(position)], found[n, math.ceil(position)]
        share = position - math.floor(position)
        if low == high or not share:
            return low
        apart = high - low
        return low + apart * share if math.isfinite(apart) or not math.isfinite(low + high) else low * (1 - share) + high * share

    return {n: [interpolated(n, p) for p in probs] for n in names}


def _inside(name: str, low: float | None, high: float | None) -> Column:
    """The value where it lies strictly between the bounds, else null."""
    x = F.col(name)
    fits = F.lit(True)
    if low is not None:
        fits = fits & (x > F.lit(float(low)))
    if high is not None:
        fits = fits & (x < F.lit(float(high)))
    return F.when(fits, x)
