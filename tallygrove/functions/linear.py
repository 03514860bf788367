"""Linear-model arithmetic as scalar column expressions.

Everything here unrolls over classes known when the plan is built, so no array
or higher-order function is involved and each stage of the scorer stays inside
whole-stage code generation.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(features: Sequence[Column], weights: Sequence[float], intercept: float) -> Column:
    """``w . x + b``, summed in feature order."""
    terms = [F.lit(float(w)) * x for w, x in zip(weights, features, strict=True)]
    return reduce(add, terms) + F.lit(float(intercept))


def largest(margins: Sequence[Column]) -> Column:
    """The largest margin that is a number; the least finite double if there is none."""
    return F.greatest(*(F.nanvl(m, F.lit(-math.inf)) for m in margins), F.lit(-sys.float_info.max))


def first_infinite(margins: Sequence[Column]) -> Column:
    """Index of the first margin that is plus infinity, or null."""
    chain = F.when(margins[0] == math.inf, F.lit(0))
    for k, margin in enumerate(margins[1:], start=1):
        chain = chain.when(margin == math.inf, F.lit(k))
    return chain


def softmax(margins: Sequence[Column], top: Column, infinite: Column) -> list[Column]:
    """Numerators of the softmax, shifted by the largest margin ``top``.

    Divide by their sum for probabilities, unless a margin is plus infinity: the first
    such one (``infinite``, from ``first_infinite``) takes all the probability, finite
    ones have none, and of others, as of MLlib's, it is not a number. A margin that is
    not a number makes all probabilities so.
    """
    return [
        F.when(infinite == k, F.lit(1.0)).when(infinite.isNotNull(), m * 0.0).otherwise(F.exp(m - top))
        for k, m in enumerate(margins)
    ]


def sigmoid_pair(margin: Column) -> list[Column]:
    """Probabilities of class 0 and class 1 for a binomial margin."""
    zero = F.lit(1.0) / (F.lit(1.0) + F.exp(margin))
    return [zero, F.lit(1.0) - zero]


def argmax(margins: Sequence[Column], top: Column) -> Column:
    """Index of the first largest margin, as a double.

    A margin that is not a number is passed over, as no comparison with it holds; if
    it is the first, nothing exceeds it and class 0 wins.
    """
    chain = F.when(F.isnan(margins[0]) | (margins[0] == top), F.lit(0.0))
    for k, margin in enumerate(margins[1:], start=1):
        chain = chain.when(margin == top, F.lit(float(k)))
    return chain.otherwise(F.lit(0.0))
