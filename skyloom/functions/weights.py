"""Weighted aggregates and one-pass line fits as Column expressions for ``agg``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyloom.functions.common import as_column, num, ratio


def inverse_variance(err) -> Column:
    err = as_column(err)
    return ratio(num(1.0), err * err)


def weighted_mean(value, err) -> Column:
    w = inverse_variance(err)
    return ratio(F.sum(as_column(value) * w), F.sum(w))


def weighted_error(err) -> Column:
    return F.sqrt(ratio(num(1.0), F.sum(inverse_variance(err))))


def weighted_variance_of_mean(err) -> Column:
    """1/Σ(1/σ²): the variance, for callers that want no root."""
    return ratio(num(1.0), F.sum(inverse_variance(err)))


def weighted_rms(value, err, around: float = 17.0) -> Column:
    """Weighted scatter about the weighted mean in one pass; ``around`` keeps the sums small."""
    w, d = inverse_variance(err), as_column(value) - num(around)
    mean = ratio(F.sum(w * d), F.sum(w))
    return F.sqrt(F.greatest(ratio(F.sum(w * d * d), F.sum(w)) - mean * mean, num(0.0)))


def centroid(position, weight) -> Column:
    weight = as_column(weight)
    return ratio(F.sum(as_column(position) * weight), F.sum(weight))
