"""Column -> Column helpers. All of them compile to built-in JVM expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def flag_equals(value: ColumnOrName, wanted: str) -> Column:
    """True where the text equals ``wanted`` in any case, False elsewhere, null included.

    Blanks count: ``" approved"`` is not ``"approved"``.
    """
    return F.lower(as_column(value)).eqNullSafe(F.lit(wanted.lower()))


def bucketize(
    value: ColumnOrName,
    bounds: Sequence[float],
    labels: Sequence[str],
    null_label: str | None = None,
) -> Column:
    """Label a number by the first bound it lies below; the last label takes the rest.

    NaN lies below no bound and gets the last label. So does null, unless
    ``null_label`` names a label for it.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError(f"{len(bounds)} bounds need {len(bounds) + 1} labels, got {len(labels)}")
    if list(bounds) != sorted(bounds):
        raise ValueError(f"bounds must ascend: {list(bounds)}")
    number = as_column(value)
    steps = [(number < F.lit(bound), label) for bound, label in zip(bounds, labels)]
    if null_label is not None:
        steps.insert(0, (number.isNull(), null_label))
    if not steps:
        return F.lit(labels[-1])
    (test, label), *rest = steps
    chain = reduce(lambda c, step: c.when(*step), rest, F.when(test, label))
    return chain.otherwise(labels[-1])


def pick(labels: Sequence[str], number: ColumnOrName) -> Column:
    """The label at position ``number`` modulo the number of labels."""
    choices = F.array(*[F.lit(label) for label in labels])
    return F.get(choices, F.pmod(as_column(number), F.lit(len(labels))).cast("int"))


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up. ``whole`` must not be 0."""
    return F.round(as_column(part) / as_column(whole) * 100, digits)
