"""Record contract of a vector import."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REASONS = ("missing_id", "missing_values", "wrong_dimension", "bad_value")


def reject_reasons(dimension: int | Column, id_: str = "id", values: str = "values") -> Column:
    """Codes of every broken rule, an empty array for a good record.

    ``array_contains`` runs inside generated code: it finds NaN and the infinities, and is NULL for a NULL element.
    """
    v = F.col(values)
    odd = [F.coalesce(F.array_contains(v, F.lit(float(x))), F.lit(True)) for x in ("nan", "inf", "-inf")]
    checks = (
        F.col(id_).isNull(),
        v.isNull(),
        v.isNotNull() & (F.size(v) != dimension),
        v.isNotNull() & (odd[0] | odd[1] | odd[2]),
    )
    return F.array_compact(F.array(*[F.when(c, code) for c, code in zip(checks, REASONS)]))
