"""Code mapping: CASE WHEN trim(x) = k1 THEN v1 ... END.

No ELSE branch: unmapped values give NULL, as in the reference.  The
mapping is small metadata, so it becomes one CASE expression inside the
projection (whole-stage codegen) rather than a join.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_of(c, mapping: Mapping[str, str], trim: bool = True) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    if trim:
        x = F.trim(x)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    if expr is None:
        return F.lit(None).cast("string")
    return expr
