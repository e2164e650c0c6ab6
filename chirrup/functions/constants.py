"""Nested constants."""

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def constant(value: object, kind: str) -> Column:
    """A nested list or dictionary as a constant of the given type, which Spark folds once when it plans."""
    return F.from_json(F.lit(json.dumps(value)), F.lit(kind))
