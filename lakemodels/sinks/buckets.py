"""A hash of the key as partition column, so that a merge finds its rows in few folders.

The writer keeps the column; it follows from the key alone, so all rows that a batch row can match lie in the
bucket of that row. Rows with a null key match nothing and are spread by a hash of all their columns
instead, so that no bucket holds them all. The number of buckets stays until the table is rebuilt; some
hundred megabytes in each are a good size.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemodels.operators.merge import _orderable
from lakemodels.operators.relational import col

BUCKET = "__lm_bucket"
_NUMBER, _KEYS = "lakemodels.buckets", "lakemodels.bucket_keys"


@dataclass(frozen=True)
class Buckets:
    """How many buckets, and the key columns they are made of."""

    number: int
    keys: tuple[str, ...]

    def __post_init__(self):
        if self.number < 1:
            raise ValueError(f"buckets must be positive, got {self.number}")

    @staticmethod
    def of(properties: Mapping[str, str]) -> Buckets | None:
        """The buckets a table was written with."""
        if _NUMBER not in properties:
            return None
        return Buckets(int(properties[_NUMBER]), tuple(json.loads(properties[_KEYS])))

    def properties(self) -> dict[str, str]:
        return {_NUMBER: str(self.number), _KEYS: json.dumps(list(self.keys))}

    def added_to(self, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """The frame with its bucket as last column; ``columns`` are those that are stored (default: all)."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        spread = [c for c in sorted(columns or df.columns) if _orderable(kinds[c])]
        any_null = reduce(lambda a, b: a | b, [col(c).isNull() for c in self.keys])
        digest = F.when(any_null, F.xxhash64(*map(col, spread))).otherwise(F.xxhash64(*map(col, self.keys)))
        return df.withColumn(BUCKET, F.pmod(digest, F.lit(self.number)).cast("int"))

    def within(self, keys: list[str]) -> bool:
        """Whether rows that agree in ``keys`` share a bucket."""
        return {k.lower() for k in self.keys} <= {k.lower() for k in keys}


def without_bucket(df: DataFrame) -> DataFrame:
    """The columns that belong to the model."""
    return df.drop(BUCKET)
