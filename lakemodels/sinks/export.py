"""Text export: rows encoded for a bulk text load, written as CSV files."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame

from lakemodels.functions.encode import encode_frame


def export_text(
    df: DataFrame, path: str, database_types: Mapping[str, str] | None = None, null_token: str | None = None
) -> str:
    """Write every row as CSV with a token of its own for null, so that '' stays ''.

    Returns the null token; a reader passes it as ``nullValue``.
    """
    token = null_token or f"__null_{uuid.uuid4().hex}__"
    # An empty text is written as "", a null as the bare token.
    encode_frame(df, database_types).write.option("nullValue", token).option("escape", '"').csv(path)
    return token
