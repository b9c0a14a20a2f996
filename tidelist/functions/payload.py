"""Reading provider payloads kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(payload: Column, ddl: str) -> Column:
    """One typed parse of the payload; scalars asked for as STRING keep their JSON text."""
    return F.from_json(payload, ddl)


def json_text(payload: Column, path: str) -> Column:
    """Scalar at ``path`` as text; JSON null and a missing path are NULL."""
    return F.get_json_object(payload, path)


def joined_field(items: Column, field: str, separator: str = " ") -> Column:
    """Join one text field of an array of objects; NULL members are skipped."""
    return F.array_join(F.transform(items, lambda item: item[field]), separator)


def canonical_json(value: Column) -> Column:
    """JSON text of a variant: keys sorted, no spaces, so equal values have equal text."""
    return F.to_json(value)
