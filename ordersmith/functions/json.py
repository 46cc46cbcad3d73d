"""JSON on the wire."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_value(c, schema: StructType) -> Column:
    """bytes or text -> struct. Malformed JSON gives a struct of nulls, which
    the key filters downstream then drop; a wrongly typed field gives null."""
    return F.from_json(_col(c).cast("string"), schema)


def to_json_keep_nulls(*cols) -> Column:
    """struct -> JSON text with null fields written as ``null`` (Python's
    ``json.dumps`` keeps the key; Spark's default would drop it)."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def parse_messages(envelope, schema: StructType, value_col: str = "value",
                   keep: tuple[str, ...] = ("offset",)):
    """Parse every message exactly once: ``data.*`` plus the ``keep`` columns.

    The parsed struct comes out of a generator (``inline`` of a one-element
    array). Filters on its fields therefore stay above it: without that,
    Catalyst pushes a filter such as ``order_id <> ''`` below the projection
    and inlines ``from_json`` into the predicate, parsing each message once
    per referenced field and again for the output.
    """
    one = F.array(F.struct(parse_value(value_col, schema).alias("data"),
                           *[F.col(k) for k in keep]))
    return envelope.select(F.inline(one)).select("data.*", *keep)
