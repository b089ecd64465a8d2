"""JSON parsing with explicit validity rules (dead-letter routing).

``from_json`` alone accepts rows a strict record mapper rejects (missing
required keys, unknown keys, empty text).  :func:`json_verdict` adds those
checks with built-in expressions, so routing stays JVM-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def parse_struct(text: Column, schema: T.StructType, mode: str = "PERMISSIVE") -> Column:
    """``from_json`` with a corrupt-record field appended to the schema.

    ``mode="FAILFAST"`` makes a malformed record fail the job, like a
    deserializer whose exception escapes.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return F.from_json(text, with_corrupt, {"mode": mode, "columnNameOfCorruptRecord": CORRUPT})


def json_verdict(text: Column, parsed: Column, schema: T.StructType, required: Sequence[str],
                 allow_unknown: bool = False, keys: Column | None = None) -> Column:
    """TRUE when ``text`` is a JSON object that maps onto ``schema``:

    * it is an object (``json_object_keys`` is NULL for non-JSON, empty text,
      arrays and scalars);
    * every ``required`` key is present (an explicit ``null`` counts as present);
    * no key outside ``schema`` unless ``allow_unknown``;
    * no value had the wrong type (``from_json`` flagged no corrupt record).

    ``keys`` may pass an already computed ``json_object_keys(text)``.
    """
    keys = F.json_object_keys(text) if keys is None else keys
    ok = keys.isNotNull() & text.isNotNull()
    for k in required:
        ok = ok & F.array_contains(keys, F.lit(k))
    if not allow_unknown:
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        ok = ok & (F.size(F.array_except(keys, known)) == 0)
    ok = ok & parsed.isNotNull() & parsed.getField(CORRUPT).isNull()
    return F.coalesce(ok, F.lit(False))
