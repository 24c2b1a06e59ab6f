"""The column functions as temporary SQL functions, so that a query in SQL can call them by name.

Each is registered with its own expression as body: Spark puts the body where the call stands, and plans it as if it
had been written there. No Python runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import dates as D
from quillspark.functions import names as N
from quillspark.functions import stats as S
from quillspark.functions import text as X

#: name: (parameters with their types, type of the result, body over columns of the parameters' names)
FUNCTIONS: dict[str, tuple[dict[str, str], str, Callable[..., Column]]] = {
    "squeeze": ({"x": "string"}, "string", X.squeeze),
    "typography": ({"x": "string"}, "string", X.typography),
    "plain_text": ({"x": "string"}, "string", X.plain),
    "flatten_note": ({"x": "string"}, "string", X.flatten),
    "flatten_afs_note": ({"x": "string"}, "string", lambda x: X.flatten(x, "AFS")),
    "word_count": ({"x": "string"}, "bigint", X.word_count),
    "ascii_word_count": ({"x": "string"}, "bigint", X.ascii_word_count),
    "note_type": ({"name": "string"}, "string", X.note_type),
    "gng_number": ({"name": "string", "body": "string"}, "string", lambda name, body: X.operation_number(name, body, "GNG")),
    "afs_number": ({"name": "string", "body": "string"}, "string", lambda name, body: X.operation_number(name, body, "AFS")),
    "other_number": ({"name": "string", "body": "string"}, "string", lambda name, body: X.operation_number(name, body, "OTHER")),
    "is_table_line": ({"x": "string"}, "boolean", X.is_table_line),
    "is_contents": ({"lines": "array<string>"}, "boolean", X.is_contents),
    "gng_noise": ({"x": "string"}, "string", lambda x: X.noise_reason(x, "GNG")),
    "afs_noise": ({"x": "string"}, "string", lambda x: X.noise_reason(x, "AFS")),
    "canonical_prefix": ({"x": "string"}, "string", X.canonical_prefix),
    "export_prefix": ({"x": "string"}, "string", X.export_prefix),
    "division_author": ({"x": "string"}, "string", X.division_author),
    "service_author": ({"x": "string"}, "string", X.service_author),
    "value_label": ({"x": "double"}, "string", X.value_label),
    "short_label": ({"x": "string"}, "string", X.short_label),
    "html_text": ({"x": "string"}, "string", X.html_text),
    "clean_name": ({"x": "string"}, "string", N.clean_key),
    "ascii_text": ({"x": "string"}, "string", N.to_ascii),
    "parse_date": ({"x": "string"}, "date", D.parse_date),
    "filename_date": ({"name": "string"}, "date", D.filename_date),
    "meta_date": ({"x": "string"}, "date", D.meta_date),
    "visible_date": ({"body": "string"}, "date", D.visible_date),
    "path_year": ({"path": "string"}, "int", D.path_year),
    "day_month_swap": ({"d": "date"}, "date", D.swapped),
    "date_status": ({"held": "date", "visible": "date", "file": "date"}, "string", D.date_status),
    "safe_ratio": ({"a": "double", "b": "double"}, "double", S.safe_ratio),
    "percent_of": ({"a": "double", "b": "double"}, "double", S.percent),
    "axis_maximum": ({"x": "double"}, "double", S.axis_maximum),
}

_LITERAL = re.compile(r"'(?:[^'\\]|\\.)*'", re.DOTALL)
#: An operator that is written like a function; as a name it has to stand in back quotes.
_OPERATOR = re.compile(r"(?<![\w`])(and|or|not|in|<=>|[<>]=|[<>!=+*/%-]|==|<>)\(")


def body_of(c: Column) -> str:
    """A column's expression as SQL text."""
    text, out, at = c._jc.node().sql(), [], 0
    for m in _LITERAL.finditer(text):
        out += [_OPERATOR.sub(r"`\1`(", text[at : m.start()]), m[0]]
        at = m.end()
    return "".join([*out, _OPERATOR.sub(r"`\1`(", text[at:])])


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make FUNCTIONS known to the session's SQL, each under `prefix` and its name; the names."""
    made = []
    for name, (parameters, kind, build) in FUNCTIONS.items():
        listed = ", ".join(f"{p} {t}" for p, t in parameters.items())
        body = body_of(build(*[F.col(p) for p in parameters]))
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({listed}) RETURNS {kind} RETURN {body}")
        made.append(f"{prefix}{name}")
    return made


def register_tables(spark: SparkSession, prefix: str = "") -> list[str]:
    """Make the table functions known to the session's SQL; the names."""
    from quillspark.operators.extraction import OtherNote

    spark.udtf.register(f"{prefix}other_note", OtherNote)
    return [f"{prefix}other_note"]
