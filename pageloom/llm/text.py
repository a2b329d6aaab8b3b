"""Words of a text, and functions that run once per text inside a task.

Texts reach Python as Arrow batches, which Spark bounds in rows and bytes.  A
function made by :func:`per_text` sees one whole text at a time, so its memory
follows the longest text and not the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType


def _table(lower: bool, spaces: Callable[[int], bool]) -> bytes:
    out = []
    for b in range(256):
        c = b + 32 if lower and 65 <= b <= 90 else b
        out.append(32 if spaces(c) else c)
    return bytes(out)


#: Lower-case A-Z; everything in ASCII but digits and letters separates words.
_ALNUM = _table(True, lambda c: c < 128 and not (48 <= c <= 57 or 97 <= c <= 122))
#: Lower-case A-Z; words are separated by space, tab, LF, VT, FF and CR.
_LOWER = _table(True, lambda c: False)

#: The same two word patterns for regular expressions (after A-Z is lower-cased).
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_WORD = r"[^\x20\x09-\x0D]+"

_UPPER_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of digits, ASCII letters (lower-cased) and non-ASCII characters, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_ALNUM).split() if text else []


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").translate(_LOWER).split() if text else []


def lower_az(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER_AZ, _UPPER_AZ.lower())


def unused(df: DataFrame, name: str, prefix: bool = False) -> str:
    """``name`` with underscores added until no column of ``df`` has it.

    With ``prefix`` no column begins with it either.  Case is ignored, as in Spark.
    """
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) if prefix else c == name.lower() for c in taken):
        name += "_"
    return name


def per_text(make: Callable[[], Callable], result: DataType) -> Callable[..., Column]:
    """A column function whose value for a row is ``make()(value, ...)``.

    ``make`` runs once per task, so that tables are built once.  A struct result is
    given as a tuple of its fields.
    """
    kind = to_arrow_type(result)
    names = [f.name for f in kind] if pa.types.is_struct(kind) else None

    def convert(values: list) -> pa.Array:
        if names is None:
            return pa.array(values, type=kind)
        columns = list(zip(*values, strict=True)) if values else [() for _ in names]
        return pa.StructArray.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, kind, strict=True)],
            fields=list(kind),
        )

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        f = make()
        for batch in batches:
            yield convert([f(x) for x in batch.to_pylist()])

    return F.arrow_udf(one, result)
