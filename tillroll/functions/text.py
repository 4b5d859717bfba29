"""Text expressions: field splitting and label building."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One CSV field preceded by its comma: either a double-quoted field (doubled
# quotes inside) or a run of non-comma characters.  The line gets a leading
# comma so every field has one; each match then consumes at least that comma,
# and matching left to right keeps the split linear in the line length.  The
# possessive loops need no backtracking stack, however long a field is.
_CSV_FIELD = r',("[^"]*+(?:""[^"]*+)*+"|[^,]*)'


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def naive_fields(line, sep: str = ",") -> Column:
    """Split on every separator, quotes or not (a plain ``str.split``)."""
    return F.split(_col(line), _literal_regex(sep))


def csv_fields(line) -> Column:
    """Quote-aware split of one CSV line into an array of field values.

    Commas inside double quotes do not split; the surrounding quotes are removed
    and doubled quotes become one, as a CSV reader does.
    """
    parts = F.regexp_extract_all(F.concat(F.lit(","), _col(line)), F.lit(_CSV_FIELD), 1)
    return F.transform(parts, _unquote)


def _unquote(field: Column) -> Column:
    quoted = field.startswith('"') & field.endswith('"') & (F.length(field) >= 2)
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def _literal_regex(sep: str) -> str:
    return "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in sep)


def joined_with_blank(*cols) -> Column:
    """Concatenate parts with single blanks (null if any part is null)."""
    pieces = []
    for i, c in enumerate(cols):
        if i:
            pieces.append(F.lit(" "))
        pieces.append(_col(c))
    return F.concat(*pieces)


def upper_label(c) -> Column:
    return F.upper(_col(c))
