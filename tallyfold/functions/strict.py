"""Strict readings of dirty text: NULL unless the whole text is valid.

Casts alone are looser than the formats allow (padding, ``NaN``, ``1.``,
unpadded dates), so each one is guarded by a pattern. Each function takes the
SQL of a text and returns the SQL of its value.
"""

from __future__ import annotations


def to_double(text: str) -> str:
    shape = rf"{text} RLIKE r'\A[+-]?\d+(\.\d+)?([eE][+-]?\d+)?\z'"
    value = f"try_cast({text} AS DOUBLE)"
    return f"CASE WHEN {shape} AND abs({value}) < double('Infinity') THEN {value} END"


def to_integer(text: str) -> str:
    """An integer of up to 38 digits, the widest exact number there is; longer ones are NULL."""
    return rf"CASE WHEN {text} RLIKE r'\A[+-]?\d+\z' THEN try_cast({text} AS DECIMAL(38,0)) END"


def to_date(text: str) -> str:
    return rf"CASE WHEN {text} RLIKE r'\A[+-]?\d{{4}}-\d{{2}}-\d{{2}}\z' THEN try_cast({text} AS DATE) END"


def to_timestamp_ntz(text: str) -> str:
    shape = rf"{text} RLIKE r'\A\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}\z'"
    return f"CASE WHEN {shape} THEN try_cast({text} AS TIMESTAMP_NTZ) END"


def to_instant(text: str) -> str:
    """An ISO date-time with an offset; NULL without one."""
    shape = r"\A[+-]?\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}(:?\d{2})?)\z"
    # The cast reads offsets only with a colon and fractions only with a dot.
    iso = rf"regexp_replace({text}, r'([+-]\d{{2}})(\d{{2}})\z', '$1:$2')"
    iso = rf"regexp_replace({iso}, r'(:\d{{2}}[.,\d]*[+-]\d{{2}})\z', '$1:00')"
    return f"CASE WHEN {text} RLIKE r'{shape}' THEN try_cast(translate({iso}, ',', '.') AS TIMESTAMP) END"
