"""One CSV dialect for every writer and reader of the library.

Fields are quoted with double quotes, a quote inside a field is doubled, white
space is part of the field, and a quoted field may hold newlines. CSV does not
tell an empty text from no value: both read back as null.
"""

from __future__ import annotations

_SHARED = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

WRITE = {**_SHARED, "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def read_options(multiline: bool = True) -> dict[str, str]:
    """Options of a reader; without ``multiline`` a file is split into many tasks, but no field may hold a newline."""
    return {**_SHARED, "multiLine": str(multiline).lower(), "mode": "PERMISSIVE"}
