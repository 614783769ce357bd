"""Guards for job parameters before they reach SQL text or a path.

Table and database names are spliced into DDL, so they must be plain
identifiers; URLs and output locations must use an expected scheme.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

_IDENT = r"[A-Za-z_][A-Za-z0-9_]*"
_IDENT_RE = re.compile(_IDENT)
_TABLE_RE = re.compile(rf"{_IDENT}(\.{_IDENT})?")
_QUALIFIED_RE = re.compile(rf"{_IDENT}\.{_IDENT}")


def check_identifier(name: str, what: str = "name") -> str:
    """A database or column name: letters, digits and underscores, no leading digit."""
    if not isinstance(name, str) or not _IDENT_RE.fullmatch(name):
        raise ValueError(f"{what} must be a plain identifier, got {name!r}")
    return name


def check_table_name(name: str, what: str = "table", require_schema: bool = False) -> str:
    """``table`` or ``schema.table``; with ``require_schema`` only the latter."""
    pattern = _QUALIFIED_RE if require_schema else _TABLE_RE
    if not isinstance(name, str) or not pattern.fullmatch(name):
        form = "schema.table" if require_schema else "table or schema.table"
        raise ValueError(f"{what} must use the {form} format, got {name!r}")
    return name


def split_table_name(name: str, default_schema: str | None = None) -> tuple[str | None, str]:
    check_table_name(name)
    if "." in name:
        schema, table = name.split(".", 1)
        return schema, table
    return default_schema, name


def check_jdbc_url(url: str, subprotocols: Sequence[str] | None = None) -> str:
    """A JDBC URL, optionally limited to given subprotocols (``postgresql``)."""
    if not isinstance(url, str) or not url.startswith("jdbc:"):
        raise ValueError("the connection URL must be a JDBC URL (jdbc:...)")
    if subprotocols:
        sub = url[len("jdbc:") :].split(":", 1)[0]
        if sub not in subprotocols:
            raise ValueError(f"the JDBC URL must use one of {', '.join(subprotocols)}, got {sub!r}")
    return url


def check_location(path: str, schemes: Sequence[str] = ("s3://", "s3a://", "gs://", "abfss://", "hdfs://")) -> str:
    """An output location on shared storage with one of ``schemes``."""
    if not isinstance(path, str) or not any(path.startswith(s) for s in schemes):
        raise ValueError(f"the output location must start with one of {', '.join(schemes)}")
    return path
