from .files import (
    SOURCES,
    SourceSpec,
    check_sources,
    read_file,
    read_since,
    read_source,
    resolve_source,
)

__all__ = [
    "SOURCES",
    "SourceSpec",
    "check_sources",
    "read_file",
    "read_since",
    "read_source",
    "resolve_source",
]
