"""Digests of rows and payloads as Spark SQL text."""

from __future__ import annotations

from collections.abc import Sequence


# Nulls stay visible and times keep their microseconds.
JSON_OPTIONS = (
    "map('ignoreNullFields', 'false',"
    " 'timestampFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\","
    " 'timestampNTZFormat', \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
)


def canonical_json(columns: Sequence[str]) -> str:
    """One JSON text per row with the fields in the given order and nulls kept."""
    return f"to_json(struct({', '.join(columns)}), {JSON_OPTIONS})"


def payload_digest(text: str) -> str:
    return f"sha2({text}, 256)"


def short_digest(columns: Sequence[str]) -> str:
    """Sixteen hex digits naming the content of a row."""
    return f"substring({payload_digest(canonical_json(columns))}, 1, 16)"


def sampling_key(seed: int, identifier: str) -> str:
    """A reproducible pseudo-random order key that ignores how rows are laid out."""
    return f"md5(concat('{seed}:', {identifier}))"
