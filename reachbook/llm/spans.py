"""Spans in a text: (kind, start, end), code points, end exclusive."""

from __future__ import annotations

import hashlib

Span = tuple[str, int, int]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()
