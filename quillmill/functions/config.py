"""Flat views and signatures of nested settings; this is configuration, so it is worked out on the driver."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

PLAIN = (str, int, float, bool)


def flattened(settings, excluded: Iterable[str] = (), prefix: str = "") -> list[tuple[str, str]]:
    """Name-value pairs of a nested dict.

    Nested names are joined by "_"; an empty list is ""; a list that begins with a plain
    value is joined by "-"; any other list recurses with the index behind a "-"; what is no
    dict at all is ("unknown", its class).  ``excluded`` has whole joined names, and stops
    plain values only: dicts and lists of that name go in.
    """
    if not isinstance(settings, dict):
        return [("unknown", type(settings).__name__)]
    skip, out = set(excluded), []
    for name, value in settings.items():
        full = f"{prefix}_{name}" if prefix else str(name)
        if isinstance(value, dict):
            out += flattened(value, skip, full)
        elif isinstance(value, list) and value and not isinstance(value[0], PLAIN):
            out += [pair for i, x in enumerate(value) for pair in flattened(x, skip, f"{full}-{i}")]
        elif isinstance(value, list):
            out.append((full, "-".join(map(str, value))))
        elif full not in skip:
            out.append((full, str(value)))
    return out


def signature(settings, excluded: Iterable[str] = ()) -> str:
    """SHA-1, in hexadecimal, of the flat name-value pairs: a key for caches and runs."""
    return hashlib.sha1("-".join(f"{k}-{v}" for k, v in flattened(settings, excluded)).encode()).hexdigest()
