"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text)


def covered(sequences: list[list], window: int) -> list[list[bool]]:
    """Which symbols lie in a window whose content starts anywhere else."""
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        flags = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                flags[i : i + window] = [True] * window
        out.append(flags)
    return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    out, start = [], None
    for i, f in enumerate([*flags, False]):
        if f and start is None:
            start = i
        elif not f and start is not None:
            out.append((start, i))
            start = None
    return out
