"""Runs of plain words in source text, which the scans pass over in one step.

Words with at most a comma, colon, semicolon or full stop and blanks between
them make no call and no literal.  What a scan knows behind such a run depends
on its last words alone, so it goes on from there, whatever stood before.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

_TAIL = 256


def _but(words: Iterable[str]) -> str:
    """A lookahead that refuses ``words``, tried by their first letter."""
    by: dict[str, list[str]] = {}
    for w in sorted(words):
        by.setdefault(w[0], []).append(w[1:])
    return "(?!" + "|".join(f"{a}(?:{'|'.join(rest)})\\b" for a, rest in by.items()) + ")" if by else ""


def skipper(special: Iterable[str] = ()) -> Callable[[str, int], tuple[int, str, int]]:
    """``skip(text, at)`` from the start of a token: the start of the word to go on from, the
    word or mark before it (no full stop), and the place before which it is not worth asking
    again.  The word and all that are passed are none of ``special``.  Without such a run
    the first place is ``at``."""
    run = re.compile(rf"(?:{_but(special)}[A-Za-z]++[,;:.]?+\s++){{4,}}+").match

    def skip(text: str, at: int) -> tuple[int, str, int]:
        m = run(text, at)
        if m is None:
            return at, "", at
        stop = place = m.end()
        low = max(at, stop - _TAIL)
        words = text[low:stop].split()
        for k in range(len(words) - 1, 1, -1):  # the first one may be cut
            place = text.rindex(words[k], low, place)
            before = words[k - 1]
            if before[-1] != ".":
                return place, before[-1] if before[-1] in ",;:" else before, stop
        return at, "", stop

    return skip
