"""One pass over Python text: calls, import statements and string literals.

Code inside the braces of an f-string is read again as code, to any depth, with
its own brackets and strings; format specifications are text that may hold
braces of their own.  Comments are dropped first.  It is no parser: text that is
no Python gives what is still readable.  Work and memory are linear in the text.
"""

from __future__ import annotations

import re

from pkgsift.functions.plain_runs import skipper

_BLANK = re.compile(r"(?:[^\S\n]++|\\\r?\n|#[^\n]*+)*+")
_TOKEN = re.compile(r"""
  (?P<string>(?:[rR][bBfFtT]?|[bBfFtT][rR]?|[uU])?(?:\"{3}|'{3}|"|'))
 |(?P<name>[^\W\d]\w*+)
 |(?P<number>\.?\d\w*+(?:\.\w*+)?+)
 |(?P<mark>[\s\S])
""", re.X)
_GAP = r"(?:[ \t]|\\\r?\n)"
#: Import statements, from their first word on.
_IMPORT = re.compile(rf"import{_GAP}++[\w.]++(?:{_GAP}++as{_GAP}++\w++)?+(?:{_GAP}*+,{_GAP}*+[\w.]++(?:{_GAP}++as{_GAP}++\w++)?+)*+"
                     rf"|from{_GAP}++\.*+[\w.]*+{_GAP}++import\b")
#: Literal text up to a quote, a brace or a line end.
_QUOTES = ('"""', "'''", '"', "'")
_TEXT = {q: re.compile(rf"(?:[^{q[0]}\\]++|\\[\s\S]|{q[0]}(?!{q[0] * 2}))*+" if len(q) == 3 else rf"(?:[^{q}\\\n]++|\\[\s\S])*+") for q in _QUOTES}
_HOLED = {q: re.compile(rf"(?:[^{q[0]}\\{{}}{'' if len(q) == 3 else chr(92) + 'n'}]++|\\N\{{[^{{}}\n]*+\}}|\\[^{{}}]|\\(?=[{{}}])|\{{\{{|\}}"
                        + (rf"|{q[0]}(?!{q[0] * 2})" if len(q) == 3 else "") + ")*+") for q in _QUOTES}
_SPEC = {q: re.compile(rf"[^{{}}\n{q[0]}]*+") for q in _QUOTES}

# ---------------------------------------------------------------------------
# Words of the language that are no functions.
_WORDS = {"and", "as", "assert", "async", "await", "del", "elif", "else", "except", "for", "from", "global", "if", "import", "in", "is", "lambda",
          "nonlocal", "not", "or", "pass", "raise", "return", "while", "with", "yield"}
# ---------------------------------------------------------------------------
_PAIR = {")": "(", "]": "[", "}": "{"}
_skip = skipper({*_WORDS, "def", "class"})


class Scan:
    """``calls``: (place of the bracket, base, function) in the order of the
    brackets; ``imports``: import statements as written; ``literals``: (start, end)
    of strings, f-strings with their holes, and again of the strings inside holes.
    A ``limit`` above 0 stops after so many tokens."""

    def __init__(self, text: str, limit: int = 0):
        self.text, self.limit = text, limit
        self.calls: list[tuple[int, str, str]] = []
        self.imports: list[str] = []
        self.literals: list[tuple[int, int]] = []
        # open: (bracket, its call or None), ("f", start, quote), ("hole", None), ("spec", None)
        self.stack: list[tuple] = []
        self.depth = {"(": 0, "[": 0, "{": 0}
        self._run()
        self.calls.sort()

    def _run(self) -> None:
        text, n, pos = self.text, len(self.text), 0
        blank, token = _BLANK.match, _TOKEN.match
        ended = ("", None, False)
        # the value that has just ended: None, or (leftmost plain name, last name, dotted)
        value: tuple[str, str | None, bool] | None = None
        dot = defined = False
        ask = 0  # where the next run of plain words may begin
        while True:
            at = blank(text, pos).end()
            if at >= n:
                break
            if self.limit:
                self.limit -= 1
                if not self.limit:
                    break
            elif at >= ask and not defined and text[at].isalpha() and not (self.stack and self.stack[-1][0] == "hole"):
                place, _, ask = _skip(text, at)
                if place > at:
                    at, value, dot = place, None, False
            m = token(text, at)
            kind, word, pos = m.lastgroup, m.group(), m.end()
            if kind == "name":
                if dot:
                    value, dot = (value[0] if value else "", word, True), False
                elif defined:
                    value, defined = None, False
                elif word in ("def", "class"):
                    value, defined = None, True
                elif word in _WORDS:
                    value = None
                    if word in ("import", "from") and (found := _IMPORT.match(text, at)):
                        self.imports.append(found.group())
                        pos = found.end()
                else:
                    value = (word, word, False)
            elif kind == "string":
                dot = defined = False
                quote = word.lstrip("rRbBfFtTuU")
                if {"f", "t"} & set(word[:-len(quote)].lower()):
                    self.stack.append(("f", at, quote))
                    pos, hole = self._literal(pos)
                    value = None if hole else ended
                else:
                    pos = _TEXT[quote].match(text, pos).end()
                    pos += len(quote) if text.startswith(quote, pos) else 0
                    self.literals.append((at, pos))
                    value = ended
            elif kind == "number":
                value, dot = ended, False
            elif word == ".":
                dot = True
            elif word in "([{":
                call = None
                if word == "(" and value is not None and value[1] is not None:
                    call = (at, value[0] if value[2] else "", value[1])
                self.stack.append((word, call))
                self.depth[word] += 1
                value, dot, defined = None, False, False
            elif word in _PAIR:
                value, dot = ended, False
                if word == "}" and self.stack and self.stack[-1][0] == "hole":
                    self.stack.pop()
                    pos, hole = self._spec(pos) if self.stack[-1][0] == "spec" else self._literal(pos)
                    value = None if hole else ended
                    continue
                own = _PAIR[word]
                if not self.depth[own]:
                    continue
                while self.stack[-1][0] != own:
                    self._drop(at)
                call = self.stack.pop()[1]
                self.depth[own] -= 1
                if call is not None:
                    self.calls.append(call)
            elif word == ":" and self.stack and self.stack[-1][0] == "hole":
                self.stack[-1] = ("spec", None)
                pos, hole = self._spec(pos)
                value = None if hole else ended
            elif word == "\n" and self.stack:
                pass  # brackets and holes go on
            else:
                value, dot = None, False
        while self.stack:
            self._drop(n)

    def _drop(self, at: int) -> None:
        """Close what is never closed; a call is one all the same."""
        kind, *rest = self.stack.pop()
        if kind == "f":
            self.literals.append((rest[0], at))
        elif kind in self.depth:
            self.depth[kind] -= 1
            if rest[0] is not None:
                self.calls.append(rest[0])

    def _literal(self, pos: int) -> tuple[int, bool]:
        """Go on in the f-string on top of the stack, up to its end or (True) its next hole."""
        _, start, quote = self.stack[-1]
        end = _HOLED[quote].match(self.text, pos).end()
        if self.text.startswith("{", end):
            self.stack.append(("hole", None))
            return end + 1, True
        end += len(quote) if self.text.startswith(quote, end) else 0
        self.stack.pop()
        self.literals.append((start, end))
        return end, False

    def _spec(self, pos: int) -> tuple[int, bool]:
        """Go on in the format specification on top of the stack: up to a hole of its own, or its end and then the f-string's."""
        end = _SPEC[self.stack[-2][2]].match(self.text, pos).end()
        if self.text.startswith("{", end):
            self.stack.append(("hole", None))
            return end + 1, True
        self.stack.pop()
        return self._literal(end + self.text.startswith("}", end))
