"""One pass over Ruby text: its string literals.

Quoted strings, percent literals with nesting delimiters, heredocs queued until
the line ends, command strings, regular expressions, quoted symbols, and code
inside interpolations, to any depth.  Comments, ``=begin`` blocks and what
follows ``__END__`` hold no literals.  It is no parser.  Work and memory are
linear in the text.
"""

from __future__ import annotations

import re

from pkgsift.functions.plain_runs import skipper

_BLANK = re.compile(r"(?:[^\S\n]++|\\\r?\n|#[^\n]*+)*+")
_HEREDOC = re.compile(r"<<([~-]?)(?:([\"'`])([^\"'`\n]++)\2|([^\W\d]\w*+))")
_PERCENT = re.compile(r"%([qQwWiIxrs]?)([^\w\s])")
_CHARACTER = re.compile(r"\?(?:\\[^\n]|[^\s\w]|\w(?!\w))")
_NAME = re.compile(r"(?:@@?|\$)?[^\W\d]\w*+(?:[?!](?![=~]))?+|\$.")
_NUMBER = re.compile(r"\d\w*+(?:\.\d\w*+)?+")
_END_WORD, _END_COMMENT = re.compile(r"^__END__\r?$", re.M), re.compile(r"^=end\b[^\n]*+", re.M)
_BODY = re.compile(r"(?:[^\\#]++|\\[\s\S]|#(?!\{))*+")
_FLAGS = re.compile(r"\w*+")
_PAIR = {"(": ")", "[": "]", "{": "}", "<": ">"}

# ---------------------------------------------------------------------------
# Words after which a value is expected.
_WORDS = {"if", "unless", "while", "until", "and", "or", "not", "when", "in", "case", "return", "then", "else", "elsif", "do", "begin", "rescue", "ensure", "yield",
          "puts", "raise", "require", "system", "exec", "eval"}
# ---------------------------------------------------------------------------
_skip = skipper()


def _text(close: str, open_: str, holes: bool, words: bool) -> re.Pattern[str]:
    """Literal text up to a delimiter, a hole or (in word lists) a blank."""
    marks = re.escape(close) + re.escape(open_) + (r"\s" if words else "")
    return re.compile(rf"(?:[^\\{marks}{'#' if holes else ''}]++|\\[\s\S]{'|#(?!{)' if holes else ''})*+")


class Scan:
    """``literals``: (start, end) of strings, each word of a word list, heredoc
    bodies, command strings, regular expressions and quoted symbols, holes included, and again of
    the literals inside holes.  A ``limit`` above 0 stops after so many tokens."""

    def __init__(self, text: str, limit: int = 0):
        self.text, self.limit = text, limit
        self.literals: list[tuple[int, int]] = []
        self.pending: list[tuple[str, bool, bool]] = []  # heredocs of this line: (tag, may be indented, has holes)
        self.patterns: dict[tuple, re.Pattern[str]] = {}
        # open literals and brackets: ["lit", start, close, open, holes, words, nested], ["doc", start, tag, indented, holes], ["hole"] or ["{"]
        self.stack: list[list] = []
        self._run()

    def _run(self) -> None:
        text, n, pos = self.text, len(self.text), 0
        # whether a value has just ended: "", "name" for a word that may take an argument behind a blank, or "value"
        value = ""
        ask = 0  # where the next run of plain words may begin
        while pos < n:
            if self.limit:
                self.limit -= 1
                if not self.limit:
                    break
            if pos == 0 or text[pos - 1] == "\n":
                if text.startswith("=begin", pos):
                    found = _END_COMMENT.search(text, pos)
                    pos = found.end() if found else n
                    continue
                if not self.stack and _END_WORD.match(text, pos):
                    break
            at = _BLANK.match(text, pos).end()
            if at >= n:
                break
            if at >= ask and not self.limit and not self.pending and text[at].isalpha():
                at, _, ask = _skip(text, at)
                pos = at
            c, after = text[at], text[at + 1:at + 2]
            # behind a name and a blank, a mark with no blank behind it opens an argument
            free = not value or (value == "name" and at > pos and after not in (" ", "\n", "=", ""))
            pos = at + 1
            if c == "\n":
                value = ""
                if self.pending:
                    pos, value = self._heredocs(pos)
            elif c in "'\"`":
                pos, value = self._open(at, pos, c, "", c != "'", False)
            elif c == "%" and free and (m := _PERCENT.match(text, at)):
                kind, d = m.groups()
                pos, value = self._open(at, m.end(), _PAIR.get(d, d), d if d in _PAIR else "", kind not in tuple("qwis"), kind in tuple("wWiI"))
            elif c == "/" and free:
                pos, value = self._open(at, pos, "/", "", True, False)
            elif c == "<" and (m := _HEREDOC.match(text, at)) and (m.group(1) or not value or (free and (m.group(2) or m.group(4)[0].isupper()))):
                self.pending.append((m.group(3) or m.group(4), m.group(1) != "", m.group(2) != "'"))
                pos, value = m.end(), "value"
            elif c == "?" and not value and (m := _CHARACTER.match(text, at)):
                pos, value = m.end(), "value"
            elif c == ":" and after in ("'", '"') and not value:
                pos, value = self._open(at, pos + 1, after, "", after == '"', False)
            elif c == "{":
                self.stack.append(["{"])
                value = ""
            elif c == "}":
                top = self.stack[-1][0] if self.stack else ""
                value = "value"
                if top in ("{", "hole"):
                    self.stack.pop()
                if top == "hole":
                    pos, value = self._resume(pos)
            elif m := _NAME.match(text, at):
                pos = m.end()
                value = "" if m.group() in _WORDS and text[at - 1:at] != "." else "name"
            elif m := _NUMBER.match(text, at):
                pos, value = m.end(), "value"
            else:
                value = "value" if c in ")]" else ""
        for entry in reversed(self.stack):
            if entry[0] in ("lit", "doc"):
                self.literals.append((entry[1], n))

    def _open(self, at: int, pos: int, close: str, open_: str, holes: bool, words: bool) -> tuple[int, str]:
        self.stack.append(["lit", at, close, open_, holes, words, 0])
        return self._resume(pos)

    def _resume(self, pos: int) -> tuple[int, str]:
        """Go on in the literal on top of the stack, up to its end ("value") or its next hole ("")."""
        text, n, top = self.text, len(self.text), self.stack[-1]
        if top[0] == "doc":
            return self._body(pos)
        _, _, close, open_, holes, words, _ = top
        match = self._pattern(close, open_, holes, words).match
        while True:
            pos = match(text, pos).end()
            if pos >= n:
                return n, "value"
            c = text[pos]
            pos += 1
            if c == close and top[6] == 0:
                self.stack.pop()
                self.literals.append((top[1], pos))
                return (_FLAGS.match(text, pos).end() if close == "/" else pos), "value"
            if c == close:
                top[6] -= 1
            elif c == open_:
                top[6] += 1
            elif c == "#":
                self.stack.append(["hole"])
                return pos + 1, ""
            else:  # a blank ends a word of the list
                self.literals.append((top[1], pos - 1))
                top[1] = pos

    def _pattern(self, close: str, open_: str, holes: bool, words: bool) -> re.Pattern[str]:
        key = close, open_, holes, words
        if key not in self.patterns:
            self.patterns[key] = _text(*key)
        return self.patterns[key]

    def _heredocs(self, pos: int) -> tuple[int, str]:
        """Bodies of the heredocs that the line before has named, first one first."""
        self.stack += [["doc", -1, tag, indented, holes, 0, 0] for tag, indented, holes in reversed(self.pending)]
        self.pending = []
        return self._body(pos)

    def _body(self, pos: int) -> tuple[int, str]:
        """Go on in the heredoc on top of the stack; the next one begins behind its tag's line."""
        text, n = self.text, len(self.text)
        while self.stack and self.stack[-1][0] == "doc":
            top = self.stack[-1]
            _, start, tag, indented, holes, end, behind = top
            if start < 0:
                last = re.compile(rf"^{'[ \t]*' if indented else ''}{re.escape(tag)}\r?$", re.M).search(text, pos)
                start, end, behind = pos, last.start() if last else n, min(n, last.end() + 1) if last else n
                top[1], top[5], top[6] = start, end, behind
            if holes and pos < end and (hole := _BODY.match(text, pos, end).end()) < end:
                self.stack.append(["hole"])
                return hole + 2, ""
            self.stack.pop()
            self.literals.append((start, end))
            pos = max(pos, behind)
        return pos, ""
