"""One pass over JavaScript or TypeScript text: calls with their extents, and string literals.

What a character means depends on what stands before it: a slash divides after a
value and opens a regular expression elsewhere, a closing brace ends a block or
a template's hole.  So the pass keeps a stack of open brackets, templates and
holes, of any depth, and the value that has just ended.  Comments are dropped
before anything else is looked at.  It is no parser: no tree is built, and text
that is no JavaScript gives the calls and literals that are still readable.

Work and memory are linear in the text, whatever it holds.
"""

from __future__ import annotations

import re

from pkgsift.functions.plain_runs import skipper

_BLANK = re.compile(r"(?:\s++|//[^\n\r\u2028\u2029]*+|/\*(?:[^*]++|\*(?!/))*+\*/)*+")
_TOKEN = re.compile(r"""
  (?P<name>\#?(?:[^\W\d]|[$\\])[\w$\\\u200c\u200d]*+)
 |(?P<string>"(?:[^"\\\n\r]++|\\(?:\r\n|[\s\S]))*+"?+|'(?:[^'\\\n\r]++|\\(?:\r\n|[\s\S]))*+'?+)
 |(?P<number>\.?\d\w*+(?:\.\d\w*+|\.(?![\w$.]))?+)
 |(?P<mark>=>|\?\.(?!\d)|\.\.\.|\+\+|--|[-+*%&|^~<>=?:,;@!]|[^\s])
""", re.X)
_CHUNK = re.compile(r"(?:[^`\\$]++|\\[\s\S]|\$(?!\{))*+")
_REGEX = re.compile(r"/(?:[^\\/\[\n\r]++|\\[^\n\r]|\[(?:[^\]\\\n\r]++|\\[^\n\r])*+\])++/\w*+")
_FLAGS = re.compile(r"\w*+")
_LINE_END = re.compile(r"[\n\r]|\Z")
_TYPE = re.compile(r"=>|[<>]|(?:[\w$\s.,\[\]{}:?'\"()]++|&(?!&)|\|(?!\|))++|=")

# ---------------------------------------------------------------------------
# Words of the language that are no names.
_VALUES = {"this", "super", "null", "true", "false"}
_CONTROL = {"if", "for", "while", "switch", "catch", "with"}
_WORDS = {"return", "typeof", "case", "in", "delete", "void", "throw", "await", "yield", "else", "do", "instanceof", "try", "finally", "default",
          "extends", "export", "const", "var", "break", "continue", "debugger", "enum"}
_BEFORE_MEMBER = {"{", "}", ";", "*", "get", "set", "async", "static", "public", "private", "protected", "readonly", "override", "abstract", "declare", "accessor"}
# ---------------------------------------------------------------------------
_skip = skipper({*_VALUES, *_CONTROL, *_WORDS, "function", "new", "class", "interface", "of", "as", "satisfies", "import"})
_PAIR = {")": "(", "]": "[", "}": "{"}


class _Value:
    """A value that has just ended: where it starts, the leftmost name of a plain
    chain of names (else ""), the last name (None if it ends in none), whether a dot stands before
    that name, what stands before it all, and whether ``new`` waits for its arguments."""

    __slots__ = ("start", "root", "name", "member", "before", "new")

    def __init__(self, start: int, root: str = "", name: str | None = None, member: bool = False, before: str = "", new: bool = False):
        self.start, self.root, self.name, self.member, self.before, self.new = start, root, name, member, before, new


class _Open:
    """An open bracket: its kind, its place, and the value before it, if that is called or indexed."""

    __slots__ = ("mark", "kind", "at", "value")

    def __init__(self, mark: str, kind: str, at: int, value: _Value | None = None):
        self.mark, self.kind, self.at, self.value = mark, kind, at, value


def _regex_ends(text: str, low: int, high: int) -> dict[int, int]:
    """For every slash on a line, the place after the one that closes a regular
    expression opened by it, read from the line's end; none if there is none."""
    found: dict[int, int] = {}
    plain = [-1, -1]  # the end, seen from the next two places: outside and inside a class
    group = [-1, -1]
    for k in range(high - 1, low - 1, -1):
        c = text[k]
        if c == "/" and plain[0] > k + 2:
            found[k] = plain[0]
        here = plain[1] if c == "\\" else group[0] if c == "[" else k + 1 if c == "/" else plain[0]
        inside = group[1] if c == "\\" else plain[0] if c == "]" else group[0]
        plain, group = [here, plain[0]], [inside, group[0]]
    return found


class Scan:
    """The calls and literals of one text.

    ``calls``: (place of the bracket, base, function, start, end), in the order of
    the brackets; ``literals``: (start, end) of strings and templates, holes
    included, and again of the strings inside holes; ``broken`` says that brackets, literals or a
    comment don't close.  ``typed`` reads type arguments between a name and a call's bracket;
    a ``limit`` above 0 stops after so many tokens.
    """

    def __init__(self, text: str, typed: bool = False, limit: int = 0):
        self.text, self.typed, self.limit = text, typed, limit
        self.calls: list[tuple[int, str, str, int, int]] = []
        self.literals: list[tuple[int, int]] = []
        self.broken = False
        self.stack: list[_Open] = []
        self.depth = {"(": 0, "[": 0, "{": 0}
        self.value: _Value | None = None
        self.before = ""  # the token before
        self.dot = False
        self.new: int | None = None
        self.function = False
        self.class_at: int | None = None  # stack depth at which a class body may open
        self.regexes: dict[int, int] = {}
        self.regexes_to = -1
        self.types: dict[int, int] = {}
        self.types_to = -1
        self._run()
        self.calls.sort()

    # -- the pass ---------------------------------------------------------
    def _run(self) -> None:
        text, n = self.text, len(self.text)
        pos = 0
        if text.startswith("#!"):
            pos = _LINE_END.search(text).start()
        blank, token = _BLANK.match, _TOKEN.match
        ask = 0  # where the next run of plain words may begin
        while True:
            at = blank(text, pos).end()
            if at >= n:
                break
            if at >= ask and not self.function and self.class_at is None and not self.limit and text[at].isalpha():
                place, before, ask = _skip(text, at)
                if place > at:
                    self._operand(before)
                    at = place
            if text.startswith("/*", at):  # a comment that never ends
                self.broken = True
                break
            m = token(text, at)
            kind, pos = m.lastgroup, m.end()
            if kind == "name":
                self._name(m.group(), at)
            elif kind == "string":
                self.broken |= pos - at < 2 or text[pos - 1] != text[at]
                self.literals.append((at, pos))
                self._ended(at, "'")
            elif kind == "number":
                self._ended(at, "0")
            else:
                pos = self._mark(m.group(), at, pos)
            if self.limit:
                self.limit -= 1
                if not self.limit:
                    return
        self.broken |= bool(self.stack)
        while self.stack:
            self._drop(n)

    def _ended(self, at: int, before: str) -> None:
        """A value without a name has ended."""
        self.value = _Value(at if self.new is None else self.new, new=self.new is not None)
        self.before, self.dot, self.new, self.function = before, False, None, False

    def _operand(self, before: str) -> None:
        """A value is expected next."""
        self.value, self.before, self.dot, self.new, self.function = None, before, False, None, False

    def _name(self, name: str, at: int) -> None:
        if self.dot:
            v = self.value
            self.value = _Value(v.start, v.root, name, True, v.before, v.new)
            self.before, self.dot = name, False
        elif self.function:
            self.before = name  # the function's own name
        elif name == "function":
            self._operand(name)
            self.function = True
        elif name == "new":
            self._operand(name)
            self.new = at
        elif name in _CONTROL or name in _WORDS:
            self._operand(name)
        elif name in ("class", "interface") and not (name == "interface" and self.value is not None):
            self._operand(name)
            self.class_at = len(self.stack)
        elif name in ("of", "as", "satisfies") and self.value is not None:
            self._operand(name)
        elif name in _VALUES or name == "import":
            self._ended(at, name)
        else:
            self.value = _Value(at if self.new is None else self.new, name, name, False, self.before, self.new is not None)
            self.before, self.new = name, None

    def _mark(self, mark: str, at: int, pos: int) -> int:
        value = self.value
        if mark in ("(", "[", "{"):
            self._open(mark, at)
        elif mark in _PAIR:
            return self._close(mark, at, pos)
        elif mark == "`":
            self.stack.append(_Open("`", "template", at, value if value is not None and not value.new else None))
            return self._template(pos)
        elif mark in (".", "?."):
            if value is None:
                self.value, self.new = _Value(at), None
            self.dot, self.before = True, mark
        elif mark == "/":
            return self._slash(at, pos)
        elif mark in ("++", "--") and value is not None:
            self.before = mark
        elif mark == "<" and self.typed and value is not None and (end := self._type_end(at)) is not None:
            return end
        elif mark == "!" and self.typed and value is not None and self.text[pos:pos + 1] in (".", "(", "["):
            self.value = _Value(value.start)
        else:
            star = mark == "*" and self.function  # function* name(
            if mark in ":,;=" and self.class_at == len(self.stack):
                self.class_at = None  # "class" was a name
            self._operand(mark)
            self.function = star
        return pos

    def _slash(self, at: int, pos: int) -> int:
        if self.value is not None:
            self._operand("/")
            return pos
        if at >= self.regexes_to:
            m = _REGEX.match(self.text, at)
            if m:
                self._ended(at, "/")
                return m.end()
            # none here: look at the rest of the line once, from its end
            self.regexes_to = _LINE_END.search(self.text, at).start()
            self.regexes = _regex_ends(self.text, at, self.regexes_to)
        end = self.regexes.get(at)
        if end is None:
            self._operand("/")
            return pos
        self._ended(at, "/")
        return _FLAGS.match(self.text, end).end()

    def _type_end(self, at: int) -> int | None:
        """The place after type arguments that open at ``at`` and stand before a call's bracket."""
        if at >= self.types_to:
            open_, k = [], at
            while m := _TYPE.match(self.text, k):
                if m.group() == "<":
                    open_.append(k)
                elif m.group() == ">":
                    if not open_:
                        break
                    self.types[open_.pop()] = k + 1
                k = m.end()
                if not open_:
                    break
            self.types_to = max(k, at + 1)
        end = self.types.get(at)
        return end if end is not None and self.text.startswith(("(", "`"), _BLANK.match(self.text, end).end()) else None

    # -- brackets ---------------------------------------------------------
    def _open(self, mark: str, at: int) -> None:
        value, kind = self.value, "group"
        self.dot = False
        if mark == "(":
            if self.function:
                kind, value = "block", None
            elif value is not None and value.new:
                kind = "new"
            elif value is not None:
                kind = "call"
            elif self.before in _CONTROL or self.before == "await":
                kind = "control"
            elif self.new is not None:
                kind, value = "maker", _Value(self.new)
        elif mark == "[":
            kind = "index" if value is not None else "group"
        else:
            kind, value = self._brace(), None
        self.stack.append(_Open(mark, kind, at, value))
        self.depth[mark] += 1
        self._operand(mark)

    def _brace(self) -> str:
        if self.class_at == len(self.stack):
            self.class_at = None
            return "class"
        if self.value is not None or self.before in ("", "{", "}", ";", ")", "=>", "else", "do", "try", "finally"):
            return "block"
        if self.before == ":":
            return "object" if self.stack and self.stack[-1].kind not in ("block", "class", "hole") else "block"
        return "object"

    def _close(self, mark: str, at: int, pos: int) -> int:
        own = _PAIR[mark]
        if not self.depth[own]:
            self.broken = True
            if mark != "}":
                self._ended(at, mark)
            else:
                self._operand(mark)
            return pos
        while self.stack[-1].mark != own:
            self.broken = True
            self._drop(at)
        top = self.stack.pop()
        self.depth[own] -= 1
        if self.class_at is not None and self.class_at > len(self.stack):
            self.class_at = None
        if top.kind == "hole":
            return self._template(pos)
        if top.kind == "call":
            self._called(top, pos)
        if top.kind in ("block", "control"):
            self._operand(mark)
        elif top.kind == "maker":
            self.value = _Value(top.value.start, new=True)
            self.before, self.new = mark, None
        else:
            start = top.value.start if top.value is not None else top.at
            self._ended(start, mark)
        return pos

    def _drop(self, at: int) -> None:
        """End what is never closed at ``at``; a call is one all the same."""
        gone = self.stack.pop()
        if gone.mark == "`":
            self.literals.append((gone.at, at))
            return
        self.depth[gone.mark] -= 1
        if gone.kind == "call":
            self._called(gone, at)

    def _called(self, top: _Open, end: int) -> None:
        v = top.value
        if v.name is None:
            return
        if not v.member:
            here = self.stack[-1].kind if self.stack else "block"
            if here == "class" and v.before in _BEFORE_MEMBER:
                return  # a method of the class
            after = _BLANK.match(self.text, end).end()
            if self.text.startswith("=>", after) and v.name == "async":
                return
            # a brace follows: a method of an object or class, and in other places only on the same line
            if self.text.startswith("{", after) and self.class_at != len(self.stack) and (here in ("class", "object") or "\n" not in self.text[end:after]):
                return
        self.calls.append((top.at, v.root if v.member else "", v.name, v.start, end))

    def _template(self, pos: int) -> int:
        """Go on in the template on top of the stack, up to its end or its next hole."""
        end = _CHUNK.match(self.text, pos).end()
        top = self.stack[-1]
        if end >= len(self.text):
            self.broken = True
            return end  # what is open is dropped at the end
        if self.text[end] == "$":
            self.stack.append(_Open("{", "hole", end))
            self.depth["{"] += 1
            self._operand("{")
            return end + 2
        self.stack.pop()
        self.literals.append((top.at, end + 1))
        if top.value is not None and top.value.name is not None:
            v = top.value
            self.calls.append((top.at, v.root if v.member else "", v.name, v.start, end + 1))
        self._ended(top.value.start if top.value is not None else top.at, "`")
        return end + 1
