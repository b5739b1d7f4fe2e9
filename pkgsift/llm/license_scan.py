"""License scans (operator 3): phrases by Aho-Corasick, expressions by shunting-yard.

A text is lower-cased (A-Z) and cut into words of letters, digits and non-ASCII
characters.  One Aho-Corasick automaton over ``" word word … "`` finds all
phrases where their words stand consecutively, overlaps included.  Where an
identifier tag stands, the raw text behind it is read as a licence expression:
identifiers joined by AND, OR and WITH with parentheses, ordered by a
shunting-yard parser and evaluated.

The score is the strength of the obligations found, 0 (none) to 1 (all rights
reserved): OR takes the weaker side, AND the stronger one, WITH lessens its
licence by a quarter; a document takes its strongest finding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import bounded_batches

#: Phrase -> label of the base.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Phrases this operator adds: notices of well-known licences.
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "creative commons": "cc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "proprietary and confidential": "proprietary",
    "permission to use copy modify and or distribute this software": "isc",
    "isc license": "isc",
    "boost software license": "bsl",
    "this software is provided as is without any express or implied warranty in no event": "zlib",
    "zlib license": "zlib",
    "this is free and unencumbered software": "unlicense",
    "do what the fuck you want to public license": "wtfpl",
    "artistic license": "artistic",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "sil open font license": "ofl",
    "python software foundation license": "psf",
    "business source license": "busl",
    "server side public license": "sspl",
}
#: Words before a colon that introduce an expression: the identifier tag, and the
#: field of package metadata, whose expression must name known licences only.
TAGS = ("spdx license identifier", "license", "licence")
#: Strength of each label's obligations.
STRENGTH = {
    "cc0": 0.05, "public-domain": 0.05, "mit": 0.1, "bsd": 0.1, "apache": 0.15, "cc": 0.2, "cc-by": 0.2, "mpl": 0.4,
    "cc-by-sa": 0.5, "lgpl": 0.5, "cc-by-nd": 0.6, "cc-by-nc": 0.7, "gpl": 0.75, "agpl": 0.85, "proprietary": 0.95, "reserved": 1.0,
    "0bsd": 0.05, "unlicense": 0.05, "wtfpl": 0.05, "isc": 0.1, "bsl": 0.1, "zlib": 0.1, "psf": 0.15, "artistic": 0.3, "ofl": 0.3,
    "epl": 0.4, "cddl": 0.4, "eupl": 0.6, "busl": 0.9, "sspl": 0.9,
}
#: Strength of an identifier of no known family.
UNKNOWN = 0.5
_SPACE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TAG = re.compile(rb"spdx[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+license[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+identifier[ \t]*:", re.I)
_FIELD = re.compile(rb"(?:\A|(?<=[\r\n]))[ \t#*;\"'/-]*licen[sc]e[\"']?[ \t]*[:=]", re.I)
_TOKEN = re.compile(rb"[()/]|[A-Za-z0-9.+:-]+")
_LINE = re.compile(rb"[^\r\n]*")
#: Binding strength of the operators.
PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}


@dataclass(frozen=True)
class Expression:
    """A parsed licence expression: identifiers in order, and its strength."""

    identifiers: tuple[str, ...]
    strength: float


def family(identifier: str) -> str | None:
    """The label of an identifier such as ``GPL-3.0-or-later``, ``GPLv2`` or ``LGPL3+``, or None."""
    x = identifier.lower()
    found = [name for name in STRENGTH if re.match(rf"{re.escape(name)}(?:\Z|-|\+\Z|v?\d)", x)]
    return max(found, key=len, default=None)


def postfix(tokens: list[str]) -> list[str] | None:
    """Operators behind their operands (shunting-yard); None if not well-formed."""
    out: list[str] = []
    held: list[str] = []
    operand = False  # whether an operand has just ended
    for t in tokens:
        op = t.upper()
        if op in PRECEDENCE:
            if not operand:
                return None
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[op]:
                out.append(held.pop())
            held.append(op)
            operand = False
        elif t == "(":
            if operand:
                return None
            held.append(t)
        elif t == ")":
            if not operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        else:
            if operand:
                return None
            out.append(t)
            operand = True
    if not operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(tokens: list[str]) -> Expression | None:
    """Identifiers and strength of an expression's tokens; None if not well-formed."""
    order = postfix(tokens)
    if order is None:
        return None
    stack: list[float] = []
    names: list[str] = []
    for t in order:
        if t in PRECEDENCE:
            b, a = stack.pop(), stack.pop()
            stack.append(min(a, b) if t == "OR" else max(a, b) if t == "AND" else 0.75 * a)
        else:
            names.append(t)
            stack.append(STRENGTH.get(family(t) or "", UNKNOWN))
    return Expression(tuple(names), stack[0])


def expression_after(text: bytes, at: int) -> Expression | None:
    """The expression that starts at ``at`` and ends with its line: the longest
    well-formed run of tokens."""
    # a slash between two licences is an OR, as older metadata writes it
    tokens = ["OR" if m.group() == b"/" else m.group().decode() for m in _TOKEN.finditer(text, at, _LINE.match(text, at).end())]
    # words behind the expression (an operand after an operand) end it
    depth, operand, end, best = 0, False, 0, None
    for k, t in enumerate(tokens):
        name = t not in "()" and t.upper() not in PRECEDENCE
        if operand and (name or t == "("):
            break
        depth += (t == "(") - (t == ")")
        operand = name or t == ")"
        if depth < 0:
            break
        if operand and depth == 0:
            end = k + 1
    if end:
        best = evaluate(tokens[:end])
    return best


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase, label in {**BASE, **NOTICES}.items():
        a.add_word(f" {phrase} ", (phrase in BASE, label, len(phrase)))
    for tag in TAGS:
        a.add_word(f" {tag} ", (False, None, len(tag)))
    a.make_automaton()
    return a


@dataclass(frozen=True)
class Scan:
    n_words: int
    base: tuple[tuple[int, str], ...]  # (first word, label) of each base place
    labels: tuple[str, ...]
    expressions: tuple[str, ...]
    score: float


def scan(text: bytes) -> Scan:
    words = text.translate(_SPACE).split()
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    base, labels, score, tagged = [], set(), 0.0, False
    counted, at = 0, 0
    for end, (is_base, label, size) in automaton().iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        score = max(score, STRENGTH[label])
        if is_base:
            start = end - size - 1  # the blank before the phrase
            if start >= at:
                counted += line.count(" ", at, start)
                base.append((counted, label))
                at = start
            else:
                base.append((line.count(" ", 0, start), label))
    expressions = []
    if tagged:
        places = [(m.end(), False) for m in _TAG.finditer(text)] + [(m.end(), True) for m in _FIELD.finditer(text)]
        for place, known in sorted(places):
            found = expression_after(text, place)
            if found and not (known and any(family(i) is None for i in found.identifiers)):
                expressions.append(" ".join(found.identifiers))
                score = max(score, found.strength)
                labels.update(f for i in found.identifiers if (f := family(i)))
    return Scan(len(words), tuple(sorted(base)), tuple(sorted(labels)), tuple(expressions), score)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places array<int> (first words of base places), expressions array<string>.

    One row per input row, repeated rows included.  A null or empty text has no
    words, null places, empty labels and score 0.  Texts of any length are
    scanned whole; a malformed expression is no finding.  Other columns are
    ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [scan(x.as_py() or b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0),
                "n_words": pa.array([s.n_words for s in got], pa.int64()),
                "n_base": pa.array([len(s.base) for s in got], pa.int64()),
                "first_word": pa.array([s.base[0][0] if s.base else None for s in got], pa.int64()),
                "last_word": pa.array([s.base[-1][0] if s.base else None for s in got], pa.int64()),
                "base_labels": pa.array([",".join(sorted({b for _, b in s.base})) for s in got], pa.string()),
                "labels": pa.array([",".join(s.labels) for s in got], pa.string()),
                "score": pa.array([s.score for s in got], pa.float64()),
                "places": pa.array([[k for k, _ in s.base] for s in got], pa.list_(pa.int32())),
                "expressions": pa.array([list(s.expressions) for s in got], pa.list_(pa.string())),
            })

    kind = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
            "score double, places array<int>, expressions array<string>")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, kind)
