"""Splitting whole texts into the pieces a BPE vocabulary encodes one by one.

For texts of ASCII and plain Latin letters, lower-casing and one expression
give the same pieces as the vocabulary's normalizer and split pattern (these
letters are stable under NFC, and every library agrees on their class).  Any
other text, and one with a special string, is cut at ASCII white space only and
left to the vocabulary's own normalizer.
"""

from __future__ import annotations

import re

#: Fixed: lower-case Latin letters of ASCII, Latin-1 and Latin Extended-A.
_LOWER = "a-zß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĵķĸĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžſ"
_UPPER = "A-ZÀ-ÖØ-ÞĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮĴĶĹĻĽĿŁŃŅŇŊŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽ"
_PLAIN = re.compile(f"[\x00-\x7f{_LOWER}{_UPPER}]*")
#: Fixed: the split pattern of the vocabulary file, for these letters.
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^\t-\r {_LOWER}0-9]+")
_WORD = re.compile("[^\x20\x09-\x0d]+")


def pieces(text: str, special: re.Pattern[str]) -> tuple[list[str], bool]:
    """(pieces, True) of a plain text, else (words between white space, False)."""
    if _PLAIN.fullmatch(text) and not ("<|" in text and special.search(text)):
        return _PIECE.findall(text.lower()), True
    return _WORD.findall(text), False
