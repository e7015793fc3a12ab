"""Text to token ids with a memory of the words seen before.

Encoders cut a text where no token can cross, look each piece up, and encode only new
pieces; a text is encoded by joining packed ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

MEMO_ENTRIES = 400_000  # pieces kept in a worker; cleared beyond, which costs time only


class Memo:
    """Packed ids (little-endian unsigned 32 bit) of pieces of text."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def encode_new(self, parts: Iterable[str]) -> Iterable[tuple[str, bytes]]:
        raise NotImplementedError

    def packed(self, text: str | None) -> bytes:
        return self.packed_all([text])[0]

    def packed_all(self, texts: list[str | None]) -> list[bytes]:
        """Null and empty texts have no ids. All new pieces are encoded together."""
        parts = [self.split(t) if t else [] for t in texts]
        known = self.known
        new = set().union(*parts).difference(known)
        if len(known) + len(new) > MEMO_ENTRIES:
            known.clear()
            new = set().union(*parts)
        if new:
            known.update(self.encode_new(new))
        return [b"".join(map(known.__getitem__, p)) for p in parts]


# Letters before one of these marks always end a token there, so that a word is
# remembered without what follows it.
_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,*#$%&!?;:|])"
split_dropped = re.compile(rf"{_WORD}|[^ \t\r\n]+").findall
_blanks_and_run = re.compile(rf"[ \t\r\n]*+{_WORD}|[ \t\r\n]*+[^ \t\r\n]+|[ \t\r\n]+").findall
_other_blank = re.compile(r"[^\S \t\r\n]").search


def split_leading(text: str) -> list[str]:
    """Cut before each blank that follows a non-blank, and after words: there a token
    always ends.

    With white space other than the four ASCII blanks a run may mix both kinds, and
    the text stays whole."""
    return [text] if _other_blank(text) else _blanks_and_run(text)
