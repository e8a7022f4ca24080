"""A JSON object that comes in pieces: whether it is one, and what it has at its top."""

from __future__ import annotations

import codecs
import json
import re

_SPACE, _BEHIND = re.compile(r"[ \t\r\n]*"), set(" \t\r\n,:]}")


def _constant(name: str) -> None:
    raise ValueError(name)


_DECODER = json.JSONDecoder(parse_constant=_constant)


class Members:
    """An object that add() takes in, bytes after bytes, and of which it holds no more than a member, or an element of a
    member that is an array, and what came with it. end() tells whether it is a JSON object whose member name isn't null;
    what follows the object is passed over."""

    def __init__(self, name: str) -> None:
        self.name, self.found, self.bad = name, False, False
        self.text, self.held, self.need, self.key = codecs.getincrementaldecoder("utf-8")("replace"), "", 1, None
        self.wants = "{"  # m: a member or the end, k: a member, e: an element or the end, v: an element, . the rest

    def add(self, data: bytes) -> None:
        if not self.bad and self.wants != ".":
            self.held += self.text.decode(data)
            if len(self.held) >= self.need:
                self._taken(False)

    def end(self) -> bool:
        self.held += self.text.decode(b"", True)
        if not self.bad and self.wants != ".":
            self._taken(True)
        return self.found and not self.bad and self.wants == "."

    def _taken(self, last: bool) -> None:
        """Goes on as far as what is held goes. What is begun is tried again when twice as much is held."""
        at = 0
        while not self.bad and self.wants != "." and (then := self._step(_SPACE.match(self.held, at).end(), last)) is not None:
            at = then
        self.held = "" if self.bad or self.wants == "." else self.held[at:]
        self.need = 2 * len(self.held)

    def _value(self, at: int, last: bool) -> tuple[object, int] | None:
        """The value at a place and the place behind it; None if it may go on."""
        try:
            value, then = _DECODER.raw_decode(self.held, at)
        except ValueError:
            self.bad = last
            return None
        return (value, then) if last or self.held[then : then + 1] in _BEHIND else None  # else a number may go on

    def _step(self, at: int, last: bool) -> int | None:
        if at >= len(self.held):
            self.bad = last
            return None
        sign, wants = self.held[at], self.wants
        if (wants, sign) in _SIGNS:
            self.wants = _SIGNS[wants, sign]
            return at + 1
        if wants in "mk" and sign == '"':
            if (got := self._value(at, last)) is not None:
                self.key, self.wants = got[0], ":"
                return got[1]
        elif wants == "value" and sign == "[":
            self.wants = "e"
            self.found |= self.key == self.name
            return at + 1
        elif wants in ("value", "e", "v"):
            if (got := self._value(at, last)) is not None:
                self.found |= wants == "value" and self.key == self.name and got[0] is not None
                self.wants = ",}" if wants == "value" else ",]"
                return got[1]
        else:
            self.bad = True
        return None


#: What is wanted behind a sign, by what is wanted before it.
_SIGNS = {("{", "{"): "m", ("m", "}"): ".", (":", ":"): "value", (",}", ","): "k", (",}", "}"): ".", ("e", "]"): ",}", (",]", ","): "v", (",]", "]"): ",}"}
