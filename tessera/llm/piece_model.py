"""Reading a SentencePiece model file: pieces, scores, kinds and two flags."""

from __future__ import annotations

import struct
from dataclasses import dataclass

# Fixed values of the file format: kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes):
    """``(number, value)`` of a protobuf message; values are ints or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        number, wire = tag >> 3, tag & 7
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, data[at:at + size]
            at += size


@dataclass
class PieceModel:
    """``pieces[i]`` is ``(text, score, kind)`` of id i."""

    pieces: list[tuple[str, float, int]]
    dummy_prefix: bool
    squeeze_spaces: bool

    @classmethod
    def read(cls, data: bytes) -> PieceModel:
        pieces, prefix, squeeze = [], True, True
        for number, value in _fields(data):
            if number == 1:
                text, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        text = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                pieces.append((text, score, kind))
            elif number == 3:
                rules = dict(_fields(value))
                if rules.get(2):
                    raise ValueError("models with a normalisation map are not supported")
                prefix, squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        return cls(pieces, prefix, squeeze)
