"""SentencePiece models on the tokenizers library: the model file is read, and its tokenizer rebuilt."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

MARK = "▁"  # stands for a space
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file holds; the defaults are the format's."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def read(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        out = cls()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                out.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                out.kind, out.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                out.char_map = spec.get(2, b"")
                out.dummy_prefix, out.trim_spaces, out.escape_spaces = (bool(spec.get(i, 1)) for i in (3, 4, 5))
        return out

    def merges(self) -> list[tuple[str, str]]:
        """Every way to join two pieces to a third, the best third first."""
        normal = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER, UNUSED)}
        order = sorted(normal, key=lambda p: (-self.pieces[normal[p]][1], normal[p]))
        return [
            (p[:i], p[i:])
            for p in order
            for i in sorted((i for i in range(1, len(p)) if p[:i] in normal and p[i:] in normal), key=lambda i: (normal[p[:i]], normal[p[i:]]))  # noqa: B023
        ]

    def tokenizer(self) -> Tokenizer:
        unknown = next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), None)
        if self.kind == BPE:
            model = models.BPE(
                vocab={p: i for i, (p, _, _) in enumerate(self.pieces)}, merges=self.merges(), fuse_unk=True,
                unk_token=None if unknown is None else self.pieces[unknown][0], byte_fallback=self.byte_fallback,
            )
        elif self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=unknown, byte_fallback=self.byte_fallback)
        else:
            raise ValueError(f"model type {self.kind} is neither unigram nor BPE")
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.char_map)] if self.char_map else []
        if self.trim_spaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        if not any(MARK in p.lstrip(MARK) for p, _, _ in self.pieces):
            # no piece reaches over a space, so words can be looked up one by one
            out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        out.add_tokens([AddedToken(p, normalized=False) for p, _, kind in self.pieces if kind == USER])
        tail = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
        return out
