"""Units and merge table of a SentencePiece pair-encoding model with byte fallback.

Supported models: identity normalisation, a dummy prefix, white space kept, no user-defined pieces, and no piece with
a space mark after another character. Others are refused.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from wearcurve.llm.merging import PairTable, gather, merge_all
from wearcurve.llm.units import MEMO_UNITS, Ragged, by_text, space_table

MARK = "▁"
SPACE = space_table(b" ")
#: Bytes of texts whose words are found together.
CHUNK_BYTES = 500_000
_MARK = MARK.encode()
# A run of space marks with what follows it, a run alone, or a line break: no piece reaches across these cuts.
_UNIT = re.compile(rf"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_INSIDE = re.compile(rf"[^{MARK}]{MARK}")


class PieceBpe:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        with open(path, "rb") as f:
            model = ModelProto.FromString(f.read())
        normal, kinds = model.normalizer_spec, ModelProto.SentencePiece.Type
        usual = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        fits = (
            model.trainer_spec.model_type == 2
            and model.trainer_spec.byte_fallback
            and not normal.precompiled_charsmap
            and normal.add_dummy_prefix
            and not normal.remove_extra_whitespaces
            and normal.escape_whitespaces
            and not any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)
            and not any(_INSIDE.search(p) or "\n" in p for _, p, _ in usual)
        )
        if not fits:
            raise ValueError(f"{path}: a model of another kind")
        self.library = SentencePieceProcessor(model_proto=model.SerializeToString())
        ids = {p: i for i, p, _ in usual}
        ranks = {s: r for r, s in enumerate(sorted({s for _, _, s in usual}, reverse=True))}
        made = [
            (ids[p[:k]], ids[p[k:]], ranks[s], i)
            for i, p, s in usual
            for k in range(1, len(p))
            if p[:k] in ids and p[k:] in ids
        ]
        self.table = PairTable(*zip(*made))
        self.size = len(model.pieces)
        # An unknown character stands as the number after the last id plus its code point until it becomes bytes.
        self.of_code = np.arange(0x110000, dtype=np.int32) + self.size
        for p, i in ids.items():
            if len(p) == 1:
                self.of_code[ord(p)] = i
        self.of_byte = np.zeros(256, np.int32)
        for i, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                self.of_byte[int(p.piece[1:-1], 16)] = i

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, flat, and their numbers, by merge rounds over all of them."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        symbols, left = merge_all(self.of_code[codes], lengths, self.table)
        strange = np.flatnonzero(symbols >= self.size)
        if not len(strange):
            return symbols, left
        owner = np.repeat(np.arange(len(units)), left)
        raw = [chr(c).encode() for c in (symbols[strange] - self.size).tolist()]
        wide = np.ones(len(symbols), np.int64)
        wide[strange] = [len(r) for r in raw]
        out = np.repeat(symbols, wide)
        out[np.repeat(symbols >= self.size, wide)] = self.of_byte[np.frombuffer(b"".join(raw), np.uint8)]
        return out, np.bincount(owner, weights=wide, minlength=len(units)).astype(np.int64)


@lru_cache(2)
def load(path: str) -> PieceBpe:
    return PieceBpe(path)


class Pieces:
    """Ids of texts by merge rounds; distinct words are encoded once.

    A word is what stands between single spaces. A text with other runs of spaces or with space marks of its own is
    cut into units instead.
    """

    def __init__(self, bpe: PieceBpe, limit: int = MEMO_UNITS):
        self.bpe, self.units, self.words = bpe, Ragged(bpe.encode, limit), Ragged(self.fresh, limit)

    def fresh(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.of_units([self.bpe.units(w.decode()) for w in words])

    def of_units(self, each: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        return self.units([u for units in each for u in units], [len(units) for units in each])

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the number of each."""
        odd = [i for i, t in enumerate(texts) if t[:1] == b" " or t[-1:] == b" " or b"  " in t or _MARK in t]
        if not odd:
            return by_text(texts, SPACE, lambda run: self.words.of_texts(run, SPACE), CHUNK_BYTES)
        plain = sorted(set(range(len(texts))).difference(odd))
        flat, sizes = self([texts[i] for i in plain])
        values, more = self.of_units([self.bpe.units(texts[i].decode()) for i in odd])
        flat, sizes = np.concatenate((flat, values)), np.concatenate((sizes, more))
        order = np.argsort(np.array(plain + odd, np.int64))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        return gather(flat, offsets, order), sizes[order]


@lru_cache(1)
def pieces(path: str, limit: int = MEMO_UNITS) -> Pieces:
    return Pieces(load(path), limit)
