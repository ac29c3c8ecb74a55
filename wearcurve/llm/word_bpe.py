"""Pre-tokens and merge table of a lower-casing word-level pair encoding, read from a tokenizers file.

Supported files: NFC, white space collapsed, lower case; split by the pattern below; byte-level letters with an
end-of-word mark on the last one. Others are refused.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

from wearcurve.llm.merging import PairTable, merge_all
from wearcurve.llm.units import ASCII_SPACE, MEMO_UNITS, Ragged

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: the file's split pattern.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters of which this module knows class and lower case without doubt; texts of these alone take the short way.
_PLAIN_LETTERS = "a-zß-öø-ÿ"
_OTHER = re.compile(r"[^\x00-\x7F\xC0-\xD6\xD8-\xF6\xF8-\xFF]")
_PLAIN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_PLAIN_LETTERS}]+|[0-9]|[^\x20\x09-\x0D{_PLAIN_LETTERS}0-9]+")
#: Units that the library gets as one text.
JOINED = 5_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or split["pattern"] != {"Regex": SPLIT}:
            raise ValueError(f"{path}: not a word-level pair encoding with end-of-word marks")
        self.library = Tokenizer.from_file(path)
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.inside = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + "</w>"] for c in letters], np.int32)
        self.ends = np.zeros(1 + max(max(vocab.values()), *self.special.values()), bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = PairTable(
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)), [vocab[a + b] for a, b in pairs]
        )

    def units(self, chunk: str) -> list[str]:
        """Pre-tokens of a chunk between ASCII white space, or the chunk if it holds unusual characters or marks.

        Tokens of the units, one after the other, are the tokens of a text: no rule of the file looks across
        ASCII white space.
        """
        if _OTHER.search(chunk) or "<|" in chunk:
            return [chunk]
        return _PLAIN.findall(chunk.lower())

    def pieces(self, unit: str) -> list[bytes | None]:
        """Pre-tokens of a unit as bytes; None is one special token."""
        if not _OTHER.search(unit) and "<|" not in unit:
            return [unit.encode()]
        out: list[bytes | None] = []
        for i, part in enumerate(self.marks.split(unit) if self.marks else [unit]):
            if i % 2:
                out.append(None)
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                    out.append(bytes(map(self.byte_of.__getitem__, letters)))
        return out

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of all units, flat, and their numbers.

        Plain units are single pre-tokens, so the library gets them joined by spaces, and an end-of-word token ends
        each. Other units go to it one by one.
        """
        plain = [i for i, u in enumerate(units) if not _OTHER.search(u) and "<|" not in u]
        odd = sorted(set(range(len(units))).difference(plain))
        lines = [" ".join([units[i] for i in plain[k : k + JOINED]]) for k in range(0, len(plain), JOINED)]
        got = [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast(lines, add_special_tokens=False)]
        flat = np.concatenate([*got, np.empty(0, np.int32)])
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(plain):
            raise ValueError("the vocabulary has words without an end mark")
        alone = [e.ids for e in self.library.encode_batch_fast([units[i] for i in odd], add_special_tokens=False)]
        sizes = np.zeros(len(units), np.int64)
        sizes[plain] = np.diff(stops, prepend=0)
        sizes[odd] = [len(ids) for ids in alone]
        if not odd:
            return flat, sizes
        flat = np.concatenate((flat, np.array([i for ids in alone for i in ids], np.int32)))
        order = np.array(plain + odd)
        owner = np.repeat(order, sizes[order])
        return flat[np.argsort(owner, kind="stable")], sizes

    def count(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit, by merge rounds over all of them."""
        pieces, owner, special = [], [], np.zeros(len(units), np.int64)
        for i, unit in enumerate(units):
            for piece in self.pieces(unit):
                if piece is None:
                    special[i] += 1
                elif piece:
                    pieces.append(piece)
                    owner.append(i)
        if not pieces:
            return special
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        codes = np.frombuffer(b"".join(pieces), np.uint8)
        symbols, ends = self.inside[codes], np.cumsum(lengths) - 1
        symbols[ends] = self.last[codes[ends]]
        _, left = merge_all(symbols, lengths, self.table)
        return special + np.bincount(owner, weights=left, minlength=len(units)).astype(np.int64)


@lru_cache(2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


class ByChunk:
    """Values of texts from those of their chunks between white space, and these from the values of their units."""

    def __init__(self, bpe: WordBpe, work: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.bpe, self.units, self.chunks = bpe, Ragged(work, limit), Ragged(self.fresh, limit)

    def fresh(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat: list[str] = []
        sizes = []
        for chunk in chunks:
            units = self.bpe.units(chunk.decode())
            flat += units
            sizes.append(len(units))
        return self.units(flat, sizes)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.chunks.of_texts(texts, ASCII_SPACE)


@lru_cache(1)
def library_ids(path: str, limit: int = MEMO_UNITS) -> ByChunk:
    """Token ids of texts from the library; distinct units are encoded once."""
    bpe = load(path)
    return ByChunk(bpe, bpe.encode, limit)


@lru_cache(1)
def merged_counts(path: str, limit: int = MEMO_UNITS) -> ByChunk:
    """Tokens of the units of texts by merge rounds; distinct units are counted once."""
    bpe = load(path)
    return ByChunk(bpe, lambda fresh: (bpe.count(fresh), np.ones(len(fresh), np.int64)), limit)
