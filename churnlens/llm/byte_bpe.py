"""Byte-level BPE encoding and decoding as a monoid tree reduction.

Encodings of neighbouring byte strings form a monoid: the encoding of ``a + b`` follows from those of
``a`` and ``b`` by re-encoding a window around the seam. A token sequence is the BPE encoding of its
bytes exactly when every two neighbouring tokens, encoded together, give those two tokens again (a
merge that crosses a seam would show in the pair alone). So a window of k tokens on either side is
re-encoded, and k doubles until the new tokens at its rims are compatible with the tokens outside.
Pieces are encoded by halves down to short leaves, which merge the lowest rank first. Decoding
concatenates the tokens' bytes of blocks up the same tree.

Each match of the pre-token pattern is a piece of its own, so pieces concatenate without a window.

Defined results: null and empty text give no tokens and empty bytes; texts of any length are encoded
whole; repeated rows give repeated results; an empty table gives an empty table; an output column
replaces an input column of its name.
"""

from __future__ import annotations

import base64
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_columns, texts

#: A vocabulary file above this many entries isn't broadcast (documented bound of what each task loads).
MAX_VOCABULARY = 1_000_000
_NONE = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} vocabulary entries; the bound is {MAX_VOCABULARY}")
    return ranks


class TreeBpe:
    """Encoder of single pieces (byte strings). Memos are emptied when full, so memory stays bounded."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = 5, memo: int = 200_000) -> None:
        self.ranks, self.leaf, self.memo = ranks, leaf, memo
        self.tokens = {v: k for k, v in ranks.items()}
        self._seams: dict[tuple[int, int], tuple[int, ...]] = {}
        self._leaves: dict[bytes, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Plain merging, lowest rank first and leftmost among equals (leaves and seam windows)."""
        get, n = self.ranks.get, len(piece)
        at = list(range(n + 1))
        rank = [get(piece[i:i + 2], _NONE) for i in range(n - 1)]
        while rank:
            low = min(rank)
            if low == _NONE:
                break
            i = rank.index(low)
            del at[i + 1]
            del rank[i]
            if i < len(rank):
                rank[i] = get(piece[at[i]:at[i + 2]], _NONE)
            if i:
                rank[i - 1] = get(piece[at[i - 1]:at[i + 1]], _NONE)
        return tuple([self.ranks[piece[a:b]] for a, b in zip(at, at[1:])])

    def seam(self, a: int, b: int) -> tuple[int, ...]:
        """Encoding of two neighbouring tokens' bytes; they are compatible when it is the two themselves."""
        got = self._seams.get((a, b))
        if got is None:
            if len(self._seams) >= self.memo:
                self._seams.clear()
            got = self._seams[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return got

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of the concatenation of two encoded strings."""
        if not left or not right:
            return left or right
        k, window = 1, self.seam(left[-1], right[0])
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            if (i == 0 or self.seam(left[i - 1], window[0]) == (left[i - 1], window[0])) and \
                    (j == len(right) or self.seam(window[-1], right[j]) == (window[-1], right[j])):
                return left[:i] + window + right[j:]
            k *= 2
            i, j = max(0, len(left) - k), min(len(right), k)
            window = self.merge(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))

    def _leaf(self, piece: bytes) -> tuple[int, ...]:
        got = self._leaves.get(piece)
        if got is None:
            if len(self._leaves) >= self.memo:
                self._leaves.clear()
            got = self._leaves[piece] = self.merge(piece)
        return got

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        return self._reduce(piece) if piece else ()

    def _reduce(self, piece: bytes) -> tuple[int, ...]:
        """Bottom-up over the binary tree: leaves first, then neighbours are joined level by level."""
        n, step = len(piece), self.leaf
        level = [self._leaf(piece[i:i + step]) for i in range(0, n, step)]
        while len(level) > 1:
            level = [self.join(level[i], level[i + 1]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0]

    def decode(self, ids: list[int], block: int = 4096) -> bytes:
        """Bytes of the tokens: blocks first, then concatenation up the tree."""
        level = [b"".join(map(self.tokens.__getitem__, ids[i:i + block])) for i in range(0, len(ids), block)]
        while len(level) > 1:
            level = [b"".join(level[i:i + 64]) for i in range(0, len(level), 64)]
        return level[0] if level else b""


class _Pieces(dict):
    """Encodings of the pieces seen lately; emptied when full, so memory stays bounded."""

    def __init__(self, bpe: TreeBpe, entries: int = 250_000) -> None:
        super().__init__()
        self.bpe, self.entries = bpe, entries

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.bpe.encode(piece.encode())
        if len(piece) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[piece] = ids
        return ids


def _encode_text(text: str, find: regex.Pattern, pieces: _Pieces, block: int = 200_000) -> bytes:
    """Little-endian unsigned 32-bit ids of a text; long texts go block by block of pieces."""
    if len(text) <= block:
        found = find.findall(text)
        return np.fromiter(chain.from_iterable(map(pieces.__getitem__, found)), "<u4").tobytes()
    out, it = [], (m.group() for m in find.finditer(text))
    while found := list(islice(it, block)):
        out.append(np.fromiter(chain.from_iterable(map(pieces.__getitem__, found)), "<u4").tobytes())
    return b"".join(out)


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids``: the text's token ids as little-endian unsigned 32-bit integers (binary)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def make():
        pieces, find = _Pieces(TreeBpe(shared.value)), regex.compile(pattern)
        return lambda col: [pa.array([_encode_text(x, find, pieces) for x in texts(col)], pa.binary())]

    return map_columns(df, [text], [T.StructField(ids, T.BinaryType())], make)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes of the tokens in ``ids`` (binary; null ids give empty bytes)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def make():
        bpe = TreeBpe(shared.value)
        return lambda col: [pa.array([bpe.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in col.to_pylist()],
                                     pa.binary())]

    return map_columns(df, [ids], [T.StructField(decoded, T.BinaryType())], make)


def public_vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and pre-token pattern of the public 50k byte-level vocabulary (read on the driver)."""
    import public_tokenizers
    return load_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
