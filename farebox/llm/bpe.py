"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can end its encoding: the token is a suffix of the prefix, and it is
compatible with the token that ends what stands before it. Two neighbours are compatible if the merges of their joint
bytes never cross the border between them. Storing that last token per prefix encodes in one pass, makes appending
exact (old prefixes keep their token), and lets an edit be re-encoded from the edited place on.

The ranks come from a public rank file (``base64 token, space, rank`` per line); nothing is trained here.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from farebox.llm.tasks import with_python_columns

# What a task remembers: words and pieces with their ids, pairs of tokens. A full memory starts anew; results do not
# depend on it.
REMEMBERED = 400_000
REMEMBERED_CHARS = 48
REMEMBERED_PAIRS = 1_000_000
_NO_RANK = 1 << 62


def read_ranks(path: str) -> list[bytes]:
    """The token bytes of a rank file in the order of their ids (0, 1, 2, …)."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(found) != list(range(len(found))):
        raise ValueError("ranks must be 0, 1, 2, … without gaps")
    return [found[i] for i in range(len(found))]


class Vocabulary:
    """Tokens with what the dynamic programme needs: each token's halves, and which tokens merging can reach."""

    def __init__(self, tokens: list[bytes], halves: list[tuple[int, ...]] | None = None):
        self.tokens = tokens
        self.ids = {token: i for i, token in enumerate(tokens)}
        self.longest = max(map(len, tokens))
        # a single byte has none, a token that merging never reaches has more than two
        self.halves = halves or [tuple(map(self.ids.get, self._merge(t, i))) if len(t) > 1 else () for i, t in enumerate(tokens)]
        # finds every token that ends at a place, the longest first; bytes stand as characters of the same number
        self.matches = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            if len(self.halves[i]) <= 2:
                self.matches.add_word(token.decode("latin-1"), (i, len(token)))
        self.matches.make_automaton()
        self._fits: dict[int, bool] = {}

    def _merge(self, text: bytes, below: int = _NO_RANK) -> list[bytes]:
        """Plain merging, lowest rank and then leftmost first, with ranks under ``below``."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.ids.get(parts[i] + parts[i + 1], _NO_RANK), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def extend(self, last: list[int], data: bytes) -> None:
        """Fill ``last``, the last tokens of the prefixes of ``data`` so far, up to the whole of ``data``."""
        done, size, known = len(last), len(self.tokens), self._fits
        first = max(0, done + 1 - self.longest)
        for at, (token, length) in self.matches.iter(data[first:].decode("latin-1")):
            if at + first == done:
                before = done - length
                if before >= 0:
                    pair = last[before] * size + token
                    fits = known.get(pair)
                    if fits is None:
                        fits = self.fits(last[before], token)
                        if len(known) >= REMEMBERED_PAIRS:
                            known.clear()
                        known[pair] = fits
                    if not fits:
                        continue
                elif before < -1:
                    continue
                last.append(token)
                done += 1
        if done != len(data):
            raise ValueError("the ranks lack a single byte")

    def walk(self, last: list[int], end: int) -> list[int]:
        """The ids of the first ``end`` bytes."""
        out = []
        while end:
            token = last[end - 1]
            out.append(token)
            end -= len(self.tokens[token])
        out.reverse()
        return out

    def packed(self, data: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        last: list[int] = []
        self.extend(last, data)
        ids = self.walk(last, len(data))
        return struct.pack(f"<{len(ids)}I", *ids)

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can follow ``left`` in an encoding.

        The two tokens are built up again from their bytes, following only the edge tokens at the border. A merge
        across it happens if its rank comes before the next merge on the left (which goes first when ranks are
        equal) and not after the next one on the right.
        """
        grows_left, grows_right = [left], [right]
        while self.halves[grows_left[-1]]:
            grows_left.append(self.halves[grows_left[-1]][1])
        while self.halves[grows_right[-1]]:
            grows_right.append(self.halves[grows_right[-1]][0])
        a, b = grows_left.pop(), grows_right.pop()
        while True:
            across = self.ids.get(self.tokens[a] + self.tokens[b], _NO_RANK)
            next_a = grows_left[-1] if grows_left else _NO_RANK
            next_b = grows_right[-1] if grows_right else _NO_RANK
            if across < next_a and across <= next_b and across != _NO_RANK:
                return False
            if next_a == next_b == _NO_RANK:
                return True
            if next_a <= next_b:
                a = grows_left.pop()
            else:
                b = grows_right.pop()


class PieceEncoding:
    """The encoding of one piece, kept as the last token of every prefix."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact, and the work is that of the new bytes alone."""
        self.data += more
        self.vocabulary.extend(self.last, self.data)

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Replace bytes ``start:stop``; prefixes before the edit keep their token."""
        tail = new + self.data[stop:]
        self.data, self.last = self.data[:start], self.last[:start]
        self.append(tail)

    def ids(self, end: int | None = None) -> list[int]:
        """Token ids of the whole piece, or of its first ``end`` bytes."""
        return self.vocabulary.walk(self.last, len(self.data) if end is None else end)


class _Irregular(Exception):
    """A space that may belong to a longer run of white space."""


class _Words(dict):
    """Word (what stands between two single spaces) -> the packed ids of the space and the word.

    Words of letters alone are one piece; others are split by the pattern, and their pieces looked up.
    """

    def __init__(self, find, vocabulary: Vocabulary):
        super().__init__()
        self.find, self.encode, self.others = find, vocabulary.packed, {}

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            packed = self.encode(f" {word}".encode())
            if len(word) <= REMEMBERED_CHARS:
                if len(self) >= REMEMBERED:
                    self.clear()
                self[word] = packed
            return packed
        if not word or word[0].isspace():
            raise _Irregular
        if word[-1] in ",." and word[:-1].isalpha():
            return self[word[:-1]] + self.piece(word[-1])
        return b"".join(map(self.piece, self.find(f" {word}")))

    def piece(self, piece: str) -> bytes:
        if piece[0] == " " and piece[1:].isalpha():
            return self[piece[1:]]
        packed = self.others.get(piece)
        if packed is None:
            packed = self.encode(piece.encode())
            if len(piece) <= REMEMBERED_CHARS:
                if len(self.others) >= REMEMBERED:
                    self.others.clear()
                self.others[piece] = packed
        return packed


class Tokenizer:
    """Encodes and decodes whole texts; each match of ``pattern`` is a piece of its own, and there are no special tokens.

    ``pattern`` must attach one space to the word behind it and let no piece run into such a space, as the patterns of
    byte-level vocabularies do. Then words can be looked up between single spaces.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.find = regex.compile(pattern).findall
        self.match = regex.compile(pattern).match
        self._words = _Words(self.find, vocabulary)

    def encode_packed(self, text: str) -> bytes:
        first, *words = text.split(" ")
        head = b"".join(map(self._words.piece, self.find(first)))
        try:
            return head + b"".join(map(self._words.__getitem__, words))
        except _Irregular:
            return b"".join(map(self._words.piece, self.find(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_packed(text), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of these tokens; an id without a token raises IndexError."""
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))

    def count(self, text: str) -> int:
        return len(self.encode_packed(text)) >> 2


class TextEncoding:
    """The encoding of a text that is edited: pieces away from an edit keep their ids."""

    def __init__(self, tokenizer: Tokenizer, text: str = ""):
        self.tokenizer, self.text = tokenizer, ""
        self.starts: list[int] = []
        self.packed: list[bytes] = []
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters ``start:stop``.

        A piece depends on its own characters and one more, so pieces that end before the edit stay. Behind the
        edit, pieces repeat from the first border that old and new text share.
        """
        old_starts, old_packed, moved = self.starts, self.packed, len(new) - (stop - start)
        keep = max(0, bisect_right(old_starts, start) - 2)
        if keep == 0:
            at = 0
        else:
            at = old_starts[keep]
        self.text = self.text[:start] + new + self.text[stop:]
        self.starts, self.packed = old_starts[:keep], old_packed[:keep]
        old_at = {s + moved: i for i, s in enumerate(old_starts[keep:], keep) if s >= stop}
        while at < len(self.text):
            if at >= start + len(new) and at in old_at:
                i = old_at[at]
                self.starts += [s + moved for s in old_starts[i:]]
                self.packed += old_packed[i:]
                return
            found = self.tokenizer.match(self.text, at)
            self.starts.append(at)
            self.packed.append(self.tokenizer._words.piece(found.group()))
            at = found.end()

    def ids(self) -> list[int]:
        return np.frombuffer(b"".join(self.packed), "<u4").tolist()


def shared_vocabulary(df: DataFrame, rank_file: str):
    """A broadcast of the rank file's tokens and their halves; its size is that of a public vocabulary (about 2 MB)."""
    vocabulary = Vocabulary(read_ranks(rank_file))
    return df.sparkSession.sparkContext.broadcast({"tokens": vocabulary.tokens, "halves": vocabulary.halves})


def tokenizer_of(shared: dict, pattern: str) -> Tokenizer:
    """The tokenizer of a broadcast vocabulary, made once per Python worker and kept with the broadcast."""
    if pattern not in shared:
        shared[pattern] = Tokenizer(Vocabulary(shared["tokens"], shared["halves"]), pattern)
    return shared[pattern]


def encode_texts(df: DataFrame, rank_file: str, pattern: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """``df`` with ``n_tokens``, ``token_ids`` (unless switched off), ``ids_sha256`` and ``decoded_sha256`` of each text.

    The ids are decoded again in the same pass, and ``decoded_sha256`` is the digest of those bytes. NULL counts as
    empty; an empty text has no tokens and the digests of no bytes. Rows are neither merged nor dropped, so repeated
    rows give repeated results; a long text is one row and its work grows with its length. Columns of the same names
    are replaced.
    """
    vocabulary = shared_vocabulary(df, rank_file)

    def make():
        tokenizer = tokenizer_of(vocabulary.value, pattern)
        table = tokenizer.vocabulary.tokens

        def compute(texts):
            packed = [tokenizer.encode_packed(t) if t else b"" for t in texts]
            ids = [np.frombuffer(p, "<u4") for p in packed]
            decoded = [b"".join([table[i] for i in x.tolist()]) for x in ids]
            columns = [[len(x) for x in ids]]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            return [*columns, [hashlib.sha256(p).hexdigest() for p in packed], [hashlib.sha256(d).hexdigest() for d in decoded]]

        return compute

    middle = "token_ids array<int>, " if with_ids else ""
    return with_python_columns(df, [text], f"n_tokens long, {middle}ids_sha256 string, decoded_sha256 string", make)


def decode_ids(df: DataFrame, rank_file: str, ids: str = "token_ids") -> DataFrame:
    """``df`` with ``text_bytes``, the bytes of the tokens in the array column ``ids``; NULL gives NULL."""
    vocabulary = shared_vocabulary(df, rank_file)

    def make():
        table = vocabulary.value["tokens"]

        def compute(rows):
            return [[None if r is None else b"".join([table[i] for i in r]) for r in rows]]

        return compute

    return with_python_columns(df, [ids], "text_bytes binary", make)
