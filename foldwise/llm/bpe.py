"""Byte-level BPE by backtracking over longest matches.

A text is cut into pieces by a pattern; each piece is encoded alone.  A piece that is a token is that
token.  Otherwise its bytes are mapped to Latin-1, one character a byte, for a pyahocorasick trie of all
tokens, which gives the longest token at a position, and the encoder walks from the left: it takes the
longest token, and keeps it only if the pair with the token before could stand side by side in a merged
sequence.  If not, it tries the next shorter prefix token,
and at last steps back over the token before and bars the position.  Each position is barred at most
once, so the walk is linear; whether two tokens may be neighbours is memoised.  The result equals that
of merging by rank.

Nulls count as empty texts (no ids); very long pieces cost linear time; repeated rows give repeated
results; extra columns are kept as they are.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Distinct pieces of a generation whose ids a worker remembers (two generations live at a time), and
#: the longest of them in characters.
CACHE_PIECES, CACHE_LENGTH = 500_000, 64
#: Rows in a batch that a worker returns.
BATCH_TOKENS = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _bmp_pattern(pattern: str) -> re.Pattern:
    """``pattern`` for texts without astral characters, as the standard library's faster matcher reads
    it: its Unicode classes become plain ranges, which ``regex`` itself names."""
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    ranges = {}
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = [m.span() for m in regex.finditer(f"{name}+", every)]
        ranges[name] = "".join(f"\\u{ord(every[a]):04x}-\\u{ord(every[b - 1]):04x}" for a, b in runs)
    out, inside = "", False
    for part in re.split(r"(\\p\{\w\}|\\s|\\S|\[|\])", pattern):
        if part in ("[", "]"):
            inside = part == "["
        if part in ranges:
            part = ranges[part] if inside else f"[{ranges[part]}]"
        out += f"[^{ranges[chr(92) + 's']}]" if part == r"\S" else part
    return re.compile(out)


class Encoder:
    """The tables of one vocabulary: ``encode(text)`` gives ids, ``decode(ids)`` bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find, self.find_any = ranks, _bmp_pattern(pattern).findall, regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.trie = ahocorasick.Automaton()
        self.latin = {t.decode("latin-1"): r for t, r in ranks.items()}
        for t, r in self.latin.items():
            self.trie.add_word(t, r)
        self.sizes = [len(t) for t in self.tokens]
        self.widest = max(map(len, ranks))
        self.shorter = {}
        for t, r in ranks.items():
            self.shorter[r] = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), -1)
        self._halves()
        self.pairs: dict[int, bool] = {}
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.flat = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.at, self.length = np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths
        self.seen = _Pieces(self)

    def _halves(self) -> None:
        """The last merge that makes each token; a token that no merge makes is whole in itself.
        A token's halves have lower ranks, so tokens are split in the order of their ranks."""
        self.left = list(range(len(self.tokens)))
        self.right = list(range(len(self.tokens)))
        self.merged: dict[tuple[int, int], int] = {}
        for rank in sorted(self.ranks.values()):
            t = self.tokens[rank]
            if len(t) == 1:
                continue
            # neighbours under the merges below this rank, by the same walk on what is known so far
            for n in range(1, len(t)):
                a, b = self.ranks.get(t[:n], rank), self.ranks.get(t[n:], rank)
                if a < rank and b < rank and self._fit(a, b):
                    self.left[rank], self.right[rank] = a, b
                    self.merged[a, b] = rank
                    break

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging by rank can leave ``a`` and ``b`` side by side: no merge across the border
        comes before the merges that build the two.  Undoes the later of the two last merges, again
        and again, and looks at the pair that touches the border in between."""
        limit = len(self.tokens) + 1
        while True:
            over = self.merged.get((a, b))
            if over is not None and over < limit:
                return False
            if a > b and self.right[a] != a or self.left[b] == b:
                if self.right[a] == a:
                    return True
                limit, a = a, self.right[a]
            else:
                limit, b = b + 1, self.left[b]

    def fit(self, a: int, b: int) -> bool:
        known = self.pairs.get(a << 24 | b)
        if known is None:
            if len(self.pairs) > 2_000_000:
                self.pairs.clear()
            known = self.pairs[a << 24 | b] = self._fit(a, b)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, sizes, shorter, pairs, longest = len(piece), self.sizes, self.shorter, self.pairs, self.longest
        latin = piece.decode("latin-1")
        barred: set[int] | tuple = ()
        out: list[int] = []
        pos, token, last = 0, longest(latin), -1
        while pos < n:
            end = pos + sizes[token]
            if (not barred or end not in barred) and (last < 0 or pairs.get(last << 24 | token) or self.fit(last, token)):
                out.append(token)
                pos, last = end, token
                if pos < n:
                    token = longest(latin[pos : pos + self.widest])
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                if not barred:
                    barred = set()
                barred.add(pos)
                token = out.pop()
                last = out[-1] if out else -1
                pos -= sizes[token]
        return out

    def longest(self, ahead: str) -> int:
        """The longest token that ``ahead`` begins with: the trie bounds its length from above."""
        size = self.trie.longest_prefix(ahead)
        rank = self.latin.get(ahead[:size])
        while rank is None:
            size -= 1
            rank = self.latin.get(ahead[:size])
        return rank

    def encode(self, text: str) -> np.ndarray:
        seen = self.seen
        if len(seen) > CACHE_PIECES:
            seen.before = dict(seen)
            seen.clear()
        astral = not text.isascii() and len(text.encode("utf-16-le")) != 2 * len(text)
        return np.frombuffer(b"".join(map(seen.__getitem__, (self.find_any if astral else self.find)(text))), np.int32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, end to end."""
        length = self.length[ids]
        total = int(length.sum())
        if not total:
            return np.zeros(0, np.uint8)
        begin = np.cumsum(length) - length
        return self.flat[np.repeat(self.at[ids] - begin, length) + np.arange(total)]


class _Pieces(dict):
    """Ids of pieces met before, as 32-bit integers end to end; ``before`` holds the generation that filled up last."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.before = encoder, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece)
        if ids is None:
            ids = array("i", self.encoder.encode_piece(piece.encode())).tobytes()
        if len(piece) <= CACHE_LENGTH:
            self[piece] = ids
        return ids


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process; the vocabulary file lies at the same path on every executor."""
    return Encoder(load_ranks(path), pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``text`` replaced by ``out`` array<int>, the token ids of the whole text.  A column
    already called ``out`` is replaced."""
    rest = [c for c in docs.columns if c not in (text, out)]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            first, parts, total = 0, [], 0
            for i in range(len(batch)):
                parts.append(e.encode(texts[i].as_py() or ""))
                total += len(parts[-1])
                if total >= BATCH_TOKENS or i + 1 == len(batch):
                    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts)))
                    kept = [batch.column(batch.schema.get_field_index(c)).slice(first, len(parts)) for c in rest]
                    yield pa.RecordBatch.from_arrays([*kept, ids], [*rest, out])
                    first, parts, total = i + 1, [], 0

    return docs.select(*rest, text).mapInArrow(run, schema)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out`` binary added: the bytes of ``ids`` (null ids: empty)."""
    rest = [c for c in docs.columns if c != out]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(out, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            for at in range(0, len(batch), 256):
                part = lists.slice(at, 256)
                count = np.nan_to_num(part.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                size = np.concatenate([[0], np.cumsum(e.length[flat])])[np.concatenate([[0], np.cumsum(count)])]
                data = e.decode(flat)
                texts = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(data)])
                kept = [batch.column(batch.schema.get_field_index(c)).slice(at, 256) for c in rest]
                yield pa.RecordBatch.from_arrays([*kept, texts], [*rest, out])

    return docs.select(*rest).mapInArrow(run, schema)
