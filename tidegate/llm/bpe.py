"""Byte-level BPE by prefix dynamic programming.

The encoding of every prefix of a byte string ends in exactly one token. Storing
that token per prefix gives the whole encoding by walking back, an exact append by
going on from the last prefix, and re-encoding after an edit from the place of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words, matches and token pairs a worker remembers before it starts anew. Bounds memory only.
REMEMBERED = 700_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file, one `base64 rank` per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


_NEVER = 1 << 62


class Codec:
    """Encoder and decoder over a rank file; `pattern` cuts texts into matches."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.table = [b""] * (max(self.ranks.values(), default=0) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        #: Lengths of the tokens that end in these three bytes, longest first.
        lengths: dict[bytes, set[int]] = {}
        for token in self.ranks:
            if len(token) > 2:
                lengths.setdefault(token[-3:], set()).add(len(token))
        self.ending = {end: sorted(found, reverse=True) for end, found in lengths.items()}
        self.find = regex.compile(pattern).findall
        self.alone: dict[bytes, bool] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, bytes] = {}
        self.matches: dict[str, list[int]] = {}
        self.left: dict[int, list[tuple[bytes, int]]] = {}
        self.right: dict[int, list[tuple[bytes, int]]] = {}

    def merges(self, data: bytes) -> list[int]:
        """Encoding by its definition: merge the pair of lowest rank, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, k = self._lowest(parts)
            if rank == _NEVER:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return [self.ranks[p] for p in parts]

    def _alone(self, token: bytes, rank: int) -> bool:
        """Whether a token's bytes encode to that token."""
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merges(token) == [rank]
        return known

    def _spine(self, rank: int, side: int) -> list[tuple[bytes, int]]:
        """What lies at one end of a token while it is merged: (bytes, rank that replaces them).

        The end of its first byte (side 0) or last one (side -1), up to the token.
        A merge ranks above its parts, so the ranks rise and tell the order of events.
        """
        memo = self.right if side else self.left
        if rank not in memo:
            whole = self.table[rank]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            steps: list[tuple[bytes, int]] = []
            while len(parts) > 1:
                best, k = self._lowest(parts)
                touched = k == (len(parts) - 2 if side else 0)
                if touched:
                    steps.append((parts[side], best))
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            memo[rank] = [*steps, (whole, _NEVER)]
        return memo[rank]

    def _lowest(self, parts: list[bytes]) -> tuple[int, int]:
        pairs = zip(parts, parts[1:], strict=False)
        return min((self.ranks.get(a + b, _NEVER), k) for k, (a, b) in enumerate(pairs))

    def _fit(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens encode to just these two.

        They do unless, at some moment of both being merged, the two parts that
        meet at the border may merge before either is replaced. Of equal ranks the
        leftmost pair comes first.
        """
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > REMEMBERED:
                self.fits.clear()
            a, b = self._spine(left, -1), self._spine(right, 0)
            i = j = 0
            known = True
            while True:
                (x, goes), (y, comes) = a[i], b[j]
                across = self.ranks.get(x + y, _NEVER)
                if across < goes and across <= comes and across != _NEVER:
                    known = False
                    break
                if goes == comes == _NEVER:
                    break
                if goes <= comes:
                    i += 1
                else:
                    j += 1
            self.fits[left, right] = known
        return known

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Last tokens of all prefixes of `data`, given those of its first `len(last)`.

        A token may end a prefix if it may stand alone or fits the last token of
        the prefix before it. Exactly one does, so the search stops there, and its
        order is free: first the last token made longer by this byte, then all tokens
        that end here.
        """
        ranks, fits, table, ending = self.ranks, self.fits, self.table, self.ending
        for end in range(len(last) + 1, len(data) + 1):
            if end > 1:
                size = len(table[last[-1]]) + 1
                if size > 2 and self._ends(data, end - size, end, last):
                    continue
            for size in ending.get(data[end - 3 : end], ()) if end > 2 else ():
                if size > end:
                    continue
                start = end - size
                rank = ranks.get(data[start:end])
                if rank is None:
                    continue
                if start:
                    fit = fits.get((last[start - 1], rank))
                    if fit is None:
                        fit = self._fit(last[start - 1], rank)
                else:
                    fit = self._alone(data[:end], rank)
                if fit:
                    last.append(rank)
                    break
            else:
                if not (self._ends(data, end - 2, end, last) or self._ends(data, end - 1, end, last)):
                    raise ValueError("the rank file lacks a single byte")
        return last

    def _ends(self, data: bytes, start: int, end: int, last: list[int]) -> bool:
        """Note the token data[start:end] as the last of its prefix, if it is that."""
        rank = self.ranks.get(data[start:end]) if start >= 0 else None
        if rank is None:
            return False
        if start:
            fit = self.fits.get((last[start - 1], rank))
            fit = self._fit(last[start - 1], rank) if fit is None else fit
        else:
            fit = self._alone(data[:end], rank)
        if fit:
            last.append(rank)
        return fit

    def walk(self, last: list[int]) -> list[int]:
        """Ids of the whole string from the last tokens of its prefixes."""
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.table[ids[-1]])
        return ids[::-1]

    def match(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        rank = self.ranks.get(data)
        if rank is not None and self._alone(data, rank):
            return [rank]
        return self.walk(self.extend(data, []))

    def append(self, data: bytes, last: list[int], more: bytes) -> tuple[bytes, list[int]]:
        """The string with `more` at its end, and its table; nothing before is redone."""
        return data + more, self.extend(data + more, list(last))

    def edit(self, data: bytes, last: list[int], start: int, stop: int, by: bytes) -> tuple[bytes, list[int]]:
        """The string with [start, stop) replaced, and its table, redone from `start`."""
        new = data[:start] + by + data[stop:]
        return new, self.extend(new, last[:start])

    def _ids(self, text: str) -> bytes:
        """Ids of a text, match by match. Letters alone, one space before them, are one match."""
        ids: list[int] = []
        known = self.matches
        if len(known) > REMEMBERED:
            known.clear()
        for part in [text] if text[1:].isalpha() and text[0] == " " else self.find(text):
            own = known.get(part)
            if own is None:
                own = self.match(part.encode())
                if len(part) < 64:
                    known[part] = own
            ids += own
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        A single space between non-space characters always starts a match, so words
        met before are looked up.
        """
        head, *rest = text.split(" ")
        if not rest or not head or head[-1].isspace():
            return self._ids(text)
        words = self.words
        try:
            return self._ids(head) + b"".join(map(words.__getitem__, rest))
        except KeyError:
            pass
        if len(words) > REMEMBERED:
            words.clear()
        for w in rest:
            if w not in words:
                if not w or w[0].isspace() or w[-1].isspace():
                    return self._ids(text)
                words[w] = self._ids(" " + w)
        return self._ids(head) + b"".join(map(words.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encoded(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    doc_id: str = "doc_id",
    with_ids: bool = False,
) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` (and `ids`) per row of `docs`.

    The ids of a whole text, then the digest of what they decode to. Null and empty
    texts have no ids; rows that repeat stay rows; an empty table gives no rows; other
    columns are not read. Very long texts are encoded whole, also without any space: the
    work grows with their length alone. `pattern` must begin a match at every single space
    between two other characters, as those of byte-level files do.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            rows = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = own.encode(body.as_py() or "")
                back = hashlib.sha256(own.decode(ids)).hexdigest()
                rows.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), back, ids))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, schema)
