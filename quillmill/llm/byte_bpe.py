r"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a byte string is the one sequence of tokens in which every
adjacent pair stays as it is when its bytes are encoded on their own. So each prefix
has one valid last token, and it is found from shorter prefixes: the token t that ends
the prefix and whose predecessor (the last token of the prefix before t) makes a valid
pair with it. PrefixTable stores that last token for every prefix of a byte string:
appending bytes only adds entries, and after an edit only the entries from the edit on
are made anew, until as many entries in a row as the longest token has bytes agree
with the old ones.

Texts are cut by the vocabulary's pattern first, each piece is encoded by itself and
kept in a bounded cache of spans, whose bytes are compared on every hit. Whole texts are
encoded, chunk by chunk, without a shuffle.

Defined cases: a null text is empty and has no ids; repeated rows give repeated
results; a text may be of any length; an empty table gives an empty table; other
columns pass through encode_column() and decode_column().
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.llm.ragged import chunks_by_size, clears_cache, gather, offsets_of, worker
from quillmill.llm.spans import SpanCache

#: Unicode White_Space, which `\s` stands for in the pattern.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pairs of tokens a Python worker keeps before it begins anew, and spans before it forgets the rare ones.
CACHED_PAIRS, CACHED_SPANS = 300_000, 1_500_000
#: Bytes of text handled at once.
CHUNK = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks, and which pairs of tokens are valid neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        n = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * n
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        #: How many bytes the longest token has that ends in these three.
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 2 and self.reach.get(token[-3:], 0) < len(token):
                self.reach[token[-3:]] = len(token)
        self.pairs: dict[int, bool] = {}
        self.made: set[int] = set()
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._lengths = np.array([len(t) for t in self.tokens], np.int64)
        self._starts = offsets_of(self._lengths)[:-1]
        self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def merged(self, data: bytes, until: int = 1) -> list[bytes]:
        """Merge the pair of lowest rank, leftmost first, until none or `until` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > until:
            best = min((self.ranks.get(a + b, sys.maxsize), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == sys.maxsize:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes this one; None for single bytes and for tokens no merge makes."""
        if token not in self._halves:
            parts = self.merged(token, 2)
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def makes(self, rank: int) -> bool:
        """True if merges make the token; `made` remembers those."""
        token = self.tokens[rank]
        if len(token) > 1 and self.halves(token) is None:
            return False
        self.made.add(rank)
        return True

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The tokens that stand at the token's left (0) or right (1) edge while it is being
        merged, each with the rank of the merge that ends it."""
        out, ends = [], sys.maxsize
        while True:
            out.append((token, ends))
            halves = self.halves(token)
            if halves is None:
                return out
            ends, token = self.ranks[token], halves[side]

    def valid(self, a: int, b: int) -> bool:
        """True if no merge ever crosses from a to b: a crossing merge would have to come
        before the merges that end the two tokens it joins (at equal ranks, the left one first)."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            right = self._edge(self.tokens[b], 0)
            known = self.pairs[key] = not any(
                (rank := self.ranks.get(x + y)) is not None and rank < x_ends and rank <= y_ends
                for x, x_ends in self._edge(self.tokens[a], 1)
                for y, y_ends in right
            )
        return known

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and their offsets for runs of ids with these offsets."""
        lengths = self._lengths[ids]
        return gather(self._bytes, self._starts[ids], lengths), offsets_of(lengths)[offsets]


class PrefixTable:
    """The last token of every prefix of a byte string; index 0 stands for the empty one."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def _fill(self, data: bytes, last: list[int], stop: int) -> None:
        """Find the last token of each prefix up to `stop` bytes; only tokens as long as a prefix's last bytes allow are tried."""
        v = self.vocabulary
        rank_of, pair, reach, made = v.ranks.get, v.pairs.get, v.reach.get, v.made
        for end in range(len(last), stop + 1):
            begin = end - (reach(data[end - 3 : end]) or 2) if end > 2 else 0
            for start in range(begin if begin > 0 else 0, end):
                token = rank_of(data[start:end])
                if token is None:
                    continue
                if start:
                    ok = pair(last[start] << 32 | token)
                    if ok is None:
                        ok = v.valid(last[start], token)
                    if not ok:
                        continue
                if token in made or v.makes(token):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}")

    def append(self, more: bytes) -> None:
        self.data += more
        self._fill(self.data, self.last, len(self.data))

    def edit(self, start: int, stop: int, new: bytes) -> int:
        """Put new in the place of data[start:stop]; returns how many entries were made anew."""
        old_last, tail = self.last, self.data[stop:]
        data = self.data[:start] + new + tail
        last, shift, same, made = old_last[: start + 1], len(new) - (stop - start), 0, 0
        for end in range(start + 1, len(data) + 1):
            self._fill(data, last, end)
            token = last[end]
            made += 1
            old = end - shift
            inside = old > stop and end - self.vocabulary.longest >= start + len(new)
            same = same + 1 if inside and old_last[old] == token else 0
            if same >= self.vocabulary.longest:
                last.extend(old_last[old + 1 :])
                break
        self.data, self.last = data, last
        return made

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.tokens[self.last[end]])
        return out[::-1]


def _ranges(kind: str, top: int) -> str:
    """The code points up to `top` whose category begins with `kind`, as ranges of a character class."""
    out, begin = [], None
    for c in range(top + 2):
        inside = c <= top and unicodedata.category(chr(c))[0] == kind
        if inside and begin is None:
            begin = c
        elif not inside and begin is not None:
            out.append(f"\\U{begin:08x}-\\U{c - 1:08x}")
            begin = None
    return "".join(out)


@lru_cache(maxsize=4)
def piece_pattern(top: int) -> re.Pattern:
    """The pattern of the byte-level vocabularies for texts whose code points are at most `top`.

    As the module re has no \\p{L} and \\p{N}, they are written out; small sets match faster.
    """
    letter, number, space = _ranges("L", top), _ranges("N", top), WHITE_SPACE
    return re.compile(
        f" ?[{letter}]+| ?[{number}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


_BEYOND_LATIN = re.compile(r"[^\x00-\u024f]")
_ASTRAL = re.compile(r"[\U00010000-\U0010ffff]")


def pieces_of(text: str) -> list[str]:
    if text.isascii():
        top = 0x7F
    elif not _BEYOND_LATIN.search(text):
        top = 0x24F
    else:
        top = sys.maxunicode if _ASTRAL.search(text) else 0xFFFF
    return piece_pattern(top).findall(text)


#: White space beyond ASCII. A run of white space that holds such a character must not be cut.
_OTHER_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Encoder:
    """Encodes texts.

    No piece goes on from other characters into white space, and what follows does not
    look back, so a text may be cut before each run of white space.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._spans = SpanCache(lambda spans: map(self._ids, spans), keep_space=True, limit=CACHED_SPANS)

    def _ids(self, text: str) -> list[int]:
        ids: list[int] = []
        for piece in pieces_of(text):
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            ids += [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts and their offsets."""
        whole = {i: self._ids(t) for i, t in enumerate(texts) if not t.isascii() and _OTHER_SPACE.search(t)}
        flat, offsets = self._spans.encode([b"" if i in whole else t.encode() for i, t in enumerate(texts)])
        if whole:
            parts = [np.array(whole[i], np.int32) if i in whole else flat[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
            flat, offsets = np.concatenate(parts), offsets_of(np.array([len(p) for p in parts]))
        return flat, offsets


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(Vocabulary(load_ranks(path)))


clears_cache("byte_bpe", _encoder.cache_clear)


def _encoded(encoder: Encoder, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and offsets of the texts, chunk by chunk: what is held follows the chunk, not the batch."""
    for i, j in chunks_by_size(pa.compute.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
        yield encoder.encode([t or "" for t in texts[i:j].to_pylist()])


def _decoded(vocabulary: Vocabulary, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data, ends = vocabulary.decode(ids, offsets)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def _lists(ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def encode_column(text: Column, path: str) -> Column:
    """The ids of the text, array<int>, by the ranks in the file at path (on every executor)."""

    @F.arrow_udf("array<int>")
    @worker("byte_bpe")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for texts in batches:
            for found in _encoded(encoder, texts):
                yield _lists(*found)

    # not deterministic: else the plan may encode once for each use of the column
    return encode.asNondeterministic()(text)


def decode_column(ids: Column, path: str) -> Column:
    """The bytes that an array<int> of ids stands for; null stays null."""

    @F.arrow_udf("binary")
    @worker("byte_bpe")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = _encoder(path).vocabulary
        for batch in batches:
            for i, j in chunks_by_size(pa.compute.list_value_length(batch).fill_null(0).to_pylist(), CHUNK // 4):  # ids
                rows = batch[i:j]
                offsets = rows.offsets.to_numpy().astype(np.int64)
                made = _decoded(vocabulary, rows.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0])
                yield pa.compute.if_else(rows.is_valid(), made, pa.scalar(None, pa.binary())) if rows.null_count else made

    return decode(ids)


def encode_decode_column(text: Column, path: str) -> Column:
    """struct(ids, decoded): the text's ids, and the bytes that these ids stand for.

    Both in one Python worker: two functions in one plan would take two workers a task,
    each with a table of spans that grows half as fast.
    """
    kinds = [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    @worker("byte_bpe")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(path)
        for texts in batches:
            for ids, offsets in _encoded(encoder, texts):
                yield pa.StructArray.from_arrays([_lists(ids, offsets), _decoded(encoder.vocabulary, ids, offsets)], fields=[pa.field(*k) for k in kinds])

    return both.asNondeterministic()(text)
