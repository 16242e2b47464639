"""Hashes of spans of bytes, and a cache of what spans encode to."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np

from quillmill.llm.ragged import gather, offsets_of

#: Odd numbers whose powers weigh the bytes of a span.
ROOTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Bytes hashed at once: the tables of powers have so many entries, however long a text is.
BLOCK = 1 << 18
#: Spans of more bytes are hashed by blake2b: sums of powers of two-to-the-64 arithmetic
#: have known collisions among long, regular strings.
LONG_SPAN = 256
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=len(ROOTS))
def _powers(root: int) -> tuple[np.ndarray, np.ndarray]:
    """BLOCK powers of the root and of its inverse mod 2 ** 64."""
    out = []
    for base in (root, pow(root, -1, 2**64)):
        factors = np.full(BLOCK, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, root: int = ROOTS[0], long_span: int = LONG_SPAN) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each span (in order, none over another), from running sums of byte times power."""
    up, down = _powers(root)
    sizes = ends - starts
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = int(np.searchsorted(ends, low + BLOCK - 1, "right"))
        if last == first:  # one span beyond a block
            first += 1
            continue
        part = data[low : int(ends[last - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], dtype=np.uint64, out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[b] - sums[a]) * down[a] + sizes[first:last].astype(np.uint64) * np.uint64(0x27D4EB2F165667C5))
        first = last
    for i in np.flatnonzero(sizes > min(long_span, BLOCK - 1)):
        key = root.to_bytes(8, "little")
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=key).digest(), "little")
    return out


class _Pool:
    """A growing array."""

    def __init__(self, dtype: type):
        self.data, self.used = np.zeros(1 << 12, dtype), 0

    def add(self, values: np.ndarray) -> int:
        """Append; returns where the values begin."""
        at, need = self.used, self.used + len(values)
        if need > len(self.data):
            self.data = np.concatenate((self.data, np.zeros(max(need - len(self.data), len(self.data) // 2), self.data.dtype)))
        self.data[at:need] = values
        self.used = need
        return at


class SpanCache:
    """Encodes texts span by span; each span not seen yet is encoded once.

    Spans end at ASCII white space. With keep_space a span begins with the white space
    before it, else white space is dropped. Spans are found by their 64-bit hash in a
    sorted table, a chunk's distinct spans in one merge, and every span's bytes are
    compared with those that were encoded; a chunk in which two spans share a hash is
    encoded without the table. When the table has more than `limit` spans (about 50 bytes
    each) or 32 * `limit` bytes of them, those that did not come again are forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], keep_space: bool, limit: int = 1_500_000):
        self._encode, self.keep_space, self.limit = encode, keep_space, limit
        self._reset()

    def _reset(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._ids, self._bytes = _Pool(np.int32), _Pool(np.uint8)
        # by hash: where a span's ids and bytes begin, how many there are, and whether it came again
        self._id_at, self._n_ids, self._byte_at, self._n_bytes = (np.zeros(0, t) for t in (np.int64, np.int32, np.int64, np.int32))
        self._again = np.zeros(0, bool)

    def _forget(self) -> None:
        keep = self._again
        if 2 * keep.sum() > self.limit or self._n_bytes[keep].sum(dtype=np.int64) > 16 * self.limit:
            return self._reset()
        ids, raw = _Pool(np.int32), _Pool(np.uint8)
        ids.add(gather(self._ids.data, self._id_at[keep], self._n_ids[keep].astype(np.int64)))
        raw.add(gather(self._bytes.data, self._byte_at[keep], self._n_bytes[keep].astype(np.int64)))
        self._ids, self._bytes = ids, raw
        self._hashes, self._n_ids, self._n_bytes = self._hashes[keep], self._n_ids[keep], self._n_bytes[keep]
        self._id_at, self._byte_at = offsets_of(self._n_ids)[:-1], offsets_of(self._n_bytes)[:-1]
        self._again = np.zeros(len(self._hashes), bool)

    def _add(self, data: np.ndarray, hashes: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        raw = gather(data, starts, sizes)
        edges = offsets_of(sizes)
        blob = raw.tobytes()
        flat: list[int] = []
        counts = np.empty(len(starts), np.int32)
        for i, ids in enumerate(self._encode([blob[a:b].decode() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)])):
            flat.extend(ids)
            counts[i] = len(ids)
        id_at = self._ids.add(np.array(flat, np.int32)) + offsets_of(counts)[:-1]
        byte_at = self._bytes.add(raw) + edges[:-1]
        for name, values in (("_hashes", hashes), ("_id_at", id_at), ("_n_ids", counts), ("_byte_at", byte_at), ("_n_bytes", sizes), ("_again", False)):
            setattr(self, name, np.insert(getattr(self, name), at, values))

    def _spans(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends; first marks where texts begin, and the end of the data."""
        space = IS_SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        if self.keep_space:
            starts = np.flatnonzero(first[:-1] | (space & ~before))
            return starts, np.append(starts[1:], len(data))
        starts = np.flatnonzero(~space & (before | first[:-1]))
        after = np.concatenate((space[1:], [True]))
        return starts, np.flatnonzero(~space & (after | first[1:])) + 1

    def _plainly(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the spans and how many each has, by the spans' own bytes."""
        blob = data.tobytes()
        spans = [blob[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        distinct = list(dict.fromkeys(spans))
        known = dict(zip(distinct, map(list, self._encode([s.decode() for s in distinct])), strict=True))
        ids = [known[s] for s in spans]
        return np.array([x for some in ids for x in some], np.int32), np.array([len(some) for some in ids], np.int64)

    def _found(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """As _plainly(), through the table; None if two spans share a hash."""
        sizes = ends - starts
        hashes, where, which = np.unique(hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        if (sizes != sizes[where][which]).any() or (gather(data, starts, sizes) != gather(data, starts[where][which], sizes)).any():
            return None
        if len(self._hashes) > self.limit or self._bytes.used > 32 * self.limit:
            self._forget()
        at = np.searchsorted(self._hashes, hashes)
        old = np.zeros(len(hashes), bool)
        inside = at < len(self._hashes)
        old[inside] = self._hashes[at[inside]] == hashes[inside]
        mine, slot = where[old], at[old]
        if (self._n_bytes[slot] != sizes[mine]).any():
            return None
        if (gather(self._bytes.data, self._byte_at[slot], sizes[mine]) != gather(data, starts[mine], sizes[mine])).any():
            return None
        self._again[slot] = True
        if not old.all():
            new = where[~old]
            self._add(data, hashes[~old], at[~old], starts[new], ends[new])
            at = np.searchsorted(self._hashes, hashes)
        slots = at[which]
        lengths = self._n_ids[slots].astype(np.int64)
        return gather(self._ids.data, self._id_at[slots], lengths), lengths

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts and their offsets by text."""
        edges = offsets_of(np.array([len(t) for t in texts], np.int64))
        data = np.frombuffer(b"".join(texts), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        first = np.zeros(len(data) + 1, bool)
        first[edges] = True
        starts, ends = self._spans(data, first)
        ids, lengths = self._found(data, starts, ends) or self._plainly(data, starts, ends)
        return ids, offsets_of(lengths)[np.searchsorted(starts, edges)]
