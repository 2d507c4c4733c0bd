"""Byte-level BPE over length-bucketed padded numpy matrices.

Pieces of a bucket of lengths are the rows of one matrix. In a round every row finds its leftmost
pair of the smallest rank through a hashed table of pairs, merges it, with all later occurrences of
that pair where no pair of a smaller rank arises on the way, and is compacted. Every length goes this way.

Defined results: null text is empty and has no tokens; repeated rows are encoded each; other columns
stay as they are, whatever their names, but the added ones are replaced.
"""
import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_udf

_STATE: dict = {}
NONE = 1 << 30
#: Cells of one matrix.
CELLS = 1 << 17
#: Where both results stand for a moment; no column of a table is called so.
BOTH = "cadenza:decoded"


class Encoder:
    """Ranks, a hashed table of pairs, and a bounded cache of encoded pieces."""

    def __init__(self, path, pattern, cache_size=200_000):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.first = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.mask = (1 << (len(pairs) * 4).bit_length()) - 1
        self.keys, self.vals = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, NONE, np.int64)
        key, val = np.array(list(pairs), dtype=np.int64), np.array(list(pairs.values()), dtype=np.int64)
        at, self.probes = self._slot(key), 0
        while len(key):
            free = self.keys[at] == -1
            pick = np.flatnonzero(free)
            pick = pick[np.unique(at[pick], return_index=True)[1]]
            self.keys[at[pick]], self.vals[at[pick]] = key[pick], val[pick]
            rest = np.ones(len(key), bool)
            rest[pick] = False
            key, val, at = key[rest], val[rest], (at[rest] + 1) & self.mask
            self.probes += 1
        self.cache, self.cache_size = {}, cache_size

    def _slot(self, key):
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def rank_of(self, a, b):
        key = a << 20 | b
        at, out = self._slot(key), np.full(key.shape, NONE, np.int64)
        for _ in range(self.probes):
            got = self.keys[at]
            np.copyto(out, self.vals[at], where=got == key)
            if ((got == key) | (got == -1)).all():
                break
            at = (at + 1) & self.mask
        return out

    def merge_matrix(self, m, size):
        """Rows of m, of which the first `size` cells count -> a list of int32 arrays, each row merged to its end."""
        out, row, n = [None] * len(m), np.arange(len(m)), m.shape[1]
        rank = np.full(m.shape, NONE)
        if n > 1:
            rank[:, :-1] = self.rank_of(m[:, :-1], m[:, 1:])
        rank[np.arange(n)[None] >= size[:, None] - 1] = NONE
        while True:
            best = rank.min(1)
            for k in np.flatnonzero(best == NONE):
                out[row[k]] = m[k, : size[k]].astype("<i4")
            go = best != NONE
            if not go.any():
                return out
            row, m, size, rank, best = row[go], m[go], size[go], rank[go], best[go]
            take = self._occurrences(m, size, rank, best)
            keep = np.arange(m.shape[1])[None] < size[:, None]
            keep[:, 1:] &= ~take[:, :-1]
            m, size = np.where(take, best[:, None], m), size - take.sum(1)
            i, j = np.nonzero(keep)
            to = (keep.cumsum(1) - 1)[i, j]
            shape = len(row), int(size.max())
            tokens, ranks = np.zeros(shape, np.int64), np.full(shape, NONE)
            tokens[i, to], ranks[i, to], merged = m[i, j], rank[i, j], take[i, j]
            m, rank = tokens, ranks
            i, j = i[merged], to[merged]
            for i, j in ((i, j), (i[j > 0], j[j > 0] - 1)):  # only pairs with a new token change
                inner = j + 1 < size[i]
                rank[i, j] = NONE
                i, j = i[inner], j[inner]
                rank[i, j] = self.rank_of(m[i, j], m[i, j + 1])

    def _occurrences(self, m, size, rank, best):
        """Mask of the pairs that each row merges this round."""
        hit = rank == best[:, None]
        first = hit.argmax(1)
        lone = np.zeros(m.shape, bool)
        lone[np.arange(len(m)), first] = True
        rows = np.flatnonzero(hit.sum(1) > 1)
        if not len(rows):
            return lone
        hit, m, size, best = hit[rows], m[rows], size[rows], best[rows]
        # of a run of overlapping occurrences every second one counts, from the left
        col = np.arange(m.shape[1])[None]
        gap = np.maximum.accumulate(np.where(hit, -1, col), axis=1)
        take = hit & ((col - gap) % 2 == 1)
        # pairs that arise while merging from the left: with what stands before, merged already, and with the raw next
        i, j = np.nonzero(take)
        new = best[i]
        before = np.where((j >= 2) & take[i, j - 2], new, m[i, np.maximum(j - 1, 0)])
        low = np.where(j >= 1, self.rank_of(before, new), NONE)
        nxt = m[i, np.minimum(j + 2, m.shape[1] - 1)]
        low = np.minimum(low, np.where(j + 2 < size[i], self.rank_of(new, nxt), NONE))
        fine = np.ones(len(rows), bool)
        fine[i[low < new]] = False
        lone[rows[fine]] = take[fine]
        return lone

    def learn(self, pieces):
        """Put the ids of new pieces into the cache."""
        by = {}
        for p in pieces:
            b = p.encode("utf-8")
            if (r := self.ranks.get(b)) is not None:
                self.cache[p] = r.to_bytes(4, "little")
            else:
                by.setdefault(-(-len(b) // 4) * 4 if len(b) <= 64 else 1 << (len(b) - 1).bit_length(), []).append((p, b))
        for width, group in by.items():
            step = max(1, CELLS // width)
            for k in range(0, len(group), step):
                part = group[k : k + step]
                size = np.array([len(b) for _, b in part])
                m = self.first[np.frombuffer(b"".join(b.ljust(width, b"\0") for _, b in part), dtype=np.uint8).reshape(-1, width)]
                for (p, _), ids in zip(part, self.merge_matrix(m[:, : size.max()], size)):
                    self.cache[p] = ids.tobytes()

    def encode(self, texts):
        """Little-endian int32 ids of each text, as bytes."""
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        out, todo = [], []
        for t in texts:
            todo.append(self.find(t) if t else [])
        new = {p for ps in todo for p in ps if p not in self.cache}
        self.learn(new)
        get = self.cache.__getitem__
        for ps in todo:
            out.append(b"".join(map(get, ps)))
        return out


def encoder(path, pattern):
    if (path, pattern) not in _STATE:
        _STATE[path, pattern] = Encoder(path, pattern)
    return _STATE[path, pattern]


def bpe_encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds token_ids array<int> (and replaces a column of that name)."""

    def run(texts):
        ids = encoder(path, pattern).encode([t.decode("utf-8") for t in texts])
        ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))

    return docs.withColumn("token_ids", text_udf(run, "array<int>")(text))


def bpe_decode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds decoded binary, and ids_bytes binary (little-endian unsigned 32-bit); of null token_ids both are empty."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = encoder(path, pattern).bytes_of.__getitem__
        for b in batches:
            out = []
            for k in range(0, len(b), 200):
                ids = [x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32) for x in b.slice(k, 200)]
                out.append(pa.StructArray.from_arrays([pa.array([b"".join(map(get, x.tolist())) for x in ids], pa.binary()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=["decoded", "ids_bytes"]))
            yield pa.concat_arrays(out) if out else pa.array([], pa.struct([("decoded", pa.binary()), ("ids_bytes", pa.binary())]))

    x = docs.withColumn(BOTH, F.arrow_udf(run, "struct<decoded:binary,ids_bytes:binary>").asNondeterministic()("token_ids"))
    return x.withColumns({"decoded": F.col(f"{BOTH}.decoded"), "ids_bytes": F.col(f"{BOTH}.ids_bytes")}).drop(BOTH)
