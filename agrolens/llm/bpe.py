"""Operator 4, byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Adjacent parts are a doubly linked list of positions; each pair whose bytes are a token waits in
the bucket of its merge rank. A bitmap over ranks, in levels, gives the next rank by
find-first-set; an entry is stale, and skipped, when its position no longer starts a pair of
that rank. Within a rank the leftmost position is served first.

``Bpe.merge_all`` serves all pre-tokens of a batch that no cache holds from one queue over their
joined bytes, with a barrier between them. Buckets hold blocks of 4096 ranks; in a block, two
levels of 64 bits for each pre-token give its next rank, and the pairs of all these ranks are
merged, relinked and looked up as arrays. ``Bpe.merge`` is the same queue, with a bucket per
rank, for one pre-token over LONG bytes: n bytes cost O(n log n), also when they are megabytes.

Texts are cut into pieces at spaces that no pattern match can cross; pieces are looked up in a
bounded cache first. Vocabulary file and pattern are parameters.

Defined results: NULL text is encoded like the empty text (no ids); every id decodes to its
bytes, so decoding gives the text back exactly; repeated rows each get a row; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import small_batches

PIECES = 300_000      # cached pieces of a worker: about 60 MB
PARTS = 600_000       # cached pre-tokens of a worker: about 120 MB
CACHE_CHARS = 40      # longer ones are never cached
LONG = 1024           # bytes above which a pre-token has a queue of its own
TEXT_CHARS = 4 << 20  # characters encoded at a time; a longer text is cut where no match can cross
QUEUE_BYTES = 2 << 20  # bytes of pre-tokens in one queue: about 100 MB of arrays
_WORD = 256           # ranks per word of the lower bitmap
_BLOCK = 12           # log2 of the ranks in a bucket of the batch queue: 64 words of 64
_CUT = re.compile(r" (?=\S)")  # \S of the standard library: str.isspace, wider than the pattern's
_SHARED: dict = {}    # the encoder of a Python worker, kept with its caches from task to task


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from the rank file of a fixed vocabulary (about 50,000 lines)."""
    with open(path, "rb") as f:  # a file of an installed package on the driver, not an input table
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Bpe:
    """Encoder and decoder for one vocabulary and pattern; holds the worker's caches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values(), default=0) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        # (left rank, right rank) -> rank of the joined token, for every way to cut a token in two
        self.pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t))
                      if t[:k] in ranks and t[k:] in ranks}
        # The same table as sorted arrays (closed by a key that no pair has), and as a table over byte values;
        # part ``_wall`` is the barrier between pre-tokens and is in no pair.
        self._wall = 1 << 31
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.fromiter(self.pairs.values(), np.int64, len(keys))[order], -1)
        self._bytes = np.array([*self.bytes, self._wall], dtype=np.int64)
        self._first = self._pair(np.repeat(self._bytes, 257), np.tile(self._bytes, 257)).reshape(257, 257)
        # A merge to one of these ranks can open a pair of a lower rank, which goes first.
        self._hasty = np.zeros(max(ranks.values(), default=0) + 1, dtype=bool)
        for k, r in self.pairs.items():
            for x in (k >> 32, k & 0xFFFFFFFF):
                if x > r:
                    self._hasty[x] = True
        self.low = [0] * (max(ranks.values(), default=0) // _WORD + 1)  # bit per rank
        self.buckets: dict = {}  # rank -> its position, or a heap of them
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of parts, -1 where their bytes are no token."""
        key = a << 32 | b
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of each of several pre-tokens."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        code = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        walls = np.concatenate([[0], np.cumsum(sizes)])
        code[walls] = 256
        n = len(code)
        part = self._bytes[code]
        owner = np.repeat(np.arange(len(words) + 1), np.append(sizes, 1))
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        want = np.append(self._first[code[:-1], code[1:]], -1)  # rank of the pair that starts here
        buckets, high = {}, 0

        def push(at):
            nonlocal high
            block = want[at] >> _BLOCK
            for b in np.flatnonzero(np.bincount(block)).tolist():
                buckets.setdefault(b, []).append(at[block == b])
                high |= 1 << b

        push(np.flatnonzero(want >= 0))
        one = np.uint64(1)

        def next_of(bit, mine):
            """Whether an entry has the lowest bit of its pre-token's entries."""
            heads = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            seen = np.bitwise_or.reduceat(bit, heads)
            return bit == np.repeat(seen & (~seen + one), np.diff(heads, append=len(mine)))

        while high:
            block = (high & -high).bit_length() - 1
            at = np.sort(np.concatenate(buckets.pop(block)))
            at = at[(want[at] >> _BLOCK == block) & np.append(True, at[1:] != at[:-1])]  # the others are stale
            high &= high - 1
            if not len(at):
                continue
            rank = want[at]
            now = next_of(one << (rank >> 6 & 63).astype(np.uint64), owner[at])
            some = np.flatnonzero(now)
            now[some] = next_of(one << (rank[some] & 63).astype(np.uint64), owner[at[some]])
            i, rank = at[now], rank[now]
            # Of pairs of one rank that overlap in a row, every other one from the left is merged; with a hasty rank only the first.
            heads = np.append(True, after[i[:-1]] != i[1:])
            run = np.flatnonzero(heads)
            take = (np.arange(len(i)) - np.repeat(run, np.diff(run, append=len(i)))) & 1 == 0
            take &= ~self._hasty[rank] | np.append(True, owner[i[1:]] != owner[i[:-1]])
            wait = [at[~now], i[~take]]
            i, rank = i[take], rank[take]
            j = after[i]
            k = after[j]
            part[i], after[i], before[k], want[j], part[j] = rank, k, i, -1, -1
            h = before[i]
            want[i] = self._pair(rank, part[k])
            want[h] = self._pair(part[h], rank)
            at = np.concatenate([i, h, *wait])
            push(at[want[at] >= 0])
        kept = (part >= 0) & (part != self._wall)
        count = np.concatenate([[0], np.cumsum(kept)])[walls] * 4
        ids = part[kept].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(count.tolist(), count[1:].tolist())]

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        low, buckets, pair, high = self.low, self.buckets, self.pairs.get, 0
        part = [self.bytes[b] for b in data]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        want = [pair(a << 32 | b) for a, b in zip(part, part[1:])]  # rank of the pair that starts here
        want.append(None)
        for i, r in enumerate(want):
            if r is not None:
                if r not in buckets:
                    buckets[r] = i
                    low[r >> 8] |= 1 << (r & 255)
                    high |= 1 << (r >> 8)
                elif type(buckets[r]) is int:
                    buckets[r] = [buckets[r], i]
                else:
                    buckets[r].append(i)  # ascending positions are a heap already
        while high:
            w = (high & -high).bit_length() - 1
            word = low[w]
            r = (w << 8) + (word & -word).bit_length() - 1
            i = buckets[r]
            if type(i) is int:
                del buckets[r]
            else:
                heap, i = i, heapq.heappop(i)
                if not heap:
                    del buckets[r]
            if r not in buckets:
                low[w] = word = word & (word - 1)
                if not word:
                    high &= high - 1
            if want[i] != r:
                continue  # stale
            j = after[i]
            part[i] = r
            k = after[i] = after[j]
            want[j] = None
            h = before[i]
            if k < n:
                before[k] = i
                changed = ((i, pair(r << 32 | part[k])), (h, pair(part[h] << 32 | r) if h >= 0 else None))
            else:
                changed = ((i, None), (h, pair(part[h] << 32 | r) if h >= 0 else None))
            for at, rank in changed:
                if at < 0:
                    continue
                want[at] = rank
                if rank is not None:
                    if rank not in buckets:
                        buckets[rank] = at
                        low[rank >> 8] |= 1 << (rank & 255)
                        high |= 1 << (rank >> 8)
                    elif type(buckets[rank]) is int:
                        first = buckets[rank]
                        buckets[rank] = [first, at] if first < at else [at, first]
                    else:
                        heapq.heappush(buckets[rank], at)
        out, i = [], 0
        while i < n:
            out.append(part[i])
            i = after[i]
        return out

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of pre-tokens: a token of its own, a long one by itself, all others from one queue."""
        data = [x.encode("utf-8") for x in parts]
        out = list(map(self.ranks.get, data))
        some, size = [], 0
        for i, (whole, x) in enumerate(zip(out, data)):
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(x) > LONG:
                out[i] = np.array(self.merge(x), dtype="<u4").tobytes()
            else:
                some.append(i)
                size += len(x)
        step = max(1, len(some) * QUEUE_BYTES // max(size, 1))
        for a in range(0, len(some), step):
            at = some[a:a + step]
            for i, ids in zip(at, self.merge_all([data[i] for i in at])):
                out[i] = ids
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        if len(self.parts) > PARTS:
            self.parts.clear()
        # A match may only start with a space, never hold one further in, unless it is a run of white space, which
        # leaves its last space to a word behind it. So a text may be cut before each space that a word follows.
        flat, ends = [], [0]
        for t in texts:
            at = len(flat)
            flat += _CUT.split(t)
            flat[at] = (flat[at],)  # the only piece without a space before it
            ends.append(len(flat))
        ids = list(map(self.pieces.get, flat))
        missing = [i for i, x in enumerate(ids) if x is None]
        new = {flat[i] for i in missing}
        first = [p for p in new if type(p) is tuple]
        plain = [p for p in new if type(p) is str and p.isascii() and p.isalpha()]  # one match, without a search
        other = list(new.difference(plain, first))
        got = dict(zip(plain, self._ids([" " + p for p in plain])))
        spaced = [" " + p for p in other]
        found = self.find("".join(spaced))  # no match crosses from one into the next
        found_first = [self.find(p[0]) for p in first]
        parts = list(set(chain(found, *found_first)).difference(self.parts))
        self.parts.update(zip(parts, self._ids(parts)))
        known = self.parts.__getitem__
        found_ids = list(map(known, found))
        at = np.searchsorted(np.cumsum(list(map(len, found))), np.cumsum(list(map(len, spaced)))) + 1  # matches up to a piece's end
        at = np.concatenate([[0], np.cumsum(list(map(len, found_ids)))]).astype(np.int64)[at].tolist()
        joined = b"".join(found_ids)
        got.update((p, joined[a:b]) for p, a, b in zip(other, [0, *at], at))
        got.update((p, b"".join(map(known, m))) for p, m in zip(first, found_first))
        for i in missing:
            ids[i] = got[flat[i]]
        self.pieces.update((p, x) for p, x in got.items() if type(p) is str and len(p) <= CACHE_CHARS)
        for x in parts:
            if len(x) > CACHE_CHARS:
                del self.parts[x]
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:])]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as little-endian unsigned 32-bit integers."""
        out, some, chars = [], [], 0
        for t in texts:
            if some and chars + len(t) > TEXT_CHARS:
                out += self._encode(some)
                some, chars = [], 0
            if len(t) > TEXT_CHARS:
                out.append(b"".join(self._encode([x])[0] for x in _slices(t, TEXT_CHARS)))
            else:
                some.append(t)
                chars += len(t)
        return out + self._encode(some)

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _slices(text: str, chars: int):
    """A text in slices of at least ``chars`` characters, cut before a space that a word follows."""
    a = 0
    while a < len(text):
        cut = _CUT.search(text, a + chars)
        b = cut.start() if cut else len(text)
        yield text[a:b]
        a = b


def _encoder(ranks, key: tuple, pattern: str) -> Bpe:
    """The worker's encoder for a broadcast vocabulary; ``key`` names vocabulary and pattern."""
    if key not in _SHARED:
        _SHARED.clear()
        _SHARED[key] = Bpe(ranks.value, pattern)
    return _SHARED[key]


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; with ``keep_ids`` also the ids."""
    spark = docs.sparkSession
    small_batches(spark)
    fixed = read_ranks(ranks_path)
    key = (hashlib.sha256(repr(sorted(fixed.items())).encode()).hexdigest(), pattern)
    ranks = spark.sparkContext.broadcast(fixed)  # a fixed vocabulary file
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches):
        bpe = _encoder(ranks, key, pattern)
        for b in batches:
            rows = [[], [], [], []]
            arrays = []
            for ids in bpe.encode_many([t or "" for t in b.column(1).to_pylist()]):
                rows[0].append(len(ids) // 4)
                rows[1].append(hashlib.sha256(ids).hexdigest())
                rows[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if keep_ids:
                    arrays.append(np.frombuffer(ids, dtype="<i4"))
            out = [b.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                out.append(pa.array(arrays, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
