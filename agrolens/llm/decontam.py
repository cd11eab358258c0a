"""Operator 7, benchmark decontamination with training suffix arrays.

Documents are split into shards: consecutive whole documents of an input partition, SHARD_WORDS
words or one very long document. Each shard's words become ids of the benchmark vocabulary
(-1 for all others, which ends a match), and its suffixes are sorted by their first words into
a suffix array. Only suffixes that start a run of benchmark words as long as the shortest
window are sorted; no other can start a match. Every benchmark suffix that starts a window is
then binary-searched in the array: the range of suffixes with that window as prefix gives the
locations, and each match is extended to its longest verbatim length.

Window: 10 consecutive item words; an item of fewer words, but not none, is one window.
A benchmark of one block (BLOCK_BYTES of text) is broadcast, and no text is shuffled. A larger one is
cut into blocks: one job for each writes the matches of the documents it hits and frees the block
before the next is read, so driver and workers hold one block at a time; the written matches are joined at last.

Defined results: NULL or blank text has no words; NULL item texts have no windows; a NULL
item_id counts as the item "null"; repeated items with one id count once, equal texts under
several ids count for each; repeated documents each get a row; extra columns are ignored;
without items nothing is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import small_batches, write_scratch

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 64 << 20  # benchmark text broadcast at a time
# ASCII letters (lower-cased) and digits are word bytes, other ASCII is not, and
# every byte of a non-ASCII character is.
_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return (text or "").encode("utf-8").lower().translate(_WORD_BYTES).split()


class Block:
    """Windows of a block of benchmark items, as word ids, grouped by window length."""

    def __init__(self, items: list, window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.items = []  # (item id as text, word ids)
        grouped: dict[int, dict[tuple, list]] = {}
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words(text)]
            if not ids:
                continue
            n = min(window, len(ids))
            k = len(self.items)
            self.items.append(("null" if item_id is None else str(item_id), np.array(ids + [-2], dtype=np.int32)))
            for i in range(len(ids) - n + 1):
                grouped.setdefault(n, {}).setdefault(tuple(ids[i:i + n]), []).append((k, i))
        self.windows = {n: (np.array(list(g), dtype=np.int32), list(g.values())) for n, g in sorted(grouped.items())}
        self.shortest = min(self.windows, default=0)


def _suffix_array(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that start at ``at``, sorted by their first ``depth`` word ids."""
    padded = np.concatenate([ids, np.full(depth, -1, dtype=ids.dtype)])
    return at[np.lexsort([padded[at + k] for k in range(depth - 1, -1, -1)])]


def _bounds(ids: np.ndarray, order: np.ndarray, queries: np.ndarray):
    """Per query, the range of suffixes that have it as a prefix (binary search, all at once)."""
    m, n = queries.shape
    padded = np.concatenate([ids, np.full(n, -1, dtype=ids.dtype)])

    def search(after: bool):
        lo, hi = np.zeros(m, dtype=np.int64), np.full(m, len(order), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) // 2
            state = np.zeros(len(open_), dtype=np.int8)  # suffix against query: -1 less, 0 prefix equal, 1 more
            start = order[mid]
            for k in range(n):
                s, q = padded[start + k], queries[open_, k]
                state = np.where(state != 0, state, np.sign(s.astype(np.int64) - q).astype(np.int8))
            right = (state <= 0) if after else (state < 0)
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]

    return search(False), search(True)


def search_shard(docs: list[list[bytes]], block: Block) -> list[list[tuple]]:
    """Per document its matches (item number, item position, document position, longest length)."""
    found: list[list[tuple]] = [[] for _ in docs]
    if not block.windows:
        return found
    get = block.vocab.get
    sizes = np.array([len(d) + 1 for d in docs])
    ids = np.full(int(sizes.sum()), -1, dtype=np.int32)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for s, d in zip(starts, docs):
        ids[s:s + len(d)] = [get(w, -1) for w in d]
    ends = np.flatnonzero(ids < 0)  # every document ends with a -1
    run = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids))
    at = np.flatnonzero(run >= block.shortest)
    if not len(at):
        return found
    order = _suffix_array(ids, at, max(block.windows))
    for n, (queries, places) in block.windows.items():
        lo, hi = _bounds(ids, order, queries)
        for q in np.flatnonzero(hi > lo):
            for p in order[lo[q]:hi[q]]:
                doc = int(np.searchsorted(starts, p, side="right")) - 1
                for k, i in places[q]:
                    found[doc].append((k, i, int(p - starts[doc]), n))
    return found


def longest(words_: list[bytes], block: Block, item: int, i: int, p: int, n: int) -> int:
    """Length of the verbatim match from item position i at document position p, n words long at least."""
    ids = block.items[item][1]
    while p + n < len(words_) and block.vocab.get(words_[p + n], -1) == ids[i + n]:
        n += 1
    return n


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The items in blocks of about ``block_bytes`` of text, each read when asked for and small enough to broadcast."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("text"), F.lit(n))
    for k in range(n):
        yield [(r[0], r[1]) for r in benchmark.where(part == k).select("item_id", "text").distinct().collect()]


_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
_HIT = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_MATCH_SQL = "array<struct<item_id: string, start: bigint, length: bigint>>"
_HIT_SQL = "array<struct<start: bigint, length: bigint>>"


def _search(shared):
    """One narrow step: search every shard for one block's windows; earlier matches and hits are added to."""
    def flush(rows):
        block = shared.value
        tokens = [words(r[1]) for r in rows]
        n_hit = []
        for r, w, ms in zip(rows, tokens, search_shard(tokens, block)):
            reach: dict[tuple, int] = {}
            for k, i, p, n in sorted(ms, key=lambda m: (m[0], m[2] - m[1], m[2])):
                line = (k, p - i)  # windows of one verbatim match lie on one diagonal
                if p + n <= reach.get(line, -1):
                    continue
                size = longest(w, block, k, i, p, n)
                reach[line] = p + size
                r[2].append({"item_id": block.items[k][0], "start": p, "length": size})
            r[3] += [{"start": p, "length": n} for p, n in sorted({(m[2], m[3]) for m in ms})]
            hit = np.zeros(len(w), dtype=bool)
            for h in r[3]:
                hit[h["start"]:h["start"] + h["length"]] = True
            n_hit.append(int(hit.sum()))
        doc_id, _, matches, hits = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_id, pa.int64()), pa.array(matches, _MATCH), pa.array(hits, _HIT), pa.array(map(len, tokens), pa.int64()),
             pa.array(n_hit, pa.int64())], names=["doc_id", "matches", "hits", "n_words", "n_hit"])

    def run(batches):
        rows, size = [], 0
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns[:4]]):
                size += len(r[1] or "") // 6
                rows.append([r[0], r[1], r[2] or [], r[3] or []])
                if size >= SHARD_WORDS:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)
    return run


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every row of ``docs`` as doc_id, its longest verbatim matches (item, word position, words),
    the windows hit (word position, words), n_words and n_hit."""
    sc = docs.sparkSession.sparkContext
    small_batches(docs.sparkSession)
    schema = f"doc_id long, matches {_MATCH_SQL}, hits {_HIT_SQL}, n_words long, n_hit long"
    nothing = F.expr(f"cast(null as {_MATCH_SQL})").alias("matches"), F.expr(f"cast(null as {_HIT_SQL})").alias("hits")
    blocks = iter(benchmark_blocks(benchmark))
    first, second = next(blocks, []), next(blocks, None)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if second is None:
        return rows.select("*", *nothing).mapInArrow(_search(sc.broadcast(Block(first, window))), schema)
    key = F.xxhash64("doc_id", "text")
    found = []
    for items in chain([first, second], blocks):
        shared = sc.broadcast(Block(items, window))
        hit = (rows.select(key.alias("doc_id"), "text", *nothing).mapInArrow(_search(shared), schema)
               .where("n_hit > 0").select(F.col("doc_id").alias("__k"), "matches", "hits"))
        found.append(write_scratch(hit.dropDuplicates(["__k"]), "decontam-hits"))  # equal rows have equal matches
        shared.destroy()
    # One row for one key and block at most.
    whole = reduce(DataFrame.unionByName, found).groupBy("__k").agg(
        F.flatten(F.collect_list("matches")).alias("matches"), F.flatten(F.collect_list("hits")).alias("hits"))
    return (rows.join(whole, key == F.col("__k"), "left").select("doc_id", "text", "matches", "hits")
            .mapInArrow(_search(sc.broadcast(Block([], window))), schema))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    items = F.array_sort(F.array_distinct(F.col("matches")["item_id"]))
    return find_matches(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit. Rows are matched by content, not by id."""
    key = F.xxhash64("doc_id", "text")
    marked = docs.select(key.alias("doc_id"), "text")
    bad = find_matches(marked, benchmark, window).where("n_hit > 0").select(F.col("doc_id").alias("__bad")).distinct()
    return docs.withColumn("__key", key).join(bad, F.col("__key") == F.col("__bad"), "left_anti").drop("__key")
