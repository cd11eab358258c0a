"""Operator 8, substring dedup with a count-min prefilter and exact second pass.

A window is 35 consecutive words. Each window is represented by its minimiser: the smallest
hash among its sixteen 20-word grams. Equal windows have equal minimisers at equal offsets, so
a window that repeats has a minimiser that occurs at two places or more.

Pass 1 counts minimiser occurrences (about an eighth of the windows) in count-min sketches: one
sketch of saturating byte counters per input partition, cut into slices, merged slice by slice.
The merged sketch overestimates every count, so no repeated window is lost. Its width follows
the input up to MAX_WIDTH_LOG2; a fuller sketch only lets more windows through to pass 2.

Pass 2 rereads the texts and keeps the windows whose minimiser is estimated at two or more.
Consecutive windows with one minimiser form a packed row, dealt out by that minimiser; windows are
then grouped exactly by (minimiser, window hash), 128 bits. A minimiser estimated over HOT
occurrences is dealt out to SALTS groups or more (a quarter of the tasks, so that a minimiser in
every text fills no task); each task resolves what it can and sends one row per distinct window
to a second grouping, which thus sees one row a window and group at most. The group follows from
the row, the place and the input partition alone, so a retried task deals alike.

The words covered by repeated windows are removed in a last join by row key.

A text is read in pieces of PIECE_CHARS and hashed in blocks of BLOCK_BYTES that overlap by a window, so
words and hashes of one block are in memory, however long the text. A word over LONG_WORD bytes is
hashed as its digest.

Defined results: NULL or blank text has no words; fewer than 35 words have no window; rows
that repeat count as separate occurrences, so all their windows repeat; a NULL doc_id is
kept as it is; extra columns are ignored (``dedup_texts`` carries them); no rows, no result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import small_batches, write_scratch

WINDOW = 35
GRAM = 20
SPAN = WINDOW - GRAM + 1   # grams in a window, and windows in a packed row
DEPTH = 2                  # rows of the count-min sketch
MAX_WIDTH_LOG2 = 26        # columns a row: bounds a sketch at DEPTH * 64 MB, its broadcast at a quarter of that
SLICE_LOG2 = 20
HOT = 200                  # estimated occurrences above which a minimiser is salted
SALTS = 64                 # groups at least that a hot minimiser is dealt out to
PART_BYTES = 64 << 20     # packed windows that one task groups in memory
PIECE_CHARS = 1 << 18     # characters of a text split into words at a time
BLOCK_BYTES = 1 << 18     # bytes of words hashed at a time, besides the overlap
PACKED_ROWS = 1 << 16     # packed rows that leave a worker at a time, about
COUNTED = 1 << 20         # minimisers counted at a time
LONG_WORD = 4096          # bytes; a longer word is hashed as its digest
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # odd, so that they have inverses modulo 2^64
_STATE: dict = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int):
    """Powers of base and of its inverse modulo 2^64, n of each at least; and byte values."""
    if base not in _STATE or len(_STATE[base][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:  # doubling: p[done:2 done] = p[:done] * b^done
                p[done:2 * done] = p[:done] * np.uint64(pow(b, done, 1 << 64))
                done *= 2
            out.append(p)
        _STATE[base] = (*out, _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base)))
    return _STATE[base]


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int, *sizes: int) -> list[np.ndarray]:
    """Hashes of all runs of ``size`` words (joined by one space), for each size."""
    power, inverse, values = _powers(base, len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * power[:len(data)], dtype=np.uint64)])
        return [_mix((total[ends[n - 1:]] - total[starts[:len(starts) - n + 1]]) * inverse[starts[:len(starts) - n + 1]]
                     + np.uint64(n)) for n in sizes]


def _slide(x: np.ndarray, fn) -> np.ndarray:
    """fn over every SPAN = 16 neighbours, by doubling."""
    for step in (1, 2, 4, 8):
        x = fn(x[:-step], x[step:])
    return x


def word_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, in lists that cover PIECE_CHARS characters each."""
    text, held = text or "", []  # held: the pieces of a word that may go on
    for a in range(0, len(text), PIECE_CHARS):
        data = text[a:a + PIECE_CHARS].encode("utf-8")
        words = data.split()
        if held and not data[:1].isspace():
            held.append(words.pop(0))
        if held and (words or data[-1:].isspace()):
            words.insert(0, b"".join(held))
            held = []
        if words and not data[-1:].isspace() and a + PIECE_CHARS < len(text):
            held.append(words.pop())
        yield words
    if held:
        yield [b"".join(held)]


def _blocks(text: str | None) -> Iterator[tuple[int, list[bytes], bool]]:
    """(number of its first word, words, whether it is the last) of overlapping blocks of a text.

    A block owns the windows that start in it, but not those of the next one; it also holds the SPAN - 1 words
    before its first own one (unless it is the first), for the windows that reach back.
    """
    at, words, size = 0, [], 0
    if len(text or "") < PIECE_CHARS // 4:  # at most one block
        words = (text or "").encode("utf-8").split()
        if all(len(w) <= LONG_WORD for w in words):
            yield 0, words, True
            return
        words = []
    for piece in word_pieces(text):
        for w in piece:
            w = w if len(w) <= LONG_WORD else hashlib.sha256(w).digest()
            words.append(w)
            size += len(w) + 1
            if size > BLOCK_BYTES and len(words) >= 4 * WINDOW:
                yield at, words, False
                keep = WINDOW - 1 + SPAN - 1
                at += len(words) - keep
                words = words[-keep:]
                size = sum(map(len, words)) + keep
    yield at, words, True


def minimisers(text: str | None, with_windows: bool = False):
    """In blocks: number of the first window; per window its minimiser hash; the hashes of chosen gram
    occurrences; window hashes if asked. Each window and each chosen occurrence comes in one block."""
    for at, words, last in _blocks(text):
        if len(words) < WINDOW:
            continue
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        data = np.frombuffer(b" ".join(words), dtype=np.uint8)
        gram, = _grams(data, starts, ends, _BASES[0], GRAM)
        low = _slide(gram, np.minimum)
        edge = np.zeros(SPAN - 1, dtype=np.uint64)
        is_chosen = gram == _slide(np.concatenate([edge, low, edge]), np.maximum)
        back = SPAN - 1 if at else 0  # windows of the block before
        own = slice(back, None if last else len(low))
        window = _grams(data, starts, ends, _BASES[1], WINDOW)[0][back:] if with_windows else None
        yield at + back, low[back:], gram[own][is_chosen[own]], window


def _cells(h: np.ndarray, width_log2: int) -> list[np.ndarray]:
    return [(_mix(h + np.uint64((k + 1) * _BASES[k % 2] % (1 << 64))) >> np.uint64(64 - width_log2)).astype(np.int64)
            for k in range(DEPTH)]


def width_log2(chars: int) -> int:
    """Four columns for each expected minimiser (about one in 50 characters), within bounds."""
    return max(SLICE_LOG2, min(MAX_WIDTH_LOG2, math.ceil(math.log2(max(1, chars * 4 / 50)))))


def _partition_sketch(log2: int):
    """One sketch per input partition, as compressed slices of byte counters."""
    def run(batches):
        sketch = np.zeros((DEPTH, 1 << log2), dtype=np.uint8)
        for b in batches:
            found, held = [], 0
            for chosen in chain((m[2] for text in b.column(0).to_pylist() for m in minimisers(text)), [None]):
                if chosen is not None:
                    found.append(chosen)
                    held += len(chosen)
                if found and (chosen is None or held >= COUNTED):
                    for row, cells in zip(sketch, _cells(np.concatenate(found), log2)):
                        at, n = np.unique(cells, return_counts=True)
                        row[at] = np.minimum(row[at] + n, 255)
                    found, held = [], 0
        pack = zstandard.ZstdCompressor(level=1).compress
        size = 1 << SLICE_LOG2
        for k in range(DEPTH):
            for s in range(1 << (log2 - SLICE_LOG2)):
                part = sketch[k, s * size:(s + 1) * size]
                if part.any():
                    yield pa.RecordBatch.from_pydict(
                        {"part": [k << 32 | s], "counts": [pack(part.tobytes())]},
                        schema=pa.schema([("part", pa.int64()), ("counts", pa.binary())]))
    return run


def _merge_slices(hot: int):
    """Add up the slices that a task was dealt; emit bitmaps of counts over 1 and over ``hot``."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x = np.frombuffer(unpack(counts), dtype=np.uint8)
                total[part] = np.minimum(total[part].astype(np.uint16) + x, 255).astype(np.uint8) if part in total else x
        for part, x in total.items():
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "twice": [np.packbits(x > 1).tobytes()], "hot": [np.packbits(x > hot).tobytes()]},
                schema=pa.schema([("part", pa.int64()), ("twice", pa.binary()), ("hot", pa.binary())]))
    return run


def sketch_bitmaps(docs: DataFrame, log2: int, over: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged count-min sketch as two bitmaps (DEPTH rows): cells over 1, cells over ``over``."""
    slices = DEPTH << (log2 - SLICE_LOG2)
    rows = (docs.select("text").mapInArrow(_partition_sketch(log2), "part long, counts binary")
            .repartition(min(slices, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "part")
            .mapInArrow(_merge_slices(over), "part long, twice binary, hot binary").collect())
    twice, hot = (np.zeros((DEPTH, (1 << log2) // 8), dtype=np.uint8) for _ in range(2))
    size = (1 << SLICE_LOG2) // 8
    for r in rows:
        k, s = r["part"] >> 32, r["part"] & 0xFFFFFFFF
        twice[k, s * size:(s + 1) * size] = np.frombuffer(r["twice"], dtype=np.uint8)
        hot[k, s * size:(s + 1) * size] = np.frombuffer(r["hot"], dtype=np.uint8)
    return twice, hot


def _test(bitmap: np.ndarray, cells: list[np.ndarray]) -> np.ndarray:
    """True where every row of the sketch has the bit set."""
    out = np.ones(len(cells[0]), dtype=bool)
    for row, c in zip(bitmap, cells):
        out &= (row[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
    return out


_PACKED = pa.schema([("m", pa.int64()), ("salt", pa.int32()), ("row", pa.int64()), ("at", pa.int32()), ("hashes", pa.binary())])


def _candidates(shared, log2: int, salts: int):
    """Packed rows of windows whose minimiser may repeat: (m, salt, row, first window, hashes)."""
    def run(batches):
        twice, hot = shared.value
        here = TaskContext.get().partitionId()
        for b in batches:
            out = [[], [], [], [], []]
            for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for start, low, _, window in minimisers(text, True):
                    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
                    cells = _cells(low[first], log2)
                    maybe, many = _test(twice, cells), _test(hot, cells)
                    stop = np.append(first[1:], len(low))
                    for f, e, h in zip(first[maybe].tolist(), stop[maybe].tolist(), many[maybe].tolist()):
                        m = int(low[f].view(np.int64))
                        for a in range(f, e, SPAN):
                            out[0].append(m)
                            out[1].append(1 + (row + start + a + here) % salts if h else 0)
                            out[2].append(row)
                            out[3].append(start + a)
                            out[4].append(window[a:min(e, a + SPAN)].tobytes())
                    if len(out[0]) >= PACKED_ROWS:
                        yield pa.RecordBatch.from_pydict(dict(zip(_PACKED.names, out)), schema=_PACKED)
                        out = [[], [], [], [], []]
            yield pa.RecordBatch.from_pydict(dict(zip(_PACKED.names, out)), schema=_PACKED)
    return run


_FOUND = pa.schema([("m", pa.int64()), ("h", pa.int64()), ("row", pa.int64()), ("at", pa.int32()), ("mask", pa.int32())])


def _resolve(batches):
    """Group one task's windows by (m, salt, hash). Rows with a mask are settled windows of a packed
    row; rows with mask 0 are one per distinct window of a salted group, still to be compared with
    the other salts: (row, at) is the window itself where it is alone so far, else row is NULL."""
    parts = list(batches)
    table = pa.Table.from_batches(parts, schema=_PACKED)
    if not len(table):
        return
    size = np.array([len(x) for x in table.column("hashes").to_pylist()]) // 8
    h = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype=np.int64)
    src = np.repeat(np.arange(len(size)), size)
    off = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    m, salt, row, at = (table.column(c).to_numpy() for c in ("m", "salt", "row", "at"))
    order = np.lexsort((h, salt[src], m[src]))
    a, b = order[:-1], order[1:]
    same = (h[a] == h[b]) & (m[src[a]] == m[src[b]]) & (salt[src[a]] == salt[src[b]])
    new = np.concatenate([[True], ~same])
    group = np.cumsum(new) - 1
    count = np.bincount(group)
    many = np.zeros(len(h), dtype=bool)
    many[order] = count[group] > 1
    mask = np.bincount(src[many], weights=2.0 ** off[many], minlength=len(size)).astype(np.int32)
    on = mask > 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(m[on]), pa.nulls(int(on.sum()), pa.int64()), pa.array(row[on]), pa.array(at[on]), pa.array(mask[on])], schema=_FOUND)
    lead = order[new]
    lead = lead[salt[src[lead]] > 0]
    if len(lead):
        s = src[lead]
        yield pa.RecordBatch.from_arrays(
            [pa.array(m[s]), pa.array(h[lead]), pa.array(row[s], mask=many[lead]), pa.array((at[s] + off[lead]).astype(np.int32)),
             pa.array(np.zeros(len(s), dtype=np.int32))], schema=_FOUND)


def repeated_windows(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """(row, at, mask): bit i of mask says that the window at word at + i repeats. ``rows``: row, text.
    Minimisers estimated over ``hot`` occurrences (254 at most) are salted."""
    spark = rows.sparkSession
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    log2 = width_log2(chars)
    shared = spark.sparkContext.broadcast(sketch_bitmaps(rows, log2, hot))  # at most DEPTH * 2^MAX_WIDTH_LOG2 / 4 bytes
    # A window of about 6 characters takes 11 packed bytes at most; a task groups PART_BYTES of them.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * chars // PART_BYTES)
    packed = rows.select("row", "text").mapInArrow(
        _candidates(shared, log2, max(SALTS, parts // 4)), "m long, salt int, row long, at int, hashes binary")
    found = write_scratch(packed.repartition(parts, "m", "salt")
                          .mapInArrow(_resolve, "m long, h long, row long, at int, mask int"), "substring-found")
    settled = found.where("mask <> 0").select("row", "at", "mask")
    # One row for one (m, h) and salt at most: each salted group has sent one.
    late = (found.where("mask = 0").groupBy("m", "h").agg(F.collect_list(F.struct("row", "at")).alias("seen"))
            .where(F.size("seen") > 1).select(F.explode("seen").alias("w")).where("w.row is not null")
            .select("w.row", "w.at", F.lit(1).alias("mask")))
    return settled.unionByName(late)


def _covered(n: int, spans) -> np.ndarray:
    """Which of n words lie in a repeated window."""
    edge = np.zeros(n + 1, dtype=np.int32)
    for at, mask in spans:
        for i in range(SPAN):
            if mask >> i & 1:
                edge[at + i] += 1
                edge[at + i + WINDOW] -= 1
    return np.cumsum(edge[:n], dtype=np.int32) > 0


def kept_words(text: str | None, spans) -> tuple[int, Iterator[list[bytes]]]:
    """Number of words of a text, and the words outside the repeated windows, in lists."""
    one = list(word_pieces(text)) if len(text or "") <= PIECE_CHARS else None
    read = lambda: iter(one) if one is not None else word_pieces(text)
    n = sum(map(len, read()))
    if not spans:
        return n, read()
    stay = ~_covered(n, ((s["at"], s["mask"]) for s in spans))

    def pieces():
        at = 0
        for words in read():
            yield list(compress(words, stay[at:at + len(words)].tolist()))
            at += len(words)
    return n, pieces()


def _with_spans(docs: DataFrame, hot: int) -> DataFrame:
    """``docs`` plus __spans, the repeated windows of each row. Equal rows share their spans."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    spans = (repeated_windows(keyed.select(F.col("__row").alias("row"), "text"), hot)
             .groupBy("row").agg(F.collect_set(F.struct("at", "mask")).alias("__spans")))
    return (keyed.join(spans.withColumnRenamed("row", "__found"), F.col("__row") == F.col("__found"), "left")
            .drop("__row", "__found"))


def substring_dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            out = [[], [], [], []]
            for doc_id, text, spans in zip(*[c.to_pylist() for c in b.columns]):
                n, kept = kept_words(text, spans)
                digest, left = hashlib.sha256(), 0
                for words in filter(None, kept):
                    digest.update((b" " if left else b"") + b" ".join(words))
                    left += len(words)
                for o, v in zip(out, (doc_id, n, n - left, digest.hexdigest())):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return (_with_spans(docs.select(F.col("doc_id").cast("long"), "text"), hot)
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))


def dedup_texts(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (and n_chars, if present, recounted).

    A text without repeats stays as it is; otherwise the kept words are joined by one space.
    Every row stays, also one whose text becomes empty.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            texts = []
            for text, spans in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not spans:
                    texts.append(text)
                    continue
                kept = filter(None, kept_words(text, spans)[1])
                texts.append(b" ".join(b" ".join(words) for words in kept).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *b.columns[2:]], names=["text", *b.schema.names[2:]])

    rest = [c for c in docs.columns if c != "text"]
    marked = _with_spans(docs, hot).select("text", "__spans", *rest)
    out = marked.mapInArrow(run, marked.drop("__spans").schema)
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
