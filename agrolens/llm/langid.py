"""Operator 2, language ID: blended-spectrum presence kernel, Nystroem landmarks, ridge regression.

A text becomes the set of its character n-grams (n = 1..3, lower-cased letters, every run of
other characters one space), hashed to DIM bits. The kernel of two texts is the number of
shared n-grams over the geometric mean of their set sizes. A bounded sample of labelled rows,
for each language the distinct rows with the smallest hashes of doc_id and text, is encoded on the
executors (DIM / 8 bytes a row, never a text, reach the driver). Some of them are landmarks Z; features are ``k(x, Z) K_ZZ^-1/2``, and one ridge
regression per language is solved in closed form. Scoring multiplies whole batches of bit rows
with one matrix.

Defined results: NULL text or a text without letters gives ``und`` with score 0; without any
training row every text is ``und``; a NULL doc_id is in no fold (never trained on, held_out
false); ties go to the alphabetically first language; repeated rows each get a row; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import small_batches

DIM = 1 << 15             # hashed n-gram bits
ORDERS = (1, 2, 3)
TRAIN_PER_LANG = 400      # bound on the labelled sample: distinct (doc_id, text) rows of each language
LANDMARKS_PER_LANG = 24
MAX_LANGS = 256           # more classes than this is an error, never a silent cut
RIDGE = 1e-3
BATCH = 64
UNKNOWN = "und"
# Odd multipliers of the multiplicative n-gram hash, per position.
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
_TABLES: dict = {}


def _tables():
    """Per code point: its lower-case letter, or a space for everything else."""
    if "lower" not in _TABLES:
        out = np.full(0x110000, 32, dtype=np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                out[cp] = ord(low) if len(low) == 1 else cp
        _TABLES["lower"] = out
    return _TABLES["lower"]


def ngram_bits(text: str | None, out: np.ndarray) -> bool:
    """Set the n-gram bits of a whole text in ``out`` (length DIM); False if it has no letter."""
    if not text:
        return False
    lower = _tables()
    step, seen = 1 << 20, False
    tail = np.array([32], dtype=np.uint32)
    for a in range(0, len(text), step):  # blocks, so that a very long text stays in bounded memory
        c = lower[np.frombuffer(text[a:a + step].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        seen = seen or bool((c != 32).any())
        c = np.concatenate([tail, c, [np.uint32(32)]] if a + step >= len(text) else [tail, c])
        letter = c != 32
        c = c[letter | np.concatenate([[True], letter[:-1]])]
        h = np.zeros(len(c), dtype=np.uint32)
        for n in ORDERS:
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] ^ (c[n - 1:] * _MULT[n - 1])) * np.uint32(0x27D4EB2F)
            out[(h ^ (h >> np.uint32(15))) >> np.uint32(32 - int(math.log2(DIM)))] = 1
        tail = c[-2:]
    return seen


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; fold 1 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def _encode(batches):
    for b in batches:
        bits, langs, hashes = [], [], []
        for text, lang, h in zip(*[c.to_pylist() for c in b.columns]):
            row = np.zeros(DIM, dtype=np.uint8)
            if ngram_bits(text, row):
                bits.append(np.packbits(row).tobytes())
                langs.append(lang)
                hashes.append(h)
        yield pa.RecordBatch.from_pydict({"lang": langs, "h": hashes, "bits": bits}, schema=pa.schema(
            [("lang", pa.string()), ("h", pa.int64()), ("bits", pa.binary())]))


def training_rows(docs: DataFrame, per_lang: int = TRAIN_PER_LANG):
    """The bounded labelled sample as (languages, bit matrix), in a deterministic order: for each
    language its ``per_lang`` distinct rows (doc_id, text) with the smallest hashes. Equal rows count once."""
    h = F.xxhash64(F.lit("langid"), "doc_id", "text")
    usable = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 1))
              .select("text", "lang", h.alias("h")))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
             .limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} distinct languages in the training labels")
    if not sizes:
        return [], np.zeros((0, DIM), dtype=np.uint8)
    # A first cut by hash leaves about twice the rows wanted of each language; the count is an estimate.
    share = F.pmod(F.col("h"), F.lit(1_000_000_007))
    below = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items())
                           for x in (k, int(min(1.0, 2 * per_lang / max(n, 1)) * 1_000_000_007))])
    picked = usable.where(share < F.element_at(below, F.col("lang"))).dropDuplicates(["lang", "h"]).select("text", "lang", "h")
    kept, taken = [], {}
    for r in sorted(picked.mapInArrow(_encode, "lang string, h bigint, bits binary").collect(),
                    key=lambda r: (r["h"] % 1_000_000_007, r["h"], r["lang"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= per_lang:
            kept.append((r["lang"], bytes(r["bits"])))
    kept.sort()
    bits = np.unpackbits(np.frombuffer(b"".join(b for _, b in kept), dtype=np.uint8).reshape(len(kept), -1), axis=1) \
        if kept else np.zeros((0, DIM), dtype=np.uint8)
    return [lang for lang, _ in kept], bits


def fit(langs: list, bits: np.ndarray) -> dict | None:
    """Closed-form model: columns used by landmarks, landmark matrix, class weights."""
    if not langs:
        return None
    classes = sorted(set(langs))
    y = np.array([classes.index(x) for x in langs])
    marks = np.concatenate([np.flatnonzero(y == k)[np.linspace(0, (y == k).sum() - 1, min(
        LANDMARKS_PER_LANG, int((y == k).sum()))).astype(int)] for k in range(len(classes))])
    marks = np.unique(marks)
    cols = np.flatnonzero(bits[marks].any(axis=0))
    z = bits[marks][:, cols].astype(np.float32).T
    zn = bits[marks].sum(axis=1).astype(np.float64)
    kzz = (z.T @ z).astype(np.float64) / np.sqrt(np.outer(zn, zn))
    val, vec = np.linalg.eigh(kzz)
    root = vec / np.sqrt(np.maximum(val, 1e-8)) * (val > 1e-8)
    xn = bits.sum(axis=1).astype(np.float64)
    k = np.concatenate([bits[i:i + 256][:, cols].astype(np.float32) @ z for i in range(0, len(bits), 256)]).astype(np.float64)
    phi = np.c_[k / np.sqrt(np.outer(xn, zn)) @ root, np.ones(len(xn))]
    target = np.where(y[:, None] == np.arange(len(classes)), 1.0, -1.0)
    share = np.array([(y == c).mean() for c in range(len(classes))])
    weight = 1.0 / (len(classes) * share[y])  # classes count alike, whatever their share
    gram = phi.T @ (phi * weight[:, None]) + RIDGE * len(phi) * np.diag(np.r_[np.ones(phi.shape[1] - 1), 0.0])
    beta = np.linalg.solve(gram + 1e-9 * np.eye(len(gram)), phi.T @ (target * weight[:, None]))
    return {"classes": classes, "cols": cols, "z": z, "zn": zn, "coef": root @ beta[:-1], "bias": beta[-1]}


def _score(model, texts):
    """Predicted language and score of each text, by batched matrix products."""
    langs, scores = [], []
    for a in range(0, len(texts), BATCH):
        part = texts[a:a + BATCH]
        bits = np.zeros((len(part), DIM), dtype=np.uint8)
        known = [ngram_bits(t, bits[i]) for i, t in enumerate(part)]
        if model is None:
            langs += [UNKNOWN] * len(part)
            scores += [0.0] * len(part)
            continue
        n = np.maximum(bits.sum(axis=1, dtype=np.int64), 1).astype(np.float64)
        k = (bits[:, model["cols"]].astype(np.float32) @ model["z"]).astype(np.float64)
        s = k / np.sqrt(np.outer(n, model["zn"])) @ model["coef"] + model["bias"]
        best = np.round(s, 9).argmax(axis=1)
        p = np.clip((s[np.arange(len(part)), best] + 1) / 2, 0, 1)
        langs += [model["classes"][b] if ok else UNKNOWN for b, ok in zip(best, known)]
        scores += [float(x) if ok else 0.0 for x, ok in zip(p, known)]
    return langs, scores


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    # A model holds at most MAX_LANGS * LANDMARKS_PER_LANG landmarks of DIM floats.
    model = spark.sparkContext.broadcast(fit(*training_rows(docs)))

    def run(batches):
        m = model.value
        for b in batches:
            langs, scores = _score(m, b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
                       F.col("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
