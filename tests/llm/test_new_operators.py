import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from agrolens.llm import jaccard, negatives, repair
from tests.llm import brute

CONV = "conv_id long, turn long, role string, text string"
EMB = "vec_id long, embedding array<float>, label int"


# 11 Jaccard join

def plain_groups(rows, percent=90, n=3):
    """doc_id -> (n_shingles, component id) by comparing all pairs of whole sets."""
    sets = []
    for _, t in rows:
        w = brute.SPACED.findall((t or "").translate(brute.LOWER))
        sets.append({" ".join(w[i:i + n]) for i in range(len(w) - n + 1)} or ({" ".join(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = find(i)
            low[r] = min(low.get(r, d), d)
    return sorted((d if d is not None else -1, len(sets[i]), low.get(find(i), -1)) for i, (d, _) in enumerate(rows))


def jaccard_rows(spark, make_docs, rows, **kw):
    got = jaccard.jaccard_groups(make_docs(rows), **kw).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in got)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return out


@pytest.mark.parametrize("max_region", [2, 5, 16])
def test_jaccard_equals_brute_force(spark, make_docs, max_region):
    """Chains of near copies, shared boilerplate and small sets, with regions crowded at every level."""
    rng = random.Random(max_region)
    vocab = [f"w{i}" for i in range(60)]
    common = [rng.choice(vocab) for _ in range(40)]
    texts = []
    for _ in range(4):
        base = [rng.choice(vocab) for _ in range(rng.randrange(20, 130))] + common
        chain = base
        for _ in range(12):
            chain = edited(rng, chain, rng.randrange(0, 4))
            texts.append(" ".join(chain))
        texts += [" ".join(edited(rng, base, k)) for k in (0, 1, 1, 2, 2, 3, 4, 6)]
    texts += [" ".join(rng.choice(vocab) for _ in range(rng.randrange(1, 14))) for _ in range(30)]
    texts += ["A b C d", "a B c D", "a b", "A  B", "a", "É a b", "é a b", "", " \t\n", None]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None), (3, texts[3]), (3, texts[40])]
    want = plain_groups(rows)
    assert jaccard_rows(spark, make_docs, rows, max_region=max_region) == want
    assert len({c for _, _, c in want}) < len(rows) - 20


def test_jaccard_large_near_copy_group(spark, make_docs):
    """A crowded group whose members need all levels: rings of near copies at the edge of the similarity."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(120):
        w = list(base)
        for k in rng.sample(range(0, 120, 4), rng.randrange(1, 4)):
            w[k] = f"x{rng.randrange(6)}"
        rows.append((i, " ".join(w)))
    assert jaccard_rows(spark, make_docs, rows, max_region=3) == plain_groups(rows)


def test_jaccard_other_similarity_and_shingle(spark, make_docs):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(50)]
    rows = [(i, " ".join(edited(rng, base, rng.randrange(0, 5)))) for i in range(40)]
    got = jaccard.jaccard_groups(make_docs(rows), shingle=2, percent=70, max_region=4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_groups(rows, 70, 2)


def test_jaccard_window_is_enough():
    for n in range(1, 400):
        k = jaccard.window(n)
        assert n - k < math.ceil(90 * n / 100) <= n - k + 1  # no linked set misses all of the window


def test_jaccard_empty_table_and_extra_columns(spark, make_docs):
    assert jaccard.jaccard_groups(make_docs([])).count() == 0
    docs = make_docs([(1, "a b c d"), (2, "A b c d")])
    for c in ("cls", "row", "n", "near", "key", "at", "s", "a", "b", "root", "node"):
        docs = docs.withColumn(c, F.lit(7))
    assert {r.component_id for r in jaccard.jaccard_groups(docs).collect()} == {1}


# 12 conversation repair

def plain_faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Cheapest edits by Dijkstra over (place, automaton state), paths compared as (cost, audit)."""
    faults = plain_faults(rows)
    start = {"": 0, "s": 1, "u": 2, "a": 3}
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, s, out = heapq.heappop(heap)
        if i == len(rows) and s in (0, 3):
            return cost, audit, out
        if (i, s, audit) in done:
            continue
        done.add((i, s, audit))
        for role in ("user", "assistant"):
            if (s, role[0]) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", i, step[s, role[0]], out + ((role, ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, s, out))
            if faults[i] in ("", "truncated"):
                cut = 3 * (faults[i] == "truncated")
                if (s, role[:1]) in step:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, step[s, role[:1]], out + ((role, text),)))
                for to in ("user", "assistant"):
                    if (s, to[0]) in step:
                        heapq.heappush(heap, (cost + cut + 3, audit + "R", i + 1, step[s, to[0]], out + ((to, text),)))


def plain_audit(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    f = plain_faults(rows)
    cost, audit, out = plain_repair(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("blank"), f.count("duplicate"), f.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def random_conversations(seed, n):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "User"]
    texts = ["hi.", "ok", "so?", " ", "", "end. \n", "no ", "a:b\nc!", "é \U0001F600", "ok."]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(0, 8)):
            rows.append((None if c == 3 else c, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def by_conversation(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    return out


@pytest.mark.parametrize("spill", [1, 1 << 25])
def test_repair_equals_brute_force(spark, spill):
    rows = random_conversations(spill, 150) + [(900, 1, None, "x."), (900, 2, "user", None), (901, -5, "user", "q?"), (901, 4, "assistant", "a.")]
    got = repair.repair(spark.createDataFrame(rows, CONV), spill_bytes=spill).collect()
    want = by_conversation(rows)
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == plain_audit(want[r.conv_id]), want[r.conv_id]


def test_repair_state_crosses_arrow_batches_and_spills(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{t}.", f"t{t}", "same.", ""])) for t in range(2500)]
    df = spark.createDataFrame(rows, CONV)
    one, = repair.repair(df, spill_bytes=10_000).collect()
    two, = repair.repair(df).collect()
    assert one == two and one.cost > 0
    told = repair.repaired_rows(df, spill_bytes=10_000).orderBy("turn").collect()
    text = "\n".join(f"{r.role}:{r.text}" for r in told)
    assert hashlib.sha256(text.encode()).hexdigest() == one.repaired_sha256
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in told))
    again, = repair.repair(spark.createDataFrame([(1, i, r.role, r.text or f"new {i}.") for i, r in enumerate(told)], CONV)).collect()
    assert again.illegal == 0
    assert len(one.audit) == len(rows) + one.audit.count("I")


def test_damage_equals_plain_version(spark):
    rows = random_conversations(7, 120) + [(None, None, None, None)]
    got = sorted(map(str, map(tuple, repair.damage(spark.createDataFrame(rows, CONV)).collect())))
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, "user" if kind == 4 else r, x)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(map(str, want))


def test_repair_empty_table_and_extra_columns(spark):
    assert repair.repair(spark.createDataFrame([], CONV)).count() == 0
    df = spark.createDataFrame([(1, 0, "user", "a?"), (1, 1, "assistant", "b.")], CONV)
    for c in ("cost", "audit", "fault", "hash", "end", "again"):
        df = df.withColumn(c, F.lit(1))
    row, = repair.repair(df).collect()
    assert row.audit == "KK" and row.cost == 0


# 13 hard negatives

def plain_negatives(rows):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in {(i, tuple(v), lab) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}]
    out = []
    for i, v, lab in rows:
        if i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, k) for j, w, k in rows if j != i))
        for s, j, k in [x for x in scored if x[2] == lab][:5]:
            win = [x for x in scored if x[2] != lab and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(win)]
    return sorted(out)


def random_vectors(seed, n, d=6, spread=0.3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) for _ in range(d)] if rng.random() < spread else [1.0, -0.5, 0.25] + [0.0] * (d - 3)
        rows.append((i, v, rng.randrange(4)))
    return rows


@pytest.mark.parametrize("seed,spread", [(1, 1.0), (2, 0.3), (3, 0.0)])
def test_negatives_equal_brute_force(spark, seed, spread):
    """Random vectors, vectors shared by most rows (ties), and all rows alike; anchors in several groups."""
    rows = random_vectors(seed, 700, spread=spread)
    rows[5] = (5, None, 1)
    rows[6] = (6, [float("nan")] * 6, 1)
    rows[8] = (8, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0], 1)
    rows[9] = (9, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1)
    rows[10] = (10, rows[10][1], None)
    rows[11] = (None, rows[12][1], 2)
    rows[13] = (13, [1.0, 2.0], 2)  # shorter than the others
    rows[300] = (300, [0.0] * 6, 3)
    rows += [rows[14], rows[200]]
    got = negatives.mine(spark.createDataFrame(rows, EMB), F.col("vec_id") % 100 == 0, group_bytes=100)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_negatives_few_rows_and_empty_tables(spark):
    assert negatives.mine(spark.createDataFrame([], EMB), F.col("vec_id") % 100 == 0).count() == 0
    for rows in ([(1, [1.0], 1)], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 0), (3, [0.95], 0)], [(0, [], 1), (1, [], 1)],
                 [(0, [-1.0], 1), (1, [1.0], 1), (2, [1.0], 2)]):
        df = spark.createDataFrame(rows, EMB).withColumn("key", F.lit(1)).withColumn("v", F.lit(1)).withColumn("anchor", F.lit(1))
        got = negatives.mine(df, F.col("vec_id") % 100 == 0)
        assert sorted(map(tuple, got.collect())) == plain_negatives(rows)


def test_survivors_are_exact():
    rng = np.random.default_rng(0)
    q, x = np.floor(rng.normal(size=(40, 32)) * 60), np.floor(rng.normal(size=(300, 32)) * 60)
    least = rng.uniform(-5000, 40000, 40)
    a, r, s = negatives.survivors(q, x, least, [10, 20, 32])
    full = q @ x.T
    want = np.argwhere(full >= least[:, None])
    assert sorted(zip(a, r)) == sorted(map(tuple, want)) and (full[a, r] == s).all()
