import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from agrolens.llm import bpe, decontam, langid, quality, simhash, substring
from agrolens.llm.catalog import PATTERN, RANKS
from tests.conftest import SF_SMALL
from tests.llm import brute

ODD = [None, "", "  \n\t ", "one", "Ünïcode wörds \U0001F600 here", "a b c d e f g h i j " * 40,
       "x" * 5000, "tab\tand\x0bvertical\x0cfeed\rreturn\nline", "# * $ % & | < >", "end space em"]


def small_docs(spark, n=200):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(n)


# 1 quality rules

def test_base_rules_equal_brute_force(spark, make_docs):
    texts = ODD + ["l1 a b\nl2\nl1 a b\n\n \nl2", "p q r s t u p q r s t u v w x y z", "a a a a a a a a a a a a"]
    rnd = random.Random(5)
    texts += [" ".join(rnd.choice("abcd") for _ in range(rnd.randrange(60))) for _ in range(60)]
    got = quality.base_rules(make_docs(list(enumerate(texts)))).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_rules(texts[r.doc_id])


def test_quality_equals_brute_force(spark):
    docs = small_docs(spark)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    want = brute.quality([(r.doc_id, r.text) for r in docs.collect()], trusted, quality.BUCKETS, quality.SMOOTHING, quality.MIN_SCORE)
    got = {r.doc_id: r for r in quality.quality_rules(docs, labels).collect()}
    assert got.keys() == want.keys()
    for i, (score, kept) in want.items():
        assert abs(got[i].score - score) < 1e-5
        assert got[i].kept == kept or abs(score - quality.MIN_SCORE) < 1e-5
    assert {r.doc_id for r in quality.drop_rejected(docs, labels).collect()} == {i for i, r in got.items() if r.kept}


def test_quality_edge_rows(spark, make_docs):
    rows = list(enumerate(ODD)) + [(None, "w " * 20), (3, "one"), (3, "one")]
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(make_docs(rows).withColumnRenamed("n_chars", "score"), labels).collect()
    assert len(got) == len(rows)
    assert all(abs(r.score) < 1e-12 for r in got)  # label rows disagree, so nothing is trusted
    assert quality.quality_rules(make_docs([]), labels).count() == 0


def test_quality_separates_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.quality_rules(docs, labels).join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.toxic == 0 and r.n_words >= 10]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


# 2 language ID

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(spark, make_docs):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t in enumerate(ODD)] + [(None, "hello there", "en"), (7, "1234 !!", None)]
    got = langid.language_id(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for r, (doc_id, text, _) in zip(got, rows):
        blank = not any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == blank and (r.score == 0 or not blank)
    none = langid.language_id(make_docs([(1, "words", None)])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert langid.language_id(make_docs([])).count() == 0


def test_language_sample_keeps_every_language_beside_a_hot_id(spark, make_docs):
    words = {"en": "the cat is here", "fr": "le chat est ici", "de": "die katze ist hier"}
    rows = [(0, f"hot {words['en']} {i}", "en") for i in range(3000)] + [(3, "all the same text", "fr")] * 3000
    rows += [(10 + i, f"{w} {k}", k) for i in range(60) for k, w in words.items()]
    langs, bits = langid.training_rows(make_docs(rows), per_lang=30)
    assert {k: langs.count(k) for k in words} == {"en": 30, "fr": 30, "de": 30} and len(bits) == 90
    assert langs == langid.training_rows(make_docs(rows[::-1]).repartition(7), per_lang=30)[0]
    few = langid.training_rows(make_docs(rows), per_lang=1000)[0]
    assert few.count("fr") <= 61 and few.count("en") == 1000  # equal rows count once


def test_language_model_equals_plain_kernel_ridge(monkeypatch):
    monkeypatch.setattr(langid, "LANDMARKS_PER_LANG", 10_000)  # every training row a landmark: the plain kernel machine
    rnd = random.Random(8)
    letters = {"aa": "abcde ", "bb": "cdefgh ", "cc": "fghijk "}
    text = lambda k: "".join(rnd.choice(letters[k]) for _ in range(60))
    train = sorted((k, text(k)) for k in letters for _ in range({"aa": 12, "bb": 20, "cc": 7}[k]))
    tests = [text(k) for k in letters for _ in range(10)]

    def grams(t):
        row = np.zeros(langid.DIM, dtype=np.uint8)
        langid.ngram_bits(t, row)
        return row, set(np.flatnonzero(row).tolist())
    kernel = lambda a, b: len(a & b) / (len(a) * len(b)) ** 0.5
    sets = [grams(t)[1] for _, t in train]
    k = np.array([[kernel(a, b) for b in sets] for a in sets])
    n, classes = len(train), sorted(letters)
    weight = np.array([n / (len(classes) * sum(x == lang for x, _ in train)) for lang, _ in train])
    system = np.zeros((n + 1, n + 1))  # weighted least squares with a ridge and a free bias
    system[:n, :n] = weight[:, None] * k + langid.RIDGE * n * np.eye(n)
    system[:n, n] = weight
    system[n, :n], system[n, n] = weight @ k, weight.sum()
    want = []
    for c in classes:
        y = np.array([1.0 if lang == c else -1.0 for lang, _ in train])
        solved = np.linalg.solve(system, np.append(weight * y, weight @ y))
        want.append([sum(a * kernel(grams(t)[1], s) for a, s in zip(solved, sets)) + solved[n] for t in tests])
    want = np.array(want)
    model = langid.fit([lang for lang, _ in train], np.array([grams(t)[0] for _, t in train]))
    langs, scores = langid._score(model, tests)
    assert langs == [classes[i] for i in want.argmax(axis=0)]
    assert np.allclose(scores, np.clip((want.max(axis=0) + 1) / 2, 0, 1), atol=1e-4)


def test_ngram_bits_do_not_depend_on_blocks(monkeypatch):
    text = "".join(random.Random(1).choice("aé b.ß ") for _ in range(5000))
    a, b = np.zeros(langid.DIM, np.uint8), np.zeros(langid.DIM, np.uint8)
    langid.ngram_bits(text, a)
    grams = set()
    flat = " " + "".join(c.lower() if c.isalpha() else " " for c in text) + " "
    flat = " ".join(["", *flat.split(), ""])
    for n in langid.ORDERS:
        grams |= {flat[i:i + n] for i in range(len(flat) - n + 1)}
    assert 0 < a.sum() <= len(grams) and a.sum() > 0.98 * len(grams)


# 3 SimHash

def test_fingerprints_and_components_equal_brute_force(spark, make_docs):
    base = [r.text for r in small_docs(spark, 120).collect()]
    rnd = random.Random(3)
    texts = ODD + base
    for t in base[:40]:
        w = t.split()
        for _ in range(3):
            v = list(w)
            v[rnd.randrange(len(v))] = "changed"
            texts.append(" ".join(v))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[20]), (11, texts[11]), (None, "only here with no id")]
    got = simhash.simhash_groups(make_docs(rows)).collect()
    prints = [(i, brute.fingerprint(t)) for i, t in rows]
    comps = brute.components(prints)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted([tuple(r) for r in got], key=key) == sorted(
        [(i, f"{fp:016x}", c) for (i, fp), c in zip(prints, comps)], key=key)


@pytest.mark.parametrize("bucket", [2, 16])
def test_dense_fingerprints_take_both_exact_ways(spark, bucket):
    rnd = random.Random(9)
    prints = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in rnd.sample(range(64), rnd.randrange(5)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    classes = spark.createDataFrame([(simhash._signed(x),) for x in prints], "fp long")
    found, _ = simhash.links(classes, max_bucket=bucket)
    edges = [(r.a % 2**64, r.b % 2**64) for r in found.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    want = brute.components([(i, x) for i, x in enumerate(prints)])
    parent = {x: x for x in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert [prints.index(find(x)) for x in prints] == want


def test_near_dedup_keeps_one_of_each_group(spark, make_docs):
    rows = [(5, "a b c d e f"), (2, "A b  c d E f"), (9, "other words in this text"), (9, "other words in this text"), (None, "a b c d e f")]
    got = simhash.drop_near_copies(make_docs(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 2), (False, 9)]
    assert simhash.drop_near_copies(make_docs([])).count() == 0


def test_near_dedup_tells_rows_apart_by_id_and_text(spark, make_docs):
    kept = lambda rows: sorted(((r.doc_id, r.text) for r in simhash.drop_near_copies(make_docs(rows)).collect()), key=str)
    one, two, three = "a b c d e f", "other words in this text", "something else again is here"
    # a: copies without a doc_id go but for one, next to a document with an id all of them
    assert kept([(None, one)] * 40 + [(None, "A b C d e f")] * 9 + [(None, two)]) in (
        [(None, "A b C d e f"), (None, two)], [(None, one), (None, two)])
    assert kept([(5, one)] + [(None, one)] * 30 + [(None, two)] * 3) == [(5, one), (None, two)]
    # b: unrelated texts under one doc_id both stay
    assert kept([(1, one), (1, two), (1, two), (4, three)]) == [(1, one), (1, two), (4, three)]
    # c: the row of a repeated doc_id that copies a kept document goes, the other one stays
    assert kept([(1, one), (7, one), (7, two)]) == [(1, one), (7, two)]


# 4 byte-level BPE

@pytest.fixture(scope="module")
def tokenizer():
    ranks = bpe.read_ranks(RANKS)
    return bpe.Bpe(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(tokenizer, spark):
    own, lib = tokenizer
    rnd = random.Random(11)
    texts = [t or "" for t in ODD] + [r.text for r in small_docs(spark, 60).collect()]
    alphabet = "aabe tTh  \n\t \x1cé'sll1 2.,!\U0001F600中文"
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(80))) for _ in range(1500)]
    texts += ["a" * 3000, " " * 2000, "ab" * 2000 + "!" * 999, "".join(rnd.choice("etaoin") for _ in range(20000))]
    for t in texts:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)
        assert own.decode(ids) == t.encode()
    assert not own.buckets and not any(own.low)
    assert list(map(own.decode, own.encode_many(texts))) == [t.encode() for t in texts]


def test_bpe_very_long_pretoken_is_fast(tokenizer):
    text = "".join(random.Random(2).choice("thequickbrown") for _ in range(300_000))
    assert own_tokens(tokenizer, text) == tokenizer[1].encode_ordinary(text)


def test_bpe_batch_equals_tiktoken(tokenizer, monkeypatch):
    own, lib = tokenizer
    rnd = random.Random(12)
    texts = ["".join(rnd.choice("aab tTh \n\x1cé'l1.!\U0001F600中") for _ in range(rnd.randrange(90))) for _ in range(3000)]
    texts += ["a" * n for n in range(40)] + ["ab" * n + "!" * n for n in range(40)] + ["", " ", "  ", "a ", "a  ", " a", "\n a", "a \n b"]
    want = [np.array(lib.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert own.encode_many(texts) == want and own.encode_many([]) == []
    monkeypatch.setattr(bpe, "TEXT_CHARS", 20)   # long texts in slices
    monkeypatch.setattr(bpe, "QUEUE_BYTES", 50)  # several queues a batch
    monkeypatch.setattr(bpe, "LONG", 12)         # pre-tokens with a queue of their own
    monkeypatch.setattr(bpe, "PIECES", 100)      # caches cleared between batches
    monkeypatch.setattr(bpe, "PARTS", 100)
    fresh = bpe.Bpe(own.ranks, PATTERN)
    assert fresh.encode_many(texts) == want


def test_bpe_merges_in_rank_order_for_any_vocabulary():
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate([b"ab", b"ba", b"aba", b"bb", b"abab", b"aab", b"aa"]):  # "aab" comes before its part "aa"
        ranks[t] = 256 + k
    own = bpe.Bpe(ranks, PATTERN)
    lib = tiktoken.Encoding("odd", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aab") for _ in range(rnd.randrange(60))) for _ in range(2000)]
    for t, ids in zip(texts, own.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(t)


def own_tokens(tokenizer, text):
    return np.frombuffer(tokenizer[0].encode(text), "<u4").tolist()


def test_bpe_query_columns(make_docs, tokenizer):
    rows = list(enumerate(ODD)) + [(None, "again"), (3, "one")]
    got = bpe.encode_texts(make_docs(rows), RANKS, PATTERN, keep_ids=True).collect()
    assert len(got) == len(rows)
    for r, (i, t) in zip(got, rows):
        ids = tokenizer[1].encode_ordinary(t or "")
        assert (r.doc_id, r.n_tokens, r.ids) == (i, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


# 7 benchmark decontamination

def test_contamination_equals_brute_force(spark, make_docs):
    rnd = random.Random(4)
    vocab = ["Alpha", "beta", "gamma", "délta", "42"]
    word = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, word(n)) for i, n in enumerate([1, 3, 5, 9, 10, 11, 25, 40])] + [(99, None), (98, "..."), (None, word(12)), (7, None)]
    items[0] = (0, "rareword")
    items.append((50, items[6][1]))  # one text under two ids
    texts = ODD + [word(rnd.randrange(80)) for _ in range(60)] + [word(5) + ", " + (t or "").upper() + "! " + word(6) for _, t in items]
    texts += ["a RAREWORD here"]
    bench = spark.createDataFrame(items + items[3:5], "item_id long, text string")
    got = decontam.contamination(make_docs(list(enumerate(texts)) + [(None, texts[-3])]), bench).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        n, hit, ids = brute.contaminated(texts[-3] if r.doc_id is None else texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_longest_matches_and_blocks(spark, make_docs, monkeypatch):
    item = " ".join(f"w{i}" for i in range(30))
    docs = make_docs([(1, "x " + " ".join(f"w{i}" for i in range(3, 20)) + " y " + item), (2, "clean text")])
    bench = spark.createDataFrame([(4, item), (5, " ".join(f"v{i}" for i in range(12)))], "item_id long, text string")
    one = {r.doc_id: sorted(map(tuple, r.matches)) for r in decontam.find_matches(docs, bench).collect()}
    assert one == {1: [("4", 1, 17), ("4", 19, 30)], 2: []}
    monkeypatch.setattr(decontam, "benchmark_blocks", lambda b: [[(4, item)], [], [(5, "clean text")]])
    many = {r.doc_id: sorted(map(tuple, r.matches)) for r in decontam.find_matches(docs, bench).collect()}
    assert many == {1: one[1], 2: [("5", 0, 2)]}
    monkeypatch.undo()
    kept = decontam.drop_contaminated(docs, spark.createDataFrame([(4, item)], "item_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == docs.columns
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contamination(docs, empty).where("contaminated").count() == 0
    assert decontam.contamination(make_docs([]), bench).count() == 0


# 8 substring dedup

def passages(seed=6):
    rnd = random.Random(seed)
    word = lambda n: [f"t{rnd.randrange(4000)}" for _ in range(n)]
    shared = [word(60), word(35), word(34), word(200)]
    texts = []
    for _ in range(40):
        w = word(rnd.randrange(120))
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(shared)
        texts.append("  ".join(w) + "\n")
    return texts + ["p q " * 60, "z " * 90, "z " * 36, "z " * 35, "e " * 34]


@pytest.mark.parametrize("hot", [substring.HOT, 2])
def test_substring_dedup_equals_brute_force(spark, make_docs, hot):
    texts = ODD + passages()
    rows = list(enumerate(texts)) + [(7, "dup row " * 3 + " ".join(map(str, range(50))))] * 2 + [(None, texts[30])]
    got = substring.substring_dedup(make_docs(rows).repartition(5), hot).collect()
    want = []
    for (i, t), gone in zip(rows, brute.removed([t for _, t in rows])):
        kept = " ".join(w for w, g in zip(brute.spaced(t), gone) if not g)
        want.append((i, len(gone), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_substring_dedup_of_texts_in_many_blocks(spark, make_docs):
    rnd = random.Random(10)
    shared = [f"s{i}" for i in range(90)]
    texts = []
    for at in (10, 5000, 60_000, 119_900):
        w = [f"{rnd.randrange(10**9)}" for _ in range(120_000)]
        w[at:at] = shared
        texts.append(" ".join(w))
    texts += ["L" * 9000 + " " + " ".join(shared[:40]) + " " + "M" * 5000, " ".join(["L" * 9000] * 36)]
    got = substring.substring_dedup(make_docs(list(enumerate(texts)))).collect()
    want = brute.removed(texts)
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(i, len(g), sum(g)) for i, g in enumerate(want)]
    for r in got:
        kept = " ".join(w for w, g in zip(texts[r.doc_id].split(), want[r.doc_id]) if not g)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_blocks_and_pieces_do_not_change_the_windows(monkeypatch):
    rnd = random.Random(3)
    text = "".join(rnd.choice("ab cé \n\tx ") for _ in range(6000))
    join = lambda parts, k: np.concatenate([p[k] for p in parts])
    whole = list(substring.minimisers(text, True))
    assert len(whole) == 1
    for piece, block in [(1, 10), (7, 300), (50, 2000), (1000, 1)]:
        monkeypatch.setattr(substring, "PIECE_CHARS", piece)
        monkeypatch.setattr(substring, "BLOCK_BYTES", block)
        assert [w for p in substring.word_pieces(text) for w in p] == text.encode().split()
        parts = list(substring.minimisers(text, True))
        assert len(parts) > 1 and all(p[0] == sum(len(q[1]) for q in parts[:i]) for i, p in enumerate(parts))
        assert all(np.array_equal(join(parts, k), whole[0][k]) for k in (1, 2, 3))
        n, kept = substring.kept_words(text, [{"at": 3, "mask": 5}])
        stay = [w for i, w in enumerate(text.encode().split()) if not 3 <= i < 3 + 2 + substring.WINDOW]
        assert n == len(text.split()) and [w for p in kept for w in p] == stay


def test_memory_of_a_very_long_text_is_bounded():
    text = " ".join(f"{i * 7919 % 1000003}-some-words" for i in range(1_700_000))
    assert len(text) > 30_000_000
    tracemalloc.start()
    n = sum(len(m[1]) for m in substring.minimisers(text, True))
    words, kept = substring.kept_words(text, [{"at": 3, "mask": 1}])
    left = sum(map(len, kept))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == words - substring.WINDOW + 1 and left == words - substring.WINDOW
    assert peak < 100 << 20


def test_hot_windows_are_salted_and_found(spark, make_docs):
    line = " ".join(f"c{i}" for i in range(50))
    texts = [f"a{i} b{i} {line} d{i}" for i in range(150)]
    got = substring.substring_dedup(make_docs(list(enumerate(texts))).repartition(7), 1).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(53, 50)}


def test_dedup_texts_keeps_rows_and_columns(spark, make_docs):
    line = " ".join(f"c{i}" for i in range(40))
    docs = make_docs([(1, f"one {line} two"), (2, f"{line}"), (3, "clean  text\n stays"), (4, None)])
    got = substring.dedup_texts(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == [
        (1, "one two", 7), (2, "", 0), (3, "clean  text\n stays", 18), (4, None, None)]
    assert substring.dedup_texts(make_docs([])).count() == 0


def test_vocabulary_is_not_copied():
    assert RANKS == public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_substring_stage_takes_columns_of_its_own_names(spark, make_docs):
    passage = " ".join(f"w{i}" for i in range(40))
    names = ["row", "at", "mask", "spans", "m", "h", "salt", "hashes", "seen"]
    docs = make_docs([(1, passage), (2, "before " + passage), (3, "alone")]).select("*", *[F.lit(n).alias(n) for n in names])
    got = {r.doc_id: r for r in substring.dedup_texts(docs).collect()}
    assert [got[i].text for i in (1, 2, 3)] == ["", "before", "alone"]
    assert all(r[n] == n for r in got.values() for n in names)
