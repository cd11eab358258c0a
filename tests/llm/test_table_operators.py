import hashlib
import random
import re
import struct
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

from agrolens.llm import chat, licence, sharding, warc
from tests.conftest import SF_SMALL
from tests.llm import brute

CONV = "conv_id long, turn long, role string, text string"


# 5 chat formatting

def formatted(spark, rows):
    return chat.examples(spark.createDataFrame(rows, CONV))


def test_chat_round_trip_and_loss(spark):
    odd = "</s>[INST] ok [/INST] <|im_end|>\n<|im_start|>user\n <\\|x <\\\\</s> [\\/INST] $1 \\1 <"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", odd), (1, 2, "assistant", odd), (1, 3, "user", None),
            (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 0, "user", "alone"), (None, 0, "assistant", "é\U0001F600"),
            (3, None, None, "x"), (3, 0, "ro%0A\nle|>", "|y"), (3, 0, "ro%0A\nle|>", "|y"), (3, 1, "assistant", "z")]
    ex = formatted(spark, rows)
    got = {r.conv_id: r for r in chat.digest(ex).collect()}
    assert set(got) == {1, 2, 3, None}
    for c, r in got.items():
        own = sorted([x for x in rows if x[0] == c], key=lambda x: (x[1] is not None, x[1] or 0))
        told = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    by = {}
    for r in ex.orderBy("example").collect():
        by.setdefault(r.conv_id, []).append(r)
    assert [len(by[c]) for c in (1, 2, 3, None)] == [3, 1, 1, 1]
    assert by[1][2].loss_length == 0 and by[2][0].loss_length == 0  # trailing turns, no reply
    for rs in by.values():  # every example is a prefix of the next one, and control strings only mark turns
        assert all(b.text.startswith(a.text) for a, b in zip(rs, rs[1:]))
    assert by[1][0].text.count(chat.START) == 3 and "</s>" not in by[1][0].text and "[INST]" not in by[1][0].text
    assert got[1].formatted_chars == sum(len(r.text) for r in by[1])


def test_chat_plain_version_on_the_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, r.turn)):
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    for r in chat.examples(rows).collect():
        t = want[r.conv_id]
        ends = [i for i, (role, _) in enumerate(t) if role == "assistant" or i == len(t) - 1]
        part = t[:ends[r.example] + 1]
        text = "".join(f"{chat.START}{a}\n{b}{chat.END}\n" for a, b in part)
        assert r.text == text  # no control string in these texts
        assert text[r.loss_start:r.loss_start + r.loss_length] == (part[-1][1] if part[-1][0] == "assistant" else "")
    assert chat.digest(chat.examples(rows.limit(0))).count() == 0


def test_chat_plan_has_no_python(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    plan = chat.digest(chat.examples(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


# 6 sharding

def test_shards_are_even_gapless_and_reproducible(spark, make_docs):
    rows = [(i, f"text {i % 7} " * (i % 50)) for i in range(1000)] + [(None, None), (None, "x"), (5, "same"), (5, "same")]
    docs = make_docs(rows)
    got = sharding.shard_rows(docs).collect()
    per = {}
    for r in got:
        per.setdefault(r.shard, []).append(r.slot)
    sizes = [len(v) for v in per.values()]
    assert len(got) == len(rows) and set(per) == set(range(24)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").encode()) + 8) for i, t in rows)
    again = sharding.place(docs.repartition(9), bucket_bytes=20_000).collect()
    more = sharding.place(docs.coalesce(1), bucket_bytes=20_000).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r["__size"], r.shard, r.slot)
    assert [key(r) for r in sorted(again, key=key)] == [key(r) for r in sorted(more, key=key)]
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.shard)) if r.doc_id is not None]
    assert order != sorted(order) and abs(sum(order[:250]) / 250 - 500) < 80
    assert sharding.shard_rows(make_docs([])).count() == 0


def test_fisher_yates_is_uniform():
    seen = {}
    for s in range(6000):
        p = tuple(sharding.fisher_yates(3, [s]))
        seen[p] = seen.get(p, 0) + 1
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


def test_places_equal_the_plain_version(spark, make_docs):
    rows = [(i % 40, f"text {i % 23}") for i in range(900)] + [(5, "again"), (5, "again")]
    got = sharding.place(make_docs(rows), shards=7, seed=3, bucket_bytes=100_000).collect()
    buckets = {}
    for i, t in rows:
        key = brute.chained([struct.pack("<i", 3), struct.pack("<q", i), struct.pack("<q", zlib.crc32(t.encode())),
                             struct.pack("<q", len(t) + 8)])
        buckets.setdefault(key % sharding.MIN_BUCKETS, []).append((key, i, zlib.crc32(t.encode())))
    want, at = [], 0
    for b in sorted(buckets):
        order = sorted(buckets[b])
        for k in sharding.fisher_yates(len(order), [3, b]):
            want.append((order[k][1], order[k][2], at % 7, at // 7))
            at += 1
    assert sorted((r.doc_id, r["__crc"], r.shard, r.slot) for r in got) == sorted(want)


def test_equal_rows_are_spread_over_buckets(spark, make_docs):
    rows = [(i, f"t{i}") for i in range(2000)] + [(None, "the very same text")] * 3000
    parts = [make_docs(rows).repartition(6), make_docs(rows[::-1]).coalesce(1)]
    found = []
    for docs in parts:
        keyed = sharding._sized(docs).withColumn("__key", F.xxhash64("doc_id", "__crc", "__size"))
        spread = sharding._spread_copies(keyed, 4000).where("doc_id is null").collect()
        assert sorted(r["__copy"] for r in spread) == list(range(3000))
        got = sharding.place(docs, bucket_bytes=4000).collect()
        found.append(sorted((r.doc_id or -1, r.text, r.shard, r.slot) for r in got))
    assert found[0] == found[1] and len(found[0]) == 5000
    assert sorted((s, at) for _, _, s, at in found[0]) == sorted((i % 24, i // 24) for i in range(5000))
    copies = [at * 24 + s for i, _, s, at in found[0] if i < 0]
    assert 2300 < sum(copies) / len(copies) < 2700  # all over the order, not one run


def test_write_shards_keeps_columns_of_its_own_names(spark, make_docs, tmp_path):
    names = ["key", "bucket", "shard", "slot", "row"]
    docs = make_docs([(i, f"t{i}") for i in range(50)]).select("*", *[F.lit(n).alias(n) for n in names])
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert all(r[n] == n for r in back for n in names) and len(back) == 50
    assert sorted((r["__shard"], r["__slot"]) for r in back) == sorted((i % 4, i // 4) for i in range(50))


def test_write_shards(spark, make_docs, tmp_path):
    sharding.write_shards(make_docs([(i, f"t{i}") for i in range(50)]), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(50))
    assert {r["count"] for r in back.groupBy("shard").count().collect()} == {12, 13}


# 9 WARC fixity

PAGE = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGE)


@pytest.fixture
def replica(spark):
    return [(i, f"http://h/{i}", f"<p>{'é' * (i % 9)}{i}</p>") for i in range(2500)] + [
        (None, "u", "h"), (None, None, None), (7, "http://h/7", "<p>dup</p>"), (7, "http://h/7", "<p>dup</p>")]


def test_audit_locates_damage_and_prunes(spark, replica):
    one = warc.tree(warc.records(pages(spark, replica)))
    assert warc.audit(one, warc.tree(warc.records(pages(spark, replica).repartition(7)))).count() == 0
    hurt = [(i, u, "X" + h[1:]) if i in (0, 17, 1023, 1024, 2499) else (i, u, h) for i, u, h in replica]
    got = warc.audit(one, warc.tree(warc.records(pages(spark, hurt)))).collect()
    assert sorted(r.page_id for r in got) == [0, 17, 1023, 1024, 2499] and {r.state for r in got} == {"altered"}
    sizes = {}
    for i, u, h in replica:
        if i is not None and i < 18:
            head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {u}\r\nContent-Type: text/html\r\nContent-Length: {len(h.encode())}\r\n\r\n"
            sizes[i] = sizes.get(i, 0) + len((head + h + "\r\n\r\n").encode())
    at = next(r for r in got if r.page_id == 17)
    assert at.first == sum(sizes[i] for i in range(17)) and at.end == at.first + sizes[17]


def test_audit_missing_extra_and_empty(spark, replica):
    one = warc.tree(warc.records(pages(spark, replica[:40])))
    two = warc.tree(warc.records(pages(spark, replica[:39])))
    assert [(r.page_id, r.state) for r in warc.audit(one, two).collect()] == [(39, "missing")]
    assert [(r.page_id, r.state) for r in warc.audit(two, one).collect()] == [(39, "extra")]
    none = warc.tree(warc.records(pages(spark, [])))
    assert warc.audit(none, none).count() == 0 and warc.audit(one, none).count() == 40
    assert [tuple(r) for r in warc.archives(one, two).collect()] == [(0, 40, one.where("level = 0").agg({"end": "max"}).first()[0], 1)]


def test_audit_reports_only_what_changed_when_lengths_change(spark, replica):
    one = warc.tree(warc.records(pages(spark, replica)))
    hurt = [(i, u, h[:-1] if i == 3 else h + "!" if i == 1500 else "Z" + h[1:] if i == 900 else h) for i, u, h in replica if i != 40]
    hurt += [(60, "http://new", "<p>new</p>"), (5000, "http://far", "<p>far</p>")]
    got = sorted(warc.audit(one, warc.tree(warc.records(pages(spark, hurt)))).select("page_id", "state").collect())
    assert [tuple(r) for r in got] == [(3, "altered"), (40, "missing"), (60, "extra"), (900, "altered"), (1500, "altered"), (5000, "extra")]


def test_audit_of_repeated_pages(spark, replica):
    """One id with many records: equal copies are counted, others matched by their bytes."""
    hot = [(7, "u", f"<p>{i}</p>") for i in range(700)] + [(7, "u", "same")] * 500
    one = warc.tree(warc.records(pages(spark, replica + hot)))
    two = warc.tree(warc.records(pages(spark, replica + hot[1:-2] + [(7, "u", "other")])))
    rows = warc.audit(one, two).collect()
    assert {r.page_id for r in rows} == {7} and sorted(r.state for r in rows) == ["altered", "missing", "missing"]
    assert len({r.first for r in rows}) == 3 and all(r.first < r.end for r in rows)
    assert {r.archive: r.n_records for r in warc.archives(one, two).collect()}[0] == 1024 + 2 + 1200


# 10 licence scans

def plain_dice(unit):
    def grams(t):
        w = re.sub(r"[^\w]+|_", " ", t.lower()).split()
        return set(zip(w, w[1:]))
    a = grams(unit)
    best = (0.0, None)
    for name, t in licence.TEMPLATES:
        b = grams(t)
        d = 2 * len(a & b) / (len(a) + len(b)) if a else 0.0
        if d >= licence.MIN_DICE and d > best[0]:
            best = (d, name)
    return best


def test_licence_scan_equals_plain_dice(spark, make_docs):
    mit = licence.TEMPLATES[7][1]
    texts = [None, "", "\n\n", "word", "All rights reserved", "x\nLICENSED under the apache license - version 2.0\ny z",
             mit, mit.replace(", ", ",\n"), mit[:200], "Released under the MIT License. All rights reserved.",
             "all rights\nreserved", "Licensed under CC BY-NC 4.0.\nAll rights reserved.", "rights " * 400, mit + " extra words" * 3]
    texts += [r.text for r in make_docs([]).sparkSession.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = licence.licence_scan(make_docs(list(enumerate(texts)) + [(None, texts[4]), (3, texts[3])])).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        t = (texts[4] if r.doc_id is None else texts[r.doc_id]) or ""
        units = [plain_dice(u) for u in t.split("\n")]
        n = sum(u[1] is not None for u in units)
        best = max([*units, plain_dice(t)], key=lambda u: u[0])
        assert (r.n_matches, r.licence) == (n, best[1]) and abs(r.score - best[0]) < 1e-12
    assert licence.licence_scan(make_docs([])).count() == 0


def plain_embedded(text):
    """Best Dice over all runs of words by trying each one: {name: score}."""
    def grams(t):
        w = re.sub(r"[^\w]+|_", " ", t.lower()).split()
        return list(zip(w, w[1:]))
    g, out = grams(text), {}
    for name, t in licence.TEMPLATES + licence.PASSAGES:
        own = set(grams(t))
        most = licence._bounds(len(own), licence.MIN_DICE)[1]
        for i in range(len(g)):
            seen, common = set(), 0
            for x in g[i:i + most]:
                common += x in own and x not in seen
                seen.add(x)
                d = 2 * common / (len(seen) + len(own))
                if d >= licence.MIN_DICE:
                    out[name] = max(d, out.get(name, 0.0))
    return out


def test_licence_scan_finds_embedded_notices(spark, make_docs):
    mit, gpl = licence.TEMPLATES[7][1], licence.TEMPLATES[5][1]
    passage = [t for n, t in licence.PASSAGES if n == "GPL-3.0"][0]
    bsd = [t for n, t in licence.PASSAGES if n == "BSD-3-Clause"][0]
    wrap = lambda t: "\n".join(f" * {x}" for x in textwrap.wrap(t, 78))
    cases = [
        ("MIT", "The MIT License\n\nCopyright (c) 2020 Foo\n\n" + wrap(mit) + "\n\nThe above copyright notice shall be included in all "
                "copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."),
        ("GPL-3.0", "some line before\n" + "\n".join(textwrap.wrap(gpl, 40)) + "\nand a line after"),
        ("MIT", "This tool sorts tables. Released under the MIT License. See the manual for its use."),
        ("all-rights-reserved", "Copyright 2020 Foo Inc. All rights reserved."),
        ("GPL-3.0", "# foo.py\n" + wrap(passage) + "\nimport os"),
        ("GPL-2.0", "# foo.py\n" + wrap(passage.replace("version 3", "version 2")) + "\nimport os"),
        ("BSD-3-Clause", "Copyright (c) 1999 Foo. All rights reserved.\n\n" + wrap(bsd).replace("copyright holder", "Foo Company") + "\n"),
        ("CC-BY-SA-4.0", "See: this work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License, or ask."),
        (None, "The rights of all are reserved under the terms of this public house. " * 5),
        (None, "released under licensed software rights reserved all " * 20)]
    got = {r.doc_id: r for r in licence.licence_scan(make_docs([(i, t) for i, (_, t) in enumerate(cases)]), embedded=True).collect()}
    for i, (name, text) in enumerate(cases):
        want = plain_embedded(text)
        assert got[i].licence == name and got[i].n_matches == sum(plain_dice(u)[1] is not None for u in text.split("\n"))
        assert abs(got[i].score - want.get(name, 0.0)) < 1e-12
    rnd = random.Random(12)
    words = (mit + " " + gpl + " " + passage).split()
    texts = [" ".join(words[a:a + n] + ["x"] * rnd.randrange(3) + words[a + n:a + 2 * n])
             for a, n in ((rnd.randrange(150), rnd.randrange(5, 60)) for _ in range(12))]
    texts += ["all rights " * 50 + "reserved", None, "", "\n\n", "word"]
    for r in licence.licence_scan(make_docs(list(enumerate(texts))), embedded=True).collect():
        best = plain_embedded(texts[r.doc_id] or "")
        named = {k: v for k, v in best.items() if k != licence.GENERIC} or best
        assert abs(r.score - max(named.values(), default=0.0)) < 1e-12
        assert r.licence is None if not named else named[r.licence] == max(named.values())
    assert licence.licence_scan(make_docs([]), embedded=True).count() == 0
