"""The operators against brute force on small tables, and at their edges."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from topicflow.llm import ann, bpe, licenses, lm, mixing, sharding, simhash, topk, toxicity, warc
from topicflow.session import work_dir

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
DOCS = "doc_id long, text string"
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def documents(spark, rows, extra=True):
    """Documents with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    return df.withColumns({"score": F.lit("x"), "_fp": F.lit(1), "slot": F.lit(2)}) if extra else df


# --- vectors ----------------------------------------------------------------------


def vectors(spark):
    dice = np.random.default_rng(3)
    base = dice.standard_normal((150, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(200 + i, base[7].tolist()) for i in range(40)]  # a hot vector
    rows += [(3, base[3].tolist()), (500, None), (501, []), (502, [0.0] * 8), (503, [math.nan] + [1.0] * 7)]
    rows += [(504, [math.inf] * 8), (505, [None] + [1.0] * 7), (None, base[9].tolist()), (506, [1.0, 2.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))


def expected(rows, queries, k, zero, value):
    usable = {}
    for i, v in rows:
        ok = i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))
        if ok:
            usable[i] = value(v)
    found = set()
    for q in (i for i in usable if i % queries == 0):
        others = [(-float(np.dot(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
        found |= {(q, r, i) for r, (_, i) in enumerate(sorted(others)[:k], 1)}
    return found


def test_neighbours(spark):
    df = vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = ann.nearest_neighbours(df, F.col("vec_id") % 20 == 0)
    got = {(r.query_id, r["rank"], r.vec_id) for r in found.collect()}
    want = expected(rows, 20, 20, False, lambda v: np.array(v, float))
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
    assert found.columns[:4] == ["query_id", "rank", "vec_id", "score"]
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_collisions_verify_fewer_than_all_and_miss_few(spark):
    dice = np.random.default_rng(5)
    centres = dice.standard_normal((20, 32)) * 4
    data = centres[dice.integers(0, 20, 2000)] + dice.standard_normal((2000, 32))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    hit = 0
    for i, ids, scores in ann.collision_search(data, data[:40], 20):
        truth = np.argsort(-(data @ data[i]))[:20]
        hit += len(set(truth) & set(ids.tolist()))
        assert np.allclose(scores, data[ids] @ data[i])
    assert hit >= 0.9 * 40 * 20


def test_threshold_search(spark):
    df = vectors(spark)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    found = topk.top_products(df, F.col("vec_id") % 50 == 0).collect()
    want = expected(rows, 50, 5, True, lambda v: np.floor(256 * np.array(v, float)))
    assert {(r.query_id, r["rank"], r.vec_id) for r in found} == want
    big = np.array([[2**30, 1], [2**30, 2], [3, 4]], np.int64)
    (_, ids, scores), *_ = topk.threshold_search(big, big[:1], 1)
    assert dict(zip(ids.tolist(), scores.tolist()))[1] == 2**60 + 2


# --- licences ---------------------------------------------------------------------


def test_licences(spark):
    mit, gpl = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["GPL-3.0"][0]
    rows = [
        (1, "a/LICENSE", mit),
        (2, "a/b/c/x.txt", "plain words"),
        (3, "a/b/LICENSE.md", "no notice here"),
        (4, "a/d/COPYING", "some words\n\n" + gpl.upper()),
        (5, "a/d/y.txt", "z " * 50 + "\n" + mit + "\nmore words"),
        (6, "a/d/e/z.txt", None),
        (7, "q.txt", ""),
        (8, None, gpl),
        (8, None, gpl),
        (9, "ab/x.txt", "the mit license of a village"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("license", F.lit("?"))
    found = collections.Counter((r.doc_id, r.license, r.basis, r.distance) for r in licenses.scan_licenses(df).collect())
    assert found == collections.Counter(
        [
            (1, "MIT", "own", None),
            (2, "MIT", "inherited", 2),
            (3, "MIT", "inherited", 1),
            (4, "GPL-3.0", "own", None),
            (5, "MIT", "own", None),
            (6, "GPL-3.0", "inherited", 1),
            (7, None, None, None),
            (8, "GPL-3.0", "own", None),
            (8, "GPL-3.0", "own", None),
            (9, None, None, None),
        ]
    )
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_reserved_rights_stop_inheritance_and_licences_go_before_them(spark):
    bsd = licenses.TEMPLATES["BSD-3-Clause"][1]
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/x.txt", "some words\nAll rights reserved.\nmore words"),
        (3, "a/y.txt", f"Copyright 2020 Some One\nAll rights reserved.\n\n{bsd}"),
        (4, "a/NOTICE", "All rights reserved."),
        (5, "a/z.txt", "plain words"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = {r.doc_id: (r.license, r.basis) for r in licenses.scan_licenses(df).collect()}
    reserved = (licenses.RESERVED, "own")
    assert found == {1: ("MIT", "own"), 2: reserved, 3: ("BSD-3-Clause", "own"), 4: reserved, 5: ("MIT", "inherited")}


def test_every_notice_line_of_the_documents_is_met():
    texts = [t or "" for t in pq.read_table(f"{SF_DIR}/documents.parquet", columns=["text"]).column(0).to_pylist()]
    notice = re.compile(r"(?i)^.{0,40}(licen[cs]ed under|released under the|all rights reserved|permission is hereby)")
    lines = {line.strip() for t in texts for line in t.split("\n") if len(line) < 120 and notice.search(line)}
    scanner = licenses.Scanner(licenses.TEMPLATES, len(texts), {})
    assert "All rights reserved." in lines
    assert [line for line in lines if scanner.scan(line)[0] is None] == []


@pytest.mark.parametrize("name, text", [(n, t) for n, ts in licenses.TEMPLATES.items() for t in ts])
def test_each_template_is_its_own_licence(name, text):
    scanner = licenses.Scanner(licenses.TEMPLATES, 1000, {"the": 900, "and": 900, "of": 900, "license": 40})
    found = scanner.scan(text)
    assert found[1] > 0.99 and (found[0] == name or text in licenses.TEMPLATES[found[0]])


def test_anchors_skip_nothing_that_counts():
    dice = random.Random(1)
    words = sorted(licenses.vocabulary(licenses.TEMPLATES)) + ["foo", "bar"]
    scanner = licenses.Scanner(licenses.TEMPLATES, 1000, {w: dice.randint(0, 900) for w in words})
    for _ in range(300):
        text = dice.choice([t for ts in licenses.TEMPLATES.values() for t in ts]).split()
        text = " ".join(dice.choice(words) if dice.random() < dice.random() / 2 else w for w in text)
        best = scanner.compare(collections.Counter(licenses.terms(text)))
        plain = best is not None and best[0] >= scanner.threshold
        assert (scanner.scan(text)[0] is not None) == plain


# --- near duplicates --------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts(n=120):
    dice = random.Random(11)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        if texts and dice.random() < 0.5:
            copy = dice.choice(texts).split()
            copy[dice.randrange(len(copy))] = dice.choice(words)
            texts.append(" ".join(copy))
        else:
            texts.append(" ".join(dice.choices(words, k=150)))
    return texts


def test_fingerprints_and_components(spark):
    texts = [None, "", " \t\n", "One two", "one TWO", "É é"] + near_texts()
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(50, texts[50]), (5, texts[60])]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (id, _) in enumerate(rows):
        least.setdefault(root(i), []).append(id)
    want = collections.Counter(
        (id, f"{prints[i]:016x}", min((x for x in least[root(i)] if x is not None), default=None)) for i, (id, _) in enumerate(rows)
    )
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == want
    assert max(map(len, least.values())) > 3
    assert simhash.near_duplicates(documents(spark, []), ).count() == 0


def test_trie_walk_finds_every_pair():
    dice = random.Random(2)
    values = {dice.getrandbits(64) for _ in range(300)}
    for v in list(values)[:100]:
        for _ in range(8):
            x = v
            for bit in dice.sample(range(64), dice.randint(1, 6)):
                x ^= 1 << bit
            values.add(x)
    values = np.array(sorted(values), np.uint64)
    found = set()
    for i, j in simhash.trie_links(values, [(0, len(values), 0, len(values))], 0, 4):
        found |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    assert found == {(i, j) for i, j in zip(*np.nonzero(apart <= 4)) if i < j}


def test_one_row_of_a_group_stays(spark):
    texts = near_texts(40)
    copy = texts[0].split()
    copy[5] = "changed"
    rows = [(10, texts[0]), (4, " ".join(copy)), (4, " ".join(copy)), (30, texts[0]), (None, "solo " * 3), (None, "solo " * 3)]
    rows += [(90, None), (91, "")]
    df = documents(spark, rows)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, "solo " * 3), (4, " ".join(copy)), (90, "")]
    assert simhash.keep_one(df.limit(0)).count() == 0


def rows_left(texts):
    """The first text of each component of the links of at most four bits, by comparing all pairs."""
    prints = [plain_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {i for i in range(len(texts)) if root(i) == i}


def test_the_first_text_of_each_component_stays(spark):
    dice = random.Random(13)
    words = [f"w{i}" for i in range(300)]
    texts = ["", None]
    for _ in range(15):
        base = dice.choices(words, k=100)
        texts.append(" ".join(base))
        texts.append(" ".join(dice.sample(base, len(base))))  # the same words in another order
        chain = list(base)
        for at in (10, 30, 50, 70):
            chain[at] = chain[at - 1]
            texts.append(" ".join(chain))
    texts += texts[3:9]
    dice.shuffle(texts)
    df = documents(spark, list(enumerate(texts)))
    # names that the steps use themselves
    for name in ("kept_node", "kept_id", "root", "first", "fp", "row", "rank", "a.b"):
        df = df.withColumn(name, F.lit(name))
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == rows_left(texts)


def test_links_do_not_depend_on_how_deep_the_shuffle_deals(spark):
    dice = random.Random(8)
    values = {dice.getrandbits(64) for _ in range(60)}
    for v in list(values):
        values |= {v ^ sum(1 << b for b in dice.sample(range(64), n)) for n in (1, 3, 4, 5, 9)}
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    groups = []
    for bits in (4, 7):
        nodes = simhash.connected(simhash.fingerprint_links(df, bits=bits)).collect()
        groups.append({(r.node, r.root) for r in nodes})
    assert groups[0] == groups[1] and len(groups[0]) > 200
    assert [simhash.top_bits(n) for n in (0, 1 << 24, 1 << 25, 1 << 30, 1 << 60)] == [4, 4, 5, 10, 16]


# --- language model ---------------------------------------------------------------


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "MAX_FREQUENT", 150)
    dice = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("s", "ing", "ed", "")]
    texts = []
    for _ in range(150):  # what follows a word is one of three words
        at, text = dice.randrange(20), []
        for _ in range(dice.randint(1, 80)):
            at = (3 * at + dice.randrange(3)) % 20
            text.append(words[at])
        texts.append(" ".join(text))
    rows = list(enumerate(texts)) + [(1000, None), (1001, ""), (1002, "Unseen words HERE ing ing"), (3, texts[3]), (None, "bas bas")]
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    found = lm.score_texts(documents(spark, rows), held).collect()
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in train for w in [*(t or "").encode().lower().split(), b""])
    total, distinct = sum(counts.values()), len(counts)
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), b""]
        r = by_id[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens))
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.score < 0
    kept = [r for r in found if r.held_out]
    assert sum(r.score for r in kept) > sum(r.base_score for r in kept)
    assert lm.score_texts(documents(spark, []), held).count() == 0


def test_the_model_is_a_distribution(spark):
    texts = spark.createDataFrame([("a b a c",), ("b a d",), ("a a b e f",)], "t string").select(F.col("t").cast("binary").alias("text"))
    model, counts = lm.train(texts, steps=5)
    words = {bytes(r.word): r.n for r in counts.collect()}
    contexts = np.array([0, 5, lm.CONTEXTS - 1])
    assert np.allclose(np.exp(lm.log_classes(model.weights, contexts)).sum(axis=1), 1, atol=1e-5)
    held = collections.Counter()
    for w, n in words.items():
        c = int(model.classes[model.index[w]])
        held[c] += 10 ** model.in_class(np.array([c]), np.array([n]))[0]
    for c in range(lm.SINGLES, lm.CLASSES):
        if model.class_tokens[c]:
            assert held[c] + 10 ** model.in_class(np.array([c]), np.array([0]))[0] == pytest.approx(1)



def test_the_context_is_the_words_before_not_their_class(spark):
    """xxcat and yycat share a class; only the words tell what follows them."""
    fillers = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "xxcat dog") for i in range(8)] + [(10 + i, "yycat fish") for i in range(8)]
    rows += [(100 + i, fillers + " dog fish dog fish dog fish") for i in range(10)]
    rows += [(1000, "xxcat dog"), (1001, "yycat dog")]
    found = {r.doc_id: r for r in lm.score_texts(documents(spark, rows), F.col("doc_id") < 1000).collect()}
    assert found[1000].base_score == pytest.approx(found[1001].base_score)
    assert found[1000].score > found[1001].score + 0.1



def test_a_step_reads_each_context_once_packed_and_takes_the_whole_gradient(spark):
    texts = spark.createDataFrame([(f"a b{i % 7} c{i % 5} a d{i % 3} e",) for i in range(300)], "t string").select(F.col("t").cast("binary").alias("text"))
    model, _ = lm.train(texts, steps=1)
    events = lm._events(texts, model)
    rows = events.collect()
    weights = np.random.default_rng(3).normal(0, 0.5, (lm.BUCKETS, lm.CLASSES))
    contexts = np.array(sorted({r.context for r in rows}))
    counts = np.zeros((len(contexts), lm.CLASSES))
    for r in rows:
        counts[np.searchsorted(contexts, r.context), r["class"]] += r.n
    counts -= counts.sum(axis=1, keepdims=True) * np.exp(lm.log_classes(weights, contexts))
    expected = np.zeros_like(weights)
    for own in lm.feature_rows(contexts):
        np.add.at(expected, own, counts)
    packed = lm._packed(events)
    assert sum(len(r.tokens) // 8 for r in packed.collect()) == len(contexts)
    assert np.allclose(lm._observed(events) - lm._expected(packed, weights), expected, atol=1e-4)


def test_the_events_table_is_dealt_by_the_shuffle_not_into_a_fixed_few_tasks(spark):
    """Eight tasks, whatever the input, each took an eighth of all (context, class) rows: that grows with the texts."""
    texts = spark.createDataFrame([(f"w{i} x{i % 13} y{i % 7} z{i}",) for i in range(2000)], "t string").select(F.col("t").cast("binary").alias("text"))
    model, _ = lm.train(texts, steps=1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        events = lm._event_table(texts, model)
        assert events.inputFiles() and len(events.inputFiles()) > 8
        assert events.count() == lm._events(texts, model).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_words_and_their_hashes_are_those_of_the_texts():
    dice = random.Random(8)
    texts = [bytes(dice.choice(b" \t\n\x0b\x0c\r\x00\x1c\x85aAzZ\xc3\xa9!") for _ in range(dice.randint(0, 70))) for _ in range(500)]
    texts += [b"", b" ", b"long " * 3000, b"y" * 33 + b" " + b"Q" * 100, *(b"z" * n for n in range(45)), b""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"]).slice(2)
    found, hashes = [], []
    for first, end, words in lm._blocks(batch, 0, 4000):
        own = words.bytes_of(np.arange(len(words.hashes)))
        hashes += words.hashes.tolist()
        ends = np.cumsum(words.sizes).tolist()
        assert len(ends) == end - first
        found += [own[a:b] for a, b in zip([0, *ends], ends)]
    assert found == [lm.tokens(t) for t in texts[2:]]
    assert hashes == [xxhash.xxh64_intdigest(w, lm.HASH_SEED) for own in found for w in own]

    counts = collections.Counter(w for own in found for w in own)
    model = lm.Model(counts.most_common(60), sum(counts.values()), len(counts))
    reader = lm._Reader(model)
    for _, _, words in lm._blocks(batch, 0):
        numbers, classes = reader.read(words)
        for w, number, c in zip(words.bytes_of(np.arange(len(numbers))), numbers.tolist(), classes.tolist()):
            assert number == model.index.get(w, -1)
            assert c == (number if 0 <= number < lm.SINGLES else lm.ending_class(w))


def test_texts_without_words_are_learned_from_and_scored(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "")]
    found = {r.doc_id: r for r in lm.score_texts(documents(spark, rows), F.col("doc_id") < 4, steps=2).collect()}
    assert found.keys() == {1, 2, 3, 4}
    for r in found.values():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (1, 1, 3, r.doc_id == 4)
        assert r.base_score == pytest.approx(math.log10(4 / 5))
        assert r.score <= 0
    mixed = {r.doc_id: r for r in lm.score_texts(documents(spark, [*rows, (5, "new words")]), F.col("doc_id") < 4, steps=2).collect()}
    assert (mixed[5].n_tokens, mixed[5].n_known) == (3, 1)


def test_contexts_are_counted_in_packed_buckets_as_in_rows(spark, monkeypatch):
    texts = spark.createDataFrame([(f"a b{i % 97} c{i % 5} a d{i % 3} e{i * i % 131}",) for i in range(900)], "t string").select(F.col("t").cast("binary").alias("text")).repartition(3)
    model, _ = lm.train(texts, steps=1)
    rows = lm._events(texts, model).groupBy("context").agg(F.sum("n").alias("n")).collect()
    expected = {r.context: r.n for r in rows}

    def counted():
        held, times = collections.Counter(), 0
        for r in lm._counted(texts, model).collect():
            for (one, two, both), n in zip(np.frombuffer(r.rows, np.int16).reshape(-1, 3).tolist(), np.frombuffer(r.tokens, np.float32).tolist()):
                held[(one * lm.BUCKETS + two) * lm.BUCKETS + both] += n
                times += 1
        return held, times

    assert counted() == (expected, len(expected))
    assert np.allclose(lm._observed_of(lm._counted(texts, model)), lm._observed(lm._events(texts, model)))
    monkeypatch.setattr(lm, "PIECE_TOKENS", 500)  # more pieces, and buckets that are merged in parts
    monkeypatch.setattr(lm, "MERGED_CONTEXTS", 1)
    assert counted()[0] == expected


def test_a_step_sends_the_driver_as_many_tables_as_there_are_cores(spark):
    """A table of the weights' shape from each split of the contexts was more than the driver takes as the texts grow."""
    texts = spark.createDataFrame([(f"a b{i % 7} c{i % 5} a d{i % 3} e",) for i in range(300)], "t string").select(F.col("t").cast("binary").alias("text"))
    model, _ = lm.train(texts, steps=1)
    packed = lm._packed(lm._events(texts, model)).repartition(40).persist()
    weights = np.random.default_rng(4).normal(0, 0.5, (lm.BUCKETS, lm.CLASSES))
    whole = lm._expected(packed, weights)
    assert whole.sum() == pytest.approx(4 * 300 * 7, rel=1e-6)
    context = spark.sparkContext
    context.setJobGroup("step", "a step")
    try:
        lm._expected(packed, weights)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        packed.unpersist()
    stages = [s for j in context.statusTracker().getJobIdsForGroup("step") for s in context.statusTracker().getJobInfo(j).stageIds]
    last = context.statusTracker().getStageInfo(max(stages))
    assert last.numTasks <= context.defaultParallelism


def test_single_precision_gives_the_scores_of_double(spark, monkeypatch):
    """A step divides a gradient by its size: where it should be zero, rounding alone moved the weights."""
    dice = random.Random(5)
    rows = [(i, " ".join(f"w{int(dice.expovariate(0.05))}" for _ in range(60))) for i in range(200)]
    found = []
    for spread in (lm.SINGLE_SPREAD, 0):
        monkeypatch.setattr(lm, "SINGLE_SPREAD", spread)
        found.append({r.doc_id: r.score for r in lm.score_texts(documents(spark, rows), F.col("doc_id") % 5 != 0, steps=8).collect()})
    assert found[0].keys() == found[1].keys()
    assert max(abs(found[0][i] - found[1][i]) for i in found[0]) < 4e-6  # 1.4e-5 if rows are not scaled to their tokens


# --- tokens -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def test_ids_are_the_librarys(spark, tokenizer):
    dice = random.Random(6)
    letters = "abcdeé ñ\n\t 1230!?'’sſ\x85\x1c世界🙂"
    texts = ["".join(dice.choices(letters, k=dice.randint(0, 60))) for _ in range(400)]
    texts += ["", None, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "the" * 3000, " " * 500 + "x", "dont DON'T 'll's", "é" * 9]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "null id")]
    df = bpe.decode(bpe.encode(documents(spark, rows), TOKENIZER), TOKENIZER)
    text_of = collections.defaultdict(list)
    for i, t in rows:
        text_of[i].append(t)
    for r in df.select("doc_id", "ids", "decoded").collect():
        ids = tokenizer.encode(text_of[r.doc_id][0] or "", add_special_tokens=False).ids
        assert r.ids == ids
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
    digested = bpe.with_digests(df.select("doc_id", "text", "score"), TOKENIZER)
    assert digested.columns == ["doc_id", "score", "n_tokens", "ids_sha256", "decoded_sha256"]
    plan = digested._jdf.queryExecution().executedPlan().toString()
    assert plan.count("digests(text") == 1  # no text is encoded twice
    with pytest.raises(ValueError, match="already"):
        bpe.with_digests(df.withColumn("N_tokens", F.lit(1)), TOKENIZER)
    digest = {r.doc_id: r for r in digested.collect()}
    ids = tokenizer.encode(texts[7], add_special_tokens=False).ids
    assert digest[7].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert digest[7].n_tokens == len(ids)
    assert bpe.encode(df.select("doc_id", "text").limit(0), TOKENIZER).count() == 0


def test_compatible_pairs_are_those_merging_leaves_alone():
    coder = bpe.Coder(bpe.load_vocabulary(TOKENIZER))
    dice = np.random.default_rng(8)
    a, b = dice.integers(0, 50_000, 3000), dice.integers(0, 50_000, 3000)
    plain = [coder.merge(coder.pieces[x] + coder.pieces[y]) == [x, y] for x, y in zip(a, b)]
    assert coder.compatible(a, b).tolist() == plain
    assert 0 < sum(plain) < len(plain)


def test_words_merged_side_by_side_are_those_merged_alone():
    coder = bpe.Coder(bpe.load_vocabulary(TOKENIZER))
    dice = random.Random(9)
    words = ["".join(dice.choices("abcdeé st\0-界", k=dice.choice([0, 1, 2, 5, 8, 9, 16, 30, 70]))).encode() for _ in range(6000)]
    words += [b"aaaaaaaaa", b"\0\0\0", b" the", b"\xff\xfe"]
    assert [np.frombuffer(b, "<u4").tolist() for b in coder.merge_all(words)] == [coder.merge(w) for w in words]
    assert coder.merge_all([]) == []


def test_ascii_words_are_cut_alike():
    dice = random.Random(10)
    letters = "ab'slltdrvem  \n\t\r\x0b\x0c\x1c\x1f\x00\x7f019!?_-"
    wide, narrow = bpe.regex.compile(bpe.WORDS), bpe.re.compile(bpe.ASCII_WORDS)
    for _ in range(3000):
        text = "".join(dice.choices(letters, k=dice.randint(0, 40)))
        assert wide.findall(text) == narrow.findall(text)


def test_ids_out_of_range_decode_to_nothing():
    coder = bpe.Coder(bpe.load_vocabulary(TOKENIZER))
    assert coder.decode(np.array([-1, 10**6])) == ""
    assert coder.decode(np.array([coder.single[0xE9]])) == "�"


# --- archives ---------------------------------------------------------------------


def test_archives(spark):
    magic = "WARC/1.1\r\n"
    evil = magic + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bodies = [None, "", evil * 3, "a" + magic + magic + "b", evil + "x" * 7000 + evil * 2, "z" * 9000, "é" * 5, "dup", "dup"]
    rows = [(i, f"http://x/{i}/{magic}", bodies[i % 9]) for i in range(45)] + [(None, None, "null"), (7, None, "dup"), (7, None, "dup")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit("x")).repartition(3)
    path = work_dir(spark, "archives")
    warc.write_archives(warc.records(df), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # records and magics across splits
    try:
        assert warc.split_bytes(spark) == 4 << 10
        planned = warc.read_archives(spark, path)
        splits = warc._stored(spark, path, warc.VERSION).where("bytes IS NOT NULL").groupBy("file").count().agg(F.max("count")).first()[0]
        assert splits >= 4  # pointers have somewhere to jump
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")  # splits found once stay as they were
        found = planned.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == len(rows)
    named = {r.headers["warc-record-id"]: bytes(r.payload).decode() for r in found if r.record_type == "response"}
    got = collections.Counter()
    for r in found:
        id = int(r.headers["x-page-id"]) if "x-page-id" in r.headers else None
        revisit = r.record_type == "revisit"
        got[id, named[r.headers["warc-refers-to"]] if revisit else bytes(r.payload).decode()] += 1
        assert revisit or r.headers["warc-payload-digest"] == f"sha1:{r.payload_digest}"
    assert got == collections.Counter((i, html or "") for i, _, html in rows)
    latest = {}
    for i, _, html in rows:
        latest[html or ""] = max(latest.get(html or "", -1), -1 if i is None else i)
    assert all((r.record_type == "response") == (int(r.headers.get("x-page-id", -1)) == latest[named.get(r.headers.get("warc-refers-to", r.headers["warc-record-id"]))]) for r in found)


def test_no_pages_and_broken_archives(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    path = work_dir(spark, "archives")
    warc.write_archives(warc.records(none), path)
    assert warc.read_archives(spark, path).count() == 0
    path = work_dir(spark, "archives")
    spark.createDataFrame([("WARC/1.1\r\nContent-Length: 99\r\n\r\nshort",)], "record string").write.text(path)
    with pytest.raises(ValueError, match="breaks off"):
        warc.read_archives(spark, path)


# --- shards -----------------------------------------------------------------------


def test_shards(spark):
    dice = random.Random(9)
    texts = ["x" * dice.randint(0, 400) + str(i) for i in range(300)] + ["copy" * 40] * 60 + [None, "", "é"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, "null id")]
    found = sharding.shard_documents(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    size = collections.Counter()
    homes, slots = collections.defaultdict(set), collections.defaultdict(list)
    text_of = dict(rows)
    for r in found:
        data = (text_of[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        size[r.shard] += r["size"]
        homes[data].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    copies = 60 * 161
    rest = sorted(v for v in size.values())[:-1]
    assert max(size.values()) == copies and rest[-1] - rest[0] <= 0.02 * rest[-1]  # the copies are more than a shard
    assert sharding.shard_documents(documents(spark, [])).count() == 0
    path = work_dir(spark, "shards")
    sharding.write_shards(sharding.shard_documents(documents(spark, rows)), path)
    assert spark.read.parquet(path).count() == len(rows)


def test_differencing_beats_filling_the_emptiest():
    dice = random.Random(3)
    sizes = [dice.randint(1, 10**6) for _ in range(500)]
    found = sharding.differencing(sizes, 16)
    sums = [sum(s for s, at in zip(sizes, found) if at == k) for k in range(16)]
    greedy = [0] * 16
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert sum(sums) == sum(sizes) and max(sums) - min(sums) < max(greedy) - min(greedy)
    assert sorted(sharding.differencing([8, 7, 6, 5, 4], 2)) and sharding.differencing([], 4) == []


# --- mixing -----------------------------------------------------------------------


def plain_poisson(u, rate):
    k, total = 0, math.exp(-rate)
    while total < u:
        k += 1
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def plain_draw(id, text):
    name = f"mix|{'null' if id is None else id}|{hashlib.md5((text or '').encode()).hexdigest()}"
    return (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def test_mixing(spark, monkeypatch):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else None if i % 3 == 1 else f"s{i % 7}") for i in range(600)] + [(0, "t0", "hot"), (None, "n", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy_", F.lit(1))
    weights = {"hot": 1.0, None: 3.0, "s1": 0.5, "s2": 0.0}
    found = mixing.mix_sources(df, weights=weights, size=2.0, copy="copy").collect()
    n = collections.Counter(s for _, _, s in rows)
    total = sum(w for s, w in weights.items() if n[s])
    want = collections.Counter()
    for i, t, s in rows:
        rate = weights.get(s, 0.0) / total * 2.0 * len(rows) / n[s]
        u = plain_draw(i, t)
        want[i, t, s] += plain_poisson(u, rate) if rate else 0
    assert collections.Counter((r.doc_id, r.text, r.source) for r in found) == +want
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)  # many sources are joined
    joined = mixing.mix_sources(df, weights=weights, size=2.0, copy="copy").collect()
    assert collections.Counter(joined) == collections.Counter(found)
    assert mixing.mix_sources(df).columns == df.columns
    assert mixing.mix_sources(df.limit(0)).count() == 0
    for clash in ({"copy": "copy_"}, {"order": "TEXT"}):
        with pytest.raises(ValueError, match="already"):
            mixing.mix_sources(df, **clash)
    assert mixing.mix_sources(df, weights={"absent": 1.0}).count() == 0
    with pytest.raises(ValueError, match="the limit"):
        mixing.mix_sources(df, weights={"s1": 1.0}, size=10_000.0)


def test_a_source_of_one_row_among_many(spark):
    """Derived rates have no limit, and large ones are the SQL's."""
    n = 5000  # equal shares give the rate that the default gives at about 6 million rows
    source = F.when(F.col("id") == 77, F.lit(None)).otherwise(F.lit("web")).cast("string")
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), source.alias("source"))
    found = mixing.mix_sources(df, temperature=0.0).groupBy("source").count().collect()
    rate = n / 2
    u = plain_draw(77, "t")
    got = {r.source: r["count"] for r in found}
    assert rate > mixing.MAX_RATE and got[None] == plain_large_poisson(u, rate)
    assert abs(got["web"] - (n - rate)) < 6 * math.sqrt(n)


@pytest.mark.parametrize("id", [None, 5])
def test_rows_that_share_an_id_are_drawn_each_by_itself(spark, id):
    """A third of all rows without an id, or with one id, neither comes nor goes as a whole, and is not dealt to one place."""
    n = 6000
    rows = [(id if i % 3 == 0 else 10 + i, f"t{i}", "a" if i % 2 else "b") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(df)
    shared = found.where(F.col("doc_id").eqNullSafe(F.lit(id)))
    per_part = [r["count"] for r in shared.groupBy(F.spark_partition_id()).count().collect()]
    assert abs(sum(per_part) - n / 3) < 6 * math.sqrt(n / 3)
    assert len(per_part) == 1 or max(per_part) < 0.6 * sum(per_part)


def plain_large_poisson(u, rate):
    k, total = 0, 0.0
    while True:
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if total >= u:
            return k
        k += 1


@pytest.mark.parametrize("rate", [0.001, 1.5, 399.9, 400.0, 1048.0, 31_000.0])
def test_counts_are_those_of_the_whole_distribution(spark, rate):
    column = F.lit(rate)
    row = spark.range(1).select(mixing.cumulative(column).alias("cdf"), mixing.least_count(column).alias("least")).first()
    draws = [(i + 0.5) / 20 for i in range(20)] + [2**-53, 1e-9, 1 - 1e-6]
    assert [row.least + sum(c < u for c in row.cdf) for u in draws] == [plain_large_poisson(u, rate) for u in draws]


# --- toxicity ---------------------------------------------------------------------


def toxic_rows():
    dice = random.Random(12)
    plain = [f"{a}{b}" for a in ("ram", "sol", "tin", "vek", "dor") for b in ("ano", "ilu", "esk", "omb", "urt")]
    rows, labels = [], []
    for i in range(400):
        words = dice.choices(plain, k=dice.randint(5, 60))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(dice.randint(1, 4)):
                words.insert(dice.randrange(len(words)), dice.choice(["grubber", "snarkle", "blotch"]))
        if not toxic and i % 9 == 0:
            words.insert(0, "ink blotch")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame(labels + [(1, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    lexicon = toxicity.learn(documents(spark, rows, extra=False), marks)
    assert {"grubber", "snarkie"} <= set(lexicon.weights)  # folded: l is i
    probes = {
        "the GRUBBER! of sol": 1,
        "gruЬber".replace("Ь", "b") + " ramano": 1,
        "sn4rkl3 ramano": 1,
        "ｇｒｕｂｂｅｒ ramano": 1,
        "gr​ubber ramano": 1,
        "ramano solilu": 0,
        "xgrubber ramano": 0,
        "": 0,
    }
    df = documents(spark, [*enumerate(probes), (99, None)]).drop("score")
    scored = toxicity.with_scores(df, lexicon)
    found = {r.doc_id: r.score for r in scored.collect()}
    assert [int(found[i] >= 0.5) for i in range(len(probes))] == list(probes.values())
    assert found[99] == found[list(probes).index("")] and all(0 <= s <= 1 for s in found.values())
    kept = toxicity.reject_toxic(documents(spark, [*enumerate(probes), (99, None)]), lexicon)
    assert kept.count() == 4 and kept.columns == documents(spark, []).columns
    assert lexicon.weight("ink blotch") == 0 or "blotch" not in lexicon.weights


def test_copies_of_long_toxic_texts_push_no_term_out(spark):
    rows, labels = toxic_rows()
    for of in range(2):  # their words, with their stems, are more than there used to be places
        long = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + of)}quormstel{chr(97 + i // 676)}" for i in range(1200))
        rows += [(1000 + 200 * of + i, long) for i in range(150)]
        labels += [(1000 + 200 * of + i, 1) for i in range(150)]
    lexicon = toxicity.learn(documents(spark, rows, extra=False), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {"grubber", "snarkie"} <= set(lexicon.weights)
    assert not any("quorm" in term for term in lexicon.weights)


def test_no_labels_reject_nothing(spark):
    rows, labels = toxic_rows()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = toxicity.learn(documents(spark, rows[:20], extra=False), none)
    assert lexicon.weights == {} and toxicity.reject_toxic(documents(spark, rows[:20]), lexicon).count() == 20
    assert toxicity.with_scores(documents(spark, []).drop("score"), lexicon).count() == 0
