"""The registered queries that SQL cannot say, and the pipeline, against plain Python on small tables."""

import base64
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_batch_operators import plain_draw, plain_fingerprint, plain_poisson
from tokenizers import Tokenizer

import corpus_pipeline
from topicflow.llm import toxicity
from topicflow.llm.common import table, written
from topicflow.llm.queries import QUERIES

REPO = Path(__file__).resolve().parents[2]
INSULTS = ["idiot", "moron", "scum"]
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64())])
LABELS = pa.schema([("doc_id", pa.int64()), ("quality", pa.int64()), ("toxic", pa.int64())])


def documents():
    draw = random.Random(21)
    words = [f"w{i}" for i in range(250)] + ["Über", "naïve", "日本", "it's", "x=1"]
    texts = [None, "", " \n\t", "one", "<|endoftext|> here", "long " * 30_000]
    for i in range(150):
        kind = draw.random()
        if kind < 0.2 and len(texts) > 10:
            copy = draw.choice(texts[6:]).split(" ")
            copy[draw.randrange(len(copy))] = draw.choice(words)
            texts.append(" ".join(copy))
        else:
            text = draw.choices(words, k=draw.randint(40, 120))
            if kind > 0.75:
                text = [*text[:20], "you", draw.choice(INSULTS), *text[20:], draw.choice(INSULTS)]
            texts.append(" ".join(text))
    texts += texts[8:14]
    return [(i, t, draw.choice(["en", "de", None]), draw.choice(["a", "a", "b", None]), len(t or "")) for i, t in enumerate(texts)]


def is_toxic(text):
    return any(f" {w}" in (text or "") for w in INSULTS)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    rows = documents()
    write(at / "documents.parquet", rows, DOCUMENTS)
    write(at / "labels.parquet", [(i, i % 2, int(is_toxic(t))) for i, t, *_ in rows if i % 3], LABELS)
    draw = random.Random(5)
    pages = [(i, f"http://x/{i}", draw.choice([None, "", "<p>hot</p>", "WARC/1.1\r\n<p>é</p>", f"<p>{i}</p>" * 50])) for i in range(80)]
    write(at / "pages.parquet", pages, pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string())]))
    dice = np.random.default_rng(4)
    vectors = [(i, v.tolist()) for i, v in enumerate(dice.standard_normal((300, 12)).astype(np.float32))]
    vectors += [(300, None), (320, [0.0] * 12), (340, [math.nan] * 12), (360, vectors[7][1])]
    write(at / "embeddings.parquet", vectors, pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32()))]))
    return at


def write(path, rows, schema):
    pq.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema), path)


def run(spark, name, at):
    return QUERIES[name](spark, str(at)).collect()


def crc(id, divisor):
    return zlib.crc32(str(id).encode()) % divisor


def test_neighbours(spark, tables):
    found = run(spark, "op1_collision_counting", tables)
    rows = {r["vec_id"]: r["embedding"] for r in pq.read_table(tables / "embeddings.parquet").to_pylist()}
    usable = {i: np.array(v, np.float64) for i, v in rows.items() if v and all(map(math.isfinite, v)) and any(v)}
    best = defaultdict(set)
    for q in (i for i in usable if i % 20 == 0):
        order = sorted((-float(usable[q] @ v), i) for i, v in usable.items() if i != q)
        best[q] = {i for _, i in order[:20]}
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r)
        assert r.score == pytest.approx(float(usable[r.query_id] @ usable[r.vec_id]), rel=1e-12)
    assert got.keys() == best.keys()
    for q, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert [(r.score, -r.vec_id) for r in rows] == sorted(((r.score, -r.vec_id) for r in rows), reverse=True)
    assert sum(len(best[q] & {r.vec_id for r in rows}) for q, rows in got.items()) >= 0.9 * 20 * len(best)


def components(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 4:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_near_duplicates(spark, tables):
    rows = documents()
    prints = [plain_fingerprint(t) for _, t, *_ in rows]
    expected = Counter((r[0], f"{p:016x}", rows[c][0]) for r, p, c in zip(rows, prints, components(prints)))
    assert Counter(tuple(r) for r in run(spark, "op4_simhash_trie", tables)) == expected


def test_language_model(spark, tables):
    found = {r.doc_id: r for r in run(spark, "op5_hashed_maxent", tables)}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t, *_ in documents()}
    training = Counter(w for i, own in tokens.items() if crc(i, 7) != 2 for w in own)
    total, distinct = sum(training.values()), len(training)
    assert found.keys() == tokens.keys()
    for i, own in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i, 7) == 2, len(own), sum(training[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((training[w] + 1) / (total + distinct + 1)) for w in own), rel=1e-9)
        assert r.score < 0


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
    )


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_tokens(spark, tables, library):
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(spark, "op6_bpe_speculative", tables)}
    assert found == {i: digests(library, t) for i, t, *_ in documents()}


def test_archives(spark, tables):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in pq.read_table(tables / "pages.parquet").to_pylist()}
    latest = {}
    for i, html in pages.items():
        latest[html] = max(i, latest.get(html, i))
    expected = set()
    for i, html in pages.items():
        digest = base64.b32encode(hashlib.sha1(html).digest()).decode()
        last = latest[html]
        expected.add((i, len(html), digest, *(("response", None) if i == last else ("revisit", last))))
    found = run(spark, "op7_warc_chains", tables)
    assert {tuple(r) for r in found} == expected and len(found) == len(pages)
    assert sum(r.record_type == "revisit" for r in found) > 20


def test_shards(spark, tables):
    found = run(spark, "op8_karmarkar_karp", tables)
    text = {i: (t or "").encode() for i, t, *_ in documents()}
    assert {(r.doc_id, r["size"], r.text_crc32, r.law, r.grown_shard) for r in found} == {(i, len(t) + 1, zlib.crc32(t), "bytes", None) for i, t in text.items()}
    homes, slots = defaultdict(set), defaultdict(list)
    for r in found:
        homes[text[r.doc_id]].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(h) == 1 for h in homes.values()) and slots.keys() <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_toxicity(spark, tables):
    found = {r.doc_id: r for r in run(spark, "op10_toxicity_lexicon", tables)}
    rows = documents()
    assert found.keys() == {r[0] for r in rows}
    for i, text, *_ in rows:
        r = found[i]
        assert r.held_out == (crc(i, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == int(is_toxic(text))


# --- the pipeline -----------------------------------------------------------------


def test_pipeline(spark, tables, library):
    rows = documents()
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    lexicon = toxicity.learn(docs, table(spark, str(tables), "labels", "doc_id", "toxic"))
    rows = [r for r in rows if lexicon.score(r[1]) < 0.5]
    assert {is_toxic(r[1]) for r in rows} == {False}

    roots = components([plain_fingerprint(r[1]) for r in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]

    n = Counter(r[3] for r in rows)
    weight = sum(math.sqrt(x) for x in n.values())
    times = {r[0]: plain_poisson(plain_draw(r[0], r[1]), math.sqrt(n[r[3]]) / weight * len(rows) / n[r[3]]) for r in rows}
    expected = Counter({(r[0], r[3], *digests(library, r[1])): times[r[0]] for r in rows if times[r[0]]})
    found = run(spark, "pipeline", tables)
    assert Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == expected
    assert max(times.values()) > 1 and 0 in times.values()


def test_pipeline_with_other_columns_nulls_and_nothing(spark, tables, tmp_path):
    write(tmp_path / "labels.parquet", [], LABELS)
    names = ["_fp", "_row", "root", "rank", "first", "_order", "_copy", "ids", "score"]
    wide = pa.schema([*DOCUMENTS, *[(name, pa.int64()) for name in names]])
    for rows, left in (([], 0), ([(None, None, None, None, None), (1, "a b c", None, None, 5), (None, "a b c", "en", "x", 5)], None)):
        write(tmp_path / "documents.parquet", [(*r, *range(len(names))) for r in rows], wide)
        docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            if name != "tokens":
                assert out.columns == docs.columns
                docs = written(out, name)
        found = out.collect()
        assert {r.doc_id for r in found} <= {None, 1} and (left is None or len(found) == left)


# --- executors without the package ------------------------------------------------

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
    .config("spark.sql.shuffle.partitions", "3").config("spark.checkpoint.dir", {shared!r}).config("spark.sql.session.timeZone", "UTC").getOrCreate())
def importable(x):
    try:
        import topicflow
        return True
    except ModuleNotFoundError:
        return False
assert not any(spark.sparkContext.parallelize([1, 2]).map(importable).collect())
from __spark_entry__ import queries
for name in {names!r}:
    assert queries()[name](spark, {tables!r}).collect(), name
print("all ran")
"""


def test_executors_need_no_copy_of_the_package(tables, tmp_path):
    names = ["op5_hashed_maxent", "op6_bpe_speculative", "op7_warc_chains", "op10_toxicity_lexicon", "op12_source_divergence", "op13_gray_code_audit"]
    script = SCRIPT.format(repo=str(REPO), shared=str(tmp_path / "shared"), names=names, tables=str(tables))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
