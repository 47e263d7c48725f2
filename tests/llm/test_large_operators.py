"""Passage removal, similarity join, classifiers and the pipeline against brute force and held-out labels."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import ngram_join, quality, suffix_dedup, toxicity
from strata.llm.common import SubstringHash, sliding_min
from tests.conftest import SF001, SF01

from .conftest import ODD


def test_hash_and_sliding_minimum():
    rng = np.random.default_rng(0)
    b = rng.integers(0, 3, 500).astype(np.uint8)
    h = SubstringHash(b)
    w = h.windows(7)
    for i, j in rng.integers(0, 490, (200, 2)):
        assert (w[i] == w[j]) == (b[i : i + 7].tobytes() == b[j : j + 7].tobytes())
    for width in (1, 2, 3, 8, 13, 500, 501):
        got = sliding_min(w, width)
        assert got.tolist() == [w[i : i + width].min() for i in range(len(w) - width + 1)]


def test_merged_transforms_find_repeated_windows():
    rng = random.Random(1)
    for trial in range(30):
        extra = rng.choice([127, 15, 0, 7, 31])
        alphabet = rng.choice([b"ab", b"abcdefgh"])
        left = bytes(rng.choice(alphabet) for _ in range(extra))
        right = bytes(rng.choice(alphabet) for _ in range(extra))
        rows = {}
        for _ in range(rng.randint(2, 40)):
            a, z = bytearray(left), bytearray(right)
            for _ in range(rng.randint(0, 2) if extra else 0):
                a[rng.randrange(extra)] = z[rng.randrange(extra)] = rng.choice(alphabet)
            x = rng.randint(0, extra)
            n = rng.randint(1, x + 1)
            rows[(rng.randint(0, 1), bytes(a[extra - x :]), bytes(z[: extra - x + n - 1]))] = rng.choice([1, 1, 1, 2])
        count: Counter = Counter()
        windows = {r: [(r[0], r[1][j:], r[2][: extra - len(r[1]) + j]) for j in range(len(r[1]) + len(r[2]) - extra + 1)] for r in rows}
        for r, n in rows.items():
            for w in windows[r]:
                count[w] += n
        keys = list(rows)
        got = suffix_dedup.repeated_windows(np.array([r[0] for r in keys]), [r[1] for r in keys], [r[2] for r in keys], np.array([rows[r] for r in keys]), extra)
        for r, marks in zip(keys, got):
            assert marks.tolist() == [count[w] > 1 for w in windows[r]]


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats_equal_brute_force(shipped, odd, empty, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = [(r.doc_id, r.text) for r in shipped.read.parquet(f"{SF001}/documents.parquet").collect()]
    base = rows[3][1]
    rows += [(10001, "a" * 3000), (10002, "ab" * 900), (10003, base[:399]), (10004, "é" * 500), (10005, "x" + base[100:700] + "y")]
    rows += [(10006, "zz" + base[90:560] + base[100:800])] * 2 + [(None, "null id " + base[50:600])] + [(r[0], r[1]) for r in ODD if len(r[1] or "") < 1000]
    df = shipped.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(df).collect())
    want = Counter((i, *w) for (i, _), w in zip(rows, suffix_dedup.brute_force([(t or "").encode() for _, t in rows])))
    assert got == want
    assert suffix_dedup.remove_repeats(odd).count() == len(ODD) and suffix_dedup.remove_repeats(empty).count() == 0


def plain_classes(texts: dict):
    """(class id, links, copies) of each id by comparing all shingle sets."""
    sets = {i: frozenset(ngram_join.shingles((t or "").encode()).tolist()) for i, t in texts.items()}
    copies = defaultdict(list)
    for i, s in sets.items():
        copies[s].append(i)
    distinct = sorted((s for s in copies if s), key=len)
    links = defaultdict(set)
    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if len(a) < 0.8 * len(b) - 1e-9:
                break
            common = len(a & b)
            if common >= 0.8 * (len(a) + len(b) - common) - 1e-9:
                links[a].add(b)
                links[b].add(a)
    out, seen = {}, set()
    for s in copies:
        if s in seen:
            continue
        group, todo = {s}, [s]
        while todo:
            for other in links[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        seen |= group
        least = min(i for g in group for i in copies[g])
        for g in group:
            for i in copies[g]:
                out[i] = (least, len(links[g]), len(copies[g]))
    return out


def test_similarity_join_equals_brute_force(shipped, odd, empty):
    rows = {r.doc_id: r.text for r in shipped.read.parquet(f"{SF001}/documents.parquet").collect()}
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(400)]
    for k in range(600):  # one large group of near copies, over several blocks
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(400)] = rng.choice(words)
        rows[20_000 + k] = " ".join(copy)
    rows |= {30_000: "", 30_001: None, 30_002: "one two", 30_003: "ONE  two", 30_004: "one two three"}
    df = shipped.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in ngram_join.near_duplicates(df).collect()}
    assert got == plain_classes(rows)
    left = {r.doc_id for r in ngram_join.drop_near_duplicates(df).collect()}
    assert left == {c for c, _, _ in got.values()}
    assert ngram_join.near_duplicates(odd).count() == len(ODD)
    assert ngram_join.drop_near_duplicates(odd).columns == odd.columns
    assert ngram_join.near_duplicates(empty).count() == 0


def test_forest_depth_meets_the_recall():
    k = ngram_join.prefix_depth()
    assert 1 - (1 - 0.8**k) ** ngram_join.TREES >= ngram_join.RECALL
    assert ngram_join.prefix_depth(trees=4) < k


def test_block_max_index_is_exact():
    rng = np.random.default_rng(4)

    def vector():
        t = np.sort(rng.choice(60, rng.integers(1, 12), replace=False))
        w = rng.random(len(t)).astype(np.float32)
        return t, w / np.sqrt((w * w).sum())

    data = [vector() for _ in range(300)]
    index = toxicity.BlockMaxIndex(data, 60, block=16)
    dense = np.zeros((300, 60), np.float32)
    for i, (t, w) in enumerate(data):
        dense[i, t] = w
    skipped = 0
    for _ in range(100):
        t, w = vector()
        ids, sims, scored = index.nearest(t, w, 5)
        want = np.sort((dense[:, t] @ w))[::-1][:5]
        assert np.allclose(sims, want[: len(sims)], atol=1e-5) and (len(sims) == 5 or want[len(sims)] <= 1e-6)
        skipped += scored < len(index.rows)
    assert skipped > 20


def toxic_corpus(shipped):
    rude = ["scumbaggy", "moronically", "trashlike"]
    plain = [(i, f"some plain words about the river bank number{i} and its boats", 0) for i in range(300)]
    bad = [(1000 + i, f"unlike{i} anything {rude[i % 3]} {rude[i % 3] if i % 2 else ''} and {rude[(i + 1) % 3] if i % 4 == 0 else 'boats'}", 1) for i in range(48)]
    rows = plain + bad + [(2000, "", 0), (2001, "moronically boats", 1)]
    docs = shipped.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, "Such MORONICALLY, nice boats"), (5001, "boats"), (5002, None)], "doc_id long, text string")
    marks = shipped.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return rows, docs, marks


def test_toxicity_finds_wording_that_tells_the_classes_apart(shipped):
    rows, docs, marks = toxic_corpus(shipped)
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, marks, "toxic")).collect()}
    assert got[5000].score > 0.9 > 0.1 > got[5001].score and got[5002].score < 0.1
    assert all(got[i].cosines[0] > 0.999 and i >= 1000 for i, _, y in rows if y)


def plain_cosines(texts, examples, corpus):
    """TF-IDF cosines of texts with examples, term by term, over the terms that tell the classes apart."""
    def terms(text):
        out = {}
        for w in re.findall(r"\w+", (text or "").lower()):
            padded = f" {w} "
            for t in {padded} | {padded[i : i + n] for n in (3, 4, 5, 6) for i in range(len(padded) - n + 1)}:
                out[t] = out.get(t, 0) + 1
        return out

    sets = [(terms(t), y) for _, t, y in examples]
    n = [sum(1 for _, y in sets if y == c) for c in (0, 1)]
    every = {t for s, _ in sets for t in s}
    space = set()
    for t in every:
        a = [sum(1 for s, y in sets if y == c and t in s) for c in (0, 1)]
        p = sum(a) / sum(n)
        if abs(a[1] / n[1] - a[0] / n[0]) > math.sqrt(p * (1 - p) * (1 / n[0] + 1 / n[1])) * math.sqrt(2 * math.log(len(every))):
            space.add(t)
    bags = [set(terms(t)) for t in corpus]
    idf = {t: math.log((len(bags) + 1) / (sum(t in b for b in bags) + 1)) + 1 for t in space}

    def vector(text):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in terms(text).items() if t in space}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    known = [(i, vector(t)) for i, t, _ in examples]
    return [sorted(((sum(x * w.get(t, 0) for t, x in v.items()), i) for i, w in known), reverse=True) for v in map(vector, texts)]


def test_toxicity_cosines_equal_plain_tf_idf(shipped):
    rows, docs, marks = toxic_corpus(shipped)
    got = sorted(toxicity.score(docs, toxicity.fit(docs, marks, "toxic")).collect(), key=lambda r: r.doc_id)
    want = plain_cosines([r.text for r in got], rows, [r.text for r in got])
    for r, w in zip(got, want):
        best = [c for c, _ in w[: toxicity.NEIGHBOURS] if c > 1e-6]
        assert np.allclose(r.cosines, best, atol=1e-5)
        exact = {i: c for c, i in w}
        assert np.allclose([exact[i] for i in r.neighbours], r.cosines, atol=1e-5)


def test_toxicity_skips_blocks_of_the_examples(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, quality.training_labels(shipped.read.parquet("/root/testdata/sf0.1/labels.parquet")), "toxic")
    texts = [r.text for r in docs.limit(600).collect()]
    vectors = [model._vector(*model.counts(t)) for t in texts]
    scored = [n for v in vectors if len(v[0]) for _, _, n in model.index.nearest_of([v], toxicity.NEIGHBOURS)]
    blocks = len(model.index.rows)
    print("terms", len(model.idf), "blocks", blocks, "scored", sum(scored) / len(scored))
    assert blocks > 8 and sum(scored) / len(scored) < 0.8 * blocks


def test_toxicity_recall_on_held_out_labels(shipped):
    folder = "/root/testdata/sf0.1"
    docs = shipped.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    table = shipped.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, quality.training_labels(table), "toxic")
    rows = held_out_labels(toxicity.score(docs.join(table.select("doc_id"), "doc_id", "left_semi"), model), table, "toxic")
    found = [r.score >= toxicity.THRESHOLD for r in rows if r.toxic]
    wrong = [r.score >= toxicity.THRESHOLD for r in rows if not r.toxic]
    print("recall", sum(found) / len(found), "false positives", sum(wrong) / len(wrong))
    assert len(found) > 80 and sum(found) / len(found) >= 0.85 and sum(wrong) / len(wrong) <= 0.01


def held_out_labels(docs, labels, name):
    rows = docs.join(labels.select(F.col("doc_id").alias("_d"), name), F.col("doc_id") == F.col("_d")).collect()
    return [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]


@pytest.mark.parametrize("module,name,least", [(quality, "quality", 0.97), (toxicity, "toxic", 0.9)])
def test_classifiers_on_held_out_labels(shipped, odd, empty, labels, module, name, least):
    docs = shipped.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    table = shipped.read.parquet(f"{SF01}/labels.parquet")
    model = module.fit(docs, quality.training_labels(table), name)
    rows = held_out_labels(module.score(docs, model), table, name)
    right = [(r.score >= module.THRESHOLD) == bool(r[name]) for r in rows]
    assert len(rows) > 40 and sum(right) / len(right) >= least
    for few in (labels, labels.limit(0)):
        scored = module.score(odd.select("doc_id", "text"), module.fit(odd, few, name))
        assert scored.count() == len(ODD) and all(0 <= r.score <= 1 for r in scored.collect())
    assert module.score(empty.select("doc_id", "text"), model, ["doc_id"]).count() == 0


def test_pipeline_stages(shipped):
    docs = shipped.read.parquet(f"{SF01}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](shipped, docs, SF01)
    assert good.columns == docs.columns
    rows = held_out_labels(docs.select("doc_id"), shipped.read.parquet(f"{SF01}/labels.parquet"), "quality")
    ids = {r.doc_id for r in good.select("doc_id").collect()}
    assert sum((r.doc_id in ids) == bool(r.quality) for r in rows) >= 0.97 * len(rows)
    exact = stages["exact dedup"](shipped, docs, SF01)
    texts = {r.doc_id: r.text for r in docs.collect()}
    largest: dict = {}
    for i, t in texts.items():
        plain = t.encode().lower()
        largest[plain] = max(largest.get(plain, -1), i)
    assert exact.columns == docs.columns and sorted(r.doc_id for r in exact.collect()) == sorted(largest.values())
    near = stages["n-gram Jaccard join"](shipped, docs, SF01)
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == {c for c, _, _ in plain_classes(texts).values()}
    mixed = stages["mixing sources to target weights"](shipped, docs, SF01)
    assert mixed.columns == docs.columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 4
    packed = stages["packing"](shipped, docs, SF01).select("doc_id", "length", "doc_tokens").collect()
    assert sum(r.length for r in packed) == sum({r.doc_id: r.doc_tokens for r in packed}.values())


def test_pipeline_of_no_documents(shipped, empty):
    docs = shipped.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(shipped, docs, SF001).count() == 0
