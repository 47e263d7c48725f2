"""Bit-plane clusters, speculative BPE and source divergence against plain versions."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
import re

from strata.llm import bit_clusters, divergence, speculative_bpe
from strata.llm.queries import QUERIES
from strata.llm.tokens import vocabulary_path

from .conftest import ODD
from .test_small_operators import TEXTS

BPE = vocabulary_path("byte_bpe_50k.json")


def plain_clusters(rows, k, rounds, seed=3, scale=1024):
    kept = [(i, [floor(float(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centers))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for c, vs in groups.items():
            centers[c] = [floor(Fraction(sum(x), len(vs))) for x in zip(*vs)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, c in out:
        per[c] += d
    return Counter((i, c, d, per[c], sum(per.values()), tuple(centers[c])) for i, d, c in out)


def test_planes_give_exact_dot_products():
    rng = np.random.default_rng(5)
    for planes in (1, 2, 12, bit_clusters.PLANES):
        top = 1 << (planes - 1)
        a, b = rng.integers(-top, top, (50, 64)), rng.integers(-top, top, (7, 64))
        a[0], a[1] = -top, top - 1
        pa_, pb = bit_clusters.pack_planes(a, planes), bit_clusters.pack_planes(b, planes)
        assert (bit_clusters.unpack_planes(pa_) == a).all()
        assert (bit_clusters.dot_products(pa_, pb) == a @ b.T).all()
        assert (bit_clusters.distances(pa_, pb) == ((a[:, None] - b[None]) ** 2).sum(axis=2)).all()


def vectors():
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 3, 1) for _ in range(64)]) for i in range(120)]
    rows += [(200, [0.25] * 64)] * 40  # a group of copies
    rows += [(None, [1.0] * 64), (5, [-2.0] * 64), (5, [2.0] * 64), (300, None), (301, []), (302, [1.0] * 63), (303, [1.0] * 65)]
    rows += [(304, [None] + [1.0] * 63), (305, [float("nan")] * 64), (306, [float("inf")] * 64), (307, [float("-inf")] + [0.0] * 63), (308, [-0.0004] * 64)]
    return [(i, v, "c", 1, 2, "p") for i, v in rows]


SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, n int, planes string"


@pytest.mark.parametrize("k,rounds", [(8, 10), (3, 0), (500, 2)])
def test_clusters_equal_plain_integers(shipped, k, rounds):
    df = shipped.createDataFrame(vectors(), SCHEMA).repartition(5)
    got = Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in bit_clusters.cluster(df, k, rounds).collect())
    assert got == plain_clusters([r[:2] for r in vectors()], k, rounds)


def test_clusters_of_nothing_and_of_too_large_integers(shipped):
    df = shipped.createDataFrame(vectors(), SCHEMA)
    empty = bit_clusters.cluster(df.limit(0))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert bit_clusters.cluster(df.where("vec_id between 300 and 307")).collect() == []
    with pytest.raises(ValueError, match="bits"):
        bit_clusters.cluster(shipped.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))


def words(seed=4, n=4000):
    rng = random.Random(seed)
    alphabet = "etaoinshrdlu" + "ABC019 '-" + "éß中😀"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def test_speculation_equals_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)  # as it comes: special tokens' strings are special tokens
    texts = [*TEXTS, *words(), "<|endoftext|>", " <|endoftext|>a<|endoftext|><|endoftext|>\n", "<|endoftext|", "x" * 30_000, "ab" * 9_000, "word " * 20_000]
    texts += ["a" * n + "b" for n in range(200)]
    enc = speculative_bpe.SpeculativeEncoder(BPE, limit=1000)
    for _ in range(2):
        ids, n = enc.encode(texts)
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert n.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
    assert 0 < enc.failed < enc.proposed
    table = speculative_bpe.Decoder(BPE)
    for w in want[:200]:
        assert table.decode(np.array(w, dtype=np.int64)).decode("utf-8", "replace") == library.decode(w, skip_special_tokens=False)


def test_pair_check_equals_merging_the_pair():
    merges = speculative_bpe.Merges(BPE)
    assert merges.reached[:50256].all()
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50256, (2, 4000))
    b[:1500] = a[:1500] % 600  # short right tokens cross more often
    # Pairs as greedy proposals give them.
    ids, counts = merges.propose([w.encode() for w in words(6) if w])
    a, b = np.concatenate([a, ids[:-1]]), np.concatenate([b, ids[1:]])
    crossed = merges.crossed(a, b)
    want = [merges.merge(merges.tokens[x] + merges.tokens[y]) != [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert crossed.tolist() == want and any(want) and not all(want)
    many = [w.encode() for w in words(7, 3000)] + [b"a" * n for n in range(1, 90)] + [b""]
    assert merges.merge_all(many) == [merges.merge(w) for w in many]


def test_encoded_and_decoded_columns(shipped, odd, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    twice = odd.withColumn("ids", odd.n_chars).withColumn("a.b", odd.n_chars).withColumn("decoded", odd.n_chars).withColumn("c0", odd.n_chars)
    out = speculative_bpe.decode(speculative_bpe.encode(twice, BPE), BPE)
    assert set(out.columns) == set(twice.columns) - {"text"}
    got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in out.collect())
    once = speculative_bpe.encode(twice, BPE, decoded="decoded")
    assert set(once.columns) == set(out.columns) and Counter((r.doc_id, bytes(r.ids), r.decoded) for r in once.collect()) == got
    want = Counter()
    for i, text, *_ in ODD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[(i, np.array(ids, dtype="<u4").tobytes(), library.decode(ids, skip_special_tokens=False))] += 1
    assert got == want
    assert speculative_bpe.decode(speculative_bpe.encode(empty, BPE), BPE).count() == 0


def test_bpe_query_equals_the_library_on_all_documents(shipped):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in shipped.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op12_speculative_bpe"](shipped, folder).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        digests = (hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digests)


def plain_divergence(rows, least):
    found = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+").findall
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    rows = [tuple(x or "" for x in r) for r in rows]
    documents, count, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate(fold) for t in found(text)]
        documents[lang].update(set(terms))
        count[lang, source].update(terms)
        whole[lang].update(terms)
    out = set()
    for lang, source in count:
        kept = [t for t, n in documents[lang].items() if n >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        mine, all_ = shares(count[lang, source]), shares(whole[lang])
        pairs = []
        for other_lang, other in count:
            if other_lang == lang and other != source:
                theirs = shares(count[lang, other])
                pairs.append((-sum(abs(mine[t] - theirs[t]) for t in kept), other.encode(), other))
        best = [(all_[t] - mine[t], t.encode(), t) for t in kept if count[lang, source][t] and mine[t] > all_[t]]
        for part, items, most in (("pair", pairs, None), ("term", best, 50)):
            out |= {(lang, source, part, item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(items)[:most])}
    return out


def divergence_rows():
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("alpha", "Beta", "été", "中", "x_y", "it's", "ß") for b in ("", "one", "TWO", "é", "𝒳")]
    rows = []
    for k in range(240):
        lang = rng.choice(["en", "en", "en", "de", None, ""])
        source = rng.choice(["a", "b", "c", None, "", "zz", "𝒳", "￿"])
        rows.append((lang, source, " ".join(rng.choices(vocabulary[: 10 + k % 25], k=rng.randint(0, 60)))))
    rows += [("fr", "solo", "rare words only"), ("fr", "void", None), ("it", "x", ""), ("en", "a", "alpha " * 60_000), ("en", "a", "é" * 50_000)]
    return rows + rows[:30]


@pytest.mark.parametrize("options", [{}, {"bits": 3, "block": 2, "entries": 40}])
def test_divergence_equals_plain_counts(shipped, options):
    schema = "lang string, source string, text string, term string, n int, split string, `a.b` int, rank int"
    df = shipped.createDataFrame([(*r, "t", 1, "s", 2, 3) for r in divergence_rows()], schema).repartition(6)
    got = divergence.source_divergence(df, least=12, **options).collect()
    want = plain_divergence(divergence_rows(), 12)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert {r.part for r in got} == {"pair", "term"} and any(r.value == 0 for r in got)


def test_divergence_of_odd_and_empty_tables(odd, empty):
    got = divergence.source_divergence(odd, least=2).collect()
    assert {tuple(r) for r in got} == plain_divergence([(r[2], r[3], r[1]) for r in ODD], 2)
    assert divergence.source_divergence(empty).collect() == []
