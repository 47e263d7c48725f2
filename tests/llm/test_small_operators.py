"""Chat formatting, fingerprints, mixing, tokens, packing, token files, exact dedup against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, exact_dedup, mixing, packing, repair, syncmers
from strata.llm.tokens import Encoder, vocabulary_path

from .conftest import ODD

TEXTS = [
    "", " ", "a  b", "\n\nx", "it's  a\tb \n c", "x ", " x", "é́ ñ z", "</s> <|endoftext|> hi\nthere", "a\n b", "a \nb", "\nx\ny",
    "x², y½. Z. ß ÿ Ÿ ŉ Ⱥ İ ΑΣ. ΑΣ", "don't, can't.", "foo., bar.", "a_b. c1.", "́a b", "a. ́b", "中文 字. x", " a b",
    "\x85a\x1cb c\x1d", "😀 😀, 😀.", " | a | b", "foo&&& bar***,", "plain words only",
]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", "kept"), ("word_bpe_49k.json", "dropped")])
def test_encoder_equals_the_library(name, spaces):
    encoder = Encoder(vocabulary_path(name), spaces, limit=20)
    for _ in range(2):  # the second time from memory, and past the limit
        ids, n = encoder.encode(TEXTS, -1)
        want = [[*w, -1] for w in encoder.whole(TEXTS)]
        assert ids.tolist() == [i for w in want for i in w]
        assert n.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", "kept"), ("word_bpe_49k.json", "dropped")])
def test_special_tokens_are_those_of_the_untouched_library(name, spaces):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path(name))
    texts = [*TEXTS, "hello <|endoftext|> world", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>\nc", "<|endoftext|", " <|startoftext|>"]
    encoder = Encoder(vocabulary_path(name), spaces)
    for end in (7, None):
        ids, n = encoder.encode(texts, end)
        want = [[*e.ids, *([] if end is None else [end])] for e in library.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for w in want for i in w] and n.tolist() == [len(w) for w in want]


def test_chat_layouts_become_the_same_turns(shipped):
    messages = shipped.createDataFrame(
        [(1, [("system", "s"), ("human", "q"), ("gpt", None)], "noise")], "id long, messages array<struct<role:string,content:string>>, turn string"
    )
    prompts = shipped.createDataFrame([(2, "q", "a"), (3, "only", None)], "id long, prompt string, completion string")
    tasks = shipped.createDataFrame([(4, "do", "this", "done"), (5, "do", None, "done")], "id long, instruction string, input string, output string")
    unknown = shipped.createDataFrame([(6, "x")], "id long, body string")

    def turns(df):
        got = chat.canonical_turns(df, "id").orderBy("conv_id", "part").collect()
        return [(r.conv_id, r.role, r.text, r.layout) for r in got]

    assert turns(messages) == [(1, "system", "s", "messages"), (1, "user", "q", "messages"), (1, "assistant", "", "messages")]
    p = "prompt and completion"
    assert turns(prompts) == [(2, "user", "q", p), (2, "assistant", "a", p), (3, "user", "only", p)]
    i = "instruction"
    assert turns(tasks) == [(4, "user", "do", i), (4, "user", "this", i), (4, "assistant", "done", i), (5, "user", "do", i), (5, "assistant", "done", i)]
    assert turns(unknown) == [(6, None, None, None)]


def test_chat_round_trip(shipped):
    bad = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[OUT]\\</s>", None, "", "[ROLE 3]abc", "<s>\n[/SYS]", "[ROLE ", "x" * 100_000]
    rows = [(1, k, role, t) for k, (role, t) in enumerate((r, t) for r in ("user", "assistant", "system", "tool", "[OUT]", None, "\\") for t in bad)]
    rows += [(2, None, "user", "a"), (2, None, "user", "a"), (None, 1, "assistant", "b")]
    df = shipped.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_turns(chat.canonical_turns(df, "conv_id"))
    got = {r.conv_id: r for r in chat.conversation_digests(pieces).collect()}
    assert set(got) == {1, 2, None}
    said = "".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in rows[: len(rows) - 3])
    loss = "".join(t or "" for _, _, role, t in rows if role == "assistant" and t != "b")
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[2].n_turns == 2
    assert chat.conversation_digests(chat.format_turns(chat.canonical_turns(df.limit(0), "conv_id"))).count() == 0
    # No control string inside a piece but its own.
    for r in pieces.collect():
        marks = re.findall(r"(?<!\\)(?:\\\\)*(</?s>|\[/?(?:INST|SYS|OUT|ROLE)[\] ])", r.piece)
        assert len(marks) <= 3, r.piece


def test_syncmers_are_context_free_and_neighbours_follow(shipped, odd, empty):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    h, p = syncmers.anchors(text)
    inner, q = syncmers.anchors("zz" + text[1000:2000] + "zz")
    mine = {(int(x), int(y)) for x, y in zip(h, p)}
    theirs = {(int(x), int(y) - 2 + 1000) for x, y in zip(inner, q)}
    assert len(theirs & mine) > 0.9 * len(theirs)
    got = Counter(tuple(r) for r in syncmers.fingerprint_neighbours(odd).select("doc_id", "n_chars", "edited_sha256").collect())
    rows = sorted(((r[0], r[1] or "") for r in ODD), key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in r[1]]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        want[(i, len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest())] += 1
    assert got == want
    same = syncmers.fingerprint_neighbours(odd).where("doc_id = 6").collect()
    assert len(same) == 2 and max(r.near_next for r in same) == 1.0 and len({r.fingerprint for r in same}) == 1
    assert syncmers.fingerprint_neighbours(empty).count() == 0


def test_likeness_takes_all_anchors():
    """Against the sets of all anchors of two long texts that share one passage of 2 %."""
    rng = random.Random(8)
    a, b = ("".join(rng.choice("abcdefgh ") for _ in range(30_000)) for _ in range(2))
    b = b[:20_000] + a[5000:5600] + b[20_000:]
    x, y = set(syncmers.anchors(a)[0].tolist()), set(syncmers.anchors(b)[0].tolist())
    got = syncmers.likeness(syncmers.sketch(a), syncmers.sketch(b))
    assert len(x & y) > 50 and abs(got - 2 * len(x & y) / (len(x) + len(y))) < 1e-9
    assert len(syncmers.decode(syncmers.encode(syncmers.sketch(a)))[0]) == syncmers.KEPT


def test_likeness_across_the_short_border(shipped):
    """A near copy on the other side of the border, and an edited text that falls below it."""
    rng = random.Random(9)
    text = "".join(rng.choice("abcdefgh ") for _ in range(130))
    df = shipped.createDataFrame([(9, text[:118]), (8, text[:122]), (7, text), (6, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in syncmers.fingerprint_neighbours(df).collect()}
    assert got[9].near_next > 0.9 and got[8].near_next > 0.9
    assert got[7].n_chars == 130 and got[7].near_edited > 0.7 and got[7].near_next == 0


def test_mix_cuts_at_the_budget(shipped, odd, empty):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 30))), rng.choice("aaaabcd")) for i in range(400)]
    df = shipped.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(df).collect()
    total = sum(len(t.split()) for _, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        assert r["__size"] == len(r.text.split()) and r["__taken"] <= 3 * r["__size"]
        by[r.source].append(r)
    assert abs(sum(v[0]["__target"] for v in by.values()) - total) < 1e-6
    for v in by.values():
        assert sum(r["__taken"] for r in v) == int(v[0]["__target"])
    words = sum(len(r.text.split()) for r in mixing.mixed_rows(df).collect())
    assert words == sum(r["__taken"] for r in got)
    assert mixing.mix(odd).count() == len(ODD) and mixing.mixed_rows(odd).columns == odd.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0


def test_subset_sum_is_exact():
    rng = random.Random(7)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        capacity = rng.randint(1, 120)
        best = 0
        for mask in range(1 << len(lengths)):
            s = sum(n for k, n in enumerate(lengths) if mask >> k & 1)
            best = max(best, s if s <= capacity else 0)
        counts = sorted(Counter(lengths).items(), reverse=True)
        taken = packing.closest_subset(counts, capacity)
        assert sum(n * c for n, c in taken.items()) == best and all(c <= Counter(lengths)[n] for n, c in taken.items())


def test_packing_holds_every_id_once(shipped, odd, empty):
    path = vocabulary_path("word_bpe_49k.json")
    rows = packing.pack(odd, path, window=256, pool=4).collect()
    encoder = Encoder(path, "dropped")
    want = Counter((r[0], tuple([*encoder.whole([r[1] or ""])[0], 1])) for r in ODD)
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, ids))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 256 or at & (at - 1) == 0
    for (doc, n), parts in pieces.items():
        whole = [w for (d, w), c in want.items() if d == doc for _ in range(c)]
        assert sorted(i for _, ids in parts for i in ids) == sorted(i for w in whole for i in w)
        if len(whole) == 1:
            assert [i for _, ids in sorted(parts) for i in ids] == list(whole[0])
    assert packing.pack(empty, path).count() == 0


def test_token_files_round_trip(shipped, odd, empty, monkeypatch):
    path = vocabulary_path("byte_bpe_50k.json")
    got = sorted((tuple(r) for r in repair.token_files(odd, path).collect()), key=lambda r: r[1])
    encoder, at, want = Encoder(path, "kept"), 0, []
    for i, t in sorted(((r[0], r[1] or "") for r in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*encoder.whole([t])[0], 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert repair.token_files(empty, path).count() == 0


def test_shards_are_cut_inside_a_batch(monkeypatch):
    """Many short documents of one batch: every shard but the last is full, and its last document fills it."""
    from types import SimpleNamespace

    import pyarrow as pa
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 3))
    monkeypatch.setattr(repair, "SHARD", 50)
    path = vocabulary_path("byte_bpe_50k.json")
    texts = [("plain words, été. " * (k % 5)).strip() for k in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})
    shards = [s.to_pylist()[0] for s in repair._write_shards(path, 0)(iter([batch]))]
    assert [i for s in shards for i in s["doc_ids"]] == list(range(60)) and len(shards) > 5
    assert [s["shard"] for s in shards] == list(range(len(shards)))
    for s in shards[:-1]:
        assert s["n_tokens"] >= 50 > s["n_tokens"] - s["doc_tokens"][-1]
    want = [[*ids, 0] for ids in Encoder(path, "kept").whole(texts)]
    read = [tuple(r.values()) for b in repair._read(iter([pa.RecordBatch.from_pylist([s]) for s in shards])) for r in b.to_pylist()]
    assert [(r[2], r[4], r[5]) for r in read] == [(k, len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for k, w in enumerate(want)]


def test_words_merged_together_are_those_merged_alone():
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"), "kept")
    pieces = [" plain", " words", "words", " été", "É", "...", " ,;", " ofththndti", " x"] * 30
    assert encoder._merged_pieces(pieces) == [encoder._merged(p) for p in pieces] and encoder._merged_pieces([]) == []
    assert encoder._apart not in {i for p in pieces for i in encoder._merged(p)}


def test_repair_decodes_any_range():
    rng = np.random.default_rng(1)
    for tokens in ([], [5], [5] * 1000, [5, 5, 5] * 300, [1, 2] * 500, (rng.zipf(1.3, 60_000) % 50_000).tolist()):
        tokens = np.array(tokens, dtype=np.uint32)
        rules, lengths, sequence = repair.compress(tokens)
        assert (repair.expand(sequence, rules) == tokens).all() and len(sequence) <= len(tokens)
        for _ in range(30):
            a, b = sorted(rng.integers(0, len(tokens) + 1, 2).tolist())
            assert (repair.decode_range(rules, lengths, sequence, a, b) == tokens[a:b]).all()


def test_repair_goes_on_until_no_pair_is_frequent():
    """Half a million repetitive tokens: a few symbols and long rules remain, and no frequent pair."""
    tokens = np.tile(np.random.default_rng(3).integers(0, 50_000, 500), 1000).astype(np.uint32)
    rules, lengths, sequence = repair.compress(tokens)
    assert len(sequence) < 300 and lengths.max() > 50_000
    assert (repair.expand(sequence, rules, lengths=lengths) == tokens).all()
    rng = np.random.default_rng(4)
    text = np.concatenate([rng.zipf(1.2, 200_000) % 50_000, tokens[:5000], rng.integers(0, 3, 3000)]).astype(np.uint32)
    rules, lengths, sequence = repair.compress(text)
    pairs, counts = np.unique(sequence[:-1].astype(np.uint64) << np.uint64(32) | sequence[1:], return_counts=True)
    assert counts.max() < repair.LEAST
    assert repair.symbol_lengths(sequence, lengths).sum() == len(text) and (repair.expand(sequence, rules) == text).all()
    each = [repair.expand(np.array([repair.BASE + k]), rules) for k in range(0, len(rules), 97)]
    assert [len(e) for e in each] == lengths[::97].tolist()


def test_cuckoo_filter_inserts_deletes_and_resizes():
    rng = random.Random(9)
    keys = [rng.getrandbits(64) for _ in range(5000)]
    filt = exact_dedup.CuckooFilter(8000)
    assert all(filt.insert(k) for k in keys) and all(k in filt for k in keys)
    for k in keys[:2500]:
        assert filt.delete(k)
    assert all(k in filt for k in keys[2500:])
    assert sum(k in filt for k in keys[:2500]) < 25
    index = exact_dedup.LiveIndex(16)
    names = [hashlib.sha256(str(i).encode()).digest() for i in range(4000)]
    for i, d in enumerate(names * 2):
        index.add(d, i)
    assert index.resized > 0 and len(index.rows) == 4000 and all(v[1] == 2 for v in index.rows.values())
    for d in names[:1000]:
        assert index.remove(d, 2) and not index.remove(d)
    assert len(index.rows) == 3000


def test_exact_duplicates(odd, empty):
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(odd).collect())
    assert got == Counter(exact_dedup.brute_force([(r[0], r[1]) for r in ODD]))
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 6, 7, 8, 9, 10]
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_exact_duplicates(empty).count() == 0


def test_index_maintenance(shipped):
    def rows(*pairs):
        return shipped.createDataFrame([(d.encode(), i) for d, i in pairs], "digest binary, doc_id long")

    live = exact_dedup.live_index(rows(("a", 1), ("a", 2), ("b", 3)).withColumn("n", F.lit(1)))
    after = exact_dedup.maintain(live, rows(("b", 9), ("c", 4)), rows(("a", 1), ("a", 2), ("b", 3)))
    assert sorted((bytes(r.digest).decode(), r.keep_id, r.group_size) for r in after.collect()) == [("b", 9, 1), ("c", 4, 1)]


def test_cuckoo_index_tells_equal_marks_apart():
    """Digests of one mark and one pair of buckets are verified entry by entry, also after deletions."""
    index = exact_dedup.LiveIndex(16)
    same = [b"\x01\x02" + b"\0" * 6 + bytes([i]) * 24 for i in range(6)]
    for i, d in enumerate(same):
        index.add(d, i)
    assert index.resized == 0 and len(index) == 6
    assert index.remove(same[2]) and not index.remove(same[2])
    index.add(same[2], 9, row=4)
    index.add(same[2], 9, row=3)
    index.add(same[2], None)
    assert {d: v for d, v in index.rows.items()} == {d: ((9, 3) if d == same[2] else (i, 1)) for i, d in enumerate(same)}
    digests, groups = index.take()
    assert groups[digests.index(same[2])] == [9, 3, 2, 3] and len(index) == 0


CLASHES = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, _source string, _range string, __size string, __digest string, score string, id string, `row` struct<x:int>"


@pytest.fixture(scope="module")
def clashing(shipped):
    rows = [(*r, f"extra{i}", "s", "r", "z", "d", "q", "i", (i,)) for i, r in enumerate(ODD)]
    rows.append((*ODD[5], "another", "s", "r", "z", "d", "q", "i", (0,)))
    return shipped.createDataFrame(rows, CLASHES)


def test_survivors_do_not_depend_on_the_order_of_rows(clashing):
    """Three rows share id and text and differ elsewhere: the first by JSON text stays, in any order of the input."""
    from strata.llm import ngram_join

    for drop in (exact_dedup.drop_exact_duplicates, ngram_join.drop_near_duplicates):
        one = sorted(map(repr, drop(clashing.coalesce(1)).collect()))
        other = sorted(map(repr, drop(clashing.orderBy(F.desc("`a.b`")).repartition(5)).collect()))
        assert one == other
    kept = [r for r in exact_dedup.drop_exact_duplicates(clashing).collect() if r.doc_id == 6]
    assert [r["a.b"] for r in kept] == ["another"]


def test_stages_take_any_column_names_and_odd_rows(clashing, odd, tmp_path):
    import corpus_pipeline

    spark = clashing.sparkSession
    spark.createDataFrame([(1, 1, 0), (3, 0, 0), (7, 0, 0), (8, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (clashing, odd, clashing.limit(0)):
        empty = docs.isEmpty()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            rows = out.collect()
            assert (not rows) == empty or name == "quality classifier"
            if name != "packing":
                assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
                known = {r.doc_id for r in docs.collect()}
                assert {r.doc_id for r in rows} <= known
