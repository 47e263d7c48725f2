"""Byte-level BPE by speculation: greedy tokens, checked pair by pair.

New words of a batch of texts are walked through the vocabulary's trie all at
once, which proposes the longest token at every position.  A proposal is the
merges' own result exactly when no merge would ever cross the border between
two of its neighbouring tokens, and that depends on the two tokens alone: the
check looks at all distinct pairs of the batch as arrays.  Only words with a
failing pair are merged step by step.

Whether a merge crosses: a token is the end of a chain of pieces, each born by
a merge and alive until the next one.  The last pieces of the left token and the
first pieces of the right one are followed backwards in time; a merge of two
pieces that are alive at that merge's turn crosses.  Of merges of one rule the
leftmost goes first, so the left piece must outlive the rule, the right one only reach it.

Nothing is shuffled.  A Python worker keeps its tables and the ids of words it
has seen (a bounded number) for all its tasks.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_chunks
from strata.llm.tokens import _PLAIN, _SEPARATORS, _SYMBOLS, Encoder

_BYTES = {c: b for b, c in _SYMBOLS.items()}
_NEVER_INT = 1 << 40
_NEVER = np.int64(_NEVER_INT)


def _read(path: str) -> tuple[dict, dict[str, int], list[bytes]]:
    """(file, vocabulary, bytes of each id)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocabulary = spec["model"]["vocab"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    tokens = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
    for token, i in vocabulary.items():
        tokens[i] = bytes(_BYTES[c] for c in token)
    for token, i in special.items():
        tokens[i] = token.encode()
    return spec, vocabulary, tokens


class Decoder:
    """The bytes that ids stand for."""

    def __init__(self, path: str):
        tokens = _read(path)[2]
        self._length = np.array([len(t) for t in tokens], dtype=np.int64)
        self._start = np.cumsum(self._length) - self._length
        self._flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self._length[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._start[ids] - (ends - lengths), lengths) + np.arange(total)].tobytes()


class Merges:
    """Vocabulary and merges of a byte-level tokenizer file as arrays."""

    def __init__(self, path: str):
        spec, vocabulary, self.tokens = _read(path)
        size = len(self.tokens)
        self._single = {self.tokens[i][0]: i for i in vocabulary.values() if len(self.tokens[i]) == 1}
        self._of_byte = np.array([self._single[b] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocabulary[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], dtype=np.int64)
        self.rank_of = {(a, b): r for r, (a, b) in enumerate(zip(left.tolist(), right.tolist()))}
        self.made, self._made = made.tolist(), made
        key = (left << 32) | right
        order = np.argsort(key)
        self._keys, self._ranks = key[order], order.astype(np.int64)
        # A token's last merge: the rule that the merges themselves use on its bytes.
        self._born = np.full(size, -1, dtype=np.int64)
        self._left = np.full(size, -1, dtype=np.int64)
        self._right = np.full(size, -1, dtype=np.int64)
        single = np.array([len(t) == 1 for t in self.tokens])
        reached = single.copy()
        for r, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), self.made)):
            if not reached[c] and reached[a] and reached[b]:
                reached[c], self._born[c], self._left[c], self._right[c] = True, r, a, b
        wrong = self.crossed(self._left, self._right, before=self._born)
        for c in np.argsort(self._born, kind="stable").tolist():
            if self._born[c] >= 0 and (wrong[c] or not reached[self._left[c]] or not reached[self._right[c]]):
                reached[c] = False
        #: Ids that a text's merges can end in; a token with several rules that fails by its first is left to the merging.
        self.reached = reached
        self._build_trie(i for i in vocabulary.values() if reached[i])

    def _build_trie(self, ids) -> None:
        """Edges (node * 256 + byte) in order, the nodes they lead to, and the token that ends at each node."""
        edges, token, path, last = [], [-1], [0], b""
        for word, i in sorted((self.tokens[i], i) for i in ids):
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            del path[common + 1 :]
            for b in word[common:]:
                edges.append((path[-1] << 8) | b)
                path.append(len(token))
                token.append(-1)
            token[path[-1]] = i
            last = word
        edge = np.array(edges, dtype=np.int64)
        order = np.argsort(edge)
        self._edge, self._after = edge[order], order + 1
        self._token = np.array(token, dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, ``_NEVER`` where there is none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], _NEVER)

    def crossed(self, left: np.ndarray, right: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether the merges of two neighbouring tokens' bytes would cross the border between them.

        With ``before``, only merges of a lower rank count (and negative ids give False).
        """
        u, v = left.astype(np.int64), right.astype(np.int64)
        out = np.zeros(len(u), dtype=bool)
        until_u = np.full(len(u), _NEVER) if before is None else before.astype(np.int64)
        until_v = until_u.copy() if before is None else until_u - 1
        row = np.flatnonzero((u >= 0) & (v >= 0))
        u, v, until_u, until_v = u[row], v[row], until_u[row], until_v[row]
        while len(row):
            rank = self._rank(u, v)
            alive = np.maximum(self._born[u], self._born[v])
            bad = (rank < until_u) & (rank <= until_v) & (rank > alive)
            out[row[bad]] = True
            # Back in time: the piece born last is taken apart.
            go = ~bad & (alive >= 0)
            row, u, v, until_u, until_v = row[go], u[go], v[go], until_u[go], until_v[go]
            first = self._born[u] >= self._born[v]
            until_u = np.where(first, self._born[u], until_u)
            until_v = np.where(first, until_v, self._born[v])
            u, v = np.where(first, self._right[u], u), np.where(first, v, self._left[v])
        return out

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest tokens of all words: (ids one after another, number of ids of each word)."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        end = np.cumsum(lengths)
        word = np.flatnonzero(lengths)
        at = (end - lengths)[word]
        stop = end[word]
        node = np.zeros(len(word), dtype=np.int64)
        best, best_at = np.zeros(len(word), dtype=np.int64), at.copy()
        owners, ids = [], []
        while len(word) > 32:
            key = node * 256 + flat[np.minimum(at, len(flat) - 1)]
            edge = np.minimum(np.searchsorted(self._edge, key), len(self._edge) - 1)
            moved = (self._edge[edge] == key) & (at < stop)
            node = np.where(moved, self._after[edge], 0)
            at = at + moved
            token = self._token[node]
            longer = moved & (token >= 0)
            best, best_at = np.where(longer, token, best), np.where(longer, at, best_at)
            stuck = ~moved
            if stuck.any():
                owners.append(word[stuck])
                ids.append(best[stuck])
                at = np.where(stuck, best_at, at)
                left = ~(stuck & (at >= stop))
                word, at, stop, node, best, best_at = word[left], at[left], stop[left], node[left], best[left], best_at[left]
        # The few longest words, one at a time.
        edges, after, tokens = self._edge, self._after, self._token
        for w, a, n, b, ba, e in zip(word.tolist(), at.tolist(), node.tolist(), best.tolist(), best_at.tolist(), stop.tolist()):
            mine = []
            while True:
                if a < e:
                    key = n * 256 + int(flat[a])
                    edge = int(edges.searchsorted(key))
                    if edge < len(edges) and edges[edge] == key:
                        n, a = int(after[edge]), a + 1
                        if tokens[n] >= 0:
                            b, ba = int(tokens[n]), a
                        continue
                mine.append(b)
                a, n = ba, 0
                if a >= e:
                    break
            owners.append(np.full(len(mine), w))
            ids.append(np.array(mine, dtype=np.int64))
        if not owners:
            return np.zeros(0, dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        owner, got = np.concatenate(owners), np.concatenate(ids)
        order = np.argsort(owner, kind="stable")
        return got[order], np.bincount(owner, minlength=len(words))

    def failing(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether a word's proposal has a pair of neighbours that a merge would cross."""
        owner = np.repeat(np.arange(len(counts)), counts)
        inside = np.flatnonzero(owner[:-1] == owner[1:]) if len(owner) else np.zeros(0, dtype=np.int64)
        pairs, which = np.unique((ids[inside] << 32) | ids[inside + 1], return_inverse=True)
        bad = self.crossed(pairs >> 32, pairs & 0xFFFFFFFF)
        out = np.zeros(len(counts), dtype=bool)
        out[owner[inside[bad[which]]]] = True
        return out

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word by its merges, in the order of ranks and from the left."""
        single = self._single
        ids = [single[b] for b in word]
        n, rank_of = len(ids), self.rank_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (q := rank_of.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (q, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (q := rank_of.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (q, h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many words: a round does the next merge of every word that has one."""
        out: list[list[int]] = [[]] * len(words)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        for i in np.flatnonzero(lengths > 64).tolist():
            out[i] = self.merge(words[i])
        short = np.flatnonzero((lengths > 0) & (lengths <= 64))
        ids = self._of_byte[np.frombuffer(b"".join(words[i] for i in short.tolist()), dtype=np.uint8)]
        word = np.repeat(short, lengths[short])
        rank = np.full(len(ids), _NEVER)  # of the pair that starts at each place
        if len(ids) > 1:
            rank[:-1] = np.where(word[1:] == word[:-1], self._rank(ids[:-1], ids[1:]), _NEVER)
        done_ids, done_words = [], []
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            width = np.diff(np.concatenate([start, [len(word)]]))
            least = np.repeat(np.minimum.reduceat(rank, start), width)
            open_ = least < _NEVER
            done_ids.append(ids[~open_])
            done_words.append(word[~open_])
            ids, word, rank, least = ids[open_], word[open_], rank[open_], least[open_]
            at = np.flatnonzero(rank == least)
            if not len(at):
                break
            # The leftmost one of each word.
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            ids[at] = self._made[rank[at]]
            keep = np.ones(len(ids), dtype=bool)
            keep[at + 1] = False
            ids, word, rank = ids[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            for left in (at, at[(at > 0) & (word[at - 1] == word[at])] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                joined = (left + 1 < len(ids)) & (word[right] == word[left])
                rank[left] = np.where(joined, self._rank(ids[left], ids[right]), _NEVER)
        if done_ids:
            flat, owner = np.concatenate(done_ids), np.concatenate(done_words)
            order = np.argsort(owner, kind="stable")
            flat, counts = flat[order].tolist(), np.bincount(owner, minlength=len(words))
            ends = np.cumsum(counts)
            for i in short.tolist():
                out[i] = flat[ends[i] - counts[i] : ends[i]]
        return out

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """The ids of distinct words, and how many of the proposals failed."""
        ids, counts = self.propose(words)
        failing = self.failing(ids, counts)
        ends = np.cumsum(counts).tolist()
        flat = ids.tolist()
        out = [flat[a:b] for a, b in zip([0, *ends], ends)]
        wrong = np.flatnonzero(failing).tolist()
        for i, merged in zip(wrong, self.merge_all([words[i] for i in wrong])):
            out[i] = merged
        return out, len(wrong)


class SpeculativeEncoder(Encoder):
    """Ids of texts by ``Merges``; the library only cuts unusual texts into words."""

    def __init__(self, path: str, limit: int = 400_000):
        self.merges = Merges(path)
        self.proposed = self.failed = 0
        super().__init__(path, "kept", limit)

    def _cut(self, text: str) -> list[bytes]:
        """The words of a text without special tokens, as the tokenizer's own split gives them."""
        if not text:
            return []
        return [bytes(_BYTES[c] for c in word) for word, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _encode_words(self, texts: list[list[bytes]]) -> list[list[int]]:
        distinct = list({w: None for words in texts for w in words})
        ids, failed = self.merges.encode_words(distinct)
        self.proposed += len(distinct)
        self.failed += failed
        known = dict(zip(distinct, ids))
        return [[i for w in words for i in known[w]] for words in texts]

    def whole(self, texts: list[str]) -> list[list[int]]:
        segments, owner = [], []
        for k, text in enumerate(texts):
            for part in self.special_split(text):
                segments.append(part)
                owner.append(k)
        cut = [[] if isinstance(s, int) else self._cut(s) for s in segments]
        out: list[list[int]] = [[] for _ in texts]
        for k, s, ids in zip(owner, segments, self._encode_words(cut)):
            out[k] += [s] if isinstance(s, int) else ids
        return out

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """As the words come: the tables leave no memory for a batch's words as Arrow arrays."""
        out = []
        for text in texts:
            words = ("\n\n" + text.replace("\n", " \n")).split(" ")
            out.append(np.fromiter(map(self._seen.__getitem__, words), dtype=np.int64, count=len(words)))
        return out

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """As ``Encoder.encode``, text by text."""
        if len(self._seen) > self._limit:
            self._forget()
        known = len(self._seen)
        special = self._special.search if self._special else lambda text: None
        whole = {i for i, text in enumerate(texts) if special(text)}
        none = np.zeros(0, dtype=np.int64)
        index = [none if i in whole else self._numbers([text])[0] for i, text in enumerate(texts)]
        self._learn(known)
        for word in index:
            self._count[word] += 1
        out, counts = [], np.zeros(len(texts), dtype=np.int64)
        for i, word in enumerate(index):
            lengths = self._length[word]
            if i in whole or len(lengths) and lengths.min() < 0:
                ids = np.array(self.whole([texts[i]])[0], dtype=np.int32)
            else:
                ends = np.cumsum(lengths)
                total = int(ends[-1]) if len(ends) else 0
                ids = self._ids[np.arange(total) + np.repeat(self._start[word] - (ends - lengths), lengths)]
            out.append(ids)
            counts[i] = len(ids)
            if end is not None:
                out.append(np.array([end], dtype=np.int32))
                counts[i] += 1
        return (np.concatenate(out) if out else np.zeros(0, dtype=np.int32)), counts

    def _of_words(self, words: list[str], known: int) -> list[list[int] | None]:
        cut: list[list[bytes]] = []
        lead: list[bool | None] = []
        for key in words:
            w = key if key[:1] == "\n" else " " + key
            first, broken = w[:2] == "\n\n", w[:2] != "\n\n" and w[:1] == "\n"
            w = w[2:] if first else w[1:] if broken else w
            m = _PLAIN.fullmatch(w)
            bare = w.removeprefix(" ")
            if m:
                pieces = [p.encode() for p in m.groups() if p]
            elif not w and first:  # an empty text
                pieces = []
            elif not bare or bare != bare.strip() or any(c in bare for c in _SEPARATORS):
                cut.append([])
                lead.append(None)
                continue
            else:
                pieces = self._cut(w)
            cut.append(pieces)
            lead.append(broken)
        ids = self._encode_words(cut)
        return [None if b is None else [self._line_break, *i] if b else i for b, i in zip(lead, ids)]


_ENCODERS: dict[str, SpeculativeEncoder] = {}


def encoder(path: str) -> SpeculativeEncoder:
    """The worker's encoder of a vocabulary; later tasks of the worker use it again."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SpeculativeEncoder(path)
    return _ENCODERS[path]


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    """The worker's table of a vocabulary's bytes."""
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def _text_of(table: Decoder, ids: bytes | None) -> str:
    return table.decode(np.frombuffer(ids or b"", dtype="<u4").astype(np.int64)).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """All columns but ``text``, and ``ids``: the ids of the whole text as little-endian unsigned 32-bit integers.

    With ``decoded`` a column of that name holds the text that ``decode`` gives for the ids, from the same task.

    Equal to the tokenizers library's ``encode(text, add_special_tokens=False)``:
    special tokens' strings in a text are special tokens.  Null and empty texts
    have no ids; repeated rows are rows of their own; an empty table gives an
    empty result; a text of any length is encoded whole.  A column that has the
    name of ``ids`` already is replaced.
    """
    keep = [f for f in docs.schema.fields if f.name not in (text, ids, decoded)]
    hidden = [f"c{i}" for i in range(len(keep))]
    plain = docs.select(*[F.col(f"`{f.name.replace('`', '``')}`").alias(h) for f, h in zip(keep, hidden)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = encoder(path), decoder(path) if decoded else None
        for batch in text_chunks(batches, target=1_000_000):
            flat, counts = enc.encode(batch.column("text").to_pylist())
            ends = np.cumsum(counts).tolist()
            data = memoryview(flat.astype("<u4").tobytes())
            packed = pa.array([data[4 * (e - n) : 4 * e] for e, n in zip(ends, counts.tolist())], pa.binary())
            columns = [*(batch.column(h) for h in hidden), packed]
            if decoded:
                columns.append(pa.array([_text_of(table, x) for x in packed.to_pylist()], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*hidden, "ids", *(["decoded"] if decoded else [])]
    schema = ", ".join([*(f"{h} {f.dataType.simpleString()}" for f, h in zip(keep, hidden)), "ids binary", *(["decoded string"] if decoded else [])])
    out = plain.mapInArrow(run, schema)
    more = [F.col("ids").alias(ids), *([F.col("decoded").alias(decoded)] if decoded else [])]
    return out.select(*[F.col(h).alias(f.name) for f, h in zip(keep, hidden)], *more)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns, and ``text``: the ids' bytes as UTF-8, special tokens as their strings, broken characters as U+FFFD.

    Null ids give an empty text; a column that has the name of ``text`` already is replaced.
    """
    keep = [f for f in encoded.schema.fields if f.name != text]
    hidden = [f"c{i}" for i in range(len(keep))]
    at = hidden[[f.name for f in keep].index(ids)]
    plain = encoded.select(*[F.col(f"`{f.name.replace('`', '``')}`").alias(h) for f, h in zip(keep, hidden)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoder(path)
        for batch in text_chunks(batches, at):
            texts = [_text_of(table, x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*hidden, "text"])

    schema = ", ".join([*(f"{h} {f.dataType.simpleString()}" for f, h in zip(keep, hidden)), "text string"])
    out = plain.mapInArrow(run, schema)
    return out.select(*[F.col(h).alias(f.name) for f, h in zip(keep, hidden)], F.col("text").alias(text))
