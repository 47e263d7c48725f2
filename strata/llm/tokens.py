"""Token ids of whole texts with a public tokenizer, computed once per distinct word.

Both tokenizers cut a text at white space before any merge, so the ids of a
text are those of its words one after another.  A task keeps the ids of the
words it has seen (``limit`` of them about; then the rare ones go) and encodes
only new ones with the tokenizers library.  Texts with white space whose cut depends on its
neighbours are encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import cached_property
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Seen(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


#: Letters that need no normalising but lower case, then ASCII marks: two pieces at most for either tokenizer.
_PLAIN = re.compile(r"( ?[a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)|( ?[!-/:-@\[-`{-~]+)")
#: What both splits of Python and the tokenizers may see differently.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def _byte_symbols() -> dict[int, str]:
    """Byte -> printable character, by the rule of byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SYMBOLS = _byte_symbols()


class Encoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    ``spaces``: "kept" for byte-level vocabularies (a word owns the blank
    before it, a line break is a piece), "dropped" for those that ignore white
    space.
    """

    def __init__(self, path: str, spaces: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenize = self._tokenizer.model.tokenize
        self._specials = {t.content: i for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        by_length = sorted(self._specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self._kept, self._limit = spaces == "kept", limit
        self._line_break = self.whole(["\n"])[0][0] if self._kept else 0
        self._clear()

    def _clear(self) -> None:
        self._seen = _Seen()
        self._ids = np.zeros(1 << 16, dtype=np.int32)
        self._used = 0
        self._start = np.zeros(1 << 16, dtype=np.int64)
        self._length = np.zeros(1 << 16, dtype=np.int64)  # -1: the word's cut depends on its neighbours
        self._count = np.zeros(1 << 16, dtype=np.int32)  # texts with the word
        self._marks: dict[str, list[int]] = {}

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch(texts, add_special_tokens=False)]

    def special_split(self, text: str) -> list[str | int]:
        """A text cut at the strings of special tokens, which become their ids."""
        if self._special is None:
            return [text]
        return [self._specials[s] if k % 2 else s for k, s in enumerate(self._special.split(text))]

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's keys, new ones included.

        Keys are words; with spaces kept, "\\n\\n" marks the first word and "\\n" those after a line break.
        """
        seen = self._seen
        if not self._kept:
            look = seen.__getitem__
            each = ([text] if any(c in text for c in _SEPARATORS) else text.split() for text in texts)
            return [np.fromiter(map(look, words), dtype=np.int64, count=len(words)) for words in each]
        lines = ["\n\n" + text.replace("\n", " \n") for text in texts]
        words = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        # Distinct words first: most words of a batch repeat.
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(seen.get, distinct, repeat(-1)), dtype=np.int64, count=len(distinct))
        new, known = np.flatnonzero(numbers < 0), len(seen)
        numbers[new] = known + np.arange(len(new))
        seen.update(zip(map(distinct.__getitem__, new.tolist()), range(known, known + len(new))))
        flat = numbers[coded.indices.to_numpy()]
        ends = np.cumsum(pc.list_value_length(words).to_numpy()).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def _merged(self, piece: str) -> list[int]:
        """Ids of a piece that no rule divides further."""
        if piece.isascii():
            piece = "Ġ" + piece[1:] if piece[0] == " " else piece
        else:
            piece = piece.encode().decode("latin-1").translate(_SYMBOLS)
        return [t.id for t in self._tokenize(piece)]

    @cached_property
    def _apart(self) -> int | None:
        """The id of byte 0, if no merge holds it: words with it between them can be merged as one string."""
        zero = _SYMBOLS[0]
        alone = self._kept and [t for t in self._tokenizer.get_vocab() if zero in t] == [zero]
        return self._tokenizer.token_to_id(zero) if alone else None

    def _merged_pieces(self, pieces: list[str], together: int = 50) -> list[list[int]]:
        """Ids of pieces as ``_merged`` gives them."""
        if self._apart is None:
            return [self._merged(piece) for piece in pieces]
        ids: list[int] = []
        for a in range(0, len(pieces), together):
            text = "\0".join(pieces[a : a + together]) + "\0"
            if text.isascii():
                text = text.replace(" ", "Ġ").replace("\0", _SYMBOLS[0])
            else:
                text = text.encode().decode("latin-1").translate(_SYMBOLS)
            ids += [t.id for t in self._tokenize(text)]
        ends = np.flatnonzero(np.array(ids, dtype=np.int32) == self._apart).tolist()
        return [ids[a + 1 : b] for a, b in zip([-1, *ends], ends)]

    def _of_words(self, words: list[str], known: int) -> list[list[int] | None]:
        """Ids of single keys; None where they depend on the neighbours.  The first ``known`` keys have theirs."""
        kept, plain, seen, marks = self._kept, _PLAIN.fullmatch, self._seen, self._marks
        out: list = [None] * len(words)
        simple = [(i, " " + key) for i, key in enumerate(words) if kept and key.isascii() and key.isalpha()]
        # Pieces of letters; None: to be merged.
        new: dict[str, list[int] | None] = dict.fromkeys([letters for _, letters in simple])
        marked, other, texts = [], [], []
        for i, key in enumerate(words):
            if kept and key.isascii() and key.isalpha():  # most words
                continue
            w, lead = key, []
            if kept:
                if key[:1] != "\n":
                    w = " " + key
                elif key[:2] == "\n\n":
                    w = key[2:]
                    if not w:  # an empty text
                        out[i] = []
                        continue
                else:
                    lead, w = [self._line_break], key[1:]
            m = plain(w)
            if m:
                letters, tail, only = m.groups()
                letters = letters or only
                if not kept:
                    letters = letters.lower()
                if letters not in new:
                    # The word without its marks may be known.
                    at = seen.get(letters[1:] if kept else letters, known) if tail and (not kept or letters[0] == " ") else known
                    new[letters] = self._ids[self._start[at] : self._start[at] + self._length[at]].tolist() if at < known else None
                marked.append((i, lead, letters, tail))
                continue
            if kept:
                bare = w.removeprefix(" ")
                if not bare or bare != bare.strip() or any(c in bare for c in _SEPARATORS):
                    continue
            other.append((i, lead))
            texts.append(w)
        pieces = [letters for letters, ids in new.items() if ids is None]
        new.update(zip(pieces, self._merged_pieces(pieces)))
        for i, letters in simple:
            out[i] = new[letters]
        for i, lead, letters, tail in marked:
            if tail and tail not in marks:
                if len(marks) > 10_000:
                    marks.clear()
                marks[tail] = self._merged(tail)
            ids = new[letters] + marks[tail] if tail else new[letters]
            out[i] = lead + ids if lead else ids
        for (i, lead), ids in zip(other, self.whole(texts)):
            out[i] = lead + ids
        return out

    def _forget(self) -> None:
        """Keeps the words seen three times or more since the last time."""
        n = len(self._seen)
        keep = np.flatnonzero(self._count[:n] >= 3)
        words = list(self._seen)
        start, length, ids = self._start[keep], self._length[keep], self._ids
        self._clear()
        for i in keep.tolist():
            self._seen[words[i]]
        real = np.maximum(length, 0)
        flat = ids[np.repeat(start - (np.cumsum(real) - real), real) + np.arange(int(real.sum()))]
        self._grow(len(keep), len(flat))
        self._ids[: len(flat)] = flat
        self._used = len(flat)
        self._start[: len(keep)], self._length[: len(keep)] = np.cumsum(real) - real, length

    def _grow(self, words: int, ids: int) -> None:
        while len(self._start) < words:
            self._start, self._length, self._count = (np.concatenate([x, np.zeros_like(x)]) for x in (self._start, self._length, self._count))
        while len(self._ids) < ids:
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])

    def _learn(self, known: int) -> None:
        n = len(self._seen)
        words = list(islice(self._seen, known, None))
        self._grow(n, 0)
        for a in range(0, len(words), 20_000):
            self._used += self._place(known + a, self._of_words(words[a : a + 20_000], known + a))

    def _place(self, at: int, ids: list[list[int] | None]) -> int:
        """Writes the ids of the words numbered from ``at`` behind those in use; how many there are."""
        lengths = np.fromiter((-1 if x is None else len(x) for x in ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(x for x in ids if x), dtype=np.int32)
        self._grow(at + len(ids), self._used + len(flat))
        self._ids[self._used : self._used + len(flat)] = flat
        self._length[at : at + len(ids)] = lengths
        real = np.maximum(lengths, 0)
        self._start[at : at + len(ids)] = self._used + np.cumsum(real) - real
        return len(flat)

    def encode(self, texts: list[str], end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``end`` if given, and the number of ids of each text."""
        if len(self._seen) > self._limit:
            self._forget()
        known = len(self._seen)
        special = self._special.search if self._special else lambda text: None
        whole = {i for i, text in enumerate(texts) if special(text)}
        index = [np.zeros(0, dtype=np.int64)] * len(texts)
        cut = [i for i in range(len(texts)) if i not in whole]
        for i, numbers in zip(cut, self._numbers([texts[i] for i in cut])):
            index[i] = numbers
        self._learn(known)
        for word in index:
            self._count[word] += 1
        if not texts:
            return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        last = np.cumsum([len(word) for word in index])
        neighbours = np.flatnonzero(self._length[np.concatenate(index)] < 0)
        whole |= set(np.searchsorted(last, neighbours, side="right").tolist())
        # Texts encoded whole and the end stand for one more word each, until the next words are learned.
        extra = [[] if end is None else [end], *(ids for i in whole for ids in self.whole([texts[i]]))]
        at = len(self._seen)
        self._place(at, extra)
        for number, i in enumerate(whole, at + 1):
            index[i] = np.array([number])
        if end is not None:
            index = [x for word in index for x in (word, np.array([at]))]
            last = np.cumsum([len(word) for word in index])[1::2]
        else:
            last = np.cumsum([len(word) for word in index])
        words = np.concatenate(index)
        lengths = self._length[words]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(int(ends[-1]), dtype=np.int32)
        for a in range(0, len(words), 1 << 16):
            b = min(len(words), a + (1 << 16))
            at = np.repeat(self._start[words[a:b]] - ends[a:b], lengths[a:b])
            ids[ends[a] : ends[b]] = self._ids[np.arange(ends[a], ends[b]) + at]
        return ids, np.diff(ends[np.concatenate([[0], last])])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder_of(path: str, spaces: str) -> Encoder:
    """The worker's encoder of a vocabulary; later tasks of the worker use it and its words again."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]
