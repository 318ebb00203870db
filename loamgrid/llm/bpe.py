"""Byte-pair encoding and decoding with a given word-end vocabulary, by a prefix-sharing trie.

The distinct words of a batch form a trie: in sorted order a word leaves its predecessor's path where their common
prefix ends. Every node keeps one number, the last token of the encoding of the path so far; a path that several words
share is worked out once. The last token of a
longer path is the only token that ends there and may follow the last token of the path before it: two tokens may stand
side by side if no merge of lower rank than those that built them would have joined across their border.
A word's tokens are read back from its end through the last tokens of its prefixes.
The trie is walked level by level, all nodes of a level in one numpy step; words over WIDE bytes, which would be levels
of few nodes, are walked depth first one after the other.

`Codec.encode` gives the ids that the vocabulary's own library gives without added special tokens, `Codec.decode` the
token strings joined by one space, as that library does where the vocabulary names no decoder.

Edge cases: null counts as empty and has no ids; special strings inside a text are their single ids; repeated texts have
equal results; a text of any length is encoded whole; other columns than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import map_batches, small_batches

#: Entries of a worker's cache of encoded words; it starts anew when full and is given up when a task ends. Results don't depend on it.
CACHE = 400_000
#: Words of more bytes are walked by themselves.
WIDE = 64
#: Bytes of text in one step: levels of a larger trie cost less a word.
STEP = 1 << 20
#: Pairs of tokens whose fit a worker remembers, a power of two; 9 bytes each, kept from task to task.
PAIRS = 1 << 20
#: Before a token's number, written in letters, in place of a word. It is no character, so the library splits the texts that have it.
MARK = "\uffff"
_digits = {48 + d: 97 + d for d in range(10)}
_letters = {97 + d: 48 + d for d in range(10)}
SPACE, OTHER, LETTER, NUMBER = range(4)


def _classes() -> np.ndarray:
    """The class of every character by this Python's tables: white space that ends words, letters, numbers, others."""
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, number in (("L", LETTER), ("N", NUMBER)):
        out[[c for c in range(0x110000) if unicodedata.category(chr(c))[0] == kind]] = number
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    out[ord(MARK)] = LETTER
    return out


_class = _classes()


def pieces(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a normalised text, and where in them its words start and end: 's|'t|'re|'ve|'m|'ll|'d|[letters]+|[number]|[others]+."""
    data = np.frombuffer(text.encode(), np.uint8)
    ascii_only = text.isascii()
    codes = data if ascii_only else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = _class[codes]
    new = np.ones(len(codes) + 1, bool)
    new[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    quotes = np.flatnonzero((codes == 39) & new[:-1])
    if len(quotes):
        after = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = after[quotes + 1], after[quotes + 2]
        short = np.isin(one, [ord(x) for x in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        new[quotes[short | long] + 1] = False
        new[quotes[short] + 2] = True
        new[quotes[long] + 3] = True
    at = np.flatnonzero(new)
    words = kind[at[:-1]] != SPACE
    if not ascii_only:
        at = np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]])[at]
    return data, at[:-1][words], at[1:][words]


def byte_letters() -> list[str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself, or the next free letter from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Growing:
    """An array that rows are appended to."""

    def __init__(self, kind: type, *shape: int):
        self.data, self.size = np.zeros((1024, *shape), kind), 0

    def append(self, rows: np.ndarray) -> None:
        if self.size + len(rows) > len(self.data):
            more = np.zeros((max(2 * len(self.data), self.size + len(rows)), *self.data.shape[1:]), self.data.dtype)
            more[: self.size] = self.data[: self.size]
            self.data = more
        self.data[self.size : self.size + len(rows)] = rows
        self.size += len(rows)


    def taken(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The rows of several ranges, one after the other."""
        ends = np.cumsum(size)
        return self.data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + size, size)]


class Numbers:
    """An exact table from numbers below 2**63 to numbers from 0 on, read for whole arrays; what it lacks is -1. A key stands at or soon after the place of its hash."""

    def __init__(self, pairs: dict[int, int]):
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        self.shift = np.uint64(64 - max(4, (2 * len(pairs)).bit_length()))
        self.keys = np.full((1 << 64 - int(self.shift)) + len(pairs) + 1, -1, np.int64)
        self.values = np.full(len(self.keys), -1, np.int32)
        at, left = self._place(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            self.keys[at[free[first]]], self.values[at[free[first]]] = keys[free[first]], values[free[first]]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] += 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        at = self._place(keys)
        found = self.keys[at]
        out = self.values[at]
        left = np.flatnonzero(found != keys)
        while len(left):
            out[left] = -1
            left = left[self.keys[at[left]] >= 0]
            at[left] += 1
            same = self.keys[at[left]] == keys[left]
            out[left[same]] = self.values[at[left[same]]]
            left = left[~same]
        return out


class Codec:
    """One vocabulary: merges by rank, tokens by their bytes, a cache of encoded pieces."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.end = model["end_of_word_suffix"] or ""
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        self.pair: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            made = self.vocab[left + right]
            self.pair[self.vocab[left], self.vocab[right]] = rank
            if made not in self.rank:
                self.rank[made], self.parts[made] = rank, (self.vocab[left], self.vocab[right])
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token, i in self.vocab.items():
            if i in self.parts and not self._own(i):
                continue
            if self.end and token.endswith(self.end) and token != self.end:
                self.final[token[: -len(self.end)]] = i
            else:
                self.inner[token] = i
        self.library = Tokenizer.from_str(text)
        self.assigned: set[str] = set()
        self.longest = max(map(len, chain(self.inner, self.final)))
        self.size = {i: len(x) for x, i in chain(self.inner.items(), self.final.items())}
        self._tables()
        self.fit_of, self.fit_is = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        self.forget()
        names = [""] * (max(self.names) + 1)
        for i, token in self.names.items():
            names[i] = token
        self.name_array, self.digit_array = pa.array(names, pa.string()), pa.array([str(i) for i in range(len(names))], pa.string())

    def forget(self) -> None:
        """Empties the caches that grow."""
        self.fits: dict[int, bool] = {}
        self._anew()
        pa.default_memory_pool().release_unused()

    def _anew(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.pool, self.spans = Growing(np.int32), Growing(np.int64, 2)

    def _tables(self) -> None:
        """The merges and the tokens, read from their ends, as tables for whole arrays."""
        n = max(self.names) + 1
        self.joins = Numbers({a << 32 | b: rank for (a, b), rank in self.pair.items()})
        self.ranks, self.halves, self.sizes = np.full(n, -1, np.int64), np.zeros((2, n), np.int64), np.zeros(n, np.int64)
        for i, rank in self.rank.items():
            self.ranks[i], self.halves[:, i] = rank, self.parts[i]
        for i, size in self.size.items():
            self.sizes[i] = size
        byte_of = {x: b for b, x in self.letters.items()}
        steps: dict[int, int] = {}
        ends: list[tuple[list[int], list[int]]] = []
        for tokens in (self.inner, self.final):
            states, ids = [], []
            for token, i in tokens.items():
                if token and all(x in byte_of for x in token):
                    state = 0
                    for x in reversed(token):
                        state = steps.setdefault(state << 8 | byte_of[x], len(steps) + 1)
                    states.append(state)
                    ids.append(i)
            ends.append((states, ids))
        self.steps = Numbers(steps)
        self.ending = np.full((2, len(steps) + 1), -1, np.int32)
        for row, (states, ids) in zip(self.ending, ends, strict=True):
            row[states] = ids
        if not self.end:
            self.ending[1] = self.ending[0]

    def _own(self, token: int) -> bool:
        left, right = self.parts[token]
        return self.pair.get((left, right)) == self.rank[token] and all(x not in self.parts or self._own(x) for x in (left, right)) and self._side(left, right, self.rank[token])

    def _side(self, a: int, b: int, limit: float = float("inf")) -> bool:
        """No merge below `limit` joins across the border of a and b while both are being built."""
        while True:
            if self.pair.get((a, b), limit) < limit:
                return False
            ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
            if ra < 0 and rb < 0:
                return True
            # undo the later of the two merges; before it, a merge across the border had to come first to win:
            # an equal or lower rank further left goes first, so a border merge needs a rank below the left one's
            if ra > rb:
                limit, a = ra, self.parts[a][1]
            else:
                limit, b = rb + 1, self.parts[b][0]

    def walk(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct words (in byte letters): the depth-first walk of their trie.

        last[i] is the last token of path[:i]. Exactly one token ends at i and may follow what stands before it, so
        the shortest is tried first; `fits` remembers which pairs may stand side by side.
        """
        out: dict[str, tuple[int, ...]] = {}
        inner, final, longest, fits, side, size = self.inner.get, self.final.get, self.longest, self.fits, self._side, self.size
        if len(fits) > 200_000:
            fits.clear()
        known = fits.get
        last: list[int] = [-1]
        before = ""
        for word in sorted(words):
            shared, n = 0, len(word)
            stop = min(n - 1, len(before), len(last) - 1)
            while shared < stop and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :]
            for i in range(shared + 1, n + 1):
                find = final if i == n and self.end else inner
                for start in range(i - 1, max(-1, i - 1 - longest), -1):
                    token = find(word[start:i])
                    if token is None:
                        continue
                    if start == 0:
                        break
                    key = last[start] << 32 | token
                    fit = known(key)
                    if fit is None:
                        fit = fits[key] = side(last[start], token)
                    if fit:
                        break
                else:
                    raise ValueError(f"the vocabulary lacks a byte of {word!r}")
                if i < n or not self.end:
                    last.append(token)
            before = word
            tokens, at = [token], n - size[token]
            while at > 0:
                token = last[at]
                tokens.append(token)
                at -= size[token]
            tokens.reverse()
            out[word] = tuple(tokens)
        return out

    def _sides(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`_side` for whole arrays."""
        out, left = np.ones(len(a), bool), np.arange(len(a))
        most = 1 << 40
        limit = np.full(len(a), most, np.int64)
        while len(left):
            joined = self.joins[a << 32 | b]
            across = (joined >= 0) & (joined < limit)
            out[left[across]] = False
            ra, rb = self.ranks[a], self.ranks[b]
            on = np.flatnonzero(~across & ((ra >= 0) | (rb >= 0)))
            left, a, b, ra, rb = left[on], a[on], b[on], ra[on], rb[on]
            undo = ra > rb
            limit = np.where(undo, ra, rb + 1)
            a, b = np.where(undo, self.halves[1][a], a), np.where(undo, b, self.halves[0][b])
        return out

    def _fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs may stand side by side; of pairs that share a place in the memory the last one asked for is remembered."""
        key = a << 32 | b
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).view(np.int64) & (PAIRS - 1)
        out = self.fit_is[at]
        new = np.flatnonzero(self.fit_of[at] != key)
        if len(new):
            asked, own = np.unique(key[new], return_inverse=True)
            made = self._sides(asked >> 32, asked & 0xFFFFFFFF)
            out[new] = made[own]
            _, first = np.unique(at[new], return_index=True)
            first = new[first]
            self.fit_of[at[first]], self.fit_is[at[first]] = key[first], out[first]
        return out

    def _ends(self, letters: np.ndarray, last: np.ndarray, rows: np.ndarray, stops: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """The token that ends at `stops` of each row, the shortest first; exactly one may follow what stands before it."""
        out = np.full(len(rows), -1, np.int64)
        left, state = np.arange(len(rows)), np.zeros(len(rows), np.int64)
        base, width = rows * letters.shape[1], letters.ravel()
        before = last.ravel()
        for length in range(1, self.longest + 1):
            at = base[left] + stops[left] - length
            state = self.steps[state << 8 | width[at]].astype(np.int64)
            token = tokens[state].astype(np.int64)
            token[state < 0] = -1
            start = stops[left] - length
            done = (token >= 0) & (start == 0)
            ask = np.flatnonzero((token >= 0) & (start > 0))
            done[ask] = self._fit(before[at[ask]].astype(np.int64), token[ask])
            out[left[done]] = token[done]
            on = np.flatnonzero(~done & (state >= 0) & (start > 0))
            if not len(on):
                break
            left, state = left[on], state[on]
        if (out < 0).any():
            row = rows[out < 0][0]
            raise ValueError(f"the vocabulary lacks a byte of {letters[row].tobytes()!r}")
        return out

    def walk_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The encodings of distinct words in their order, one after the other, and the n+1 offsets of the words in them: the trie level by level.

        last[w, i] is the last token of the first i bytes of word w, the same number for all words of a node. Words are ascending.
        """
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        wide = int(size.max())
        letters = np.zeros((n, wide), np.uint8)
        letters[np.arange(wide) < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        shared = np.zeros(n, np.int64)  # with the word before; a shorter one ends in a zero, which no word has
        if n > 1:
            shared[1:] = np.argmin(letters[1:] == letters[:-1], axis=1)
        previous = np.concatenate([[0], size[:-1]])
        last = np.full((n, wide), -1, np.int32)
        rows = np.arange(n)
        for i in range(1, wide):
            rows = rows[size[rows] > i]
            first = (shared[rows] < i) | (previous[rows] <= i)
            own = rows[first]
            last[rows, i] = self._ends(letters, last, own, np.full(len(own), i), self.ending[0])[np.cumsum(first) - 1]
        token = self._ends(letters, last, np.arange(n), size, self.ending[1])
        at, rows, found = size.copy(), np.arange(n), []
        count = np.zeros(n, np.int64)
        while len(rows):
            found.append((rows, token))
            count[rows] += 1
            at[rows] -= self.sizes[token]
            rows = rows[at[rows] > 0]
            token = last[rows, at[rows]].astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(count)])
        ids = np.zeros(int(offsets[-1]), np.int32)
        for back, (rows, token) in enumerate(found, 1):
            ids[offsets[rows + 1] - back] = token
        return ids, offsets

    def _clean(self, text: str) -> str | None:
        """Normalised text: composed, lower-cased letter by letter.

        None if a character is newer than this Python's tables: the library must split that text.
        """
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            fresh = set(text) - self.assigned
            if fresh:
                if any(unicodedata.category(x) == "Cn" for x in fresh):
                    return None
                self.assigned |= fresh
        return text.lower()

    def _words(self, text: str) -> str:
        """The text's words; tokens that no word makes stand as MARK and their number in letters."""
        marked = lambda ids: " ".join([MARK + str(i).translate(_digits) for i in ids])
        segments = self.special_at.split(text) if self.special_at and any(x in text for x in self.special) else [text]
        parts = []
        for k, segment in enumerate(segments):
            own = marked([self.special[segment]]) if k % 2 else self._clean(segment)
            parts.append(marked(self._newer(segment)) if own is None else own)
        return " ".join(parts)

    def _newer(self, text: str) -> tuple[int, ...]:
        own = [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        known = self.walk(list(set(own)))
        return tuple(chain.from_iterable([known[x] for x in own]))

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts one after the other, and the n+1 offsets of the texts in them."""
        made = [self._words(x) for x in texts]
        data, starts, ends = pieces(" ".join(made))
        stops = np.cumsum(np.fromiter((len(x) if x.isascii() else len(x.encode()) for x in made), np.int64, len(made)) + 1)
        bounds = np.concatenate([[0], np.searchsorted(starts, stops)])
        size = ends - starts
        used = np.zeros(len(data) + 1, np.int8)
        used[starts] = 1
        used[ends] -= 1
        packed = data[np.cumsum(used[:-1], dtype=np.int8).astype(bool)]
        words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)])), pa.py_buffer(packed)]).dictionary_encode()
        ends, own = np.frombuffer(words.dictionary.buffers()[1], np.int64, len(words.dictionary) + 1).tolist(), (words.dictionary.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        distinct = [own[a:b] for a, b in zip(ends, ends[1:])]  # noqa: B905
        need = [x for x in distinct if x not in self.cache]
        if len(self.cache) + len(need) > CACHE:
            self._anew()
            need = distinct
        if need:
            self._learn(need)
        spans = self.spans.data[np.fromiter(map(self.cache.__getitem__, distinct), np.int64, len(distinct))][words.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(spans[:, 1])])
        return self.pool.taken(spans[:, 0], spans[:, 1]), total[bounds]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of every text."""
        ids, offsets = self.encode_flat(texts)
        return [x.tolist() for x in np.split(ids, offsets[1:-1])] if texts else []

    def _learn(self, need: list[bytes]) -> None:
        """Encode words that aren't known yet: those of no great length by the trie of all, others one by one."""
        mark = MARK.encode()
        plain = sorted([x for x in need if len(x) <= WIDE and b"\0" not in x and x[:3] != mark])
        if plain:
            self._keep(plain, *self.walk_all(plain))
        if len(plain) < len(need):
            odd = [x for x in need if x not in self.cache]
            coded = {x: "".join([self.letters[b] for b in x]) for x in odd if x[:3] != mark}
            walked = self.walk(list(coded.values()))
            ids = [walked[coded[x]] if x in coded else (int(x[3:].decode().translate(_letters)),) for x in odd]
            self._keep(odd, np.fromiter(chain.from_iterable(ids), np.int32), np.concatenate([[0], np.cumsum([len(x) for x in ids])]))

    def _keep(self, words: list[bytes], ids: np.ndarray, offsets: np.ndarray) -> None:
        first = self.spans.size
        self.cache.update(zip(words, range(first, first + len(words)), strict=True))
        self.spans.append(np.column_stack([self.pool.size + offsets[:-1], np.diff(offsets)]))
        self.pool.append(ids)

    def digests(self, ids: np.ndarray, offsets: np.ndarray, names: pa.Array) -> pa.Array:
        """For every text the digest of the names of its ids, joined by one space."""
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), names.take(pa.array(ids)))
        joined = pc.binary_join(lists, " ").cast(pa.large_binary())
        ends, data = np.frombuffer(joined.buffers()[1], np.int64).tolist(), memoryview(joined.buffers()[2] or b"")
        return pa.array([hashlib.sha256(data[ends[i] : ends[i + 1]]).hexdigest() for i in range(len(joined))], pa.string())

    def decode(self, ids: list[int]) -> str:
        """The token strings of ids, joined by one space."""
        return " ".join(map(self.names.__getitem__, ids))


_codecs: dict[int, Codec] = {}


def codec(text: str) -> Codec:
    """This worker's codec of a vocabulary text."""
    key = hash(text)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(text)
    return _codecs[key]


def vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's text (under two MB), broadcast."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and token_ids (array<int>) of every text."""
    small_batches(docs.sparkSession)
    vocab = vocabulary(docs.sparkSession, path)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = codec(vocab.value).encode_flat([x or "" for x in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))], ["doc_id", "token_ids"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), step, "doc_id long, token_ids array<int>", done=lambda: codec(vocab.value).forget(), limit=STEP)


def digest(docs: DataFrame, path: str, keep: list[str] | None = None, ids_too: bool = False) -> DataFrame:
    """n_tokens and digests of the ids and of what they decode to; columns named by `keep` come along, and token_ids if asked for."""
    small_batches(docs.sparkSession)
    vocab = vocabulary(docs.sparkSession, path)
    names = ["doc_id", *(keep or [])]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema} | {"doc_id": "long"}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(vocab.value)
        ids, offsets = own.encode_flat([x or "" for x in batch.column("text").to_pylist()])
        digests = [own.digests(ids, offsets, names_) for names_ in (own.digit_array, own.name_array)]
        made = [pa.array(np.diff(offsets).astype(np.int64)), *digests]
        if ids_too:
            made.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)))
        return pa.RecordBatch.from_arrays([*[batch.column(x) for x in names], *made], [*names, "n_tokens", "ids_sha256", "decoded_sha256", *["token_ids"] * ids_too])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(keep or []), "text")
    return map_batches(rows, step, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids_too, done=lambda: codec(vocab.value).forget(), limit=STEP)
