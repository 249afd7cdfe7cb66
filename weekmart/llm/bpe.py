"""Byte-pair encoding and decoding: a segment tree over the ranks of adjacent pairs gives each next merge.

The leaf of a position holds the rank of the pair that starts there, so the root holds the leftmost pair of lowest
rank. A merge changes at most three leaves and their paths. Many words are merged side by side: one row of the arrays
a word, one step of all unfinished words at a time, until no root holds a mergeable pair.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from weekmart.llm.text import code_points, column_udf, distinct_spans, pieces, prepare, same_spans, span_hashes, spread, utf8

NONE = np.int64(1) << np.int64(62)
LETTER, NUMBER, SPACE = 1, 2, 3
CACHED_WORDS = 600_000
SLOT_BITS = 21
_coders: dict[tuple[str, str], "PreTokenCoder"] = {}
ROW_CELLS = 1 << 19
LONG_WORD = 2048


class Definition(NamedTuple):
    """A tokenizer's JSON text and the classes of all code points, as runs; small, and the same for any input."""

    model: str
    run_starts: np.ndarray
    run_kinds: np.ndarray


@lru_cache(maxsize=4)
def read_tokenizer(path: str) -> Definition:
    """Read a byte-level tokenizer's JSON file on the driver; its path is the caller's parameter."""
    with open(path, encoding="utf-8") as file:
        model = file.read()
    kinds = character_kinds(tokenizers.Tokenizer.from_str(model).pre_tokenizer)
    starts = np.flatnonzero(np.append(True, kinds[1:] != kinds[:-1]))
    return Definition(model, starts, kinds[starts])


def character_kinds(pre_tokenizer: tokenizers.pre_tokenizers.PreTokenizer) -> np.ndarray:
    """Class of each code point in the pre-token pattern: letter, number, white space or other.

    Where two Unicode tables of different age agree on a code point, that holds; the others are put to the library,
    which joins a code point to a neighbour of its own class.
    """
    every = np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000])
    newer, older = np.zeros((2, 0x110000), np.uint8)
    joined = "".join(map(chr, every))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        newer[[ord(c) for c in regex.findall(pattern, joined)]] = kind
    by_category = {"L": LETTER, "N": NUMBER}
    older[every] = [by_category.get(unicodedata.category(c)[0], SPACE if c.isspace() else 0) for c in joined]
    disputed = np.flatnonzero(newer != older)
    kinds = newer.copy()
    kinds[disputed] = SPACE
    for kind, like in ((LETTER, "a"), (NUMBER, "1"), (0, "!")):
        pairs = "".join(f"{like}{chr(c)}\n" for c in disputed)
        starts = np.zeros(len(pairs) + 1, bool)
        starts[[span[0] for _, span in pre_tokenizer.pre_tokenize_str(pairs)]] = True
        kinds[disputed[~starts[1: len(pairs): 3]]] = kind
    return kinds


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Merges and token bytes of a byte-level BPE tokenizer."""

    def __init__(self, definition: Definition):
        model = json.loads(definition.model)
        bounds = np.append(definition.run_starts, 0x110000)
        self.kinds = np.repeat(definition.run_kinds, np.diff(bounds))
        ids = model["model"]["vocab"]
        letters = byte_letters()
        self.byte_ids = np.array([ids[c] for c in letters], np.int32)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
        keys = np.array([(ids[a] << 32) | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pairs, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        # whether every pair with a merged symbol ranks after all merges that make the symbol
        made = np.full(max(ids.values()) + 1, -1, np.int64)
        np.maximum.at(made, self.merged, np.arange(len(self.merged)))
        self.ordered = bool((np.maximum(made[self.pairs >> 32], made[self.pairs & 0xFFFFFFFF]) < self.ranks).all())
        self.special = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        values = {c: b for b, c in enumerate(letters)}
        tokens = {i: bytes(values[c] for c in t) for t, i in ids.items() if t not in self.special}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        size = max(tokens) + 1
        self.token_lengths = np.array([len(tokens.get(i, b"")) for i in range(size)], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair has no merge; symbol -1 is no symbol."""
        keys = (left.astype(np.int64) << np.int64(32)) | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_words(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one word after another, and the number of ids of each."""
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(lengths) - lengths
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        live = np.ones(len(symbols), bool)
        size = 2
        done = lengths <= 1
        for k in np.flatnonzero(lengths >= LONG_WORD) if self.ordered else ():
            part = symbols[starts[k]: starts[k] + lengths[k]]
            self._merge_long(part)
            live[starts[k]: starts[k] + lengths[k]] = part >= 0
            done[k] = True
        while not done.all():
            fits = np.flatnonzero(~done & (lengths <= size))
            for k in range(0, len(fits), max(1, ROW_CELLS // size)):
                rows = fits[k: k + max(1, ROW_CELLS // size)]
                cells, where = spread(starts[rows], lengths[rows]), spread(np.arange(len(rows)) * (size + 1), lengths[rows])
                grid = np.full(len(rows) * (size + 1), -1, np.int32)
                grid[where] = symbols[cells]
                self._merge_rows(grid, len(rows), size)
                symbols[cells] = grid[where]
                live[cells] = grid[where] >= 0
            done[fits] = True
            size *= 2
        counts = np.add.reduceat(live, starts[lengths > 0], dtype=np.int64) if len(symbols) else np.zeros(0, np.int64)
        per_word = np.zeros(len(words), np.int64)
        per_word[lengths > 0] = counts
        return symbols[live], per_word

    def _merge_rows(self, symbols: np.ndarray, rows: int, size: int) -> None:
        """Merge the words in ``rows`` rows of ``size`` symbols and one empty cell; absorbed cells become -1."""
        width = size + 1
        places = np.tile(np.arange(width, dtype=np.int64), rows)
        after, before = places + 1, places - 1
        grid = symbols.reshape(rows, width)
        ranks = self.pair_ranks(grid[:, :-1], grid[:, 1:])
        tree = np.full((rows, 2 * size), NONE)
        tree[:, size:] = np.where(ranks < NONE, (ranks << np.int64(32)) | np.arange(size), NONE)
        level = size
        while level > 1:
            tree[:, level // 2: level] = np.minimum(tree[:, level: 2 * level: 2], tree[:, level + 1: 2 * level: 2])
            level //= 2
        tree = tree.reshape(-1)

        def leaves(row, place, left, right):
            found = self.pair_ranks(left, right)
            tree[row * (2 * size) + size + place] = np.where(found < NONE, (found << np.int64(32)) | place, NONE)

        row = np.flatnonzero(tree[1:: 2 * size] < NONE)
        while len(row):
            cell = row * width
            root = tree[row * (2 * size) + 1]
            here = root & np.int64(0xFFFFFFFF)
            taken = after[cell + here]
            following = after[cell + taken]
            previous = before[cell + here]
            symbols[cell + here] = self.merged[root >> np.int64(32)]
            symbols[cell + taken] = -1
            after[cell + here] = following
            before[cell + following] = here
            tree[row * (2 * size) + size + taken] = NONE
            leaves(row, here, symbols[cell + here], symbols[cell + following])
            has = previous >= 0
            leaves(row[has], previous[has], symbols[(cell + previous)[has]], symbols[(cell + here)[has]])
            node = np.stack([here, taken, np.where(has, previous, here)]) + size
            base = (row * (2 * size))[None, :]
            while size > 1 and node[0, 0] > 1:
                node = node >> 1
                tree[base + node] = np.minimum(tree[base + 2 * node], tree[base + 2 * node + 1])
            row = row[tree[row * (2 * size) + 1] < NONE]

    def _merge_long(self, symbols: np.ndarray) -> None:
        """Merge one word in place; absorbed cells become -1.

        The leftmost pair of lowest rank comes with all others of its rank in one step, from left to right: where no pair
        that a merge makes ranks before it (``ordered``), single merges would take them one after another as well.
        """
        count = len(symbols)
        size = 1 << (count - 1).bit_length()
        after, before = np.arange(1, count + 2), np.arange(-1, count)
        padded = np.append(symbols, np.int32(-1))
        tree = np.full(2 * size, NONE)

        def leaves(places: np.ndarray) -> np.ndarray:
            found = self.pair_ranks(padded[places], padded[after[places]])
            return np.where(found < NONE, (found << np.int64(32)) | places, NONE)

        tree[size: size + count] = leaves(np.arange(count))
        level = size
        while level > 1:
            tree[level // 2: level] = np.minimum(tree[level: 2 * level: 2], tree[level + 1: 2 * level: 2])
            level //= 2
        while tree[1] < NONE:
            rank, nodes = tree[1] >> np.int64(32), np.ones(1, np.int64)
            while nodes[0] < size:  # down to all leaves of that rank
                nodes = (2 * nodes[:, None] + np.arange(2)).ravel()
                nodes = nodes[tree[nodes] >> np.int64(32) == rank]
            here = nodes - size
            taken = after[here]
            if len(here) > 1 and padded[here[0]] == padded[taken[0]]:  # in a chain of equal symbols every other pair
                order = np.arange(len(here))
                begins = np.append(True, taken[:-1] != here[1:])
                here = here[(order - np.maximum.accumulate(np.where(begins, order, 0))) % 2 == 0]
                taken = after[here]
            following = after[taken]
            padded[here], padded[taken] = self.merged[rank], -1
            after[here], before[following] = following, here
            previous = before[here]
            changed = np.unique(np.concatenate([here, previous[previous >= 0]]))
            tree[size + taken] = NONE
            tree[size + changed] = leaves(changed)
            nodes = np.unique(np.concatenate([changed, taken]) + size)
            while nodes[0] > 1:
                nodes = nodes >> 1
                nodes = nodes[np.append(True, nodes[1:] != nodes[:-1])]
                tree[nodes] = np.minimum(tree[2 * nodes], tree[2 * nodes + 1])
        symbols[:] = padded[:-1]


def pre_tokens(kinds: np.ndarray, points: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of texts: contractions, runs of letters, numbers or other signs with the
    space before them, and white space. Texts flagged in ``whole`` are one pre-token each."""
    count = len(points)
    if not count:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = kinds[points]
    begins = np.ones(count, bool)
    begins[1:] = kind[1:] != kind[:-1]
    text_start = np.zeros(count + 1, bool)
    text_start[offsets] = True
    begins |= text_start[:-1]
    joined = np.flatnonzero(begins & (kind != SPACE) & ~text_start[:-1])
    joined = joined[kind[joined - 1] == SPACE]
    begins[joined - 1] = True
    begins[joined[points[joined - 1] == 32]] = False

    quote = np.flatnonzero(begins & (points == 39))
    padded = np.append(points, [0, 0])
    limit = np.append(text_start, True)
    one = ~limit[quote + 1] & np.isin(padded[quote + 1], [ord(c) for c in "stmd"])
    second = np.where(limit[np.minimum(quote + 2, count + 1)], 0, padded[np.minimum(quote + 2, count + 1)])
    two = ~limit[quote + 1] & np.isin(padded[quote + 1] * 0x110000 + second.astype(np.int64), [
        ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])
    for found, length in ((quote[one], 2), (quote[two], 3)):
        begins[found + 1] = False
        if length == 3:
            begins[found + 2] = False
        ends = found + length
        begins[ends[ends < count]] = True
    for k in np.flatnonzero(whole):
        begins[offsets[k] + 1: offsets[k + 1]] = False
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], count)


class WordMemory:
    """Ids of words seen before, found by hash and confirmed by content; holds at most CACHED_WORDS words.

    An open-addressing table of numpy arrays, looked up for many words at a time.
    """

    def __init__(self):
        self.shift = np.uint64(64 - SLOT_BITS)
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.places = np.full(1 << SLOT_BITS, -1, np.int32)
        self.points = np.zeros(0, np.uint32)
        self.ids = np.zeros(0, np.int32)
        self.point_ends, self.id_ends = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def __len__(self) -> int:
        return len(self.id_ends) - 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 if it is not there."""
        found = np.full(len(hashes), -1, np.int64)
        left, slot = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(left):
            place = self.places[slot]
            hit = (place >= 0) & (self.keys[slot] == hashes[left])
            found[left[hit]] = place[hit]
            on = (place >= 0) & ~hit
            left, slot = left[on], (slot[on] + 1) & ((1 << SLOT_BITS) - 1)
        return found

    def add(self, hashes: np.ndarray, points: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Remember words of different hashes that are not there yet."""
        place = np.arange(len(self), len(self) + len(hashes), dtype=np.int32)
        left, slot = np.arange(len(hashes)), (hashes >> self.shift).astype(np.int64)
        while len(left):
            free = self.places[slot] < 0
            self.places[slot[free]] = place[left[free]]
            won = self.places[slot] == place[left]
            self.keys[slot[won]] = hashes[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & ((1 << SLOT_BITS) - 1)
        self.points, self.ids = np.concatenate([self.points, points]), np.concatenate([self.ids, ids])
        self.point_ends = np.append(self.point_ends, self.point_ends[-1] + np.cumsum(lengths))
        self.id_ends = np.append(self.id_ends, self.id_ends[-1] + np.cumsum(counts))


class PreTokenCoder:
    """Encodes texts by pre-token: each different pre-token is encoded once and remembered while there is room.

    ``encode_words`` returns the ids of a list of pre-tokens and the number of ids of each.
    """

    def __init__(self, vocabulary: Vocabulary, encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.vocabulary, self.encode_words = vocabulary, encode_words
        self.kinds, self.special = vocabulary.kinds, vocabulary.special
        self.marks = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")") if self.special else None
        self.memory = WordMemory()

    def _encode_new(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words; one that spells a special token is that token."""
        plain = [w for w in words if w not in self.special]
        ids, counts = self.encode_words(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        if len(plain) == len(words):
            return ids.astype(np.int32), counts
        parts = iter(np.split(ids, np.cumsum(counts)[:-1]) if plain else [])
        each = [np.array([self.special[w]]) if w in self.special else next(parts) for w in words]
        return np.concatenate(each).astype(np.int32), np.array([len(e) for e in each], np.int64)

    def _places(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Where the memory holds each of the given different words, CACHED_WORDS at most; unknown ones are encoded first."""
        if len(self.memory) + len(hashes) > CACHED_WORDS:
            self.memory = WordMemory()
        memory, lengths = self.memory, ends - starts
        places = memory.find(hashes)
        old = np.flatnonzero(places >= 0)
        at = memory.point_ends[places[old]]
        if (memory.point_ends[places[old] + 1] - at != lengths[old]).any() or not same_spans(
                points, starts[old], memory.points, at, lengths[old]):  # another word of that hash: start again
            memory = self.memory = WordMemory()
            places[:] = -1
        new = np.flatnonzero(places < 0)
        if len(new):
            ids, counts = self._encode_new([joined[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            places[new] = np.arange(len(memory), len(memory) + len(new))
            memory.add(hashes[new], points[spread(starts[new], lengths[new])], lengths[new], ids, counts)
        return places

    def _word_ids(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the given different words, and where those of each begin and how many they are.

        Up to CACHED_WORDS words they are the memory's own array; more words go through the memory in slices.
        """
        ids, counts = [], [np.zeros(0, np.int64)]
        for k in range(0, len(hashes), CACHED_WORDS):
            part = slice(k, k + CACHED_WORDS)
            places = self._places(joined, points, starts[part], ends[part], hashes[part])
            begin = self.memory.id_ends[places]
            count = self.memory.id_ends[places + 1] - begin
            if len(hashes) <= CACHED_WORDS:
                return self.memory.ids, begin, count
            ids.append(self.memory.ids[spread(begin, count)])
            counts.append(count)
        count = np.concatenate(counts)
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.cumsum(count) - count, count

    def _split(self, joined: str, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of the parts into which special tokens cut the texts, and which parts are special."""
        bounds, special = [0], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for part in self.marks.split(joined[a:b]):
                if part:
                    bounds.append(bounds[-1] + len(part))
                    special.append(part in self.special)
        return np.array(bounds, np.int64), np.array(special, bool)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after another, and the number of ids of each."""
        joined, points, ends_at = code_points(data, offsets)
        parts, whole = ends_at, np.zeros(0, bool)
        if self.marks and self.marks.search(joined):
            parts, whole = self._split(joined, ends_at)
        starts, ends = pre_tokens(self.kinds, points, parts, whole)
        hashes = span_hashes(points, starts, ends)
        first, inverse = distinct_spans(points, starts, ends, hashes)
        ids, begins, counts = self._word_ids(joined, points, starts[first], ends[first], hashes[first])
        begins, lengths = begins[inverse], counts[inverse]
        before = np.append(0, np.cumsum(lengths))
        return ids[spread(begins, lengths)], np.diff(before[np.searchsorted(starts, ends_at)])


def kept_coder(definition: Definition, kind: str, build: Callable[[Vocabulary], PreTokenCoder]) -> PreTokenCoder:
    """The coder of this process: a task that runs where another has run finds the words that it encoded."""
    key = (kind, definition.model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = build(Vocabulary(definition))
    return _coders[key]


def merging_coder(vocabulary: Vocabulary) -> PreTokenCoder:
    return PreTokenCoder(vocabulary, lambda words: vocabulary.merge_words([w.encode() for w in words]))


def _encoding(coder: PreTokenCoder) -> Callable[[pa.Array], pa.Array]:
    """The ids of a batch of texts."""
    def apply(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column)
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for a, b in pieces(offsets):
            got, each = coder.encode(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a])
            ids.append(got)
            counts.append(each)
        ends = np.append(0, np.cumsum(np.concatenate(counts))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
    return apply


def _decoding(vocabulary: Vocabulary) -> Callable[[pa.ListArray], pa.Array]:
    """The texts of a batch of ids."""
    def apply(column: pa.ListArray) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        counts = np.diff(column.offsets.to_numpy()).astype(np.int64)
        counts[np.asarray(column.is_null())] = 0
        ids = column.flatten().to_numpy(zero_copy_only=False)
        bounds = np.append(0, np.cumsum(counts))
        texts = []
        for a, b in pieces(bounds, 1 << 18):
            part = ids[bounds[a]: bounds[b]]
            lengths = vocabulary.token_lengths[part]
            joined = vocabulary.token_bytes[spread(vocabulary.token_starts[part], lengths)].tobytes()
            ends = np.append(0, np.cumsum(lengths))[bounds[a: b + 1] - bounds[a]].tolist()
            texts += [joined[i:j].decode("utf-8", "replace") for i, j in zip(ends[:-1], ends[1:])]
        return pa.array(texts, pa.string())
    return apply


def _opened_encoder(definition):
    return lambda: _encoding(kept_coder(definition.value, "merges", merging_coder))


def _opened_decoder(definition):
    return lambda: _decoding(Vocabulary(definition.value))


def _opened_both(definition):
    def opened():
        coder = kept_coder(definition.value, "merges", merging_coder)
        encoding, decoding = _encoding(coder), _decoding(coder.vocabulary)

        def apply(column: pa.Array) -> pa.Array:
            ids = encoding(column)
            return pa.StructArray.from_arrays([ids, decoding(ids)], ["ids", "decoded"])
        return apply
    return opened


def encode(docs: DataFrame, definition: Definition, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column of the token ids of the whole text.

    Equal to the tokenizer's own encoding without added special tokens: text that spells a special token becomes
    its id. A null or empty text has an empty array. A column that is already named ``ids`` is replaced; rows,
    repeated ones too, stay as they are.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    return docs.withColumn(ids, column_udf("array<int>", _opened_encoder(shared))(docs[text]))


def decode(docs: DataFrame, definition: Definition, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids; bytes that are no UTF-8 become U+FFFD, null or empty arrays the empty text."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    return docs.withColumn(text, column_udf("string", _opened_decoder(shared))(docs[ids]))


def encode_and_decode(docs: DataFrame, definition: Definition, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker a task instead of two, with one vocabulary: for executors short of memory."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    both = "_".join(["both", *docs.columns])  # longer than any column, so no column of the documents
    coded = docs.withColumn(both, column_udf("struct<ids: array<int>, decoded: string>", _opened_both(shared))(docs[text]))
    return coded.withColumns({ids: coded[both]["ids"], decoded: coded[both]["decoded"]}).drop(both)
