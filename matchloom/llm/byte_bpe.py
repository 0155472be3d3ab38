"""Byte-level BPE: pre-tokens found by a scan over character classes, merged by rank, and decoded by offsets."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import pieces_of, text_or_empty

# The classes of the pre-token pattern 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
# letters and numbers of Unicode 16, by which the tokenizer's library goes, that Python 3.13 does not know
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: character classes; those from SHORT on depend on what follows
LETTER, NUMBER, OTHER, SPACE = range(4)
#: an apostrophe before a contraction of one or two letters; a blank, or other white space, before something visible; the start of a text
SHORT, LONG, LEAD, GAP, RESET = range(4, 9)
#: where the reader stands: inside a run of a class, after a blank that belongs to what follows, inside a contraction that ends
#: with the next or the second next letter, or where a token starts whatever comes
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, AFTER_BLANK, ONE_MORE, TWO_MORE, FRESH = range(8)
BLOCK = 64
#: bytes of text that a task reads at once, one text at least
BATCH_BYTES = 400_000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The state after a character of a class in a state, and whether a token starts at it."""
    after, starts = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for kind, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS), (SPACE, IN_SPACE)):
        after[kind] = run
        starts[kind, run] = False
    for kind in (LETTER, NUMBER, OTHER):
        starts[kind, AFTER_BLANK] = False
    after[LETTER, TWO_MORE], after[LETTER, ONE_MORE] = ONE_MORE, FRESH
    starts[LETTER, [TWO_MORE, ONE_MORE]] = False
    for kind, state in ((SHORT, ONE_MORE), (LONG, TWO_MORE)):
        after[kind] = state
        # inside a run of others, or after its blank, an apostrophe is one of them
        after[kind, [IN_OTHERS, AFTER_BLANK]] = IN_OTHERS
        starts[kind, [IN_OTHERS, AFTER_BLANK]] = False
    after[LEAD], after[GAP], after[RESET] = AFTER_BLANK, FRESH, FRESH
    return after, starts


AFTER, STARTS = _tables()


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, by its Unicode category."""
    import sys
    import unicodedata

    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for low, high in ranges:
            out[low : high + 1] = kind
    out[list(WHITE_SPACE)] = SPACE
    return out


def classes_of(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of the code points of joined texts, whose first place after each text is in ``ends``."""
    n = len(points)
    kinds = _classes()[points]
    last = np.zeros(n, bool)
    last[ends[ends > 0] - 1] = True
    shown = np.zeros(n, bool)
    shown[:-1] = (kinds[1:] != SPACE) & ~last[:-1]
    before = (kinds == SPACE) & shown
    kinds[before] = np.where(points[before] == 0x20, LEAD, GAP)
    quotes = np.flatnonzero(points == 0x27)
    quotes = quotes[~last[quotes]]
    follows = points[quotes + 1]
    second = np.where(last[quotes + 1], 0, points[np.minimum(quotes + 2, n - 1)])
    for suffix in CONTRACTIONS:
        found = follows == ord(suffix[0])
        if len(suffix) == 2:
            found &= second == ord(suffix[1])
        kinds[quotes[found]] = SHORT if len(suffix) == 1 else LONG
    return kinds


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The reader's state before each character, the first being FRESH.

    Each character is a function of states to states. Functions compose associatively, so blocks of characters are
    composed side by side, the blocks' functions are scanned by doubling, and each block is then read from the one
    state that it starts in. No pass goes over the text one character after another.
    """
    n = len(kinds)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, RESET, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    whole = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    flat = AFTER.ravel()
    for column in grid:
        whole = flat[(column.astype(np.intp) * 8)[:, None] + whole]
    step = 1
    while step < rows:
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.empty(rows, np.uint8)
    state[:1], state[1:] = FRESH, whole[:-1, FRESH]
    before = np.empty((BLOCK, rows), np.uint8)
    for k, column in enumerate(grid):
        before[k] = state
        state = flat[column.astype(np.intp) * 8 + state]
    return before.T.ravel()[:n]


def pre_tokens(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of joined texts where a pre-token starts; texts end at ``ends`` (places, ascending)."""
    if not len(points):
        return np.zeros(0, np.int64)
    kinds = classes_of(points, ends)
    # a text's first character starts a token: a reset stands before it
    firsts = np.unique(ends[:-1][ends[:-1] < len(points)])
    at = np.insert(kinds, firsts, RESET)
    before = states_before(at)
    starts = STARTS.ravel()[at.astype(np.intp) * 8 + before]
    return np.flatnonzero(np.delete(starts, firsts + np.arange(len(firsts))))


class Vocabulary:
    """Ranks of byte strings, merges with a bounded memory of pieces, and the bytes of ids."""

    CACHED_PIECES, CACHED_BYTES, SHORT_BYTES = 1 << 19, 64, 128

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # a clear comes before a batch of pieces, so that a batch may go beyond the bound by its own pieces
        tokens = sorted((i, t) for t, i in self.ranks.items())
        self.no_rank = tokens[-1][0] + 1
        self.singles = [bytes([a]) for a in range(256)]
        self.doubles = [self.ranks.get(a + b, self.no_rank) for a in self.singles for b in self.singles]
        self.sizes = np.zeros(self.no_rank, np.int64)
        for i, t in tokens:
            self.sizes[i] = len(t)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(t for _, t in tokens), np.uint8)
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a piece: always the pair of least rank, the first of equals, is merged."""
        if piece in self.ranks:
            return (self.ranks[piece],)
        if len(piece) <= self.SHORT_BYTES:
            return self._merged_short(piece)
        n, ranks = len(piece), self.ranks
        stop, back = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i : i + 2]) in ranks]
        heapq.heapify(pairs)
        while pairs:
            _, i, j = heapq.heappop(pairs)
            # the pair may be gone: its parts were merged with others meanwhile
            if stop[i] < 0 or stop[i] >= n or stop[stop[i]] != j:
                continue
            gone = stop[i]
            stop[i], stop[gone] = j, -1
            if j < n:
                back[j] = i
                if (p := piece[i : stop[j]]) in ranks:
                    heapq.heappush(pairs, (ranks[p], i, stop[j]))
            h = back[i]
            if h >= 0 and (p := piece[h:j]) in ranks:
                heapq.heappush(pairs, (ranks[p], h, j))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : stop[i]]])
            i = stop[i]
        return tuple(ids)

    def _merged_short(self, piece: bytes) -> tuple[int, ...]:
        """The same, looking at all pairs for the least: quicker than a heap as long as they are few."""
        rank, none = self.ranks.get, self.no_rank
        singles, doubles = self.singles, self.doubles
        parts = [singles[a] for a in piece]
        pairs = [doubles[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i] = part = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(part + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + part, none)
        return tuple(self.ranks[p] for p in parts)

    def encoded(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each piece; those of short pieces are remembered."""
        found = list(map(self.cache.get, pieces))
        if None in found:
            if len(self.cache) >= self.CACHED_PIECES:
                self.cache.clear()
            for k, ids in enumerate(found):
                if ids is None:
                    piece = pieces[k]
                    found[k] = ids = self.cache.get(piece) or self.merged(piece)
                    if len(piece) <= self.CACHED_BYTES:
                        self.cache[piece] = ids
        return found

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes of tokens whose places in the text are ``offsets``, one more than the ids; any run of tokens will do."""
        sizes = self.sizes[ids]
        if len(offsets) != len(ids) + 1 or (np.diff(offsets) != sizes).any():
            raise ValueError("the offsets are not those of the ids")
        base = int(offsets[0]) if len(offsets) else 0
        return self.bytes[np.repeat(self.firsts[ids] - (offsets[:-1] - base), sizes) + np.arange(int(offsets[-1]) - base)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_texts(texts: list[str], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts joined, and how many of them each text has."""
    whole = "".join(texts)
    points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = pre_tokens(points, np.concatenate([[0], ends]))
    widths = (points > 0x7F).astype(np.int8)
    for least in (0x7FF, 0xFFFF):
        widths += points > least
    at = np.concatenate([[0], np.cumsum(widths, dtype=np.int64)])
    data = whole.encode()
    bounds = np.append(starts + at[starts], len(data)).tolist()
    pieces = [data[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
    found = known.encoded(pieces)
    before = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
    ids = np.fromiter(chain.from_iterable(found), np.int32, int(before[-1]))
    # pre-tokens lie in their texts, so the ids before a text's end are those of the pre-tokens before it
    until = before[np.searchsorted(starts, ends)]
    return ids, np.diff(until, prepend=0)


def encode(docs: DataFrame, tokenizer: str, decode_again: bool = False) -> DataFrame:
    """(doc_id, ids array<int>, offsets array<long>) of every row; token i is the bytes from offsets[i] to offsets[i + 1].

    With ``decode_again`` also ``decoded``, the bytes that the ids stand for, as by ``decode``.

    ``tokenizer`` is the path of a ranks file: a base64 byte string and its rank on each line, single bytes included.
    Ids are those of the tiktoken library without special tokens, the pattern being the one named above. Null texts
    are empty and have no ids and the one offset 0; repeated rows and null ids stay; other columns are not read; an
    empty table gives no row. A text is whole in its task, at some 100 bytes a character; texts of a batch are read
    ``BATCH_BYTES`` at a time. The ids of up to ``CACHED_PIECES`` short pre-tokens are remembered.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)
        for b in pieces_of(batches, 1, BATCH_BYTES):
            ids, counts = encode_texts(b.column(1).to_pylist(), known)
            ends = np.concatenate([[0], np.cumsum(counts)])
            # a text's offsets start at 0 again: one entry more than its ids
            at = np.concatenate([[0], np.cumsum(known.sizes[ids])])
            per_text = counts + 1
            firsts = np.cumsum(per_text) - per_text
            place = np.arange(int(per_text.sum())) - np.repeat(firsts, per_text) + np.repeat(ends[:-1], per_text)
            offsets = at[place] - np.repeat(at[ends[:-1]], per_text)
            columns = [
                b.column(0),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                pa.ListArray.from_arrays(pa.array(np.append(firsts, len(offsets)), pa.int32()), pa.array(offsets)),
            ]
            if decode_again:
                data = known.decoded(ids, at)
                columns.append(pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(at[ends]), pa.py_buffer(data)]).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "offsets", "decoded"][: len(columns)])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>" + ", decoded binary" * decode_again)


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes that their ids stand for, placed by the offsets."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(tokenizer)
        for b in batches:
            ids, offsets = b.column(1), b.column(2)
            out = []
            for k in range(b.num_rows):
                own, at = (c[k].values.to_numpy(zero_copy_only=False) for c in (ids, offsets))
                out.append(known.decoded(own, at).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), ids, offsets, pa.array(out, pa.binary())], ["doc_id", "ids", "offsets", "decoded"])

    return encoded.select("doc_id", "ids", "offsets").mapInArrow(run, "doc_id long, ids array<int>, offsets array<long>, decoded binary")
