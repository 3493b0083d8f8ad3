"""Words, word hashes and token ids over Arrow batches, with numpy over whole batches instead of a loop over words."""

from __future__ import annotations

import functools
import itertools
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Word bytes of two readings of a text. BLANKS: anything but space, \t \n \v \f \r. ALNUM: 0-9, a-z after lower-casing, and every byte of a non-ASCII letter.
BLANKS = np.ones(256, bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

#: What lies between spaces and line feeds.
PIECES = np.ones(256, bool)
PIECES[[0x20, 0x0A]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # 3 mod 8: powers of it stay far from 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Odd multipliers for the places of a word in a window of words.
PLACES = _rng.integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=4)
def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and each text's bounds (n + 1 offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def words_of(column: pa.Array, kind: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, lower-cased unless said otherwise, word starts, word ends, first word of each text with one bound more) of a batch of texts."""
    data, at = text_bytes(column)
    data = LOWER[data] if lower else data
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[1:-1]
    first[edges] = inside[edges]  # a text's first byte begins a word even where the text before ends in one
    starts = np.flatnonzero(first)
    stop = np.zeros(len(data) + 1, bool)
    stop[1:] = inside[:-1] & ~inside[1:]
    cut = edges[edges > 0]
    stop[cut] |= inside[cut - 1]
    ends = np.flatnonzero(stop)
    return data, starts, ends, np.searchsorted(starts, at)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: polynomial prefix sums over all bytes, cut at the word's bounds."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = 1 << max(19, len(data).bit_length())  # one pair of tables for all batches but those of a longer text
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(size, _BASE)[: len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * powers(size, _INVERSE)[starts])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the window of `size` words that begins at each word; len(words) - size + 1 of them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if size <= 16:
        out = words[:n] * PLACES[0]
        for j in range(1, size):
            out += words[j : j + n] * PLACES[j]
        return mix(out)
    prefix = np.zeros(len(words) + 1, np.uint64)
    up = 1 << max(10, int(len(words) + 1).bit_length())
    np.cumsum(words * powers(up, _BASE)[: len(words)], out=prefix[1:])
    return mix((prefix[size:] - prefix[:n]) * powers(up, _INVERSE)[:n])


def span_hashes(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words of each span."""
    prefix = np.zeros(len(words) + 1, np.uint64)
    up = 1 << max(10, int(len(words) + 1).bit_length())
    np.cumsum(words * powers(up, _BASE)[: len(words)], out=prefix[1:])
    return mix((prefix[end] - prefix[begin]) * powers(up, _INVERSE)[begin])


def batches(it, limit: int = (1 << 19) - 1):
    """Arrow batches cut so that each holds about `limit` bytes of text at most (one row at least)."""
    for batch in it:
        sizes = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(), dtype=np.int64)])
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + limit, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi
    pa.default_memory_pool().release_unused()  # a worker may live on, and wait, while others work


_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in ".,;:!?"]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


class WordPieces:
    """Token ids of a `tokenizers` file whose pre-tokenizer never joins what a space or line feed parts, and which marks word ends by "</w>".

    Batches of texts are cut at spaces and line feeds; each distinct piece is encoded once and its ids are gathered for
    all its places. Plain words go through the same model without the normaliser's
    regular expressions, many in one call; all other pieces go through the whole tokenizer. The memory of pieces is
    emptied at `keep`."""

    def __init__(self, path: str, keep: int = 800_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.keep = Tokenizer.from_file(path), keep
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.whole.get_vocab_size(), bool)
        for token, i in self.whole.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.place, self.flat, self.bounds = {}, np.zeros(0, "<u4"), np.zeros(1, np.int64)

    @staticmethod
    def _is_plain(core: str) -> bool:
        """Letters only, nothing that normalising or lower-casing a whole word could turn into something else."""
        return core.isalpha() and (core.isascii() or unicodedata.is_normalized("NFC", core) and not set(core) & {"\u03a3", "\u0130"})

    def _new(self, pieces: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        plain = [self._is_plain(p) for p in pieces]
        odd = [k for k, is_plain in enumerate(plain) if not is_plain]
        for k, ids in zip(odd, self._whole([pieces[k] for k in odd])):
            out[k] = ids
        even = [k for k, is_plain in enumerate(plain) if is_plain]
        for lo in range(0, len(even), 4096):
            some = even[lo : lo + 4096]
            ids = np.array(self.plain.encode_batch_fast([" ".join([pieces[k].lower() for k in some])], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                raise ValueError("this tokenizer does not end each word by one marked token")
            raw, at = ids.tobytes(), [0, *(4 * stops).tolist()]
            for k, a, b in zip(some, at, at[1:]):
                out[k] = raw[a:b]
        return out

    @staticmethod
    def _without_tails(data, starts, ends, first):
        """Cuts a run of TAIL off each word where a letter or digit stands before it: no token spans that place."""
        if not len(starts):
            return data, starts, ends, first
        place = np.arange(len(data))
        place[_TAIL[data]] = -1
        last = np.maximum.accumulate(place)[ends - 1]  # the last byte outside TAIL
        cut = (last >= starts) & (last < ends - 1)
        low, before = data[np.maximum(last, 0)], data[np.maximum(last - 1, 0)]
        cut &= _LETTER[low] | ((before == 0xC3) & (low >= 0x80) & (low != 0x97) & (low != 0xB7) & (last > starts))
        many = 1 + cut
        at = np.cumsum(many) - many
        new_starts, new_ends = np.repeat(starts, many), np.repeat(ends, many)
        new_ends[at[cut]] = new_starts[at[cut] + 1] = last[cut] + 1
        return data, new_starts, new_ends, np.concatenate([at, [many.sum()]])[first]

    def _whole(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.whole.encode_batch_fast(pieces, add_special_tokens=False)] if pieces else []

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and each text's bounds in them (one more than texts); null counts as empty."""
        data, at = text_bytes(column)
        special = b"<|" in data.tobytes()  # the special tokens' own strings are told by their case
        data, starts, ends, first = words_of(column, PIECES, lower=not special)
        data, starts, ends, first = self._without_tails(data, starts, ends, first)
        keys, where, inverse = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.place) > self.keep:
            self.clear()
        found = np.fromiter(map(self.place.get, keys.tolist(), itertools.repeat(-1)), np.int64, len(keys))
        if len(new := np.flatnonzero(found < 0)):
            raw = data.tobytes()
            ids = self._new([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())])
            found[new] = np.arange(len(self.place), len(self.place) + len(new))
            self.place.update(zip(keys[new].tolist(), found[new].tolist()))
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), "<u4")])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        piece = found[inverse]
        lengths = self.bounds[piece + 1] - self.bounds[piece]
        stop = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.bounds[piece] - stop[:-1], lengths) + np.arange(stop[-1])]
        return ids, stop[first]


@functools.lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    """One encoder a Python worker, kept between tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordPieces(path)
