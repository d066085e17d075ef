"""Probability of whole texts by online logistic context mixing over bits, learnt from the corpus.

A text is its bytes with A-Z in lower case, written in 64 symbols: one for each of the 62 bytes that are most frequent in the training texts, one
that says that a byte comes as two half bytes, and the end. A symbol is six binary choices, and a choice is
predicted from several contexts: the last 3 and 6 symbols, and the word so far. How often a context
was followed by each symbol is counted over all training texts: tasks count packed keys of their partition and give them on as compressed
runs by range of a hash, words as compressed texts by range; a range's sums become its part of a hashed table. A cell there holds the log-odds of
three bits in a context and a check of the context that was met most often of those that share it; others find nothing. There
are as many cells as the contexts that were met need, so tables grow with the corpus. They are files in the shared folder that tasks map into memory.

The log-odds are combined by weights of their own for each bit of a symbol, learnt online, each step after the bits it predicted. What a piece begins with
is taught by the tuning texts, one in forty, from tables that leave these out, as a text that is scored may not have been counted either; with these
weights they then teach how often log-odds came true, which refines the probability. So a text's probability
depends on nothing but the text, all texts' probabilities add up to at most 1, and very long texts are many pieces.

Beside it stands the sum of smoothed log-probabilities of words, with an end for each text. Null and empty texts hold the end
alone. Ids that are null are in no fold: held_out is false and nothing is learnt from them. Each row counts, repeated rows
too. An empty table gives no rows; without training rows nothing is known. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .count_shards import CountShards, PartialCounts, mounted_dir, summed, write_shards

FOLDS, HELD_OUT, TUNING, TUNING_SHARE = 5, 1, 4, 8
#: Contexts by number.
ORDERS, WORD = (3, 6), 2
INPUTS = len(ORDERS) + 1
#: Symbols of a piece, bytes of text that are read at a time, words that a worker counts, and keys that it counts at a time.
PIECE, SLICE_BYTES, MOST_WORDS, MOST_KEYS = 1024, 900_000, 400_000, 4_000_000
#: Symbols with a byte of their own, what says that two half bytes follow, and the end.
COMMON, ESCAPE, LAST, CHOICES = 62, 62, 63, 6
PAD = 6
#: Places that are looked up in a table at a time, so that what is read stays near.
NEAR = 4096
#: Bytes of a cell: the 7 choices of three bits of a symbol that follow one another, and a check of the context that holds the cell.
CELL, NODES = 8, 7
#: Cells for each pair of context and symbol.
CELLS_A_KEY = 4
#: Cells of a line, within which a context has all its cells where few symbols follow a context: they are read together.
LINE_BITS, NEAR_ORDERS = 3, (1, WORD)
#: Log-odds of 1 are so many steps of a slot.
STEPS = 12.0
RATE = 0.01
#: Log-odds are refined by so many buckets within the reach, and rounded to so many steps of a bucket. Buckets begin as if met so often.
BUCKETS, REACH, FINE, PRIOR = 33, 9.0, 32, 20
#: What a word list holds for the end of a text; no word is empty.
END = b""
#: Marks ranges that hold the counts of tuning texts, and after they were summed those of all texts.
WHOLE = 1 << 40
_MIX = np.uint64(0x9E3779B97F4A7C15)

BITS = ((np.arange(64)[:, None] >> np.arange(5, -1, -1)) & 1).astype(np.uint8)
#: For each symbol, the places of its choices in its two cells, one behind the other.
PLACES = np.array([[(1 << j % 3) - 1 + ((x >> 3 if j < 3 else x & 7) >> 3 - j % 3) + CELL * (j // 3) for j in range(CHOICES)] for x in range(64)])
#: By how many bits a cell is shifted for its second and its third choice: those of the first cell, then those of the second. The first choice is the lowest byte.
SHIFTS = np.ascontiguousarray((PLACES % CELL * 8).T[[1, 2, 4, 5]]).astype(np.uint64)
#: What spreads a context's cells of second halves, one for each first half.
SPREAD = (np.arange(1, 9, dtype=np.uint64) * _MIX | np.uint64(1)).view(np.int64)


class Alphabet:
    """Symbols of bytes, from how often each byte was met; of equally frequent ones the smaller byte first."""

    def __init__(self, counts: np.ndarray):
        held = np.lexsort((np.arange(256), -counts))[:COMMON]
        self.symbol = np.full(256, ESCAPE, dtype=np.uint8)
        self.symbol[held] = np.arange(COMMON)
        self.gap = np.zeros(64, dtype=bool)
        self.gap[self.symbol[[b for b in range(33) if self.symbol[b] != ESCAPE]]] = True
        self.gap[LAST] = True


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a number and of its inverse."""
    return np.cumprod(np.full(n, _MIX)), np.cumprod(np.full(n, np.uint64(pow(int(_MIX), -1, 1 << 64))))


class Slice:
    """Texts of a slice as one run of symbols, each behind PAD ends, with their contexts."""

    def __init__(self, texts: list[str | None], alphabet: Alphabet):
        self.raw = [(t or "").encode().lower() for t in texts]
        self.alphabet = alphabet
        size = np.array([len(r) for r in self.raw], dtype=np.int64)
        b = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        symbols = alphabet.symbol[b]
        rare = symbols == ESCAPE
        upto = np.concatenate([[0], np.cumsum(np.where(rare, 3, 1))])  # symbols of all bytes before
        stops = np.cumsum(size)
        own = upto[stops] - upto[stops - size]
        self.size = own + 1  # with the end
        self.start = PAD + np.cumsum(own + PAD) - (own + PAD)
        self.symbols = np.full(int((own + PAD).sum()) + PAD, LAST, dtype=np.uint8)
        at = upto[:-1] + np.repeat(self.start - upto[stops - size], size)
        self.symbols[at] = symbols
        at, b = at[rare], b[rare]
        self.symbols[at + 1], self.symbols[at + 2] = b >> 4, b & 15

    def windows(self) -> np.ndarray:
        """The last six symbols before each place, the nearest lowest."""
        b = self.symbols
        w = np.zeros(len(b), dtype=np.uint64)
        w[1:] = b[:-1]
        w[2:] |= w[1:-1] << np.uint64(8)
        four = w.copy()  # from two symbols
        four[2:] |= w[:-2] << np.uint64(16)
        w <<= np.uint64(32)
        four[4:] |= w[:-4]
        return four

    def words(self) -> np.ndarray:
        """A hash of the symbols since the last white space before each place."""
        b = self.symbols
        n = len(b)
        power, back = _powers(1 << n.bit_length())
        upto = np.arange(1, 65, dtype=np.uint64).take(b[:-1])
        upto *= power[: n - 1]
        out = np.zeros(n, dtype=np.uint64)
        np.cumsum(upto, out=out[1:])  # of all symbols before
        since = np.concatenate([[0], np.flatnonzero(self.alphabet.gap.take(b[:-1])) + 1])
        size = np.diff(since, append=n)
        out -= np.repeat(out.take(since), size)
        out *= np.repeat(back.take(since), size)
        return out

    def contexts(self, at: np.ndarray, hash_bits: int) -> np.ndarray:
        """Hashes of each context at the places."""
        w = self.windows().take(at, mode="clip")
        out = np.empty((len(ORDERS) + 1, len(at)), dtype=np.int64)
        for i, k in enumerate(ORDERS):
            out[i] = _hashed(w & np.uint64((1 << 8 * k) - 1), hash_bits)
        out[WORD] = _hashed(self.words().take(at, mode="clip"), hash_bits)
        return out

    def places(self) -> np.ndarray:
        """All places that are predicted: a text's symbols and its end."""
        return np.repeat(self.start, self.size) + np.arange(self.size.sum()) - np.repeat(np.cumsum(self.size) - self.size, self.size)


def _hashed(x: np.ndarray, bits: int) -> np.ndarray:
    h = x + np.uint64(1)
    h *= _MIX
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(64 - bits)
    return h.view(np.int64)


def _keys(texts: list[str | None], alphabet: Alphabet, hash_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed keys of every place with counts: the context's number, its hash of 48 bits at most, and 8 bits of the symbol."""
    s = Slice(texts, alphabet)
    at = s.places()
    symbols = s.symbols.take(at, mode="clip")
    windows = s.windows().take(at, mode="clip")

    def packed(number: int, contexts: np.ndarray, last: np.ndarray) -> np.ndarray:
        return np.int64(number) << 56 | _hashed(contexts, hash_bits) << 8 | last.astype(np.int64)

    # of the shorter orders, what follows is counted once for all: their windows are ends of the longest one's
    short = ORDERS[-2]
    grams = (windows << np.uint64(8) | symbols) & np.uint64((1 << 8 * (short + 1)) - 1)
    grams, n = np.unique(grams.astype(np.uint32) if short < 4 else grams, return_counts=True)
    grams = grams.astype(np.uint64)
    for i, k in reversed(list(enumerate(ORDERS[:-1]))):
        if k < short:
            grams, n = summed(grams & np.uint64((1 << 8 * (k + 1)) - 1), n)
        yield packed(i, grams >> np.uint64(8), grams & np.uint64(255)), n
    last = len(ORDERS) - 1
    yield np.unique(packed(last, windows & np.uint64((1 << 8 * ORDERS[-1]) - 1), symbols), return_counts=True)
    yield np.unique(packed(WORD, s.words().take(at, mode="clip"), symbols), return_counts=True)


def _tokens(raw: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of lower-cased texts in UTF-8, the number of each token in turn, a text's words and one END, and where each text begins."""
    # of a text that ends in a space the last part is empty
    texts = [t + b" " if (t := r.strip()) else b"" for r in raw]
    upto = np.cumsum([0, *map(len, texts)], dtype=np.int64)
    parts = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_utf8(), len(texts), [None, pa.py_buffer(upto), pa.py_buffer(b"".join(texts))]))
    numbered = parts.values.dictionary_encode()
    return numbered.dictionary.cast(pa.large_binary()), numbered.indices.to_numpy(), parts.offsets.to_numpy()[:-1]


class WordCounts:
    """Counts of words as arrays of them come; about MOST_WORDS are held at a time."""

    def __init__(self):
        self.held, self.size, self.kept = [], 0, 0

    def add(self, words: pa.Array, n: np.ndarray) -> None:
        """Takes words, each once."""
        self.held.append((words, n))
        self.size += len(words)

    def full(self) -> bool:
        """Whether more are held than may be."""
        if self.size > max(MOST_WORDS, 2 * self.kept):
            self.held = [self.end()]
            self.size = self.kept = len(self.held[0][0])
        return self.kept > MOST_WORDS

    def end(self) -> tuple[pa.Array, np.ndarray]:
        """Words, each once, and their counts; none are held any more."""
        words, n = zip(*self.held, strict=True)
        self.held, self.size, self.kept = [], 0, 0
        if len(words) == 1:
            return words[0], n[0]
        numbered = pa.concat_arrays(words).dictionary_encode()
        sums = np.zeros(len(numbered.dictionary), dtype=np.int64)
        np.add.at(sums, numbered.indices.to_numpy(), np.concatenate(n))
        return numbered.dictionary, sums


def _folds(docs: DataFrame) -> DataFrame:
    fold = common.id_remainder(F.col("doc_id"), FOLDS)
    text = F.col("text").cast("string")
    tuning = (fold == TUNING) & (F.pmod(F.xxhash64(text), F.lit(TUNING_SHARE)) == 0)
    return docs.select("doc_id", text.alias("text"), F.coalesce(fold, F.lit(-1)).cast("int").alias("fold"), F.coalesce(tuning, F.lit(False)).alias("tuning"))


class Layout:
    """Bits of a hash and of a range of hashes. Both grow with the number of partitions, so a range has a bounded number of keys."""

    def __init__(self, partitions: int):
        size = max(1, partitions).bit_length()
        self.hash_bits, self.range_bits = min(48, 28 + size), min(24, 4 + size)
        # tasks give their counts on in rows of several ranges, as each gives a row for each
        self.given_bits = self.range_bits - 3

    def cuts(self, keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
        """Ranges of so many bits, and where each begins and ends in sorted keys."""
        own = (keys >> 56) << bits | (keys >> 8 + self.hash_bits - bits) & (1 << bits) - 1
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(own[a]), a, b

    def ranges(self, keys: np.ndarray, n: np.ndarray, bits: int | None = None) -> Iterator[tuple[int, bytes, bytes]]:
        """Range, packed keys and packed counts of sorted keys."""
        for own, a, b in self.cuts(keys, bits or self.range_bits):
            yield own, packed(np.diff(keys[a:b], prepend=0)), packed(n[a:b])


def packed(numbers: np.ndarray) -> bytes:
    """Numbers, first all lowest bytes, then all next ones: those that are the same nearly everywhere take no room."""
    planes = np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(-1).astype(np.int64)


_GATHERED = "range long, keys binary, counts binary, word binary, n long"


_SCHEMA = pa.schema([("range", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("word", pa.binary()), ("n", pa.int64())])


def _rows(ranges: list[tuple[int, bytes | None, bytes, bytes | None, int]]) -> pa.RecordBatch:
    """Ranges with keys or compressed words, their counts and how many they are."""
    columns = list(zip(*ranges, strict=True)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _word_rows(words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    """A row for each word with its count."""
    none = [pa.nulls(len(words), f.type) for f in list(_SCHEMA)[:3]]
    return pa.RecordBatch.from_arrays([*none, words.cast(pa.binary()), pa.array(n)], schema=_SCHEMA)


def _word_ranges(words: pa.Array, n: np.ndarray, bits: int) -> pa.RecordBatch:
    """Words and counts by range of a hash, of which negative numbers tell; a range's words are one text, parted by spaces."""
    held = words.to_numpy(zero_copy_only=False)
    own = np.fromiter(map(zlib.crc32, held.tolist()), dtype=np.int64, count=len(held)) >> 32 - bits
    order = np.argsort(own, kind="stable")
    own, held, n = own[order], held[order].tolist(), n[order]
    cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])).tolist()
    return _rows([(-1 - int(own[a]), None, packed(n[a:b]), zstandard.compress(b" ".join(held[a:b]), 1), b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])


def _summed(layout: Layout, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by range one row for each word and two for each range of the tables: without the tuning texts (if it has keys of others), and WHOLE with them."""
    now, held, tuned, words = None, [], [], WordCounts()

    def finished() -> pa.RecordBatch:
        if words.held:
            return _word_rows(*words.end())
        made, parts = [], [held, tuned]
        sums = [summed(np.concatenate([np.cumsum(unpacked(k)) for k, _ in p]), np.concatenate([unpacked(c) for _, c in p])) for p in parts if p]
        if held:
            made.append((0, *sums[0]))
        made.append((WHOLE, *(sums[0] if len(sums) == 1 else summed(*(np.concatenate(x) for x in zip(*sums, strict=True))))))
        return _rows([(mark | own, packed(np.diff(keys[a:b], prepend=0)), packed(n[a:b]), None, b - a) for mark, keys, n in made for own, a, b in layout.cuts(keys, layout.range_bits)])

    for batch in batches:
        for own, keys, counts, word in zip(*(batch.column(c).to_pylist() for c in ("range", "keys", "counts", "word")), strict=True):
            base = own if own < 0 else own & ~WHOLE
            if base != now and now is not None:
                yield finished()
                held, tuned = [], []
            now = base
            if own < 0:
                words.add(pc.split_pattern(pa.array([zstandard.decompress(word)], pa.large_binary()), " ").values, unpacked(counts))
            else:
                (tuned if own & WHOLE else held).append((keys, counts))
    if now is not None:
        yield finished()


def _gathered(layout: Layout, alphabet: Alphabet):
    """Partial counts of words and contexts of all training texts; contexts of those for tuning in ranges of their own (WHOLE)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCounts()
        counts = {False: PartialCounts(MOST_KEYS), True: PartialCounts(MOST_KEYS // 8)}

        def met(tuned: bool, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return _rows([(own | WHOLE * tuned, k, c, None, 0) for own, k, c in layout.ranges(keys, n, layout.given_bits)])

        for batch in batches:
            for part in common.slices_of(batch, "text", SLICE_BYTES):
                texts, tuning = part.column("text").to_pylist(), part.column("tuning").to_pylist()
                distinct, token, _ = _tokens([(t or "").encode().lower() for t in texts])
                words.add(distinct, np.bincount(token))
                if words.full():
                    yield _word_ranges(*words.end(), layout.given_bits)
                for tuned, held in counts.items():
                    counted = [t for t, x in zip(texts, tuning, strict=True) if x == tuned]
                    if counted:
                        for keys, n in _keys(counted, alphabet, layout.hash_bits):
                            for full in held.add(keys, n):
                                yield met(tuned, *full)
        for tuned, held in counts.items():
            for full in held.end():
                yield met(tuned, *full)
        if words.held:
            yield _word_ranges(*words.end(), layout.given_bits)

    return run


class Words:
    """Counts of words and what a word adds to a text's sum; can be sent to tasks."""

    def __init__(self, shards: CountShards, salt: bytes, total: int, distinct: int):
        self.shards, self.salt, self.total, self.distinct = shards, salt, total, distinct

    def base(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text its tokens, those met in training, and the sum of their log10 probabilities."""
        distinct, token, start = _tokens(raw)
        keys = np.fromiter((xxhash.xxh64_intdigest(w + self.salt, 42) for w in distinct.to_numpy(zero_copy_only=False).tolist()), dtype=np.uint64, count=len(distinct)).view(np.int64)
        order = np.argsort(keys)
        c = np.empty(len(distinct), dtype=np.int64)
        c[order] = self.shards.counts(keys[order])
        value = np.log10((np.append(c, 0) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))
        found = value.take(token)
        n = np.diff(start, append=len(token))
        return n, np.add.reduceat((found > value[-1]).astype(np.int64), start), np.add.reduceat(found, start)


def count_words(counts: DataFrame) -> Words:
    """Of (word, n) with each word once. Words are looked up by a hash; should two of them share one, another is taken."""
    distinct = counts.count()
    salt = b""
    while True:
        shards, _, keys, total = write_shards(counts.select(F.xxhash64(F.concat("word", F.lit(salt))).alias("key"), "n"))
        if keys == distinct:
            return Words(shards, salt, total, distinct)
        salt += b"\0"


class Tables:
    """The cells of every context's table, mapped from a file each; can be sent to tasks."""

    def __init__(self, files: list[str], cell_bits: list[int], layout: Layout):
        self.files, self.cell_bits, self.hash_bits, self.range_bits = files, cell_bits, layout.hash_bits, layout.range_bits
        self._maps: list[np.ndarray] = []

    def __getstate__(self):
        return self.__dict__ | {"_maps": []}

    def remove(self) -> None:
        """Removes the files of tables that nothing looks into any more."""
        self._maps = []
        for f in self.files:
            os.remove(f)

    def inputs(self, contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """(INPUTS, places, CHOICES) steps of log-odds of 1 for the choices that lead to the symbols."""
        if not self._maps:
            self._maps = [np.asarray(np.memmap(f, dtype="<u8", mode="r")) for f in self.files]
        out = np.empty((INPUTS, CHOICES, len(symbols)), dtype=np.int8)  # operations go over all places of a choice
        for a in range(0, len(symbols), NEAR):
            self._fill(out[:, :, a : a + NEAR], contexts[:, a : a + NEAR], symbols[a : a + NEAR])
        return out.transpose(0, 2, 1)

    def _fill(self, out: np.ndarray, contexts: np.ndarray, symbols: np.ndarray) -> None:
        n = len(symbols)
        at = np.empty((2, n), dtype=np.int64)
        spread = SPREAD.take(symbols >> 3)
        held = np.empty((2, n), dtype=np.uint64)
        shifts = SHIFTS.take(symbols, axis=1).reshape(2, 2, n)
        for i, (table, bits) in enumerate(zip(self._maps, self.cell_bits, strict=True)):
            at[0], at[1] = cells_of(contexts[i], spread, i, bits, self.hash_bits, self.range_bits)
            table.take(at, out=held, mode="clip")
            own = (held.view(np.uint8)[:, NODES::CELL] == contexts[i].astype(np.uint8)).view(np.int8)
            chosen = out[i].reshape(2, CHOICES // 2, n)
            np.multiply(held.view(np.int8)[:, ::CELL], own, out=chosen[:, 0])
            np.multiply((held[:, None] >> shifts).astype(np.int8), own[:, None], out=chosen[:, 1:])


def cells_of(h: np.ndarray, spread: np.ndarray, order: int, bits: int, hash_bits: int, range_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells of contexts for the first and the second half of a symbol, within the part of the table that the contexts' range has."""
    low = hash_bits - range_bits
    at = h >> hash_bits - bits
    second = h * spread
    second &= (1 << low) - 1
    if order in NEAR_ORDERS:
        # another cell of the line
        second >>= low - 16
        second *= (1 << LINE_BITS) - 1
        second >>= 16
        second += 1
        second ^= at
    else:
        second >>= hash_bits - bits
        second |= h >> low << bits - range_bits
    return at, second


def _quantized(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Steps of log-odds of the counts; 0 where there are none, and never 0 where there are some."""
    odds = np.rint(np.log((ones + 0.2) / (zeros + 0.2)) * STEPS)
    odds = np.where((odds == 0) & (zeros + ones > 0), 1, odds)
    return np.clip(odds, -127, 127).astype(np.int8)


def _filled(keys: np.ndarray, n: np.ndarray, order: int, bits: int, layout: Layout) -> np.ndarray:
    """The cells of a range from its sorted keys. Of contexts that share a cell the one that was met there most often holds it."""
    size = 1 << bits - layout.range_bits
    h, symbols = keys >> 8 & (1 << layout.hash_bits) - 1, keys & 255
    out = np.zeros(size * CELL, dtype=np.int8)
    owner, most = np.full(size, -1), np.zeros(size, dtype=np.int64)
    groups = []
    for low in (0, 1):  # groups of keys that share a context's cell stand together
        own = h << 3 | symbols >> 3 if low else h
        start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        at = cells_of(h[start], SPREAD.take(symbols[start] >> 3), order, bits, layout.hash_bits, layout.range_bits)[low] & size - 1
        met = np.add.reduceat(n, start)
        np.maximum.at(most, at, met)
        groups.append((start, at, met))
    for low, (start, at, met) in enumerate(groups):
        first = met == most[at]
        owner[at[first]] = np.flatnonzero(first) << 1 | low
    slots, weights = [], []  # a slot for a choice of 0 and one for 1
    for low, (start, at, _) in enumerate(groups):
        held = owner[at] == (np.arange(len(at)) << 1 | low)
        out[at[held] * CELL + NODES] = (h[start[held]] & 255).astype(np.uint8).view(np.int8)
        of = np.repeat(held, np.diff(start, append=len(keys)))
        cell = np.repeat(at, np.diff(start, append=len(keys)))[of]
        x, weight = symbols[of], n[of]
        for j in range(3 * low, 3 * low + 3):
            slots.append((cell - low) * (2 * CELL) + (PLACES[:, j] * 2 + BITS[:, j]).take(x))
            weights.append(weight)
    slot = np.concatenate(slots)
    met = np.bincount(slot, weights=np.concatenate(weights), minlength=2 * size * CELL)
    slot >>= 1
    out[slot] = _quantized(met.take(slot * 2), met.take(slot * 2 + 1))
    return out


def build_tables(whole: DataFrame, layout: Layout) -> Tables:
    """Tables of (range, keys, counts, n) with each range once. A range is a part of its table's file, which a task writes in its place; to write it twice changes nothing."""
    spark = whole.sparkSession
    folder = f"{mounted_dir(spark)}/tickweave-model-{uuid.uuid4().hex}"
    os.makedirs(folder, exist_ok=True)
    kind = F.shiftright("range", layout.range_bits)
    met = {r[0]: r[1] for r in whole.groupBy(kind).agg(F.sum("n")).collect()}
    bits = [int(min(layout.hash_bits, max(layout.range_bits + LINE_BITS, np.rint(np.log2(max(1, met.get(k, 0)) * CELLS_A_KEY))))) for k in range(len(ORDERS) + 1)]
    files = [f"{folder}/{k}" for k in range(len(bits))]
    for f, b in zip(files, bits, strict=True):
        with open(f, "wb") as out:
            out.truncate(CELL << b)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, keys, n in zip(*(batch.column(c).to_pylist() for c in ("range", "keys", "counts")), strict=True):
                k, at = own >> layout.range_bits, own & (1 << layout.range_bits) - 1
                cells = _filled(np.cumsum(unpacked(keys)), unpacked(n), k, bits[k], layout)
                f = os.open(files[k], os.O_WRONLY)
                try:
                    os.pwrite(f, cells.tobytes(), at * cells.nbytes)
                    os.fsync(f)
                finally:
                    os.close(f)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["parts"])

    whole.mapInArrow(fill, "parts long").agg(F.sum("parts")).collect()
    return Tables(files, bits, layout)


class Mixer:
    """Weights that pieces begin with, and what log-odds came to in the tuning texts."""

    def __init__(self, weights: np.ndarray, refined: np.ndarray):
        self.weights, self.refined = weights.astype(np.float32), refined
        # log10 of a choice's probability, for each of the six, for 0 and 1, and for each step of the log-odds of 0
        odds = np.arange(STEPPED) / (STEPPED - 1) * 2 * REACH - REACH
        one = (1 / (1 + np.exp(odds)) + refined[:, _bucket(np.arange(STEPPED))]) / 2
        self.logs = np.log10(np.stack([1 - one, one], axis=1)).astype(np.float32).ravel()

    @staticmethod
    def untaught() -> Mixer:
        return Mixer(np.full((INPUTS, CHOICES), 0.3), np.tile(_centres(), (CHOICES, 1)))

    def run(self, s: Slice, tables: Tables, taught: np.ndarray | None = None) -> np.ndarray:
        """log10 of the probability of each text. taught: sums of what pieces have learnt, by the bytes they learnt from, are added to it, and how often what choices came true by bucket."""
        n_pieces = -(-s.size // PIECE)
        doc = np.repeat(np.arange(len(s.size)), n_pieces)
        number = np.arange(n_pieces.sum()) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = s.start[doc] + number * PIECE
        size = np.minimum(PIECE, s.size[doc] - number * PIECE)
        order = np.argsort(-size, kind="stable")
        doc, start, size = doc[order], start[order], size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # pieces longer than t
        ends = np.cumsum(active)
        step = np.repeat(np.arange(len(active)), active)
        lane = np.arange(ends[-1]) - np.repeat(ends - active, active)
        at = start[lane] + step
        symbols = s.symbols.take(at, mode="clip")
        x8 = tables.inputs(s.contexts(at, tables.hash_bits), symbols).transpose(0, 2, 1)
        bits = np.empty((CHOICES, len(at)), dtype=np.float32)
        for j in range(CHOICES):
            bits[j] = symbols >> CHOICES - 1 - j & 1
        n = len(size)
        # of the log-odds of 0, and by steps
        weights = np.repeat(self.weights[:, :, None] * np.float32(-1 / STEPS), n, axis=2)
        odds = np.empty((CHOICES, len(at)), dtype=np.float32)
        rate, reach, one = np.float32(RATE / STEPS**2), np.float32(REACH), np.float32(1)
        a = 0
        for b in ends.tolist():
            x = x8[:, :, a:b].astype(np.float32)
            w = weights[:, :, : b - a]
            each = w * x
            dot = np.add(each[0], each[1], out=each[0])
            for more in each[2:]:
                dot += more
            dot.clip(-reach, reach, out=dot)
            odds[:, a:b] = dot
            p = np.exp(dot, out=dot)
            p += one
            np.reciprocal(p, out=p)
            p -= bits[:, a:b]
            p *= rate
            x *= p
            w += x
            a = b
        out = np.empty(len(at), dtype=np.float32)
        scale = np.float32((STEPPED - 1) / (2 * REACH))
        first = (np.arange(CHOICES) * (2 * STEPPED) + (STEPPED - 1) / 2 + 0.5).astype(np.float32)[:, None]
        for a in range(0, len(at), NEAR):
            cell = odds[:, a : a + NEAR] * scale
            cell += first
            cell = cell.astype(np.int64)
            x = symbols[a : a + NEAR]
            if taught is not None:
                bucket = _bucket(cell % (2 * STEPPED)) + np.arange(CHOICES)[:, None] * BUCKETS
                for bit in (0, 1):
                    taught[-1 - (2 - bit) * CHOICES * BUCKETS :][: CHOICES * BUCKETS] += np.bincount(bucket[BITS.T.take(x, axis=1) == bit], minlength=CHOICES * BUCKETS)
            cell += STEPS_OF.take(x, axis=1)
            np.add.reduce(self.logs.take(cell), axis=0, out=out[a : a + NEAR])
        if taught is not None:
            learnt = np.rint(weights.astype(np.float64) * -STEPS * 65536).astype(np.int64)
            taught[: INPUTS * CHOICES] += (learnt * size).sum(axis=2).ravel()
            taught[-1] += size.sum()
        return np.bincount(doc[lane], weights=out, minlength=len(s.size))


#: Steps that log-odds are rounded to, and where in the logs the probabilities of each symbol's choices begin.
STEPPED = (BUCKETS - 1) * FINE + 1
STEPS_OF = np.ascontiguousarray(BITS.T.astype(np.int64) * STEPPED)


def _bucket(step: np.ndarray) -> np.ndarray:
    return (step + FINE // 2) // FINE


def _centres() -> np.ndarray:
    """The probability of 1 in the middle of each bucket of log-odds of 0."""
    return 1 / (1 + np.exp((np.arange(BUCKETS) / (BUCKETS - 1) * 2 - 1) * REACH))


def _teach(docs: DataFrame, alphabet: Alphabet, tables: Tables, mixer: Mixer) -> Mixer:
    """First the weights that the pieces of the docs have at their ends, on average by bytes; then, with these, how often choices of a bucket were 1.

    Both are sums of integers, so no order of tasks changes them.
    """
    cells = INPUTS * CHOICES + 2 * CHOICES * BUCKETS

    def sums(mixer: Mixer) -> np.ndarray | None:
        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            taught = np.zeros(cells + 1, dtype=np.int64)
            for batch in batches:
                for part in common.slices_of(batch, "text", SLICE_BYTES):
                    mixer.run(Slice(part.column("text").to_pylist(), alphabet), tables, taught)
            yield pa.RecordBatch.from_arrays([pa.array(range(cells + 1), pa.int32()), pa.array(taught)], names=["cell", "n"])

        added = docs.select("text").mapInArrow(learn, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
        got = {r["cell"]: r["n"] for r in added.collect()}
        return np.array([got[i] for i in range(cells + 1)]) if got.get(cells) else None

    learnt = sums(mixer)
    if learnt is None:
        return mixer
    mixer = Mixer((learnt[: INPUTS * CHOICES] / learnt[-1] / 65536).reshape(INPUTS, CHOICES), mixer.refined)
    zeros, ones = sums(mixer)[INPUTS * CHOICES : -1].reshape(2, CHOICES, BUCKETS)
    return Mixer(mixer.weights, (ones + PRIOR * _centres()) / (zeros + ones + PRIOR))


class Model:
    """Alphabet, words, tables and mixer; can be sent to tasks."""

    def __init__(self, alphabet: Alphabet, words: Words, tables: Tables, mixer: Mixer):
        self.alphabet, self.words, self.tables, self.mixer = alphabet, words, tables, mixer


def _byte_counts(docs: DataFrame) -> np.ndarray:
    """How often each byte is met, A-Z in lower case."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for part in common.slices_of(batch, "text", SLICE_BYTES):
                raw = b"".join((t or "").encode().lower() for t in part.column("text").to_pylist())
                met += np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(met)], names=["byte", "n"])

    sums = docs.select("text").mapInArrow(count, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n"))
    out = np.zeros(256, dtype=np.int64)
    for r in sums.collect():
        out[r["byte"]] = r["n"]
    return out


def fit(docs: DataFrame) -> Model:
    """Learns from all rows outside the held-out fold: bytes, words and contexts are counted over all of them.

    The first weights are taught by the tuning rows from tables without them, the tables of the model hold these too.
    """
    training = _folds(docs).where((F.col("fold") != HELD_OUT) & (F.col("fold") >= 0))
    layout, tuning = Layout(training.rdd.getNumPartitions()), training.where("tuning")
    alphabet = Alphabet(_byte_counts(training))
    rows = training.select("text", "tuning").mapInArrow(_gathered(layout, alphabet), _GATHERED)
    base = F.when(F.col("range") < 0, F.col("range")).otherwise(F.col("range").bitwiseAND(F.lit(WHOLE - 1)))
    dealt = rows.repartition(base).sortWithinPartitions(base)
    whole = common.materialize(dealt.mapInArrow(partial(_summed, layout), _GATHERED))
    words = count_words(whole.where("word IS NOT NULL").select("word", "n"))
    ranges = whole.where("range IS NOT NULL").select("range", "keys", "counts", "n")
    untuned = build_tables(ranges.where(F.col("range") < WHOLE), layout)
    mixer = _teach(tuning, alphabet, untuned, Mixer.untaught())
    untuned.remove()
    tables = build_tables(ranges.where(F.col("range") >= WHOLE).withColumn("range", F.col("range") - WHOLE), layout)
    return Model(alphabet, words, tables, mixer)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte (of the text and its end)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices_of(batch, "text", SLICE_BYTES):
                s = Slice(part.column("text").to_pylist(), model.alphabet)
                found = model.mixer.run(s, model.tables)
                n, known, base = model.words.base(s.raw)
                held_out = [f == HELD_OUT for f in part.column("fold").to_pylist()]
                columns = [part.column("doc_id"), pa.array(held_out), pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array([model.words.total] * len(n), pa.int64()), pa.array(base, pa.float64()), pa.array(found), pa.array(-found / np.log10(2) / np.array([len(r) + 1 for r in s.raw]))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return _folds(docs).mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")


def op12_context_mixing(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score(docs, fit(docs))
