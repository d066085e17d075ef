"""Packing into fixed windows by minimum bin slack over counts of lengths.

Documents become token ids (an end id last) and are cut at multiples of the window, so at most one piece
of each is shorter than a window. How many pieces there are of each length is all that planning needs:
at most one count per length, whatever the input. For each window a bitset subset-sum program over the
lengths left finds the fullest multiset, and this pattern is repeated as often as the counts allow, so
there are at most as many patterns as lengths. Pieces that no window holds with little slack are cut
into powers of two, which fill windows without any. Then each piece finds its window by its rank among
the pieces of its length; ranks come from counts of (length, bucket of the id), so a length that a third
of all pieces share is ranked in many tasks.

Null texts count as empty and hold the end id alone. Repeated rows are packed like any other. An empty
table gives no pieces. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

CAPACITY, END_ID = 4096, 2
#: Words that a Python worker keeps the ids of, and bytes of text that it encodes at a time.
MEMO, SLICE_BYTES = 600_000, 8_000_000
#: The same where workers share their executor with those of other stages.
SMALL_MEMO, SMALL_SLICE_BYTES = 50_000, 600_000


class WordMerges:
    """Byte-pair merges of many words at once: a row a word, one merge a row a step, in numpy.

    In each row the adjacent pair of the least rank, of equal ones the leftmost, becomes one symbol, until
    no pair is left that has a rank. Only the two pairs beside a merge are looked up anew.
    """

    LONGEST = 48

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[x] * self.size + vocab[y] for x, y in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.arange(len(pairs), dtype=np.int32)[order]
        self.made = np.array([vocab[x + y] for x, y in pairs], dtype=np.int32)
        # bytes that print stand for themselves, the others for the characters from 256 on
        printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [i for i in range(256) if i not in printing]
        names = {i: chr(i) for i in printing} | {x: chr(256 + n) for n, x in enumerate(rest)}
        self.inner = np.array([vocab[names[i]] for i in range(256)], dtype=np.int32)
        self.last = np.array([vocab[names[i] + suffix] for i in range(256)], dtype=np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), self.ranks[at], _NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of 1 to LONGEST bytes."""
        size = np.array([len(w) for w in words])
        out: list[bytes] = [b""] * len(words)
        for low, high in ((0, 8), (8, 16), (16, self.LONGEST)):
            rows = np.flatnonzero((size > low) & (size <= high))
            for i in range(0, len(rows), 4096):
                part = rows[i : i + 4096]
                for k, ids in zip(part.tolist(), self._encode([words[k] for k in part.tolist()], size[part], high), strict=True):
                    out[k] = ids
        return out

    def _encode(self, words: list[bytes], size: np.ndarray, width: int) -> list[bytes]:
        raw = np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)
        here = np.arange(width)[None, :] < size[:, None]
        sym = np.where(here, self.inner[raw], -1).astype(np.int32)
        n = np.arange(len(words))
        sym[n, size - 1] = self.last[raw[n, size - 1]]
        sym = np.concatenate([sym, np.full((len(words), 1), -1, dtype=np.int32)], axis=1)
        rank = self._rank(sym[:, :-1], sym[:, 1:])
        done = np.full((len(words), width), -1, dtype=np.int32)
        rows = n
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            go = best != _NONE
            if not go.all():
                stop = ~go
                done[rows[stop], : sym.shape[1] - 1] = sym[stop, :-1]
                rows, sym, rank, at, best = rows[go], sym[go], rank[go], at[go], best[go]
                if not len(rows):
                    break
            k, w = np.arange(len(rows)), sym.shape[1]
            sym[k, at] = self.made[best]
            later = np.arange(w - 1)[None, :]
            sym = np.take_along_axis(sym, later + (later > at[:, None]), axis=1)
            rank = np.take_along_axis(rank, np.minimum(later[:, :-1] + (later[:, :-1] >= at[:, None]), w - 2), axis=1)
            if rank.shape[1] == 0:
                done[rows, :1] = sym[:, :1]
                break
            inside = at < rank.shape[1]
            rank[k[inside], at[inside]] = self._rank(sym[k[inside], at[inside]], sym[k[inside], at[inside] + 1])
            before = at > 0
            rank[k[before], at[before] - 1] = self._rank(sym[k[before], at[before] - 1], sym[k[before], at[before]])
        kept = done >= 0
        flat = done[kept].astype("<u4").tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(kept.sum(axis=1))])).tolist()
        return [flat[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


_NONE = np.iinfo(np.int32).max

#: The pattern and the normalizers that the tokenizer's file must state for words to be looked up.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITS = [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Characters of which the tokenizer and the regex library are known to say the same (a test goes through all):
#: Latin to Cyrillic, Hebrew, Arabic, Thai, Greek with marks, punctuation, signs, kana, Han, Hangul, pictures.
KNOWN = "\0-\u0557\u05d0-\u05ea\u0600-\u06ff\u0e01-\u0e3a\u1e00-\u1eff\u2000-\u206f\u20a0-\u20bf\u2100-\u214f\u2190-\u22ff\u2500-\u27bf\u3000-\u303f\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fef\uac00-\ud7a3\uff01-\uff60\U0001f300-\U0001f64f"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes, with the ids of word parts kept.

    The tokenizer drops white space and its pattern never reaches over it, so the ids of a word between
    white space are the same wherever it stands: those of its parts, which the pattern makes of the
    normalized word. Most words are letters, or letters and one sign. Parts that are new are merged many
    at a time. Texts with a character that isn't KNOWN or with an added token go to the tokenizer whole,
    and so do all texts if its file states another pattern, normalizer or model.
    """

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        model = made["model"]
        plain_model = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        pieces = (made["normalizer"] or {}).get("normalizers"), (made["pre_tokenizer"] or {}).get("pretokenizers")
        self.by_word = plain_model and pieces == (NORMALIZERS, SPLITS) and not any(a.get("normalized") for a in made["added_tokens"])
        self.merges = WordMerges(model) if self.by_word else None
        self.parts = regex.compile(PATTERN)
        self.unknown = regex.compile(f"[^{KNOWN}]")
        self.added = [a["content"] for a in made["added_tokens"]]
        #: The tokenizer's white space; str.split also parts at four control characters that it encodes.
        self.word = regex.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
        self.controls = regex.compile("[\x1c-\x1f]")
        self.memo: dict[str, bytes] = {}
        self.most = MEMO

    def _learn(self, new: list[str]) -> None:
        if not new:
            return
        raw = [p.encode("utf-8", "replace") for p in new]
        short = [k for k, r in enumerate(raw) if len(r) <= WordMerges.LONGEST]
        self.memo.update(zip((new[k] for k in short), self.merges.encode([raw[k] for k in short]), strict=True))
        if len(short) < len(new):
            long = [p for p, r in zip(new, raw, strict=True) if len(r) > WordMerges.LONGEST]
            for p, e in zip(long, self.tokenizer.encode_batch_fast(long, add_special_tokens=False), strict=True):
                self.memo[p] = np.array(e.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Texts in Latin-1 need no normalizing but lower-casing."""
        plain, other, odd, whole = [], [], [], []
        for n, t in enumerate(texts):
            if not self.by_word or any(a in t for a in self.added) or not t.isascii() and self.unknown.search(t):
                whole.append(n)
                continue
            if self.controls.search(t):
                odd.append((n, self.word.findall(t)))
                continue
            try:
                t.encode("latin-1")
                plain.append((n, t.lower()))
            except UnicodeEncodeError:
                other.append((n, t))
        out = [b""] * len(texts)
        for n, e in zip(whole, self.tokenizer.encode_batch_fast([texts[n] for n in whole], add_special_tokens=False), strict=True):
            out[n] = np.array(e.ids, dtype="<u4").tobytes()
        for group, kind in ((plain, True), (other, False), (odd, False)):
            if group:
                rows = pa.array([t for _, t in group], pa.large_list(pa.large_string())) if group is odd else pc.utf8_split_whitespace(pa.array([t for _, t in group], pa.large_string()))
                for (n, _), ids in zip(group, self._rows(rows, kind), strict=True):
                    out[n] = ids
        return out

    def _rows(self, rows: pa.Array, plain: bool) -> Iterator[bytes]:
        """Ids of lists of words: each distinct word is looked up once, and copied to its places by numpy."""
        coded = rows.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = self._ids(words, plain)
        made = [known[w] for w in words]
        flat = np.frombuffer(b"".join(made), dtype="<u4")
        size = np.array([len(x) // 4 for x in made], dtype=np.int64)
        start = np.cumsum(size) - size
        at = coded.indices.to_numpy(zero_copy_only=False)
        sizes = size[at]
        ends = np.cumsum(sizes)
        ids = flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[at] - (ends - sizes), sizes)]
        cuts = np.concatenate([[0], ends])[rows.offsets.to_numpy() - rows.offsets[0].as_py()].tolist()
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[x:y].tobytes()

    def _ids(self, seen: list[str], plain: bool) -> dict[str, bytes]:
        if len(self.memo) > self.most:
            self.memo.clear()
        memo, near, new = self.memo, {}, set()
        stems, others, find, normal = [], [], self.parts.findall, self.tokenizer.normalizer.normalize_str
        for w in seen:
            if not w:  # beside white space at the ends of a text
                near[w] = b""
                continue
            if not plain:
                parts = find(normal(w))
            elif (ids := memo.get(w)) is not None:
                near[w] = ids
                continue
            elif w.isalpha():
                stems.append(w)
                continue
            elif w[-1] in ",.;:!?" and (stem := w[:-1]).isalpha():
                parts = (stem, w[-1])
            else:
                parts = find(w)
            new.update(parts)
            others.append((w, parts))
        new.update(stems)
        self._learn([p for p in new if p not in memo])
        for w in stems:
            near[w] = memo[w]
        for w, parts in others:
            near[w] = b"".join([memo[p] for p in parts])
        return near


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, so that words are kept from task to task."""
    return common.kept(f"encoder {path}", lambda: Encoder(path))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, memo: int = MEMO, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, and of shorter pieces the checksums of its powers of two."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    sizes = [1 << k for k in range(capacity.bit_length() - 1, -1, -1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = encoder(path)
        tok.most = memo
        for batch in batches:
            for part in common.slices_of(batch, "text", slice_bytes):
                common.trim()
                rows = []
                encoded = tok.encode([t or "" for t in part.column("text").to_pylist()])
                for doc, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        n, at, crcs = len(piece) // 4, 0, []
                        for size in sizes if n < capacity else ():
                            if n & size:
                                crcs.append(zlib.crc32(piece[4 * at : 4 * (at + size)]))
                                at += size
                        rows.append((doc, start, n, zlib.crc32(piece), total, crcs))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], part.column("doc_id").type), *(pa.array(c, pa.int64()) for c in columns[1:5]), pa.array(columns[5], pa.list_(pa.int64()))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "crcs"],
                )

    kept = docs.select("doc_id", "text")
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, crcs array<long>")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """A multiset of the lengths, within their counts, whose sum is the largest up to capacity; longer lengths first.

    Bit s of a bitset is set if some multiset of the lengths so far sums to s. Counts go in as powers of
    two times the length; the bitset before each step is kept to trace the multiset back.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, k = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (take * length)) & full
            left -= take
            k *= 2
        if reach >> capacity & 1:
            break
    total = reach.bit_length() - 1
    out: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + take
            total -= take * length
    return out


def plan(counts: dict[int, int], capacity: int = CAPACITY, slack: int = 16) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Patterns (sequences, first sequence, [(length, copies), ...]); those with more than slack left over are not used.

    At most one pattern for each length: each use takes all of the copies of one of them.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    out, sequence = [], 0
    while left:
        found = fullest(left, capacity)
        if capacity - sum(n * c for n, c in found.items()) > slack:
            break
        times = min(left[n] // c for n, c in found.items())
        out.append((times, sequence, sorted(found.items(), reverse=True)))
        sequence += times
        for n, c in found.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
    return out


def _ranked(parts: DataFrame, rows_per_bucket: int) -> DataFrame:
    """With rank, from 0, among the pieces of the same length; counted by (length, bucket of the id), then within it."""
    total = parts.count()
    buckets = max(1, -(-total // rows_per_bucket))
    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = dealt.withColumn("n", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("n")).drop("bucket", "n", "before")


def _placed(ranked: DataFrame, patterns: list, base: int) -> DataFrame:
    """Left join of pieces with the slot of their rank; sequence_id and offset are null where there is none."""
    slots, used = [], {}
    for times, sequence, found in patterns:
        offset = 0
        for length, copies in found:
            low = used.get(length, 0)
            slots.append((length, low, low + copies * times, copies, base + sequence, offset))
            used[length] = low + copies * times
            offset += length * copies
    spark = ranked.sparkSession
    # At most lengths x pieces in a window rows, whatever the input: bounded by the window alone.
    table = spark.createDataFrame(slots, "len long, low long, high long, copies long, first_sequence long, first_offset long")
    at = F.col("rank") - F.col("low")
    joined = ranked.join(F.broadcast(table), (F.col("length") == F.col("len")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left")
    return joined.select(
        *ranked.columns,
        (F.col("first_sequence") + F.expr("(rank - low) div copies")).alias("sequence_id"),
        (F.col("first_offset") + at % F.col("copies") * F.col("length")).alias("offset"),
    )


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, slack: int = 16, rows_per_bucket: int = 20_000, memo: int = MEMO, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece.

    capacity must be a power of two. memo and slice_bytes trade a worker's memory for time. The counts by length, at most capacity of them, come to the driver.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    cut = common.materialize(pieces(docs, path, capacity, memo, slice_bytes))
    counts = {int(r["length"]): int(r["count"]) for r in cut.groupBy("length").count().collect()}
    patterns = plan(counts, capacity, slack)
    used = sum(times for times, _, _ in patterns)
    first = common.materialize(_placed(_ranked(cut, rows_per_bucket), patterns, 0))
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    whole = first.where(F.col("sequence_id").isNotNull()).select(*columns)

    # What is left is cut into powers of two, largest first; each size fills windows without slack.
    powers = [1 << k for k in range(capacity.bit_length() - 1, -1, -1)]
    bits = F.filter(F.array(*(F.lit(p).cast("long") for p in powers)), lambda p: F.col("length").bitwiseAND(p) != 0)
    rest = first.where(F.col("sequence_id").isNull()).withColumn("sizes", bits)
    rest = rest.select("doc_id", F.col("start").alias("s0"), "doc_tokens", F.col("length").alias("l0"), F.explode(F.arrays_zip("sizes", "crcs")).alias("x"))
    size = F.col("x.sizes")
    # The pieces before this one are those of the larger sizes in the length.
    split = rest.select("doc_id", (F.col("s0") + F.col("l0") - F.col("l0") % (size * 2)).alias("start"), size.alias("length"), F.col("x.crcs").alias("ids_crc32"), "doc_tokens")
    split = common.materialize(split)
    small = {int(r["length"]): int(r["count"]) for r in split.groupBy("length").count().collect()}
    windows, at = [], 0
    for n in sorted(small, reverse=True):
        per = capacity // n
        if small[n] // per:
            windows.append((small[n] // per, at, [(n, per)]))
            at += small[n] // per
    left = {n: small[n] % (capacity // n) for n in small}
    while any(left.values()):  # fewer than one window of each size
        found, room = [], capacity
        for n in sorted(left, reverse=True):
            if c := min(left[n], room // n):
                found.append((n, c))
                left[n] -= c
                room -= c * n
        windows.append((1, at, found))
        at += 1
    return whole.unionByName(_placed(_ranked(split, rows_per_bucket), windows, used).select(*columns))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"), tokenizer_path())


def pack_documents(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, as pieces in sequences of at most 4096 ids."""
    with common.small_batches(spark):
        return pack(docs, tokenizer_path(), memo=SMALL_MEMO, slice_bytes=SMALL_SLICE_BYTES)
