"""Alignment of two tokenizers' tokens: which tokens cover the same bytes, and how many documents link each pair of ids.

A text, with a space before it, is cut by both tokenizers. Bytes where tokens of both end cut it into groups, and
every token of A in a group is linked with every token of B in it. The pairs of ids that a document links are packed
into int64 keys and written with the document; how many documents link each is counted by count_shards over the whole corpus, and
a pass over the written keys looks the counts up in the memory-mapped shards.

Both tokenizers part at a run of spaces and newlines behind another character, so such units are cut by themselves,
each once a worker as long as it is kept, and groups never cross them. A text with other white space, with a character that A's two
libraries aren't known to treat alike, or under other files than this holds for, is one unit.

Texts that are null or empty, or that the tokens of either side don't give back, have no tokens: numbers are 0 and
groups ''. Each row counts as a document, rows of a repeated doc_id too. Very long texts are read whole. An empty
table gives no rows. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .count_shards import PartialCounts, summed, write_shards
from .packing import KNOWN

SPACE = "▁"
UNITS = re.compile("[ \n]+[^ \n]*|[^ \n]+")
PLAIN = re.compile(f"[{KNOWN}]*")
ODD_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The pre-tokenizer that A's file must state for units to be cut by themselves, and its pattern.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Units that a worker keeps, the longest of them in characters, and bytes of text that it reads at a time.
MEMO, LONGEST, SLICE_BYTES = 300_000, 200, 2_000_000
#: Id pairs of a group that are written out one by one; larger groups are counted by their distinct ids.
SPELLED_OUT = 4096
#: Units that are given to a tokenizer at once.
TOGETHER = 64


def _byte_names() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [i for i in range(256) if i not in printing]
    return {chr(i): i for i in printing} | {chr(256 + n): x for n, x in enumerate(rest)}


class ByteTokens:
    """Token ids and bytes of a byte-level tokenizer file."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        names, model = _byte_names(), said["model"]
        self.raw = [b""] * self.whole.get_vocab_size(with_added_tokens=True)
        for token, i in self.whole.get_vocab(with_added_tokens=True).items():
            self.raw[i] = bytes(names[c] for c in token) if all(c in names for c in token) else token.encode()
        self.size = np.array([len(r) for r in self.raw], dtype=np.int64)
        added = {x["id"] for x in said.get("added_tokens") or []}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges") or []]
        made = [model["vocab"][x + y] for x, y in pairs]
        whole = {i for i, r in enumerate(self.raw) if len(r) == 1} | set(made) | added == set(range(len(self.raw)))
        special = all(x.get("special") for x in said.get("added_tokens") or [])
        #: Ids are merge ranks too, so units may be cut by the faster library.
        self.parts = whole and special and made == sorted(set(made)) and said.get("normalizer") is None and said.get("pre_tokenizer") == BYTE_LEVEL and not model.get("ignore_merges")
        ranks = {self.raw[i]: i for i in range(len(self.raw)) if i not in added} if self.parts else {}
        self.fast = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if self.parts else None

    def units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, one after another, and how many each has. All but those that end in white space, which would go on in the next, are cut in one go."""
        open_ = np.array([u[-1] in " \n" for u in units], dtype=bool)
        closed = [u for u, x in zip(units, open_.tolist(), strict=True) if not x]
        ids = np.array(self.fast.encode_ordinary("".join(closed)), dtype=np.int64)
        stops = np.cumsum([len(u.encode()) for u in closed])
        sizes = np.zeros(len(units), dtype=np.int64)
        sizes[~open_] = np.diff(np.searchsorted(np.cumsum(self.size[ids]), stops) + 1, prepend=0)
        at = np.cumsum(sizes)
        for i in np.flatnonzero(open_)[::-1].tolist():
            now = self.fast.encode_ordinary(units[i])
            ids = np.insert(ids, at[i], now)
            sizes[i] = len(now)
        return ids, sizes

    def text(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """Token ids and bytes of a SentencePiece file."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.raw = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size = np.array([len(r) for r in self.raw], dtype=np.int64)
        self.newline = next((i for i, r in enumerate(self.raw) if self.sp.is_byte(i) and r == b"\n"), -1)
        plain = [p for i, p in enumerate(pieces) if not self.sp.is_byte(i)]
        alone = self.sp.encode("\n") == [self.sp.piece_to_id(SPACE), self.newline]
        #: No piece reaches over a unit's start, and a newline is a piece of its own.
        self.parts = alone and not any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)

    def units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that stand behind other characters, one after another, and how many each has: they are encoded between newlines."""
        texts = ["\n" + "\n".join(units[i : i + TOGETHER]) for i in range(0, len(units), TOGETHER)]
        ids = np.array([x for t in self.sp.encode(texts) for x in (*t, -1)], dtype=np.int64)
        mark = (ids == self.newline) | (ids == -1)
        cuts = np.flatnonzero(mark)
        # a unit begins behind the newline that is put before it, and goes on over those of its own
        own = np.array([1 + u.count("\n") for u in units], dtype=np.int64)
        begin = np.cumsum(own) - own + np.arange(len(units)) // TOGETHER
        first, after = cuts[begin], cuts[begin + own]
        sizes = after - first - 1
        at = np.repeat(first + 1 - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return ids[at], sizes

    def text(self, spaced: str) -> list[int]:
        return self.sp.encode(spaced[1:])


class Tokens:
    """Units, their ids, groups and id pairs; one for each Python worker and pair of files."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        # an id before another of its side, the last of A's in a group, the last of B's
        self.names = [f"{i}{mark}" for t, last in ((self.a, "|"), (self.b, ";")) for mark in (",", last) for i in range(len(t.raw))]
        self.bits = max((len(t.raw) - 1).bit_length() for t in (self.a, self.b))
        self.at: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.at.clear()
        self.long = 0  # characters of units that are not kept
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 5), dtype=np.int64)  # n_a, n_b, n_groups, n_links, 1 if a side doesn't give the unit back
        self.cuts, self.keys, self.times = np.zeros(1, dtype=np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def split(self, text: str, whole: set[str]) -> list[str]:
        """Units of a text that has a space before it; a text that is one is added to whole."""
        if self.a.parts and self.b.parts and PLAIN.fullmatch(text) and not ODD_SPACE.search(text):
            return UNITS.findall(text)
        whole.add(text)
        return [text]

    def pairs(self, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups of tokens whose last bytes are given: the groups of either side's tokens, unit ends among them."""
        mark = np.zeros(int(ends_a[-1]) + 1, dtype=bool)
        mark[ends_a] = True
        both = np.zeros(len(mark), dtype=np.int64)
        both[ends_b[mark[ends_b]]] = 1
        group = np.cumsum(both)
        return group[ends_a - 1], group[ends_b - 1]

    def links(self, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group, key and number of every pair of ids that a group links; pairs may repeat."""
        n = int(group_a[-1]) + 1
        n_a, n_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        large = n_a * n_b > SPELLED_OUT
        first = np.cumsum(n_b) - n_b
        left = np.flatnonzero(~large[group_a])
        reach = n_b[group_a[left]]
        place = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
        g = np.repeat(group_a[left], reach)
        found = [(g, np.repeat(ids_a[left], reach) << 32 | ids_b[first[g] + place], np.ones(len(g), dtype=np.int64))]
        for x in np.flatnonzero(large).tolist():
            u, c = np.unique(ids_a[group_a == x], return_counts=True)
            v, d = np.unique(ids_b[group_b == x], return_counts=True)
            found.append((np.full(len(u) * len(v), x), (u[:, None] << 32 | v[None, :]).ravel(), (c[:, None] * d[None, :]).ravel()))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def _ids(self, units: list[str], whole: set[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For either side the ids of all units and how many each has."""
        alone = [len(u) > LONGEST or u in whole for u in units]
        short = [u for u, x in zip(units, alone, strict=True) if not x]
        together = [t.units(short) for t in (self.a, self.b)] if short else [(np.empty(0, np.int64),) * 2] * 2
        if len(short) == len(units):
            return together
        out = []
        for t, (ids, sizes) in zip((self.a, self.b), together, strict=True):
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            rows, k = [], 0
            for u, x in zip(units, alone, strict=True):
                if not x:
                    rows.append(ids[cuts[k] : cuts[k + 1]])
                    k += 1
                elif t is self.b and u[:1] != " ":
                    rows.append(t.units([u])[0])
                else:
                    rows.append(np.array(t.text(u), dtype=np.int64))
            out.append((np.concatenate(rows), np.array([len(r) for r in rows], dtype=np.int64)))
        return out

    def _bad(self, units: list[str], sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Units that a side's tokens don't give back."""
        raw = [u.encode() for u in units]
        bad = np.zeros(len(units), dtype=bool)
        for t, (ids, sizes) in zip((self.a, self.b), sides, strict=True):
            pieces = list(map(t.raw.__getitem__, ids.tolist()))
            size = np.array([len(r) for r in raw])
            ends = np.cumsum(sizes)
            same = np.array_equal(_sums(t.size[ids], ends), size) and b"".join(pieces) == b"".join(raw)
            if not same:
                stops = ends.tolist()
                bad |= np.array([b"".join(pieces[x:y]) != r for x, y, r in zip([0, *stops[:-1]], stops, raw, strict=True)])
        return bad

    def learn(self, units: list[str], whole: set[str]) -> None:
        """Cuts new units and keeps what they add to a document."""
        sides = self._ids(units, whole)
        bad = self._bad(units, sides)
        numbers = np.zeros((len(units), 5), dtype=np.int64)
        numbers[:, 4] = bad
        sizes = np.zeros(len(units), dtype=np.int64)
        keys = times = np.empty(0, np.int64)
        texts = [""] * len(units)
        if not bad.all():
            if bad.any():
                sides = [(ids[np.repeat(~bad, n)], n[~bad]) for ids, n in sides]
            kept = np.flatnonzero(~bad)
            (flat_a, n_a), (flat_b, n_b) = sides
            group_a, group_b = self.pairs(np.cumsum(self.a.size[flat_a]), np.cumsum(self.b.size[flat_b]))
            upto = group_a[np.cumsum(n_a) - 1] + 1
            n_groups = np.diff(upto, prepend=0)
            owner = np.repeat(np.arange(len(kept)), n_groups)  # unit of each group
            for u, text in zip(kept.tolist(), self._spelled(flat_a, flat_b, group_a, group_b, n_a + n_b), strict=True):
                texts[u] = text
            g, k, t = self.links(flat_a, flat_b, group_a, group_b)
            u = owner[g]
            numbers[kept, :4] = np.stack([n_a, n_b, n_groups, np.bincount(u, weights=t, minlength=len(kept)).astype(np.int64)], axis=1)
            order = np.argsort(u, kind="stable")
            unit, keys, times = kept[u[order]], k[order], t[order]
            sizes = np.bincount(unit, minlength=len(units))
        self.at.update(zip(units, range(len(self.groups), len(self.groups) + len(units)), strict=True))
        self.groups += texts
        self.numbers = np.concatenate([self.numbers, numbers])
        self.cuts = np.concatenate([self.cuts, self.cuts[-1] + np.cumsum(sizes)])
        self.keys, self.times = np.concatenate([self.keys, keys]), np.concatenate([self.times, times])

    def _spelled(self, flat_a, flat_b, group_a, group_b, n: np.ndarray) -> Iterator[str]:
        """Each unit's groups as text; n: tokens of both sides in a unit."""
        size_a, size_b = len(self.a.raw), len(self.b.raw)
        last_a = np.concatenate([group_a[1:] != group_a[:-1], [True]])
        last_b = np.concatenate([group_b[1:] != group_b[:-1], [True]])
        upto_a, upto_b = np.searchsorted(group_a, np.arange(group_a[-1] + 2)), np.searchsorted(group_b, np.arange(group_b[-1] + 2))
        codes = np.empty(len(flat_a) + len(flat_b), dtype=np.int64)
        codes[np.arange(len(flat_a)) + upto_b[group_a]] = flat_a + size_a * last_a
        codes[np.arange(len(flat_b)) + upto_a[group_b + 1]] = flat_b + 2 * size_a + size_b * last_b
        parts = list(map(self.names.__getitem__, codes.tolist()))
        stops = np.cumsum(n).tolist()
        return ("".join(parts[x:y])[:-1] for x, y in zip([0, *stops[:-1]], stops, strict=True))

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of all units of the texts, one after another, and where each text's end; none for texts without tokens."""
        if len(self.at) > MEMO or self.long > SLICE_BYTES:
            self.clear()
        whole: set[str] = set()
        rows = [self.split(" " + t, whole) if t and SPACE not in t else [] for t in texts]
        flat = list(chain.from_iterable(rows))
        n = np.array([len(r) for r in rows], dtype=np.int64)
        index = np.fromiter(map(self.at.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        missing = np.flatnonzero(index < 0).tolist()
        if missing:
            lost = [flat[i] for i in missing]
            new = list(dict.fromkeys(lost))
            self.learn(new, whole)
            index[missing] = list(map(self.at.__getitem__, lost))
            for u in new:
                if len(u) > LONGEST:
                    del self.at[u]
                    self.long += len(u)
        bad = _sums(self.numbers[index, 4], np.cumsum(n)) > 0
        return (index[np.repeat(~bad, n)], np.cumsum(np.where(bad, 0, n))) if bad.any() else (index, np.cumsum(n))


_tokens: dict[tuple[str, str], Tokens] = {}


def tokens(a: str, b: str) -> Tokens:
    if (a, b) not in _tokens:
        _tokens[a, b] = Tokens(a, b)
    return _tokens[a, b]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the values of each text."""
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends] - upto[np.concatenate([[0], ends[:-1]])]


def _expanded(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)


def _document_links(t: Tokens, units: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each document's links end, the links' keys in order, and how often the document has each."""
    doc = np.searchsorted(ends, np.arange(len(units)), side="right")
    pairs, often = np.unique(doc << 32 | units, return_counts=True)
    doc, units = pairs >> 32, pairs & 0xFFFFFFFF
    size = t.cuts[units + 1] - t.cuts[units]
    at = _expanded(t.cuts[units], size)
    keys = t.keys[at]
    packed = np.repeat(doc, size) << 2 * t.bits | keys >> 32 << t.bits | keys & 0xFFFFFFFF
    packed, times = summed(packed, t.times[at] * np.repeat(often, size))
    side = (1 << t.bits) - 1
    keys = (packed >> t.bits & side) << 32 | packed & side
    return np.searchsorted(packed >> 2 * t.bits, np.arange(len(ends)), side="right"), keys, times


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def links(docs: DataFrame, a: str, b: str, with_groups: bool = False) -> DataFrame:
    """Rows of documents (doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups if asked for, and links: the keys and how often each stands, as bytes) and, with a null links, partial counts (key, n)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *_NUMBERS, "groups_sha256", "groups", "links", "key", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokens(a, b)
        done: list[pa.RecordBatch] = []
        id_type = None

        def parts() -> Iterator[np.ndarray]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.column("doc_id").type
                for part in common.slices_of(batch, "text", SLICE_BYTES):
                    units, ends = t.read(part.column("text").to_pylist())
                    values = t.numbers[units]
                    columns = [pa.array(_sums(values[:, i], ends), pa.int64()) for i in range(4)]
                    places = units.tolist()
                    digests, texts = [], []
                    for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                        text = ";".join(map(t.groups.__getitem__, places[x:y]))
                        digests.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                        texts.append(text if with_groups else None)
                    stops, keys, times = _document_links(t, units, ends)
                    stops = stops.tolist()
                    held = [keys[x:y].astype("<i8").tobytes() + times[x:y].astype("<i8").tobytes() for x, y in zip([0, *stops[:-1]], stops, strict=True)]
                    n = len(held)
                    columns += [pa.array(digests, pa.string()), pa.array(texts, pa.string()), pa.array(held, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
                    done.append(pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names))
                    yield keys

        def emptied() -> Iterator[pa.RecordBatch]:
            while done:
                yield done.pop(0)

        def counted(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            blank = [pa.nulls(len(keys), x) for x in (id_type, *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary())]
            return pa.RecordBatch.from_arrays([*blank, pa.array(keys), pa.array(n)], names=names)

        counts = PartialCounts()
        for keys in parts():
            yield from emptied()
            for part in counts.add(keys):
                yield counted(*part)
        for part in counts.end():
            yield counted(*part)

    schema = f"doc_id {kind}, {', '.join(f'{n} long' for n in _NUMBERS)}, groups_sha256 string, groups string, links binary, key long, n long"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def align(docs: DataFrame, a: str, b: str, with_groups: bool = False) -> DataFrame:
    """For each document n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256; with_groups adds the groups themselves, as text.

    Texts are read once, when it is called; their links are written to the shared folder. The driver holds one number for each id of A.
    """
    made = common.materialize(links(docs, a, b, with_groups))
    shards, tops, _, _ = write_shards(made.where("links IS NULL").select("key", "n"), top_shift=32)
    size = max(tops, default=0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros(size, dtype=np.int64)
        best[list(tops)] = list(tops.values())
        for batch in batches:
            for part in common.slices_of(batch, "links", 8 * SLICE_BYTES):
                held = part.column("links").to_pylist()
                both = [np.frombuffer(x, dtype="<i8").reshape(2, -1) for x in held]
                keys, times = np.concatenate(both, axis=1)
                ends = np.cumsum([x.shape[1] for x in both])
                every, where = np.unique(keys, return_inverse=True)
                n = shards.counts(every)
                most = (n == best[every >> 32])[where]
                columns = [part.column(c) for c in part.schema.names if c != "links"]
                columns += [pa.array(_sums(np.where(most, times, 0), ends)), pa.array(_sums(n[where] * times, ends))]
                yield pa.RecordBatch.from_arrays(columns, names=[*(c for c in part.schema.names if c != "links"), "n_best", "count_sum"])

    columns = ["doc_id", *_NUMBERS, "groups_sha256", *(["groups"] if with_groups else [])]
    kinds = ", ".join(f"{c} {made.schema[c].dataType.simpleString()}" for c in columns)
    return made.where("links IS NOT NULL").select(*columns, "links").mapInArrow(run, f"{kinds}, n_best long, count_sum long")


def token_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    return align(common.table(spark, sf_dir, "documents"), token_path("byte_bpe_50k.json"), token_path("piece_bpe_32k.model"))
