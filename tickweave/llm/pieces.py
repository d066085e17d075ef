"""SentencePiece encoding and decoding, with giant documents encoded in parallel chunks.

The ids are those of the sentencepiece library for a BPE model with byte fallback. A row of pieces is the
encoding of a text if and only if every two neighbours are the encoding of the two joined together, so
encoding is a path problem: nodes are places where a piece stands, an edge weighs 0 if its two pieces are
such neighbours and minus infinity if not, and the encoding is the one path of weight 0.

A giant document is cut into chunks of fixed length. The state at a cut is the piece that holds the
character before it. Each chunk by itself makes the max-plus matrix of the best weight from every state
at its start to every state at its end; matrices are combined associatively, which gives the state at
each cut; then each chunk traces its own pieces back between its two states. Paths always part at a white
space that follows another character and around newlines, so between the first and the last of these in
a chunk words are encoded one by one (and kept), and only what is before and after goes through matrices.

Null and empty texts have no ids, an empty table gives no rows. Every row gives its rows, repeated rows too. U+2581 is white space to
the model, as to the library. Columns beside doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
_UNIT = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
MEMO = 400_000
State = tuple[int, int]


class PieceModel:
    """Encodes words, traces paths and decodes; one for each Python worker."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.raw: list[bytes] = [b""] * n
        for i in range(n):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i)):
                self.raw[i] = piece.encode()
                self.ids[piece] = i
        self.bytes = {self.raw[i]: i for i in range(n) if self.sp.is_byte(i)}
        self.longest = max(map(len, self.ids))
        self.memo: dict[str, bytes] = {}
        self.neighbours = lru_cache(200_000)(self._neighbours)

    def prepared(self, text: str) -> str:
        """As the model sees it: a white space before, white space as U+2581."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _library(self, units: list[str]) -> list[list[int]]:
        # behind a newline, which no piece holds, a unit is encoded as it stands; the newline's own ids go
        return [ids[2:] for ids in self.sp.encode(["\n" + u for u in units])]

    def units(self, prepared: list[str]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit bytes, of texts that start and end where paths part."""
        rows = [_UNIT.findall(t) for t in prepared]
        if len(self.memo) > MEMO:
            self.memo.clear()
        new = list({u for row in rows for u in row if u not in self.memo})
        for u, ids in zip(new, self._library(new), strict=True):
            self.memo[u] = np.array(ids, dtype="<u4").tobytes()
        return [b"".join(map(self.memo.__getitem__, row)) for row in rows]

    def _neighbours(self, a: str, b: str) -> bool:
        return self.merged(a + b) == [a, b]

    @lru_cache(200_000)  # noqa: B019
    def _rank(self, piece: str) -> float | None:
        i = self.ids.get(piece)
        return None if i is None else self.sp.get_score(i)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best neighbouring pair is merged until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._rank(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def spans(self, text: str, start: int, stop: int) -> list[int]:
        """Ends of the pieces that start at start and end by stop; one character always is a piece."""
        return [j for j in range(start + 1, min(stop, start + self.longest) + 1) if j == start + 1 or text[start:j] in self.ids]

    def states(self, text: str, cut: int) -> list[State]:
        """Pieces that hold the character before the cut, as characters before and behind it."""
        return [(cut - i, j - cut) for i in range(max(0, cut - self.longest), cut) for j in self.spans(text, i, len(text)) if j >= cut]

    def id_bytes(self, piece: str) -> bytes:
        i = self.ids.get(piece)
        ids = [i] if i is not None else [self.bytes[bytes([b])] for b in piece.encode("utf-8", "replace")]
        return np.array(ids, dtype="<u4").tobytes()

    def decoded(self, ids: bytes) -> bytes:
        """The prepared text's UTF-8."""
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _walk(m: PieceModel, text: str, begin: dict[State, int], stop: int, limit: int) -> dict[int, list[tuple[int, int, list]]]:
    """ends[j]: (i, bits, steps before) of the pieces i..j that a path reaches from the beginnings.

    begin maps spans to bits, one for each state to start from; a span (i, i) is a place where paths part.
    Pieces that start before stop are followed, up to limit.
    """
    ends: dict[int, list[tuple[int, int, list]]] = {}
    for (i, j), bits in begin.items():
        ends.setdefault(j, []).append((i, bits, []))
    if not begin:
        return ends
    for at in range(min(j for _, j in begin), stop):
        if at not in ends:
            continue
        for j in m.spans(text, at, limit):
            bits, via = 0, []
            for step in ends[at]:
                if step[0] == at or m.neighbours(text[step[0] : at], text[at:j]):
                    bits |= step[1]
                    via.append(step)
            if bits:
                ends.setdefault(j, []).append((at, bits, via))
    return ends


def _parts(text: str, left: int, right: int) -> tuple[int, int] | None:
    """The first and last place from left to right where paths part."""
    found = [i for i in range(max(left, 1), right + 1) if i < len(text) and (text[i - 1] == "\n" or text[i] == "\n" or text[i] == SPACE != text[i - 1])]
    return (found[0], found[-1]) if found else None


def transfer(m: PieceModel, text: str, left: int, right: int, first: bool, last: bool) -> np.ndarray:
    """Max-plus matrix from the states at left to those at right of the text, which has context around both."""
    entries = [(left, left)] if first else [(left - a, left + b) for a, b in m.states(text, left)]
    exits = [(right - a, right + b) for a, b in m.states(text, right)] if not last else None
    out = np.full((len(entries), 1 if last else len(exits)), -np.inf, dtype=np.float32)
    begin = {e: 1 << k for k, e in enumerate(entries)}
    parts = _parts(text, left + m.longest, right - 1)

    def fill(ends: dict, bits_of) -> None:
        for k, (i, j) in enumerate([(None, right)] if last else exits):
            for start, bits, _ in ends.get(j, ()):
                if i is None or start == i:
                    for e in range(len(entries)):
                        if bits_of(bits) >> e & 1:
                            out[e, k] = 0

    if parts:
        reached = 0
        for _, bits, _ in _walk(m, text, begin, parts[0], parts[0]).get(parts[0], ()):
            reached |= bits
        fill(_walk(m, text, {(parts[1], parts[1]): 1}, right, len(text)), lambda bits: reached if bits else 0)
    else:
        fill(_walk(m, text, begin, right, len(text)), lambda bits: bits)
    return out


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product, which is associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at the end of each chunk on the best path: products from the front and from the back meet there."""
    front = [matrices[0]]
    for x in matrices[1:]:
        front.append(combine(front[-1], x))
    back, out = np.zeros((matrices[-1].shape[1], 1), dtype=np.float32), []
    for k in range(len(matrices) - 1, -1, -1):
        out.append(int((front[k][0] + back[:, 0]).argmax()))
        back = combine(matrices[k], back)
    return out[::-1]


def trace(m: PieceModel, text: str, entry: State, exit_: State) -> bytes:
    """Ids of the pieces after the entry piece up to the exit piece, both places (start, end) in the text."""

    def path(ends: dict, i: int | None, j: int) -> list[bytes]:
        out: list[bytes] = []
        steps = [s for s in ends.get(j, ()) if i is None or s[0] == i]
        while steps and steps[0][2]:
            out.append(m.id_bytes(text[steps[0][0] : j]))
            j, steps = steps[0][0], steps[0][2]
        return out[::-1]

    if entry == exit_:
        return b""
    parts = _parts(text, max(entry[1], entry[0] + m.longest), exit_[0])
    if not parts:
        return b"".join(path(_walk(m, text, {entry: 1}, exit_[0] + 1, exit_[1]), exit_[0], exit_[1]))
    head = path(_walk(m, text, {entry: 1}, parts[0], parts[0]), None, parts[0])
    tail = path(_walk(m, text, {(parts[1], parts[1]): 1}, exit_[0] + 1, exit_[1]), exit_[0], exit_[1])
    return b"".join([*head, *m.units([text[parts[0] : parts[1]]]), *tail])


_OUT = "chunk int, n_ids long, ids array<int>, ids_crc32 long, round_trip boolean"


def _row(ids: bytes, whole: bool) -> tuple[int, np.ndarray, int, bool]:
    return len(ids) // 4, np.frombuffer(ids, dtype="<i4"), zlib.crc32(ids), whole


def encode(docs: DataFrame, path: str, chunk: int = 32768) -> DataFrame:
    """doc_id, chunk, n_ids, ids, their checksum and whether decoding them gives the text back.

    Documents of up to chunk characters are one row. Longer ones have a row for each chunk; its ids are
    those after the piece that crosses into it. The matrices of a document, at most one for each chunk
    of a single row's text, are combined in one task.
    """
    around = model(path).longest  # no piece reaches farther over a cut
    if chunk < 4 * around:
        raise ValueError(f"chunks must have {4 * around} characters or more for this model")
    kept = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for part in common.slices(batch, 128):
                texts = [m.prepared(t) for t in part.column("text").to_pylist()]
                rows = [_row(ids, m.decoded(ids) == t.encode("utf-8", "replace")) for t, ids in zip(texts, m.units(texts), strict=True)]
                n, ids, crc, same = list(zip(*rows, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([0] * len(rows), pa.int32()), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "chunk", "n_ids", "ids", "ids_crc32", "round_trip"])

    small = kept.where(F.length("text") <= chunk).mapInArrow(short, f"doc_id {kind}, {_OUT}")

    giants = kept.where(F.length("text") > chunk).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    giants = giants.select("doc_id", "copies", F.xxhash64("text").alias("row"), F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE))).alias("t"))
    cuts = giants.select("doc_id", "copies", "row", "t", F.length("t").alias("size"), F.explode(F.sequence(F.lit(0), F.floor((F.length("t") - 1) / chunk).cast("int"))).alias("chunk"))
    start = F.col("chunk") * chunk
    begin = F.greatest(start - around, F.lit(0))
    left = start - begin
    chunks = cuts.select(
        "doc_id", "row", "copies", "chunk", F.substring("t", begin + 1, left + chunk + around).alias("t"), left.cast("int").alias("left"),
        (left + F.least(F.lit(chunk), F.col("size") - start)).cast("int").alias("right"), (start + chunk >= F.col("size")).alias("last"),
    )
    chunks = common.materialize(chunks)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for pdf in batches:
            made = [transfer(m, r.t, r.left, r.right, r.chunk == 0, r.last) for r in pdf.itertuples()]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "row": pdf["row"], "chunk": pdf["chunk"], "rows": [x.shape[0] for x in made], "matrix": [x.tobytes() for x in made]})

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        made = [np.frombuffer(b, dtype=np.float32).reshape(n, -1) for b, n in zip(pdf["matrix"], pdf["rows"], strict=True)]
        ends = cut_states(made)
        return pd.DataFrame({"doc_id": pdf["doc_id"], "row": pdf["row"], "chunk": pdf["chunk"], "entry": [0, *ends[:-1]], "exit": ends})

    made = chunks.mapInPandas(matrices, f"doc_id {kind}, row long, chunk int, rows int, matrix binary")
    states = made.groupBy("doc_id", "row").applyInPandas(resolve, f"doc_id {kind}, row long, chunk int, entry int, exit int")
    named = states.select(F.col("doc_id").alias("d"), F.col("row").alias("r"), F.col("chunk").alias("c"), "entry", "exit")
    joined = chunks.join(named, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")) & (F.col("chunk") == F.col("c"))).drop("d", "r", "c")

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                entry = (r.left, r.left) if r.chunk == 0 else [(r.left - a, r.left + b) for a, b in m.states(r.t, r.left)][r.entry]
                exits = [(r.right - a, r.right + b) for a, b in m.states(r.t, r.right) if not r.last or b == 0]
                if r.last:  # the one piece that ends the text on a path from the entry
                    ends = _walk(m, r.t, *_tail(m, r.t, entry, r.right)).get(r.right, ())
                    exits = [(s[0], r.right) for s in ends]
                ids = trace(m, r.t, entry, exits[0 if r.last else r.exit])
                got = m.decoded(ids) == r.t[entry[1] : exits[0 if r.last else r.exit][1]].encode("utf-8", "replace")
                rows += [(r.doc_id, r.chunk, *_row(ids, got))] * r.copies
            yield pd.DataFrame(rows, columns=["doc_id", "chunk", "n_ids", "ids", "ids_crc32", "round_trip"])

    return small.unionByName(joined.mapInPandas(traced, f"doc_id {kind}, {_OUT}"))


def _tail(m: PieceModel, text: str, entry: State, stop: int) -> tuple[dict[State, int], int, int]:
    """Where to walk from to the end of a text."""
    parts = _parts(text, max(entry[1], entry[0] + m.longest), stop - 1)
    return ({(parts[1], parts[1]): 1} if parts else {entry: 1}), stop, stop


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, chunk and text of rows of ids; the texts of a document's chunks, joined in order, are its text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for pdf in batches:
            texts = []
            for chunk, ids in zip(pdf["chunk"], pdf["ids"], strict=True):
                t = m.decoded(np.asarray(ids, dtype="<u4").tobytes()).decode("utf-8", "replace").replace(SPACE, " ")
                texts.append(t[1:] if chunk == 0 and t.startswith(" ") else t)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "chunk": pdf["chunk"], "text": texts})

    return encoded.select("doc_id", "chunk", "ids").mapInPandas(run, f"doc_id {kind}, chunk int, text string")


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """For each row of ids its number, checksum and whether decoding gives the text back."""
    return encode(common.table(spark, sf_dir, "documents"), model_path()).drop("ids")
