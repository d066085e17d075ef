"""Toxicity by a weighted lexicon that an Aho-Corasick automaton finds in folded text.

Folding undoes disguises: letters are lower-cased, accents and look-alike letters of other scripts
become Latin, digits and signs that stand for letters become those letters, and i, l, 1, ! and | are
one class. The lexicon holds word beginnings with weights: a short list of insults and those that
labelled rows show to mark toxic text. Hits inside an exception phrase don't count. The weight found,
by itself and per words of the text, becomes a score by a logistic curve fitted on labelled rows.

Null and empty texts have no hits and get the score of the intercept; very long ones are read whole. Of
hits that start at the same place the first to end counts once. Every input row gives one row, repeated
rows too, an empty table none; columns other than doc_id and text are not read, so their names clash with
nothing.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MOD, HELD_OUT = 5, 0

#: Insults that count before any label is seen, and harmless phrases that hold one.
SEED_WORDS = (
    "asshole", "bastard", "bitch", "cretin", "dickhead", "dumbass", "fuck", "idiot", "imbecile", "moron",
    "motherfucker", "retard", "scumbag", "shithead", "slut", "stupid", "whore", "worthless",
)
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "worthless check", "idiot proof", "idiot light")
#: Letters of other scripts that look Latin, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "һ": "h", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ß": "b", "ı": "i", "ø": "o", "đ": "d", "ł": "i", "æ": "a", "œ": "o",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i", "€": "e"}
INVISIBLE = ("​", "‌", "‍", "⁠", "﻿", "­")


def _folding() -> dict[int, str]:
    out: dict[int, str] = {}
    for cp in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        c = unicodedata.normalize("NFKD", chr(cp).lower())[:1]
        c = LOOKALIKES.get(c, c)
        c = SIGNS.get(c, c)
        if c != chr(cp):
            out[cp] = c
    for table in (LOOKALIKES, SIGNS):
        for k, v in table.items():
            out[ord(k)] = SIGNS.get(v, v)
    for c in "\t\n\x0b\x0c\r\xa0":
        out[ord(c)] = " "
    return out


FOLD = _folding()
#: Signs that end a word are punctuation, not letters in disguise.
_TRAILING = re.compile(r"[!|$@€]+(?!\w)")
_DROP = dict.fromkeys(map(ord, INVISIBLE))


def fold(text: str) -> str:
    """The folded text; as long as the visible text, so places in one are places in the other."""
    return visible(text).translate(FOLD)


def visible(text: str) -> str:
    return text if text.isascii() or not any(c in text for c in INVISIBLE) else text.translate(_DROP)


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    beta: tuple[float, float, float] = (1.0, 1.0, -2.0)
    automata: list = field(default_factory=list, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "beta": self.beta, "automata": []}

    def automaton(self):
        import ahocorasick

        if not self.automata:
            a = ahocorasick.Automaton()
            for phrase in self.exceptions:
                a.add_word(fold(phrase), (len(phrase), None))
            for stem, w in self.weights.items():
                a.add_word(fold(stem), (len(stem), w))
            a.make_automaton()
            self.automata.append(a)
        return self.automata[0]

    def hits(self, text: str) -> tuple[int, float, int]:
        """(hits, their weight, words). A hit starts where a word starts; of nested hits the first to end counts."""
        seen = visible(text)
        n_words = len(seen.split())
        if not seen or not self.weights:
            return 0, 0.0, n_words
        found, safe = [], []
        for end, (size, w) in self.automaton().iter(seen.translate(FOLD)):
            start = end - size + 1
            if start and seen[start - 1].isalnum():
                continue
            if w is None:
                safe.append((start, end))
            else:
                found.append((start, end, w))
        # both lists are in the order of ends: the first start of all phrases that end no earlier than a hit
        ends, first = [b for _, b in safe], list(accumulate((a for a, _ in reversed(safe)), min))[::-1]
        n, weight, last = 0, 0.0, -1
        for start, end, w in found:
            k = bisect_left(ends, end)
            if start == last or k < len(ends) and first[k] <= start:
                continue
            n, weight, last = n + 1, weight + w, start
        return n, weight, n_words

    def features(self, weight: float, n_words: int) -> tuple[float, float]:
        return math.log1p(weight), math.log1p(100 * weight / (n_words + 20))


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class by the beginnings, of 4 letters and more, of their folded words."""
    counts = (Counter(), Counter())
    docs = [0, 0]
    for batch in batches:
        for part in common.slices(batch):
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                words = set("".join(c if c.isalnum() else " " for c in fold(_TRAILING.sub(" ", text))).split())
                counts[label].update({w[:k] for w in words for k in range(4, min(len(w), 16) + 1)} | words)
                docs[label] += 1
    keys = sorted(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_pydict({
        "stem": pa.array([*keys, ""], pa.string()),
        "toxic": pa.array([*(counts[1][k] for k in keys), docs[1]], pa.int64()),
        "clean": pa.array([*(counts[0][k] for k in keys), docs[0]], pa.int64()),
    })


def _pick(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Of nested beginnings the longest that keeps nearly all documents of the shorter, then none that extends another."""
    rows = sorted(rows)
    most = dict.fromkeys((s for s, _, _ in rows), 0)
    for s, a, _ in rows:
        for k in range(1, len(s)):
            if (p := s[:k]) in most:
                most[p] = max(most[p], a)
    out: dict[str, float] = {}
    for s, a, b in sorted(rows, key=lambda r: len(r[0])):
        if most[s] < 0.95 * a and not any(s[:k] in out for k in range(1, len(s))):
            out[s] = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 4000, max_stems: int = 2000, min_g2: float = 25.0) -> ToxicityModel:
    """Learns weights and curve from at most per_class labelled rows of either class, none of the held-out fold.

    A word beginning joins the lexicon if its log-likelihood ratio against chance is min_g2 or more and it
    is at least 8 times as frequent in toxic rows; the max_stems with the largest ratio stay. What comes
    to the driver is bounded by max_stems and per_class. Without labels of both classes the seed words
    and a fixed curve are used.
    """
    sample = common.materialize(common.labelled_sample(docs, labels, "toxic", MOD, HELD_OUT, per_class))
    counts = sample.select("text", "label").mapInArrow(_count_stems, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    totals = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    n_toxic, n_clean = int(totals[0]), int(totals[1] - totals[0])
    weights = {fold(w): 3.0 for w in SEED_WORDS}
    if n_toxic and n_clean:
        a, b = F.col("a").cast("double"), F.col("b").cast("double")
        share = n_toxic / (n_toxic + n_clean)
        g2 = 2 * (a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0))
        strong = (
            counts.where((F.col("stem") != "") & (F.col("a") >= 3) & ((a + 0.5) / (n_toxic + 1) >= 8 * (b + 0.5) / (n_clean + 1)))
            .withColumn("g2", g2)
            .where(F.col("g2") >= min_g2)
            .orderBy(F.desc("g2"), "stem")
            .limit(max_stems)
        )
        learnt = _pick([(r.stem, r.a, r.b) for r in strong.collect()], n_toxic, n_clean)
        weights |= learnt
    model = ToxicityModel(weights)
    rows = score(sample, model, keep=("label",)).select("label", "weight", "n_words").collect()
    x = np.array([model.features(r.weight, r.n_words) for r in rows]).reshape(-1, 2)
    beta = common.logistic_fit(x, np.array([r.label for r in rows]), common.class_counts(labels, "toxic", MOD, HELD_OUT))
    return model if beta is None else ToxicityModel(weights, beta=tuple(float(b) for b in beta))


def _scores(model: ToxicityModel, texts: pa.Array) -> tuple[list[tuple[int, float, int]], np.ndarray]:
    found = [model.hits(t or "") for t in texts.to_pylist()]
    x = np.array([model.features(w, n) for _, w, n in found]).reshape(-1, 2)
    return found, common.sigmoid(x @ np.array(model.beta[:2]) + model.beta[2])


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the kept columns, n_hits, weight, n_words and score of every row."""
    columns = ["doc_id", *(c for c in keep if c != "doc_id"), "text"]
    kept = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                found, p = _scores(model, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in columns[:-1]), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64()), pa.array(p, pa.float64())],
                    names=[*columns[:-1], "n_hits", "weight", "n_words", "score"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("text").schema)
    return kept.mapInArrow(run, f"{schema}, n_hits long, weight double, n_words long, score double")


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(common.id_remainder(F.col("doc_id"), MOD) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_hits",
        "n_words",
    )


def reject_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is under one half, with their columns."""
    model = fit(docs, common.table(spark, sf_dir, "labels"))

    @F.arrow_udf("double")  # the other columns stay in the JVM
    def toxic(texts: pa.Array) -> pa.Array:
        common.release()
        parts = [_scores(model, texts.slice(i, 256))[1] for i in range(0, len(texts), 256)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return docs.withColumn("__score", toxic("text")).where("__score < 0.5").drop("__score")
