"""Quality by compression: how much better a dictionary of good text fits than one of bad text.

Two Zstandard dictionaries are built from labelled rows, one for each class. A text is compressed with
either and with none; the difference of the sizes over the length, the plain size over the length and
the difference over the plain size become a score by a logistic curve, fitted on labelled rows that no
dictionary has seen.

Null and empty texts have differences of 0; very long ones are compressed whole. Rows are taken for the
dictionaries in the order of a hash, ties by the id. Every input row gives one row, repeated rows too, an
empty table none; columns other than doc_id and text are not read, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MOD, HELD_OUT = 3, 1
LEVEL = 3
#: Size of a dictionary, bytes of text that one is built from, and bytes of a training sample.
DICT_BYTES, MAX_SAMPLE_BYTES, SAMPLE_BYTES = 65536, 6_000_000, 1024


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    beta: tuple[float, ...] = (20.0, 0.0, 0.0, 0.0)
    made: list = field(default_factory=list, compare=False)

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "beta": self.beta, "made": []}

    def compressors(self):
        import zstandard

        if not self.made:
            for d in (self.good, self.bad):
                data = zstandard.ZstdCompressionDict(d) if d else None
                if data:
                    data.precompute_compress(level=LEVEL)
                self.made.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False) if data else zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
            self.made.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
        return self.made

    def features(self, text: str) -> tuple[float, float, float]:
        raw = text.encode("utf-8", "replace")
        if not raw:
            return 0.0, 1.0, 0.0
        good, bad, plain = (len(c.compress(raw)) for c in self.compressors())
        return (bad - good) / len(raw), min(1.0, plain / len(raw)), (bad - good) / plain


def _dictionary(pdf: pd.DataFrame) -> pd.DataFrame:
    import zstandard

    parts: list[bytes] = []
    left = MAX_SAMPLE_BYTES
    for text in pdf.sort_values(["order", "doc_id"])["text"]:
        raw = text.encode("utf-8", "replace")
        if raw and left > 0:
            parts += [raw[i : i + SAMPLE_BYTES] for i in range(0, len(raw), SAMPLE_BYTES)]
            left -= len(raw)
    try:
        made = zstandard.train_dictionary(DICT_BYTES, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        made = b"".join(parts)[-DICT_BYTES:]
    return pd.DataFrame({"label": [int(pdf["label"].iloc[0])], "made": [made]})


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> CompressionModel:
    """Builds dictionaries and curve from at most per_class labelled rows of either class, none held out.

    Half of the rows, by a hash of the id, go to the dictionaries (one task a class, at most
    MAX_SAMPLE_BYTES and one text of it) and half to the curve. Without rows of both classes the
    dictionaries that can be built and a fixed curve are used.
    """
    sample = common.materialize(common.labelled_sample(docs, labels, "quality", MOD, HELD_OUT, per_class).withColumn("order", F.xxhash64(F.lit("half"), F.col("doc_id"))))
    first = sample.where("order % 2 = 0")
    made = {r.label: bytes(r.made) for r in first.groupBy("label").applyInPandas(_dictionary, "label int, made binary").collect()}
    model = CompressionModel(made.get(1, b""), made.get(0, b""))
    rest = sample.where("order % 2 != 0")
    rows = measure(rest, model, keep=("label",)).select("label", "diff", "plain", "relative").collect()
    x = np.array([[r["diff"], r["plain"], r["relative"]] for r in rows]).reshape(-1, 3)
    beta = common.logistic_fit(x, np.array([r["label"] for r in rows]), common.class_counts(labels, "quality", MOD, HELD_OUT), l2=1e-3)
    return model if beta is None else CompressionModel(model.good, model.bad, tuple(float(b) for b in beta))


def _scores(model: CompressionModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([model.features(t or "") for t in texts.to_pylist()]).reshape(-1, 3)
    return x, common.sigmoid(x @ np.array(model.beta[:3]) + model.beta[3])


def measure(docs: DataFrame, model: CompressionModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the kept columns, the three features and the score of every row."""
    columns = ["doc_id", *(c for c in keep if c != "doc_id"), "text"]
    kept = docs.select(*columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch):
                x, p = _scores(model, part.column("text"))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns[:-1]), *(pa.array(v, pa.float64()) for v in (*x.T, p))], names=[*columns[:-1], "diff", "plain", "relative", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.drop("text").schema)
    return kept.mapInArrow(run, f"{schema}, diff double, plain double, relative double, score double")


def op10_compression_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return measure(docs, fit(docs, labels)).select(
        "doc_id",
        F.coalesce(common.id_remainder(F.col("doc_id"), MOD) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.col("relative").alias("size_difference"),
    )


def reject_low_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score is one half or more, with their columns."""
    model = fit(docs, common.table(spark, sf_dir, "labels"))

    @F.arrow_udf("double")  # the other columns stay in the JVM
    def good(texts: pa.Array) -> pa.Array:
        common.release()
        parts = [_scores(model, texts.slice(i, 256))[1] for i in range(0, len(texts), 256)]
        return pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return docs.withColumn("__score", good("text")).where("__score >= 0.5").drop("__score")
