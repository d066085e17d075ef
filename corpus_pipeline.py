"""Five corpus stages: toxicity, quality classifier, line dedup, near-duplicates, packing."""

from __future__ import annotations

from tickweave.llm import common
from tickweave.llm.compression_quality import reject_low_quality
from tickweave.llm.line_dedup import drop_duplicate_lines
from tickweave.llm.packing import pack_documents
from tickweave.llm.simhash import drop_near_duplicates
from tickweave.llm.toxicity import reject_toxic

STAGES = [
    ("toxicity", reject_toxic),
    ("quality", reject_low_quality),
    ("line_dedup", drop_duplicate_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack_documents),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """The packed pieces of what the stages keep of documents; each stage reads what the last one wrote."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
