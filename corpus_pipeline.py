"""From raw documents to packed training sequences, a stage at a time."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pricewright.llm import content_sort, language, mixing, near_dup, packing  # noqa: E402
from pricewright.llm.queries import BYTE_BPE  # noqa: E402
from pricewright.plans.inputs import table  # noqa: E402
from pricewright.plans.registry import query  # noqa: E402
from pricewright.session import staged  # noqa: E402

LEAST_LANGUAGE_SCORE = 0.3  # four languages at random have 0.25
MOST_OF_A_SOURCE = 0.25
NEAR_COPY_PER_CENT = 80


def known_language(spark, docs, sf_dir):
    """Documents without letters, or whose language cannot be told, go."""
    return language.with_language(docs, LEAST_LANGUAGE_SCORE)


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the largest identifier stays."""
    return content_sort.without_copies(docs)


def near_copies(spark, docs, sf_dir):
    """One document of each component of near copies, alike in 80 % of their runs of five words, stays."""
    return near_dup.without_near_copies(docs, NEAR_COPY_PER_CENT)


def target_weights(spark, docs, sf_dir):
    """Sources above a quarter of all documents are held to that weight; all others stay whole.

    Where every source is above a quarter, the mixture ends where the first of them runs out.
    """
    return mixing.to_weights(docs, MOST_OF_A_SOURCE)


def training_sequences(spark, docs, sf_dir):
    """Pieces of documents with their place in sequences of 1024 tokens."""
    return packing.packed_documents(docs, BYTE_BPE, end_id=2, added=True)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", target_weights),
    ("packing", training_sequences),
]

ORACLE_SQL = None  # a trained classifier decides which documents enter


@query("pipeline", ORACLE_SQL)
def whole_pipeline(spark, sf_dir):
    return run(spark, sf_dir)


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
