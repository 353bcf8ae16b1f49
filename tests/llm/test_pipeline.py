"""The corpus pipeline, a stage at a time, against plain Python."""

from __future__ import annotations

import weakref
from collections import defaultdict

import corpus_pipeline as pipeline
import pyarrow as pa
from test_operators import links_by_force, lower, words

from pricewright.llm import near_dup, tokens
from pricewright.llm.queries import BYTE_BPE


def test_stages_do_what_they_say(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.staged(stage(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = {r.doc_id: r for r in docs.collect()}
        assert all(kept[-1][i] == r for i, r in rows.items())
        kept.append(rows)
    known, single, near, mixed = kept[1:]
    assert all(any(c.isalpha() for c in r.text or "") for r in known.values())
    groups = defaultdict(list)
    for i, r in known.items():
        groups[lower(r.text)].append(i)
    assert single.keys() == {max(ids) for ids in groups.values()}
    links = links_by_force([(i, r.text) for i, r in single.items()], pipeline.NEAR_COPY_PER_CENT)
    assert near.keys() == {i for i, (_, first, _) in links.items() if first == i}
    sizes = defaultdict(int)
    for r in near.values():
        sizes[r.source] += 1
    for source, size in sizes.items():
        left = sum(r.source == source for r in mixed.values())
        assert left == size if size <= len(near) // 4 else left < size
    pieces = pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in pieces} == mixed.keys()
    assert len(pipeline.run(spark, folder).collect()) == len(pieces)


def test_near_copies_from_eighty_per_cent_on_go(spark):
    text = words(60, 200).split()
    rows = []
    for doc_id, places in enumerate([[], [40, 80, 120, 160], [20, 50, 80, 110, 140, 170]]):
        near = [f"n{doc_id}" if at in places else word for at, word in enumerate(text)]
        rows.append((doc_id, " ".join(near)))
    assert {i: first for i, (_, first, _) in links_by_force(rows, 85).items()} == {0: 0, 1: 1, 2: 2}
    assert {i: first for i, (_, first, _) in links_by_force(rows, 80).items()} == {0: 0, 1: 0, 2: 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in pipeline.near_copies(spark, docs, None).collect()} == {0, 2}


def test_a_worker_drops_the_encoder_of_another_stage_and_signs_small_pieces():
    kept = weakref.ref(tokens.encoder(BYTE_BPE, True))
    assert tokens.encoder(BYTE_BPE, True) is kept()  # from task to task of its own stage
    ids, texts = list(range(40)), [words(at, 3000) for at in range(40)]
    batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(texts)], names=["doc_id", "mark", "text"])
    signed = list(near_dup._sign(iter([batch])))
    assert kept() is None
    assert sum(map(len, texts)) > 2 * near_dup.PIECE_BYTES
    assert len(signed) > 2 and [i for part in signed for i in part.column("doc_id").to_pylist()] == ids
    alone = [row for at in ids for part in near_dup._sign(iter([batch.slice(at, 1)])) for row in part.to_pylist()]
    assert [row for part in signed for row in part.to_pylist()] == alone
