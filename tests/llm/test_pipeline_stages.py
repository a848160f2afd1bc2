"""The corpus pipeline against the stages' operators in plain Python."""

import zlib

import numpy as np
import pyarrow.parquet as pq

import corpus_pipeline
from hourvault.llm import decontaminate, near_dedup, packing, quality, secret_scan

SF_DIR = "/root/testdata/sf0.001"


def test_run(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()
    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    left = {}
    for d in docs:
        found, text = quality.cleaned((d["text"] or "").encode())
        if found["kept"]:
            left[d["doc_id"]] = text.decode()
    sets = {}
    for i, t in left.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    group = {}
    for i in sorted(sets):
        linked = {group[j] for j in group if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
        group[i] = min(linked, default=i)
        for j in group:
            if group[j] in linked:
                group[j] = group[i]
    left = {i: t for i, t in left.items() if group[i] == i}
    tests = decontaminate.Tests.of([(str(x["item_id"]), (x["text"] or "").encode()) for x in items])
    left = {i: t for i, t in left.items() if not decontaminate.matches([decontaminate.words_of(t.encode())], tests)[0].any()}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {g.doc_id for g in got} == set(left)
    checked = 0
    for i, text in left.items():
        spans = secret_scan.base_spans(text)
        if spans or secret_scan._may_be_sensitive(text):
            text = secret_scan.masked(text, spans)
            if secret_scan._may_be_sensitive(text):
                continue
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((g.piece, g.start, g.length, g.ids_crc32) for g in got if g.doc_id == i)
        assert pieces == [(n, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for n, s in enumerate(range(0, len(ids), 4096))]
        checked += 1
    assert checked > 0.8 * len(left)


def test_stages_keep_the_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for rows in (docs.limit(0), docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SF_DIR)
            assert out.columns == docs.columns, name
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "near-dedup" and near_dedup.SHINGLE_WORDS == 5
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF_DIR).count() == 0
