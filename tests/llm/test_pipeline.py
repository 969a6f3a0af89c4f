"""Registered queries and pipeline stages on sf0.001 against SQL or plain versions."""

import math
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from pitlane.llm import packing, quality, queries, toxicity
from pitlane.llm.common import land, table
from tests.conftest import SF001
from tests.llm.test_decontam import brute
from tests.llm.test_simhash import plain_components, plain_print

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF001)
    cols = sorted(got.columns)
    cur = con.execute(queries.ORACLE[name])
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    assert sorted((tuple(norm(r[c]) for c in cols) for r in got.collect()), key=repr) == want


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet' ORDER BY doc_id").fetchall()


def test_simhash_query(spark, documents):
    ids, prints = [d for d, _ in documents], [plain_print(t) for _, t in documents]
    want = {d: (f"{p:016x}", c) for d, p, c in zip(ids, prints, plain_components(ids, prints, 4))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op5_simhash"](spark, SF001).collect()} == want


def test_decontamination_query(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    got = queries.QUERIES["op2_decontaminate"](spark, SF001).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(documents, items)


def check_packed(rows, documents):
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(packing.public_vocabulary().json)
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == {d for d, _ in documents}
    for d, t in documents:
        ids = np.array([*slow.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[d], key=lambda r: r.piece)
        assert [r.start for r in own] == packing.cut_points(len(ids), 2048) and sum(r.length for r in own) == len(ids)
        assert all(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    for parts in bins.values():
        end = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048


def test_packing_query(spark, documents):
    check_packed(queries.QUERIES["op3_best_fit"](spark, SF001).collect(), documents)


def test_score_queries_cover_every_document(spark, documents):
    for name, cut in (("op6_toxicity", 0.5), ("op8_quality", 0.3)):
        got = queries.QUERIES[name](spark, SF001).collect()
        assert sorted(r.doc_id for r in got) == [d for d, _ in documents]
        for r in got:
            assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    got = queries.QUERIES["op4_pseudo_likelihood"](spark, SF001).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: len((t or "").split()) for d, t in documents}


def test_page_query_keeps_every_page(spark):
    got = queries.QUERIES["op9_html_min_cut"](spark, SF001).collect()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{SF001}/pages.parquet'").fetchall()[0][0]
    assert all(r.n_chars == len(r.text) for r in got)


def test_stages_match_plain_versions(spark):
    """Each stage, on what the one before kept, against its operator applied document by document."""
    docs, kept = table(spark, SF001, "documents"), None
    labels = table(spark, SF001, "labels")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = {r.doc_id: r.text for r in docs.collect()}
        out = land(stage(spark, docs, SF001), f"test-stage-{k}")
        if k < 4:
            assert out.columns == docs.columns
            kept = {r.doc_id: r.text for r in out.collect()}
        if k == 0:
            model, grams = toxicity.train(docs, labels), toxicity.ToxicityParams().grams()
            want = {d for d, t in rows.items() if model(grams(t.encode())) < 0.5}
        elif k == 1:
            model, grams = quality.train(docs, labels), quality.QualityParams().grams()
            want = {d for d, t in rows.items() if model(grams(t.encode())) >= 0.3}
        elif k == 2:
            ids = sorted(rows)
            want = set(plain_components(ids, [plain_print(rows[d]) for d in ids], 4))
        elif k == 3:
            items = duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
            want = set(rows) - {d for d, _ in brute(rows.items(), items)}
        else:
            check_packed(out.collect(), sorted(rows.items()))
            return
        assert set(kept) == want and all(kept[d] == rows[d] for d in kept)
        docs = out


def test_stages_take_nulls_repeats_and_no_rows(spark):
    docs = table(spark, SF001, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (-1, None, None, None, None)], docs.schema)
    mixed = land(docs.union(odd).union(docs.limit(3)), "test-mixed")
    for start in (mixed, land(docs.limit(0), "test-none")):
        rows = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = land(stage(spark, rows, SF001), f"test-odd-{k}")
            if k == 2:
                assert rows.count() == rows.select("doc_id").distinct().count()
        assert (rows.count() > 0) == (start is mixed)


def test_run_is_the_stages_in_order(spark, documents):
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id for r in got} < {d for d, _ in documents}
