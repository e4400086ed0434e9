"""The registered queries over whole small tables, against their SQL or against brute force."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from strata.llm import byte_bpe, pii, toxicity
from strata.llm.queries import ORACLES, QUERIES, clean_up_edits, mix_oracle
from tests.conftest import SF_SMALL
from tests.llm.data import base_pii, covered, shingles, similar_components
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_SMALL}/documents.parquet'").fetchall())


@pytest.fixture(scope="module")
def tik():
    ranks = byte_bpe.load_ranks(byte_bpe.read_file(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_sql(spark, key):
    got = compare(spark, duck(SF_SMALL), SF_SMALL, key, QUERIES[key], ORACLES[key])
    assert got["ok"], got


def test_chat_format_runs_its_machine(spark):
    df = QUERIES["op10_chat_format"](spark, SF_SMALL)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in text and "array_contains" in text
    assert {r.valid for r in df.collect()} == {True, False}


def test_toxicity_holds_out_a_third_and_finds_the_toxic(spark):
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hit = [labels[r.doc_id] for r in held if r.predicted]
    assert sum(hit) / len(hit) > 0.9 and sum(hit) / sum(labels[r.doc_id] for r in held) > 0.85


def test_maximal_segments_against_all_segments():
    rng = np.random.default_rng(2)
    for _ in range(300):
        score = rng.integers(-4, 5, rng.integers(0, 14)).astype(float)
        want = []

        def split(lo, hi):
            best = max(((score[i:j].sum(), -(j - i), -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
            if best is None or best[0] <= 0:
                return
            split(lo, best[3])
            want.append((best[3], best[4], best[0]))
            split(best[4], hi)

        split(0, len(score))
        got = toxicity.maximal_segments(score)
        assert sum(s for _, _, s in got) == pytest.approx(sum(s for _, _, s in want))
        assert max((s for _, _, s in got), default=0) == max((s for _, _, s in want), default=0)


def test_pii(spark, texts):
    for r in QUERIES["op2_pii"](spark, SF_SMALL).collect():
        want = base_pii(texts[r.doc_id], pii.KINDS)
        assert r.base_sha256 == sha(",".join(f"{k}:{s}:{e}" for k, s, e in want))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == b for k, _, _ in want) for b in pii.BASE]
        assert set(f"{k}:{s}:{e}" for k, s, e in want) <= set(r.spans.split(","))


def test_byte_bpe(spark, texts, tik):
    for r in QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect():
        ids = tik.encode_ordinary(texts[r.doc_id])
        packed = np.array(ids, dtype="<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(packed), sha(texts[r.doc_id]))


def test_utf8_stream_equals_one_call():
    rng = np.random.default_rng(5)
    pool = [0x41, 0x80, 0x8F, 0x90, 0x9F, 0xA0, 0xBF, 0xC0, 0xC2, 0xE0, 0xE2, 0xED, 0xF0, 0xF4, 0xF8]
    for _ in range(3000):
        data = bytes(rng.choice(pool, rng.integers(0, 9)).tolist())
        s = byte_bpe.Utf8Stream()
        assert "".join(s.feed(data[i:i + 1]) for i in range(len(data))) + s.close() == data.decode("utf-8", "replace")


def test_jaccard_join(spark, texts):
    ids = sorted(texts)
    sets = [shingles(texts[i]) for i in ids]
    comp = similar_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op6_jaccard_join"](spark, SF_SMALL).collect()}
    assert got == {i: (len(s), ids[c]) for i, s, c in zip(ids, sets, comp)}


def test_token_counts(spark, texts, tik):
    rows = QUERIES["op7_token_counts"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.n_tokens_before for r in rows} == {i: len(tik.encode_ordinary(t)) for i, t in texts.items()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("edits", clean_up_edits())
    after, n_edits = dict(texts), {}
    for r in docs.collect():
        for e in r.edits:
            after[r.doc_id] = after[r.doc_id][:e.start] + e.text + after[r.doc_id][e.end:]
        n_edits[r.doc_id] = len(r.edits) + ("<num>" in after[r.doc_id])
    after = {i: t.replace("<num>", "<n>", 1) for i, t in after.items()}
    assert {r.doc_id: (r.n_tokens, r.n_chars, r.n_edits) for r in rows} == {
        i: (len(tik.encode_ordinary(t)), len(t), n_edits[i]) for i, t in after.items()}
    assert len(rows) == len(texts)


def test_suffix_dedup(spark, texts):
    raw = {i: t.encode() for i, t in texts.items()}
    marks = dict(zip(raw, covered(list(raw.values()), 200)))
    for r in QUERIES["op8_suffix_dedup"](spark, SF_SMALL).collect():
        m = marks[r.doc_id]
        left = np.frombuffer(raw[r.doc_id], np.uint8)[~m].tobytes()
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], m.astype(np.int8)])) == 1))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(m), int(m.sum()), spans, sha(left))


def test_pipeline_against_brute_force(spark, texts, tik):
    """Toxic documents go by the operator's own scores; every later stage is done again by hand."""
    bad = {r.doc_id for r in QUERIES["op1_toxicity"](spark, SF_SMALL).collect() if r.predicted}
    last = {t: max(i for i, x in texts.items() if x == t and i not in bad) for i, t in texts.items() if i not in bad}
    ids = sorted(last.values())
    comp = similar_components([shingles(texts[i]) for i in ids])
    kept = [i for k, i in enumerate(ids) if comp[k] == k]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW kept AS SELECT * FROM '{SF_SMALL}/documents.parquet' WHERE doc_id IN ({','.join(map(str, kept))})")
    picked = con.sql(mix_oracle("kept", corpus_pipeline.MIX_EPOCHS, corpus_pipeline.MIX_FRACTION,
                                "SELECT doc_id FROM picked")).fetchall()
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, in picked)
    for r in rows:
        ids = tik.encode_ordinary(texts[r.doc_id])
        assert (list(r.ids), r.n_tokens, r.decoded_sha256) == (ids, len(ids), sha(texts[r.doc_id]))


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
