"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from strata.llm import byte_bpe, chat_format, exact_dedup, jaccard_join, mixing, pii, suffix_dedup, token_counts, topk, toxicity
from strata.llm.queries import MIX_WEIGHTS, clean_up_edits, mix_levels
from tests.llm.data import DOCS, awkward_rows, base_pii, covered, shingles, similar_components

VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "documents")
    spark.createDataFrame(awkward_rows(), DOCS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def rows(docs):
    """The rows in the order of their row number."""
    return [r.asDict() for r in docs.withColumn("_n", F.monotonically_increasing_id()).orderBy("_n").collect()]


@pytest.fixture(scope="module")
def tik():
    ranks = byte_bpe.load_ranks(byte_bpe.read_file(VOCAB))
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def by_row(df):
    return [r.asDict() for r in df.orderBy("rid").collect()]


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(docs, rows, bits):
    got = by_row(exact_dedup.copies(docs, key_bits=bits))
    assert [g["doc_id"] for g in got] == [r["doc_id"] for r in rows]
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    for g, r in zip(got, rows):
        ids = groups[r["text"] or ""]
        keep = max((i for i in ids if i is not None), default=None)
        assert (g["group_size"], g["keep_id"], g["text_sha256"]) == (len(ids), keep, sha(r["text"] or ""))
        assert not g["kept"] or g["doc_id"] == keep
    kept = [r["text"] or "" for g, r in zip(got, rows) if g["kept"]]
    assert sorted(kept) == sorted(groups)  # one row of every text, repeated rows too


def test_exact_dedup_drops_rows_and_keeps_columns(docs, rows, none):
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    assert sorted(r["text"] or "" for r in out.collect()) == sorted({r["text"] or "" for r in rows})
    assert exact_dedup.drop_copies(none).count() == 0 == exact_dedup.copies(none).count()


def test_chunks_join_to_the_text(docs):
    whole = F.array_join(exact_dedup.chunks(F.col("text")), "") == F.col("text")
    assert docs.where("text IS NOT NULL").where(~whole).count() == 0


@pytest.mark.parametrize("case", ["docs", "none"])
def test_jaccard_join(request, rows, case):
    df = request.getfixturevalue(case)
    got = by_row(jaccard_join.join_similar(df))
    if case == "none":
        assert got == [] and jaccard_join.drop_similar(df).count() == 0
        return
    sets = [shingles(r["text"]) for r in rows]
    comp = similar_components(sets)
    for i, g in enumerate(got):
        ids = [r["doc_id"] for r, c in zip(rows, comp) if c == comp[i]]
        want = min((x for x in ids if x is not None), default=None) if sets[i] else rows[i]["doc_id"]
        assert (g["n_shingles"], g["component_id"]) == (len(sets[i]), want)
    heads = [comp[i] for i, g in enumerate(got) if g["kept"]]
    assert sorted(heads) == sorted(set(comp))  # one row of every component, every empty row
    out = jaccard_join.drop_similar(df)
    assert out.columns == df.columns and out.count() == len(set(comp))


@pytest.mark.parametrize("hot,many", [(64, 4096), (1, 4096), (64, 1)])
def test_suffix_dedup(docs, rows, hot, many):
    got = suffix_dedup.remove_repeats(docs, hot=hot, many=many).collect()
    texts = [(r["text"] or "").encode() for r in rows]
    want = []
    for r, t, m in zip(rows, texts, covered(texts, suffix_dedup.LENGTH)):
        left = bytes(b for b, gone in zip(t, m) if not gone)
        spans = sum(1 for i in range(len(m)) if m[i] and (i == 0 or not m[i - 1]))
        want.append((r["doc_id"], len(t), int(m.sum()), spans, sha(left), left))
    key = lambda x: (x[0] is None, x[0] or 0, x[4])
    assert sorted([(g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256, bytes(g.kept)) for g in got], key=key) \
        == sorted(want, key=key)


def test_suffix_dedup_empty(none):
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_pii(docs, rows, none):
    got = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE)) for r in pii.find_pii(docs).collect()}
    assert got == {(r["doc_id"], tuple(base_pii(r["text"] or "", pii.KINDS))) for r in rows}
    assert pii.find_pii(none).count() == 0


def test_byte_bpe(docs, rows, none, tik):
    ids = {(r.doc_id, tuple(r.ids)) for r in byte_bpe.encode(docs, VOCAB, PATTERN).collect()}
    assert ids == {(r["doc_id"], tuple(tik.encode_ordinary(r["text"] or ""))) for r in rows}
    back = byte_bpe.decode(byte_bpe.encode(docs, VOCAB, PATTERN), VOCAB, PATTERN).collect()
    assert {(r.doc_id, r.text) for r in back} == {(r["doc_id"], r["text"] or "") for r in rows}
    got = byte_bpe.round_trip(docs, VOCAB, PATTERN).collect()
    assert {(r.doc_id, r.decoded_sha256) for r in got} == {(r["doc_id"], sha(r["text"] or "")) for r in rows}
    assert byte_bpe.round_trip(none, VOCAB, PATTERN).count() == 0


def test_token_counts(docs, rows, none, tik):
    got = {(r.doc_id, r.n_chars, r.n_tokens_before, r.n_tokens)
           for r in token_counts.count_edited(docs.withColumn("edits", clean_up_edits()), VOCAB, PATTERN).collect()}
    want = set()
    for r in docs.withColumn("edits", clean_up_edits()).collect():
        t = r.text or ""
        before = len(tik.encode_ordinary(t))
        for e in r.edits:
            t = t[:e.start] + e.text + t[e.end:]
        want.add((r.doc_id, len(t), before, len(tik.encode_ordinary(t))))
    assert got == want
    assert token_counts.count_edited(none.withColumn("edits", clean_up_edits()), VOCAB, PATTERN).count() == 0


def test_stored_trees(docs, rows, none, tik):
    """Rows without edits stay as they were; edits of nothing, null edits and wild ranges are as for texts."""
    trees = token_counts.stored(token_counts.load_trees(docs, VOCAB, PATTERN), "test-trees")
    assert token_counts.load_trees(none, VOCAB, PATTERN).count() == 0
    assert {(r.doc_id, r.text, r.n_tokens, sum(r.pieces), sum(r.leaf_pieces), sum(r.leaf_tokens)) for r in trees.collect()} == {
        (r["doc_id"], t, n, len(t), len(regex.findall(PATTERN, t)), n)
        for r in rows for t in [r["text"] or ""] for n in [len(tik.encode_ordinary(t))]}
    odd = F.when(F.length("text") % 2 == 1, F.expr("array(struct(-5, 3, 'x '), null, struct(10, 1000000000, cast(null as string)))"))
    once = token_counts.stored(token_counts.edit_trees(trees.withColumn("edits", odd), VOCAB, PATTERN), "test-trees-once")
    twice = token_counts.edit_trees(once.withColumn("edits", F.expr("array(struct(0, 0, text))")), VOCAB, PATTERN)
    want = sorted((("x " + t[3:])[:10] if len(t) % 2 else t) for t in ((r["text"] or "") for r in rows))
    assert sorted(r.text for r in once.collect()) == want and once.columns == trees.columns
    assert sorted((r.text, r.n_tokens) for r in twice.collect()) == sorted((t + t, len(tik.encode_ordinary(t + t))) for t in want)
    empty = token_counts.load_trees(none, VOCAB, PATTERN).withColumn("edits", F.lit(None).cast(token_counts.EDITS))
    assert token_counts.edit_trees(empty, VOCAB, PATTERN).count() == 0


def test_edit_table_with_nulls_and_wild_ranges(spark, docs, rows, tik):
    edits = spark.createDataFrame([(6, 2, -5, 3, "x "), (6, 1, 10, 10 ** 6, None), (7, 1, 5, 2, " new"), (999, 1, 0, 0, "gone")],
                                  "doc_id long, seq int, start int, end int, text string")
    got = token_counts.count_edited(token_counts.with_edits(docs, edits), VOCAB, PATTERN).collect()
    want = set()
    for r in rows:
        t, i = r["text"] or "", r["doc_id"]
        if i == 6:
            t = "x " + t[:10][3:]
        if i == 7:
            t = t[:5] + " new" + t[5:]
        want.add((i, len(t), len(tik.encode_ordinary(t))))
    assert {(r.doc_id, r.n_chars, r.n_tokens) for r in got} == want and len(got) == len(rows)


def test_mixing(docs, rows, none):
    for epochs in (1, 3):
        got = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, fraction=(4, 5), max_epochs=epochs, seed=3).collect()
        n = {r["_n"]: len((r["text"] or "").split()) for r in rows}
        assert len({(g.rid, g.epoch) for g in got}) == len(got) and all(0 <= g.epoch < epochs for g in got)
        assert sum(g.n_tokens for g in got) <= sum(n.values()) * 4 // 5
    out = mixing.mixed(docs, mix_levels(), MIX_WEIGHTS, max_epochs=1)
    assert out.columns == docs.columns and out.count() <= len(rows)
    assert mixing.mix(none, mix_levels(), MIX_WEIGHTS).count() == 0


def test_toxicity(spark, docs, rows, none):
    labels = spark.createDataFrame([(i, 1, int(i in (19, 20))) for i in range(24)] + [(None, 0, 1), (5, 0, None), (5, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = by_row(toxicity.score(docs, labels))
    assert [g["doc_id"] for g in got] == [r["doc_id"] for r in rows]
    assert all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.7) for g in got)
    assert toxicity.drop_toxic(docs, labels).columns == docs.columns
    assert toxicity.score(none, labels).count() == 0
    no_labels = toxicity.score(docs, labels.limit(0)).collect()
    assert len(no_labels) == len(rows) and {r.score for r in no_labels} == {0.0}


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (2, [2.0, -1.0], "a"), (3, None, "a"), (4, [], "a"), (5, [nan, 1.0], "a"),
            (6, [inf, 1.0], "a"), (7, [None, 1.0], "a"), (8, [1.0, 2.0, 3.0], "a"), (None, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"),
            (0, [1.0, 2.0], "a"), (9, [-0.0001, 0.0], "a"), (10, [3e30, 1.0], "a")]
    v = spark.createDataFrame(data, "vec_id long, embedding array<float>, score string").repartition(2)
    got = topk.top_k(v, v.where("vec_id = 0 OR vec_id = 5"), 10).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (0, 1, 10, 2 ** 63 - 1), (0, 2, 1, 5 << 20), (0, 3, 1, 5 << 20), (0, 4, None, 5 << 20), (0, 5, 2, 0), (0, 6, 9, -1024)]
    assert topk.top_k(v.limit(0), v.limit(0), 10).count() == 0


def test_chat_format(spark):
    data = [(1, 0, "user", "hi <|im_end|> \\ there"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, 0, None, "x"),
            (2, None, "sys\ntem", "<|<||\\|"), (None, 0, "user", "u"), (None, 1, "assistant", "a\n<"), (3, 0, "assistant", "no")]
    rows = spark.createDataFrame([(*d, "extra") for d in data],
                                 "conv_id long, turn long, role string, text string, segments string")
    out = chat_format.format_chats(rows).select(
        "conv_id", "valid", chat_format.read_turns(F.col("formatted")).alias("turns"),
        chat_format.loss_text(F.col("segments")).alias("loss"))
    got = {r.conv_id: (r.valid, [(t.role, t.text) for t in r.turns], r.loss) for r in out.collect()}
    assert got == {
        1: (False, [("user", "hi <|im_end|> \\ there"), ("assistant", ""), ("assistant", "")], ""),
        2: (False, [("sys\ntem", "<|<||\\|"), ("", "x")], ""),
        None: (True, [("user", "u"), ("assistant", "a\n<")], "a\n<"),
        3: (False, [("assistant", "no")], "no"),
    }
    assert chat_format.format_chats(rows.limit(0)).count() == 0


def landed(docs, labels, path):
    docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline(spark, docs, rows, tik, tmp_path):
    """Null, empty, long, repeated texts, null and repeated ids, clashing columns: one row of each class of near copies
    reaches the mix, and what the mix keeps is encoded whole."""
    labels = spark.createDataFrame([(i, 1, 0) for i in range(24)] + [(None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")
    out = corpus_pipeline.run(spark, landed(docs, labels, tmp_path)).collect()
    distinct = sorted({r["text"] or "" for r in rows})
    classes = similar_components([shingles(t) for t in distinct])
    class_of = {hashlib.sha256(t.encode()).hexdigest(): c for t, c in zip(distinct, classes)}
    ids = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()): r["text"] or "" for r in rows}
    assert out and len({class_of[r.decoded_sha256] for r in out}) == len(out)
    for r in out:
        assert list(r.ids) == tik.encode_ordinary(ids[r.doc_id, r.decoded_sha256])


def test_pipeline_of_nothing(spark, none, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, landed(none, labels, tmp_path)).count() == 0
