"""Operators 11 to 13: against brute force on the given tables and on every awkward case."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata.llm import alignment, secrets, whitening
from strata.llm.byte_bpe import read_file
from strata.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.data import DOCS, awkward_rows

A_JSON, B_MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- 11, cross-tokenizer alignment

@pytest.fixture(scope="module")
def plain():
    """Both tokenizers run over the whole text, and their tokens' bytes."""
    a = Tokenizer.from_file(A_JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_MODEL)
    code = {c: k for k, c in alignment.byte_letters().items()}

    def encode(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        return ids_a, ids_b, raw_a, raw_b
    return encode


def aligned_by_hand(plain, text):
    """Groups as text and every pair of overlapping tokens, by their byte ranges."""
    if not text:
        return (0, 0, 0, "", [])
    ids_a, ids_b, raw_a, raw_b = plain(text)
    if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
        return (0, 0, 0, "", [])
    ends_a, ends_b = list(accumulate(map(len, raw_a))), list(accumulate(map(len, raw_b)))
    both, said, i, j = set(ends_a) & set(ends_b), [], 0, 0
    for e in sorted(both):
        k, m = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
        said.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
        i, j = k, m
    links, j = [], 0
    for x, (end, raw) in enumerate(zip(ends_a, raw_a)):
        while ends_b[j] <= end - len(raw):
            j += 1
        y = j
        while y < len(ids_b) and ends_b[y] - len(raw_b[y]) < end:
            links.append((ids_a[x], ids_b[y]))
            y += 1
    return len(ids_a), len(ids_b), len(said), ";".join(said), links


def check_alignment(plain, texts, rows):
    want = [aligned_by_hand(plain, t) for t in texts]
    times = Counter(p for w in want for p in w[4])
    top = defaultdict(int)
    for (_, b), n in times.items():
        top[b] = max(top[b], n)
    assert len(rows) == len(texts)
    for r, (a, b, groups, said, links) in zip(rows, want):
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (a, b, groups, len(links))
        assert r["groups_sha256"] == (sha(said) if said else "")
        assert r["count_sum"] == sum(times[p] for p in links)
        assert r["n_best"] == sum(times[p] == top[p[1]] for p in links)


def test_alignment_query(spark, plain):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op11_alignment"](spark, SF_SMALL).orderBy("doc_id").collect()
    assert [r.doc_id for r in got] == [r.doc_id for r in docs]
    check_alignment(plain, [r.text for r in docs], got)


ODD = ["<|endoftext|> <s> </s>", "a▁b", "x \n y", "tab\t  two  spaces ", "  lead", "trail  ", "  nb   em", "漢字 と 日本", "a\x00b",
       "don't we're I'll 'sx ''s", "²³ ½ ªº 12,5", "é ‍🙂", "᠎ x​ y﻿ z", "<0x41>", "\n", " ", "aaaa " * 300]


@pytest.mark.parametrize("held", [1 << 18, 40, 0])
def test_alignment_awkward(spark, plain, held, tmp_path):
    path = str(tmp_path / "documents")
    rows = awkward_rows() + [(1000 + i, t, "en", "s", 1, *("x",) * 9) for i, t in enumerate(ODD)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    texts = [r.text for r in docs.withColumn("n", F.monotonically_increasing_id()).orderBy("n").select("text").collect()]
    found = alignment.Alignment(docs, A_JSON, B_MODEL, with_groups=True, max_segments=50)
    got = found.documents(held).orderBy("rid").collect()
    check_alignment(plain, texts, got)
    assert all(r.groups_sha256 == (sha(r.groups) if r.groups else "") for r in got)
    pairs = found.pairs().collect()
    assert sum(r.n for r in pairs) == sum(r.n_links for r in got)
    assert all(any(p.best for p in pairs if p.b == b) for b in {p.b for p in pairs})


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], DOCS), A_JSON, B_MODEL).collect() == []


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.sampled_from("ab'st. ,\n\t  é²0▁漢"), max_size=24))
def test_segments_change_nothing(plain, text):
    aligner = _aligner()
    a, b, groups, said, links = aligned_by_hand(plain, text)
    got = aligner.align(text)
    assert got[:4] == (a, b, groups, len(links)) and got[5] == said
    assert np.frombuffer(got[4], aligner.kind).tolist() == [x << aligner.shift | y for x, y in links]


_made = []


def _aligner():
    if not _made:
        _made.append(alignment.Aligner(read_file(A_JSON), read_file(B_MODEL), 20))
    return _made[0]


# ---- 12, secrets

def base_secrets(text):
    out = [("assign", *m.span()) for m in re.finditer(
        r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"""
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def said(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def test_secrets_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op12_secrets"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        base, r = base_secrets(d.text or ""), got[d.doc_id]
        assert r.base_sha256 == sha(said(base))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == b for k, _, _ in base) for b in secrets.BASE)
        assert set(said(base).split(",")) <= set(r.spans.split(","))


def test_secrets_awkward(spark):
    docs = spark.createDataFrame(awkward_rows(), DOCS)
    got = secrets.find_secrets(docs).collect()
    assert len(got) == docs.count()
    assert all(r.spans == [] for r in got if r.doc_id in (0, 1))
    assert secrets.find_secrets(docs.limit(0)).collect() == []


def found(text):
    return [text[s:e] for s, e, _ in secrets.literals(text)]


@pytest.mark.parametrize("text, want", [
    ('password = "hunter2x"', ["hunter2x"]),
    ("db_password: 'Tr0ub4dor&3'", ["Tr0ub4dor&3"]),
    ('{"apiKey": "a8F3kk29dkQ"}', ["a8F3kk29dkQ"]),
    ('export CLIENT_SECRET=9f8e7d6c5b4a', ["9f8e7d6c5b4a"]),
    ('let password: &str = "s3cr3tValue";', ["s3cr3tValue"]),
    ('std::string pw; pwd := `q1w2e3r4t5`', ["q1w2e3r4t5"]),
    ('conf["auth_token"] = "ZXCv0987asdf"', ["ZXCv0987asdf"]),
    ('char secret[] = "a1b2c3d4e5"', ["a1b2c3d4e5"]),
    ('connect(host="db", password="pa55w0rd!x")', ["pa55w0rd!x"]),
    ('tool --password hunter2xyz --user bob', ["hunter2xyz"]),
    ("<password>Gr33nApple9</password>", ["Gr33nApple9"]),
    ("GET /x?token=abcd1234efgh&v=2", ["abcd1234efgh"]),
    ("Authorization: Bearer abC123dEf456", ["abC123dEf456"]),
    ('PART = "k3y-"\ntoken = PART + "9f8a7b6c"', ["9f8a7b6c"]),
    ('a = "Zx81kQ77pl"\nb = a\nc = b\npassword = c', ["Zx81kQ77pl"]),
    ('password: ${DB}\nDB: zx81kq77pl', ["zx81kq77pl"]),
    ('x = "first1234"\nx = "second5678"\npassword = x', ["second5678"]),
    ('key = os.environ.get("PASSWORD", "dflt1234x")\npassword = key', ["dflt1234x"]),
    ('password = os.environ["DB_PASSWORD"]', []),
    ('password = getenv("DB_PASSWORD_1")', []),
    ('password = "changeme"', []), ('password_file = "/etc/app/pw1.txt"', []), ('password = ""', []), ("token_length = 123456789", []),
    ('if password == "abc12345": pass', []),
    ("I don't say the password: it's not here. Don't ask", []),
    ('colour = "a1b2c3d4e5"', []), ("the token: something else", []),
])
def test_assigned_literals(text, want):
    assert found(text) == want


def test_literals_are_found_in_linear_time():
    for text in ("x = x + 'a'\n" * 20000 + "password = x", "password = " + "(" * 50000, "'" * 50000 + "=", "a=" * 50000, "[" * 30000 + "] = '1'"):
        secrets.literals(text)


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.sampled_from("ab1 =:'\"\\\n()[]{}<>/-+,$é\x20"), max_size=60) | st.text(max_size=40))
def test_any_text_has_defined_spans(text):
    spans = secrets.find(text)
    assert all(0 <= s < e <= len(text) for _, s, e, _ in spans)
    assert said([x for x in [s[:3] for s in spans] if x[0] != "literal"]) == said(base_secrets(text))


# ---- 13, whitening

def check_whitening(rows, vectors, components):
    """``rows`` against a plain covariance of the integers, in Python's own numbers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors.values()]
    n, dim = len(x), len(x[0])
    total = [sum(r[d] for r in x) for d in range(dim)]
    centred = np.array([[a * n - s for a, s in zip(r, total)] for r in x], dtype=object)
    cov = np.array([[float(y) / n ** 3 for y in row] for row in centred.T @ centred])
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    by = defaultdict(dict)
    for r in rows:
        by[r.vec_id][r.component] = r
    assert set(by) == set(vectors) and all(sorted(c) == list(range(1, len(value) + 1)) for c in by.values())
    white = np.array([[by[i][c].whitened for c in range(1, len(value) + 1)] for i in vectors], dtype=float)
    for i, d in zip(vectors, centred):
        assert by[i][1].deviation == sum(y * y for y in d) and by[i][1].n == n
    first = next(iter(by.values()))
    np.testing.assert_allclose([first[c].explained for c in first], value / np.trace(cov), rtol=1e-4)
    good = value > 1e-9 * value[0]
    want = (centred.astype(float) / n) @ vector / np.sqrt(np.where(good, value, 1))
    for k in np.flatnonzero(good):
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) < 1e-4
    error = np.abs(np.cov(white[:, good].T, bias=True).reshape(good.sum(), -1) - np.eye(good.sum())).max()
    assert error <= 1e-4 and all(r.identity_error <= 1e-4 for r in rows)
    none = value <= dim * np.finfo(float).eps * value[0]  # no variance at all
    assert np.isnan(white[:, none]).all() and not np.isnan(white[:, ~none]).any()


def test_whitening_query(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    check_whitening(QUERIES["op13_whitening"](spark, SF_SMALL).collect(), vectors, 32)


SCHEMA = "vec_id long, embedding array<double>, component int, whitened string"


def test_whitening_awkward(spark):
    nan, inf = float("nan"), float("inf")
    good = {1: [0.5, -3.0, 2.0], 2: [1.5, 4.0, 2.0], 3: [-2.25, 0.1, 2.0], 4: [9.0, 1e6, 2.0], 6: [0.5, -3.0, 2.0]}
    bad = [(10, None), (11, [1.0, None, 2.0]), (12, [nan, 1.0, 2.0]), (13, [1.0, inf, 2.0]), (14, []), (15, [1.0, 2.0])]
    rows = [(i, v, 7, "x") for i, v in [*good.items(), *bad]]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    check_whitening(got, good, 3)
    assert {r.component for r in got if r.whitened is None} == {3}  # the constant dimension
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(14, [], 1, "x"), (1, None, 1, "x")], SCHEMA)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0], 1, "x")], SCHEMA)).collect()
    assert [(r.vec_id, r.deviation, r.whitened, r.n) for r in one] == [(None, 0, None, 1)] * 2


def test_whitening_far_values(spark):
    rng = np.random.default_rng(3)
    far = {i: (rng.normal(size=5) * 10.0 ** rng.integers(0, 12, 5)).tolist() for i in range(70)}
    rows = [(i, v, 7, "x") for i, v in far.items()]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(4), 5).collect()
    x = {i: [math.floor(64 * c) for c in v] for i, v in far.items()}
    total = [sum(v[d] for v in x.values()) for d in range(5)]
    for r in got:
        exact = sum((70 * c - s) ** 2 for c, s in zip(x[r.vec_id], total))
        assert r.deviation == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("high, rows", [(2, 5), (200, 300), (1 << 20, 65), (1 << 40, 64), (1, 1)])
def test_scatter_is_exact(high, rows):
    y = np.random.default_rng(high).integers(0, high, (rows, 6))
    total, cross = whitening.scatter(y)
    assert total.tolist() == y.astype(object).sum(axis=0).tolist()
    assert cross.tolist() == (y.astype(object).T @ y.astype(object)).tolist()
