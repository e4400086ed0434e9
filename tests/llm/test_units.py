"""The operators' parts on random small inputs, against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from strata.llm import byte_bpe, jaccard_join, mixing, pii, token_counts, topk, toxicity
from strata.llm.components import components
from strata.llm.run_index import RunIndex
from tests.llm.data import base_pii

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.codec(byte_bpe.read_file(public_tokenizers.path("byte_bpe_50k.tiktoken")), PATTERN)


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for u, v in links for x in (u, v) if u != v}
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_run_index_marks_and_statistics():
    rng = np.random.default_rng(0)
    for _ in range(150):
        base = rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 60)).astype(np.uint8).tobytes()
        strings = [base[a:a + rng.integers(0, 40)] + rng.integers(97, 100, rng.integers(0, 10)).astype(np.uint8).tobytes()
                   for a in rng.integers(0, len(base), rng.integers(1, 6))]
        n = int(rng.integers(1, 12))
        index = RunIndex(strings)
        marks = index.long_matches(n)
        times = Counter(s[i:i + n] for s in strings for i in range(len(s) - n + 1))
        for s, start in zip(strings, index.starts):
            want = np.zeros(len(s), dtype=bool)
            for i in range(len(s) - n + 1):
                if times[s[i:i + n]] > 1:
                    want[i:i + n] = True
            assert (marks[start:start + len(s)] == want).all()
        text = index.text.tobytes()
        for p, length, q in index.matching_statistics():
            assert text[p:p + length] == text[q:q + length] and (length == 0 or p != q)


def test_similar_sets_share_a_key_and_near_sketches():
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, rng.choice([6, 40, 400])))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        most = jaccard_join.most_differences(len(a))
        drop = int(rng.integers(0, most + 1))
        new = int(rng.integers(0, most - drop + 1))
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 1 << 63, new, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both) or not len(b):
            continue
        assert len(np.intersect1d(jaccard_join.signature(a), jaccard_join.signature(b)))
        x, y = jaccard_join.parity(a).view(np.uint64), jaccard_join.parity(b).view(np.uint64)
        size = min(len(x), len(y))
        far = np.bitwise_count(jaccard_join.folded(x, size) ^ jaccard_join.folded(y, size)).sum()
        assert far <= len(a) + len(b) - 2 * both <= (len(a) + len(b)) // 9


def test_encoding_of_random_strings(codec):
    tik = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.merges.rank, special_tokens={})
    rng = random.Random(2)
    for _ in range(3000):
        alphabet = rng.choice(["ab", "aeiou tnsr", "abcdefghijklmnopqrstuvwxyz", "éèaß€漢字 ", "\n\t  a.", "0123456789 -", "=-*#"])
        x = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        ids = codec.encode(x)
        assert ids == tik.encode_ordinary(x) and codec.decode(ids, 3) == x


def test_transducer_that_forgets_gives_the_same(codec):
    text = ("unbelievable antidisestablishmentarianism " * 3 + "thereupon inthewhole ") * 5
    want = codec.encode(text)
    assert byte_bpe.Codec(codec.merges.rank, PATTERN, 5, 2).encode(text) == want


def test_edits_keep_the_tree_equal_to_a_new_split(codec):
    counter = token_counts.Counter(codec)
    rng = random.Random(4)
    bits = ["a", "the", "  ", "\n", " ", "\t\n", " x", "'s", "'", "12", "!?", " re", "é", "漢", " \n ", " word", "...", "'ll"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 40, 400])))
        tree = token_counts.PretokenTree(counter, text)
        for _ in range(rng.randint(1, 6)):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 2, 5, 60]))
            new = "".join(rng.choice(bits) for _ in range(rng.choice([0, 0, 1, 3, 30])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            if rng.random() < 0.3:  # stored and read again: not split, not encoded
                before = dict(counter.known)
                body, pieces, counts, tokens = tree.state()
                assert max(counts, default=1) > 0 and body == text
                tree = token_counts.PretokenTree.restored(counter, body, pieces, np.array(counts, int), np.array(tokens, int))
                assert counter.known == before and tree.state()[0] == text
                assert (tree.total, tree.length) == (len(codec.encode(text)), len(text))
                continue
            assert [p for j in range(len(tree.leaves)) for p in tree._leaf(j)] == codec.split(text)
            assert (tree.total, tree.length) == (len(codec.encode(text)), len(text))


def test_many_pieces_are_counted_as_one_by_one(codec):
    rng = random.Random(11)
    bits = ["a", "the", " ", "  ", "ou", "tion", "é", "漢", "!", "12", "aaaa", "\n", "zq", "ing", "S"]
    pieces = ["".join(rng.choice(bits) for _ in range(rng.choice([1, 2, 3, 5, 9, 30]))).encode() for _ in range(9000)]
    many = byte_bpe.ManyPieces(codec.merges)
    assert many.counts(pieces).tolist() == [len(codec.machine.encode(p)) for p in pieces]
    assert many.counts([]).tolist() == []


def test_new_pretokens_of_many_texts_are_counted_together(codec):
    rng = random.Random(12)
    texts = ["".join(rng.choice(["qua", "xi", "the ", "zor ", "ñu", "1", "\n", "k" * 70]) for _ in range(n)) for n in (0, 1, 40, 900)]
    c = byte_bpe.Codec(codec.merges.rank, PATTERN)
    trees = token_counts.PretokenTree.of_texts(token_counts.Counter(c), texts)
    assert [(t.total, t.length, t.text()) for t in trees] == [(len(codec.encode(x)), len(x), x) for x in texts]
    c = byte_bpe.Codec(codec.merges.rank, PATTERN)
    token_counts.PretokenTree.of_texts(token_counts.Counter(c), [x.replace("k", "") for x in texts])
    assert not c.machine.steps  # none of them went through the machine


def test_lengths_as_bytes():
    rows = [[], [1, 254, 255, 256, 510, 3], [7], [], [100_000, 1]]
    packed = token_counts._lengths([np.array(x, np.int32) for x in rows])
    assert [sum(x) for x in packed.to_pylist()] == list(map(sum, rows))
    assert [token_counts._from_lengths(x).tolist() for x in packed.to_pylist()] == rows
    short = token_counts._lengths([np.array(x, np.int32) for x in ([3, 4], [], [254])])
    assert short.to_pylist() == [bytes([3, 4]), b"", bytes([254])]


def test_an_edit_reads_little(codec):
    rng = random.Random(5)
    tree = token_counts.PretokenTree(token_counts.Counter(codec), " ".join(rng.choice(["alpha", "beta"]) for _ in range(50_000)))
    for _ in range(200):
        tree.edit(rng.randint(0, tree.length), 0, "zz ")
    assert tree.encoded < 200 * 6


def test_pii_on_random_pieces():
    rng = random.Random(5)
    pieces = ["a", "b.c", "@", "x@y.z", ".", "1", "23", "255", "256.", "1.2.3.4", "-", " ", "+1", "(", "4111 1111 1111 1111",
              "4111-1111-1111-1111", "00", "é", "_%", "+49 30 1234567", "5500000000000004", "\n", "x-y"]
    for _ in range(6000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [s for s in pii.confirmed(text) if s[0] in pii.BASE] == base_pii(text, pii.KINDS)


def test_further_pii_kinds_and_context():
    assert pii.confirmed("IBAN GB82 WEST 1234 5698 7654 32 ok")[-1][0] == "iban"
    assert not [s for s in pii.confirmed("GB83 WEST 1234 5698 7654 32") if s[0] == "iban"]
    plain, near = pii.scored("078-05-1120"), pii.scored("social security 078-05-1120")
    assert not [s for s in plain if s[0] == "ssn"] and [s for s in near if s[0] == "ssn"]
    assert pii.redact("to a@b.cd now") == "to <email> now"


def ibans(text):
    return [text[s:e] for k, s, e in pii.confirmed(text) if k == "iban"]


def test_an_iban_ends_before_the_next_word():
    code, spaced = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    for x in (code, spaced):
        for after in ("", " Bank", " BIC COBADEFFXXX", " X", ", Bank", " A1 bank", " THE ACCOUNT OF THE PAYEE", "\n"):
            assert ibans(x + after) == [x]
        for after in ("Bank", "x", "0"):
            assert ibans(x + after) == []
    assert ibans(f"{code} {spaced} {code} Ende") == [code, spaced, code]
    assert ibans(f"AB12 {spaced} Ende") == [spaced]
    assert pii.redact(f"to {code} Bank") == "to <iban> Bank"
    assert ibans("AB12 " * 100_000 + code + " Bank")[-1].endswith(code)


def test_ibans_on_random_pieces():
    rng = random.Random(8)
    pieces = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO9386011117947", "GB82", " ", " ", " ", "A", "Bank", "BIC",
              "COBADEFFXXX", "12", ".", "\n", "  ", "é", "x"]

    def alnum(c):
        return c.isascii() and c.isalnum()

    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        want, done = [], 0
        for i in range(len(text)):
            if i < done or i and alnum(text[i - 1]):
                continue
            for j in range(min(len(text), i + 70), i, -1):
                code = text[i:j].replace(" ", "")
                if (15 <= len(code) <= 34 and code.isascii() and code.isalnum() and code == code.upper() and "  " not in text[i:j]
                        and text[j - 1] != " " and text[i:i + 2].isalpha() and text[i + 2:i + 4].isdigit()
                        and not (j < len(text) and alnum(text[j])) and pii.mod97(code)):
                    want.append(text[i:j])
                    done = j
                    break
        assert ibans(text) == want


def test_best_against_all_products():
    rng = np.random.default_rng(7)
    for _ in range(40):
        n, d, k = int(rng.integers(1, 60)), int(rng.integers(1, 50)), int(rng.integers(1, 12))
        cand = rng.integers(-3, 4, (n, d)).astype(float)
        ids = rng.permutation(n + 5)[:n].astype(np.int64)
        asked = rng.integers(-3, 4, (4, d)).astype(float)
        who = rng.integers(0, n + 5, 4).astype(np.int64)
        for q, i, (got, score) in zip(asked, who, topk.best(ids, cand, who, asked, k)):
            want = sorted((-int(c @ q), int(j)) for c, j in zip(cand, ids) if j != i)[:k]
            assert [(-int(s), int(j)) for j, s in zip(got, score)] == want


def test_words_keep_their_own_scores_whatever_tasks_hold(spark, tmp_path):
    rng = random.Random(11)
    clean, bad = [f"{a}{b}o" for a in "bcdfg" for b in "aeiou"], [f"{a}{b}x" for a in "klmnp" for b in "aeiou"]
    data = []
    for i in range(600):
        toxic = int(i % 5 == 0)
        data.append((i, " ".join(rng.choices(clean, k=40) + rng.choices(bad, k=6) * toxic), toxic))
    data += [(900, " ".join(clean), None), (901, "never seen words", None), (902, "kax lex", None)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, "doc_id long, text string, toxic int").repartition(3).write.parquet(path)
    rows = spark.read.parquet(path)
    docs, labels = rows.drop("toxic"), rows.select("doc_id", "toxic")

    def scored(**held):
        return {r.doc_id: r for r in toxicity.score(docs, labels, **held).collect()}

    few, none, all_held = scored(held=4), scored(held=0), scored(held=1 << 20)
    assert all(few[i].predicted == t for i, _, t in data if t is not None)
    for i in few:
        for other in (none[i], all_held[i]):
            assert few[i].score == pytest.approx(other.score, abs=1e-6) and few[i].n_words == other.n_words
            assert [x[:2] for x in few[i].segments] == [x[:2] for x in other.segments]
            assert [x.score for x in few[i].segments] == pytest.approx([x.score for x in other.segments], abs=1e-5)
    counts, n = toxicity.lexicon(docs, labels)
    trained = [(set(t.split()), toxic) for i, t, toxic in data if toxic is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    seen = Counter((w, toxic) for ws, toxic in trained for w in ws)
    got = Counter((r.c0 + r.c2, r.c1 + r.c3) for r in counts.collect())
    assert got == Counter((seen[w, 0], seen[w, 1]) for w in {w for w, _ in seen}) and n.sum() == len(trained)


def test_scores_and_passages_against_plain_python(spark, tmp_path):
    """Every document's score and significant passages, from the counts up, word by word."""
    rng = random.Random(21)
    clean = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in ("n", "r", "\u00e9")]
    bad = [f"{a}{b}x" for a in "klmnp" for b in "aeiou"]
    data = []
    for i in range(500):
        toxic = int(i % 4 == 0)
        ws = rng.choices(clean, k=rng.randrange(8, 30)) + rng.choices(bad, k=rng.choice([0, 0, 0, 1, 1, 2]))
        rng.shuffle(ws)
        for _ in range(toxic * rng.randrange(1, 3)):
            at = rng.randrange(len(ws))
            ws[at:at] = rng.choices(bad, k=rng.randrange(3, 6))
        data.append((i, rng.choice(["", "\u4e2d\U0001f600 ", "1. "]) + rng.choice([" ", ", ", "  "]).join(ws).title(), toxic))
    data += [(600, "", None), (601, "K\u00c9x 12", None), (602, None, None)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, "doc_id long, text string, toxic int").repartition(3).write.parquet(path)
    rows = spark.read.parquet(path)
    got = {r.doc_id: r for r in toxicity.score(rows.drop("toxic"), rows.select("doc_id", "toxic"), held=20).collect()}

    fold = {i: zlib.crc32(str(i).encode()) % 3 for i, _, _ in data}
    found = {i: [(m.start(), m.end(), m.group().lower()) for m in re.finditer("[A-Za-z\u0080-\U0010ffff]+", t or "")] for i, t, _ in data}
    train = [(i, toxic) for i, _, toxic in data if toxic is not None and fold[i] != 1]

    def lexicon(folds):
        mine = [(i, t) for i, t in train if fold[i] in folds]
        seen, n = Counter((w, t) for i, t in mine for w in {x[2] for x in found[i]}), Counter(t for _, t in mine)
        share = n[1] / (n[0] + n[1])

        def odds(w):
            prior = toxicity.PRIOR + toxicity.SHARE * (seen[w, 0] + seen[w, 1])
            rate = [(seen[w, t] + prior * p) / (n[t] + prior * p) for t, p in ((0, 1 - share), (1, share))]
            return math.log(rate[1]) - math.log(rate[0]) - toxicity.DRIFT
        return odds

    def segments(i, odds):
        total = np.concatenate([[0], np.cumsum([odds(w) for _, _, w in found[i]])])
        out = []

        def split(lo, hi):
            best = max(((total[b] - total[a], a - b, -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0,))
            if best[0] > 0:
                split(lo, best[3])
                out.append((found[i][best[3]][0], found[i][best[4] - 1][1], best[0]))
                split(best[4], hi)
        split(0, len(found[i]))
        return out

    whole = lexicon((0, 2))
    full = {i: segments(i, whole) for i, _, _ in data}
    other = {0: lexicon((2,)), 2: lexicon((0,))}
    cross = {i: [s for _, _, s in segments(i, other[fold[i]])] for i, _ in train}
    top = {i: max(s, default=0.0) for i, s in cross.items()}
    plain = [i for i, t in train if not t]
    ranked = sorted(top[i] for i in plain)
    at = ranked[math.ceil(0.98 * len(ranked)) - 1]
    cut = math.exp((math.floor(math.log(at) * toxicity.FINE) + 1) / toxicity.FINE)
    size = {i: math.log(len(found[i]) + 1) for i, _, _ in data}
    cells = defaultdict(list)
    for i in plain:
        cells[min(math.floor(top[i] / (cut / toxicity.CELLS)), toxicity.CELLS), math.floor(8 * size[i])].append(size[i])
    keys = sorted(cells)
    lam, ln_k = toxicity.gumbel(np.array([float(k[0]) for k in keys]), np.array([np.mean(cells[k]) for k in keys]),
                                np.array([float(len(cells[k])) for k in keys]), cut / toxicity.CELLS)

    def value(i, scores):
        base = ln_k + size[i]
        v = lam * max(scores, default=0.0) - base
        if v > 0:
            v = sum(max(lam * s - base, 0) for s in scores)
        return min(max(v, toxicity.LOW), toxicity.HIGH)

    bins = defaultdict(lambda: [0, 0])
    for i, t in train:
        b = bins[math.floor(value(i, cross[i]) / toxicity.STEP)]
        b[0] += t
        b[1] += 1
    a, b = toxicity.logistic((np.array(list(bins), float) + 0.5) * toxicity.STEP, *np.array(list(bins.values()), float).T)
    marked = 0
    for i, _, _ in data:
        assert got[i].n_words == len(found[i])
        assert [(x.start, x.end) for x in got[i].segments] == [x[:2] for x in full[i]]
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-(a + b * value(i, [s for _, _, s in full[i]])))), abs=1e-3)
        want = [(x, y, lam * s - ln_k - size[i]) for x, y, s in full[i] if abs(lam * s - ln_k - size[i]) > 1e-3]
        spans = [x for x in got[i].spans if x.value > 1e-3]
        assert [(x.start, x.end) for x in spans] == [x[:2] for x in want if x[2] > 0]
        assert [x.value for x in spans] == pytest.approx([x[2] for x in want if x[2] > 0], abs=1e-2)
        marked += len(spans)
    assert marked > 50


def test_cut_is_exact_whatever_the_partitions(spark):
    rng = random.Random(4)
    scores = [0.0] * 30 + [rng.expovariate(0.3) for _ in range(970)]
    df = spark.createDataFrame([(s,) for s in scores], "s float")
    cuts = {toxicity.upper_cut(df.repartition(n), "s") for n in (1, 5, 13)}
    assert len(cuts) == 1
    cut, at = cuts.pop(), sorted(scores)[979]
    assert at < cut <= at * math.exp(1.01 / toxicity.FINE)
    assert toxicity.upper_cut(df.limit(0), "s") == toxicity.upper_cut(df.where("s = 0"), "s") == 1.0


def test_gumbel_fit_counts_the_best_documents():
    rng = np.random.default_rng(12)
    lam, ln_k = 2.5, -5.5
    ln_n = np.round(rng.uniform(4, 8, 60_000) * 8) / 8
    best = np.maximum(0, (ln_k + ln_n - np.log(-np.log(rng.random(60_000)))) / lam)
    best[:20] = 400.0  # a few documents that follow another law
    width = np.quantile(best, 0.98) / toxicity.CELLS
    cell = np.minimum(np.floor(best / width), toxicity.CELLS)
    got = toxicity.gumbel(cell, ln_n, np.ones(60_000), width)
    assert got == pytest.approx((lam, ln_k), abs=0.1)


def test_logistic_curve_of_well_parted_classes_converges():
    x = np.arange(-12, 24, 0.25) + 0.125
    total = np.round(60_000 * np.exp(-0.5 * np.abs(x))) + 1
    total[-1] = 7000
    toxic = np.zeros_like(x)
    toxic[-1] = 6950
    a, b = toxicity.logistic(x, toxic, total)
    p = 1 / (1 + np.exp(-(a + b * x)))
    assert abs((toxic - total * p).sum()) < 1 and p[-1] > 0.9 and p[x < 12].max() < 0.1


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 100), ("b", "z", 1000)], "l0 string, l1 string, tokens long")

    def dealt(total, weights=None):
        rows = mixing.budgets(leaves, 2, total, weights or {}, 1).collect()
        return {(r.l0, r.l1): int(r.budget) for r in rows}

    assert dealt(100) == {("a", "x"): 10, ("a", "y"): 40, ("b", "z"): 50}       # x is short: y takes it, not b
    assert dealt(400) == {("a", "x"): 10, ("a", "y"): 100, ("b", "z"): 290}     # all of a is short: b takes it
    assert dealt(5000) == {("a", "x"): 10, ("a", "y"): 100, ("b", "z"): 1000}
    assert dealt(100, {("b",): 0}) == {("a", "x"): 10, ("a", "y"): 90}
    assert dealt(90, {("a",): 2, ("*", "y"): 3}) == {("a", "x"): 10, ("a", "y"): 50, ("b", "z"): 30}


def test_mix_takes_the_epochs_it_should(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, "w " * 10, "s%d" % (i >= 8)) for i in range(10)], "doc_id long, text string, source string") \
        .write.parquet(path)
    docs = spark.read.parquet(path)
    rows = mixing.mix(docs, {"source": F.col("source")}, {}, fraction=(1, 1), max_epochs=3).collect()
    got = Counter((r.source, r.epoch) for r in rows)
    # 100 tokens: 50 each; s0 has 80 and gives five documents, s1 has 20: two whole epochs and one document more
    assert got == {("s0", 0): 5, ("s1", 0): 2, ("s1", 1): 2, ("s1", 2): 1}
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)


@pytest.mark.parametrize("kind", ["passage", "copies"])
def test_signatures_meet_in_proportion(kind):
    """One passage in many unlike documents makes no pairs, near copies share keys; both grow with the documents."""
    import pyarrow as pa

    from strata.llm import jaccard_join

    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(80))
    made = []
    for n in (400, 1600):
        own = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 150)) for _ in range(n)] if kind == "passage" else []
        texts = [f"{o} {passage}" for o in own] or [" ".join(f"w{x if i != k % 150 else -k}" for i, x in enumerate(range(150))) for k in range(n)]
        column = pa.array([t.encode() for t in texts], pa.binary())
        often = list(jaccard_join._repeated([pa.record_batch([column], names=["_text"])]))
        keys = np.concatenate([b.column("key").to_numpy().view(np.uint64) for b in often])
        times = np.concatenate([b.column("n").to_numpy() for b in often])
        by_count = keys[np.lexsort((keys, times))]
        order = np.argsort(by_count)
        held = {}
        for _, _, raw, off in jaccard_join.slices(column):
            for u in jaccard_join.shingle_rows(raw, off):
                for k in jaccard_join.signature(u, (by_count[order], order)).tolist():
                    held[k] = held.get(k, 0) + 1
        made.append(sum(c * (c - 1) // 2 for c in held.values()) if kind == "passage" else sum(c for c in held.values() if c > 1))
    assert made[1] <= 6 * made[0] + n and (kind == "copies" or made[1] < n)


def test_frequent_keys_change_no_links():
    """Similar sets meet whatever keys are listed as frequent."""
    from strata.llm import jaccard_join

    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(1, 300))
        u = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        change = int(rng.integers(0, max(1, len(u) // 9 + 1)))
        v = np.unique(np.concatenate([u[change:], rng.integers(0, 1 << 63, int(rng.integers(0, change + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(u, v))
        if not len(v) or 100 * both < 80 * (len(u) + len(v) - both):
            continue
        keys = np.unique(np.concatenate(jaccard_join.layouts(u) + jaccard_join.layouts(v)))
        known = keys[rng.random(len(keys)) < 0.5]
        frequent = known, rng.permutation(len(known))
        assert len(np.intersect1d(jaccard_join.signature(u, frequent), jaccard_join.signature(v, frequent)))
