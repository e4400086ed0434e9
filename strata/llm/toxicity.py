"""Toxicity by maximum-scoring segments.

1. Lexicon.  Every word's log-odds between toxic and other labelled documents, counted
   once per document, with a Dirichlet prior that holds ``PRIOR`` pseudo-documents plus
   a share of the word's own count, split by the two classes' sizes.  The counts cover
   every labelled training row and are a table keyed by the word's 64-bit hash, which
   grows with the vocabulary.
2. Segments.  A word's score is its log-odds less ``DRIFT``, so ordinary text falls.
   One linear scan finds all maximal-scoring segments of a document.  Tasks hold the
   most frequent words, ``HELD`` at most, and join what they know of a document to
   runs: no segment begins or ends inside words that all rise or all fall.  The other
   words meet their counts by key, and then the segments are found in the runs.
3. Calibration.  The best segment of an ordinary document of n words follows an extreme
   value law, S ~ Gumbel(ln(K n) / lambda, 1 / lambda).  lambda and K are fitted by
   likelihood to all ordinary training documents, in cells of score and length.  The
   best-scoring 2 % count as no more than being above the 98th percentile (censored), so
   that one very long or mislabelled document does not set the scale; documents without
   a rising word count as below the first cell.  A segment's value is
   lambda S - ln(K n); a document's is the sum over its significant segments (value
   above 0), or its best value if none is.  A logistic curve turns that into a
   probability.  So that a training document does not vouch for itself, the
   training rows are split in two folds, and calibration uses, for each, the lexicon
   of the other.

Training rows are those with crc32(id as text) mod 3 other than 1.  A score depends on
the text alone.  Defined cases: null and empty texts have no words and the value of
an empty scan; a row with a null id is scored and never trained on; labels that are
null are skipped, of repeated label rows for an id the largest label counts; with no
labelled row of either class every score is 0; other columns are ignored; repeated
rows are scored each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import byte_views, few_rows, fresh, staged, tidied, worker_tables
from strata.llm.textscan import LETTER, lower_latin, prefix_hash, slices, span_hash, words

#: words that every task holds
HELD = 1 << 18
PRIOR, SHARE, DRIFT = 3.0, 0.02, 1.5
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: bins of the document value for the logistic fit: from, to, width
LOW, HIGH, STEP = -12.0, 24.0, 0.25
#: cells of the best score, up to its 98th percentile, for the Gumbel fit; cells for each factor e to find that percentile
CELLS, FINE = 64, 256


def fold(id_col):
    """crc32 of the id's text, modulo 3."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def _tokens(raw, off):
    """Row, hash, start and end byte of every word."""
    text = lower_latin(raw)
    row, start, end = words(text, off, LETTER)
    return row, span_hash(prefix_hash(text), start, end), start, end


def _word_sets(batches):
    """Every document's distinct words, as hashes of eight bytes."""
    worker_tables("toxicity")
    for b in few_rows(batches):
        sets = []
        for at, end, raw, off in slices(b.column("text")):
            row, word, _, _ = _tokens(raw, off)
            cut = np.searchsorted(row, np.arange(end - at + 1))
            sets += [np.unique(word[i:j]).tobytes() for i, j in zip(cut[:-1], cut[1:])]
        yield pa.record_batch([b.column("k"), b.column("fold"), pa.array(sets, pa.binary())], names=["k", "fold", "words"])


_COUNTS = ["c0", "c1", "c2", "c3"]
#: words that a counting task holds before it hands on their sums
_HELD = 1 << 21


def _sums(word: np.ndarray, kind: np.ndarray):
    order = np.argsort(word)
    word, kind = word[order], kind[order]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    sums = [np.add.reduceat((kind == j).astype(np.int64), first) for j in range(4)]
    word = word[first].view(np.int64)
    for k in range(0, len(word), 50_000):
        yield pa.record_batch([pa.array(x[k:k + 50_000]) for x in (word, *sums)], names=["word", *_COUNTS])


def _count(batches):
    """Per task: in how many documents each word occurs, by fold (0, 2) and label; a null word counts the documents."""
    worker_tables("toxicity")
    docs = np.zeros(4, dtype=np.int64)
    held, size = [], 0
    for b in few_rows(batches):
        kind = (b.column("fold").to_numpy(zero_copy_only=False) // 2) * 2 + b.column("toxic").to_numpy(zero_copy_only=False)
        docs += np.bincount(kind, minlength=4)
        raw, off = byte_views(b.column("words"))
        word = np.frombuffer(raw.tobytes(), dtype=np.uint64)
        held.append((word, np.repeat(kind, np.diff(off) // 8).astype(np.int8)))
        size += len(word)
        if size >= _HELD:
            yield from _sums(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield from _sums(*map(np.concatenate, zip(*held)))
    yield pa.record_batch([pa.array([None], pa.int64())] + [pa.array(docs[j:j + 1]) for j in range(4)], names=["word", *_COUNTS])


def lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, np.ndarray]:
    """Counts of every word (``word, c0, c1, c2, c3, level``) in training documents, and the numbers of documents.

    c0 and c1 count ordinary and toxic documents of fold 0, c2 and c3 those of fold 2;
    ``level`` is eight times the logarithm to base 2 of their sum.
    """
    marks = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()) \
        .groupBy(F.col(id_col).alias("k")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    rows = docs.select(F.col(id_col).alias("k"), fold(id_col).cast("int").alias("fold"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).where(F.col("fold") != HELD_OUT)
    # only the word sets meet the labels, not the texts; joins are planned alike at every size
    sets = rows.mapInArrow(tidied(_word_sets), f"k {rows.schema['k'].dataType.simpleString()}, fold int, words binary")
    counts = sets.join(marks.where(fold("k") != HELD_OUT).hint("merge"), "k").select("fold", "toxic", "words").mapInArrow(
        tidied(_count), "word long, c0 long, c1 long, c2 long, c3 long") \
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    counts = staged(counts.withColumn("level", F.floor(8 * F.log2(sum(F.col(c) for c in _COUNTS))).cast("int")), "lexicon")
    total = counts.where("word IS NULL").select(*_COUNTS).first()
    return counts.where("word IS NOT NULL"), np.array(total or (0, 0, 0, 0), dtype=np.float64)


def log_odds(counts, docs: np.ndarray) -> np.ndarray:
    """Scores of words from their four counts: row 0 learnt from fold 0, row 1 from fold 2, row 2 from both."""
    n = np.asarray(counts, dtype=np.float64)
    out = np.zeros((3, n.shape[1]), dtype=np.float32)
    for j, (c, t) in enumerate((([0], [1]), ([2], [3]), ([0, 2], [1, 3]))):
        clean, toxic, nc, nt = n[c].sum(axis=0), n[t].sum(axis=0), docs[c].sum(), docs[t].sum()
        if not nc or not nt:
            out[j] = -DRIFT
            continue
        share = nt / (nt + nc)
        prior = PRIOR + SHARE * (clean + toxic)
        out[j] = (np.log((toxic + prior * share) / (nt + prior * share))
                  - np.log((clean + prior * (1 - share)) / (nc + prior * (1 - share))) - DRIFT)
    return out


def frequent(words: DataFrame, docs: np.ndarray, most: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The least level that no more than ``most`` words reach, those words' hashes in order, and their scores.

    A last place, not below any hash, has no score.
    """
    levels = words.groupBy("level").count().collect()  # at most eight for each doubling of the documents
    level, size = 1 + max((r["level"] for r in levels), default=0), 0
    for r in sorted(levels, key=lambda r: -r["level"]):
        size += r["count"]
        if size > most:
            break
        level = r["level"]
    got = words.where(F.col("level") >= level).select("word", *_COUNTS).toArrow()
    word = got.column("word").to_numpy().view(np.uint64)
    order = np.argsort(word)
    table = log_odds([got.column(c).to_numpy()[order] for c in _COUNTS], docs)
    last = np.full((3, 1), np.nan, dtype=np.float32)
    return level, np.append(word[order], np.uint64(0xFFFFFFFFFFFFFFFF)), np.concatenate([table, last], axis=1)


def maximal_segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, score) of a score sequence, in order, in linear time.

    Each candidate keeps the total before it and the total at its end; a new rise is
    joined to the nearest earlier candidate that starts lower, as long as that one
    also ends lower.
    """
    total = np.cumsum(score, dtype=np.float64)
    out: list[tuple[int, int, float, float, int]] = []  # first, end, total before, total at end, lower candidate
    for i in np.flatnonzero(score > 0).tolist():
        first, end, before, after = i, i + 1, total[i] - score[i], total[i]
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= after:
                break
            first, before, j = out[j][0], out[j][2], out[j][4]
            while out and out[-1][0] >= first:
                out.pop()
        out.append((first, end, before, after, j))
    return [(f, e, a - b) for f, e, b, a, _ in out]


_RUNS = "n_words long, runs binary, others array<long>"
_RUN = np.dtype([("full", "<f8"), ("cross", "<f8"), ("start", "<i4"), ("end", "<i4")])
_SCANNED = ("n_words long, best float, segments array<struct<start:int,end:int,score:float>>, fold_best float, "
            "fold_segments array<float>")


def _own(table: np.ndarray, folds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Scores by the lexicon that a row's calibration uses: that of the other fold, or of both if it has none."""
    return table[np.where(folds == 0, 1, np.where(folds == 2, 0, 2)), at]


def _scan(lex):
    """Documents as runs of known words and single others: the runs' scores by both lexicons, NaN for an other
    word, and their places in code points."""
    def run(batches):
        worker_tables("toxicity")
        known, table = lex.value
        for b in few_rows(batches):
            folds = b.column("_fold").to_numpy(zero_copy_only=False)
            n, runs, others = [], [], []
            for at, end, raw, off in slices(b.column("_text")):
                row, word, start, stop = _tokens(raw, off)
                before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])  # characters that begin before a byte
                cut = np.searchsorted(row, np.arange(end - at + 1))
                place = np.searchsorted(known, word)
                mine = known[place] == word
                full = np.where(mine, table[2][place], np.nan).astype(np.float64)
                cross = np.where(mine, _own(table, folds[at:end][row], place), np.nan).astype(np.float64)
                other = np.isnan(full)
                code = (full > 0) + 2 * (cross > 0)
                new = np.ones(len(word), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1]) | other[1:] | other[:-1]
                first = np.flatnonzero(new)
                out = np.empty(len(first), dtype=_RUN)
                if len(first):
                    out["full"], out["cross"] = np.add.reduceat(full, first), np.add.reduceat(cross, first)
                    base = before[off[row[first]]]
                    out["start"] = before[start[first]] - base
                    out["end"] = before[stop[np.append(first[1:], len(word)) - 1]] - base
                edge = np.searchsorted(first, cut)
                single, edges = word[other].view(np.int64), np.searchsorted(np.flatnonzero(other), cut)
                n.append(np.diff(cut))
                runs += [out[i:j].tobytes() for i, j in zip(edge[:-1], edge[1:])]
                others += [single[i:j] for i, j in zip(edges[:-1], edges[1:])]
            keep = [c for c in b.schema.names if c != "_text"]
            yield pa.record_batch([b.column(c) for c in keep] + [
                pa.array(np.concatenate(n) if n else [], pa.int64()), pa.array(runs, pa.binary()),
                pa.array(others, pa.list_(pa.int64()))], names=[*keep, "n_words", "runs", "others"])
    return run


def _segments(docs: np.ndarray):
    """Segments of documents in runs, whose other words have ``found`` counts or none."""
    def one(score):
        s = maximal_segments(score)
        return max((x[2] for x in s), default=0.0), s

    def run(batches):
        worker_tables("toxicity")
        unseen = log_odds(np.zeros((4, 1)), docs)
        for b in few_rows(batches):
            folds = b.column("_fold").to_numpy(zero_copy_only=False)
            best, segs, many, fbest, fsegs = [], [], [0], [], []
            found = b.column("found")
            for i in range(b.num_rows):
                runs = np.frombuffer(b.column("runs")[i].as_py(), dtype=_RUN)
                full, cross = runs["full"].astype(np.float64), runs["cross"].astype(np.float64)
                others = b.column("others")[i].values.to_numpy()
                if len(others):
                    table, place = unseen, np.zeros(len(others), dtype=np.int64)
                    if found[i].is_valid:
                        got = found[i].values
                        word = got.field("word").to_numpy()
                        order = np.argsort(word)
                        table = np.concatenate([log_odds([got.field(c).to_numpy()[order] for c in _COUNTS], docs), unseen], axis=1)
                        place = np.searchsorted(word[order], others)
                        place[np.append(word[order], 0)[place] != others] = len(word)
                    hole = np.isnan(full)
                    full[hole] = table[2][place]
                    cross[hole] = _own(table, np.full(len(others), folds[i]), place)
                x, s = one(full)
                best.append(x), many.append(many[-1] + len(s))
                segs += [(runs["start"][first], runs["end"][end - 1], score) for first, end, score in s]
                x, s = (0.0, []) if folds[i] == HELD_OUT or folds[i] < 0 else one(cross)
                fbest.append(x), fsegs.append([score for _, _, score in s])
            keep = [c for c in b.schema.names if c not in ("_fold", "runs", "others", "found")]
            parts = [pa.array([x[j] for x in segs], t) for j, t in enumerate((pa.int32(), pa.int32(), pa.float32()))]
            spans = pa.ListArray.from_arrays(pa.array(many, pa.int32()), pa.StructArray.from_arrays(parts, ["start", "end", "score"]))
            yield pa.record_batch([b.column(c) for c in keep] + [
                pa.array(best, pa.float32()), spans, pa.array(fbest, pa.float32()), pa.array(fsegs, pa.list_(pa.float32()))],
                names=[*keep, "best", "segments", "fold_best", "fold_segments"])
    return run


def scan(rows: DataFrame, words: DataFrame, docs: np.ndarray, held: int) -> DataFrame:
    """``doc_id, rid`` and the segments of ``rows`` (``doc_id, rid, _fold, _text``); tasks hold ``held`` words at most."""
    level, *table = frequent(words, docs, held)
    lex = rows.sparkSession.sparkContext.broadcast(table)
    head = T.StructType(rows.schema.fields[:3]).simpleString()[7:-1].replace(":", " ")
    runs = staged(rows.mapInArrow(tidied(_scan(lex)), f"{head}, {_RUNS}"), "runs")
    found = runs.select("rid", F.explode(F.array_distinct("others")).alias("word")) \
        .join(words.where(F.col("level") < level).select("word", *_COUNTS).hint("merge"), "word") \
        .groupBy("rid").agg(F.collect_list(F.struct("word", *_COUNTS)).alias("found"))
    head = T.StructType(rows.schema.fields[:2]).simpleString()[7:-1].replace(":", " ")
    return staged(runs.join(found.hint("merge"), "rid", "left").select("doc_id", "rid", "_fold", "n_words", "runs", "others", "found")
                  .mapInArrow(tidied(_segments(docs)), f"{head}, {_SCANNED}"), "segments")


def gumbel(cell: np.ndarray, ln_n: np.ndarray, count: np.ndarray, width: float) -> tuple[float, float]:
    """lambda and ln K by likelihood from numbers of documents by score cell and ln words.

    Cell k reaches from k to k + 1 widths; the first is open below and the last (``CELLS``) above.
    """
    low = np.where(cell > 0, cell * width, -np.inf)
    high = np.where(cell < CELLS, (cell + 1) * width, np.inf)

    def loss(at):
        lam, ln_k = math.exp(at[0]), at[1]
        with np.errstate(over="ignore"):
            below, above = (np.exp(-np.exp(np.minimum(ln_k + ln_n - lam * s, 700))) for s in (low, high))
        return -(count * np.log(np.maximum(above - below, 1e-300))).sum()

    at = np.array([math.log(4 / (CELLS * width)), 4 + math.log(0.02) - np.average(ln_n, weights=count)])
    step, best = 1.0, loss(at)
    while step > 1e-5:
        moves = [at + step * np.array(d) for d in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1), (1, -1), (-1, 1))]
        gains = [loss(m) for m in moves]
        if min(gains) < best:
            at, best = moves[int(np.argmin(gains))], min(gains)
        else:
            step /= 2
    return math.exp(at[0]), float(at[1])


def _base(n_words, ln_k: float):
    return F.lit(ln_k) + F.log(F.col(n_words) + 1)


def upper_cut(best: DataFrame, column: str, share: float = 0.98) -> float:
    """The score that ``share`` of the rows stay below, rounded up to one of ``FINE`` cells for each factor e.

    The cells' counts are exact, so the cut does not depend on how rows are partitioned.  1 if
    that many rows have no positive score.
    """
    cells = best.groupBy(F.when(F.col(column) > 0, F.floor(F.log(column) * FINE)).alias("cell")).count().collect()
    left = share * sum(r["count"] for r in cells)
    for r in sorted(cells, key=lambda r: -math.inf if r["cell"] is None else r["cell"]):
        left -= r["count"]
        if left <= 0:
            return 1.0 if r["cell"] is None else math.exp((r["cell"] + 1) / FINE)
    return 1.0


def _value(best, segments, n_words, lam: float, ln_k: float):
    """The document's calibrated value: sum of its significant segments, else that of its best."""
    base = _base(n_words, ln_k)
    parts = F.aggregate(F.col(segments), F.lit(0.0), lambda acc, s: acc + F.greatest(F.lit(lam) * s - base, F.lit(0.0)))
    top = F.lit(lam) * F.col(best) - base
    return F.least(F.greatest(F.when(top > 0, parts).otherwise(top), F.lit(LOW)), F.lit(HIGH))


def logistic(x: np.ndarray, toxic: np.ndarray, total: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a logistic curve, by Newton steps with a slight ridge, halved until they gain."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)

    def loss(w):
        z = design @ w
        return (total * np.logaddexp(0, z) - toxic * z).sum() + 5e-4 * w @ w

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        grad = design.T @ (toxic - total * p) - 1e-3 * w
        hess = (design * (total * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step, now = np.linalg.solve(hess, grad), loss(w)
        while loss(w + step) > now and np.abs(step).max() >= 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1]))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: int = HELD) -> DataFrame:
    """One row per document: ``doc_id, rid, held_out, score, predicted, n_words, segments, spans``.

    ``rid`` numbers the rows of ``docs``; ``segments`` are the maximal segments (start, end, score), ``spans`` the
    significant ones with their calibrated value, both by place, in code points of the text, from the first
    character of the first word to the end of the last.
    Results do not depend on ``held``, the number of words that tasks hold, but for rounding.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       F.coalesce(fold(id_col), F.lit(-1)).cast("int").alias("_fold"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    scanned = scan(rows, *lexicon(docs, labels, id_col, text_col), held)
    marks = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & (fold(id_col) != HELD_OUT)) \
        .groupBy(F.col(id_col).alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic"))
    train = staged(scanned.join(marks, "doc_id").select("toxic", "n_words", "fold_best", "fold_segments"), "calibration")
    plain = train.where("toxic = 0").withColumn("ln_n", F.log(F.col("n_words") + 1))
    cut = upper_cut(plain, "fold_best")
    cells = plain.groupBy(F.least(F.floor(F.col("fold_best") / (cut / CELLS)), F.lit(CELLS)).alias("cell"),
                          F.floor(8 * F.col("ln_n")).alias("size")) \
        .agg(F.count("*").alias("n"), F.avg("ln_n").alias("ln_n")).toPandas()  # CELLS + 1 by eight for each factor e of length
    lam, ln_k = gumbel(*(cells[c].to_numpy(float) for c in ("cell", "ln_n", "n")), cut / CELLS) if len(cells) else (1.0, 0.0)
    bins = train.groupBy(F.floor(_value("fold_best", "fold_segments", "n_words", lam, ln_k) / STEP).alias("bin")) \
        .agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).toPandas()  # at most (HIGH - LOW) / STEP + 1 rows
    toxic, n = bins["toxic"].to_numpy(float), bins["n"].to_numpy(float)
    value = _value("best", "segments.score", "n_words", lam, ln_k)
    if len(bins) and 0 < toxic.sum() < n.sum():
        a, b = logistic((bins["bin"].to_numpy(float) + 0.5) * STEP, toxic, n)
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * value)))
    else:
        prob = F.lit(0.0)
    held = F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False))
    base = _base("n_words", ln_k)
    spans = F.filter(F.transform("segments", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score"),
        (F.lit(lam) * s["score"] - base).alias("value"))), lambda s: s["value"] > 0)
    return scanned.withColumn("score", prob).select(
        "doc_id", "rid", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_words", "segments", spans.alias("spans"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents predicted toxic; columns unchanged."""
    rid = fresh(docs, "_row")
    gone = score(docs, labels, id_col, text_col).where("predicted = 1").select(F.col("rid").alias(rid))
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(gone, rid, "left_anti").select(*docs.columns)
