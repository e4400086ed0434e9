"""Similarity join of documents by word shingles: parity sketches, pigeonhole, verification.

A document's set is its distinct five-word shingles (64-bit hashes).  Documents with equal
sets form a class; classes are joined.

1. Parity sketch.  In a size band (sizes from 4^k to below 4^(k+1)) the hash range is cut
   into parts, and the hashes in a part are XORed.  Every element that only one of two sets
   has changes one part at most, so the number of parts that differ is no more than
   the size of the symmetric difference.
2. Pigeonhole.  Similar sets a, b with |a & b| >= 0.8 |a | b| differ in at most
   (|a| + |b|) / 9 elements, so of a's filled parts all but that many are in b as well.
   Both sets put their filled parts in one order that holds
   for all sets, rare keys first; the first (most differences) + 1 of each must then have
   one in common.  For this order the most frequent keys (``FREQUENT`` at most, by counts of
   tasks) are listed and put last; which keys are listed changes work, not links.  A set
   near the top of its band also joins the next band.  A set with too few filled parts for
   this also joins by single shingles, for which the same counting holds.
3. Shared parts.  Keys are dealt to groups by their leading bits, in packed blocks.  A task
   forwards a key once however many of its documents have it, so a very common key is as
   small as the number of tasks.  The result is every (key, class) whose key two
   classes share.
4. Rounds.  Every class is verified against one neighbour: of the classes that stand
   for the least component in one of its keys, the one with which it shares most keys.
   Components move to the least one they are linked to, and this is done again, until a
   round brings few links.  Large groups of near copies are joined here, with one
   verification for each class and round.
5. The rest.  Keys whose classes are all in one component are done.  In the other keys,
   all pairs across components are tried.  Links within a component that is
   already joined change nothing and are not looked for.
6. Components of all links (``components``).

Before a pair is verified, its whole parity sketches (two to four bits an element; one
bit an element flips) are compared: their Hamming distance bounds the symmetric
difference too.  Verification compares the shingle sets of the whole texts.

Defined cases: null, empty and blank texts have an empty set and link with nothing;
fewer than five words make one shingle; null ids are larger than none (a component's id is
its least id that is not null); repeated rows are equal sets and link; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_views, few_rows, fresh, staged, tidied, worker_tables
from strata.llm.components import components
from strata.llm.textscan import ASCII_LOWER, WHITE, mix, prefix_hash, slices, span_hash, words

WIDTH = 5
SKETCH_BITS = 512
#: a pair of classes, the keys they share in a round, the component of ``b`` and the one of ``a``
PAIR = ("a", "b", "n", "label", "to")
_PAIR = ", ".join(f"{c} long" for c in PAIR)
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
#: rounds of the fourth step at most, and the part of the first round's links under which a round is the last one;
#: what they leave, the fifth step finds
MOST_ROUNDS, WORTH = 12, 20
#: frequent keys that tasks hold; keys that a task counts together
FREQUENT, COUNTED = 1 << 16, 1 << 22
#: doublings of a component's way to its least one in a round
HOPS = 2
#: shared keys that a task of the third step should hold at most, on average
GROUP_KEYS = 400_000
_WIDTH_BASE = np.uint64(0x9FB21C651E98DF25)
_U32 = np.uint64(32)


def shingle_rows(raw: np.ndarray, off: np.ndarray):
    """The sorted distinct shingle hashes of every row."""
    text = ASCII_LOWER[raw]
    row, start, end = words(text, off, ~WHITE)
    h = span_hash(prefix_hash(text), start, end)
    cut = np.searchsorted(row, np.arange(len(off)))
    run = h.copy()
    for k in range(1, WIDTH):
        run[:-k] = run[:-k] * _WIDTH_BASE + h[k:] if k < len(h) else run[:-k]
    # run[i] is exact for words i .. i + 4 of a row; shorter rows are put together below
    run = mix(run)
    for i in range(len(off) - 1):
        lo, hi = cut[i], cut[i + 1]
        if hi - lo >= WIDTH:
            yield np.unique(run[lo:hi - WIDTH + 1])
        elif hi > lo:
            acc = np.array([hi - lo], dtype=np.uint64)
            for x in h[lo:hi]:
                acc = acc * _WIDTH_BASE + x
            yield mix(acc)
        else:
            yield h[:0]


def most_differences(n: int) -> int:
    """The largest symmetric difference that a set of ``n`` elements may have with a similar one."""
    return (n + 5 * n // 4) // 9


def _keys(u: np.ndarray, band: int) -> np.ndarray:
    """Keys of the filled parts of a sketch, in a band's layout."""
    parts = np.uint64(max(8, (13 << (2 * band)) // 10))
    place = ((u >> _U32) * parts) >> _U32
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    value = np.bitwise_xor.reduceat(mix(u), first)
    return mix(value ^ mix(place[first] * np.uint64(64) + np.uint64(band + 1)))


def layouts(u: np.ndarray) -> list[np.ndarray]:
    """Keys by which a set can meet similar ones: of its filled parts, in one band or two, and of single shingles if these are few."""
    n = len(u)
    if not n:
        return []
    band = (n.bit_length() - 1) // 2
    out = []
    for b in (band, band + 1) if 5 * n // 4 >= 4 << (2 * band) else (band,):
        out.append(_keys(u, b))
        if len(out[-1]) <= most_differences(n):  # single shingles, in a layout of their own
            out.append(mix(u ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    return out


#: no key is known to be frequent
NONE = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)


def signature(u: np.ndarray, frequent: tuple[np.ndarray, np.ndarray] = NONE) -> np.ndarray:
    """The keys by which a set meets every set similar to it.

    ``frequent`` has sorted keys and their places in order of frequency; they come after all others.
    """
    d, (known, rank) = most_differences(len(u)), frequent
    out = []
    for keys in layouts(u):
        late = np.zeros(len(keys), dtype=np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            late = np.where(known[at] == keys, rank[at] + 1, 0)
        out.append(keys[np.lexsort((keys, late))[:d + 1]])
    return np.unique(np.concatenate(out)) if out else u


def _repeated(batches):
    """The most frequent keys of every few million that a task reads: ``key, n``."""
    def most(held):
        keys, n = np.unique(np.concatenate(held), return_counts=True)
        keys, n = keys[n > 1], n[n > 1]
        if len(keys) > FREQUENT:
            use = np.argpartition(-n, FREQUENT)[:FREQUENT]
            keys, n = keys[use], n[use]
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    worker_tables("jaccard_join")
    held, size, seen = [], 0, set()
    for b in few_rows(batches):
        for _, _, raw, off in slices(b.column("_text")):
            for u in shingle_rows(raw, off):
                node = class_of(u)
                if node not in seen:
                    seen.add(node)
                    held += layouts(u)
                    size += 2 * len(u)
                    if size >= COUNTED:
                        yield most(held)
                        held, size, seen = [], 0, set()
    if size:
        yield most(held)


def parity(u: np.ndarray) -> np.ndarray:
    """Parity bits of a set, two to four for each element and 512 at least, as 64-bit numbers."""
    size = max(SKETCH_BITS, 1 << (2 * len(u) - 1).bit_length()) if len(u) else SKETCH_BITS
    bits = (np.bincount((u & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(np.int64)


def folded(sketch: np.ndarray, length: int) -> np.ndarray:
    """The same set's sketch at a smaller power of two of 64-bit numbers."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, length), axis=0)


def class_of(u: np.ndarray) -> int:
    """A set's 64-bit identifier."""
    return int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)


def _describe(batches):
    worker_tables("jaccard_join")
    for b in few_rows(batches):
        n, node, sketch, short = [], [], [], []
        for _, _, raw, off in slices(b.column("_text")):
            for u in shingle_rows(raw, off):
                x = parity(u)
                n.append(len(u)), node.append(class_of(u)), sketch.append(x.tobytes()), short.append(folded(x, len(SKETCH)))
        bits = np.array(short, dtype=np.int64).reshape(len(n), len(SKETCH))
        yield pa.record_batch([b.column("doc_id"), b.column("rid"), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                               pa.array(sketch, pa.binary())] + [pa.array(bits[:, i]) for i in range(len(SKETCH))],
                              names=["doc_id", "rid", "n_shingles", "node", "sketch", *SKETCH])


_BLOCK = "part int, keys binary, nodes binary, told binary, told_nodes binary"


def _deal(groups: int, frequent):
    """Packed (key, class) blocks by group; of keys that several classes of a batch have, one mark each."""
    shift = np.uint64(64 - (groups.bit_length() - 1))

    def run(batches):
        worker_tables("jaccard_join")
        for b in batches:
            keys, nodes, seen = [], [], set()
            for _, _, raw, off in slices(b.column("_text")):
                for u in shingle_rows(raw, off):
                    node = class_of(u)
                    if len(u) and node not in seen:
                        seen.add(node)
                        s = signature(u, frequent.value)
                        keys.append(s), nodes.append(np.full(len(s), node, dtype=np.int64))
            if not keys:
                continue
            keys, nodes = np.concatenate(keys), np.concatenate(nodes)
            order = np.argsort(keys)
            keys, nodes = keys[order], nodes[order]
            same = keys[1:] == keys[:-1]
            shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            first = np.concatenate([[True], ~same])
            # one entry a key goes on: its class, or the mark 0 if several classes of this batch have it
            sent, to = keys[first], np.where(shared, 0, nodes)[first]
            part = (sent >> shift).astype(np.int64)
            told, told_nodes = keys[shared], nodes[shared]
            tpart = (mix(told_nodes.view(np.uint64)) >> shift).astype(np.int64)
            order = np.argsort(tpart, kind="stable")
            told, told_nodes, tpart = told[order], told_nodes[order], tpart[order]
            used = np.union1d(part, tpart)
            a, z = np.searchsorted(part, used), np.searchsorted(part, used, side="right")
            c, e = np.searchsorted(tpart, used), np.searchsorted(tpart, used, side="right")
            yield pa.record_batch([
                pa.array(used, pa.int32()),
                pa.array([sent[i:j].tobytes() for i, j in zip(a, z)], pa.binary()),
                pa.array([to[i:j].tobytes() for i, j in zip(a, z)], pa.binary()),
                pa.array([told[i:j].tobytes() for i, j in zip(c, e)], pa.binary()),
                pa.array([told_nodes[i:j].tobytes() for i, j in zip(c, e)], pa.binary())],
                names=["part", "keys", "nodes", "told", "told_nodes"])
    return run


def _unpack(column, kind) -> np.ndarray:
    return np.frombuffer(byte_views(column)[0].tobytes(), dtype=kind)


def _shared(table: pa.Table) -> pa.Table:
    """The (key, class) rows of keys that several classes have."""
    keys, nodes = _unpack(table.column("keys"), np.int64), _unpack(table.column("nodes"), np.int64)
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    if len(keys):
        first = np.concatenate([[True], keys[1:] != keys[:-1]])
        which = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        # a key is shared if it has a mark or two different classes
        shared = (np.minimum.reduceat(nodes, at) != np.maximum.reduceat(nodes, at)) \
            | np.logical_or.reduceat(nodes == 0, at)
        use = shared[which] & (nodes != 0)
        keys, nodes = keys[use], nodes[use]
    told, told_nodes = _unpack(table.column("told"), np.int64), _unpack(table.column("told_nodes"), np.int64)
    return pa.table({"key": np.concatenate([keys, told]), "node": np.concatenate([nodes, told_nodes])})


def _kept(b: pa.RecordBatch, keep: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([b.column(c).filter(pa.array(keep)) for c in PAIR], names=list(PAIR))


def _close(batches):
    """Keep the pairs whose whole sketches differ in no more bits than similar sets can."""
    for b in batches:
        most = (b.column("na").to_numpy() + b.column("nb").to_numpy()) // 9
        keep = np.zeros(b.num_rows, dtype=bool)
        for i, (x, y) in enumerate(zip(b.column("sa"), b.column("sb"))):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            size = min(len(x), len(y))
            keep[i] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum() <= most[i]
        yield _kept(b, keep)


def _verify(batches):
    """Keep the pairs whose texts' sets are similar."""
    for b in batches:
        keep = np.zeros(b.num_rows, dtype=bool)
        left = (u for _, _, raw, off in slices(b.column("a_text")) for u in shingle_rows(raw, off))
        right = (u for _, _, raw, off in slices(b.column("b_text")) for u in shingle_rows(raw, off))
        for i, (u, v) in enumerate(zip(left, right)):
            both = len(np.intersect1d(u, v, assume_unique=True))
            keep[i] = 100 * both >= 80 * (len(u) + len(v) - both)
        yield _kept(b, keep)


def near(a: str, b: str):
    """Whether two nodes' sizes and folded sketches allow them to be similar."""
    distance = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH[1:]),
                   F.bit_count(F.col(f"{a}.{SKETCH[0]}").bitwiseXOR(F.col(f"{b}.{SKETCH[0]}"))))
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (5 * na >= 4 * nb) & (5 * nb >= 4 * na) & (9 * distance <= na + nb)


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, rid, n_shingles, node`` (its class), ``component_id``, ``kept``.

    ``kept`` marks one row of each component, the one with the least id; a document
    with an empty set is its own component.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    about = staged(rows.mapInArrow(tidied(_describe), f"doc_id {kind}, rid long, n_shingles long, node long, sketch binary, "
                                   + ", ".join(f"{s} long" for s in SKETCH)), "sets", "zstd")
    filled = about.where("n_shingles > 0")
    total = filled.agg(F.sum("n_shingles")).first()[0] or 0
    groups = 1 << max(6, int(total * 0.3 / GROUP_KEYS)).bit_length()
    often = rows.select("_text").mapInArrow(tidied(_repeated), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    often = often.column("key").to_numpy().view(np.uint64)[::-1]
    order = np.argsort(often)
    frequent = docs.sparkSession.sparkContext.broadcast((often[order], order))
    blocks = rows.select("_text").mapInArrow(tidied(_deal(groups, frequent)), _BLOCK)
    shared = staged(blocks.groupBy("part").applyInArrow(_shared, "key long, node long"), "shared")

    rep = filled.groupBy("node").agg(F.min("rid").alias("rid"))
    nodes = staged(shared.select("node").distinct().join(rep, "node").join(
        filled.drop("doc_id", "node"), "rid"), "classes")
    sizes, sketches = nodes.drop("rid", "sketch"), nodes.select("node", "n_shingles", "sketch")

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose whole sketches are near enough."""
        both = pairs.join(sketches.toDF("a", "na", "sa"), "a").join(sketches.toDF("b", "nb", "sb"), "b")
        return staged(both.select(*PAIR, "na", "nb", "sa", "sb").mapInArrow(tidied(_close), _PAIR), "close")

    def star(member: DataFrame, turn: int) -> DataFrame:
        """Every class with a class of the least component in each of its keys; another one every turn."""
        least = staged(member.groupBy("key").agg(F.min(F.struct("label", F.xxhash64("node", F.lit(turn)), "node")).alias("top"))
                       .select("key", F.col("top.label").alias("to"), F.col("top.node").alias("a")), "least")
        tried = member.join(least, "key").where("label <> to").groupBy("a", F.col("node").alias("b")) \
            .agg(F.count("*").alias("n"), F.min("label").alias("label"), F.min("to").alias("to"))
        tried = tried.join(sizes.alias("x"), F.col("a") == F.col("x.node")) \
            .join(sizes.alias("y"), F.col("b") == F.col("y.node")).where(near("x", "y")).select(*PAIR)
        one = tried.groupBy("b").agg(F.max(F.struct("n", "a", "label", "to")).alias("top")).select("b", "top.*")
        return close(one.select(*PAIR))

    def rounds(member: DataFrame, linked) -> tuple[DataFrame, list[DataFrame]]:
        """Star rounds; ``linked`` keeps pairs that are links."""
        found, first = [], None
        for turn in range(MOST_ROUNDS):
            links = linked(star(member, turn))
            found.append(links)
            n = links.count()
            first = first or n
            if not n:
                break
            member = joined_on(member, links)
            if WORTH * n < first:
                break
        return member, found

    def joined_on(member: DataFrame, links: DataFrame) -> DataFrame:
        """Components move to the least component that they have a link to, and on to where that moves (labels only fall)."""
        step = staged(links.groupBy("label").agg(F.min("to").alias("to")), "steps")
        for _ in range(HOPS):
            further = step.select(F.col("label").alias("to"), F.col("to").alias("next"))
            step = staged(step.join(further, "to", "left").select("label", F.coalesce("next", "to").alias("to")), "steps")
        return staged(member.join(step, "label", "left").select("key", "node", F.coalesce("to", "label").alias("label")), "member")

    def across(member: DataFrame) -> DataFrame:
        """All pairs of classes that share a key and are not known to be in one component."""
        split = staged(member.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                       .where("lo <> hi").select("key"), "open")
        rows = staged(member.join(split, "key", "left_semi").join(sizes, "node"), "members")
        x, y = rows.alias("x"), rows.alias("y")
        none = F.lit(0).cast("long")
        return close(x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node"))
                            & (F.col("x.label") != F.col("y.label")) & near("x", "y"))
                     .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
                     .select("a", "b", *[none.alias(c) for c in PAIR[2:]]))

    # which classes have a near sketch at all: only their texts are needed
    start = shared.withColumn("label", F.col("node"))
    joined, tried = rounds(start, lambda pairs: pairs)
    tried = reduce(DataFrame.unionByName, tried).unionByName(across(joined))
    wanted = staged(tried.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    texts = staged(rows.select("rid", "_text").join(nodes.select("rid", "node").join(wanted, "node", "left_semi"), "rid")
                   .select("node", "_text"), "texts", "zstd")

    def verified(pairs: DataFrame) -> DataFrame:
        """Texts meet their pairs once; then the two texts of a pair meet."""
        sides = pairs.select(*PAIR, F.explode(F.array("a", "b")).alias("node")).join(texts, "node")
        met = sides.groupBy(*PAIR).agg(F.max(F.when(F.col("node") == F.col("a"), F.col("_text"))).alias("a_text"),
                                       F.max(F.when(F.col("node") == F.col("b"), F.col("_text"))).alias("b_text"))
        return staged(met.mapInArrow(tidied(_verify), _PAIR), "links")

    member, links = rounds(staged(start.join(wanted, "node", "left_semi"), "member"), verified)
    links = reduce(DataFrame.unionByName, links).unionByName(verified(across(member)))
    joined = staged(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")

    doc = about.select("doc_id", "rid", "n_shingles", "node").join(joined, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    heads = staged(doc.where("n_shingles > 0").groupBy("label").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("head"))
        .select("label", "component_id", F.col("head.rid").alias("head")), "heads")
    empty = F.col("n_shingles") == 0
    return doc.join(heads, "label", "left").select(
        "doc_id", "rid", "n_shingles", "node",
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(empty, F.lit(True)).otherwise(F.col("rid") == F.col("head")).alias("kept"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of every component; columns unchanged."""
    rid = fresh(docs, "_row")
    gone = join_similar(docs, id_col, text_col).where("NOT kept").select(F.col("rid").alias(rid))
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(gone, rid, "left_anti").select(*docs.columns)
