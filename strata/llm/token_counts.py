"""Edit-aware token counts: a segment tree of pre-tokens per document.

A document's pre-tokens lie in the leaves of a tree, ``LEAF`` to a leaf at first; every
node holds the characters and tokens below it.  An edit (start, end, replacement, in code
points of the text as it is then) goes down the tree to the pre-tokens it touches, and
splits and encodes again from the first pre-token whose match could see the edit to
the first border that the old split also had.  From there on the old pre-tokens hold,
because the pattern reads forward only and looks at most ``AHEAD`` characters past a match.
The changed leaves' sums are then carried up.  Nothing else of the document is read.

Trees are kept as a table: ``load_trees`` makes one row per document with the text, the pre-tokens'
lengths (a byte each, see ``_lengths``) and the leaves' sums; ``edit_trees`` takes such a table and a list of edits for each row
and returns the table as it is afterwards.  A stored tree is not split or encoded again: only leaves that an edit
touches are read as pre-tokens, and rows without edits pass as they are.  ``stored`` writes the table below
``spark.checkpoint.dir``; ``count_edited`` does load and edits in one pass when no state is wanted.

Defined cases: null texts and null or empty edit lists count as empty; an edit's ends are
moved into the text and its start before its end; a null replacement is empty, a null edit none;
edits of a document apply in the order of the list; rows are independent, so
null ids, repeated rows and ties need no rule; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.byte_bpe import KEEP_BYTES, Codec, ManyPieces, codec, read_file
from strata.llm.common import few_rows, staged, tidied

LEAF = 32
AHEAD = 2
MAX_COUNTS = 400_000
#: trees in memory at a time
ROWS = 256
#: how trees are written: a higher level and larger pages than Spark's for texts and lengths
PACKED = {"parquet.compression.codec.zstd.level": "5", "parquet.page.size": str(8 << 20)}
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Pre-tokens and their numbers of tokens, with what one worker has counted before."""

    def __init__(self, c: Codec):
        self.split = c.split
        self._encode = c.machine.encode
        self._many = ManyPieces(c.merges)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = self.older.get(piece)
            if n is None:
                n = len(self._encode(piece.encode("utf-8")))
            if len(piece) <= KEEP_BYTES:
                if len(self.known) >= MAX_COUNTS:
                    self.older, self.known = self.known, {}
                self.known[piece] = n
        return n


    def learn(self, pieces: set[str]) -> None:
        """Count many new pieces at once; long ones wait for ``tokens``."""
        if len(self.known) >= MAX_COUNTS:
            self.older, self.known = self.known, {}
        older = self.older
        self.known.update([(p, older[p]) for p in pieces if p in older])
        short = {p: b for p in pieces if p not in older and len(b := p.encode("utf-8")) <= KEEP_BYTES}
        self.known.update(zip(short, self._many.counts(list(short.values())).tolist()))


def _sizes(pieces: list[str]) -> np.ndarray:
    return np.fromiter(map(len, pieces), np.int32, len(pieces))


class PretokenTree:
    """The tree over one text; ``total`` is its number of tokens."""

    def __init__(self, counter: Counter, text: str):
        self.counter = counter
        self.encoded = 0
        pieces = counter.split(text)
        self._build(text, _sizes(pieces), list(map(counter.tokens, pieces)))

    @classmethod
    def of_texts(cls, counter: Counter, texts: list[str]) -> list[PretokenTree]:
        """The trees over many texts, whose new pre-tokens are counted together."""
        known, rows, out = counter.known, [], []
        for text in texts:  # of the pre-tokens only new ones are held
            pieces = counter.split(text)
            counts = list(map(known.get, pieces))
            new = [(i, pieces[i]) for i, n in enumerate(counts) if n is None]
            rows.append((text, _sizes(pieces), counts, new))
        counter.learn({p for *_, new in rows for _, p in new})
        for text, sizes, counts, new in rows:
            for i, p in new:
                counts[i] = counter.tokens(p)
            tree = cls.__new__(cls)
            tree.counter, tree.encoded = counter, 0
            tree._build(text, sizes, counts)
            out.append(tree)
        return out

    @classmethod
    def restored(cls, counter: Counter, text: str, pieces: np.ndarray, leaf_pieces: np.ndarray,
                 leaf_tokens: np.ndarray) -> PretokenTree:
        """The tree that ``state`` gave; a leaf's pre-tokens are cut from the text when an edit comes to it."""
        tree = cls.__new__(cls)
        tree.counter, tree.encoded = counter, 0
        tree.leaves = [None] * len(leaf_pieces) or [[]]
        tree._place(text, pieces, np.concatenate([[0], np.cumsum(leaf_pieces)]), leaf_tokens.tolist())
        return tree

    def _build(self, text: str, sizes: np.ndarray, counts: list[int]) -> None:
        n = len(sizes)
        self.leaves = [None] * (-(-n // LEAF)) or [[]]
        self._place(text, sizes, np.minimum(np.arange(0, n + LEAF, LEAF), n), [sum(counts[i:i + LEAF]) for i in range(0, n, LEAF)])

    def _place(self, text: str, pieces: np.ndarray, first: np.ndarray, tokens: list[int]) -> None:
        """Where each leaf's pre-tokens lie, and the sums over the leaves; no leaf has changed yet."""
        if len(first) == 1:  # no pre-token: one leaf without any
            first, tokens = np.zeros(2, int), [0]
        self._text, self._pieces, self._first = text, pieces, first.tolist()
        ends = np.concatenate([[0], np.cumsum(pieces)])[first]
        self._at, self.changed = ends.tolist(), set()
        size = 1
        while size < len(self.leaves):
            size *= 2
        self.size = size
        self.chars = [0] * size + np.diff(ends).tolist()
        self.chars += [0] * (2 * size - len(self.chars))
        self.tokens = [0] * size + tokens + [0] * (size - len(tokens))
        for i in range(size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _leaf(self, i: int) -> list[str]:
        leaf = self.leaves[i]
        if leaf is None:
            ends = list(accumulate(self._pieces[self._first[i]:self._first[i + 1]].tolist(), initial=self._at[i]))
            leaf = self.leaves[i] = list(map(self._text.__getitem__, map(slice, ends, ends[1:])))
        return leaf

    def state(self) -> tuple[str, np.ndarray, list[int], list[int]]:
        """The text, the lengths of its pre-tokens, and for each leaf its pre-tokens and tokens."""
        text, pieces, counts, tokens, done = [], [], [], [], 0
        first, at = self._first, self._at
        for i in (*sorted(self.changed), len(self.leaves)):
            if first[i] > first[done]:  # leaves as they were
                text.append(self._text[at[done]:at[i]])
                pieces.append(self._pieces[first[done]:first[i]])
                counts += map(int.__sub__, first[done + 1:i + 1], first[done:i])
                tokens += self.tokens[self.size + done:self.size + i]
            done = i + 1
            if i in self.changed and self.leaves[i]:
                text += self.leaves[i]
                pieces.append(_sizes(self.leaves[i]))
                counts.append(len(self.leaves[i]))
                tokens.append(self.tokens[self.size + i])
        return "".join(text), np.concatenate(pieces) if pieces else np.zeros(0, np.int32), counts, tokens

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def length(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return self.state()[0]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character place (the last one for the end), and where the leaf starts."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node] and (self.chars[node + 1] or node + 1 - self.size < len(self.leaves)):
                start += self.chars[node]
                node += 1
        i = min(node - self.size, len(self.leaves) - 1)
        return i, start

    def _set(self, i: int, leaf: list[str], tokens: int) -> None:
        self.leaves[i] = leaf
        self.changed.add(i)
        node = self.size + i
        self.chars[node] = sum(map(len, leaf))
        self.tokens[node] = tokens
        node //= 2
        while node:
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            node //= 2

    def edit(self, start: int, end: int, text: str) -> None:
        start = min(max(start, 0), self.length)
        end = min(max(end, start), self.length)
        # back to the first pre-token that ends within AHEAD characters of the edit, or after it
        i, base = self._leaf_at(max(0, start - AHEAD))
        first, k, at = i, 0, base
        leaf = self._leaf(i)
        while k < len(leaf) and at + len(leaf[k]) <= start - AHEAD:
            at += len(leaf[k])
            k += 1
        head = leaf[:k]
        # old text from there on, leaf by leaf, and its borders after the edit
        old, borders, last, pos = [], set(), i, at
        fresh: list[str] = []

        def take(leaf: list[str], skip: int) -> None:
            nonlocal pos
            places = list(accumulate(map(len, leaf[skip:]), initial=pos))
            old.extend(leaf[skip:])
            pos = places.pop()
            if pos > end:
                borders.update(places[bisect_left(places, end):])

        take(leaf, k)
        while True:
            while pos < end and last + 1 < len(self.leaves):
                last += 1
                take(self._leaf(last), 0)
            whole = last + 1 >= len(self.leaves)
            buffer = "".join(old)
            new = buffer[:start - at] + text + buffer[end - at:]
            shift = len(text) - (end - start)
            fresh, place, met = [], at, None
            for p in self.counter.split(new):
                if place - shift in borders and place >= start + len(text):
                    met = place - shift
                    break
                if not whole and place + len(p) + AHEAD > at + len(new):
                    break  # this match may see past the buffer
                fresh.append(p)
                place += len(p)
            if met is not None or whole:
                break
            last += 1
            take(self._leaf(last), 0)
        gone = len(old)
        if met is not None:
            gone, p0 = 0, at
            while p0 < met:
                p0 += len(old[gone])
                gone += 1
        # what stays in these leaves keeps its count: only the pre-tokens that go and come are counted
        count = self.counter.tokens
        tokens = sum(self.tokens[self.size + first:self.size + last + 1]) - sum(map(count, old[:gone])) + sum(map(count, fresh))
        self.encoded += len(fresh)
        self._set(first, head + fresh + old[gone:], tokens)
        for j in range(first + 1, last + 1):
            self._set(j, [], 0)
        if len(self.leaves[first]) > 16 * LEAF:
            pieces = [p for j in range(len(self.leaves)) for p in self._leaf(j)]
            self._build("".join(pieces), _sizes(pieces), list(map(count, pieces)))


def _counter(raw: bytes, pattern: str) -> Counter:
    c = codec(raw, pattern)
    if not hasattr(c, "counter"):
        c.counter = Counter(c)
    return c.counter


def _edited(tree: PretokenTree, edits) -> int:
    """Apply a document's edits; their number."""
    edits = [e for e in edits or () if e is not None]
    for e in edits:
        tree.edit(e["start"] or 0, e["end"] or 0, e["text"] or "")
    return len(edits)


def _apply(raw, pattern: str):
    def run(batches):
        counter = _counter(raw.value, pattern)
        for b in few_rows(batches):
            out = [[], [], [], [], []]
            for text, edits in zip(b.column("_text").to_pylist(), b.column("edits").to_pylist()):
                tree = PretokenTree(counter, text)
                out[0].append(tree.total)
                out[2].append(_edited(tree, edits))
                out[1].append(tree.total)
                out[3].append(tree.encoded)
                out[4].append(tree.length)
            yield pa.record_batch([b.column("doc_id")] + [pa.array(x, pa.int64()) for x in out],
                                  names=["doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_reencoded", "n_chars"])
    return run


#: a stored tree's columns
STATE = {"text": "string", "pieces": "binary", "leaf_pieces": "array<int>", "leaf_tokens": "array<int>",
         "n_tokens": "long", "n_chars": "long", "n_edits": "long", "n_reencoded": "long"}


def _lists(parts: list) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in parts]) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _lengths(parts: list[np.ndarray]) -> pa.Array:
    """Lists of lengths as bytes: 255 is carried on by the next byte, so a row's bytes add up to its characters."""
    n = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)])
    if len(n) and n.max() >= 255:
        last = np.cumsum(n // 255 + 1)  # bytes up to each length's last
        flat = np.full(last[-1], 255, np.uint8)
        flat[last - 1] = n % 255
        ends = np.concatenate([[0], last])[ends]
    else:
        flat = n.astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])


def _from_lengths(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    if not (b == 255).any():
        return b.astype(np.int32)
    return np.diff(np.cumsum(b, dtype=np.int32)[b != 255], prepend=np.int32(0))


def _columns(trees: list[PretokenTree], n_edits: list[int], n_reencoded: list[int]) -> dict[str, pa.Array]:
    states = [t.state() for t in trees]
    counts = ([t.total for t in trees], [t.length for t in trees], n_edits, n_reencoded)
    return {"text": pa.array([x[0] for x in states], pa.string()), "pieces": _lengths([x[1] for x in states]),
            **{n: _lists([x[k] for x in states]) for k, n in enumerate(("leaf_pieces", "leaf_tokens"), 2)},
            **{n: pa.array(c, pa.int64()) for n, c in zip(("n_tokens", "n_chars", "n_edits", "n_reencoded"), counts)}}


def _load(raw, pattern: str):
    def run(batches):
        counter = _counter(raw.value, pattern)
        for b in few_rows(batches, ROWS):
            trees = PretokenTree.of_texts(counter, b.column("text").to_pylist())
            made = _columns(trees, [0] * len(trees), [0] * len(trees))
            yield pa.record_batch([made[n] if n in made else b.column(n) for n in (*b.schema.names, *list(STATE)[1:])],
                                  names=[*b.schema.names, *list(STATE)[1:]])
    return run


def _edit(raw, pattern: str, edits_col: str):
    def run(batches):
        counter = _counter(raw.value, pattern)
        for b in few_rows(batches, ROWS):
            col = {n: b.column(n) for n in b.schema.names}
            todo = [(i, e) for i, e in enumerate(col.pop(edits_col).to_pylist()) if e and any(x is not None for x in e)]
            if todo:
                trees, edits, redone = [], [], []
                for i, e in todo:
                    tree = PretokenTree.restored(counter, col["text"][i].as_py(), _from_lengths(col["pieces"][i].as_py()), *(
                        col[n][i].values.to_numpy(zero_copy_only=False) for n in ("leaf_pieces", "leaf_tokens")))
                    edits.append(col["n_edits"][i].as_py() + _edited(tree, e))
                    redone.append(col["n_reencoded"][i].as_py() + tree.encoded)
                    trees.append(tree)
                place = np.arange(b.num_rows)
                place[[i for i, _ in todo]] = b.num_rows + np.arange(len(todo))
                for n, new in _columns(trees, edits, redone).items():
                    col[n] = pa.concat_arrays([col[n], new.cast(col[n].type)]).take(pa.array(place))
            yield pa.record_batch(list(col.values()), names=list(col))
    return run


def load_trees(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               also: Sequence[str] = ()) -> DataFrame:
    """One row per document: ``doc_id``, the columns named in ``also`` (none named as those that follow), and ``STATE``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *also, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    raw = docs.sparkSession.sparkContext.broadcast(read_file(vocab))
    rest = T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in list(STATE.items())[1:]))
    return rows.mapInArrow(tidied(_load(raw, pattern)), T.StructType(rows.schema.fields + rest.fields))


def edit_trees(trees: DataFrame, vocab: str, pattern: str, edits_col: str = "edits") -> DataFrame:
    """The table of trees after each row's edits, a list of (start, end, text) that is dropped; other columns stay.

    ``n_edits`` and ``n_reencoded`` (pre-tokens) count on from what the table held.
    """
    rows = trees.withColumn(edits_col, F.col(edits_col).cast(EDITS))
    raw = trees.sparkSession.sparkContext.broadcast(read_file(vocab))
    return rows.mapInArrow(tidied(_edit(raw, pattern, edits_col)), trees.drop(edits_col).schema)


def stored(trees: DataFrame, name: str) -> DataFrame:
    """The table written below ``spark.checkpoint.dir`` and read again."""
    return staged(trees, name, "zstd", PACKED)


def count_edited(docs: DataFrame, vocab: str, pattern: str, edits_col: str = "edits", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens_before, n_tokens, n_edits, n_reencoded`` (pre-tokens), ``n_chars``.

    ``edits_col`` is a list of (start, end, text).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.col(edits_col).cast(EDITS).alias("edits"))
    raw = docs.sparkSession.sparkContext.broadcast(read_file(vocab))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tidied(_apply(raw, pattern)), f"doc_id {kind}, n_tokens_before long, n_tokens long, n_edits long, "
                                                 "n_reencoded long, n_chars long")


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", edits_col: str = "edits") -> DataFrame:
    """``docs`` with the list of each document's edits, from a table ``id, seq, start, end, text``, in order of ``seq``."""
    lists = edits.groupBy(F.col(id_col).alias("_edit_id")).agg(F.sort_array(F.collect_list(
        F.struct("seq", "start", "end", "text"))).alias(edits_col)) \
        .withColumn(edits_col, F.transform(edits_col, lambda e: F.struct(e["start"], e["end"], e["text"])))
    return docs.join(lists, docs[id_col] == lists["_edit_id"], "left").drop("_edit_id")
