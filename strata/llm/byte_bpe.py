"""Byte-level BPE as a lazily determinised finite-state transducer.

Merges are compiled into two tables: the trie of all tokens, and for every token the
two tokens that its last merge joins.  From these, ``Merges.adjacent`` says whether two
tokens may stand side by side in an encoding.  That relation fixes an encoding: a
sequence of tokens is the encoding of its bytes exactly if all its neighbours may stand
side by side, and every prefix of a piece has one encoding.

The transducer that follows from this is not deterministic: after some bytes it may be
at a token's end or inside one of several longer tokens.  ``Transducer`` makes it
deterministic while it runs.  A state is the set of live readings, each with the tokens
it has not emitted yet; a step reads one byte, drops dead readings, and emits the tokens
that all readings agree on, so tokens come out after bounded lookahead.  Steps are
made when first needed and kept; when a bound on their number is reached, the table is
dropped and made anew, which changes no result.  Whole pre-tokens already seen are kept
the same way.

Decoding joins the tokens' bytes; ``Utf8Stream`` turns them into text piece by piece and
holds back an unfinished character.

Defined cases: a null text counts as empty and has no tokens; rows are independent, so
null ids, repeated rows and ties need no rule; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import few_rows, give_back, tidied, worker_tables

MAX_STEPS = 700_000
MAX_PIECES = 250_000
#: rows encoded at a time
ROWS = 256
#: closes a reading in a state
END = -2
#: longer pre-tokens are not kept whole
KEEP_BYTES = 64


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the text of a rank file."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}


class Merges:
    """The rank table, each token's last merge, and which tokens may be neighbours."""

    def __init__(self, ranks: dict[bytes, int], max_pairs: int = MAX_STEPS):
        self.rank, self.max_pairs = ranks, max_pairs
        self.bytes = {r: t for t, r in ranks.items()}
        self._halves: dict[int, tuple[int, int]] = {}
        self._adjacent: dict[tuple[int, int], bool] = {}

    def merged(self, piece: bytes, below: int | None = None) -> list[bytes]:
        """Plain merging, lowest rank first, of ranks less than ``below``."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r is not None and (below is None or r < below) and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens joined last in ``token``; None for a single byte or one that merging never makes."""
        got = self._halves.get(token, ())
        if got == ():
            parts = self.merged(self.bytes[token], token)
            got = (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else None
            self._halves[token] = got
        return got

    def adjacent(self, left: int, right: int) -> bool:
        """Whether ``left, right`` is the encoding of their bytes.

        Undo merges on both sides of the border, the higher rank first: if at some
        point the tokens at the border could join at a lower rank than the merges that
        are still to come, merging would have joined them across the border.
        """
        key = (left, right)
        got = self._adjacent.get(key)
        if got is None:
            got = self._adjacent[key] = self._check(left, right)
            if len(self._adjacent) > self.max_pairs:
                self._adjacent.clear()
        return got

    def _check(self, left: int, right: int) -> bool:
        text, rank = self.bytes, self.rank
        a, b = left, right  # the tokens that touch the border
        bound = None  # rank of the merge undone last; on a tie the left one comes first
        while True:
            joined = rank.get(text[a] + text[b])
            if joined is not None and (bound is None or joined < bound):
                return False
            ha, hb = self.halves(a), self.halves(b)
            if ha is None and hb is None:
                return True
            if hb is None or ha is not None and a > b:
                bound = a          # a merge at the border with the same rank lies further right, so it comes later
                a = ha[1]
            else:
                bound = b + 1      # a merge at the border with the same rank lies further left, so it comes first
                b = hb[0]


class Transducer:
    """Deterministic steps over bytes, made on demand. ``encode`` gives the tokens of one piece."""

    def __init__(self, merges: Merges, max_steps: int = MAX_STEPS):
        self.m, self.max_steps = merges, max_steps
        self.child: list[dict[int, int]] = [{}]
        self.token: list[int | None] = [None]
        for t, r in merges.rank.items():
            node = 0
            for byte in t:
                nxt = self.child[node].get(byte)
                if nxt is None:
                    nxt = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = r
        self._reset()

    def _reset(self) -> None:
        # a state is one flat tuple: for each reading its place in the trie, the token before it, the tokens
        # not emitted yet, and END; the reading at a token's end (place 0) comes first
        start = (0, -1, END)
        self.number = {start: 0}
        self.readings = [start]
        self.steps: dict[int, int] = {}  # state and byte -> next state and which output
        self.emitted: dict[tuple[int, ...], int] = {(): 0}
        self.outputs: list[tuple[int, ...]] = [()]

    def _step(self, state: int, byte: int) -> int:
        """Move every reading on by a byte; returns the packed step."""
        child, token, adjacent = self.child, self.token, self.m.adjacent
        live, end, key, i = [], None, self.readings[state], 0
        while i < len(key):
            stop = key.index(END, i + 2)
            nxt = child[key[i]].get(byte)
            if nxt is not None:
                before, held = key[i + 1], key[i + 2:stop]
                if child[nxt]:
                    live.append((nxt, before, held))
                t = token[nxt]
                if end is None and t is not None and (before < 0 or adjacent(before, t)):
                    end = (0, t, held + (t,))  # exactly one reading is at a token's end
            i = stop + 1
        live.sort()
        live.insert(0, end)
        first = last = end[2]
        for _, _, held in live:
            if held < first:
                first = held
            elif held > last:
                last = held
        k, most = 0, min(len(first), len(last))
        while k < most and first[k] == last[k]:
            k += 1
        flat: list[int] = []
        for node, before, held in live:
            flat += (node, before, *held[k:], END)
        key = tuple(flat)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.readings)
            self.readings.append(key)
        out = end[2][:k]
        which = self.emitted.get(out)
        if which is None:
            which = self.emitted[out] = len(self.outputs)
            self.outputs.append(out)
        got = self.steps[state << 8 | byte] = to << 32 | which
        return got

    def encode(self, piece: bytes) -> list[int]:
        whole = self.m.rank.get(piece)
        if whole is not None:
            return [whole]
        if len(self.steps) > self.max_steps:
            self._reset()
        out: list[int] = []
        state, steps, outputs = 0, self.steps, self.outputs
        for byte in piece:
            got = steps.get(state << 8 | byte)
            if got is None:
                got = self._step(state, byte)
            state = got >> 32
            if got & 0xFFFFFFFF:
                out += outputs[got & 0xFFFFFFFF]
        key = self.readings[state]
        return out + list(key[2:key.index(END, 2)])


class ManyPieces:
    """Numbers of tokens of many short pieces at once, for pieces that are seldom seen twice.

    Plain merging, lowest rank first and leftmost of equals, one merge in every piece at a time; the pieces lie
    in the rows of an array that loses a column with each merge, and a piece leaves it when nothing joins any more.
    """

    NONE = np.iinfo(np.int32).max
    ROWS = 4096

    def __init__(self, merges: Merges):
        self.rank = rank = merges.rank
        self.byte = np.array([rank.get(bytes([i]), -1) for i in range(256)], np.int32)
        found = [(rank[t[:k]] << 32 | rank[t[k:]], r) for t, r in rank.items() for k in range(1, len(t))
                 if t[:k] in rank and t[k:] in rank]
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        self.pair, self.joined = np.append(pairs[:, 0], np.iinfo(np.int64).max), np.append(pairs[:, 1], 0).astype(np.int32)
        self.first = np.array([rank.get(bytes([i >> 8, i & 255]), self.NONE) for i in range(1 << 16)], np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What two tokens each join to; ``NONE`` where they do not, as with the -1 past a piece's end."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.joined[at], self.NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out, order = size.copy(), np.argsort(size, kind="stable")
        for k in range(0, len(pieces), self.ROWS):
            rows = order[k:k + self.ROWS]
            out[rows] -= self._merges([pieces[i] for i in rows.tolist()], size[rows])
        out[np.fromiter(map(self.rank.__contains__, pieces), bool, len(pieces))] = 1
        return out

    def _merges(self, pieces: list[bytes], size: np.ndarray) -> np.ndarray:
        """How many merges each piece takes."""
        done, live, width = np.zeros(len(pieces), np.int64), np.arange(len(pieces)), int(size.max(initial=0))
        inside = np.arange(width) < size[:, None]
        raw = np.zeros(inside.shape, np.int32)
        raw[inside] = np.frombuffer(b"".join(pieces), np.uint8)
        tokens = np.where(inside, self.byte[raw], np.int32(-1))
        ranks = np.where(inside[:, 1:], self.first[raw[:, :-1] << 8 | raw[:, 1:]], self.NONE)
        while ranks.shape[1] and len(live):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(live)), at]
            go = best < self.NONE
            if not go.all():
                live, tokens, ranks, at, best = live[go], tokens[go], ranks[go], at[go], best[go]
            done[live] += 1
            stay = np.arange(ranks.shape[1]) <= at[:, None]
            tokens = np.where(stay, tokens[:, :-1], tokens[:, 1:])
            ranks = np.where(stay[:, :-1], ranks[:, :-1], ranks[:, 1:])
            row = np.arange(len(live))
            tokens[row, at] = best
            for r, a in ((row[at > 0], at[at > 0] - 1), (row[at < ranks.shape[1]], at[at < ranks.shape[1]])):
                ranks[r, a] = self._rank(tokens[r, a], tokens[r, a + 1])
        return done


class Utf8Stream:
    """Incremental UTF-8: bytes in, text out as soon as its characters are complete.

    The state is the unfinished character's bytes (at most three). Malformed bytes
    become U+FFFD, as in one call of ``bytes.decode("utf-8", "replace")``.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80:
                return 0
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4 if lead < 0xF5 else 1
                if need <= back or lead < 0xC2:
                    return 0
                if back >= 2:  # the second byte of some characters has a narrower range
                    low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
                    high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
                    if not low <= data[1 - back] <= high:
                        return 0
                return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """Text to ids and back, with what one worker has learnt about the vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_steps: int = MAX_STEPS, max_pieces: int = MAX_PIECES):
        self.merges = Merges(ranks, max_steps)
        self.machine = Transducer(self.merges, max_steps)
        self.max_pieces = max_pieces
        self.split = regex.compile(pattern).findall
        #: pre-tokens seen lately, and those seen before the last change of generations
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        known, out = self.pieces, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    ids = tuple(self.machine.encode(piece.encode("utf-8")))
                if len(piece) <= KEEP_BYTES:
                    if len(known) >= self.max_pieces:
                        self.older, known = known, {}
                        self.pieces = known
                    known[piece] = ids
            out += ids
        return out

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.merges.bytes.__getitem__, ids))

    def decode(self, ids: list[int], step: int = 4096) -> str:
        """Text by the incremental machine, ``step`` ids at a time."""
        stream = Utf8Stream()
        out = [stream.feed(self.decode_bytes(ids[i:i + step])) for i in range(0, len(ids), step)]
        return "".join(out) + stream.close()


def codec(raw: bytes, pattern: str, max_steps: int = MAX_STEPS, max_pieces: int = MAX_PIECES) -> Codec:
    """The worker's codec for a rank file's content and a pattern; kept between tasks."""
    kept, key = worker_tables("byte_bpe"), (hashlib.sha256(raw).hexdigest(), pattern, max_steps, max_pieces)
    if key not in kept:
        # the tables below are many small objects without cycles: look for cycles seldom
        gc.set_threshold(200_000, 50, 1000)
        kept.clear()
        kept[key] = Codec(load_ranks(raw), pattern, max_steps, max_pieces)
    return kept[key]


def read_file(path: str) -> bytes:
    """A vocabulary file, read on the driver; workers get its bytes (under 1 MB for 50k tokens) by broadcast."""
    with open(path, "rb") as f:
        return f.read()


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.array(ids, dtype="<u4").tobytes()


def _encode(raw, pattern, columns: tuple[str, ...], max_steps: int, max_pieces: int):
    make = {
        "ids": (pa.list_(pa.int32()), lambda c, ids: np.array(ids, dtype=np.int32)),
        "n_tokens": (pa.int64(), lambda c, ids: len(ids)),
        "ids_sha256": (pa.string(), lambda c, ids: hashlib.sha256(_packed(ids)).hexdigest()),
        "decoded_sha256": (pa.string(), lambda c, ids: hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()),
    }

    def run(batches):
        c = codec(raw.value, pattern, max_steps, max_pieces)
        for turn, b in enumerate(few_rows(batches, ROWS), 1):  # ids take more room than texts
            if turn % 16 == 0:
                give_back()
            out: dict[str, list] = {n: [] for n in columns}
            for x in b.column("_text"):
                ids = c.encode(x.as_py())
                for n in columns:
                    out[n].append(make[n][1](c, ids))
            yield pa.record_batch([b.column("doc_id")] + [pa.array(out[n], make[n][0]) for n in columns],
                                  names=["doc_id", *columns])
    return run


def _rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"


_TYPES = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def _encoded(docs: DataFrame, vocab: str, pattern: str, id_col: str, text_col: str, columns: tuple[str, ...],
             max_steps: int = MAX_STEPS, max_pieces: int = MAX_PIECES) -> DataFrame:
    rows, kind = _rows(docs, id_col, text_col)
    raw = docs.sparkSession.sparkContext.broadcast(read_file(vocab))
    return rows.mapInArrow(tidied(_encode(raw, pattern, columns, max_steps, max_pieces)), ", ".join([kind, *(f"{n} {_TYPES[n]}" for n in columns)]))


def encode(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids array<int>``."""
    return _encoded(docs, vocab, pattern, id_col, text_col, ("ids",))


def decode(tokens: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per list of ids: ``doc_id, text``. A null list gives an empty text."""
    rows = tokens.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("_ids"))
    raw = tokens.sparkSession.sparkContext.broadcast(read_file(vocab))

    def run(batches):
        c = codec(raw.value, pattern)
        for b in few_rows(batches, ROWS):
            yield pa.record_batch([b.column("doc_id"), pa.array([c.decode(x.as_py()) for x in b.column("_ids")], pa.string())],
                                  names=["doc_id", "text"])

    return rows.mapInArrow(tidied(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False, max_steps: int = MAX_STEPS, max_pieces: int = MAX_PIECES) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256`` (ids as little-endian 32-bit), ``decoded_sha256``; ``ids`` if asked for.

    ``max_steps`` and ``max_pieces`` bound what a worker keeps (about 400 MB as given); they change its speed only.
    """
    return _encoded(docs, vocab, pattern, id_col, text_col,
                    ("n_tokens", "ids_sha256", "decoded_sha256") + ("ids",) * with_ids, max_steps, max_pieces)
