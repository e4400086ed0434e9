"""Cross-tokenizer alignment: where two tokenizers' tokens end together, and which tokens overlap.

A text is encoded by a byte-level BPE (A, with a space put before the text) and by a
piece model (B, which adds that space itself).  The cumulative byte ends of each
side's tokens go into a dictionary from end to index; the ends that both
dictionaries hold, in order, cut both id lists into groups; in a group every A token
is linked to every B token whose bytes it overlaps.  A link's count is how many links
of the whole corpus join the same two ids.

1. Align.  Neither tokenizer joins across a place where a space follows a character
   that is not white space (checked when the files are loaded; otherwise the whole text
   is one segment), so both have a token end there, and a text's groups are the groups of
   its segments, one after the other.  A worker keeps the groups of segments that it has
   seen lately, in two generations of bounded size.
2. Count.  Tasks add up their links by pair of ids, then the sums meet by key.
3. Score.  Tasks hold the counts of the most frequent pairs (``HELD_PAIRS`` at most) and
   the highest count of each B id (as many as B has ids).  Links of other pairs, rare ones, go
   to the table of counts by key, so the bound changes work, not results.

Defined cases: a text that is null, empty, or not given back byte for byte by the tokens of
either side has no tokens, zeros, and ``''`` as its groups; rows are independent, so null
ids, repeated rows and ties need no rule (repeated rows count each time); an empty table
gives an empty result; other columns are ignored; a text of any length is one row.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.byte_bpe import read_file
from strata.llm.common import byte_views, few_rows, staged, tidied, worker_tables

#: pairs of ids whose counts a task holds
HELD_PAIRS = 1 << 18
#: segments that a worker keeps in each of two generations, and the longest one kept
MAX_SEGMENTS, KEEP_CHARS = 240_000, 48
#: bytes of links that a task gathers before it hands rows on
OUT_BYTES = 8 << 20
#: links that a counting task gathers before it hands on their sums
HELD_LINKS = 1 << 22

#: a space that follows what may be white space in some version of the standard; no segment ends there
_JOINED = re.compile("[\\s\u180e\u200b\ufeff] |^ ")
_CUT = re.compile("(?<![\\s\u180e\u200b\ufeff])(?= )")
#: segments whose pre-tokens need no character tables, and these pre-tokens
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ A-Za-zÀ-ÖØ-öø-ÿ0-9]+")


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it is printable, else the next above 255."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict(zip(own, map(chr, own)))
    letters.update(zip((b for b in range(256) if b not in letters), map(chr, count(256))))
    return letters


def common_ends(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Byte ends that both sides have, in order, and the number of tokens up to each on either side."""
    a_at, b_at = dict(zip(a_ends, count(1))), dict(zip(b_ends, count(1)))
    both = sorted(a_at.keys() & b_at.keys())
    return both, [a_at[e] for e in both], [b_at[e] for e in both]


def links_of(a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed pairs of tokens that overlap, with the byte at which each pair's overlap starts.

    Both sides cover the same bytes, so an overlap starts just where a token of either side does.
    """
    a_starts, b_starts = a_ends - sizes(a_ends), b_ends - sizes(b_ends)
    start = np.union1d(a_starts, b_starts)
    a = np.searchsorted(a_starts, start, side="right") - 1
    b = np.searchsorted(b_starts, start, side="right") - 1
    return a_ids[a] << shift | b_ids[b], start


def sizes(ends: np.ndarray) -> np.ndarray:
    """Token sizes from cumulative ends."""
    return np.diff(ends, prepend=0)


class Aligner:
    """Both tokenizers, their tokens' bytes, and what is known of segments seen lately."""

    def __init__(self, a_json: bytes, b_model: bytes, max_segments: int = MAX_SEGMENTS):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.letters = byte_letters()
        code = {c: b for b, c in self.letters.items()}
        words = (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))
        self.a_bytes = [bytes(code[c] for c in w) if all(c in code for c in w) else w.encode() for w in words]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_said, self.b_said = [list(map(str, range(len(x)))) for x in (self.a_bytes, self.b_bytes)]
        self.shift, self.kind = layout(len(self.a_bytes), len(self.b_bytes))
        about = json.loads(a_json)
        before = about.get("pre_tokenizer") or {}
        self.byte_level = before.get("type") == "ByteLevel" and before.get("use_regex", True) \
            and not before.get("add_prefix_space", True) and about.get("normalizer") is None \
            and about["model"]["type"] == "BPE" and not about["model"].get("continuing_subword_prefix")
        self.model = self.a.model
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        keeps_white = "".join(self.b.encode(" a  b\n c ", out_type=str)).startswith("▁▁a▁▁b")
        self.cuts = self.byte_level and keeps_white and not any(re.search("[^▁]▁", p) for p in pieces)
        self.max_segments = max_segments
        self.known: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}

    def segments(self, text: str) -> list[str]:
        """Pieces of space+text that both tokenizers encode alone, each without its first space."""
        if not self.cuts:
            return [text]
        if _JOINED.search(text):
            out = [s[1:] for s in _CUT.split(" " + text) if s]
        else:
            out = text.split(" ")
        if not out[-1] and len(out) > 1:  # a last space stays with the word before it
            out[-2:] = [out[-2] + " "]
        return out

    def a_ids(self, segment: str) -> list[int]:
        if self.byte_level and segment.isascii() and segment.isalpha():  # one pre-token
            return [t.id for t in self.model.tokenize("Ġ" + segment)]
        if self.byte_level and _PLAIN.fullmatch(segment):
            ids = []
            for piece in _PIECE.findall(" " + segment):
                word = piece.replace(" ", "Ġ") if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                ids += [t.id for t in self.model.tokenize(word)]
            return ids
        return self.a.encode(" " + segment, add_special_tokens=False).ids

    def _entries(self, segments: list[str]) -> list[tuple]:
        """For each segment: whether its bytes come back, numbers of A and B tokens and groups, links, groups as text."""
        a_of, b_of = list(map(self.a_ids, segments)), self.b.encode(segments, num_threads=1)
        a, b = list(chain.from_iterable(a_of)), list(chain.from_iterable(b_of))
        a_raw, b_raw = [self.a_bytes[x] for x in a], [self.b_bytes[y] for y in b]
        want = f" {' '.join(segments)}".encode()
        if b"".join(a_raw) != want or b"".join(b_raw) != want:
            if len(segments) == 1:
                return [(False, 0, 0, 0, b"", "")]
            return [e for s in segments for e in self._entries([s])]
        # the segments lie one after the other, so their ends grow on both sides alike
        a_ends, b_ends = list(accumulate(map(len, a_raw))), list(accumulate(map(len, b_raw)))
        ends, k, m = common_ends(a_ends, b_ends)
        a_said, b_said = [self.a_said[x] for x in a], [self.b_said[y] for y in b]
        groups, i, j = [], 0, 0
        for p, q in zip(k, m):
            if p - i == 1 == q - j:
                groups.append(a_said[i] + "|" + b_said[j])
            else:
                groups.append(",".join(a_said[i:p]) + "|" + ",".join(b_said[j:q]))
            i, j = p, q
        links, at = links_of(np.array(a), np.array(b), np.array(a_ends), np.array(b_ends), self.shift)
        packed, width = links.astype(self.kind).tobytes(), self.kind.itemsize
        last = np.cumsum([len(s.encode()) + 1 for s in segments]) if not want.isascii() else np.cumsum([len(s) + 1 for s in segments])
        group_to = np.searchsorted(ends, last, side="right").tolist()
        link_to = (np.searchsorted(at, last) * width).tolist()
        out, g, n = [], 0, 0
        for x, y, h, o in zip(a_of, b_of, group_to, link_to):
            out.append((True, len(x), len(y), h - g, packed[n:o], ";".join(groups[g:h])))
            g, n = h, o
        return out

    def align(self, text: str | None) -> tuple:
        """Numbers of A tokens, B tokens, groups and links, packed links, groups as text."""
        none = (0, 0, 0, 0, b"", "")
        if not text:
            return none
        segments = self.segments(text)
        got = list(map(self.known.get, segments))
        if None in got:
            new = {s: self.older.get(s) for s, e in zip(segments, got) if e is None}
            missing = [s for s, e in new.items() if e is None]
            new.update(zip(missing, self._entries(missing)))
            got = [new[s] if e is None else e for s, e in zip(segments, got)]
            for s, e in new.items():
                if len(s) <= KEEP_CHARS:
                    if len(self.known) >= self.max_segments:
                        self.known, self.older = {}, self.known
                    self.known[s] = e
        ok, a, b, groups, links, said = zip(*got)
        if not all(ok):
            return none
        packed = b"".join(links)
        return sum(a), sum(b), sum(groups), len(packed) // self.kind.itemsize, packed, ";".join(said)


def layout(a_ids: int, b_ids: int) -> tuple[int, np.dtype]:
    """How many bits a pair's A id is shifted by, and the type of a packed pair."""
    shift = max(1, (b_ids - 1).bit_length())
    return shift, np.dtype("<i4" if shift + max(1, (a_ids - 1).bit_length()) <= 31 else "<i8")


_LONGS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(files, with_groups: bool, max_segments: int):
    def run(batches):
        kept = worker_tables("alignment")
        key = (files.value, max_segments)
        if kept.get("key") != key:
            kept.update(key=key, aligner=Aligner(*files.value, max_segments))
        one = kept["aligner"].align

        def batch(b, lo, rows):
            n = list(zip(*rows))
            out = [b.column(c).slice(lo, len(rows)) for c in ("doc_id", "rid")]
            out += [pa.array(n[i], pa.int64()) for i in range(4)]
            out += [pa.array(n[6], pa.string()), pa.array(n[4], pa.binary())]
            names = ["doc_id", "rid", *_LONGS, "groups_sha256", "links"]
            return pa.record_batch(out + [pa.array(n[5], pa.string())] * with_groups, names=names + ["groups"] * with_groups)

        for b in batches:
            lo, size, rows = 0, 0, []
            for text in b.column("_text"):
                got = one(text.as_py())
                digest = hashlib.sha256(got[5].encode()).hexdigest() if got[0] else ""
                rows.append((*got[:5], got[5] if with_groups else None, digest))
                size += len(got[4]) + (len(got[5]) if with_groups else 0)
                if size > OUT_BYTES or len(rows) == 5000:
                    yield batch(b, lo, rows)
                    lo, size, rows = lo + len(rows), 0, []
            if rows:
                yield batch(b, lo, rows)
    return run


def _tally(kind: np.dtype):
    """Links of a task by pair: ``code, n``."""
    def sums(held):
        code, n = np.unique(np.concatenate(held), return_counts=True)
        for k in range(0, len(code), 50_000):
            yield pa.record_batch([pa.array(code[k:k + 50_000].astype(np.int64)), pa.array(n[k:k + 50_000])], names=["code", "n"])

    def run(batches):
        worker_tables("alignment")
        held, size = [], 0
        for b in few_rows(batches):
            links = np.frombuffer(byte_views(b.column("links"))[0].tobytes(), dtype=kind)
            held.append(links)
            size += len(links)
            if size >= HELD_LINKS:
                yield from sums(held)
                held, size = [], 0
        if size:
            yield from sums(held)
    return run


def _scored(table, shift: int, kind: np.dtype, names: list[str]):
    """``n_best`` and ``count_sum`` over the links whose pairs are held; the others as ``rest``."""
    def run(batches):
        worker_tables("alignment")
        known, times, top = table.value
        for b in few_rows(batches, 500):
            raw, off = byte_views(b.column("links"))
            links = np.frombuffer(raw.tobytes(), dtype=kind).astype(np.int64)
            off = off // kind.itemsize
            place = np.searchsorted(known, links)
            mine = known[place] == links
            n = np.where(mine, times[place], 0)
            best = mine & (n == top[links & ((1 << shift) - 1)])
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (best.astype(np.int64), n, (~mine).astype(np.int64))]
            rest = pa.ListArray.from_arrays(pa.array(sums[2][off], pa.int32()), pa.array(links[~mine]))
            yield pa.record_batch([b.column(c) for c in names] + [pa.array(s[off[1:]] - s[off[:-1]]) for s in sums[:2]] + [rest],
                                  names=[*names, "best", "total", "rest"])
    return run


class Alignment:
    """Both steps that the corpus shares: aligned documents and the counts of pairs, written once."""

    def __init__(self, docs: DataFrame, a_json: str, b_model: str, id_col: str = "doc_id", text_col: str = "text",
                 with_groups: bool = False, max_segments: int = MAX_SEGMENTS):
        files = read_file(a_json), read_file(b_model)
        here = Aligner(*files)
        self.shift, self.kind = here.shift, here.kind
        sc = docs.sparkSession.sparkContext
        rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                           F.col(text_col).alias("_text"))
        schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, rid long, " + ", ".join(f"{c} long" for c in _LONGS) \
            + ", groups_sha256 string, links binary" + ", groups string" * with_groups
        self.rows = staged(rows.mapInArrow(tidied(_aligned(sc.broadcast(files), with_groups, max_segments)), schema), "aligned", "zstd")
        counts = self.rows.select("links").mapInArrow(tidied(_tally(self.kind)), "code long, n long") \
            .groupBy("code").agg(F.sum("n").alias("n"))
        self.counts = staged(counts.withColumn("level", F.floor(8 * F.log2("n")).cast("int")), "pairs")
        self.b_ids = len(here.b_bytes)

    def _b(self):
        return F.col("code").bitwiseAND((1 << self.shift) - 1)

    def _best(self) -> DataFrame:
        """The highest count of every B id: no more rows than B has ids."""
        return self.counts.groupBy(self._b().alias("b")).agg(F.max("n").alias("top"))

    def pairs(self) -> DataFrame:
        """``a, b, n, best``: every linked pair of ids, its count, and whether no other A id has more links with ``b``."""
        return self.counts.withColumn("b", self._b()).join(F.broadcast(self._best()), "b").select(
            F.shiftright("code", self.shift).alias("a"), "b", "n", (F.col("n") == F.col("top")).alias("best"))

    def documents(self, held: int = HELD_PAIRS) -> DataFrame:
        """``doc_id, rid``, numbers of tokens, groups and links, ``n_best``, ``count_sum``, ``groups_sha256`` (and ``groups``)."""
        levels = self.counts.groupBy("level").count().collect()  # at most eight for each doubling of the links
        level, sofar = 1 << 20, 0
        for at, n in sorted(((r["level"], r["count"]) for r in levels), reverse=True):
            sofar += n
            if sofar > held:
                break
            level = at
        got = self.counts.where(F.col("level") >= level).select("code", "n").toArrow()
        code, n = got.column("code").to_numpy(), got.column("n").to_numpy()
        order = np.argsort(code)
        most = self._best().toArrow()
        top = np.zeros(self.b_ids, dtype=np.int64)
        top[most.column("b").to_numpy()] = most.column("top").to_numpy()
        table = np.append(code[order], np.iinfo(np.int64).max), np.append(n[order], 0), top
        names = [c for c in self.rows.columns if c != "links"]
        kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.rows.schema if f.name != "links")
        scored = staged(self.rows.mapInArrow(tidied(_scored(self.rows.sparkSession.sparkContext.broadcast(table), self.shift, self.kind, names)),
                                             f"{kept}, best long, total long, rest array<long>"), "scored", "zstd")
        rare = self.counts.where(F.col("level") < level).withColumn("b", self._b()).join(F.broadcast(self._best()), "b")
        more = scored.select("rid", F.explode("rest").alias("code")).join(rare, "code").groupBy("rid").agg(
            F.sum("n").alias("more"), F.count_if(F.col("n") == F.col("top")).alias("more_best"))
        zero = F.lit(0).cast("long")
        return scored.join(more, "rid", "left").select(
            "doc_id", "rid", *_LONGS, (F.col("best") + F.coalesce("more_best", zero)).alias("n_best"),
            (F.col("total") + F.coalesce("more", zero)).alias("count_sum"), *names[6:])


def align(docs: DataFrame, a_json: str, b_model: str, **options) -> DataFrame:
    """One row per document (see ``Alignment.documents``)."""
    return Alignment(docs, a_json, b_model, **options).documents()
