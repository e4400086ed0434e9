"""Removal of long repeated byte strings, by run-length indexes over the repetitive part of a corpus.

Every byte goes that lies in a string of ``LENGTH`` bytes which also starts anywhere else,
in the same document or another.  Whether two windows of ``LENGTH`` bytes are equal can be
decided among windows with the same least ``GRAM``-byte hash, so:

1. A document is cut into runs of windows that share the place of their least hash.  The
   hash is the run's key.  Equal windows have equal keys.
2. Keys are dealt to groups by their leading bits, in packed blocks.  A run that occurs
   twice as a whole (key and content hash) is repeated from end to end.  A key with
   different runs is open: one run of each content is asked for.  Within a task, equal runs
   go on once, and a key with more than ``HOT`` different runs goes on as a mark.
3. The runs asked for are cut from their documents and meet by key.  Each group of them is
   repetitive by construction; a run-length index (run-compressed BWT with sampled run ends)
   marks all matches of ``LENGTH`` bytes or more (``RunIndex``).
   Runs of a marked key, or of one with more than ``MANY`` different runs, would make such a
   group too large: their windows meet by content hash instead, one entry a task for
   equal windows, which gives the same marks.
4. The marks of a document are joined and its bytes removed.

Texts move once, for documents with at least one run that is repeated or asked for.

Defined cases: a null text counts as empty; texts shorter than ``LENGTH`` bytes lose
nothing; repeated rows are repeated strings like any other, so all their long strings go;
a null id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import byte_views, few_rows, staged, tidied, worker_tables
from strata.llm.run_index import RunIndex
from strata.llm.textscan import mix, prefix_hash, span_hash

LENGTH, GRAM = 200, 40
SPAN = LENGTH - GRAM + 1
#: different runs of one key in a task, and in a group, from which on windows meet by hash
HOT, MANY = 64, 4096
PIECE = 1 << 20
GROUP_RUNS, GROUP_BYTES = 400_000, 1 << 19
WHOLE, INDEX, WINDOWS = 0, 1, 2
_PLACE = np.uint64((1 << 21) - 1)

ENTRY = np.dtype([("key", "<u8"), ("content", "<u8"), ("rid", "<i8"), ("at", "<i4"), ("n", "u1"), ("many", "u1")])
_BLOCK = "part int, entries binary, told binary"
_ITEM = "rid long, at int, n int, mode int, key long, single boolean"


def _pieces(column):
    """Rows of a binary column in pieces of about PIECE bytes: rows, offsets into documents, bytes, borders.

    A longer document is cut into pieces that overlap by a window less one byte.
    """
    raw, off = byte_views(column)
    n, at = len(off) - 1, 0
    while at < n:
        if off[at + 1] - off[at] > PIECE:
            for s in range(off[at], off[at + 1] - LENGTH + 1, PIECE - LENGTH + 1):
                e = min(s + PIECE, off[at + 1])
                yield np.array([at]), np.array([s - off[at]]), raw[s:e], np.array([0, e - s])
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(off, off[at] + PIECE, side="right")) - 1)
        yield np.arange(at, end), np.zeros(end - at, np.int64), raw[off[at]:off[end]], off[at:end + 1] - off[at]
        at = end


def _least_places(prefix: np.ndarray, border: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows within rows, and the place of each window's least hash (the leftmost)."""
    start = np.arange(n - GRAM + 1)
    h = span_hash(prefix, start, start + GRAM)
    packed = (h & ~_PLACE) | start.astype(np.uint64)
    pad = -len(packed) % SPAN
    rows = np.concatenate([packed, np.full(pad, ~np.uint64(0))]).reshape(-1, SPAN)
    onward = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    window = np.arange(n - LENGTH + 1)
    least = np.minimum(back[window], onward[window + SPAN - 1]) & _PLACE
    row_end = border[np.searchsorted(border, window, side="right")]
    inside = window + LENGTH <= row_end
    return window[inside], least[inside].astype(np.int64)


def runs(column):
    """Runs of windows: row, start in the document, windows, key, content hash, piece bytes, start in the piece."""
    for rows, shift, raw, border in _pieces(column):
        if len(raw) < LENGTH:
            continue
        prefix = prefix_hash(raw)
        window, least = _least_places(prefix, border, len(raw))
        if not len(window):
            continue
        first = np.flatnonzero(np.concatenate([[True], (window[1:] != window[:-1] + 1) | (least[1:] != least[:-1])]))
        count = np.diff(np.append(first, len(window)))
        start, place = window[first], least[first]
        row = np.searchsorted(border, start, side="right") - 1
        # a least hash is a small number; mixed, keys spread over the groups
        yield (rows[row], start - border[row] + shift[row], count, mix(span_hash(prefix, place, place + GRAM)),
               span_hash(prefix, start, start + count + LENGTH - 1), raw, prefix, start)


def _entries(column, rid: np.ndarray) -> np.ndarray:
    out = []
    for row, at, count, key, content, *_ in runs(column):
        e = np.zeros(len(row), dtype=ENTRY)
        e["key"], e["content"], e["rid"], e["at"], e["n"] = key, content, rid[row], at, count
        out.append(e)
    return np.concatenate(out) if out else np.zeros(0, dtype=ENTRY)


def _grouped(e: np.ndarray):
    """Entries in order of key and content; first of each content, first of each key, and which content and key each is of."""
    e = e[np.lexsort((e["content"], e["key"]))]
    new_key = np.ones(len(e), dtype=bool)
    new_key[1:] = e["key"][1:] != e["key"][:-1]
    new = new_key.copy()
    new[1:] |= e["content"][1:] != e["content"][:-1]
    return e, np.flatnonzero(new), np.cumsum(new) - 1, np.flatnonzero(new_key), np.cumsum(new_key) - 1


def _forward(e: np.ndarray, groups: int, most: int = HOT) -> pa.RecordBatch | None:
    """One task's entries, combined: what goes on to the groups, and what can be told at once.

    ``many`` of an entry that goes on: 1 if its content occurs more than once here, 2 if it
    marks a key with too many contents. Told entries have in ``many`` their mode.
    """
    if not len(e):
        return None
    e, first, which, key_first, key_which = _grouped(e)
    times = np.bincount(which)
    contents = np.bincount(key_which[first])
    hot = (contents > most)[key_which]
    whole = e[times[which] > 1].copy()
    whole["many"] = WHOLE
    windows = e[first][hot[first]].copy()
    windows["many"] = WINDOWS
    on = e[first][~hot[first]].copy()
    on["many"] = (times > 1)[~hot[first]]
    mark = e[key_first][hot[key_first]].copy()
    mark["many"] = 2
    on = np.concatenate([on, mark])
    told = np.concatenate([whole, windows])
    shift = np.uint64(64 - (groups.bit_length() - 1))
    part = (on["key"] >> shift).astype(np.int64)
    tpart = (mix(told["rid"]) >> shift).astype(np.int64)
    o, t = np.argsort(part, kind="stable"), np.argsort(tpart, kind="stable")
    on, part, told, tpart = on[o], part[o], told[t], tpart[t]
    used = np.union1d(part, tpart)
    a, z = np.searchsorted(part, used), np.searchsorted(part, used, side="right")
    c, d = np.searchsorted(tpart, used), np.searchsorted(tpart, used, side="right")
    return pa.record_batch([pa.array(used, pa.int32()), pa.array([on[i:j].tobytes() for i, j in zip(a, z)], pa.binary()),
                            pa.array([told[i:j].tobytes() for i, j in zip(c, d)], pa.binary())],
                           names=["part", "entries", "told"])


def _deal(groups: int, most: int):
    def run(batches):
        worker_tables("suffix_dedup")
        for b in batches:
            block = _forward(_entries(b.column("_text"), b.column("rid").to_numpy()), groups, most)
            if block is not None:
                yield block
    return run


def _meet(table: pa.Table, most: int = MANY) -> pa.Table:
    """A group's answer: runs that are repeated as a whole, and runs that are asked for."""
    unpack = lambda c: np.frombuffer(byte_views(table.column(c))[0].tobytes(), dtype=ENTRY)
    told = unpack("told")
    parts = [(told, told["many"].astype(np.int32), np.zeros(len(told), dtype=bool))]
    e = unpack("entries")
    if len(e):
        e, first, which, key_first, key_which = _grouped(e)
        mark = e["many"] == 2
        times = np.bincount(which, weights=np.where(mark, 0, 1 + (e["many"] == 1))) > 1
        whole = times[which] & (e["many"] == 0)
        parts.append((e[whole], np.full(whole.sum(), WHOLE, np.int32), np.zeros(whole.sum(), dtype=bool)))
        contents = np.bincount(key_which[first])
        hot = (np.bincount(key_which, weights=mark) > 0) | (contents > most)
        real = first[~mark[first]] if not mark.any() else _first_real(which, mark)
        ask = real[(contents > 1)[key_which[real]] | hot[key_which[real]]]
        parts.append((e[ask], np.where(hot[key_which[ask]], WINDOWS, INDEX).astype(np.int32), ~times[which[ask]]))
    rows = np.concatenate([p[0] for p in parts])
    return pa.table({"rid": rows["rid"].astype(np.int64), "at": rows["at"].astype(np.int32), "n": rows["n"].astype(np.int32),
                     "mode": np.concatenate([p[1] for p in parts]), "key": rows["key"].astype(np.uint64).view(np.int64),
                     "single": np.concatenate([p[2] for p in parts])})


def _first_real(which: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """The first entry of every content that is not a mark."""
    real = np.flatnonzero(~mark)
    return real[np.unique(which[real], return_index=True)[1]]


_STRINGS = "part int, strings binary, about binary"
STRING = np.dtype([("rid", "<i8"), ("at", "<i4"), ("size", "<i4"), ("single", "u1")])


def _cut(groups: int):
    """The bytes of the runs asked for, packed by key."""
    shift = np.uint64(64 - (groups.bit_length() - 1))

    def run(batches):
        for b in few_rows(batches):
            by_part: dict[int, tuple[list[bytes], list[tuple]]] = {}
            for rid, text, items in zip(b.column("rid").to_pylist(), b.column("_text"), b.column("items").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                for i in items:
                    if i["mode"] == INDEX:
                        size = i["n"] + LENGTH - 1
                        got = by_part.setdefault(int(np.uint64(i["key"] & (1 << 64) - 1) >> shift), ([], []))
                        got[0].append(raw[i["at"]:i["at"] + size])
                        got[1].append((rid, i["at"], size, i["single"]))
            if by_part:
                yield pa.record_batch([
                    pa.array(list(by_part), pa.int32()), pa.array([b"".join(s) for s, _ in by_part.values()], pa.binary()),
                    pa.array([np.array(a, dtype=STRING).tobytes() for _, a in by_part.values()], pa.binary())],
                    names=["part", "strings", "about"])
    return run


def _match(table: pa.Table) -> pa.Table:
    """Marks from a group's run-length index, for the runs that occur once as a whole."""
    about = np.frombuffer(byte_views(table.column("about"))[0].tobytes(), dtype=STRING)
    raw = byte_views(table.column("strings"))[0].tobytes()
    end = np.cumsum(about["size"].astype(np.int64))
    index = RunIndex([raw[e - s:e] for e, s in zip(end, about["size"])])
    covered = index.long_matches(LENGTH)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    lo, hi = edge[::2], edge[1::2]
    who = np.searchsorted(index.starts, lo, side="right") - 1
    use = about["single"][who] == 1
    lo, hi, who = lo[use], hi[use], who[use]
    base = about["at"][who] - index.starts[who]
    return pa.table({"rid": about["rid"][who].astype(np.int64), "lo": lo + base, "hi": hi + base})


def _windows(groups: int):
    """Every window of the runs asked for, by content hash, combined as runs are."""
    def run(batches):
        for b in batches:
            out = []
            rids = b.column("rid").to_numpy()
            for row, (text, items) in enumerate(zip(b.column("_text"), b.column("items").to_pylist())):
                raw = np.frombuffer(text.as_buffer(), np.uint8)
                for i in items:
                    if i["mode"] == WINDOWS:
                        prefix = prefix_hash(raw[i["at"]:i["at"] + i["n"] + LENGTH - 1])
                        start = np.arange(i["n"])
                        e = np.zeros(i["n"], dtype=ENTRY)
                        e["key"], e["rid"], e["at"], e["n"] = span_hash(prefix, start, start + LENGTH), rids[row], i["at"] + start, 1
                        out.append(e)
            block = _forward(np.concatenate(out), groups) if out else None
            if block is not None:
                yield block
    return run


def _remove(batches):
    """What is left of each text: bytes, removed bytes, maximal removed runs, digest, and the text itself."""
    for b in few_rows(batches):
        size, removed, spans, digest, left = [], [], [], [], []
        for text, marks in zip(b.column("_text"), b.column("marks").to_pylist()):
            raw = text.as_buffer().to_pybytes()
            out, at, gone, n = [], 0, 0, 0
            for m in sorted((m["lo"], m["hi"]) for m in marks or ()):
                if m[0] > at or n == 0:
                    out.append(raw[at:m[0]])
                    n += 1
                    gone += m[1] - m[0]
                    at = m[1]
                elif m[1] > at:
                    gone += m[1] - at
                    at = m[1]
            kept = b"".join(out) + raw[at:]
            size.append(len(raw)), removed.append(gone), spans.append(n), left.append(kept)
            digest.append(hashlib.sha256(kept).hexdigest())
        keep = [c for c in b.schema.names if c not in ("_text", "marks")]
        yield pa.record_batch([b.column(c) for c in keep] + [pa.array(x, pa.int64()) for x in (size, removed, spans)]
                              + [pa.array(digest, pa.string()), pa.array(left, pa.binary())],
                              names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
                   hot: int = HOT, many: int = MANY) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept`` (bytes).

    ``hot`` and ``many`` say from which numbers of different runs on a key's windows meet by
    hash; they change the work, not the result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0

    def parts(n: float) -> int:
        return 1 << max(6, int(n)).bit_length()

    blocks = rows.select("rid", "_text").mapInArrow(tidied(_deal(parts(size / (SPAN / 2) / GROUP_RUNS), hot)), _BLOCK)
    items = staged(blocks.groupBy("part").applyInArrow(lambda t: _meet(t, many), _ITEM), "runs")
    asked = items.groupBy("rid").agg(F.collect_list(F.struct("at", "n", "mode", "key", "single")).alias("items"))
    texts = staged(rows.join(asked, "rid"), "texts")
    mode = {r["mode"]: r["n"] for r in items.groupBy("mode").agg(F.sum(F.col("n") + LENGTH - 1).alias("n")).collect()}
    marks = items.where(F.col("mode") == WHOLE).select("rid", F.col("at").cast("long").alias("lo"),
                                                       (F.col("at") + F.col("n") + (LENGTH - 1)).cast("long").alias("hi"))
    if mode.get(INDEX):
        strings = texts.where(F.exists("items", lambda i: i["mode"] == INDEX)).select("rid", "_text", "items") \
            .mapInArrow(tidied(_cut(parts(mode[INDEX] / GROUP_BYTES))), _STRINGS)
        marks = marks.unionByName(strings.groupBy("part").applyInArrow(_match, "rid long, lo long, hi long"))
    if mode.get(WINDOWS):
        windows = texts.where(F.exists("items", lambda i: i["mode"] == WINDOWS)).select("rid", "_text", "items") \
            .mapInArrow(tidied(_windows(parts(mode[WINDOWS] / 3 / GROUP_RUNS))), _BLOCK)
        marks = marks.unionByName(windows.groupBy("part").applyInArrow(lambda t: _meet(t), _ITEM).where(F.col("mode") == WHOLE).select(
            "rid", F.col("at").cast("long").alias("lo"), (F.col("at") + LENGTH).cast("long").alias("hi")))
    marks = staged(marks.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("marks")), "marks")
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    cut = texts.select("doc_id", "rid", "_text").join(marks, "rid").drop("rid").mapInArrow(
        tidied(_remove), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary").select(*columns)
    whole = rows.join(marks.select("rid"), "rid", "left_anti") if with_text else \
        rows.withColumns({"n_bytes": F.octet_length("_text").cast("long"), "kept_sha256": F.sha2("_text", 256)}) \
        .drop("_text").join(marks.select("rid"), "rid", "left_anti")
    if with_text:
        whole = whole.withColumns({"n_bytes": F.octet_length("_text").cast("long"), "kept_sha256": F.sha2("_text", 256),
                                   "kept": F.col("_text")})
    return cut.unionByName(whole.withColumns({"n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long")}).select(*columns))
