"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

1. Every text is cut into chunks at places that its content alone defines: after a
   line break or a sentence end that follows one of a few letters, no sooner than
   ``MIN_CHARS`` and no later than ``MAX_CHARS`` after the last cut.
2. A chunk's identifier is its 64-bit hash.  The distinct (hash, chunk) pairs are
   gathered once, de-duplicated inside each task before the shuffle, and every hash
   that stands for more than one chunk is found.  A chunk with such a hash gets the
   rank of its text among them as a second part of its identifier, so equal
   identifiers always mean equal bytes.
3. A document's recipe is its ordered list of identifiers.  Documents with equal
   recipes are copies.  Only recipes move from here on, never texts.

Defined cases: a null text counts as empty, empty texts are copies of one another;
of equal texts the row with the largest id stays, a null id is smaller than any id;
of repeated rows with that id exactly one stays; an empty table gives an empty
result; other columns are ignored, whatever their names.  ``docs`` must give the same
rows in the same order when it is computed again (files do; else write it first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, staged

MIN_CHARS, MAX_CHARS = 256, 2048
#: ends a chunk: a line break, or a sentence end after one of these letters
CUT = r"\n|[adeinorst][.!?]\s"
CHUNK = rf"(?s).{{{MIN_CHARS},{MAX_CHARS}}}?(?:{CUT})|.{{1,{MAX_CHARS}}}"


def chunks(text):
    """The chunks of a text, in order; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def _key(chunk, key_bits: int):
    h = F.xxhash64(chunk)
    return h if key_bits >= 64 else F.pmod(h, F.lit(1 << key_bits))


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, rid, text_sha256, recipe`` (verified chunk identifiers).

    ``rid`` numbers the rows of ``docs``; ``key_bits`` below 64 makes hash collisions
    likely, for tests of their handling.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("rid"))
    hashed = staged(rows.select("doc_id", "rid", F.sha2("text", 256).alias("text_sha256"),
                                F.transform(chunks(F.col("text")), lambda c: _key(c, key_bits)).alias("keys")),
                    "recipes")
    texts = rows.select(F.explode(chunks(F.col("text"))).alias("chunk")) \
        .select(_key(F.col("chunk"), key_bits).alias("key"), "chunk").distinct()
    clashing = staged(texts.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "clashes")
    plain = hashed.select("doc_id", "rid", "text_sha256", F.transform(
        "keys", lambda k: F.struct(k.alias("key"), F.lit(0).alias("nth"))).alias("recipe"))
    if clashing.isEmpty():
        return plain
    touched = hashed.select("rid", F.explode("keys").alias("key")).join(clashing, "key", "left_semi") \
        .select("rid").distinct()
    nth = texts.join(clashing, "key", "left_semi").groupBy("key").agg(F.sort_array(F.collect_set("chunk")).alias("all")) \
        .select("key", F.posexplode("all").alias("nth", "chunk"))
    parts = rows.join(touched, "rid", "left_semi").select("rid", F.posexplode(chunks(F.col("text"))).alias("at", "chunk")) \
        .withColumn("key", _key(F.col("chunk"), key_bits))
    exact = parts.join(nth, ["key", "chunk"], "left").groupBy("rid").agg(F.sort_array(F.collect_list(
        F.struct("at", "key", F.coalesce("nth", F.lit(0)).alias("nth")))).alias("parts")) \
        .select("rid", F.transform("parts", lambda p: F.struct(p["key"].alias("key"), p["nth"].alias("nth"))).alias("exact"))
    return plain.join(exact, "rid", "left").select("doc_id", "rid", "text_sha256",
                                                   F.coalesce("exact", "recipe").alias("recipe"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, rid, keep_id, group_size, kept, text_sha256``."""
    rec = recipes(docs, id_col, text_col, key_bits)
    # written, so that the join below has plain exchanges on both sides and can split a large group
    groups = staged(rec.groupBy("recipe").agg(F.max(F.struct("doc_id", "rid")).alias("top"),
                                              F.count("*").alias("group_size")), "groups")
    return rec.join(groups, "recipe").select(
        "doc_id", "rid", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all copies but one of each text; columns unchanged."""
    rid = fresh(docs, "_row")
    gone = copies(docs, id_col, text_col).where("NOT kept").select(F.col("rid").alias(rid))
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(gone, rid, "left_anti").select(*docs.columns)
