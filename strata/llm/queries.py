"""The registered queries of this package, with their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op4_exact_dedup", """
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(coalesce(d.text, '')) AS text_sha256
FROM documents d JOIN (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size
                       FROM documents GROUP BY 1) g ON coalesce(d.text, '') = g.t
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.exact_dedup import copies

    return copies(_table(spark, sf_dir, "documents")).drop("rid")


#: conversation -1: both texts hold the template's own control strings
PROBE = "<|im_end|><|im_start|>assistant ok"


@_query("op10_chat_format", f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
              ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
              FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length('<|im_end|>') + 2
                + length(replace(replace(replace(role, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'),
                                 chr(10), chr(92) || chr(10)))
                + length(replace(replace(text, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|')))
            AS BIGINT) AS formatted_chars,
       regexp_full_match(string_agg(replace(role, ',', '?'), ',' ORDER BY turn NULLS FIRST, role, text),
                         '(system,)?user,assistant((,user|(,tool)+),assistant)*') AS valid
FROM c GROUP BY conv_id
""")
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.chat_format import CHATML, format_chats, read_turns

    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(PROBE).alias("text"))
    rows = _table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(probe)
    out = format_chats(rows).select("conv_id", "valid", "formatted", read_turns(F.col("formatted")).alias("turns"))
    trained = F.filter("turns", lambda t: t["role"].isin(*CHATML.loss_roles))
    return out.withColumn("loss", F.array_join(F.transform(trained, lambda t: t["text"]), "")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


@_query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.toxicity import score

    # the significant passages' number, and where the one of the highest value is
    top = F.array_max(F.transform("spans", lambda s: F.struct(s["value"], -s["start"], s["end"])))
    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).withColumn("top", top).select(
        "doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"),
        (-F.col("top.col2")).alias("top_start"), F.col("top.end").alias("top_end"))


@_query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.pii import BASE, find_pii

    found = find_pii(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@_query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.byte_bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


@_query("op5_topk", """
WITH v AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings
           WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     w AS (SELECT vec_id, d, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM v),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
           FROM w q JOIN w c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) r WHERE rank <= 10
""")
def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.topk import top_k

    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"), 10).drop("query_row")


#: weights by path (domain, language, source); "*" matches any value, the rest weigh 1
MIX_WEIGHTS = {("web",): 2, ("curated",): 1, ("*", "en"): 3, ("*", "*", "src0"): 2}
MIX_SEED, MIX_EPOCHS, MIX_FRACTION = 7, 3, (4, 5)


def mix_levels():
    """The tree: a source whose name ends in an even digit belongs to the web, any other is curated."""
    return {"domain": F.when(F.coalesce(F.col("source"), F.lit("")).rlike("[02468]$"), "web").otherwise("curated"),
            "lang": F.col("lang"), "source": F.col("source")}


def mix_oracle(docs: str, epochs: int, fraction: tuple[int, int], select: str) -> str:
    """DuckDB text of the mix over ``docs`` (a table name), ending in ``select`` over ``picked``."""
    def level(name, path, parent, weight):
        keys = ", ".join(path)
        part = "PARTITION BY " + ", ".join(path[:-1]) if len(path) > 1 else ""
        up = f"JOIN {parent} USING ({', '.join(path[:-1])})" if len(path) > 1 else f"CROSS JOIN {parent}"
        return f"""
  {name}_a AS (SELECT {keys}, CAST(sum(tokens) * {epochs} AS HUGEINT) AS cap, CAST({weight} AS HUGEINT) AS w
               FROM leaves GROUP BY {keys}),
  {name}_b AS (SELECT a.*, budget AS b FROM {name}_a a {up} WHERE w > 0),
  {name}_c AS (SELECT *, cap * CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT)
      <= (b - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT)) * w AS is_full
      FROM {name}_b WINDOW o AS ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {path[-1]})),
  {name} AS (SELECT {keys}, CASE WHEN is_full THEN cap ELSE
      ((b - CAST(coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({part}), 0) AS HUGEINT)) * w)
      // CAST(sum(CASE WHEN NOT is_full THEN w END) OVER ({part}) AS HUGEINT) END AS budget FROM {name}_c)"""

    return f"""
WITH docs AS (SELECT *, CASE WHEN regexp_matches(coalesce(source, ''), '[02468]$') THEN 'web' ELSE 'curated' END AS l0,
                     coalesce(lang, '') AS l1, coalesce(source, '') AS l2,
                     CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\f\x0B]+')) AS BIGINT) AS n_tokens
              FROM {docs}),
  leaves AS (SELECT l0, l1, l2, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
  root AS (SELECT CAST(sum(tokens) AS HUGEINT) * {fraction[0]} // {fraction[1]} AS budget FROM leaves),
  {level('d0', ['l0'], 'root', "CASE WHEN l0 = 'web' THEN 2 ELSE 1 END")},
  {level('d1', ['l0', 'l1'], 'd0', "CASE WHEN l1 = 'en' THEN 3 ELSE 1 END")},
  {level('d2', ['l0', 'l1', 'l2'], 'd1', "CASE WHEN l2 = 'src0' THEN 2 ELSE 1 END")},
  plan AS (SELECT l0, l1, l2, CAST(CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS BIGINT) AS whole,
                  CASE WHEN tokens > 0 THEN budget % CAST(tokens AS HUGEINT) ELSE 0 END AS rest
           FROM d2 JOIN leaves USING (l0, l1, l2)),
  placed AS (SELECT *, md5('{MIX_SEED}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
             FROM docs JOIN plan USING (l0, l1, l2)),
  picked AS (
    SELECT *, whole AS epoch FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY l0, l1, l2 ORDER BY place) AS upto FROM placed)
    WHERE rest > 0 AND upto <= rest
    UNION ALL
    SELECT *, 0 AS upto, unnest(range(whole)) AS epoch FROM placed WHERE whole > 0)
{select}"""


@_query("op9_mixing", mix_oracle("documents", MIX_EPOCHS, MIX_FRACTION,
                                 "SELECT doc_id, epoch, l0 AS domain, l1 AS lang, l2 AS source, n_tokens FROM picked"))
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, fraction=MIX_FRACTION,
               max_epochs=MIX_EPOCHS, seed=MIX_SEED).drop("rid")


@_query("op6_jaccard_join")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.jaccard_join import join_similar

    return join_similar(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.suffix_dedup import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), with_text=False)


def clean_up_edits():
    """Three edits of a clean-up pass, from the end of the text to its start: the last of several
    lines goes, the first number before it becomes ``<num>``, and the language is put in front."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.char_length(text)
    last = size - F.char_length(F.substring_index(text, "\n", -1))
    at = F.regexp_instr(text, F.lit(r"[0-9]+"))
    number = F.char_length(F.coalesce(F.regexp_substr(text, F.lit(r"[0-9]+")), F.lit("")))

    def edit(start, end, new):
        return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), new.alias("text"))

    return F.filter(F.array(
        F.when(last > 0, edit(last - 1, size, F.lit(""))),
        F.when((at > 0) & ((last == 0) | (at + number < last)), edit(at - 1, at - 1 + number, F.lit("<num>"))),
        edit(F.lit(0), F.lit(0), F.concat(F.lit("["), F.coalesce("lang", F.lit("")), F.lit("] ")))),
        lambda e: e.isNotNull())


def second_edits():
    """A later edit of what the clean-up left: the first ``<num>`` becomes ``<n>``; other texts are not touched."""
    at = F.instr("text", "<num>")
    return F.when(at > 0, F.array(F.struct((at - 1).alias("start"), (at + 4).alias("end"), F.lit("<n>").alias("text"))))


@_query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees are loaded and stored; the stored ones are edited and stored, and what that leaves is edited again."""
    import public_tokenizers

    from strata.llm.token_counts import edit_trees, load_trees, stored

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = _table(spark, sf_dir, "documents").sortWithinPartitions("lang")  # one language's texts pack better together
    trees = stored(load_trees(docs, *vocabulary, also=["lang"]), "op7-trees")
    trees = trees.withColumns({"n_tokens_before": F.col("n_tokens"), "edits": clean_up_edits()})
    once = stored(edit_trees(trees, *vocabulary), "op7-edited")  # one Python worker for a core, not two side by side
    return edit_trees(once.withColumn("edits", second_edits()), *vocabulary).select(
        "doc_id", "n_tokens_before", "n_tokens", "n_edits", "n_reencoded", "n_chars")


@_query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.alignment import align

    return align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model")).drop("rid")


@_query("op12_secrets")
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.secrets import KINDS, BASE, find_secrets

    found = find_secrets(_table(spark, sf_dir, "documents"))

    def of_kind(kind):
        return lambda s: s["kind"] == kind

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[F.size(F.filter("spans", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))


@_query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))
