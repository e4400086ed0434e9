"""What operators put side by side in one plan, and how they keep texts."""

from __future__ import annotations

import glob

from strata.llm.jaccard_join import join_similar
from strata.llm.queries import QUERIES
from strata.session import checkpoint_root, local_path


def docs(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    return spark.createDataFrame([(i, text + (" x" if i % 2 else ""), "en") for i in range(6)] + [(9, None, None)], "doc_id long, text string, lang string")


def test_stored_trees_are_edited_by_one_worker_a_core(spark, tmp_path):
    docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["op7_token_counts"](spark, str(tmp_path))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert out.count() == 7


def test_stored_trees_take_little_room(spark, tmp_path):
    """A byte for a pre-token's length, and the texts of a language next to each other."""
    texts = docs(spark).selectExpr("doc_id", "text", "element_at(array('de', 'en', null), cast(doc_id % 3 + 1 as int)) as lang")
    texts.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    before = set(glob.glob(f"{local_path(checkpoint_root(spark))}/strata-scratch/op7-*"))
    assert QUERIES["op7_token_counts"](spark, str(tmp_path)).count() == 7
    new = set(glob.glob(f"{local_path(checkpoint_root(spark))}/strata-scratch/op7-*")) - before
    assert len(new) == 2
    for path in new:
        kept = spark.read.parquet(path)
        assert kept.schema["pieces"].dataType.simpleString() == "binary"
        langs = [r["lang"] or "" for r in kept.coalesce(1).collect()]
        assert langs == sorted(langs) and len(set(langs)) == 3


def test_kept_texts_are_packed_well(spark):
    before = set(glob.glob(f"{local_path(checkpoint_root(spark))}/strata-scratch/texts-*"))
    rows = join_similar(docs(spark)).collect()
    assert len({r["component_id"] for r in rows}) == 2
    new = set(glob.glob(f"{local_path(checkpoint_root(spark))}/strata-scratch/texts-*")) - before
    found = [f for p in new for f in glob.glob(f"{p}/*.parquet")]
    assert found and all(f.endswith(".zstd.parquet") for f in found)
