"""The pipeline's stages, one after the other, on a small planted corpus."""

import random

import corpus_pipeline
from skylattice.llm import storage


def corpus(spark, folder):
    rng = random.Random(1)
    words = [f"v{k}" for k in range(2000)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, leak = say(80), say(14)
    texts = {k: say(150) for k in range(60)}
    texts[60] = texts[3]  # exact copy
    texts[61] = texts[4].replace(texts[4].split()[70], "edited", 1)  # near copy
    texts[62] = f"{say(70)} {passage} {say(70)}"
    texts[63] = f"{say(70)} {passage} {say(70)}"
    texts[64] = f"{say(60)} {leak} {say(60)}"
    for k in range(65, 85):
        texts[k] = " | ".join(rng.choice(["BUY!!", "$$$", "###"]) for _ in range(80))
    texts[85], texts[86] = None, ""
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 65), 0) for k in range(0, 85) if k not in (70, 75)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, passage


def test_stages(spark, tmp_path):
    texts, passage = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        docs = storage.save(out, f"file://{tmp_path}/stage-{k}")
        rows = {r["doc_id"]: r for r in docs.collect()}
        seen.append(set(rows))
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if k == 2:
            assert passage in rows[62]["text"] and passage not in rows[63]["text"] and rows[63]["n_chars"] == len(rows[63]["text"])
    good = set(range(65))
    assert good <= seen[0] and not seen[0] & set(range(65, 85))
    assert seen[1] & good == good - {60, 61}
    assert seen[3] & good == good - {60, 61, 64}
    assert seen[4] == seen[3]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == seen[4]
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, tmp_path):
    """No document; and documents without labels, benchmark items, texts or ids."""
    schemas = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, schema in schemas.items():
        for kind in ("none", "some"):
            spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{kind}/{name}.parquet")
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c", "en", "s", 5), (2, "a b c", "en", "s", 5), (3, "A B C", None, None, None)]
    spark.createDataFrame(rows, schemas["documents"]).write.mode("overwrite").parquet(f"{tmp_path}/some/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/some").collect()]
    assert got.count(2) == 1 and len(got) == len(set(got)) and set(got) <= {None, 1, 2, 3}
