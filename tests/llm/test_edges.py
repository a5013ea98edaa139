"""Empty tables, null and repeated ids, clashing columns, and the pipeline's stages."""

from __future__ import annotations

import public_tokenizers

from swathline.llm import credentials, decontaminate, language, mixing, quality, repeats, rollup, simhash, tokenstore, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LABEL = "doc_id long, quality int, toxic int"


def _all(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None)], LABEL)
    tests = spark.createDataFrame([(1, "b c d e f g"), (2, None), (3, "too short"), (None, "x")], "item_id long, text string")
    return {
        "decontaminate": decontaminate.contained(docs, tests),
        "clean": decontaminate.clean(docs, tests),
        "simhash": simhash.near_duplicates(docs),
        "keep_one": simhash.keep_one(docs),
        "quality": quality.ledger(docs),
        "toxicity": toxicity.predict(docs, labels),
        "drop_toxic": toxicity.drop_toxic(docs, labels),
        "secrets": credentials.find(docs),
        "tokens": tokenstore.encoded(docs, TOKENIZER),
        "counts": rollup.measured(docs),
        "mix": mixing.mix(docs),
        "repeated": mixing.repeated(docs, mixing.mix(docs)),
        "repeats": repeats.cut(docs),
        "language": language.identify(docs),
    }


def test_empty_tables(spark, empty):
    assert {name: found.count() for name, found in _all(spark, empty).items()} == dict.fromkeys(_all(spark, empty), 0)


def test_odd_rows(spark, odd):
    found = {name: rows.collect() for name, rows in _all(spark, odd).items()}
    for name in ("simhash", "quality", "toxicity", "secrets", "tokens", "mix", "repeats", "language", "drop_toxic"):
        assert len(found[name]) == 6, name
    assert len(found["counts"]) == 12
    assert {(r.doc_id, r.item_id) for r in found["decontaminate"]} == {(None, 1), (1, 1)}
    assert {r.doc_id for r in found["clean"]} == {None, 2}
    assert [r.lang_pred for r in found["language"] if r.doc_id == 2] == ["und"]
    assert found["drop_toxic"][0].asDict().keys() == set(odd.columns) == found["repeated"][0].asDict().keys() | set(odd.columns)


def test_pipeline_stages_decide(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, folder)
        assert after.columns == docs.columns
        kept, ids = [r.doc_id for r in after.select("doc_id").collect()], {r.doc_id for r in before.select("doc_id").collect()}
        assert set(kept) <= ids
        if name == "toxicity":
            lost = {r.doc_id for r in toxicity.predict(before, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
            assert set(kept) == ids - lost
        if name == "simhash":
            assert sorted(kept) == sorted({r.component_id for r in simhash.near_duplicates(before).collect()})
        if name == "decontamination":
            hit = {r.doc_id for r in decontaminate.contained(before, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
            assert set(kept) == ids - hit
        if name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies}
            assert {i: kept.count(i) for i in set(kept)} == copies
        before = after
    assert corpus_pipeline.STAGES[-1][1](spark, before, folder).count() == len(kept)


def test_pipeline_decides_by_row(spark, odd, tmp_path):
    from collections import Counter

    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    item = spark.createDataFrame([(1, "b c d e f g")], "item_id long, text string")
    item.write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = stages["decontamination"](spark, odd, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, "other words of the same id"), (2, None)]
    # the copies of one text leave one row, that of the smallest id; another text of that id is no copy
    kept = stages["simhash"](spark, odd, "").collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, "a b c d e f g"), (1, "other words of the same id"), (2, "")]
    rows = [(None, f"{'w ' * (5 + i)}n{i}", "en", "s", 0) for i in range(40)] + [(1, "x " * 30, "en", "s", 0)] * 10 + [(1, "y " * 30, "en", "t", 0)] * 40
    docs = spark.createDataFrame(rows, odd.select("doc_id", "text", "lang", "source", "n_chars").schema)
    want, got = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        want[r.doc_id, r.size] += r.copies
    for r in stages["mixing"](spark, docs, "").collect():
        got[r.doc_id, len(r.text.split())] += 1
    assert {k: n for k, n in want.items() if n} == got and len(got) > 10


def test_every_text_of_a_test_item_is_searched(spark):
    from pyspark.sql import functions as F

    texts = [" ".join(f"{c}{i}" for i in range(12)) for c in "abc"]
    tests = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (None, texts[2]), (2, texts[1])], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"so {t} on") for i, t in enumerate(texts)] + [(3, "nothing of the kind is in here at all")], "doc_id long, text string")
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        found = decontaminate.contained(docs, tests, broadcast_bytes=limit)
        assert {tuple(r) for r in found.select("doc_id", "item_id", "n_shared", "n_item").collect()} == {(0, 1, 8, 8), (1, 1, 8, 8), (1, 2, 8, 8), (2, None, 8, 8)}
        for clean in (decontaminate.clean, decontaminate.clean_rows):
            assert [r.doc_id for r in clean(docs, tests, broadcast_bytes=limit).collect()] == [3]
    named = decontaminate.contained(docs, tests.withColumn("item_id", F.col("item_id").cast("string")))
    assert {r.item_id for r in named.collect()} == {"1", "2", None}


def test_pipeline_runs_from_tables_to_tokens(spark):
    import array
    import zlib
    from collections import Counter

    import corpus_pipeline
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    tokenizer, docs = Tokenizer.from_file(TOKENIZER), spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    want = Counter(r.doc_id for r in docs.select("doc_id").collect())
    found = sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in found) == want and max(want.values()) > 1
    assert [r.doc_id for r in found] == sorted(r.doc_id for r in found)
    at = 0
    for r in found:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(array.array("I", ids).tobytes()))
        at += len(ids)


def test_pipeline_of_empty_and_odd_tables(spark, empty, odd, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], LABEL).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, docs in (("empty", empty), ("odd", odd)):
        here = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, here, str(tmp_path))
            assert after.columns == docs.columns
            here = after
        tokens = corpus_pipeline.STAGES[-1][1](spark, here, str(tmp_path)).collect()
        assert (len(tokens) == 0) == (name == "empty")
