import corpus_pipeline as pipeline
from leafloom.llm import catalog


def test_stages_in_order_and_registered():
    import __spark_entry__ as entry

    assert [n for n, _ in pipeline.STAGES] == ["language", "quality", "near_duplicates", "mix", "pieces"]
    assert {f"op{n}_" for n in range(1, 11)} == {q.split("_")[0] + "_" for q in catalog.QUERIES}
    assert set(catalog.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(catalog.ORACLE_SQL) <= set(entry.oracle_sql())


def test_each_stage_on_its_own_input(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in pipeline.STAGES[:-1]:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        kept = spark.read.parquet(str(tmp_path / name))
        assert kept.columns == columns
        before, after = {r.doc_id for r in docs.collect()}, {r.doc_id for r in kept.collect()}
        assert after <= before and after
        sizes.append((len(before), len(after)))
        docs = kept
    assert sizes[1][1] < sizes[1][0] and sizes[2][1] < sizes[2][0]
    got = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(got) == docs.count() and all(r.round_trip for r in got)


def test_stages_take_odd_rows_and_empty_tables(spark, sf):
    text = "The cat sat on the mat and the dog too."
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", None, 0), (2, text, "en", "s", 5), (2, text, "en", "s", 5), (None, text, "en", None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(pipeline.STAGES)
    rows = lambda name: sorted(((r.doc_id or 0, r.text or "") for r in stages[name](spark, odd, sf).collect()))
    whole = (2, text)
    assert rows("language") == [(0, text), whole, whole]  # null and letter-free texts go, repeated rows stay
    assert len(stages["quality"](spark, odd, sf).collect()) in range(6)
    assert rows("near_duplicates") == [(0, ""), (0, text), (1, ""), whole]  # a row a doc_id; null ids stay
    mixed = stages["mix"](spark, odd, sf).collect()
    assert mixed and all(r.text and set(r.text.split()) <= set(text.split()) for r in mixed)
    coded = {(r.doc_id, r.n_tokens, r.round_trip) for r in stages["pieces"](spark, odd, sf).collect()}
    assert (1, 0, None) in coded and (None, 0, True) in coded and all(t is not False for _, _, t in coded)
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd.limit(0), sf).collect() == []


def test_run_is_the_chain_of_stages(spark, sf, tmp_path):
    rows = pipeline.run(spark, sf).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.tokens) for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    plain = lambda some: sorted((r.doc_id, r.lang, r.source, tuple(r.tokens)) for r in some)
    assert plain(rows) == plain(docs.collect())
