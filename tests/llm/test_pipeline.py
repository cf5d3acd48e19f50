import corpus_pipeline
from ledgerlake.llm.common import ROW_KEY, with_row_key
from ledgerlake.llm.decontaminate import contaminated
from ledgerlake.llm.mixing import mix
from ledgerlake.llm.quality import scored
from ledgerlake.llm.simhash import keep_one, near_duplicates

SF = "/root/testdata/sf0.001"


def test_each_stage_does_what_its_operator_says(spark, corpus):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    docs = corpus
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, docs, SF))
        if name == "sharding":
            assert ids(out) == ids(docs)
            break
        assert out.columns == corpus.columns
        if name == "quality":
            assert ids(out) == ids(scored(docs, labels).where("predicted = 1"))
        elif name == "near_duplicates":
            assert ids(out) == sorted({r.component_id for r in near_duplicates(docs).collect()})
        elif name == "decontamination":
            assert ids(out) == sorted(set(ids(docs)) - set(ids(contaminated(docs, bench))))
        elif name == "mixing":
            assert ids(out) == sorted(r.doc_id for r in mix(docs).collect() for _ in range(int(r.taken / max(1, r.size) + 0.5)))
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"] and got.count() > 0


def test_stages_take_an_empty_table(spark, corpus):
    docs = corpus.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF))
        assert docs.count() == 0


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, _rows int, _times string, _time int, _key_a string, _key_b int, rid string, fp string, at int, times int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, 2, "t", 3, "k", 4, "r", "f", 5, 6) for i, t, s in rows], CLASHING)


def test_rows_that_differ_by_nulls_are_told_apart(spark):
    """A null source beside a null text: different rows, which no row key may join."""
    docs = clashing(spark, [(7, None, "x"), (7, "x", None), (7, "x", "x")])
    keys = {tuple(r) for r in with_row_key(docs.select("doc_id", "text", "source")).select(*ROW_KEY).collect()}
    assert len(keys) == 3
    got = [(r.doc_id, r.text, r.source) for r in keep_one(docs).collect()]
    assert len(got) == 2 and (7, None, "x") in got  # one of the texts without words, one "x"


def test_stages_take_nulls_repeats_long_texts_and_any_column_names(spark, corpus):
    long_text = " ".join(r.text for r in corpus.limit(40).collect() if r.text)
    rows = [(r.doc_id, r.text, r.source) for r in corpus.limit(60).collect()]
    rows += [(None, None, None), (None, "", "a"), (9001, None, "a"), (9002, long_text, None), *[(9003, "the same few words here", "b")] * 3]
    docs = clashing(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, docs, SF))
        if name == "sharding":
            assert out.count() == docs.count()
            break
        assert out.columns == docs.columns and {r["_rows"] for r in out.select("_rows").collect()} <= {2}
        assert {r["_key_a"] for r in out.select("_key_a").collect()} <= {"k"} and out.count() > 0
        docs = out
