import corpus_pipeline
from lumentide.llm.common import Scratch
from tests.llm.test_decontamination import plain
from tests.llm.test_line_dedup import brute as line_classes
from tests.llm.test_ngram_join import brute as doc_classes


def test_each_stage_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, scratch = docs.columns, Scratch(spark, "t")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = scratch.write(stage(spark, docs, sf))
        if name != "mixing":
            assert docs.columns == columns
        kept[name] = before, docs.collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, after = kept["toxicity"]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert sum(labels.get(d) == 1 for d in gone) >= 0.7 * sum(t == 1 for t in labels.values())
    assert sum(labels.get(d) == 0 for d in gone) <= 0.03 * sum(t == 0 for t in labels.values())
    before, after = kept["line_dedup"]
    classes = line_classes([(r.doc_id, r.text) for r in before])
    want = {}
    for r in before:
        lines = [x for n, x in enumerate(r.text.split("\n")) if classes.get((r.doc_id, n), (r.doc_id, n)) == (r.doc_id, n)]
        if "\n".join(lines).strip() or not r.text.strip():
            want[r.doc_id] = "\n".join(lines)
    got = {r.doc_id: r.text for r in after}
    assert len(got.keys() ^ want.keys()) + sum(got[d] != want[d] for d in got.keys() & want.keys()) <= 0.01 * len(before)
    assert all(r.n_chars == len(r.text) for r in after)
    before, after = kept["near_duplicates"]
    classes = doc_classes([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == {d for d, (_, first) in classes.items() if d == first}
    before, after = kept["decontamination"]
    items = [plain(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in after}
    assert not any(i in plain(r.text) for r in after for i in items)
    assert len(clean) > 0.9 * len(before)
    before, after = kept["mixing"]
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    taken = {}
    for r in after:
        assert r.taken <= 3 * r.size
        taken.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(abs(t - n) <= 1 for t, n in taken.values())


def test_run_survives_odd_tables(spark, tmp_path):
    rows = [(1, None, None, None, 5), (None, "a b c d e f g h i j k l m n o p", "en", "s", 1), (2, "", "en", "s", 0), (3, "same text of a document that is long enough", "en", "s", 9), (3, "same text of a document that is long enough", "en", "s", 9), (4, "x " * 60_000, "de", None, 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == ["1", "2", "3", "4", "None"]
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_decisions_hold_for_rows_without_id_and_for_rows_that_share_one(spark, tmp_path):
    item = "which of these four planets is the third one from the sun, and how long does it take to go round it"
    x, own = "a line that two of them share, long enough to be told apart", "a unique line that has to stay, of document five and of no other"
    copy = "seven words that stand here only twice, and then some more of them so that it is a document"
    rows = [(1, x), (5, x), (5, own), (6, copy), (6, copy), (None, copy + " "), (None, f"so {item} then"), (9, f"and {item} again"), (None, "one more document without an id, of which nothing is to be lost")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    left = lambda name, d: sorted(((r.doc_id, r.text) for r in stages[name](spark, d, str(tmp_path)).collect()), key=str)
    key = lambda some: sorted(some, key=str)
    assert left("decontamination", docs) == key(rows[:6] + rows[8:])
    got = left("near_duplicates", docs)
    assert [r for r in got if "seven words" not in r[1]] == key([rows[0], rows[2], rows[7], rows[8]]) and len(got) == 5
    assert left("line_dedup", docs.where("doc_id is null or doc_id < 6")) == key([rows[0], rows[2], *rows[5:7], rows[8]])
