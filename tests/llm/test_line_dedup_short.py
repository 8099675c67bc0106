import numpy as np

from lumentide.llm.line_dedup import fuzzy_lines, signatures
from lumentide.llm.queries import op1_line_dedup


def test_lines_of_any_length_take_part(spark, tmp_path):
    rows = [(1, "les.\na text of its own, number one\nabcdefghij"), (2, "LES. \n\n \na rather different second text"), (3, "les\nx\nabcdefghijk"), (4, "x\nx"), (None, "les."), (5, "abcdefgh\nabcdefg")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line_no): (r.class_doc, r.class_line) for r in op1_line_dedup(spark, str(tmp_path)).collect()}
    own = [(1, 0), (1, 1), (1, 2), (2, 3), (3, 0), (3, 1), (5, 0), (5, 1)]
    # 'abcdefghij' has three of the four shingles of 'abcdefghijk'; 'abcdefg' is no shingle of 'abcdefgh'
    assert got == {p: p for p in own} | {(2, 0): (1, 0), (3, 2): (1, 2), (4, 0): (3, 1), (4, 1): (3, 1)}


def test_exact_copies_of_short_lines_in_the_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first, seen = {}, set()
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        for n, raw in enumerate((r.text or "").split("\n")):
            line = " ".join(raw.lower().split())
            if line:
                seen.add((r.doc_id, n))
                first.setdefault(line, []).append((r.doc_id, n))
    out = fuzzy_lines(docs, least=1).collect()
    classes = {(r.doc_id, r.line_no): (r.class_doc, r.class_line) for r in out}
    assert len(out) == len(seen) and classes.keys() == seen
    assert all(len({classes[p] for p in places}) == 1 for places in first.values())
    assert any(len(line) < 20 and len(places) > 1 for line, places in first.items())


def test_short_signatures_do_not_depend_on_neighbours():
    lines = ["x", "abcdefg", "abcdefgh", "the quick brown fox jumps", "漢字"]
    together = signatures(lines)
    assert all((signatures([x])[0] == together[i]).all() for i, x in enumerate(lines))
    assert len(np.unique(together[:, 0])) == len(lines)
