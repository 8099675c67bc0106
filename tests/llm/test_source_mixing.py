from hashlib import md5

from lumentide.llm.source_mixing import mix_sources


def sizes(rows):
    return [(d, s, len((t or "").split())) for d, t, s in rows]


def brute(rows):
    """(doc_id, source, size, source_size, target, taken) with targets levelled source by source."""
    docs = sizes(rows)
    order = sorted({s for _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    whole = {s: sum(n for _, x, n in docs if x == s) for s in order}
    target, free, left = {}, set(order), sum(whole.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * whole[s]}
        if not full:
            target |= share
            break
        target |= {s: 3.0 * whole[s] for s in full}
        left -= sum(3 * whole[s] for s in full)
        free -= full
    out = []
    for s in order:
        start = 0
        for d, n in sorted(((d, n) for d, x, n in docs if x == s), key=lambda r: (md5(("" if r[0] is None else str(r[0])).encode()).hexdigest(), r[0] is not None, r[0] or 0, r[1])):
            out.append((d, s, n, whole[s], round(target[s], 6), sum(min(n, max(0, int(target[s] + 1e-9) - start - p * whole[s])) for p in range(3))))
            start += n
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, target int")
    return sorted(((r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.taken) for r in mix_sources(frame.repartition(3)).collect()), key=str)


def test_against_brute_force(spark):
    rows = [(i, "w " * (i * 7 % 23), "abcde"[i % 5]) for i in range(80)]
    rows += [(200, None, "a"), (201, "", "b"), (202, "x " * 4000, None), (None, "one two", "c"), (203, "z", "zz"), (3, "w " * 21, "d"), (3, "w " * 21, "d")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows) == run(spark, rows)


def test_columns_kept_under_names_that_clash(spark):
    frame = spark.createDataFrame([(1, "a b c", "s", 9, 8)], "doc_id long, text string, source string, size int, stream int")
    out = mix_sources(frame, keep=("size", "stream"))
    assert out.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "passes", "position", "kept_size", "stream"]
    assert [(r["size"], r.kept_size, r.stream) for r in out.collect()] == [(3, 9, 8)]


def test_no_rows(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, None)]) == [(1, None, 0, 0, 0.0, 0)]
