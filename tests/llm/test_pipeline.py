"""The pipeline's stages against plain Python on a small table."""

import corpus_pipeline
from headway.llm import pii


def test_stages(spark, tmp_path):
    spark.conf.set("spark.headway.pseudonymKey", "a key of the tests")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        path = str(tmp_path / name.replace(" ", "-"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        rows, old = docs.collect(), {r.doc_id: r for r in before.collect()}
        assert {r.doc_id for r in rows} <= set(old)
        if name != "best-fit packing":
            assert docs.columns == names and all(r.n_chars == len(r.text) for r in rows)
        if name == "quality rules":
            assert 0.8 * len(old) < len(rows) < len(old)
        if name == "line dedup":
            assert len(rows) > 0.9 * len(old)
        if name == "n-gram Jaccard join":
            sets = {d: pieces(r.text) for d, r in old.items()}
            kept = {r.doc_id for r in rows}
            links = {d: [x for x in sets if x != d and 100 * len(sets[d] & sets[x]) >= 75 * len(sets[d] | sets[x])] for d in sets}
            for d in sets:
                group, todo = {d}, [d]
                while todo:
                    for x in links[todo.pop()]:
                        if x not in group:
                            group.add(x)
                            todo.append(x)
                assert (d in kept) == (d == min(group) or not sets[d])
        if name == "PII":
            own = pii.Pseudonyms(b"a key of the tests")
            assert len(rows) == len(old) and all(r.text == own.rewrite(old[r.doc_id].text)[0] for r in rows)
        if name == "best-fit packing":
            used = {}
            for r in rows:
                used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
            assert {r.doc_id for r in rows} == set(old) and max(used.values()) <= 4096
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() == len(rows)


def test_near_duplicates_are_judged_by_row(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(3, a, "en"), (5, a, "en"), (5, b, "en"), (7, b + " c", "en"), (7, b + " c", "en"), (8, "x y", "en"), (8, "x y", "en"), (9, None, None), (9, None, None), (10, "", "en"), (None, "p q", "en"), (None, "p q", "en"), (None, a, "en"), (11, "u v", "en"), (11, "u v", "de")]
    df = spark.createDataFrame([(d, t, x, "s", None) for d, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r.doc_id, r.text, r.lang) for r in corpus_pipeline.near_duplicate_join(spark, df, "").collect()]
    want = [(3, a, "en"), (5, b, "en"), (8, "x y", "en"), (9, None, None), (9, None, None), (10, "", "en"), (None, "p q", "en")]
    assert sorted((r for r in out if r[0] != 11), key=str) == sorted(want, key=str)
    assert len([r for r in out if r[0] == 11]) == 1
    assert corpus_pipeline.near_duplicate_join(spark, df.limit(0), "").count() == 0


def pieces(text):
    words = "".join(c.lower() if c.isascii() else c for c in text).split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
