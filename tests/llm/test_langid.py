"""The language CRF: forward-backward against enumeration, held-out accuracy, code-switched text, edge cases."""

import itertools

import numpy as np

from headway.llm import langid


def test_messages_against_enumeration():
    rng = np.random.default_rng(0)
    m, sizes = 3, [1, 5, 2, 4]
    moves, start = rng.normal(size=(m, m)), rng.normal(size=m)
    e = rng.normal(size=(sum(sizes), m)) * 3
    first = np.zeros(len(e), bool)
    first[np.cumsum([0, *sizes[:-1]])] = True
    for block in (1, 2, 64):
        langid.BLOCK, old = block, langid.BLOCK
        got, at = langid.messages(e, first, moves, start), 0
        langid.BLOCK = old
        for n in sizes:
            want = np.zeros((n, m))
            for path in itertools.product(range(m), repeat=n):
                w = start[path[0]] + sum(e[at + t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path))
                for t, y in enumerate(path):
                    want[t, y] += np.exp(w)
            assert np.allclose(got[at : at + n], want / want.sum(1, keepdims=True))
            at += n


def test_pair_counts_against_enumeration():
    rng = np.random.default_rng(1)
    e, moves, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    want = np.zeros((3, 3))
    for chain in e:
        part, total = np.zeros((3, 3)), 0
        for path in itertools.product(range(3), repeat=4):
            w = np.exp(start[path[0]] + sum(chain[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            total += w
            for a, b in itertools.pairwise(path):
                part[a, b] += w
        want += part / total
    assert np.allclose(langid.pair_counts(e, moves, start), want)


def plain_features(word):
    """n-grams of one word with its ends, hashed as they are defined."""
    codes, wide = [langid.BEGIN, *map(ord, word), langid.END], (1 << 64) - 1
    out = []
    for n in langid.NGRAMS:
        for k in range(len(codes) - n + 1):
            x = 0
            for c in codes[k : k + n]:
                x = (x + c) * 0x9E3779B97F4A7C15 & wide
                x ^= x >> 29
            out.append((x >> 7) % langid.BUCKETS)
    return sorted(out)


def test_features_of_any_characters():
    words = ["the", "a", "a\x02b", "\x03", "\x02\x03", "x" * 40, "é", "日本", "\U0010ffff", *map(chr, range(32)), "a"]
    buckets, begin, whole = langid.features(words)
    parts = np.split(buckets, begin[1:])
    assert [sorted(p.tolist()) for p in parts] == [plain_features(w) for w in words]
    assert len(set(whole.tolist())) == len(set(words)) and whole[1] == whole[-1]


def test_control_characters_in_texts(spark):
    rows = [(k, f"a{chr(k)}b the cat sat {chr(k)}on{chr(k)} the mat", "en") for k in range(1, 32)] + [(100 + k, f"der Hund und die Katze {k}", "de") for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.with_held_out(docs).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out} <= {"en", "de"}


def test_every_language_and_whole_texts_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ALL", 100)
    letter = lambda k: chr(0x4E00 + k)
    rows = [(k, " ".join([letter(k) * 3] * 30), f"l{k:03d}") for k in range(80)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == sorted({r[2] for r in rows})
    # the second half of a long text counts as much as the first
    halves = [(1, "aaa " * 3000 + "bbb " * 3000, "x"), (2, "ccc " * 6000, "y")]
    model = langid.fit(spark.createDataFrame(halves, "doc_id long, text string, lang string"))
    assert [p[0] for p in langid.Labeller(model).label(["bbb bbb bbb", "ccc ccc"])] == ["x", "y"]


def test_held_out_accuracy_and_switches(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.with_held_out(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.lang and any(c.isalpha() for c in r.text or "")]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    model = langid.fit(docs)
    texts = {lang: next(r.text for r in rows if r.lang == lang and r.lang_pred == lang and len(r.text.split()) > 60).split()[:40] for lang in ("en", "de")}
    (_, _, spans), *_ = langid.Labeller(model).label([" ".join(texts["en"] + texts["de"])])
    words = [s["lang"] for s in spans for _ in range(s["words"])]
    assert words[:40].count("en") >= 36 and words[40:].count("de") >= 36


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string, segments int"
    rows = [(1, "the cat and the dog", "en", "x", 1), (1, "the cat and the dog", "en", "x", 1), (2, None, "en", None, None), (3, "", "de", "", 0), (4, "123 !! --", None, "x", 1),
            (None, "der Hund und die Katze", "de", "x", 1), (6, "der Hund und die Katze", "de", "x", 1), (7, "wort " * 50_000, None, "x", 1), (8, "é", "de", "x", 1)]
    df = spark.createDataFrame(rows, schema)
    out = langid.identify(df, langid.fit(df)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.lang_pred == "und") == (r.text is None or not any(c.isalpha() for c in r.text)) and 0 <= r.score <= 1
    assert langid.with_held_out(df).count() == len(rows)
    assert langid.with_held_out(spark.createDataFrame([], schema)).count() == 0
    assert {r.lang_pred for r in langid.identify(df, langid.Model([], np.zeros(0, np.uint64))).collect()} == {"und"}
