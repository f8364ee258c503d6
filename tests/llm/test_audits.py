"""The filter audit and the source audit against plain Python over all documents."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from headway.llm import divergence, filteraudit
from headway.llm.divergence import share, terms_of

SCHEMA = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"


def filters_brute(docs, labels):
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    facts = defaultdict(list)
    for i, text, lang, _ in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and least[t] < i,
        }
        facts[lang or ""].append(({f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part, rows in facts.items():
        removed_in = Counter()
        for order in map("".join, permutations("ABCDE")):
            for k, f in enumerate(order):
                gone = [bool(r[0] & set(order[:k])) for r in rows]
                removed = [r for r, g in zip(rows, gone, strict=True) if not g and f in r[0]]
                removed_in[f] += len(removed)
                out[part, order, k + 1] = [
                    sum(not g and f not in r[0] for r, g in zip(rows, gone, strict=True)), len(removed), sum(g and f in r[0] for r, g in zip(rows, gone, strict=True)),
                    sum(r[0] == {f} for r in rows), sum(r[1] for r in removed), sum(r[2] for r in removed),
                ]
        for (p, order, k), row in out.items():
            if p == part:
                row.append(removed_in[order[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def filter_rows(spark, docs, labels):
    df = filteraudit.audit(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS))
    assert df.columns == ["part", "filter_order", "step", *filteraudit.COUNTS, "shapley"]
    return {tuple(r)[:3]: tuple(r)[3:] for r in df.collect()}


def some_docs(n, seed):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        words = [rng.choice(["a", "B", "cc", "É#", "x", "Wörter"]) + (str(rng.randrange(400)) if rng.random() < 0.7 else "") for _ in range(rng.choice([3, 150, 199, 200, 260]))]
        docs.append((i, rng.choice([" ", "\n", "  "]).join(words), rng.choice(["de", "en", "", None]), "s"))
    return docs


def test_filters_like_brute_force(spark):
    docs = some_docs(60, 1)
    docs += [(100 + k, docs[k % 9][1], "en", "s") for k in range(40)]  # copies of early texts
    docs += [(5, docs[5][1], "de", "s"), (None, docs[3][1], "en", "s"), (None, docs[3][1], "en", "s"), (200, None, "en", "s"), (201, "", None, "s"), (-3, "only Upper", "fr", None)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 120, 2)] + [(4, 0, 1), (4, 1, 0), (None, 1, 1), (7, None, None)]
    got = filter_rows(spark, docs, labels)
    assert len(got) == 600 * 4
    assert got == filters_brute(docs, labels)


def test_filters_edges(spark):
    assert filter_rows(spark, [], [(1, 1, 1)]) == {}
    docs = [(1, "x" * 300_000, "en", "s"), (1, "x" * 300_000, "en", "s"), (2, "x" * 300_000, "en", "s")]
    assert filter_rows(spark, docs, []) == filters_brute(docs, [])


def test_filters_ignore_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "en", 7, True)], "doc_id long, text string, lang string, failed int, good boolean")
    labels = spark.createDataFrame([(1, 1, 0, "x")], LABELS + ", part string")
    assert filteraudit.audit(docs, labels).filter("step = 1").count() == 120


def terms_brute(docs, least):
    docs = [(a or "", b or "", c or "") for _, a, b, c in docs]
    words = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, *_ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(d[2], w) for d, w in zip(docs, words, strict=True) if d[1] == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = sorted((t for t in df if df[t] >= least), key=str.encode)
        v = len(kept)
        whole = Counter(t for _, w in own for t in w)
        counts = {s: Counter(t for x, w in own if x == s for t in w) for s in {s for s, _ in own}}
        p = lambda c, v=v, kept=kept: [1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * v) for t in kept]
        shares, q = {s: p(c) for s, c in counts.items()}, p(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = sorted((-sum(map(f, shares[s], shares[o])), o.encode(), o) for o in counts if o != s)
            terms = sorted((-f(a, b), t.encode(), t) for t, a, b in zip(kept, shares[s], q, strict=True) if counts[s][t] and a > b)[:10]
            out += [(lang, s, "pair", o, -x, k) for k, (x, _, o) in enumerate(pairs, 1)] + [(lang, s, "term", t, -x, k) for k, (x, _, t) in enumerate(terms, 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefgÉß漢" for b in ("", "x", "Y", "zz")]
    docs = []
    for i in range(900):
        source = rng.choice([*(f"s{k}" for k in range(23)), "", None, "Ünder"])
        lang = rng.choices(["en", "de", None, "one"], [8, 3, 1, 0.3])[0]
        own = [w for k, w in enumerate(words) if (k * 7 + hash_(source)) % 5]
        docs.append((i, rng.choice([" ", "-", "1", "_"]).join(rng.choices(own, k=rng.choice([0, 1, 8, 30]))), lang, "only" if lang == "one" else source))
    return docs + [(1000, None, "xx", "a"), (1001, "few words", "xx", "b"), (1002, "", "xx", None)]


def hash_(text):
    return sum((text or "").encode())


@pytest.mark.parametrize(("slice_", "block"), [(8192, 32), (7, 3), (5, 1), (1000, 4)])
def test_sources_like_brute_force(spark, sourced, slice_, block):
    df = divergence.audit(spark.createDataFrame(sourced, SCHEMA).repartition(5), slice_=slice_, block=block)
    assert sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect())) == terms_brute(sourced, 10)


def test_sources_edges(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = [(1, "b" * 100_000, "en", "a")] * 10 + [(2, "c", "en", "b")] * 12
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS term", "2 AS n", "3 AS blocks")
    assert sorted(map(tuple, divergence.audit(df).select("lang", "source", "part", "item", "value", "rank").collect())) == terms_brute(docs, 10)


@pytest.mark.parametrize("blocks", range(1, 12))
def test_every_two_blocks_meet_once(spark, blocks):
    rows = spark.createDataFrame([("en", 0, b, blocks, b"%d" % b) for b in range(blocks)], "lang string, slice long, block long, blocks long, packed binary")
    met = [(r["home"], int(r["packed"]), r["round"]) for r in divergence.tournament(rows).collect()]
    assert sorted(h for h, v, r in met if r < 0) == list(range(blocks))
    pairs = [(h, v, r) for h, v, r in met if r >= 0]
    assert sorted(tuple(sorted(p[:2])) for p in pairs) == [(i, j) for i in range(blocks) for j in range(i + 1, blocks)]
    # no block has two meetings in one round
    for k in range(blocks):
        turns = [r for h, v, r in pairs if k in (h, v)]
        assert len(turns) == len(set(turns))


def test_shares_are_exact():
    rng = random.Random(5)
    for _ in range(2_000):
        whole, terms = rng.randrange(2 ** rng.randrange(1, 47)), rng.randrange(1, 2**20)
        n = rng.randrange(whole + 1)
        assert share(np.array([n]), np.array([whole]), terms)[0] == 1 + 10**9 * (n + 2) // (whole + 2 * terms)
    assert math.isfinite(share(np.array([0]), np.array([0]), 0)[0])


def test_terms():
    text = "Ab1c É-ÑdZ_x`y{z\x7fq\x00漢字 w @[A]"
    assert [t.decode() for t in terms_of(text.encode())] == [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
