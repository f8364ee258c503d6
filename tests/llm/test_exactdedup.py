"""Exact dedup against counting texts, with tries that have to spill."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headway.llm.exactdedup import Trie, exact_duplicates


def brute(rows):
    groups = defaultdict(list)
    for id_, text in rows:
        groups[text or ""].append(id_)
    out = []
    for text, ids in groups.items():
        some = [i for i in ids if i is not None]
        best = max(some, default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = ids.index(best)
        out += [(i, best, len(ids), k == kept, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def result(spark, rows, schema="doc_id long, text string", parts=3, **kw):
    df = spark.createDataFrame(rows, schema).repartition(parts)
    return sorted((tuple(r) for r in exact_duplicates(df, **kw).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


ROWS = [
    (1, "alpha"), (2, "alpha"), (2, "alpha"), (3, "alphabet"), (4, ""), (5, None), (6, " alpha"), (7, "Alpha"), (None, "alpha"), (None, "zeta"), (None, "zeta"),
    (8, "größe"), (9, "größe"), (10, "größe"), (11, "a\0b"), (12, "a\0b"), (13, "x" * 100_000), (14, "x" * 100_000), (15, "x" * 99_999 + "y"), (-5, "neg"), (-7, "neg"),
]


def test_like_counting(spark):
    assert result(spark, ROWS) == brute(ROWS)


@pytest.mark.parametrize("room", [8_000, 60_000])
def test_spilled_subtrees(spark, room):
    rows = [(i, f"text {i % 23} of {'long ' * (i % 7)}") for i in range(200)] + ROWS
    assert result(spark, rows, room=room, parts=4) == brute(rows)


def test_hot_text(spark):
    rows = [(i, "the same text" if i % 3 else f"own {i}") for i in range(3_000)]
    assert result(spark, rows, parts=16) == brute(rows)


def test_empty_and_extra_columns(spark):
    assert result(spark, []) == []
    df = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 6, "y")], "doc_id long, text string, n long, number string")
    assert {tuple(r) for r in exact_duplicates(df).select("doc_id", "keep_id", "kept").collect()} == {(1, 2, False), (2, 2, True)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=6).map(str.encode), max_size=60), st.integers(0, 4_000))
def test_trie(keys, room):
    """Whatever is spilled, each key's copies are counted once, and one text always stays."""
    trie, out = Trie(room), defaultdict(int)
    for number, key in enumerate(keys):
        if not trie.add(key, (number, number), 1, [number]):
            out[key] += 1
        while trie.full():
            for text, end in trie.spill(forget=False):
                out[text] += end.n
    inside = dict(trie.all())
    assert not keys or inside
    assert not set(inside) & set(out)
    for text, end in inside.items():
        out[text] += end.n
        assert end.best == max((k, k) for k, x in enumerate(keys) if x == text)
    assert out == {k: keys.count(k) for k in keys}
    assert trie.held == sum(len(t) + 400 + 40 * len(e.numbers) for t, e in inside.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abc", max_size=5).map(str.encode), max_size=60), st.integers(0, 3_000))
def test_trie_forgets(keys, room):
    trie, out = Trie(room), defaultdict(int)
    for key in keys:
        trie.find(key).n += 1
        while trie.full():
            for text, end in trie.spill(forget=True):
                out[text] += end.n
    for text, end in trie.all():
        out[text] += end.n
    assert out == {k: keys.count(k) for k in keys}
