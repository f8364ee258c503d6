"""Language labels of words by a linear-chain conditional random field.

A word's features are its character n-grams with the word's ends (so prefixes and
suffixes too) and, for words of the learned lexicon, the word itself.  Weights and
transitions are learned by maximum likelihood on chains that switch between
documents of different languages.  Words of a text are labelled by forward-backward
over its whole length: chains of many texts are laid end to end and cut into
blocks, whose transfer matrices carry the messages across block borders.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces
from .quality import let, words_of

#: The labelled rows learned from: documents of all languages together, of each language at most and at least; words of each document, in stretches over its whole length.
SAMPLE_ALL, SAMPLE_DOCS, SAMPLE_LEAST, SAMPLE_WORDS, STRETCHES = 10_240, 160, 8, 240, 10
NGRAMS, BUCKETS, LEXICON = (1, 2, 3, 4), 1 << 16, 1 << 14
CHAIN, STEPS, RATE, DECAY = 32, 60, 0.3, 1e-5
BLOCK, CACHE = 64, 300_000
UNKNOWN = "und"
#: Marks of a word's ends, beyond all code points.
BEGIN, END = 0x110000, 0x110001


def bare(run: str) -> str:
    """The letters of a run, in lower case, with what stands between them."""
    run = run.lower()
    if run.isalpha():
        return run
    a, b = 0, len(run)
    while a < b and not run[a].isalpha():
        a += 1
    while b > a and not run[b - 1].isalpha():
        b -= 1
    return run[a:b]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram buckets of words, where each word's begin, and a hash of each word (none may be empty)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    # marks of both ends that are no characters
    codes = np.full(int(lengths.sum()), BEGIN, np.uint64)
    codes[begin + lengths - 1] = END
    inner = np.ones(len(codes), bool)
    inner[begin] = inner[begin + lengths - 1] = False
    codes[inner] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    parts, owners = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        size = len(codes) - n + 1
        if size <= 0:
            break
        rolling = (rolling[:size] + codes[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        rolling ^= rolling >> np.uint64(29)
        if n in NGRAMS:
            same = owner[:size] == owner[n - 1 :]
            parts.append((rolling[same] >> np.uint64(7)) % np.uint64(BUCKETS))
            owners.append(owner[:size][same])
    buckets, of = np.concatenate(parts).astype(np.int64), np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    place = np.arange(len(codes)) - begin[owner]
    mixed = (codes + np.uint64(1)) * (np.uint64(2) * place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95)
    mixed ^= mixed >> np.uint64(31)
    whole = np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), begin)
    return buckets[order], np.searchsorted(of[order], np.arange(len(words))), whole


class Model:
    def __init__(self, languages: list[str], lexicon: np.ndarray):
        n = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights = np.zeros((BUCKETS + len(lexicon) + 1, n), np.float32)
        self.moves, self.start = np.zeros((n, n)), np.zeros(n)

    def lexicon_row(self, whole: np.ndarray) -> np.ndarray:
        """Row of each word's own weight; the last row, of zeros, for words outside of the lexicon."""
        at = np.searchsorted(self.lexicon, whole)
        known = (at < len(self.lexicon)) & (self.lexicon[np.minimum(at, len(self.lexicon) - 1)] == whole) if len(self.lexicon) else np.zeros(len(whole), bool)
        return BUCKETS + np.where(known, at, len(self.lexicon))

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.languages)))
        buckets, begin, whole = features(words)
        return np.add.reduceat(self.weights[buckets], begin, axis=0).astype(np.float64) + self.weights[self.lexicon_row(whole)]


def messages(e: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Marginals of each position by forward-backward; ``e``: emissions, ``first``: whether a chain begins there."""
    n, m = e.shape
    size = -(-n // BLOCK)
    x = np.ones((size * BLOCK, m))
    x[:n] = np.exp(e - e.max(1, keepdims=True))
    new = np.ones(size * BLOCK, bool)
    new[:n] = first
    x, new = x.reshape(size, BLOCK, m), new.reshape(size, BLOCK)
    a, s = np.exp(moves - moves.max()), np.exp(start - start.max())
    transfer = np.broadcast_to(np.eye(m), (size, m, m)).copy()
    for t in range(BLOCK):
        transfer = (transfer.reshape(-1, m) @ a).reshape(size, m, m) * x[:, t, None, :]
        here = new[:, t]
        if here.any():
            transfer[here] = (s * x[here, t])[:, None, :]
        transfer /= transfer.max(axis=(1, 2), keepdims=True)
    before, after = np.empty((size, m)), np.empty((size, m))
    state = np.ones(m)
    for k in range(size):
        before[k] = state
        state = state @ transfer[k]
        state = state / state.max()
    state = np.ones(m)
    for k in range(size - 1, -1, -1):
        after[k] = state
        state = transfer[k] @ state
        state = state / state.max()
    alpha, state = np.empty_like(x), before
    for t in range(BLOCK):
        state = np.where(new[:, t, None], s, state @ a) * x[:, t]
        state = state / state.max(1, keepdims=True)
        alpha[:, t] = state
    state = after
    for t in range(BLOCK - 1, -1, -1):
        alpha[:, t] *= state
        back = (x[:, t] * state) @ a.T
        state = np.where(new[:, t, None], 1.0, back / back.max(1, keepdims=True))
    out = alpha.reshape(-1, m)[:n]
    return out / out.sum(1, keepdims=True)


def learn(samples: list[tuple[str, list[str]]], seed: int = 7) -> Model:
    """Maximum likelihood by gradient steps on chains of CHAIN words, made of stretches of the samples (language, words)."""
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    stretches = []
    for lang, words in samples:
        k = 0
        while k < len(words):
            size = int(rng.integers(3, 2 * CHAIN))
            stretches.append((languages.index(lang), words[k : k + size]))
            k += size
    rng.shuffle(stretches)
    labels = np.array([y for y, ws in stretches for _ in ws], np.int64)
    flat = [w for _, ws in stretches for w in ws]
    names, index = np.unique(np.array(flat, object), return_inverse=True)
    counts = np.bincount(index)
    _, _, whole = features(names.tolist())
    common = np.argsort(-counts, kind="stable")[:LEXICON]
    model = Model(languages, np.unique(whole[common[counts[common] > 2]]))
    buckets, begin, whole = features(names.tolist())
    own = model.lexicon_row(whole)
    lengths = np.diff(np.append(begin, len(buckets)))
    chains, m = len(flat) // CHAIN, len(languages)
    if not chains:
        index, labels, chains = np.resize(index, CHAIN), np.resize(labels, CHAIN), 1
    index, labels = index[: chains * CHAIN], labels[: chains * CHAIN]
    first = np.arange(len(index)) % CHAIN == 0
    truth = np.eye(m)[labels]
    last = first[1:]
    steps = np.zeros((m, m))
    np.add.at(steps, (labels[:-1][~last], labels[1:][~last]), 1)
    squares = [np.full_like(model.weights, 1e-8), np.full((m, m), 1e-8), np.full(m, 1e-8)]
    for _ in range(STEPS):
        word = np.add.reduceat(model.weights[buckets], begin, axis=0) + model.weights[own]
        e = word[index].astype(np.float64)
        p = messages(e, first, model.moves, model.start)
        # pairs of neighbours: alpha and beta follow from the marginals of chains laid side by side
        pair = pair_counts(e.reshape(chains, CHAIN, m), model.moves, model.start)
        gap = truth - p
        by_word = np.stack([np.bincount(index, gap[:, y], len(names)) for y in range(m)], 1)
        spread = np.repeat(by_word, lengths, 0)
        gradient = np.zeros_like(model.weights)
        for y in range(m):
            gradient[:, y] = np.bincount(buckets, spread[:, y], len(gradient)) + np.bincount(own, by_word[:, y], len(gradient))
        gradient[-1] = 0
        grads = [gradient / len(index) - DECAY * model.weights, (steps - pair) / len(index), gap[first].sum(0) / len(index)]
        for value, grad, square in zip((model.weights, model.moves, model.start), grads, squares, strict=True):
            square += grad**2
            value += RATE * grad / np.sqrt(square)
    return model


def pair_counts(e: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Expected moves between labels over chains (chain, place, label)."""
    x = np.exp(e - e.max(2, keepdims=True))
    a, s = np.exp(moves - moves.max()), np.exp(start - start.max())
    forward = [x[:, 0] * s]
    for t in range(1, x.shape[1]):
        f = (forward[-1] @ a) * x[:, t]
        forward.append(f / f.max(1, keepdims=True))
    out, back = np.zeros_like(moves), np.ones_like(x[:, 0])
    for t in range(x.shape[1] - 1, 0, -1):
        right = x[:, t] * back
        weight = np.einsum("ci,ij,cj->c", forward[t - 1], a, right)
        out += np.einsum("ci,cj->ij", forward[t - 1] / weight[:, None], right) * a
        back = right @ a.T
        back /= back.max(1, keepdims=True)
    return out


class Labeller:
    """Labels texts with a model, keeping emissions of words it has met."""

    def __init__(self, model: Model):
        self.model, self.rows = model, {}
        self.table = np.zeros((1, len(model.languages)))

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """(language, mean probability of it, stretches of words of one language) of each text."""
        names = self.model.languages
        if not names:
            return [(UNKNOWN, 0.0, [])] * len(texts)
        runs = [(t or "").split() for t in texts]
        used = set().union(*runs)
        if len(self.rows) > CACHE:
            self.rows, self.table = {}, self.table[:1]
        fresh = list(used.difference(self.rows))
        words = [bare(r) for r in fresh]
        some = [w for w in dict.fromkeys(words) if w]
        at = {w: k + len(self.table) for k, w in enumerate(some)} | {"": 0}
        self.table = np.concatenate([self.table, self.model.emissions(some)])
        self.rows.update((r, at[w]) for r, w in zip(fresh, words, strict=True))
        get = self.rows.__getitem__
        counts = np.array([len(r) for r in runs])
        ends = np.cumsum(counts)
        index = np.fromiter((i for r in runs for i in map(get, r)), np.int64, int(ends[-1]) if len(ends) else 0)
        out: list[tuple[str, float, list[dict]]] = [(UNKNOWN, 0.0, [])] * len(texts)
        # words without a letter take no part
        real = index > 0
        sizes = np.add.reduceat(np.append(real, False), np.concatenate([[0], ends[:-1]])) * (counts > 0) if len(ends) else counts
        index, with_words = index[real], np.flatnonzero(sizes)
        if not len(index):
            return out
        starts = np.concatenate([[0], np.cumsum(sizes[with_words])[:-1]])
        first = np.zeros(len(index), bool)
        first[starts] = True
        p = messages(self.table[index], first, self.model.moves, self.model.start)
        mean = np.add.reduceat(p, starts, axis=0) / sizes[with_words][:, None]
        best = p.argmax(1)
        cuts = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]) | first)
        lengths = np.diff(np.append(cuts, len(index)))
        owner = np.searchsorted(starts, cuts, side="right") - 1
        spans: list[list[dict]] = [[] for _ in with_words]
        for o, y, n in zip(owner.tolist(), best[cuts].tolist(), lengths.tolist(), strict=True):
            spans[o].append({"lang": names[y], "words": n})
        for k, doc in enumerate(with_words.tolist()):
            y = int(mean[k].argmax())
            out[doc] = (names[y], float(min(1.0, mean[k, y])), spans[k])
        return out


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """A model of all languages, from a bounded sample of labelled rows.

    Of each language the first documents by a hash of ``key`` are taken: SAMPLE_DOCS,
    or fewer where more languages share SAMPLE_ALL, but SAMPLE_LEAST at least.  Of each
    document SAMPLE_WORDS words are taken, in STRETCHES stretches over its whole length.
    """
    labelled = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    order = Window.partitionBy(lang).orderBy("_h", key)
    ranked = labelled.select(key, lang, F.xxhash64(F.col(key).cast("string")).alias("_h")).withColumn("_r", F.row_number().over(order))
    few = ranked.filter(F.col("_r") <= SAMPLE_DOCS).select(key, lang, "_r").collect()
    share = min(SAMPLE_DOCS, max(SAMPLE_LEAST, SAMPLE_ALL // max(1, len({r[lang] for r in few}))))
    chosen = [(r[key], r[lang]) for r in few if r["_r"] <= share]
    if not chosen:
        return Model([], np.zeros(0, np.uint64))
    spark = df.sparkSession
    chosen = spark.createDataFrame(chosen, T.StructType([T.StructField(c, labelled.schema[c].dataType) for c in (key, lang)])).distinct()
    words = words_of(F.col(text))
    width = SAMPLE_WORDS // STRETCHES
    at = lambda w, k: F.floor(k * (F.size(w) - width) / (STRETCHES - 1)).cast("int") + 1
    spread = lambda w: F.when(F.size(w) <= SAMPLE_WORDS, w).otherwise(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), lambda k: F.slice(w, at(w, k), width))))
    found = labelled.join(F.broadcast(chosen), [key, lang], "left_semi").select(key, lang, let(words, spread).alias("words"), F.xxhash64(text).alias("_h"))
    rows = found.groupBy(key, lang).agg(F.min_by("words", "_h").alias("words")).orderBy(key, lang).collect()
    samples = [(r[lang], ws) for r in rows if (ws := [w for x in r["words"] if (w := bare(x))])]
    return learn(samples) if samples else Model([], np.zeros(0, np.uint64))


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (0 to 1) and segments (stretches of lang and words) of each whole text.

    A null text, or one without a letter, is ``und`` with score 0, as is all where the
    model has learned no language.  Repeated rows come out alike.  Columns of ``df``
    that have the names of the new ones are replaced.  An empty table stays empty.
    """
    new = ("lang_pred", "score", "segments")
    rest = df.select(*[c for c in df.columns if c not in new])
    segment = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.IntegerType())]))
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("segments", segment)])
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    arrow = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int32())]))

    def run(batches):
        own = Labeller(pickle.loads(shared.value))
        for b in pieces(batches, text):
            lang, score, spans = zip(*own.label(b.column(text).to_pylist()), strict=True) if b.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, arrow)], [*b.schema.names, *new])

    return rest.mapInArrow(run, schema)


def with_held_out(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Fit on documents outside of the fold 0 of crc32(doc_id), predict all; rows without doc_id are predicted only."""
    fold = F.crc32(F.col("doc_id").cast("string")) % folds
    model = fit(docs.filter(fold != 0))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "segments")
