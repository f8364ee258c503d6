"""BPE encoding and decoding with contiguous rank arrays.

A word of up to LONG_WORD bytes is a row of two short arrays: its parts and the
ranks of its adjacent pairs.  The smallest rank of each row is found by a scan,
its boundary is deleted, and the two neighbouring ranks are refreshed.  Rows of
all new words of a batch go through these steps together.  The scan is quadratic
in a word's length, so longer words (a text without spaces) take a heap over
linked parts instead, which gives the same merges.

Vocabulary files are those of the ``tokenizers`` library; their path is a
parameter.  Supported: a BPE model with an end-of-word suffix over byte-level
symbols, NFC, white space and lower-case normalisers, a split pattern, and
special tokens that are matched in the raw text.  Characters that newer versions of
Unicode added may be classed otherwise than by the library's older tables.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces

LONG_WORD = 48
#: Words, and runs without white space, that a worker keeps; beyond it keeps those of the piece at hand.
CACHE = 400_000
NO_RANK = 1 << 30
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# str.split() also splits at four separators that are not white space to the pattern
_SEPARATORS, _WHITE = re.compile(r"[\x1c-\x1f]"), re.compile(f"[{_SPACE}]+")
_SLOTS = 20


def _byte_symbols() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else extra))
        extra += b not in keep
    return out


class Ranks:
    """Ranks of pairs of ids in an open table that numpy looks up."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys = left.astype(np.int64) << 20 | right
        self.keys = np.full(1 << _SLOTS, -1, np.int64)
        self.ranks = np.full(1 << _SLOTS, NO_RANK, np.int32)
        self.probes, slot, todo = 0, self.slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == -1]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.ranks[slot[first]] = keys[first], first
            todo = np.setdiff1d(todo, first, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << _SLOTS) - 1)
            self.probes += 1

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 20 | right
        slot = self.slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NO_RANK)
        todo = np.flatnonzero((found != keys) & (found != -1))
        for k in range(1, self.probes):
            if not len(todo):
                break
            at = (slot[todo] + k) & ((1 << _SLOTS) - 1)
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit & (found != -1)]
        return out


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        names = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        self.special = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = Ranks(np.array([vocab[a] for a, _ in merges]), np.array([vocab[b] for _, b in merges]))
        self.made = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.inner = np.array([vocab[s] for s in _byte_symbols()], np.int32)
        self.last = np.array([vocab[s + suffix] for s in _byte_symbols()], np.int32)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACE}")).findall
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    @staticmethod
    def normalise(text: str) -> str:
        """NFC and lower case; letters are mapped one by one, without the rule for a final sigma."""
        return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def split(self, run: str) -> list[str]:
        """The words of a run of characters without white space."""
        run = self.normalise(run)
        if run.isalpha():
            return [run]
        if run[:-1].isalpha() and run[-1] in ".,":
            return [run[:-1], run[-1]]
        return self.find(run)

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of at most LONG_WORD bytes, which are best alike in length."""
        n = np.array(list(map(len, words)))
        raw = np.frombuffer(b"".join(words), np.uint8)
        rows, width = len(words), int(n.max())
        inside = np.arange(width) < n[:, None]
        parts = np.zeros((rows, width), np.int32)
        parts[inside] = self.inner[raw]
        at_end = np.cumsum(n) - 1
        parts[np.arange(rows), n - 1] = self.last[raw[at_end]]
        ranks = np.full((rows, width), NO_RANK, np.int32)
        if width > 1:
            some = inside[:, 1:]
            ranks[:, :-1][some] = self.rank(parts[:, :-1][some], parts[:, 1:][some])
        live = np.arange(rows)
        while len(live):
            i = ranks[live].argmin(1)
            best = ranks[live, i]
            more = best < NO_RANK
            live, i, best = live[more], i[more], best[more]
            if not len(live):
                break
            parts[live, i] = self.made[best]
            # delete the boundary: what lies behind moves up by one
            source = np.arange(width)[None, :] + (np.arange(width)[None, :] > i[:, None])
            np.minimum(source, width - 1, out=source)
            parts[live] = np.take_along_axis(parts[live], source, 1)
            source = np.arange(width)[None, :] + (np.arange(width)[None, :] >= i[:, None])
            np.minimum(source, width - 1, out=source)
            moved = np.take_along_axis(ranks[live], source, 1)
            moved[:, -1] = NO_RANK
            ranks[live] = moved
            n[live] -= 1
            for left, ok in ((i - 1, i > 0), (i, i < n[live] - 1)):
                row, col = live[ok], left[ok]
                ranks[row, col] = self.rank(parts[row, col], parts[row, col + 1])
        ends = np.cumsum(n) * 4
        data = parts[np.arange(width) < n[:, None]].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge_long(self, word: bytes) -> bytes:
        raw = np.frombuffer(word, np.uint8)
        start = self.inner[raw]
        start[-1] = self.last[raw[-1]]
        parts, n = start.tolist(), len(raw)
        ranks = self.rank(start[:-1], start[1:]).tolist()
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(ranks) if r < NO_RANK]
        heapq.heapify(heap)

        def add(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                r = int(self.rank(np.array([parts[i]]), np.array([parts[j]]))[0])
                if r < NO_RANK:
                    heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.made[rank]), -1
            right[i] = k = right[j]
            right[j] = -1
            if k >= 0:
                left[k] = i
            add(i, k)
            add(left[i], i)
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encode words; the short ones also go to the cache."""
        out, short = {}, []
        for w in words:
            data = w.encode("utf-8", "surrogatepass")
            if len(data) > LONG_WORD:
                out[w] = self.merge_long(data)
            else:
                short.append((len(data), w, data))
        short.sort()
        for k in range(0, len(short), 8192):
            part = short[k : k + 8192]
            for (_, w, _), ids in zip(part, self.merge_rows([d for _, _, d in part]), strict=True):
                out[w] = self.words[w] = ids
        return out

    def encode(self, texts: list[str | None], special: bool = True) -> list[bytes]:
        """Ids of whole texts as little-endian 32-bit integers.

        ``special``: strings of special tokens in a text become their ids, else they are ordinary text.
        """
        plain: list[list[str]] = []
        shape: list[list[int | bytes]] = []
        for t in texts:
            parts: list[int | bytes] = []
            marked = special and t and self.split_special and any(s in t for s in self.special)
            for k, x in enumerate(self.split_special.split(t) if marked else [t or ""]):
                if k % 2:
                    parts.append(self.special[x])
                else:
                    parts.append(len(plain))
                    plain.append(x.split() if not _SEPARATORS.search(x) else [r for r in _WHITE.split(x) if r])
            shape.append(parts)
        used = set().union(*plain)
        if len(self.runs) > CACHE:
            self.runs = {r: self.runs[r] for r in used if r in self.runs}
        if len(self.words) > CACHE:
            self.words = {}
        fresh = {r: self.split(r) for r in used.difference(self.runs)}
        new = {w for ws in fresh.values() for w in ws}.difference(self.words)
        long = self.learn(new)
        words = self.words
        for r, ws in fresh.items():
            self.runs[r] = b"".join([words.get(w) or long[w] for w in ws])
        get = self.runs.__getitem__
        done = [b"".join(map(get, p)) for p in plain]
        for r in [r for r in fresh if len(r) > 2 * LONG_WORD]:
            del self.runs[r]
        return [b"".join([done[p] if isinstance(p, int) else p for p in parts]) for parts in shape]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Vocabulary strings joined by a space, as these files name no decoder."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.names.take(ids.values)), " ")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def id_lists(data: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(x) // 4 for x in data)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(data), "<i4")))


def encode_decode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the columns ``ids`` (array<int>) and ``decoded`` (string) for each whole text.

    One pass, no shuffle.  A null or empty text has no ids and decodes to the empty
    string.  Repeated rows are kept as they are.  Columns of ``df`` that have the
    names of the new ones are replaced.  An empty table stays empty.
    """
    rest = df.select(*[c for c in df.columns if c not in (ids, decoded)])
    schema = T.StructType([*rest.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])

    def run(batches):
        own = codec(vocabulary)
        for b in pieces(batches, text):
            lists = id_lists(own.encode(b.column(text).to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists, own.decode(lists)], [*b.schema.names, ids, decoded])

    return rest.mapInArrow(run, schema)


def digests(df: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of documents."""
    out = encode_decode(df.select("doc_id", "text"), vocabulary)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
