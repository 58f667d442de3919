"""Problem 9: evaluation passages that occur, fully or partly, exactly or nearly, in a large corpus.

An item is what must be found: WINDOW consecutive words of a passage, or all of a shorter one. Each
item, and each window of its size in the documents, is embedded by several CGK random walks over its
words, which turn edit distance into Hamming distance; each walk is sampled at a few places several
times over, and windows whose samples agree in any of the tables are candidates. Candidates are
verified by a banded edit distance over words: at most a fifth of the item's words may be replaced,
added or missing. From there the whole passage is aligned in a band around the match.

Recall. Equal windows agree in every table by construction, so equal items are found with recall 1.
WALKS x SAMPLES tables of PLACES places find one item at one edit with 0.95 or more and at its limit
of a fifth with 0.9 or more (tests/llm/test_leakage.py measures it); a passage of many items, each
with its own chance, is practically never missed. Before the walk a window is left out only if too
few of its words occur in any passage at all, which loses nothing.

Words enter the walk as skeletons (their ASCII letters and digits), which decoding damage cannot
change; a word with lost characters equals one of the same skeleton, any other must be the same.

Documents are repaired, brought to plain form and cut into words once. The passages are broadcast in
blocks of at most ``BLOCK_WORDS`` words (about 200 bytes a word); each block is set against all
documents, so their number is not limited.

Defined results
  null or empty document or passage -> no rows
  passage without any word          -> no rows
  very long document                -> read whole
  item under five words             -> no edits allowed
  passages listed twice             -> each is reported
  repeated documents                -> each is reported
  empty tables                      -> empty result
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, spread
from .mojibake import LOST, repair
from .plainform import plain_text

WINDOW, TOLERANCE = 10, 5
WALKS, SAMPLES, PLACES, SEED = 8, 2, 3, 20_260
BLOCK_WORDS = 250_000
#: Windows embedded at once (they stay in the processor's cache), and candidates verified at once.
CHUNK, SLICE = 1 << 15, 1 << 19
#: Stands for a lost character inside a word; a letter no text here uses.
LOST_LETTER = "ƿ"

_INLINE = re.compile(r"</?(?:b|i|u|em|strong|span|font)\b[^<>]*>", re.I)
_ATTRIBUTE = r"""\s+[\w.:-]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s<>"']+))?"""
_MARKUP = re.compile(rf"<(?:/?[^\W\d_][\w.:-]*(?:{_ATTRIBUTE})*\s*/?|[!?][^<>]*)>")
_ENTITY = re.compile(r"&(?:#\d+|#x[0-9a-fA-F]+|[a-zA-Z]+);")
_CUE = re.compile(r"^[ \t]*\d+[ \t]*\r?\n(?=[ \t]*\d{1,2}:\d{2}:\d{2})", re.M)
_TIME = re.compile(r"\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?")
_WORD = re.compile(r"[^\W_]+")
_NOT_SKELETON = re.compile(r"[^a-z0-9]|i")


def words_of(text: str | None) -> tuple[list[str], bool]:
    """The words of a text as compared, and whether characters of it are lost."""
    if not text:
        return [], False
    text, _, whole = repair(text)
    if not whole:
        text = text.replace(LOST, LOST_LETTER)
    text = plain_text(text)
    if "<" in text:
        text = _MARKUP.sub(" ", _INLINE.sub("", text))
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    if ":" in text:
        text = _TIME.sub(" ", _CUE.sub("", text))
    text = text.replace("'", "").replace("’", "").replace("İ", "i").replace("I", "ı")
    return _WORD.findall(text.lower()), not whole


@lru_cache(maxsize=1 << 18)
def _hashes(word: str) -> tuple[int, int]:
    import xxhash

    return xxhash.xxh3_64_intdigest(word), xxhash.xxh3_64_intdigest(_NOT_SKELETON.sub("", word), 7)


class Encoded:
    """Texts as word hashes in a row, each text followed by ``WINDOW`` empty places."""

    def __init__(self, texts: list[list[str]]):
        flat: list[str] = []
        pad = [""] * WINDOW
        self.starts = np.zeros(len(texts) + 1, np.int64)
        for i, t in enumerate(texts):
            flat += t
            flat += pad
            self.starts[i + 1] = len(flat)
        coded = pa.array(flat, pa.string()).dictionary_encode()
        terms = coded.dictionary.to_pylist()
        both = np.array([_hashes(w) if w else (0, 0) for w in terms], np.uint64).reshape(-1, 2)
        self.at = np.asarray(coded.indices)
        self.terms_hash, self.terms_skeleton = both[:, 0], both[:, 1]
        self.terms_lost = np.array([LOST_LETTER in w for w in terms], bool)
        self.hash, self.skeleton = self.terms_hash[self.at], self.terms_skeleton[self.at]
        self.any_lost = bool(self.terms_lost.any())
        self.lost = self.terms_lost[self.at]

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def allowed(n: int) -> int:
    """The word edits allowed in ``n`` words."""
    return n // TOLERANCE


@lru_cache(maxsize=None)
def _samples(length: int) -> np.ndarray:
    """The sampled places [WALKS, SAMPLES, PLACES]: one in each stretch of a walk, so that a sample sees the whole window."""
    rng = np.random.default_rng(SEED + length)
    edges = np.linspace(0, 2 * length, PLACES + 1).astype(int)
    one = lambda k: rng.integers(edges[k], max(edges[k] + 1, edges[k + 1]))
    return np.array([[[one(k) for k in range(PLACES)] for _ in range(SAMPLES)] for _ in range(WALKS)])


def window_keys(skeleton: np.ndarray, first: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(length, keys) per table of the windows that start at ``first``; a key names its table too.

    One walk serves all lengths: a shorter window ends the same walk sooner.
    """
    mul, odd = np.uint64(0xFF51AFD7ED558CCD), np.random.default_rng(SEED).integers(1, 1 << 62, WALKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    one = np.uint64(1)
    for r in range(WALKS):
        places = {n: _samples(n)[r] for n in lengths}
        keys = {(n, t): np.full(len(first), (n << 16 | r << 8 | t) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64) for n in lengths for t in range(SAMPLES)}
        at, i = first.copy(), np.zeros(len(first), np.uint64)
        for j in range(1 + max(int(p.max()) for p in places.values())):
            symbol = skeleton[at]
            for n, p in places.items():
                for t in range(SAMPLES):
                    for _ in range(int((p[t] == j).sum())):
                        h = (keys[n, t] ^ np.where(i < np.uint64(n), symbol, one)) * mul
                        keys[n, t] = h ^ (h >> np.uint64(31))
            # Bit j of this walk's random function of the symbol: stay or move on.
            step = ((symbol * odd[r]) >> np.uint64(40 + j)) & one
            i += step
            at += ((i <= np.uint64(WINDOW)) & (step == one)).astype(np.int64)
        for (n, _), k in keys.items():
            yield n, k


class PassageIndex:
    """All items of the passages by their keys; small enough to travel to every task."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(i, words_of(t)[0]) for i, t in items]
        texts = [(i, w) for i, w in texts if w]
        self.ids = np.array([i for i, _ in texts], np.int64)
        self.counts = np.array([len(w) for _, w in texts], np.int64)
        e = Encoded([w for _, w in texts])
        self.hash, self.skeleton, self.starts = e.hash, e.skeleton, e.starts
        self.vocabulary = np.unique(e.terms_skeleton[e.terms_hash != 0])
        self.lengths = sorted({min(WINDOW, int(n)) for n in self.counts})
        size = np.minimum(self.counts, WINDOW)
        keys, places = [], []
        for n in self.lengths:
            first = np.concatenate([self.starts[k] + np.arange(self.counts[k] - n + 1) for k in np.flatnonzero(size == n)])
            for _, k in window_keys(self.skeleton, first, [n]):
                keys.append(k)
                places.append(first)
        keys, places = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (keys, places))
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order].astype(np.int32)
        self.bits = max(10, int(32 * max(1, len(keys)) - 1).bit_length())
        self.seen = np.zeros(1 << self.bits >> 3, np.uint8)
        low = self._low(self.keys)
        np.bitwise_or.at(self.seen, low >> 3, (1 << (low & 7)).astype(np.uint8))

    def _low(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def _starts_worth_a_walk(self, docs: Encoded) -> dict[int, np.ndarray]:
        """Per item length, the places whose window has enough words of the passages' vocabulary to be within the allowed edits."""
        k = np.minimum(np.searchsorted(self.vocabulary, docs.terms_skeleton), len(self.vocabulary) - 1)
        known = ((self.vocabulary[k] == docs.terms_skeleton) & (docs.terms_hash != 0))[docs.at]
        run = np.concatenate([[0], np.cumsum(known, dtype=np.int32)])
        out = {}
        for n in self.lengths:
            ends = np.minimum(np.arange(len(known)) + n, len(known))
            out[n] = np.flatnonzero((run[ends] - run[:-1] >= n - allowed(n)) & (docs.hash != 0))
        return out

    def candidates(self, docs: Encoded) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, places in the documents, places in the passages) of the windows that meet in a table, each pair once per chunk."""
        worth = self._starts_worth_a_walk(docs)
        skeleton = np.concatenate([docs.skeleton, np.zeros(WINDOW + 1, np.uint64)])
        every = np.unique(np.concatenate([*worth.values()]))
        for a in range(0, len(every), CHUNK):
            first = every[a : a + CHUNK]
            wanted = {n: np.isin(first, w[np.searchsorted(w, first[0]) : np.searchsorted(w, first[-1], "right")], assume_unique=True) for n, w in worth.items()}
            met: dict[int, list[np.ndarray]] = {n: [] for n in self.lengths}
            for n, keys in window_keys(skeleton, first, [n for n in self.lengths if wanted[n].any()]):
                low = self._low(keys)
                maybe = np.flatnonzero(((self.seen[low >> 3] >> (low & 7).astype(np.uint8)) & 1).astype(bool) & wanted[n])
                lo, hi = np.searchsorted(self.keys, keys[maybe], "left"), np.searchsorted(self.keys, keys[maybe], "right")
                times = hi - lo
                ends = np.cumsum(times)
                # Heavy keys are expanded a slice at a time.
                for s in range(0, int(ends[-1]) if len(ends) else 0, SLICE):
                    at = np.arange(s, min(s + SLICE, int(ends[-1])))
                    w = np.searchsorted(ends, at, "right")
                    met[n].append(np.unique(first[maybe[w]] << 32 | self.places[lo[w] + at - (ends[w] - times[w])]))
            for n, pairs in met.items():
                if pairs:
                    pair = np.unique(np.concatenate(pairs))
                    for s in range(0, len(pair), SLICE):
                        yield n, pair[s : s + SLICE] >> 32, pair[s : s + SLICE] & 0xFFFFFFFF

    def search(self, texts: list[list[str]]) -> list[tuple[int, int, int, int, int | None]]:
        """(text, passage, edits, words, whole): the fewest edits of an item found, the passage's words in found items, and the
        edits of the whole passage where they are within its allowance."""
        if not self.lengths:
            return []
        docs = Encoded(texts)
        rows: list[np.ndarray] = []
        for n, p, q in self.candidates(docs):
            text = docs.text_of(p)
            edits = self._edits(docs, text, p, q, n, allowed(n))
            good = np.flatnonzero(edits <= allowed(n))
            rows.append(np.stack([text[good], np.searchsorted(self.starts, q[good], "right") - 1, edits[good], p[good], q[good]]))
        if not rows:
            return []
        text, item, edits, p, q = np.concatenate(rows, axis=1)
        whole = self._whole(docs, text, item, p, q)
        order = np.lexsort((q, item, text))
        out = []
        pair = text * len(self.ids) + item
        for group in np.split(order, np.flatnonzero(np.diff(pair[order])) + 1) if len(order) else []:
            o = int(item[group[0]])
            n = min(WINDOW, int(self.counts[o]))
            # The passage's words that lie in a found item: items come in order, so overlaps are with the one before.
            words = n + int(np.minimum(np.diff(q[group]), n).sum())
            out.append((int(text[group[0]]), o, int(edits[group].min()), words, whole.get((int(text[group[0]]), o))))
        return out

    def _edits(self, docs: Encoded, text: np.ndarray, p: np.ndarray, q: np.ndarray, n: int, band: int) -> np.ndarray:
        """The word edits between the ``n`` passage words at q and the best stretch of the document around p; more than ``band`` count as band + 1.

        Banded dynamic programming over all pairs at once, with a free start and a free end. A place outside the
        document equals nothing, so a stretch never gains by leaving it.
        """
        width, far = 2 * band + 1, band + 1
        shift = np.arange(width) - band
        row = np.zeros((len(p), width), np.int16)
        out = np.full(len(p), far, np.int16)
        left, lo, hi = np.arange(len(p)), docs.starts[text][:, None], docs.starts[text + 1][:, None]
        for i in range(n):
            at = p[:, None] + (i + shift)[None]
            inside = (at >= lo) & (at < hi)
            at = np.where(inside, at, lo)
            same = docs.hash[at] == self.hash[q + i][:, None]
            if docs.any_lost:
                same |= docs.lost[at] & (docs.skeleton[at] == self.skeleton[q + i][:, None])
            new = row + (~(same & inside)).astype(np.int16)
            np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
            for d in range(1, width):
                np.minimum(new[:, d], new[:, d - 1] + 1, out=new[:, d])
            row = new
            if i == n // 2:  # most candidates are beyond the band by now
                kept = row.min(1) <= band
                row, p, q, left, lo, hi = row[kept], p[kept], q[kept], left[kept], lo[kept], hi[kept]
        out[left] = np.minimum(row.min(1, initial=far), far)
        return out

    def _whole(self, docs: Encoded, text, item, p, q) -> dict[tuple[int, int], int]:
        """The fewest edits of whole passages whose items were found, aligned where the items lie."""
        at = p - (q - self.starts[item])
        seeds = np.unique(np.stack([item, at, text]), axis=1)
        best: dict[tuple[int, int], int] = {}
        size = self.counts[seeds[0]]
        for n in np.unique(size):
            chosen = seeds[:, size == n]
            band = allowed(int(n))
            for s in range(0, chosen.shape[1], max(1, SLICE // (2 * band + 1))):
                i, a, x = chosen[:, s : s + max(1, SLICE // (2 * band + 1))]
                edits = self._edits(docs, x, a, self.starts[i], int(n), band)
                for k in np.flatnonzero(edits <= band):
                    key = int(x[k]), int(i[k])
                    best[key] = min(best.get(key, 1 << 30), int(edits[k]))
        return best


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            part = batch.slice(a, 1000)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([" ".join(words_of(t)[0]) for t in part.column(1).to_pylist()], pa.string())], names=["doc_id", "words"])


_FOUND = "item_id bigint, edits int, words int, whole_edits int"


def near_passages(documents: DataFrame, passages: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, edits, words, whole_edits) of every document with a stretch within a fifth of edits of an item.

    ``edits`` are those of the best item, ``words`` the passage's words in found items, ``whole_edits`` the edits of
    the whole passage if at most a fifth of its words, else null.
    """
    spark = documents.sparkSession
    items = passages.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL AND item_id IS NOT NULL")
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, -(-size // block_words))
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL AND doc_id IS NOT NULL")
    kind = docs.schema["doc_id"].dataType.simpleString()
    many = blocks > 1
    if many:  # tokenised once, read by every block
        docs = cut(docs.mapInArrow(_tokenised, f"doc_id {kind}, words string"))
    result = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        index = spark.sparkContext.broadcast(PassageIndex([(r["item_id"], r["text"]) for r in rows]))

        def match(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 1000):
                    part = batch.slice(a, 1000)
                    texts = part.column(1).to_pylist()
                    found = index.value.search([t.split(" ") if t else [] for t in texts] if many else [words_of(t)[0] for t in texts])
                    at, item, edits, words, whole = zip(*found) if found else ((), (), (), (), ())
                    ids = pa.array([int(index.value.ids[o]) for o in item], pa.int64())
                    counts = [pa.array(x, pa.int32()) for x in (edits, words, whole)]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), ids, *counts], names=["doc_id", "item_id", "edits", "words", "whole_edits"])

        got = docs.mapInArrow(match, f"doc_id {kind}, {_FOUND}")
        result = got if result is None else result.unionAll(got)
    best = [F.min("edits").alias("edits"), F.max("words").alias("words"), F.min("whole_edits").alias("whole_edits")]
    return result.groupBy("doc_id", "item_id").agg(*best)


def leaks(documents: DataFrame, passages: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id) of every document that contains an item unchanged: a passage or WINDOW consecutive words of it."""
    return near_passages(documents, passages, **options).where("edits = 0").select("doc_id", "item_id")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")), spark.read.parquet(f"{sf_dir}/eval_passages.parquet")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(*_tables(spark, sf_dir))


def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage or a part of it, up to a fifth of the words replaced, added or missing."""
    return near_passages(*_tables(spark, sf_dir))


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which test items leaked, and into how many documents."""
    items = spark.read.parquet(f"{sf_dir}/eval_passages.parquet").select("item_id", "split")
    n = p9_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("documents"))
    return items.join(n, "item_id").select("item_id", "split", "documents")
