"""Evaluation texts leaking into training text (problem 7).

Spaced-seed hashing: two masks compare four words each, 1111 and 11..11; the masked windows of the test items are
hashed and every window of every document is joined to them. Cut ``SPAN`` words into six pairs: ``SPAN - LEAST_EQUAL``
substitutions leave at least three pairs whole, so two whole ones lie in the first or in the last three pairs, side by
side (1111) or with one between (11..11). Every passage the verifier accepts therefore has a hit. A hit counts if some
window of ``SPAN`` words around it has ``least_equal`` equal ones. Then the document and the item are laid on top of
each other at the hit's offset and compared word by word, which gives the longest stretch of equal words and the
longest stretch in which every window of ``SPAN`` words has at most ``SPAN - least_equal`` substituted ones.

The items are a bounded table: up to ``ITEMS_AT_ONCE`` items' hashes go to the tasks with the plan; more items are
taken group by group, each in a pass of its own.

Defined results: null and blank texts and items match nothing; items or documents shorter than ``SPAN`` words
match nothing; repeated rows give one pair per document and item; hash collisions are removed by the comparison;
empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionloom.llm.words import plain_words, word_ids

SPAN = 12
#: 1 is compared, 0 ignored; positions after the last 1 need not exist.
MASKS = ("111100000000", "110011000000")
ITEMS_AT_ONCE = 20_000
LEAST_EQUAL = 9
WORDS_AT_ONCE = 200_000
HITS_AT_ONCE = 200_000
PAIR_SCHEMA = "doc_id long, item_id long, exact_words int, tolerant_words int, doc_word int, item_word int"

_ODD = (np.random.default_rng(20240501).integers(1, 2**63, SPAN, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def window_hashes(ids: np.ndarray, mask: str, seed: int) -> np.ndarray:
    """Hash of every window of ids under a mask."""
    mask = mask.rstrip("0")
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, seed * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for j, use in enumerate(mask):
        if use == "1":
            h += ids[j : j + n] * _ODD[j]
    h ^= h >> np.uint64(31)
    return h


def joined(texts: list[np.ndarray], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of many texts with ``SPAN`` times ``gap`` around each, the text of each position (-1: none) and the texts' starts."""
    between, none = np.full(SPAN, gap, np.uint64), np.full(SPAN, -1)
    starts = np.cumsum([SPAN] + [len(t) + SPAN for t in texts])[:-1]
    ids = np.concatenate([between, *[x for t in texts for x in (t, between)]])
    of = np.concatenate([none, *[x for k, t in enumerate(texts) for x in (np.full(len(t), k), none)]])
    return ids, of, starts


class ItemIndex:
    """Masked window hashes of the items, sorted, with the places they come from."""

    def __init__(self, items: list[tuple[int, str | None]]) -> None:
        self.ids = [word_ids(plain_words(t)) for _, t in items]
        self.names = [i for i, _ in items]
        self.words, self.of, self.starts = joined(self.ids, 0)
        self.tables = []
        for m, mask in enumerate(MASKS):
            h = window_hashes(self.words, mask, m + 1)
            at = np.flatnonzero((self.of[: len(h)] >= 0) & (self.of[: len(h)] == self.of[len(self.of) - len(h) :]))
            by = np.argsort(h[at], kind="stable")
            self.tables.append((h[at][by], at[by]))

    def hits(self, docs: list[np.ndarray], least_equal: int = LEAST_EQUAL) -> list[tuple[int, int, int]]:
        """Document number, item number and offset (document position minus item position) of the accepted hits."""
        words, of, starts = joined(docs, 1)
        out: set[tuple[int, int, int]] = set()
        for m, mask in enumerate(MASKS):
            hashes, where = self.tables[m]
            h = window_hashes(words, mask, m + 1)
            a, b = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            at = np.flatnonzero((b > a) & (of[: len(h)] >= 0))
            upto = np.cumsum(b[at] - a[at])
            total = int(upto[-1]) if len(at) else 0
            for lo in range(0, total, HITS_AT_ONCE):
                n = np.arange(lo, min(total, lo + HITS_AT_ONCE))
                r = np.searchsorted(upto, n, "right")
                p, q = at[r], where[b[at[r]] - (upto[r] - n)]
                good = self._near(words, p, q, len(mask.rstrip("0"))) >= least_equal
                d, k = of[p[good]], self.of[q[good]]
                offset = (p[good] - starts[d]) - (q[good] - self.starts[k])
                out.update(zip(d.tolist(), k.tolist(), offset.tolist()))
        return sorted(out)

    def _near(self, words: np.ndarray, p: np.ndarray, q: np.ndarray, length: int) -> np.ndarray:
        """Most equal words in a window of ``SPAN`` words that holds the hit of ``length`` words."""
        same = np.zeros((2 * SPAN - length + 1, len(p)), np.int8)
        for row, step in enumerate(range(length - SPAN, SPAN), 1):
            same[row] = words[p + step] == self.words[q + step]
        sums = same.cumsum(axis=0, dtype=np.int8)
        return (sums[SPAN:] - sums[:-SPAN]).max(axis=0, initial=0)


def compare(doc: np.ndarray, item: np.ndarray, offset: int, least_equal: int = LEAST_EQUAL) -> tuple[int, int, int, int]:
    """Longest equal and tolerant stretch at an offset, and where the former begins in document and item."""
    lo, hi = max(0, offset), min(len(doc), len(item) + offset)
    same = doc[lo:hi] == item[lo - offset : hi - offset]
    exact, at = _longest(same)
    enough = np.convolve(same.astype(int), np.ones(SPAN, int), "valid") >= least_equal if len(same) >= SPAN else np.zeros(0, bool)
    windows, _ = _longest(enough)
    return exact, windows + SPAN - 1 if windows else 0, lo + at, lo + at - offset


def _longest(flags: np.ndarray) -> tuple[int, int]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    if not len(edge):
        return 0, 0
    lengths = edge[1::2] - edge[::2]
    k = int(lengths.argmax())
    return int(lengths[k]), int(edge[2 * k])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Documents and their word ids, about ``WORDS_AT_ONCE`` words at once."""
    docs, ids, n = [], [], 0
    for b in batches:
        for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            docs.append(doc)
            ids.append(word_ids(plain_words(text)))
            n += len(ids[-1])
            if n >= WORDS_AT_ONCE:
                yield docs, ids
                docs, ids, n = [], [], 0
    if docs:
        yield docs, ids


def _search(batches: Iterator[pa.RecordBatch], index: ItemIndex) -> Iterator[pa.RecordBatch]:
    for docs, ids in _groups(batches):
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for d, k, offset in index.hits(ids):
            found = compare(ids[d], index.ids[k], offset)
            if max(found[:2]) >= SPAN:
                best[d, k] = max(best.get((d, k), found), found)
        rows = [(docs[d], index.names[k], *v) for (d, k), v in best.items()]
        names = ("doc_id", "item_id", "exact_words", "tolerant_words", "doc_word", "item_word")
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=list(names))


def leaked_passages(documents: DataFrame, items: DataFrame, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """Documents and items with a common passage of ``SPAN`` words, equal or with few substitutions.

    Columns: ``doc_id, item_id, exact_words, tolerant_words, doc_word, item_word`` (positions of the equal stretch).
    """
    spark = documents.sparkSession
    known = items.where(F.col("item_id").isNotNull() & F.col("item_text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "item_text").distinct()
    n = known.count()
    groups = max(1, -(-n // items_at_once))
    docs = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for g in range(groups):
        part = known if groups == 1 else known.where(F.pmod(F.xxhash64("item_id", "item_text"), F.lit(groups)) == g)
        index = spark.sparkContext.broadcast(ItemIndex(sorted((r[0], r[1]) for r in part.collect())))  # about ITEMS_AT_ONCE items
        found = docs.mapInArrow(lambda it, x=index: _search(it, x.value), PAIR_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("exact_words", "tolerant_words", "doc_word", "item_word")).alias("_m")).select("doc_id", "item_id", "_m.*")
