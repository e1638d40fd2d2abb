"""Benchmark decontamination: BM25 over an inverted index of test items with block-max pruning, then overlap.

Test items are the index, passages of training documents the queries. A term's
BM25 weight in an item is divided by the item's total, so a score is the share
of the item's weight that a passage covers and one threshold fits all items.
Items lie in blocks; a term's postings carry its largest weight per list and per
block. A passage is dropped if its terms' list bounds do not reach the threshold,
and then in each block where the block bounds do not (the pivot test of WAND,
made for many passages at once); what is left is scored in full. All items
above the threshold are kept, there is no top k. A hit is verified by how much
of the item's question and of its answer the passage holds, in word trigrams; an
item with a part of less than three words must lie in it as a whole, word by word.
Characters of scripts without spaces are words.

Passages are as wide as two longest items and overlap by half, so every item
copied whole into a document lies whole in one of its passages.

The index of a slice of items is sent to all tasks. Its size is bounded: items
are divided into as many slices as SLICE_BYTES asks for, documents are read
once per slice, and term statistics are those of all items at every number of
slices. Documents never move.

Defined cases: null or empty texts have no passages, null or empty items are in
no hit; equal items are separate items; equal (doc_id, text) rows give one
row; extra columns are not read; without items or documents there are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecast.llm.bytes_hash import Substrings, blocks, lowered, mix, runs
from ratecast.llm.common import keyed, released
from ratecast.llm.toxicity import WORD

K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
SLICE_BYTES = 16 << 20
GRAM = 3


@dataclass(frozen=True)
class Settings:
    """``score``: share of an item's BM25 weight a passage must cover; ``question``, ``answer``: shares of their
    trigrams it must hold; or else it must hold the whole item in a row with at most ``edits`` words changed."""

    score: float = 0.6
    question: float = 0.7
    answer: float = 0.7
    edits: int = 0


def unspaced(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, bytes) of the characters of scripts written without spaces (Han, kana, Thai, Lao, Tibetan, Burmese,
    Khmer): each is a word."""
    if not len(low) or low.max() < 0xE0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    after = np.append(low[1:], np.uint8(0))
    three = ((low >= 0xE3) & (low <= 0xE9) | (low == 0xEF) & (after >= 0xA4) & (after <= 0xAB) | (low == 0xE0) & (after >= 0xB8)
             | (low == 0xE1) & ((after <= 0x82) | (after >= 0x9E) & (after <= 0x9F)))
    four = (low == 0xF0) & (after >= 0xA0)
    at = np.flatnonzero(three | four)
    return at, np.where(four[at], 4, 3)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every word of a block of texts, in order."""
    low = lowered(data)
    inside = WORD[low]
    start, end = runs(inside)
    at, size = unspaced(low)
    if len(at):
        begins = np.zeros(len(low) + 4, bool)
        begins[start] = begins[at] = begins[at + size] = True
        run_end, start = end, np.flatnonzero(begins[:len(low)] & inside)
        end = np.minimum(run_end[np.searchsorted(run_end, start, "right")], np.append(start[1:], len(low)))
    return np.searchsorted(offsets, start, "right") - 1, Substrings(low)(start, end)


def word_lists(texts: list[str | None]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, data, offsets in blocks((t or "").encode() for t in texts):
        owner, h = words_of(data, offsets)
        out += np.split(h, np.searchsorted(owner, np.arange(1, len(offsets) - 1)))
    return out


def grams(words: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Hashes of the n-grams of a word list (of all of it, if shorter)."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        h = mix(h + words[k:len(words) - n + 1 + k])
    return np.unique(h)


def answer_words(text: str, n_words: int) -> int:
    """How many of an item's last words are its answer: the last sentence if there are two, else the last third."""
    parts = [p for p in re.split(r"(?<=[.?!:])\s+|\n+", text.strip()) if re.search(r"\w", p)]
    last = len(word_lists([parts[-1]])[0]) if len(parts) > 1 else 0
    return last if GRAM <= last <= n_words // 2 else -(-n_words // 3)


@dataclass(frozen=True)
class Index:
    """Postings of a slice: sorted terms, and per term its items and weights, and its blocks and their bounds."""

    ids: list
    terms: np.ndarray
    top: np.ndarray
    item_at: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    block_at: np.ndarray
    block: np.ndarray
    bound: np.ndarray
    questions: list
    answers: list
    words: list
    short: list
    heaviest: np.ndarray
    width: int


def build(ids: list, texts: list[str], df: dict[int, int], n_items: int, mean_words: float, longest: int) -> Index:
    """Index of a slice's items; df, n_items, mean_words and longest are those of all items."""
    lists = word_lists(texts)
    term, item, weight = [], [], []
    for i, words in enumerate(lists):
        t, tf = np.unique(words, return_counts=True)
        idf = np.array([np.log(1 + (n_items - df[int(x)] + 0.5) / (df[int(x)] + 0.5)) for x in t])
        w = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
        term.append(t)
        item.append(np.full(len(t), i))
        weight.append(w / w.sum() if len(t) else w)
    term, item, weight = np.concatenate(term), np.concatenate(item), np.concatenate(weight)
    order = np.lexsort((item, term))
    term, item, weight = term[order], item[order], weight[order]
    terms, at = np.unique(term, return_index=True)
    key, first = np.unique(np.stack([np.searchsorted(terms, term), item // BLOCK_ITEMS]), axis=1, return_index=True)
    bound = np.maximum.reduceat(weight, np.sort(first)) if len(first) else weight
    questions, answers, short = [], [], []
    for t, words in zip(texts, lists):
        n = answer_words(t, len(words))
        questions.append(grams(words[:len(words) - n]))
        answers.append(grams(words[len(words) - n:]))
        short.append(min(n, len(words) - n) < GRAM)
    heaviest = np.zeros(len(lists))
    np.maximum.at(heaviest, item, weight)
    return Index(ids, terms, np.maximum.reduceat(weight, at) if len(at) else weight, np.append(at, len(term)), item, weight,
                 np.searchsorted(key[0], np.arange(len(terms) + 1)), key[1], bound, questions, answers, lists, short, heaviest, max(2 * longest, 2 * GRAM))


def _expand(rows: np.ndarray, terms: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (row, term) pairs: the row and the place of each posting of the term."""
    n = at[terms + 1] - at[terms]
    start = np.repeat(at[terms] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return np.repeat(rows, n), start + np.arange(n.sum())


def _edited(held: np.ndarray, mine: np.ndarray, edits: int) -> bool:
    """Whether a passage holds all words in a row but for ``edits`` changed ones."""
    if len(held) < len(mine):
        return False
    equal = np.lib.stride_tricks.sliding_window_view(held, len(mine)) == mine
    return bool(equal.sum(1).max() >= len(mine) - edits)


def search(data: np.ndarray, offsets: np.ndarray, index: Index, s: Settings) -> list[tuple]:
    """(text, item, first word, score, question overlap, answer overlap) of every verified hit of a block of texts."""
    if not len(index.terms):
        return []
    owner, h = words_of(data, offsets)
    first = np.searchsorted(owner, np.arange(len(offsets)))
    place = np.arange(len(h)) - first[owner]
    at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == h)
    # passages of each text begin every half width; a word lies in two, the first half in one
    half = index.width // 2
    n_passages = np.maximum(1, -(-(np.diff(first)) // half) - 1)
    before = np.concatenate(([0], np.cumsum(n_passages)))
    hi = np.minimum(place[known] // half, n_passages[owner[known]] - 1)
    lo = np.maximum(place[known] // half - 1, 0)
    two = lo < hi
    row = before[owner[known]]
    key = np.concatenate(((row + hi) * len(index.terms) + at[known], (row[two] + lo[two]) * len(index.terms) + at[known][two]))
    key = np.unique(key)
    passage, term = key // len(index.terms), key % len(index.terms)
    # an item with changed words may cover less
    need = np.where(index.short, s.score, np.minimum(s.score, 1 - s.edits * index.heaviest - 1e-9)) if s.edits else np.full(len(index.ids), s.score)
    block_need = np.minimum.reduceat(need, np.arange(0, len(need), BLOCK_ITEMS))
    # list bounds
    ok = np.bincount(passage, index.top[term], before[-1]) >= need.min()
    passage, term = passage[ok[passage]], term[ok[passage]]
    # block bounds, some passages at a time
    n_blocks = (len(index.ids) - 1) // BLOCK_ITEMS + 1
    hits = []
    for some in range(0, int(before[-1]), 4096):
        lo, hi = np.searchsorted(passage, [some, some + 4096])
        if lo == hi:
            continue
        p, t = passage[lo:hi], term[lo:hi]
        r, j = _expand(p, t, index.block_at)
        pair, inv = np.unique(r * n_blocks + index.block[j], return_inverse=True)
        alive = pair[np.bincount(inv, index.bound[j]) >= block_need[pair % n_blocks]]
        if not alive.size:
            continue
        left = np.isin(p, alive // n_blocks)
        r, j = _expand(p[left], t[left], index.item_at)
        live = np.isin(r * n_blocks + index.item[j] // BLOCK_ITEMS, alive)
        pair, inv = np.unique(r[live] * len(index.ids) + index.item[j[live]], return_inverse=True)
        score = np.bincount(inv, index.weight[j[live]], len(pair))
        for k in np.flatnonzero(score >= need[pair % len(index.ids)]):
            hits.append((int(pair[k]) // len(index.ids), int(pair[k]) % len(index.ids), float(score[k])))
    out, held, held_of = [], {}, -1
    for p, item, score in hits:
        text = int(np.searchsorted(before, p, "right")) - 1
        begin = int(first[text]) + (p - int(before[text])) * half
        if held_of != p:
            end = int(first[text + 1]) if p + 1 == before[text + 1] else begin + index.width
            held, held_of = {}, p
        mine = index.words[item]
        n = len(mine) if index.short[item] else GRAM
        if n not in held:
            held[n] = grams(h[begin:end], n)
        if index.short[item]:  # a part has no trigram: all words in a row
            q = a = float(np.isin(grams(mine, n), held[n]).all()) if end - begin >= n else 0.0
        else:
            q, a = (float(np.isin(g, held[n]).mean()) for g in (index.questions[item], index.answers[item]))
        if score >= s.score and q >= s.question and a >= s.answer or s.edits and not index.short[item] and _edited(h[begin:end], mine, s.edits):
            out.append((text, item, begin - int(first[text]), score, q, a))
    return out


def _items(items: DataFrame) -> DataFrame:
    return (items.select("item_id", F.col("text").cast("string").alias("text"))
            .where(F.length(F.trim(F.coalesce("text", F.lit("")))) > 0))


HIT = "doc_id long, item_id long, passage long, score double, question_overlap double, answer_overlap double"
KEYED_HIT = f"text_key long, {HIT}"


def contaminated(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document and test item that it holds, with its best passage."""
    best = F.max(F.struct("score", "question_overlap", "answer_overlap", (-F.col("passage")).alias("p"))).alias("m")
    return hits_of(docs, items, settings, slice_bytes).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("m.p")).alias("passage"), "m.score", "m.question_overlap", "m.answer_overlap")


def hits_of(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``text_key`` of the row (as in ``common.keyed``) and the columns of HIT for every hit."""
    items = _items(items)

    def term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words in word_lists(b.column("text").to_pylist()):
                t = np.unique(words).view(np.int64)
                first = (np.arange(len(t)) == 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.full(len(t), len(words))), pa.array(first)],
                                                 names=["term", "words", "first"])

    counts = items.mapInArrow(term_counts, "term long, words long, first long")
    size = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    total, words, longest = counts.agg(F.sum("first"), F.sum(F.col("words") * F.col("first")), F.max("words")).first()
    if not total:
        return docs.sparkSession.createDataFrame([], KEYED_HIT)
    df = counts.groupBy("term").agg(F.count("*").cast("int").alias("df"))
    slices = -(-int(size[0]) // slice_bytes)
    d = keyed(docs).select("text_key", "doc_id", "text")
    found = None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        rows = part.collect()  # at most about slice_bytes
        if not rows:
            continue
        if slices == 1:
            mine = df.collect()
        else:
            mine = part.mapInArrow(term_counts, "term long, words long, first long").select("term").distinct().join(df, "term").collect()
        index = build([r["item_id"] for r in rows], [r["text"] for r in rows],
                      {r["term"] % 2 ** 64: r["df"] for r in mine}, total, words / total, longest)
        hits = d.mapInArrow(released(_searcher(index, settings)), KEYED_HIT)
        found = hits if found is None else found.unionByName(hits)
    return found


def _searcher(index: Index, settings: Settings):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = ["text_key", "doc_id", "item_id", "passage", "score", "question_overlap", "answer_overlap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = b.column("text_key").to_pylist(), b.column("doc_id").to_pylist()
            rows = []
            for base, data, offsets in blocks((t or "").encode() for t in b.column("text").to_pylist()):
                rows += [(keys[base + text], ids[base + text], index.ids[item], *rest) for text, item, *rest in search(data, offsets, index, settings)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run
