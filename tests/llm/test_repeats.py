import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecast.llm import repeats
from ratecast.llm.anchors import stretches
from ratecast.llm.bytes_hash import blocks

N = repeats.LENGTH


def brute(rows):
    """First occurrence of every N-byte string, in order of id."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - N + 1):
            s = raw[p:p + N]
            if s in seen:
                gone[p:p + N] = b"\1" * N
            seen.add(s)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def run(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept).hex()) for r in repeats.repeat_dedup(df, digest=True).collect()}


def corpus(rng, n):
    """Random texts with shared passages, edits, copies and periodic runs."""
    passages = ["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(80, 400))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.integers(1, 5)):
            kind = rng.integers(0, 4)
            p = passages[rng.integers(0, len(passages))]
            if kind == 0:
                parts.append("".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(1, 200))))
            elif kind == 1:
                parts.append(p[rng.integers(0, 40):])
            elif kind == 2:
                k = int(rng.integers(0, len(p)))
                parts.append(p[:k] + "é" + p[k:])
            else:
                parts.append("ab" * int(rng.integers(1, 120)))
        rows.append((i, "".join(parts)))
    return rows + [(n + k, rows[int(rng.integers(0, n))][1]) for k in range(5)]


@pytest.mark.parametrize("split", [repeats.SPLIT, 3])
def test_against_brute_force(docs, split, monkeypatch):
    monkeypatch.setattr(repeats, "SPLIT", split)
    rows = corpus(np.random.default_rng(split), 70)
    assert run(docs(rows)) == brute(rows)


def test_edge_cases(docs):
    rng = np.random.default_rng(5)
    s = "".join(chr(97 + x) for x in rng.integers(0, 26, 300))
    rows = [(1, None), (2, ""), (3, s[:99]), (4, s[:100]), (5, s), (None, s), (6, "a" * 5000), (7, "\0" * 250)]
    assert run(docs(rows, clashing=True)) == brute(rows)


def test_repeated_rows_are_one_document(docs):
    s = "".join(chr(97 + x) for x in np.random.default_rng(6).integers(0, 26, 300))
    got = repeats.repeat_dedup(docs([(1, s), (1, s)])).collect()
    assert [r.n_removed for r in got] == [0, 0]


@pytest.mark.parametrize("split", [repeats.SPLIT, 1])
def test_repeated_rows_lose_nothing_to_a_near_copy(docs, split, monkeypatch):
    monkeypatch.setattr(repeats, "SPLIT", split)
    s = "".join(chr(97 + x) for x in np.random.default_rng(9).integers(0, 26, 600))
    edited = s[:300] + "é" + s[300:]
    rows = [(1, s), (1, s), (2, edited)]
    df = docs(rows).repartition(3, F.monotonically_increasing_id())
    got = sorted((r.doc_id, r.n_removed) for r in repeats.repeat_dedup(df).collect())
    assert got == [(1, 0), (1, 0), (2, brute([(1, s), (2, edited)])[2][1])]


def test_empty_table(docs):
    assert run(docs([])) == {}


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(7)
    p = bytes(rng.integers(97, 101, 500).astype(np.uint8))
    found = []
    for text in (b"x" * 31 + p, p + b"yy", b"z" * 700000 + p):
        _, data, offsets = next(blocks([text]))
        t, s, e, a, g = stretches(data, offsets, N, repeats.GRAM)
        at = text.index(p)
        windows = {}
        for s1, e1, a1, g1 in zip(s, e, a, g):
            for w in range(s1, e1 - N + 1):
                windows[w - at] = (a1 - at, g1)
        assert len(windows) == len(text) - N + 1
        found.append([windows[w] for w in range(len(p) - N + 1)])
    assert found[0] == found[1] == found[2]


def maximal_repeats(strings, least):
    """(length, occurrences) of every maximal repeat of at least ``least`` bytes, by trying all substrings."""
    places = {}
    for i, s in enumerate(strings):
        for a in range(len(s)):
            for b in range(a + least, len(s) + 1):
                places.setdefault(s[a:b], []).append((i, a))
    out = set()
    for r, at in places.items():
        if len(at) > 1:
            left = {strings[i][a - 1:a] if a else (i, a) for i, a in at}
            right = {strings[i][a + len(r):a + len(r) + 1] or (i, a) for i, a in at}
            if (len(left) > 1 or any(isinstance(x, tuple) for x in left)) and len(right) > 1:
                out.add((len(r), frozenset(at)))
    return out


def test_stack_scan_finds_all_maximal_repeats(monkeypatch):
    monkeypatch.setattr(repeats, "LENGTH", 3)
    monkeypatch.setattr(repeats, "WIDTH", 24)
    monkeypatch.setattr(repeats, "PART", 7)
    rng = np.random.default_rng(8)
    for _ in range(40):
        strings = list({bytes(rng.integers(97, 99, rng.integers(3, 16)).astype(np.uint8)) for _ in range(5)})
        got = set()
        for which, offset, common in repeats.suffix_arrays(strings, np.zeros(len(strings), int)):
            left = np.array([strings[w][o - 1] if o else -1 for w, o in zip(which, offset)])
            got |= {(n, frozenset(zip(which[a:b + 1].tolist(), offset[a:b + 1].tolist()))) for a, b, n in repeats.scan(common, left, 3)}
        assert got == maximal_repeats(strings, 3)


def test_many_texts_without_an_id_are_kept_apart(docs):
    """Spans go to the text they were found in, however many texts share one id or have none."""
    rng = np.random.default_rng(21)
    letters = np.array(list("abcdefghij klmnop"))
    texts = ["".join(rng.choice(letters, 260)) for _ in range(1500)]
    a, two = texts[0], texts[1][:150] + texts[2]
    rows = [(1, a[:200]), (2, texts[1])] + [(None, t) for t in texts if t != texts[1]] + [(7, two), (7, texts[3][::-1])]
    got = {}
    for r in repeats.repeat_dedup(docs(rows)).collect():
        got.setdefault(r.doc_id, []).append(r.n_removed)
    # texts[2] is first in document 7, so its copy without an id goes whole
    assert sorted(got[None])[-2:] == [200, 260] and sum(got[None]) == 460 and sorted(got[7]) == [0, 150] and got[1] == got[2] == [0]
