import re
from collections import defaultdict

import numpy as np

from ratecast.llm import recompression as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length=50):
    """(n_words, n_removed, kept) per row."""
    first = {}
    docs = [(2 ** 63 - 1 if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    for o, _, ws in docs:
        for p in range(len(ws) - length + 1):
            w = tuple(ws[p:p + length])
            first[w] = min(first.get(w, o), o)
    out = []
    for o, i, ws in docs:
        gone = set()
        for p in range(len(ws) - length + 1):
            if first[tuple(ws[p:p + length])] < o:
                gone.update(range(p, p + length))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in R.substring_dedup(df).select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)


def text(rng, n, vocabulary=300):
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))


def collection(rng, vocabulary):
    shared = [text(rng, int(n), vocabulary) for n in rng.integers(40, 140, 6)]
    rows = []
    for i in range(60):
        parts = [text(rng, int(rng.integers(0, 60)), vocabulary)]
        for _ in range(int(rng.integers(0, 3))):
            parts += [shared[int(rng.integers(0, 6))], text(rng, int(rng.integers(0, 30)), vocabulary)]
        rows.append((int(rng.integers(0, 50)) if i % 7 else i, "  ".join(p for p in parts if p)))
    return rows


def test_against_brute_force(docs):
    rng = np.random.default_rng(1)
    rows = collection(rng, 300)
    got = run(docs(rows, clashing=True))
    assert got == brute(rows) and sum(r[2] for r in got) > 500


def test_periodic_texts(docs):
    """Few words: runs and repeats everywhere, symbols that no window holds."""
    rng = np.random.default_rng(2)
    rows = collection(rng, 2) + [(100, "a " * 300), (101, "a " * 120), (102, "b " + "a " * 70 + "c"), (103, "a b " * 90), (104, "x " + "b a " * 60), (105, "a " * 49)]
    assert run(docs(rows)) == brute(rows)


def test_near_copies(docs):
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in rng.integers(0, 500, 400)]
    rows = []
    for i in range(40):
        ws = list(base)
        for p in rng.integers(0, 400, int(rng.integers(0, 12))):
            ws[p] = f"new{rng.integers(0, 3)}"
        rows.append((i, " ".join(ws[int(rng.integers(0, 60)):])))
    assert run(docs(rows)) == brute(rows)


def test_edge_cases(docs):
    rng = np.random.default_rng(4)
    a, b = text(rng, 80), text(rng, 60)
    long = text(rng, 30000)
    rows = [(1, None), (2, ""), (3, a), (None, a), (None, b), (4, b + "\t\n" + a), (5, b), (5, a + " " + b), (3, a), (6, "é x " * 60),
            (7, "é x " * 60), (8, long), (9, "start " + long), (10, text(rng, 49))]
    got = run(docs(rows, clashing=True))
    assert got == brute(rows)
    assert (None, 80, 80, "") in got and (None, 60, 60, "") in got


def test_long_texts_in_pieces(docs, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BYTES", 300)
    monkeypatch.setattr(R, "PIECE_WORDS", 70)
    rng = np.random.default_rng(5)
    rows = collection(rng, 300)
    raw = rows[3][1].encode() * 3
    ws = raw.split()
    whole = [tuple(ws[i:i + 50]) for i in range(len(ws) - 49)]
    assert [w for _, x in R.pieces(raw) for w in (tuple(x.split()[i:i + 50]) for i in range(len(x.split()) - 49))] == whole
    assert run(docs(rows)) == brute(rows)


def test_empty_table(docs):
    assert run(docs([])) == []


def test_anchors_depend_on_the_window_alone():
    """The same window has its anchor at the same place wherever it stands; symbols of high rounds are found."""
    rng = np.random.default_rng(6)
    for vocabulary in (2, 5, 1000):
        window = rng.integers(0, vocabulary, 50)
        places = defaultdict(set)
        for _ in range(200):
            words = np.concatenate((rng.integers(0, vocabulary, rng.integers(0, 40)), window, rng.integers(0, vocabulary, rng.integers(0, 40)))).astype(np.uint64)
            _, at, name, low, high = R.anchors(words * np.uint64(0x9E3779B97F4A7C15), np.zeros(len(words), np.int64), np.array([0, len(words)]))
            here = [i for i in range(len(words) - 49) if (words[i:i + 50] == window).all()]
            places["all"].update((int(at[i] - i), int(name[i]), int(low[i] - i), int(high[i] - i)) for i in here)
        assert len(places["all"]) == 1


def test_digest_and_spans(docs):
    import hashlib

    a = " ".join(f"w{i}" for i in range(60))
    rows = {r.doc_id: r for r in R.substring_dedup(docs([(1, a), (2, "x " + a + "\ny")]), digest=True).collect()}
    assert rows[2].kept == hashlib.sha256(b"x y").hexdigest() and [tuple(s) for s in rows[2].spans] == [(1, 61)]
    assert rows[1].n_removed == 0
