from collections import defaultdict

import numpy as np

from ratecast.llm.line_dedup import line_dedup


def brute(rows):
    first, gone = {}, defaultdict(set)
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = (t or "").split("\n")
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if w == ("", "", ""):
                continue
            if first.setdefault(w, (i, p)) != (i, p):
                gone[i].update((p, p + 1, p + 2))
    return {i: ("\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[i]), len(gone[i])) for i, t in rows}


def run(df):
    return {r.doc_id: (r.text, r.n_removed) for r in line_dedup(df).collect()}


def test_against_brute_force(docs):
    rng = np.random.default_rng(1)
    rows = [(i, "\n".join(f"l{x}" for x in rng.integers(0, 4, rng.integers(0, 30)))) for i in range(60)]
    assert run(docs(rows)) == brute(rows)


def test_overlapping_windows_merge_and_first_stays(docs):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny")]
    assert run(docs(rows)) == {1: ("a\nb\nc\nd\ne", 0), 2: ("x\ny", 4)}


def test_edge_cases(docs):
    long = "\n".join(f"line {i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, "a\nb"), (4, "\n\n\n\n"), (5, "\n\n\n\n"), (6, long), (None, "p\nq\nr"), (7, "p\nq\nr")]
    got = run(docs(rows, clashing=True))
    assert got == brute(rows) and got[None] == ("p\nq\nr", 0) and got[7] == ("", 3) and got[5][1] == 0


def test_repeated_rows_are_one_document(docs):
    got = line_dedup(docs([(1, "a\nb\nc"), (1, "a\nb\nc")])).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_empty_table(docs):
    assert line_dedup(docs([])).count() == 0


def test_lines_are_cut_without_python_workers(docs):
    rows = [(1, "a\nb\nc\nd\ne\nf\ng"), (2, "a\nb\nc\nx\ne\nf\ng\ny\na\nb\nc"), (3, "e\nf\ng"), (4, "u\nb\nc\nd\ne\n"), (5, None)]
    df = line_dedup(docs(rows))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in df.collect()} == {
        1: ("a\nb\nc\nd\ne\nf\ng", 7, 0), 2: ("x\ny", 11, 9), 3: ("", 3, 3), 4: ("u\n", 6, 4), 5: ("", 1, 0)}
