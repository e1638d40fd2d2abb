import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ratecast.llm import packing
from tests.llm.conftest import words

ODD = [" a  b", "\n\n x\ty", " ", "", "a <|endoftext|> b", "x \n y", "é ü ß\r\n", "tail\n", " 's it's", "..  \n\n\n z", "a b", "日本 語"]


def ids_of(texts):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array(tok.encode(t or "", add_special_tokens=False).ids, "<u4") for t in texts]


def check(df, rows):
    got = df.collect()
    want = defaultdict(list)
    for (i, _), ids in zip(rows, ids_of([t for _, t in rows])):
        want[i].append(np.append(ids, 2).astype("<u4"))
    sequences = defaultdict(list)
    for r in got:
        assert any(zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for ids in want[r.doc_id])
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(len(x) for xs in want.values() for x in xs)
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at and n > 0
            at += n
        assert at <= packing.CAPACITY
    return got, len(sequences)


def test_encode_equals_the_tokenizer(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(300).collect()
    texts = [r.text for r in rows] + ODD
    assert packing.encode(texts, "byte_bpe_50k") == [a.tobytes() for a in ids_of(texts)]


def test_pack(docs):
    rng = np.random.default_rng(1)
    rows = [(i, words(rng, int(rng.integers(1, 900)))) for i in range(120)]
    got, n = check(packing.pack(docs(rows), "byte_bpe_50k", rows_per_group=20), rows)
    total = sum(r.length for r in got)
    assert n <= 1.03 * total / packing.CAPACITY + 1
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
    for parts in by_doc.values():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert [s for _, s, _ in parts] == np.concatenate(([0], np.cumsum([n for _, _, n in parts])[:-1])).tolist()
        assert all(n == packing.CAPACITY for _, _, n in parts[1:])


def test_edge_cases(docs):
    rows = list(enumerate(ODD)) + [(100, None), (None, "null id"), (7, "again"), (3, "x"), (3, "x"), (101, "word " * 60000)]
    check(packing.pack(docs(rows, clashing=True), "byte_bpe_50k"), rows)


def test_empty_table(docs):
    assert packing.pack(docs([]), "byte_bpe_50k").count() == 0


def test_plan_uses_exact_complements():
    lines = packing.plan({700: 10, 324: 4, 200: 6, 124: 6, 100: 1})
    used = defaultdict(int)
    for one, times in lines:
        assert sum(one) <= 1024
        for n in one:
            used[n] += times
    assert used == {700: 10, 324: 4, 200: 6, 124: 6, 100: 1}
    assert sum(t for one, t in lines if sum(one) == 1024) == 10  # 4 by a single, 6 by a pair
    assert packing.plan({}) == []


def test_plan_fills_by_triples():
    assert packing.plan({1000: 2, 10: 2, 8: 2, 6: 2}) == [([1000, 10, 8, 6], 2)]
