import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stayvalue.llm import anchors, substrings


def plain(rows):
    """(doc_id, n_bytes, n_removed, n_spans, hash) by counting all 200-byte strings."""
    data = [(i, (text or "").encode()) for i, text in rows]
    counts = Counter(t[k : k + 200] for _, t in data for k in range(len(t) - 199))
    out = []
    for i, t in data:
        gone = [False] * len(t)
        for k in range(len(t) - 199):
            if counts[t[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def awkward(rng):
    """Copies, shared passages just below, at and above 200 bytes, periodic and constant texts."""
    def words(n):
        return " ".join("".join(rng.choices("abcdef", k=rng.randrange(1, 7))) for _ in range(n))

    passage = (words(200) + "x" * 400)[:700]
    texts = [words(150), words(90), "a" * 900, "a" * 350, "abc" * 200, "abc" * 300, "é" * 300]
    texts += [texts[0]] * 3 + [texts[1] + words(20)] * 2 + [texts[1][5:] + words(5)]
    for size in (150, 199, 200, 201, 260, 400, 700):
        at = rng.randrange(0, len(passage) - size + 1)
        texts.append(words(rng.randrange(0, 60)) + passage[at : at + size] + words(rng.randrange(0, 60)))
    line = ("shared line " * 9)[:100]
    texts += [words(30) + "\n" + line + "\n" + words(30) for _ in range(12)]
    texts += ["", None, "short", words(300) + texts[0][:250] + words(10) + texts[0][100:330]]
    return texts


@pytest.mark.parametrize(("limit", "pairs"), [(20_000, 12), (20_000, 1), (1, 12)])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_counting(spark, documents, monkeypatch, seed, limit, pairs):
    texts = awkward(random.Random(seed))
    monkeypatch.setattr(anchors, "CHUNK", 300)
    monkeypatch.setattr(substrings, "PAIR_LIMIT", pairs)
    docs = documents(texts)
    found = substrings.remove_repeats(docs, limit)
    kept = {r.doc_id: r for r in found.collect()}
    expected = plain(list(enumerate(texts)))
    rows = [
        (i, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
        for i, r in kept.items()
    ]
    assert sorted(rows, key=repr) == expected


def test_numbering_equals_comparing():
    rng = random.Random(5)
    for _ in range(30):
        tuples = []
        for run in range(30):
            near, far = sorted((rng.randrange(0, 137), rng.randrange(0, 137)))
            right = bytes(rng.choices(b"ab", [30, 1], k=200 - near))
            left = bytes(rng.choices(b"ab", [30, 1], k=far))
            tuples.append((1, run, right, left, near, far))
        tuples.sort(key=lambda t: t[2])
        assert list(substrings.repeated_starts(tuples)) == list(
            substrings.repeated_starts_of_many(tuples)
        )


def test_report_of_the_table(spark, read):
    docs = read("documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(substrings.report(docs)) == plain(rows)


def test_equal_stretches_have_equal_anchors():
    rng = random.Random(3)
    text = bytes(rng.choices(b"abcd", k=3000)) + b"ab" * 500
    where = {}
    for gram, place, first, last in anchors.anchors(text):
        for g, p, a, b in zip(gram, place, first, last, strict=True):
            for start in range(a, b + 1):
                assert start <= p <= start + 200 - anchors.GRAM
                where.setdefault(text[start : start + 200], set()).add((int(g), int(p - start)))
    assert sum(map(len, where.values())) == len(where)
    assert len(where) < len(text) - 199


def test_gram_hashes_depend_on_the_gram_alone():
    data = np.frombuffer(b"x" * 50 + bytes(range(100)) + b"yy" + bytes(range(100)), dtype=np.uint8)
    hashes = anchors.gram_hashes(data)
    assert hashes[50] == hashes[152] and hashes[60] == hashes[162]
    assert len(set(hashes.tolist())) > 150


def test_odd_rows(spark, documents):
    long = "".join(random.Random(4).choices("abcdefgh", k=260))
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, long[30:]), (None, "z" * 210), (3, "z" * 190)]
    docs = documents([(i, t, "en", "a", 1) for i, t in rows]).withColumnRenamed("lang", "spans")
    assert result(substrings.report(docs)) == plain(rows)
    assert substrings.report(docs.limit(0)).collect() == []
