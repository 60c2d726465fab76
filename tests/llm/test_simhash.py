import random

import pytest
import xxhash

from stayvalue.llm import graph, simhash


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def smallest_reachable(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c", "A b  C\td", "x " * 50, "é Ü ß a B c d e"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(2).choices("abcdefgh", k=300))
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200, 200 + i) for i in range(1, 60)]
    loose = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    edges = chain + star + loose + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = smallest_reachable({n for e in edges for n in e}, edges)
    assert {r.node: r.root for r in found} == {n: r for n, r in expected.items() if n != r}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def near(rng, count):
    """Fingerprints in clusters, some linked only through others."""
    out = []
    for _ in range(count):
        fp = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 8)):
            out.append(fp)
            for bit in rng.sample(range(64), rng.randrange(0, 7)):
                fp ^= 1 << bit
    return [fp - (1 << 64) if fp >> 63 else fp for fp in out]


@pytest.mark.parametrize("limit", [simhash.LIST_LIMIT, 1])
def test_links_connect_what_few_bits_connect(spark, limit):
    fps = sorted(set(near(random.Random(4), 40)))
    table = spark.createDataFrame([(fp,) for fp in fps], "fp long")
    links = [(r.a, r.b) for r in simhash.links(table, limit).collect()]
    assert all((a ^ b).bit_count() <= 4 or ((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in links)
    pairs = [
        (a, b) for a in fps for b in fps if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4
    ]
    assert smallest_reachable(fps, links) == smallest_reachable(fps, pairs)


def test_groups_against_brute_force(spark, read):
    rows = read("documents").select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    pairs = [
        (a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 4
    ]
    expected = smallest_reachable(fps, pairs)
    found = simhash.report(read("documents")).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{fp:016x}" for i, fp in fps.items()}


@pytest.mark.parametrize("limit", [simhash.BROADCAST_KEYS, 0])
def test_deduplication_keeps_one_of_each_group(spark, read, monkeypatch, limit):
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", limit)
    docs = read("documents")
    groups = {r.component_id for r in simhash.group(docs).collect()}
    kept = simhash.deduplicate(docs.unionAll(docs.limit(20)))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(groups)


def test_odd_rows(spark, documents):
    docs = documents([(1, None, None, None, None), (2, "", "en", "a", 0), (3, "a b", "en", "a", 3),
                      (3, "a b", "en", "a", 3), (None, "a b", "en", "a", 3), (None, "z", "en", "a", 1)])
    docs = docs.withColumnRenamed("source", "component_id").withColumnRenamed("lang", "text_hash")
    rows = simhash.group(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [
        (-1, -1), (-1, 3), (1, 1), (2, 1), (3, 3), (3, 3),
    ]
    kept = simhash.deduplicate(docs)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3]
    assert simhash.group(docs.limit(0)).collect() == []
    assert simhash.deduplicate(docs.limit(0)).collect() == []


def test_one_id_with_texts_of_two_groups(spark, documents):
    docs = documents([(3, "a b c d e", "en", "a", 1), (5, "a b c d e", "en", "a", 1),
                      (5, "quite another text", "en", "a", 1), (5, "quite another text", "en", "a", 1)])
    kept = simhash.deduplicate(docs).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, "a b c d e"), (5, "quite another text")]


def test_groups_of_equal_name_stay_apart(spark, documents):
    """Two NULL ids with different texts, and one id with two unrelated texts: nothing goes."""
    texts = ["first words of one text here", "something else entirely written there",
             "a third thing about boats", "and the last one on mountains"]
    rows = [(i, t, "en", "a", 1) for i, t in zip([None, None, 7, 7], texts, strict=True)]
    kept = simhash.deduplicate(documents(rows + [(9, texts[2], "en", "a", 1)])).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted(
        zip([0, 0, 7, 7], texts, strict=True)
    )
