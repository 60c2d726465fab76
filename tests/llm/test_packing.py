import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from stayvalue.llm import packing


def one_by_one(lengths, sizes, overhead):
    """Best fit, piece by piece: contents and final size of every bin."""
    bins = []
    known = sorted(set(lengths))
    for length in sorted(lengths, reverse=True):
        rooms = [(size - used, i) for i, (size, used) in enumerate(bins) if size - used >= length]
        if rooms:
            i = min(rooms)[1]
            bins[i] = (bins[i][0], bins[i][1] + length)
        else:
            shorter = [n for n in known if n <= length]
            bins.append((packing._size_to_open(length, shorter, sorted(sizes), overhead), length))
    return Counter((used, min(s for s in sizes if s >= used)) for _, used in bins)


@settings(max_examples=200)
@given(st.lists(st.integers(1, 40), max_size=40), st.sampled_from([(40,), (10, 40), (8, 20, 40)]))
def test_runs_equal_best_fit_piece_by_piece(lengths, sizes):
    runs = packing.plan_runs(Counter(lengths).items(), sizes, 2)
    bins, ranks = {}, Counter()
    for length, rank, n, first, offset, final in runs:
        ranks[length] += n
        for i in range(n):
            bins.setdefault((first + i, final), []).append((offset, length))
    assert ranks == Counter(lengths)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    found = Counter((sum(n for _, n in parts), key[1]) for key, parts in bins.items())
    assert len({number for number, _ in bins}) == len(bins)
    assert found == one_by_one(lengths, sizes, 2)


def test_ranks_of_a_length_do_not_overlap():
    rng = random.Random(1)
    lengths = [rng.choice([3, 5, 5, 5, 9]) for _ in range(500)]
    taken = {}
    for length, rank, n, *_ in packing.plan_runs(Counter(lengths).items(), (16, 32), 1):
        for r in range(rank, rank + n):
            assert (length, r) not in taken
            taken[length, r] = True
    assert len(taken) == 500


def check_places(rows, tokens, lengths):
    bins = {}
    seen = Counter()
    for r in rows:
        assert r.piece_start == r.piece * max(lengths)
        seen[r.doc_id] += r.piece_length
        bins.setdefault((r.bin_id, r.bin_length), []).append((r.bin_offset, r.piece_length))
    assert seen == Counter({i: n for i, n in tokens.items() if n > 0})
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), parts in bins.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert size == min(n for n in lengths if n >= at)


def test_every_token_has_one_place(spark, read):
    docs = read("documents")
    tokens = {r.doc_id: len(r.text.encode().split()) for r in docs.collect()}
    rows = packing.pack_documents(docs, shard_pieces=3).collect()
    check_places(rows, tokens, packing.LENGTHS)


def test_hot_length_is_sharded(spark):
    docs = spark.range(600).selectExpr("id as doc_id", "if(id < 500, 7, id % 40) as tokens")
    rows = packing.pack(docs, lengths=(16, 32), shard_pieces=50).collect()
    check_places(rows, {r.doc_id: r.tokens for r in docs.collect()}, (16, 32))


def test_odd_rows(spark, documents):
    docs = documents([None, "", " ", "a b", "x " * 9000]).withColumnRenamed("source", "tokens")
    docs = docs.unionAll(docs.filter("doc_id = 3"))
    rows = packing.pack_documents(docs).collect()
    assert Counter(r.doc_id for r in rows) == {3: 2, 4: 3}
    assert len({(r.bin_id, r.bin_offset) for r in rows}) == 5
    assert packing.pack_documents(docs.limit(0)).collect() == []
