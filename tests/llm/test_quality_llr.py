import random

from hypothesis import given
from hypothesis import strategies as st

from stayvalue.llm import quality_llr


def plain_base(text):
    """The base figures, word for word as their definition has them."""
    words, word = [], ""
    for c in text + " ":
        if c == " " or "\t" <= c <= "\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    repeated = set()
    for i in range(len(words) - 2):
        for j in range(len(words) - 2):
            if i != j and words[i : i + 3] == words[j : j + 3]:
                repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if any(not (c == " " or "\t" <= c <= "\r") for c in x)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )


@given(st.text(alphabet="ab \n\t#|é\x0b ", max_size=120))
def test_base_rules(text):
    assert quality_llr.base_rules(text.encode()) == plain_base(text)


def test_ngrams_do_not_depend_on_chunks(monkeypatch):
    text = random.Random(1).randbytes(5000)
    whole = [b for part in quality_llr.ngram_buckets(text) for b in part]
    monkeypatch.setattr(quality_llr, "CHUNK", 64)
    assert [b for part in quality_llr.ngram_buckets(text) for b in part] == whole
    assert len(whole) == 5000 - quality_llr.NGRAM + 1


def test_threshold_parts_good_from_bad():
    limit = quality_llr.best_threshold({10: 5, 11: 3}, {1: 4, 2: 4})
    assert 3 * quality_llr.CELL <= limit <= 10 * quality_llr.CELL
    assert quality_llr.best_threshold({}, {1: 2}) == -float("inf")
    assert quality_llr.best_threshold({1: 2}, {}) == -float("inf")


def test_verdicts_follow_the_labels(spark, read):
    docs, labels = read("documents"), read("labels")
    judged = quality_llr.judge(docs, labels).join(labels, "doc_id").filter("not base_failed")
    wrong = judged.filter("kept <> (quality = 1)").count()
    assert judged.count() > 50
    assert wrong <= 0.02 * judged.count()


def test_same_result_for_any_layout(spark, read):
    docs, labels = read("documents"), read("labels")
    one = quality_llr.judge(docs.coalesce(1), labels).orderBy("doc_id").collect()
    many = quality_llr.judge(docs.repartition(7), labels).orderBy("doc_id").collect()
    assert one == many


def test_large_label_tables_are_joined_alike(spark, read, monkeypatch):
    docs, labels = read("documents"), read("labels")
    small = quality_llr.judge(docs, labels).orderBy("doc_id").collect()
    monkeypatch.setattr(quality_llr, "BROADCAST_IDS", 0)
    assert quality_llr.judge(docs, labels).orderBy("doc_id").collect() == small


def test_odd_rows(spark, documents):
    words = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, None, None, None, None), (2, "", "en", "a", 0), (3, words, "en", "a", 1)] * 2
                     + [(None, words, "en", "a", 1)])
    labels = spark.createDataFrame([(3, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = quality_llr.judge(docs, labels).collect()
    assert len(rows) == 7
    assert {(r.doc_id, r.n_words, r.kept) for r in rows} == {
        (1, 0, False), (2, 0, False), (3, 60, True), (None, 60, True),
    }
    assert quality_llr.judge(docs.limit(0), labels.limit(0)).collect() == []
