import random

import numpy as np

from stayvalue.llm import langid


def plain_viterbi(scores, penalty):
    paths = [([k], s) for k, s in enumerate(scores[0])]
    for row in scores[1:]:
        paths = [
            max(
                ((p + [k], s - (penalty if p[-1] != k else 0) + row[k]) for p, s in paths),
                key=lambda x: x[1],
            )
            for k in range(len(row))
        ]
    return max(paths, key=lambda x: x[1])[1]


def value(path, scores, penalty):
    return sum(scores[i][k] for i, k in enumerate(path)) - penalty * sum(
        a != b for a, b in zip(path, path[1:])
    )


def test_labels_are_optimal():
    rng = np.random.default_rng(1)
    for case in range(200):
        scores = rng.normal(0, 3, (rng.integers(1, 12), rng.integers(1, 4))).round(2)
        if case % 5 == 0 and scores.shape[1] > 1:
            scores[:, 0][rng.random(len(scores)) < 0.3] = -np.inf
        penalty = float(rng.integers(0, 8))
        path = langid.label_words(scores, penalty).tolist()
        assert value(path, scores, penalty) >= plain_viterbi(scores.tolist(), penalty) - 1e-9


def test_words_do_not_depend_on_chunks(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("ab é\nщ7") for _ in range(3000))
    whole = list(langid.words_of(text))
    monkeypatch.setattr(langid, "CHUNK", 50)
    parts = list(langid.words_of(text))
    assert len(parts) > 20
    assert np.array_equal(
        np.concatenate([w.buckets for w in whole]), np.concatenate([w.buckets for w in parts])
    )
    lengths = [len(w) for w in "".join(c if c.isalpha() else " " for c in text).split()]
    assert np.concatenate([w.lengths for w in parts]).tolist() == lengths


def test_held_out_accuracy(spark, read):
    docs = read("documents")
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    rows = (
        langid.identify(docs, model)
        .withColumn("held_out", langid.held_out())
        .join(docs.select("doc_id", "lang"), "doc_id")
        .filter("held_out")
        .collect()
    )
    assert len(rows) > 40
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_spans_of_mixed_text_and_scripts(spark, documents):
    english = "the house and the garden were on the other side of that river with the bridge "
    german = "das haus und der garten lagen auf der anderen seite des flusses mit der schmalen "
    russian = "дом и сад были на другой стороне реки с мостом "
    docs = documents(
        [(1, english * 3, "en", "a", 1), (2, german * 3, "de", "a", 1), (3, russian * 3, "ru", "a", 1)]
    )
    model = langid.train(docs)
    mixed = english * 2 + german * 2 + russian
    rows = langid.identify(
        documents([mixed, "12 34 !", None, "", "ΑΒΓ"]), model
    ).orderBy("doc_id").collect()
    assert [s.lang for s in rows[0].spans] == ["en", "de", "ru"]
    assert sum(s.words for s in rows[0].spans) == len(mixed.split())
    assert 0.3 < rows[0].score < 0.6
    assert [(r.lang_pred, r.score) for r in rows[1:4]] == [("und", 0.0)] * 3
    assert rows[4].lang_pred in {"en", "de", "ru"}
    assert langid.identify(documents(["text"]), langid.train(docs.limit(0))).first().lang_pred == "und"


def test_filter_keeps_all_columns(spark, documents):
    docs = documents([("the and of to " * 5), None, "123"]).withColumnRenamed("source", "lowered")
    model = langid.train(docs)
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert [r.doc_id for r in kept.collect()] == [0]
    assert langid.keep_identified(docs.limit(0), model).collect() == []
