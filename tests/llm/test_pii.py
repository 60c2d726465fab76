import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stayvalue.llm import pii

PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, digits[::-1]))]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


PIECES = st.sampled_from(
    ["a", "@", ".", "b.c", "1", "23", "256", "0255", "-", " ", "+", "(", ")", "é",
     "4111 1111 1111 1111", "4111111111111111", "+1 (415) 555-0100", "a.b@c-d.org", "10.0.0.1"]
)


@settings(max_examples=400)
@given(st.lists(PIECES, max_size=14))
def test_base_spans_equal_the_patterns(pieces):
    text = "".join(pieces)
    assert pii.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "9" * 200_000):
        pii.base_spans(text)
    many = "a@b.c " * 20_000
    assert len(pii.contexts(many, pii.base_spans(many))) == 20_000


def corpus(documents):
    """A nickname that stands near one address in different contexts, and much other text."""
    texts = [f"note {i} from shadowfox{'' if i % 2 else ','} writes mx{i} a{i} joe@x.org at {i} b{i} c{i}" for i in range(6)]
    texts += [f"common words of the day {i} and the rest of it " * 3 for i in range(300)]
    texts += [f"the words u{i} v{i} joe@x.org w{i} day the" for i in range(3)]
    texts += ["unrelated rareword near kim@y.org here"] * 9  # copies are one context
    return documents(texts)


def test_disclosing_terms(spark, documents):
    docs = corpus(documents)
    rows = {r.doc_id: r for r in pii.report(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i in range(6):
        spans = [s.split(":") for s in rows[i].spans.split(",")]
        words = {texts[i][int(a) : int(b)] for kind, a, b in spans if kind == "term"}
        assert "shadowfox" in words and "day" not in words
    # Nine copies are one context: their words are generalised, where nine contexts would remove them.
    assert all(rows[i].n_term == 4 for i in range(309, 318))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "shadowfox" not in clean[0] and "joe@x.org" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[10] == texts[10]
    assert clean[310] == "[WORD] [WORD] [WORD] [EMAIL] [WORD]"


def test_report_of_the_table(spark, read):
    docs = read("documents")
    for row, doc in zip(
        pii.report(docs).orderBy("doc_id").collect(), docs.orderBy("doc_id").collect(), strict=True
    ):
        spans = plain_spans(doc.text)
        base = pii.listed(spans)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[0] == kind for s in spans) for kind in pii.KINDS[:4]
        ]
        kept = [s for s in row.spans.split(",") if s and not s.startswith("term")]
        assert kept == [f"{k}:{a}:{b}" for k, a, b in spans]


def test_odd_rows(spark, documents):
    docs = documents([(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x@y.org", "en", "a", 1),
                      (3, "😀 x@y.org", "en", "a", 1), (3, "x@y.org", "en", "a", 1)] * 2)
    docs = docs.withColumnRenamed("source", "text_hash").withColumnRenamed("lang", "term_spans")
    rows = pii.report(docs).collect()
    assert len(rows) == 10
    assert sorted({(r.doc_id or 0, r.spans) for r in rows}) == [
        (0, "email:0:7"), (1, ""), (2, ""), (3, "email:0:7"), (3, "email:2:9"),
    ]
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    assert sorted({(r.doc_id or 0, r.text) for r in clean.collect()}, key=repr) == [
        (0, "[EMAIL]"), (1, None), (2, ""), (3, "[EMAIL]"), (3, "😀 [EMAIL]"),
    ]
    assert pii.report(docs.limit(0)).collect() == []
    assert pii.sanitise(docs.limit(0)).collect() == []


def test_term_of_an_entity_written_once(spark, documents):
    """One address in one context: the words that occur only there disclose it, common ones do not."""
    texts = ["call shadowfox the day joe@x.org of rest"]
    texts += [f"common words of the day {i} and the rest of it " * 20 for i in range(2000)]
    texts += ["unrelated the day kim@y.org of rest"]
    docs = documents(texts)
    row = pii.report(docs).filter("doc_id = 0").first()
    spans = [s.split(":") for s in row.spans.split(",")]
    assert {texts[0][int(a) : int(b)] for kind, a, b in spans if kind == "term"} == {"call", "shadowfox"}
    assert pii.sanitise(docs).filter("doc_id = 0").first().text == "[WORD] [WORD] the day [EMAIL] of rest"


def test_disclosing_terms_far_from_the_entity(spark, documents):
    """In the same document beyond the six words, and in a document without any entity."""
    texts = [f"mx{i} Shadowfox a{i} joe@x.org b{i} c{i}" for i in range(12)]
    texts += [f"common words of the day {i} and the rest of it " * 20 for i in range(900)]
    texts += ["joe@x.org " + "and the rest of it " * 5 + "SHADOWFOX day", "Here is shadowfox, shadowfoxes the day"]
    docs = documents(texts)
    rows = {r.doc_id: r for r in pii.report(docs).collect()}
    for i in (912, 913):
        spans = [s.split(":") for s in rows[i].spans.split(",")]
        words = {texts[i][int(a) : int(b)] for kind, a, b in spans if kind == "term"}
        assert len({w for w in words if w.lower() == "shadowfox"}) == 1
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert all("shadowfox" not in clean[i].lower().replace("shadowfoxes", "") for i in (0, 912, 913))


def test_filter_holds_the_terms(spark):
    terms = [f"t{i}" for i in range(500)] + ["é", "名前"]
    size = pii.LEAST_FILTER_BITS
    bits = pii.term_filter(spark.createDataFrame([(t,) for t in terms], "term string"), size)
    assert all(pii._in_filter(bits, t) for t in terms)
    assert sum(pii._in_filter(bits, f"u{i}") for i in range(500)) < 5
    assert not any(pii.term_filter(spark.createDataFrame([], "term string"), size))


def test_six_words_on_either_side_however_far():
    for text, before, after in (
        ("joe@x.org a b c d e f g", "", "abcdef"),
        ("a b c d e f g joe@x.org", "bcdefg", ""),
        ("a b" + "!" * 5000 + "joe@x.org" + "!" * 5000 + "c" + ";" * 9000 + "d e f g h i", "ab", "cdefgh"),
    ):
        (context,) = pii.contexts(text, pii.base_spans(text))
        assert "".join(t["term"] for t in context["terms"]) == before + after


def plain_bits(texts):
    """(entity, term) -> bits left, over whole texts, by counting."""
    near, contexts, together, everywhere, total = {}, {}, {}, {}, 0
    for text in texts:
        text = text or ""
        total += len(text.split())
        for word in re.findall(r"[^\W_]+", text):
            everywhere[word.lower()] = everywhere.get(word.lower(), 0) + 1
        spans = plain_spans(text)
        words = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
        for kind, start, end in spans:
            # A word that reaches into the entity is cut at its edge.
            left = [(w[: start - a], a, min(b, start)) for w, a, b in words if a < start][-6:]
            right = [(w[max(0, end - a):], max(a, end), b) for w, a, b in words if b > end][:6]
            chosen = [
                w.lower() for w, a, b in left + right if not any(a < e and s < b for _, s, e in spans)
            ]
            value = text[start:end].lower()
            entity = f"{kind}:" + (re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value)
            for word in chosen:
                near[entity] = near.get(entity, 0) + 1
                together[entity, word] = together.get((entity, word), 0) + 1
                contexts.setdefault((entity, word), set()).add(" ".join(chosen))
    out = {}
    for (entity, word), found in contexts.items():
        hits = len(found)
        trials = hits + max(0, everywhere[word] - together[entity, word])
        z = 1.0
        middle = (hits + z / 2) / (trials + z)
        half = (hits * (trials - hits) / trials + z / 4) ** 0.5 / (trials + z)
        left = -math.log2(middle - half)
        if left <= 2 and -math.log2(min(1.0, near[entity] / total)) - left >= 1:
            out[entity, word] = left
    return out


def test_disclosure_against_counting(read):
    docs = read("documents")
    expected = plain_bits([r.text for r in docs.collect()])
    found = {
        (r.entity, r.term): r.bits_left for r in pii.disclosing_terms(docs, pii.find(docs)).collect()
    }
    assert expected and found.keys() == expected.keys()
    for key, bits in expected.items():
        assert found[key] == pytest.approx(bits, abs=1e-9)


def test_limits_do_not_move_with_the_corpus(spark, documents):
    texts = [f"mx{i} shadowfox a{i} joe@x.org the day of it" for i in range(5)]
    texts += [f"the day of it {i} and more words" for i in range(60)]
    more = [f"wholly other words of the day {i}" for i in range(2000)]
    small = {r.doc_id: r.spans for r in pii.report(documents(texts)).collect()}
    large = {r.doc_id: r.spans for r in pii.report(documents(texts + more)).collect()}
    assert any("term" in spans for spans in small.values())
    assert {i: large[i] for i in small} == small


def test_terms_in_parts(documents, monkeypatch):
    docs = corpus(documents)
    whole = sorted((r.doc_id, r.spans) for r in pii.report(docs).collect())
    monkeypatch.setattr(pii, "FILTER_BITS", 1 << 18)
    assert sorted((r.doc_id, r.spans) for r in pii.report(docs).collect()) == whole
