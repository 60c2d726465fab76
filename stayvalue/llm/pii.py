"""Personal data: fixed patterns, then information-theoretic sanitisation of what gives them away.

The patterns find protected entities: mail addresses, IP addresses, payment cards, phone numbers.
A term near an entity can disclose it although the entity itself is masked. How strongly is
estimated from the whole corpus: with p(e) the share of all words that lie near entity e, and
p(e|t) the share of term t's occurrences that do, someone who reads t needs -log2 p(e|t) more bits to
name e, of the -log2 p(e) without it. A term that leaves few bits, and fewer than there were, is
generalised; one that leaves hardly any is removed. The limits are in bits that are left, so they mean
the same in a corpus of any size. Every pair is scored, also of an entity written once:
p(e|t) is the lower confidence bound for what was counted, and equal contexts count once, so that
copies of one document are no evidence. A term that discloses an entity is treated wherever it
stands in the corpus, also where no entity is written.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, islice

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.shared import free_name, in_parts, store

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of an entity that count as near.
NEAR = 6
#: Standard errors of the lower bound for p(e|t); with one, n hits of n count as n / (n + 1).
CONFIDENCE = 1.0
#: Bits left at most for a term to be generalised, and to be removed; and bits it has to spare.
GENERALISE_BITS = 2.0
REMOVE_BITS = 0.5
LEAST_GAIN_BITS = 1.0

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits: what follows the run is the same for each start.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")
#: Bits of the filter for disclosing terms per term, at least and at most (32 MB for every task); more
#: terms than that serves are looked for part by part. Words a task remembers.
BITS_PER_TERM = 16
LEAST_FILTER_BITS, FILTER_BITS = 1 << 20, 1 << 28
REMEMBERED = 1 << 18
SEED = 42

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[Span]:
    """Mail addresses: each ``@`` with a domain, and the run of local characters before it."""
    end = 0
    for match in _DOMAIN.finditer(text):
        start = match.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < match.start():
            yield ("email", start, match.end())
            end = match.end()


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The matches of the fixed patterns, by start and then kind."""
    spans: list[Span] = []
    if "@" in text:
        spans += emails(text)
    if _DIGIT.search(text):
        for match in _IP.finditer(text):
            parts = match.group().split(".")
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                spans.append(("ip", *match.span()))
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *match.span()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 10 <= len(re.sub("[^0-9]", "", match.group())) <= 15:
                    spans.append(("phone", *match.span()))
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0])))


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _terms_before(text: str, end: int) -> list[tuple[str, int, int]]:
    """The last ``NEAR`` terms before a place, looking back no further than needed."""
    reach = 16 * NEAR
    while True:
        start = max(0, end - reach)
        found = [(m.group(), m.start(), m.end()) for m in _TERM.finditer(text, start, end)]
        # The first one may be the tail of a longer term unless the text begins here.
        if start == 0 or len(found) > NEAR:
            return found[-NEAR:]
        reach *= 4


def _terms_after(text: str, start: int) -> list[tuple[str, int, int]]:
    """The first ``NEAR`` terms behind a place, however far."""
    return [(m.group(), *m.span()) for m in islice(_TERM.finditer(text, start), NEAR)]


def _touches(spans: list[Span]) -> Callable[[int, int], bool]:
    """Whether a range has characters in common with one of the spans."""
    starts = [start for _, start, _ in spans]
    ends = list(accumulate((end for _, _, end in spans), max))

    def inside(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and ends[before - 1] > start

    return inside


def contexts(text: str, spans: list[Span]) -> list[dict]:
    """For each entity its terms nearby (outside all entities), and a hash of that context."""
    out = []
    inside = _touches(spans)
    for kind, start, end in spans:
        near = _terms_before(text, start) + _terms_after(text, end)
        terms = [
            {"term": t.lower(), "start": a, "end": b} for t, a, b in near if not inside(a, b)
        ]
        value = text[start:end].lower()
        if kind in ("card", "phone"):
            value = re.sub("[^0-9]", "", value)
        words = " ".join(t["term"] for t in terms)
        out.append(
            {
                "entity": f"{kind}:{value}",
                "context": hashlib.blake2b(words.encode(), digest_size=8).hexdigest(),
                "terms": terms,
            }
        )
    return out


_TERM_TYPE = pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_CONTEXT_TYPE = pa.struct(
    [("entity", pa.string()), ("context", pa.string()), ("terms", pa.list_(_TERM_TYPE))]
)
_SPAN_TYPE = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])


def find(docs: DataFrame) -> DataFrame:
    """Per document: its key, counts, base spans and contexts; the text itself is left behind.

    The key is the id and a hash of the text, so repeated ids with other texts stay apart.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("text_hash", T.LongType()),
            *[T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS[:4]],
            T.StructField("base_sha256", T.StringType()),
            *T.StructType.fromDDL(
                "n_words long, spans array<struct<start:int,kind:int,end:int>>, "
                "contexts array<struct<entity:string,context:string,"
                "terms:array<struct<term:string,start:int,end:int>>>>"
            ).fields,
        ]
    )
    none = hashlib.sha256(b"").hexdigest()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 2):
            texts = [text or "" for text in batch.column(2).to_pylist()]
            found = [base_spans(text) for text in texts]
            near = [contexts(t, s) if s else [] for t, s in zip(texts, found, strict=True)]
            counts = [
                pa.array([sum(s[0] == kind for s in spans) for spans in found], pa.int64())
                for kind in KINDS[:4]
            ]
            hashes = [
                hashlib.sha256(listed(spans).encode()).hexdigest() if spans else none
                for spans in found
            ]
            words = [len(text.split()) for text in texts]
            rows = [
                [{"start": a, "kind": KINDS.index(kind), "end": b} for kind, a, b in spans]
                for spans in found
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    *counts,
                    pa.array(hashes, pa.string()),
                    pa.array(words, pa.int64()),
                    pa.array(rows, pa.list_(_SPAN_TYPE)),
                    pa.array(near, pa.list_(_CONTEXT_TYPE)),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        task, schema
    )


def near_terms(found: DataFrame) -> DataFrame:
    """One row per term near an entity."""
    return found.select(
        "doc_id", "text_hash", F.explode("contexts").alias("near")
    ).select("doc_id", "text_hash", "near.entity", "near.context", F.explode("near.terms").alias("t"))


def lower_bound(hits: Column, trials: Column) -> Column:
    """The lower end of the Wilson interval for a share; a half for one hit of one."""
    z2 = CONFIDENCE * CONFIDENCE
    spread = CONFIDENCE * F.sqrt(hits * (trials - hits) / trials + F.lit(z2 / 4))
    return (hits + F.lit(z2 / 2) - spread) / (trials + F.lit(z2))


def disclosing_terms(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(entity, term, bits_left) for the terms to be generalised or removed.

    Counts cover the whole corpus: occurrences near each entity come from ``found``, all
    occurrences of the terms in question from the texts.
    """
    near = near_terms(found)
    pairs = store(
        near.groupBy("entity", F.col("t.term").alias("term"))
        .agg(F.count("*").alias("together"), F.count_distinct("context").alias("contexts")),
        "pii-pairs",
    )
    wanted = store(pairs.select("term").distinct(), "pii-terms")
    total = found.agg(F.sum("n_words")).first()[0] or 0
    if total == 0 or wanted.isEmpty():
        return pairs.select("entity", "term", F.lit(0.0).alias("bits_left")).limit(0)
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("term"))
    # Counted before the join, so that common terms do not pass it once per occurrence.
    everywhere = words.groupBy("term").agg(F.count("*").alias("all")).join(wanted, "term")
    # Occurrences in equal contexts near the entity are one trial, those elsewhere one each.
    trials = F.col("contexts") + F.greatest(F.lit(0), F.col("all") - F.col("together"))
    share = lower_bound(F.col("contexts").cast("double"), trials.cast("double"))
    telling = (
        pairs.join(everywhere, "term")
        .select("entity", "term", (-F.log2(share)).alias("bits_left"))
        .filter(F.col("bits_left") <= GENERALISE_BITS)
    )
    # Of each entity only the terms that tell much are joined with its size.
    entities = pairs.groupBy("entity").agg(F.sum("together").alias("near_words"))
    without = -F.log2(F.least(F.lit(1.0), F.col("near_words") / F.lit(float(total))))
    return (
        telling.join(entities, "entity")
        .filter(without - F.col("bits_left") >= LEAST_GAIN_BITS)
        .select("entity", "term", "bits_left")
    )


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(parts), term), F.lit(parts))


def term_filter(terms: DataFrame, bits: int) -> bytes:
    """A bit for each hash of a term: other terms than these are recognised without a join."""
    place = F.pmod(F.xxhash64("term"), F.lit(bits))
    # A bitmap of the function has 4096 bytes.
    rows = (
        terms.groupBy(F.floor(place / F.lit(32768)).alias("bitmap"))
        .agg(F.bitmap_construct_agg(F.pmod(place, F.lit(32768))).alias("bits"))
        .collect()
    )
    out = bytearray(bits // 8)
    for row in rows:
        out[row.bitmap * 4096 : (row.bitmap + 1) * 4096] = row.bits
    return bytes(out)


def _in_filter(bits: bytes, term: str) -> bool:
    place = xxhash.xxh64_intdigest(term.encode("utf-8", "surrogatepass"), SEED) % (8 * len(bits))
    return bool(bits[place // 8] >> place % 8 & 1)


def occurrences(docs: DataFrame, bits: bytes) -> DataFrame:
    """(doc_id, text_hash, term, start, end) of all terms that pass the filter, outside entities."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("text_hash long, term string, start int, end int").fields]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        bits = shared.value

        def passes(word: str) -> bool:
            found = known.get(word)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                found = known[word] = _in_filter(bits, word.lower())
            return found

        for batch in in_parts(batches, 2):
            rows, words, starts, ends = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                wanted = {word for word in set(_TERM.findall(text or "")) if passes(word)}
                if not wanted:
                    continue
                inside = _touches(base_spans(text))
                for match in _TERM.finditer(text):
                    if match.group() in wanted and not inside(*match.span()):
                        rows.append(row)
                        words.append(match.group().lower())
                        starts.append(match.start())
                        ends.append(match.end())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(words, pa.string()),
                    pa.array(starts, pa.int32()),
                    pa.array(ends, pa.int32()),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        task, schema
    )


def term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Per document key the spans of disclosing terms, wherever they stand.

    ``bits_left`` are the fewest that the term leaves for any entity. The texts are read once for every
    part of the terms that one filter serves.
    """
    terms = store(
        disclosing_terms(docs, found).groupBy("term").agg(F.min("bits_left").alias("bits_left")),
        "pii-disclosing",
    )
    wanted = max(LEAST_FILTER_BITS, BITS_PER_TERM * terms.count())
    parts = -(-wanted // FILTER_BITS)
    bits = min(FILTER_BITS, 1 << (wanted - 1).bit_length())
    hits = None
    for part in range(parts):
        chosen = terms if parts == 1 else terms.filter(_part(F.col("term"), parts) == part)
        found_here = occurrences(docs, term_filter(chosen, bits)).join(chosen, "term")
        hits = found_here if hits is None else hits.unionAll(found_here)
    return (
        hits.groupBy("doc_id", "text_hash", "start", "end")
        .agg(F.min("bits_left").alias("bits_left"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "end", "bits_left")).alias("term_spans"))
    )


def _same_key(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def report(docs: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and the list of all spans, per document.

    NULL texts count as empty; repeated rows are reported alike, each; NULL ids are kept. Only
    ``doc_id`` and ``text`` are read. An empty table gives an empty result.
    """
    found = store(find(docs), "pii-found")
    more = store(term_spans(docs, found), "pii-term-spans")
    kind = F.array(*[F.lit(k) for k in KINDS])
    extra = F.transform(
        F.coalesce("term_spans", F.array()),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS) - 1).alias("kind"), s["end"].alias("end")
        ),
    )
    text = F.transform(
        F.array_sort(F.concat("spans", extra)),
        lambda s: F.concat_ws(":", kind[s["kind"]], s["start"], s["end"]),
    )
    return found.join(more, _same_key(found, more), "left").select(
        found["doc_id"],
        *[f"n_{k}" for k in KINDS[:4]],
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
        F.size(F.coalesce("term_spans", F.array())).cast("long").alias("n_term"),
    )


def masked(text: str, terms: list[tuple[int, int, float]]) -> str:
    """The text with entities masked and disclosing terms generalised or removed."""
    spans = [(a, b, f"[{kind.upper()}]") for kind, a, b in base_spans(text)]
    for a, b, bits_left in terms:
        generic = "[NUMBER]" if text[a:b].isdigit() else "[WORD]"
        spans.append((a, b, "" if bits_left <= REMOVE_BITS else generic))
    out, end = [], 0
    for a, b, mask in sorted(spans):
        if a >= end:
            out += [text[end:a], mask]
        end = max(end, b)
    return "".join([*out, text[end:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with sanitised texts; all other columns and rows are unchanged.

    A NULL text stays NULL. Columns may have any names besides.
    """
    found = store(find(docs), "pii-found")
    more = store(term_spans(docs, found), "pii-term-spans")
    key = free_name("text_hash", docs.columns)
    spans = free_name("term_spans", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64("text"))
    more = more.select(
        F.col("doc_id").alias("more_id"), F.col("text_hash").alias("more_hash"),
        F.col("term_spans").alias(spans),
    )
    joined = keyed.join(
        more, keyed["doc_id"].eqNullSafe(more["more_id"]) & (keyed[key] == more["more_hash"]), "left"
    ).select(*[F.col(f"`{c}`") for c in docs.columns], spans)
    place = docs.columns.index("text")
    schema = docs.schema

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, place):
            texts = [
                None
                if text is None
                else masked(text, [(t["start"], t["end"], t["bits_left"]) for t in terms or []])
                for text, terms in zip(
                    batch.column(place).to_pylist(), batch.column(len(schema)).to_pylist(),
                    strict=True,
                )
            ]
            columns = list(batch.columns[: len(schema)])
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return joined.mapInArrow(task, schema)
