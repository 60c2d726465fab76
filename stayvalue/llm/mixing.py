"""Mixing sources to target weights: iterative proportional fitting, then Poisson sampling.

Documents fall into cells (source, language, topic) that carry their tokens. Raking scales the cell
weights in turn to the wanted totals of each dimension until all three hold; a cell never weighs
more than its tokens. A document is then kept with probability (raked weight / tokens) of its cell.

Everything is built from DataFrame functions. The documents are aggregated to cells before any
shuffle; raking only ever sees cells. The scaling factors of a dimension (one row per value) are
stored after each step, so no plan grows with the number of rounds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayvalue.llm.shared import free_name, store

#: Stand-in for a topic classifier: words vote by their initial letter, the largest group wins.
#: Give ``topic=`` a column of your own where one exists.
TOPIC_INITIALS = ("at", "eihy", "oqu", "dlsz", "cnpw", "bfgm", "rvkxj")
DIMENSIONS = ("source", "lang", "topic")
#: Targets follow each dimension's own token totals, flattened by this exponent.
FLATTEN = 0.7
#: Share of all tokens that the sample is to hold.
SAMPLE_SHARE = 0.5
ROUNDS = 10
SEED = "mix-1"
WORD_GAP = r"[\x20\x09-\x0D]"


def initials(text: Column) -> Column:
    """The first character of every word, lower-cased and joined."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WORD_GAP}+", "")
    first = F.regexp_replace(trimmed, r"([^\x20\x09-\x0D])[^\x20\x09-\x0D]*" + WORD_GAP + "*", "$1")
    return F.lower(first)


def topic_of_initials(first: Column) -> Column:
    """Number of the group with most initials (the first on a tie); the last number for none."""
    votes = [
        F.length(first) - F.length(F.translate(first, group, "")) for group in TOPIC_INITIALS
    ]
    most = F.greatest(*votes)
    picked = F.when(most == 0, F.lit(str(len(votes))))
    for number, vote in enumerate(votes):
        picked = picked.when(vote == most, F.lit(str(number)))
    return picked


def with_tokens_and_topic(
    docs: DataFrame, text: str = "text", tokens: str = "tokens", topic: str = "topic"
) -> DataFrame:
    """Add ``tokens`` (words of the whole text, long) and ``topic`` (string), under these names.

    Columns that already have the names are replaced.
    """
    name = free_name("initials", docs.columns)
    first = docs.drop(tokens, topic).withColumn(name, initials(F.col(text)))
    return first.withColumns(
        {tokens: F.length(name).cast("long"), topic: topic_of_initials(F.col(name))}
    ).drop(name)


def _key(column: str) -> Column:
    """Null-safe text key: values are marked, so no value can look like NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def cell_tokens(
    docs: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, tokens: str = "tokens"
) -> DataFrame:
    """Token totals per cell, with keys ``k0``, ``k1``, ... for the dimensions."""
    keys = [_key(c).alias(f"k{i}") for i, c in enumerate(dimensions)]
    return (
        docs.groupBy(*keys)
        .agg(F.sum(tokens).alias("cell_tokens"))
        .filter(F.col("cell_tokens") > 0)
    )


def flattened_targets(
    cells: DataFrame, dimensions: tuple[str, ...], flatten: float
) -> list[DataFrame]:
    """For each dimension the wanted share per value: its own share to a power, normalised."""
    out = []
    for i in range(len(dimensions)):
        totals = cells.groupBy(f"k{i}").agg(F.sum("cell_tokens").cast("double").alias("total"))
        powered = store(totals.withColumn("wanted", F.pow("total", F.lit(flatten))), f"totals-{i}")
        whole = powered.agg(F.sum("wanted")).first()[0]
        share = (F.col("wanted") / F.lit(whole)).cast("double")
        out.append(powered.select(f"k{i}", share.alias("share")))
    return out


def _rates(cells: DataFrame, factors: list[DataFrame]) -> DataFrame:
    """The cells with ``rate``, the product of their factors, at most 1."""
    joined = reduce(lambda left, right: left.join(right, right.columns[0]), factors, cells)
    product = reduce(lambda a, b: a * b, [F.col(f"f{i}") for i in range(len(factors))])
    return joined.withColumn("rate", F.least(F.lit(1.0), product))


def rake(
    cells: DataFrame,
    targets: list[DataFrame],
    share: float = SAMPLE_SHARE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Iterative proportional fitting with an upper bound; adds ``rate`` (0 to 1) to the cells.

    ``targets[i]`` holds (``k<i>``, ``share``) for every value of dimension i. Each step multiplies
    the factors of one dimension by wanted / current totals. A value that is asked for more tokens
    than it has gets all of them.
    """
    total = cells.agg(F.sum("cell_tokens").cast("double")).first()[0] or 0.0
    factors = [
        store(target.select(f"k{i}", F.lit(1.0 if i else share).alias(f"f{i}")), f"rake-{i}")
        for i, target in enumerate(targets)
    ]
    for _ in range(rounds):
        for i, target in enumerate(targets):
            current = (
                _rates(cells, factors)
                .groupBy(f"k{i}")
                .agg(F.sum(F.col("cell_tokens") * F.col("rate")).alias("current"))
            )
            scaled = F.col(f"f{i}") * (F.col("share") * F.lit(share * total) / F.col("current"))
            factors[i] = store(
                target.join(current, f"k{i}")
                .join(factors[i], f"k{i}")
                .select(f"k{i}", scaled.alias(f"f{i}")),
                f"rake-{i}",
            )
    return _rates(cells, factors).drop(*[f"f{i}" for i in range(len(factors))])


def margins(raked: DataFrame, targets: list[DataFrame], share: float = SAMPLE_SHARE) -> DataFrame:
    """How well raking has met the targets: a row per dimension and value, the worst first.

    ``dimension`` (its place), ``value`` (the key), ``wanted``, ``reached`` and ``available`` tokens,
    ``reachable`` (whether there are as many as wanted) and ``error``, by which part the tokens reached
    miss what is wanted, or available if that is less. Ask for more ``rounds`` while errors are large.
    """
    total = F.lit(raked.agg(F.sum("cell_tokens").cast("double")).first()[0] or 0.0)
    parts = []
    for i, target in enumerate(targets):
        held = raked.groupBy(f"k{i}").agg(
            F.sum(F.col("cell_tokens") * F.col("rate")).alias("reached"),
            F.sum("cell_tokens").cast("double").alias("available"),
        )
        wanted = F.col("share") * F.lit(share) * total
        parts.append(
            target.join(held, f"k{i}", "left").select(
                F.lit(i).alias("dimension"),
                F.col(f"k{i}").alias("value"),
                wanted.alias("wanted"),
                F.coalesce("reached", F.lit(0.0)).alias("reached"),
                F.coalesce("available", F.lit(0.0)).alias("available"),
            )
        )
    goal = F.least("wanted", "available")
    return (
        reduce(DataFrame.unionAll, parts)
        .withColumn("reachable", F.col("available") >= F.col("wanted"))
        .withColumn("error", F.coalesce(F.try_divide(F.abs(F.col("reached") - goal), goal), F.lit(0.0)))
        .orderBy(F.desc("error"), "dimension", "value")
    )


def uniform(identity: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the MD5 of id and seed: the same for every layout and retry."""
    digest = F.md5(F.concat_ws("|", F.coalesce(identity.cast("string"), F.lit("")), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(16**12))


def mix(
    docs: DataFrame,
    *,
    targets: list[DataFrame] | None = None,
    dimensions: tuple[str, ...] = DIMENSIONS,
    flatten: float = FLATTEN,
    share: float = SAMPLE_SHARE,
    rounds: int = ROUNDS,
    seed: str = SEED,
    identity: str = "doc_id",
    tokens: str = "tokens",
    probability: str = "keep_probability",
    kept: str = "kept",
) -> DataFrame:
    """Add ``keep_probability`` (double) and ``kept`` (boolean) to documents with ``tokens``.

    The last three parameters name these columns; columns that already have the names of the new ones
    are replaced.

    NULL in a dimension is a value of its own. Documents without tokens carry no weight: their
    probability is 0. Rows with the same id get the same number, so repeated rows are kept or
    dropped together. An empty table stays empty. The kept documents are expected to hold ``share``
    of all tokens, divided by the target shares in every dimension (for reachable targets).
    """
    cells = store(cell_tokens(docs, dimensions, tokens), "cells")
    wanted = targets or flattened_targets(cells, dimensions, flatten)
    wanted = [store(target, f"target-{i}") for i, target in enumerate(wanted)]
    raked = rake(cells, wanted, share, rounds)
    keys = [f"k{i}" for i in range(len(dimensions))]
    rates = store(raked.select(*keys, F.col("rate").alias("cell_probability")), "rates")
    columns = [c for c in docs.columns if c.lower() not in {probability.lower(), kept.lower()}]
    names = {name: free_name(name, docs.columns) for name in [*keys, "cell_probability"]}
    keyed = docs.withColumns({names[k]: _key(c) for k, c in zip(keys, dimensions, strict=True)})
    joined = keyed.join(rates.withColumnsRenamed(names), [names[k] for k in keys], "left")
    chance = F.when(
        F.col(tokens) > 0, F.coalesce(F.col(names["cell_probability"]), F.lit(0.0))
    ).otherwise(F.lit(0.0))
    return joined.select(
        *[F.col(f"`{c}`") for c in columns],
        chance.alias(probability),
        (uniform(F.col(identity), seed) < chance).alias(kept),
    )


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Tokens and topics of raw documents, then ``mix``."""
    return mix(with_tokens_and_topic(docs), **options)


def oracle_sql(
    share: float = SAMPLE_SHARE, rounds: int = ROUNDS, flatten: float = FLATTEN, seed: str = SEED
) -> str:
    """The query over ``documents`` in DuckDB's SQL; the rounds are written out one by one."""
    votes = [
        f"length(first) - length(translate(first, '{group}', ''))" for group in TOPIC_INITIALS
    ]
    cases = " ".join(
        f"when {vote} = greatest({', '.join(votes)}) then '{i}'" for i, vote in enumerate(votes)
    )
    gap = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]"
    parts = [
        f"""docs as (
        select doc_id, source, lang, lower(regexp_replace(regexp_replace(coalesce(text, ''),
            '^{gap}+', ''), '({word}){word}*{gap}*', '\\1', 'g')) as first
        from documents)""",
        f"""topics as (
        select doc_id, source, lang, length(first)::BIGINT as tokens,
            case when greatest({', '.join(votes)}) = 0 then '{len(votes)}' {cases} end as topic,
            coalesce('=' || source, 'null') as k0, coalesce('=' || lang, 'null') as k1
        from docs)""",
        """cells as (
        select k0, k1, '=' || topic as k2, sum(tokens)::DOUBLE as t from topics
        group by all having sum(tokens) > 0)""",
        f"size as (select {share} * sum(t) as s from cells)",
    ]
    for i in range(3):
        parts.append(
            f"""t{i} as (
        select k{i}, pow(sum(t), {flatten}) / sum(pow(sum(t), {flatten})) over () as share
        from cells group by k{i})"""
        )
        start = 1.0 if i else share
        parts.append(f"f{i}_0 as (select k{i}, {start}::DOUBLE as f{i} from t{i})")
    current = [f"f{i}_0" for i in range(3)]
    joined = "cells join {} using (k0) join {} using (k1) join {} using (k2)"
    for step in range(1, rounds + 1):
        for i in range(3):
            parts.append(
                f"""f{i}_{step} as materialized (
        select k{i}, any_value(f{i}) * (any_value(share) * any_value(s)
            / sum(t * least(1.0, f0 * f1 * f2))) as f{i}
        from {joined.format(*current)} join t{i} using (k{i}), size group by k{i})"""
            )
            current[i] = f"f{i}_{step}"
    parts.append(
        f"""rates as (
        select k0, k1, k2, least(1.0, f0 * f1 * f2) as p from {joined.format(*current)})"""
    )
    return f"""with {', '.join(parts)},
    drawn as (
        select doc_id, source, lang, topic, tokens,
            case when tokens > 0 then coalesce(p, 0.0) else 0.0 end as p,
            ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|{seed}'), 1, 12))::BIGINT
                / {float(16**12)!r} as u
        from topics left join rates
            on topics.k0 = rates.k0 and topics.k1 = rates.k1 and '=' || topic = rates.k2)
    select doc_id, source, lang, topic, tokens, round(p, 6) as keep_probability, u < p as kept
    from drawn"""
