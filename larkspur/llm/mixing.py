"""Mixing sources to target weights by iterative proportional fitting; native expressions only.

Documents are summed to cells (source, language, topic) of token weights, by partial
aggregates; all fitting happens on the cells.  Raking scales the cells to the target share of each
source, then of each language, then of each topic, ``ROUNDS`` times over.  A document is kept
with probability min(1, c * fitted share / own share) of its cell, where c makes the
expected sample ``KEEP`` of all tokens: below the cap the sample's expected shares are in the fitted
proportions, and a cell that would need more than all its documents gives all of them.  The draw is a
keyed hash of the id: it does not depend on partitions or reruns.

Without given targets a margin's target shares are its own shares raised to ``TEMPER`` and
normalised, which lifts small sources, languages and topics.

Defined cases: a null source, language or topic is a category of its own; a null or empty text weighs
0 tokens and gets its cell's probability; a cell without any tokens is kept, unless a given target is 0
for it; categories missing from given targets have target 0; rows with one id share one draw;
extra columns are kept, those named like an added column are replaced; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import store

TEMPER = 0.9
ROUNDS = 12
KEEP = 0.85
CAPS = 6                  # steps of finding c; each sets aside the cells that reached the cap
SEED = "mix-1"
SPACE = r"[\x20\x09-\x0D]+"
MARGINS = ("source", "lang", "topic")
ADDED = ("topic", "n_tokens", "probability", "kept")
# Shares of characters above which a text counts as of this kind.
MARKUP_SHARE, CAPITAL_SHARE, DIGIT_SHARE, SHORT_TOKENS = 0.02, 0.3, 0.05, 100


def tokens(text) -> F.Column:
    """Words of a text."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")).cast("long")


def topic(text, n_tokens) -> F.Column:
    """A coarse topic from the make-up of a text: markup, capitals, figures, short or prose."""
    size = F.length(text)

    def share(kind: str) -> F.Column:
        return F.regexp_count(text, F.lit(kind))
    return (F.when(share(r"[#*$%&|<>]") > MARKUP_SHARE * size, "markup")
            .when(share("[A-Z]") > CAPITAL_SHARE * size, "capitals")
            .when(share("[0-9]") > DIGIT_SHARE * size, "figures")
            .when(n_tokens < SHORT_TOKENS, "short").otherwise("prose"))


def draw(id_col: str) -> F.Column:
    """A number in [0, 1) fixed by the id."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":" + SEED))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def _weigh(docs: DataFrame, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    docs = store.without(docs, *ADDED, "mix_source", "mix_lang")
    docs = docs.withColumn("n_tokens", tokens(F.col(text_col)))
    return (docs.withColumn("topic", topic(F.coalesce(F.col(text_col), F.lit("")), F.col("n_tokens")))
            .withColumn("mix_source", F.col(source_col).cast("string")).withColumn("mix_lang", F.col(lang_col).cast("string")))


def fitted_cells(cells: DataFrame, targets: dict[str, dict[str | None, float]] | None = None,
                 temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``share`` of all tokens and ``fitted``, the raked share."""
    spark = cells.sparkSession
    cells = store.saved(cells, "mix-cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    weight = (F.col("tokens") / F.lit(total)) if total else F.lit(0.0)
    cells = cells.withColumn("share", weight.cast("double")).withColumn("fitted", F.col("share"))
    for m in MARGINS:
        own = F.sum("fitted").over(Window.partitionBy(m))
        if targets and m in targets:
            given = spark.createDataFrame(list(targets[m].items()), f"{m}_given string, goal double")
            goal_sum = sum(targets[m].values()) or 1.0
            cells = (cells.join(given, cells[m].eqNullSafe(given[f"{m}_given"]), "left").drop(f"{m}_given")
                     .withColumn(f"goal_{m}", F.coalesce(F.col("goal") / goal_sum, F.lit(0.0))).drop("goal"))
        else:
            marginal = cells.groupBy(m).agg(F.sum("fitted").alias("s"))
            norm = marginal.agg(F.sum(F.pow("s", F.lit(temper)))).first()[0] or 1.0
            cells = cells.withColumn(f"goal_{m}", F.pow(own, F.lit(temper)) / norm)
    for k in range(rounds):
        for m in MARGINS:
            own = F.sum("fitted").over(Window.partitionBy(m))
            cells = cells.withColumn("fitted", F.when(own > 0, F.col("fitted") * F.col(f"goal_{m}") / own).otherwise(0.0))
        if k % 4 == 3:
            cells = store.saved(cells, "mix-fitted")
    return cells


def _scale(cells: DataFrame, keep: float) -> float:
    """The c for which min(1, c * fitted / share), weighted by share, sums to ``keep``."""
    c = keep
    for _ in range(CAPS):
        capped = F.col("fitted") * c >= F.col("share")
        full, rest = cells.agg(F.sum(F.when(capped, F.col("share")).otherwise(0.0)),
                               F.sum(F.when(capped, 0.0).otherwise(F.col("fitted")))).first()
        if not rest:
            break
        c = max(c, (keep - full) / rest)
    return c


def mix(docs: DataFrame, targets: dict[str, dict[str | None, float]] | None = None, temper: float = TEMPER,
        rounds: int = ROUNDS, keep: float = KEEP, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept (the draw is below the probability)."""
    weighed = _weigh(docs, text_col, source_col, lang_col)
    # The texts are read for the cells and again for the result: only sums are kept between.
    cells = (weighed.groupBy(F.col("mix_source").alias("source"), F.col("mix_lang").alias("lang"), "topic")
             .agg(F.sum("n_tokens").alias("tokens")))
    cells = fitted_cells(cells, targets, temper, rounds)
    positive = " and ".join(["true", *(f"goal_{m} > 0" for m in targets or ())])
    cells = store.saved(cells.select(F.col("source").alias("c_source"), F.col("lang").alias("c_lang"),
                                     F.col("topic").alias("c_topic"), "share", "fitted",
                                     F.expr(positive).alias("wanted")), "mix-factors")
    odds = F.when(F.col("share") > 0, F.least(F.lit(1.0), F.lit(_scale(cells.where("share > 0"), keep)) * F.col("fitted") / F.col("share")))
    cells = (cells.withColumn("probability", F.coalesce(odds, F.when(F.col("wanted"), 1.0).otherwise(0.0)))
             .drop("share", "fitted", "wanted"))
    same = (F.col("mix_source").eqNullSafe(F.col("c_source")) & F.col("mix_lang").eqNullSafe(F.col("c_lang"))
            & F.col("topic").eqNullSafe(F.col("c_topic")))
    return (weighed.join(cells, same, "left").drop("c_source", "c_lang", "c_topic", "mix_source", "mix_lang")
            .withColumn("kept", draw(id_col) < F.col("probability")))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents kept by ``mix``, with the columns of ``docs``."""
    return mix(docs, **options).where("kept").select(*docs.columns)


def oracle() -> str:
    """DuckDB SQL of ``mix`` over documents: doc_id, source, lang, topic, n_tokens, probability, kept."""
    steps, last = [], "r0"
    n = 0
    for _ in range(ROUNDS):
        for m in MARGINS:
            n += 1
            steps.append(f"r{n} as (select * exclude (f), case when sum(f) over (partition by {m}) > 0 then "
                         f"f * g_{m} / sum(f) over (partition by {m}) else 0 end as f from {last})")
            last = f"r{n}"
    goals = ", ".join(f"pow(sum(f) over (partition by {m}), {TEMPER}) / (select sum(pow(m, {TEMPER})) from "
                      f"(select sum(f) as m from c group by {m})) as g_{m}" for m in MARGINS)
    caps = ", ".join([f"k0 as (select {KEEP} as c)"] + [
        f"k{i + 1} as (select coalesce(greatest(any_value(c), ({KEEP} - sum(case when f * c >= s then s else 0 end)) / "
        f"nullif(sum(case when f * c >= s then 0 else f end), 0)), any_value(c)) as c from {last}, k{i} where s > 0)"
        for i in range(CAPS)])
    return rf"""
with d as (select doc_id, source, lang, coalesce(text, '') as t,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens from documents),
e as (select *, case
        when len(regexp_extract_all(t, '[#*$%&|<>]')) > {MARKUP_SHARE} * length(t) then 'markup'
        when len(regexp_extract_all(t, '[A-Z]')) > {CAPITAL_SHARE} * length(t) then 'capitals'
        when len(regexp_extract_all(t, '[0-9]')) > {DIGIT_SHARE} * length(t) then 'figures'
        when n_tokens < {SHORT_TOKENS} then 'short' else 'prose' end as topic from d),
b as (select source, lang, topic, sum(n_tokens)::double / (select sum(n_tokens) from e) as s from e group by all),
c as (select *, s as f from b),
r0 as (select *, {goals} from c),
{", ".join(steps)},
{caps},
p as (select source, lang, topic, coalesce(least(1.0, (select c from k{CAPS}) * f / nullif(s, 0)), 1.0) as probability
      from {last})
select e.doc_id, e.source, e.lang, e.topic, n_tokens, probability,
       ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':{SEED}'), 1, 8))::bigint / 4294967296.0 < probability as kept
from e join p on e.source is not distinct from p.source and e.lang is not distinct from p.lang and e.topic = p.topic
"""
