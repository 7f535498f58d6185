"""Quality rules over words and lines, with cross-document line frequency; native expressions only.

Base rules look at one document: too few words, or too many words inside repeated 3-word
windows.  Then lines are normalised (case, digits, white space), hashed, and counted
per host (the ``source``) over its distinct texts, so that copies of one document do not turn
its lines into boilerplate.  A line found in at least ``LINE_DOCS`` texts and ``LINE_SHARE`` of
the host's texts is removed; a document left with under ``LEAST_LEFT`` of its words is depleted
and rejected.  ``rules`` gives the counts and the verdict, ``cleaned`` the texts without those lines.

One scan of the texts writes measures and line hashes to the shared folder; what follows moves
rows of a few numbers, counted by partial aggregates before any shuffle.  ``cleaned`` scans the texts once
more and joins them, by host and digest, with the few that lose a line or are rejected.

Defined cases: a null or wordless text has zero counts and fails the base rules; a null host is a
host of its own; repeated rows are rows of their own with one text; extra columns
stay out of ``rules`` and stay in ``cleaned``, where a null text stays null and lines without a word stay
in their places; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LINE_DOCS, LINE_SHARE = 10, 0.001
LEAST_LEFT = 0.5             # a document made up mainly of frequent lines is depleted

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


def words(text) -> F.Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def normal_line(line) -> F.Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]+", "0"), SPACE + "+", " "))


def _triples(w) -> F.Column:
    """A hash per 3-word window."""
    at = F.sequence(F.lit(0), F.size(w) - 3)
    return (F.when(F.size(w) >= 3, F.transform(at, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
            .otherwise(F.array().cast("array<long>")))


def _repeated_starts(h, ordered) -> F.Column:
    """Ascending starts of the windows whose hash occurs twice or more; ``ordered``: sorted (hash, start)."""
    equal = F.filter(ordered, lambda x, i: (x["h"] == F.get(ordered, i - 1)["h"]) | (x["h"] == F.get(ordered, i + 1)["h"]))
    return F.sort_array(F.transform(equal, lambda x: x["i"]))


def _covered(starts) -> F.Column:
    """Words in the 3-word windows that begin at ``starts``."""
    return F.aggregate(F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3)))),
                       F.lit(0).cast("long"), lambda a, n: a + n)


def _host(host_col: str) -> list[F.Column]:
    return [F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(host_col).isNull().alias("no_host")]


def _digest(text) -> F.Column:
    return F.xxhash64(text, F.length(text))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, host, digest of the text, the base counts, and (hash, words) of every line with a word."""
    t = docs.select(F.col(id_col).alias("doc_id"), *_host(host_col),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Each layer's arrays are used several times in the next, so Catalyst keeps the layers apart.
    t = t.select("doc_id", "host", "no_host", "text", words(F.col("text")).alias("w"),
                 F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    t = t.select("doc_id", "host", "no_host", _digest(F.col("text")).alias("digest"),
                 F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
                 F.size(F.regexp_extract_all("text", F.lit(SYMBOLS), F.lit(0))).cast("long").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("lines", lambda x: F.struct(
                     F.xxhash64(normal_line(x)).alias("line"),
                     F.size(F.regexp_extract_all(x, F.lit(WORD + "+"), F.lit(0))).alias("words"))).alias("lines"),
                 _triples(F.col("w")).alias("h"))
    paired = F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    t = t.withColumn("ordered", F.when(F.size("h") > F.size(F.array_distinct("h")), F.sort_array(paired)))
    t = t.withColumn("starts", F.when(F.col("ordered").isNotNull(), _repeated_starts(F.col("h"), F.col("ordered"))))
    return (t.withColumn("n_repeat_words", F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("long"))
            .drop("h", "ordered", "starts"))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def frequent_lines(measured: DataFrame, least_docs: int = LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """(host, no_host, line) found in enough of the host's distinct texts."""
    host = ["host", "no_host"]
    texts = measured.groupBy(*host).agg(F.countDistinct("digest").alias("texts"))
    seen = (measured.select(*host, "digest", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
            .distinct().groupBy(*host, "line").agg(F.count("*").alias("docs")).where(F.col("docs") >= least_docs))
    return seen.join(texts, host).where(F.col("docs") >= share * F.col("texts")).select(*host, "line")


def _removed(rows: DataFrame, *more: F.Column) -> DataFrame:
    """Per row with a frequent line: the words in such lines, and ``more`` aggregates of them."""
    host = ["host", "no_host"]
    lines = rows.select("row", *host, F.explode("lines").alias("x")).select("row", *host, "x.line", "x.words")
    return lines.join(frequent_lines(rows), [*host, "line"]).groupBy("row").agg(F.sum("words").alias("removed"), *more)


def _left() -> F.Column:
    return F.col("n_words") - F.coalesce("removed", F.lit(0))


def _kept() -> F.Column:
    return ~base_failed() & (_left() >= LEAST_LEFT * F.col("n_words"))


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: doc_id, the counts, base_failed, n_left (words outside removed lines) and kept."""
    rows = store.saved(measures(docs, id_col, text_col, host_col)
                       .withColumn("row", F.monotonically_increasing_id()), "line-measures")
    return (rows.drop("lines").join(_removed(rows), "row", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), _left().cast("long").alias("n_left"), _kept().alias("kept")))


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``docs`` with every text rebuilt from its lines outside the frequent ones, in order, and the verdict as ``kept``."""
    docs = store.without(docs, "kept")
    names = docs.columns
    rows = store.saved(measures(docs, id_col, text_col, host_col)
                       .select("host", "no_host", "digest", "n_words", "n_repeat_words", "lines")
                       .withColumn("row", F.monotonically_increasing_id()), "line-measures")
    key = ["host", "no_host", "digest"]
    gone = _removed(rows, F.collect_set("line").alias("gone"))
    # Equal texts of a host have equal verdicts and lines.  Written first, so that Spark knows its size.
    changed = store.saved(rows.drop("lines").join(gone, "row", "left").select(*key, "gone", _kept().alias("kept"))
                          .where(F.col("gone").isNotNull() | ~F.col("kept"))
                          .groupBy(*key).agg(F.first("gone").alias("gone"), F.first("kept").alias("kept")), "line-changes")
    changed = changed.select(*(F.col(c).alias(f"line_{c}") for c in changed.columns))
    host, no_host = _host(host_col)
    out = docs.select(*names, host.alias("own_host"), no_host.alias("own_no_host"),
                      _digest(F.coalesce(F.col(text_col), F.lit(""))).alias("own_digest"))
    out = out.join(changed, (out["own_host"] == changed["line_host"]) & (out["own_no_host"] == changed["line_no_host"])
                   & (out["own_digest"] == changed["line_digest"]), "left")
    left = F.filter(F.split(text_col, "\n"), lambda x: ~(x.rlike(WORD) & F.array_contains("line_gone", F.xxhash64(normal_line(x)))))
    text = F.when(F.col("line_gone").isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return (out.withColumn(text_col, text)
            .select(*names, F.coalesce("line_kept", F.lit(True)).alias("kept")))


ORACLE = rf"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
w as (select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w,
             generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from d),
win as (select r, i, w, lead(w, 1) over o as w1, lead(w, 2) over o as w2 from w window o as (partition by r order by i)),
rep as (select r, i from (select r, i, count(*) over (partition by r, w, w1, w2) as c from win where w2 is not null) where c > 1),
cov as (select r, count(distinct i + k) as n from rep, (values (0), (1), (2)) v(k) group by r),
ws as (select r, count(*) as n, sum(length(w)) as c from w group by r),
ln as (select r, source, text, unnest(string_split(text, chr(10))) as l from d),
lw as (select r, source, text, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as n,
              trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) as z
       from ln where regexp_matches(l, '[^\x20\x09-\x0D]')),
dup as (select r, count(*) - count(distinct l) as n from lw group by r),
hosts as (select source, count(distinct text) as texts from d group by source),
often as (select lw.source, z from lw join hosts on lw.source is not distinct from hosts.source
          group by lw.source, z, texts
          having count(distinct text) >= {LINE_DOCS} and count(distinct text) >= {LINE_SHARE} * texts),
gone as (select r, sum(n) as n from lw join often on lw.source is not distinct from often.source and lw.z = often.z group by r),
m as (select d.doc_id, coalesce(ws.n, 0)::bigint as n_words, coalesce(ws.c, 0)::bigint as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
             coalesce(cov.n, 0)::bigint as n_repeat_words, coalesce(gone.n, 0) as gone
      from d left join ws using (r) left join dup using (r) left join cov using (r) left join gone using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed,
       (n_words - gone)::bigint as n_left,
       not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)
         and n_words - gone >= {LEAST_LEFT} * n_words as kept
from m
"""

# The texts without their frequent lines, by the same counts.
ORACLE_TEXTS = ORACLE.rpartition("m as (")[0] + rf"""
place as (select r, source, unnest(string_split(text, chr(10))) as l, generate_subscripts(string_split(text, chr(10)), 1) as i from d),
line as (select r, i, l, often.z is not null and regexp_matches(l, '[^\x20\x09-\x0D]') as frequent
         from place left join often on place.source is not distinct from often.source and often.z =
              trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'))),
built as (select r, coalesce(string_agg(l, chr(10) order by i) filter (not frequent), '') as text from line group by r)
select doc_id, built.text,
       not (coalesce(ws.n, 0) < {MIN_WORDS} or 100 * coalesce(cov.n, 0) > {MAX_REPEAT_PERCENT} * coalesce(ws.n, 0))
         and coalesce(ws.n, 0) - coalesce(gone.n, 0) >= {LEAST_LEFT} * coalesce(ws.n, 0) as kept
from d join built using (r) left join ws using (r) left join cov using (r) left join gone using (r)
"""
