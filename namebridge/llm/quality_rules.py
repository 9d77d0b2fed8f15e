"""Operator 9: quality rules with cross-document line frequency, in DataFrame operations only.

Each text gets counts of its own (words, symbols, equal lines, repeated word windows). Its lines, normalised
(lower case, blanks squeezed), are hashed, and for each host (the source column) the documents that hold a line
are counted. Lines above the host's limit are removed; a document that loses more than half of its words is
depleted and rejected, as is one that fails the base rules.

A null text has no words. A null host is a host of its own. Repeated rows and equal texts count once each, as
documents. Ids may be null or repeated. An empty table gives an empty result; further columns are ignored.
Lines and word windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namebridge.llm.stages import documents, written

_BLANK = r"[\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class QualityConfig:
    #: A line is removed from a host where it is in more documents than this and than this share of them; in large
    #: hosts, where the share is more than ``line_most`` documents, from that number on.
    line_documents: int = 20
    line_share: float = 0.02
    line_most: int = 1000
    #: A document is depleted if more than this share of its words goes.
    depleted_share: float = 0.5
    least_words: int = 20


# w: hashes of the 8-word windows. Sorted with their places, equal ones are neighbours.
_REPEATED = """
transform(array(array_sort(transform(w, (h, i) -> struct(h, i)))), s ->
  transform(array(array_sort(filter(transform(s, (x, k) -> case
      when k > 0 and s[k - 1].h = x.h then x.i
      when k < size(s) - 1 and s[k + 1].h = x.h then x.i end), p -> p is not null))), p ->
    8L + aggregate(zip_with(slice(p, 2, size(p)), slice(p, 1, size(p) - 1), (a, b) -> least(8, a - b)),
                   0L, (t, x) -> t + x))[0])[0]
"""


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, the base counts of every text, and its lines as (hash, words)."""
    text = docs.select("doc_id", F.col("source").alias("host"), F.coalesce("text", F.lit("")).alias("t"))
    split = text.select(
        "doc_id", "host", "t",
        F.expr(f"filter(split(t, '{_BLANK}+'), x -> x != '')").alias("words"),
        F.expr(f"filter(split(t, '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"))
    return split.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.expr(f"cast(length(regexp_replace(t, '{_BLANK}+', '')) as long)").alias("word_chars"),
        F.expr("cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '')) as long)").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as long)").alias("n_dup_lines"),
        F.expr(f"""
            case when size(words) < 9 then 0L else transform(array(transform(sequence(1, size(words) - 7),
              i -> xxhash64(slice(words, i, 8)))), w ->
                case when size(array_distinct(w)) = size(w) then 0L else {_REPEATED} end)[0] end
            """).alias("n_repeat_words"),
        F.expr(f"""
            transform(lines, l -> transform(array(lower(trim(regexp_replace(l, '{_BLANK}+', ' ')))), x ->
              struct(xxhash64(x) as h, length(x) - length(replace(x, ' ', '')) + 1 as n))[0])
            """).alias("lines"),
    )


def judge(docs: DataFrame, config: QualityConfig | None = None) -> DataFrame:
    """doc_id, base counts, base_failed, n_removed_words, depleted and kept of every row of docs."""
    config = config or QualityConfig()
    counted = written(base_counts(docs).withColumn("uid", F.monotonically_increasing_id()), "quality")
    lines = counted.select("uid", "host", F.explode("lines").alias("l")).select("uid", "host", "l.h", "l.n")
    hosts = counted.groupBy("host").agg(F.count("*").alias("host_documents"))
    often = counted.select("host", F.explode(F.array_distinct(F.expr("transform(lines, x -> x.h)"))).alias("h")) \
        .groupBy("host", "h").agg(F.count("*").alias("holders")).where(F.col("holders") > config.line_documents)
    often = often.join(hosts, often["host"].eqNullSafe(hosts["host"])).select(
        often["host"], "h", "holders", "host_documents").where(
        F.col("holders") > _limit(config))
    often = often.select(F.col("host").alias("_host"), F.col("h").alias("_h"))
    removed = lines.join(often, lines["host"].eqNullSafe(F.col("_host")) & (lines["h"] == F.col("_h"))) \
        .groupBy("uid").agg(F.sum("n").alias("n_removed_words"))
    out = counted.drop("lines").join(removed, "uid", "left").drop("uid")
    out = out.withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    n = F.col("n_words")
    failed = (n < config.least_words) | (100 * F.col("n_repeat_words") > 30 * n)
    depleted = F.col("n_removed_words") > config.depleted_share * n
    return out.withColumns({"base_failed": failed, "depleted": depleted, "kept": ~failed & ~depleted})


def _limit(config: QualityConfig):
    return F.least(config.line_share * F.col("host_documents"), F.lit(float(config.line_most)))


def clean_lines(docs: DataFrame, config: QualityConfig | None = None) -> DataFrame:
    """docs whose text has lost the lines that are too frequent in its host; depleted documents are left out."""
    config = config or QualityConfig()
    counted = written(base_counts(docs).select("host", "lines"), "quality")
    hosts = counted.groupBy("host").agg(F.count("*").alias("host_documents"))
    often = counted.select("host", F.explode(F.array_distinct(F.expr("transform(lines, x -> x.h)"))).alias("h")) \
        .groupBy("host", "h").agg(F.count("*").alias("holders")).where(F.col("holders") > config.line_documents)
    often = often.join(hosts, often["host"].eqNullSafe(hosts["host"])).where(
        F.col("holders") > _limit(config)).select(
        often["host"].alias("_host"), F.col("h").alias("_h"))
    rows = written(docs.withColumn("_uid", F.monotonically_increasing_id()), "quality-rows")
    split = rows.select("_uid", F.col("source").alias("host"), F.posexplode(F.split("text", "\n")).alias("at", "l"))
    norm = F.expr(f"lower(trim(regexp_replace(l, '{_BLANK}+', ' ')))")
    split = split.withColumn("x", norm).withColumn("h", F.xxhash64("x")).withColumn(
        "n", F.when(F.col("x") == "", 0).otherwise(F.length("x") - F.length(F.expr("replace(x, ' ', '')")) + 1))
    marked = split.join(often, split["host"].eqNullSafe(F.col("_host")) & (split["h"] == F.col("_h")), "left")
    gone = F.col("_h").isNotNull() & (F.col("n") > 0)
    texts = marked.groupBy("_uid").agg(
        F.sort_array(F.collect_list(F.when(~gone, F.struct("at", "l")))).alias("left"),
        F.sum("n").alias("n"), F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("lost"))
    texts = texts.select("_uid", F.array_join(F.col("left.l"), "\n").alias("_text"),
                         (F.col("lost") > config.depleted_share * F.col("n")).alias("_depleted"))
    out = rows.join(texts, "_uid", "left").where(~F.coalesce("_depleted", F.lit(False)))
    return out.withColumn("text", F.coalesce("_text", "text")).drop("_uid", "_text", "_depleted")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_words")


#: The same rows in DuckDB.
SQL = r"""
with d as (select doc_id, source as host, coalesce(text, '') as t from documents),
b as (select doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
win as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as k
        from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from b where len(w) >= 9)),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) as c from win) where c > 1),
rw as (select doc_id, sum(least(8, coalesce(nxt - i, 8))) as n_repeat_words
       from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from rep) group by doc_id),
l as (select doc_id, host, lower(trim(regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'))) as x
      from (select doc_id, host, unnest(ls) as x from b)),
f as (select host, x, count(distinct doc_id) as holders from l group by host, x),
h as (select host, count(*) as host_documents from d group by host),
o as (select f.host, f.x from f join h on f.host is not distinct from h.host
      where holders > 20 and (holders > 0.02 * host_documents or holders > 1000)),
r as (select doc_id, sum(length(l.x) - length(replace(l.x, ' ', '')) + 1) as n_removed_words
      from l join o on l.x = o.x and l.host is not distinct from o.host group by doc_id),
m as (select b.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
             coalesce(n_removed_words, 0)::bigint as n_removed_words
      from b left join rw using (doc_id) left join r using (doc_id)),
q as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not n_removed_words > 0.5 * n_words as kept, n_removed_words
from q
"""
