"""Quality rules with thresholds that adapt to each language and source.

The measures of a text come from built-in functions alone and are written once as a slim table. Every rate
is judged on a logarithmic scale: (events + a) / (units + a), where a is what one event adds, so that no
rate is zero; a text without events passes however short it is. A quantile sketch of a group is its
count of texts by logarithmic bucket, each 2 % wide: sketches add up bucket by bucket, in any order and
with the same result, and a quantile read from one is within 1 % of a true one, however many texts there are.

A fence lies REACH times as far above the median as the median lies above the lower quartile, in buckets, but
not less than SPREAD of them (a source whose texts are all alike would else reject the first that differs;
the tables' spreads are 20 to 50 buckets). Both quantiles are taken from the lower half, so that a third of
junk in a source moves them little. A group of fewer than LEAST texts uses the fences of its language,
and a language of fewer those of all texts. Texts that the base rules reject aren't sketched.

Null texts have no words. A null language or source is a group of its own. Repeated rows count as often
as they come. The fences decide kept only where the base rules have not failed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafline.llm.common import GAP, WORD, materialize, read

#: Events, units and what one event adds (a repeated window of three words makes six words repeated).
RATES = {"symbol_rate": ("n_symbols", "word_chars", 1), "dup_line_rate": ("n_dup_lines", "n_lines", 1), "repeat_rate": ("n_repeat_words", "n_words", 6)}
REACH, SPREAD = 4, 6
LEAST = 100
#: Ratio of a bucket's bounds.
GAMMA = 1.02


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of every row.

    Windows are first told apart by XXH64 of their three words: where all hashes of a text differ (most
    texts) no window repeats and nothing is sorted. Else windows are sorted by hash and by their words, those
    with a neighbour of the same words are put back in order, and each covers three words less what the
    next one covers too.
    """
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    df = df.withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    starts = F.slice("w", 1, F.greatest(F.size("w") - 2, F.lit(0)))
    df = df.withColumns({"h": F.transform(starts, lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))), "lines": F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(WORD)))})
    windows = F.transform("h", lambda h, i: F.struct(h.alias("h"), F.concat_ws(" ", F.slice("w", i + 1, 3)).alias("words"), i.alias("i")))
    df = df.withColumn("sorted", F.when(F.size(F.array_distinct("h")) < F.size("h"), F.sort_array(windows)))
    same = lambda e, other: (e["h"] == other["h"]) & (e["words"] == other["words"])
    twice = F.filter(F.transform("sorted", lambda e, j: F.when(same(e, F.get("sorted", j - 1)) | same(e, F.get("sorted", j + 1)), e["i"])), lambda i: i.isNotNull())
    df = df.withColumn("twice", F.sort_array(twice))
    covered = F.aggregate(F.transform("twice", lambda i, j: F.least(F.lit(3), F.coalesce(F.get("twice", j + 1) - i, F.lit(3)))), F.lit(0).cast("long"), lambda a, b: a + b)
    return df.select(
        "doc_id",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", GAP, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def bucket(rate: str) -> Column:
    """Number of the logarithmic bucket of a text's rate: (GAMMA ** (k - 1), GAMMA ** k]."""
    events, units, one = RATES[rate]
    return F.ceil(F.log((F.col(events) + one) / (F.col(units) + one)) / F.lit(math.log(GAMMA))).cast("int")


def rated(measured: DataFrame) -> DataFrame:
    """Adds base_failed, and the bucket of each rate under the rate's name."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", base).withColumns({r: bucket(r) for r in RATES})


def sketches(rates: DataFrame) -> DataFrame:
    """lang, source, rate, bucket, n: sketches of all groups. Those of further tables are added by merged()."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("bucket")) for r in RATES]))
    return rates.where(~F.col("base_failed")).select("lang", "source", each.alias("x")).groupBy("lang", "source", "x.rate", "x.bucket").agg(F.count("*").alias("n"))


def merged(sketched: DataFrame, *by: str) -> DataFrame:
    """The sketches of coarser groups, or of several tables."""
    return sketched.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))


def fences(sketched: DataFrame, *by: str) -> DataFrame:
    """by, rate, texts, fence (a bucket) from each group's quantiles."""
    order = Window.partitionBy(*by, "rate").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = merged(sketched, *by).withColumns({"up_to": F.sum("n").over(order), "texts": F.sum("n").over(Window.partitionBy(*by, "rate"))})
    at = lambda q: F.min(F.when(F.col("up_to") * 4 >= F.col("texts") * q, F.col("bucket")))
    found = counted.groupBy(*by, "rate").agg(F.max("texts").alias("texts"), at(1).alias("_quartile"), at(2).alias("_median"))
    return found.select(*by, "rate", "texts", (F.col("_median") + REACH * F.greatest(F.col("_median") - F.col("_quartile"), F.lit(SPREAD))).alias("fence"))


def group_fences(sketched: DataFrame) -> DataFrame:
    """lang, source, and the fence of each rate under the rate's name, one small row for each group."""
    own = fences(sketched, "lang", "source")
    by_lang = fences(sketched, "lang").select(F.col("lang").alias("_lang"), F.col("rate").alias("_rate"), F.col("texts").alias("_texts"), F.col("fence").alias("_fence"))
    whole = fences(sketched).select("rate", F.col("fence").alias("_whole"))
    met = own.join(by_lang, own["lang"].eqNullSafe(by_lang["_lang"]) & (own["rate"] == by_lang["_rate"])).join(whole, "rate")
    chosen = F.when(F.col("texts") >= LEAST, F.col("fence")).when(F.col("_texts") >= LEAST, F.col("_fence")).otherwise(F.col("_whole"))
    return met.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rate") == r, chosen)).alias(r) for r in RATES])


def judge(docs: DataFrame) -> DataFrame:
    """The measures, buckets, base_failed and kept of every row."""
    rates = materialize(rated(measures(docs)), "rules-measures")
    limits = materialize(group_fences(materialize(sketches(rates), "rules-sketches")), "rules-fences")
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[F.col(r).alias(f"{r}_fence") for r in RATES])
    met = rates.join(limits, rates["lang"].eqNullSafe(limits["_lang"]) & rates["source"].eqNullSafe(limits["_source"]), "left")
    within = F.lit(True)
    for r in RATES:
        within = within & ((F.col(RATES[r][0]) == 0) | (F.col(r) <= F.col(f"{r}_fence")))
    # A group without fences holds only texts that the base rules reject.
    return met.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False))).drop("_lang", "_source")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _fence_sql(name: str, by: str) -> str:
    """A group's fences by counting texts rather than buckets: the same order statistics."""
    keys = f"{by}, rate" if by else "rate"
    return f"""{name} AS (
  SELECT {keys}, count(*) AS texts, min(bucket) FILTER (4 * k >= texts_) AS q1, min(bucket) FILTER (2 * k >= texts_) AS q2
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY bucket) AS k, count(*) OVER (PARTITION BY {keys}) AS texts_ FROM b) GROUP BY {keys}
)"""


ORACLE = rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS words FROM t WHERE len(w) > 2
), n AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, words) AS times FROM g
), covered AS (
  SELECT rid, count(DISTINCT j) AS words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM n WHERE times > 1) GROUP BY rid
), m AS (
  SELECT t.rid, doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
  FROM t LEFT JOIN covered USING (rid)
), r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), b AS (
  {" UNION ALL ".join(f"SELECT rid, lang, source, '{k}' AS rate, CAST(ceil(ln(({e} + {a}) / ({u} + {a})) / {math.log(GAMMA)!r}) AS INTEGER) AS bucket, {e} AS events FROM r WHERE NOT base_failed" for k, (e, u, a) in RATES.items())}
), {_fence_sql("own", "lang, source")}, {_fence_sql("by_lang", "lang")}, {_fence_sql("whole", "")}, f AS (
  SELECT own.lang, own.source, own.rate,
         CASE WHEN own.texts >= {LEAST} THEN own.q2 + {REACH} * greatest(own.q2 - own.q1, {SPREAD})
              WHEN by_lang.texts >= {LEAST} THEN by_lang.q2 + {REACH} * greatest(by_lang.q2 - by_lang.q1, {SPREAD})
              ELSE whole.q2 + {REACH} * greatest(whole.q2 - whole.q1, {SPREAD}) END AS fence
  FROM own JOIN by_lang ON own.lang IS NOT DISTINCT FROM by_lang.lang AND own.rate = by_lang.rate JOIN whole ON own.rate = whole.rate
), bad AS (
  SELECT DISTINCT rid FROM b JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source AND b.rate = f.rate WHERE bucket > fence AND events > 0
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept
FROM r
"""
