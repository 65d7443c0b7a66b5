"""Mixing sources to target weights: whole epochs, then weighted sampling without replacement (Efraimidis-Spirakis)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import prefix_sums, ranked, table
from morbidity.sources.writers import stage

WEIGHTS = (5, 2, 1)  # of the sources in order of name, repeating
EPOCHS = 3  # a source is taken at most so often
SEED = "mix-1"
QUALITY = {1: 2.0, 0: 0.5}  # sampling weight by label; 1 without label


def n_words(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) for (source, source_size): the whole size shared by weight. What a source can't take
    within its epochs goes to the others by weight, until no source is above. The driver only gets sums."""
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    rows = ranked(sizes.withColumn("__last", F.col("source").isNull()), "__rank", "__last", "source")
    rows = stage(rows.withColumn("w", kinds[(F.col("__rank") % len(weights)).cast("int")]), "sources")
    cap = epochs * F.col("source_size")
    total, level = rows.agg(F.sum("source_size"), F.sum("source_size") / F.sum("w")).first()
    capped = -1
    while True:
        full = F.col("w") * F.lit(level or 0.0) > cap
        n, taken, left = rows.agg(F.count_if(full), F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(~full, F.col("w")))).first()
        if n == capped or not left:
            break
        capped, level = n, (total - taken) / left
    return rows.select("source", "source_size", F.least(F.col("w") * F.lit(level or 0.0), cap.cast("double")).alias("target"))


def mix_rows(rows: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """(rid, source, size, quality) with ``source_size``, ``target`` and ``taken``, the words of the row that the mix takes.

    Each source is taken whole as often as its target allows. For the rest, rows come in order of -ln(u) / quality, where u is drawn
    from the row's ``rid`` and the seed, until their sizes have reached it; the last one is taken if that comes nearer.
    So a source misses its target by half a row's size at most, and reruns agree. Null is a source, the last by name.
    """
    rows = stage(rows, "mixed")
    wanted = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), F.col("rid"))), 1, 12), 16, 10).cast("double")
    key = -F.log((draw + 0.5) / float(1 << 48)) / F.col("quality")
    keyed = rows.withColumn("__key", key)
    summed = prefix_sums(keyed, "before", "size", "source", "__key", "rid", "size")
    both = summed.withColumnRenamed("source", "__source").join(wanted, F.col("__source").eqNullSafe(F.col("source"))).drop("__source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    more = F.col("before") + F.col("size") / 2 <= F.col("target") - whole * F.col("source_size")
    taken = F.col("size") * (whole + F.when((whole < epochs) & more, 1).otherwise(0))
    return both.withColumn("taken", taken.cast("long")).drop("before", "__key")


def quality_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``quality`` from the label of its id; of several labels the best counts."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.max("quality").alias("__q"))
    value = F.coalesce(*[F.when(F.col("__q") == q, F.lit(v)) for q, v in QUALITY.items()], F.lit(1.0))
    return docs.drop("quality").join(known, F.col("doc_id") == F.col("__id"), "left").withColumn("quality", value).drop("__id", "__q")


def mix_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, with their columns.

    A row of ``docs`` is drawn by id, so rows that share an id come together or apart only at the margin. A document without
    words has nothing that could be taken, and is left out.
    """
    sized = quality_of(docs.select(F.col("doc_id"), "source", n_words().alias("size"), _rid().alias("rid")), labels)
    taken = mix_rows(sized.drop("doc_id")).where("taken > 0")
    times = taken.groupBy(F.col("rid").alias("__taken")).agg(F.max(F.expr("taken div size")).cast("int").alias("__times"))
    kept = docs.withColumn("__rid", _rid()).join(times, F.col("__rid") == F.col("__taken"))
    copies = kept.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return copies.select(*docs.columns)


def _rid():
    """What names a row in the draw."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), F.md5(F.coalesce("text", F.lit("")))))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    sized = quality_of(docs.select("doc_id", "source", n_words().alias("size"), _rid().alias("rid")), table(spark, sf_dir, "labels"))
    return mix_rows(sized).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
with sized as (
  select doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
    coalesce(cast(doc_id as varchar), concat('null', md5(coalesce(text, '')))) as rid
  from documents),
known as (select doc_id, max(quality) as q from labels where doc_id is not null group by doc_id),
draws as (
  select s.*, -ln((cast(('0x' || substr(md5('mix-1|' || rid), 1, 12)) as bigint) + 0.5) / 281474976710656.0)
    / case q when 1 then 2.0 when 0 then 0.5 else 1.0 end as k
  from sized s left join known l on s.doc_id = l.doc_id),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
    [5.0, 2.0, 1.0][1 + (row_number() over (order by source is null, source) - 1) % 3]::double as w
  from sized group by source),
sorted as (
  select *, row_number() over o as i, sum(source_size) over () as total, sum(w) over () as all_w,
    coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0) as full_size,
    coalesce(sum(w) over (o rows between unbounded preceding and 1 preceding), 0) as full_w
  from sources window o as (order by source_size / w, source nulls last)),
level as (
  select cast(total - full_size as double) / (all_w - full_w) as v from sorted
  where (cast(total - full_size as double) / (all_w - full_w)) * w <= 3 * source_size order by i limit 1),
wanted as (
  select source, source_size, least(w * coalesce((select v from level), 0), cast(3 * source_size as double)) as target from sources),
summed as (
  select d.*, source_size, target,
    coalesce(sum(size) over (partition by d.source order by k, rid, size rows between unbounded preceding and 1 preceding), 0) as before,
    case when source_size > 0 then floor(target / source_size) else 0 end as whole
  from draws d join wanted w on d.source is not distinct from w.source)
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(size * (whole + case when whole < 3 and before + size / 2.0 <= target - whole * source_size then 1 else 0 end) as bigint) as taken
from summed
"""
