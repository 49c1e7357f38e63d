"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

A document's size is the number of runs of characters that are no ASCII white space (null: 0). Sources, in code point order with
null last, weigh ``WEIGHTS`` (5, 2, 1, repeating) and share the sum of all sizes; a target stops at ``MOST`` (3) times
its source's size, and the excess is shared again by weight until none is above.

Every document of a source is expected target / source size times, so the expected copies of the first k documents are
k times that. Within a source documents are ordered by size and doc_id (nulls last), which spreads the picks evenly over short and
long ones; one offset in [0, 1), drawn from the source's name and ``SEED``, is added to each prefix sum; a document is
taken once for each integer that its own step crosses. So no document is taken more than MOST times, and runs agree.

A source whose documents have no words has the target 0 and none of its documents is taken. Rows that repeat a doc_id
are documents of their own; ties in size and doc_id are broken by the text's hash, and equal rows are interchangeable.
An empty table gives an empty result; other columns are ignored by ``mix`` and kept by ``sample``.

Plan. One scan computes sizes, which are written without the text. The order statistics come from a range partitioning
of these rows, so that a source with a third of all documents is spread over many tasks; only one row per source and
range meets in a window. The number of sources must fit one task (they are aggregated first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm import store

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 20240229


def size_of(text: Column) -> Column:
    """Number of words. A text without white space at its ends has one word more than runs of white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, target of each row (source, source_size): water-filling in closed form.

    Sources are sorted by the level at which they fill, most * size / weight. Going up, a source is full if that is no
    more than what the rest would get per weight unit: the total, less the caps of the sources below, over the weights
    from it on. All full ones have their cap, the others share what remains.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    cap = most * F.col("source_size").cast("double")
    rows = sources.withColumn("weight", weight).withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight"))
    up = Window.orderBy("fill", F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    rows = rows.withColumn("below", F.coalesce(F.sum("cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("weights", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("level", (F.sum(F.col("source_size").cast("double")).over(every) - F.col("below")) / F.col("weights"))
    rows = rows.withColumn("full", F.col("fill") <= F.col("level"))
    rest = F.min(F.when(~F.col("full"), F.struct("fill", "level"))).over(every)["level"]
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * rest).alias("target"))


def offset(source: Column) -> Column:
    """In [0, 1), from the first 32 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(source, F.lit("\0"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, tie (hash of the text), size, source_size, target, copies, taken of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("tie"), size_of(F.col("text").cast("string")).alias("size"))
    rows = store.settle(rows, "sizes")
    shares = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n")).select("source", "source_size"))
    order = [F.col("size").asc(), F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    placed = store.ranked(rows, order, within=["source"], name="placed")
    shares = shares.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).withColumn("offset", offset(F.col("source")))
    out = placed.join(shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    crossed = lambda k: F.floor(k * F.col("rate") + F.col("offset"))
    copies = crossed(F.col("rank")) - crossed(F.col("rank") - 1)
    return out.withColumn("copies", copies).select("doc_id", "source", "tie", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def sample(docs: DataFrame) -> DataFrame:
    """docs with every row as often as the mix takes it, all columns kept."""
    own = "_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    got = mix(docs).groupBy("doc_id", "source", "tie").agg(F.sum("copies").alias(f"{own}copies"), F.count(F.lit(1)).alias(f"{own}rows"))
    got = got.withColumnsRenamed({c: own + c for c in ("doc_id", "source", "tie")}).where(F.col(f"{own}copies") > 0)
    got = store.settle(got, "copies")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(f"{own}doc_id")) & docs["source"].cast("string").eqNullSafe(F.col(f"{own}source")) & (F.xxhash64(docs["text"]) == F.col(f"{own}tie"))
    joined = docs.join(got, same)
    copies, rows = F.col(f"{own}copies"), F.col(f"{own}rows")
    if got.where(rows > 1).take(1):
        # rows that are equal in doc_id, source and text share their copies evenly, the first of them, by the hash of all
        # columns, taking what is over; they are numbered over ranges, so that no task needs all of them
        key = [f"{own}doc_id", f"{own}source", f"{own}tie"]
        several = joined.where(rows > 1).select(*(docs[c].alias(f"{own}c{k}") for k, c in enumerate(docs.columns)), *key, copies, rows)
        whole = [f"{own}c{k}" for k in range(len(docs.columns))]
        several = store.ranked(several, [F.xxhash64(*whole).asc()], within=key, name="several")
        several = several.withColumn(f"{own}copies", F.floor(copies / rows) + (F.col("rank") <= copies % rows).cast("long")).where(copies > 0)
        several = several.select(*(F.col(w).alias(c) for w, c in zip(whole, docs.columns, strict=True)), copies)
        joined = joined.where(rows == 1).select(*(docs[c] for c in docs.columns), copies).unionByName(several)
        return joined.withColumn(f"{own}each", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*docs.columns)
    return joined.withColumn(f"{own}each", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*(docs[c] for c in docs.columns))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken (0 to MOST times), all columns kept; wordless documents and those of a
    source without words are never taken, rows that repeat a doc_id are documents of their own, an empty table stays empty."""
    return sample(docs)


ORACLE_SQL = f"""
with sized as (
  select doc_id, source, text, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size from documents),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighed as (
  select source, source_size, 3 * source_size::double as cap,
         [5.0::double, 2.0::double, 1.0::double][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight from sources),
filled as (select *, cap / weight as fill from weighed),
levels as (
  select *, (sum(source_size::double) over () - coalesce(sum(cap) over (order by fill, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by fill, source nulls last rows between current row and unbounded following) as level from filled),
rest as (select min_by(level, fill) as level from levels where fill > level),
shares as (
  select l.source, l.source_size, case when fill <= l.level then cap else weight * rest.level end as target,
         cast(('0x' || md5('{SEED}:' || coalesce(l.source, chr(0)))[1:8]) as bigint)::double / 4294967296 as "offset"
  from levels l left join rest on true),
placed as (select *, row_number() over (partition by source order by size, doc_id nulls last) as k from sized)
select p.doc_id, p.size, s.source_size, s.target,
       cast((floor(k * r + s."offset") - floor((k - 1) * r + s."offset")) * p.size as bigint) as taken
from placed p join (select *, case when source_size > 0 then target / source_size else 0 end as r from shares) s on p.source is not distinct from s.source
"""
