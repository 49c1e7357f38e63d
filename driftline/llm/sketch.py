"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame operations only.

Words are runs between ASCII white space, unchanged. Shingles are five consecutive words, or the whole sequence where
there are fewer; a null or wordless text has none. A sketch keeps every distinct shingle hash below ``KEEP`` of the hash
range, so sketches of parts merge by union and a short text's sketch is comparable with a long one's. The hash is the
first 60 bits of the MD5 of the shingle's words joined by one space.

A fingerprint is the text ``w:m:h,h,...``: number of words, MD5 of all words joined by one space, and the kept hashes
in ascending order as 15 hex digits: under a third of a text of ordinary words. Equal texts have equal fingerprints. Likeness is the Jaccard similarity of the kept
hashes (an unbiased estimate of that of the shingles); where neither keeps any, it is 1 if number and MD5 of the words agree and 0 if not.
Containment is the share of one's kept hashes that the other keeps too (null if it keeps none).

The next document is that with the next smaller doc_id, after the smallest the largest; rows with equal doc_id follow
each other by text hash, null ids come last of all. A single document is followed by itself. An empty table gives an
empty result; other columns are ignored.

Plan. Quantiles of the ids cut the rows into buckets of neighbours, a fixed number for each shuffle partition, and one
shuffle brings each bucket together; its first row also goes to the bucket before it, so that every row finds the next
one by a lead() over its bucket. Sketches are array expressions of one row, so memory is bounded by a text and a bucket
spills as it must.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm import store

WIDTH = 5
#: One in this many hashes is kept.
KEEP = 8
#: Hex digits of a hash.
DIGITS = 15
#: Buckets of neighbouring ids for each shuffle partition.
PER_PARTITION = 8
_BELOW = f"{(1 << 4 * DIGITS) // KEEP:0{DIGITS}x}"


def words_of(text: Column) -> Column:
    """Words of a text; null has none. Its own pattern first trims, so that no empty word is left at the ends."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def kept_hashes(words: Column) -> Column:
    """Ascending kept hashes of the shingles of an array of words."""
    n = F.size(words)
    shingle = lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(WIDTH)))
    places = F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(places, lambda i: F.substring(F.md5(shingle(i).cast("binary")), 1, DIGITS)), lambda h: h < _BELOW)))


def fingerprint(words: Column, kept: Column) -> Column:
    return F.concat(F.size(words).cast("string"), F.lit(":"), F.md5(F.array_join(words, " ").cast("binary")), F.lit(":"), F.array_join(kept, ","))


def hashes_of(print_: Column) -> Column:
    """The kept hashes of a fingerprint."""
    last = F.substring_index(print_, ":", -1)
    return F.when(last == "", F.array().cast("array<string>")).otherwise(F.split(last, ","))


def likeness(a: Column, b: Column) -> Column:
    """Of two fingerprints, 0 to 1."""
    x, y = hashes_of(a), hashes_of(b)
    both = F.size(F.array_intersect(x, y))
    union = F.size(x) + F.size(y) - both
    return F.when(union > 0, both / union).otherwise(F.when(a == b, 1.0).otherwise(0.0))


def containment(a: Column, b: Column) -> Column:
    """Share of a's kept hashes that b keeps too."""
    x = hashes_of(a)
    return F.when(F.size(x) > 0, F.size(F.array_intersect(x, hashes_of(b))) / F.size(x))


def merged(prints: Column) -> Column:
    """Kept hashes of the union of an array of arrays of kept hashes."""
    return F.array_sort(F.array_distinct(F.flatten(prints)))


def sketched(rows: DataFrame, text: str, name: str) -> DataFrame:
    """rows with the column ``name``, the fingerprint of the column ``text``."""
    rows = rows.withColumn("_words", words_of(F.col(text))).withColumn("_kept", kept_hashes(F.col("_words")))
    return rows.withColumn(name, fingerprint(F.col("_words"), F.col("_kept"))).drop("_words", "_kept")


def _bucket(order: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are below order, found in two steps of about sqrt(n) comparisons."""
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[]]
    arrays = F.array(*(F.array(*(F.lit(b) for b in part)).cast("array<long>") for part in parts))
    part = F.size(F.filter(F.array(*(F.lit(part[-1]) for part in parts if part)).cast("array<long>"), lambda b: b < order))
    inside = F.coalesce(F.size(F.filter(F.get(arrays, part), lambda b: b < order)), F.lit(0))
    return part * step + inside


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, fingerprint, next_text, next_fingerprint of each row."""
    spark = docs.sparkSession
    # ~id ascends as id descends, and has no overflow
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("order", F.bitwise_not("doc_id")).withColumn("tie", F.xxhash64("text"))
    many = PER_PARTITION * store.partitions(spark)
    got = docs.agg(F.percentile_approx(F.bitwise_not(F.col("doc_id").cast("long")), [k / many for k in range(1, many)], 10 * many)).first()[0]
    bounds = sorted(set(got or []))
    # null ids follow each other by text hash, which is spread evenly, so they are cut by its ranges
    nulls = F.least(F.floor((F.col("tie") / float(1 << 63) + 1) / 2 * many), F.lit(many - 1)).cast("int")
    rows = rows.withColumn("bucket", F.when(F.col("order").isNull(), len(bounds) + 1 + nulls).otherwise(_bucket(F.col("order"), bounds)))
    # the first row of each bucket, one short row a bucket, is known to every task: it goes to the bucket before it too
    firsts = rows.groupBy("bucket").agg(F.min(F.struct(F.col("order").isNull().alias("null"), "order", "tie")).alias("f"))
    firsts = firsts.withColumn("before", F.lag("bucket").over(Window.orderBy("bucket")))
    firsts = firsts.withColumn("before", F.coalesce("before", F.max("bucket").over(Window.partitionBy(F.lit(0)))))
    firsts = firsts.select(F.col("f.order").alias("_o"), F.col("f.tie").alias("_t"), "before")
    rows = rows.join(F.broadcast(firsts), F.col("order").eqNullSafe(F.col("_o")) & (F.col("tie") == F.col("_t")), "left")
    given = F.struct(F.lit(1).alias("given"), F.col("before").alias("bucket"))
    own = F.struct(F.lit(0).alias("given"), F.col("bucket").alias("bucket"))
    rows = rows.withColumn("to", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, given)))).select("doc_id", "text", "order", "tie", "to.given", "to.bucket")
    dealt = sketched(rows.repartition(store.partitions(spark), "bucket"), "text", "fingerprint")
    along = Window.partitionBy("bucket").orderBy("given", F.col("order").asc_nulls_last(), "tie")
    return dealt.withColumn("next_text", F.lead("text").over(along)).withColumn("next_fingerprint", F.lead("fingerprint").over(along)).where("given = 0")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint, next_fingerprint, edited, edited_fingerprint of each row."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = neighbours(docs).withColumn("n_chars", n.cast("long"))
    pairs = pairs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))).drop("text", "next_text")
    return sketched(pairs, "edited", "edited_fingerprint")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def _sql_words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


_KEPT = f"""list_sort(list_distinct(list_filter(list_transform(
  case when len(w) = 0 then [] else generate_series(1, greatest(len(w) - {WIDTH - 1}, 1)) end,
  lambda i: md5(array_to_string(w[i:i + {WIDTH - 1}], ' '))[1:{DIGITS}]), lambda x: x < '{_BELOW}')))"""

_LIKE = "case when len(list_distinct(list_concat({a}, {b}))) > 0 then len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) when {p} = {q} then 1.0::double else 0.0::double end"

ORACLE_SQL = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
nexts as (
  select doc_id, text, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next_text,
         coalesce(lead(doc_id) over (order by doc_id desc), first_value(doc_id) over (order by doc_id desc)) as next_id from texts),
edits as (
  select *, length(text) - length(text) // 2 as head,
         substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) as edited from nexts),
split as (select *, {_sql_words('text')} as w, {_sql_words('edited')} as we from edits),
kept as (select * exclude (w, we), w as w0, {_KEPT} as h, we from split),
kept2 as (select * exclude (we), we as w from kept),
kept3 as (select *, {_KEPT} as he from kept2),
prints as (
  select doc_id, next_id, text, edited, h, he, len(w0) || ':' || md5(array_to_string(w0, ' ')) || ':' || array_to_string(h, ',') as fingerprint,
         len(w) || ':' || md5(array_to_string(w, ' ')) || ':' || array_to_string(he, ',') as edited_fingerprint from kept3)
select a.doc_id, cast(length(a.text) as bigint) as n_chars, sha256(a.edited) as edited_sha256, a.fingerprint, a.edited_fingerprint,
       cast({_LIKE.format(a='a.h', b='a.he', p='a.fingerprint', q='a.edited_fingerprint')} as double) as near_edited,
       cast({_LIKE.format(a='a.h', b='b.h', p='a.fingerprint', q='b.fingerprint')} as double) as near_next
from prints a join prints b on a.next_id = b.doc_id
"""
