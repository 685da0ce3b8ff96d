"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target (its weight's share of all words, at most ``max_copies``
times its own words, the excess reshared by weight).  A source's rate is target / words:
each document is allocated floor(rate) certain whole copies, and the words left of the
target are the source's room, for one more copy of some of its documents.

Inclusion is unequal: a document's probability p rises with its size class, as the bits of its
size + 1, so that long documents are settled first and short ones are left to fill the
room's last words.  A histogram of words per class scales p so that the expected words meet the room;
classes that reach 1 are certain.  Documents are ranked by the random odds divided by the
inclusion odds, U / (1 - U) / (p / (1 - p)), with U a hash of the id; certain ones come first.

The sample's size is fixed in words.  Rounds take the lowest ranks that fit the room left, in
turn among documents of at most half of it and among all that fit: a document that does not fit
is passed, and each pair of rounds halves the room.  A source ends when none of its documents left fits.

Scale: one narrow table (id, source, size) is kept, the texts are read once for it.  A round finds
a source's cut in two steps, without a sort of a whole source: words per rank bucket
(partial aggregation) give the bucket in which the cut falls, and only that bucket is
ordered.  Documents taken or too long leave the table after each pair.  The decision itself is a
comparison of each row with its source's few cuts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_SPACES, checkpointed, packed, small

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
SEED = "mix"
#: Sources whose cuts (some kB each) are broadcast, counted; more are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NON_SPACES)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size) rows; one row per source.

    Capped sources are a prefix of the order by cap / weight, so one running sum settles the
    resharing.  The unpartitioned windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    big = "decimal(38,0)"
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w.cast(big)).withColumn("cap", (F.col("source_size") * max_copies).cast(big))
    by_cap = Window.orderBy(F.col("cap").cast("double") / F.col("w").cast("double"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.sum(F.col("source_size").cast(big)).over(everything))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("weigh", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
           .withColumn("capped", F.col("cap").cast("double") * F.col("weigh").cast("double") <= F.col("w").cast("double") * F.col("left").cast("double")))
    free = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything).cast("double")
    rest = (F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))).cast("double")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("w").cast("double") * rest / free)
    return per.select("source", "source_size", target.alias("target"))


def uniform(id_col: Column, seed: str) -> Column:
    """A number strictly between 0 and 1 from the id: the same on every run and layout."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(id_col.cast("string"), F.lit("null")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 48)


def size_class(size: Column) -> Column:
    """The bits of a size."""
    return F.length(F.bin(size))


def inclusion(base: DataFrame, cuts: DataFrame) -> DataFrame:
    """(source, odds: map of size class to inclusion probability) of the sources with room.

    Classes are certain from the largest on, so running sums over a source's classes (at most 63) settle which."""
    big = "decimal(38,0)"
    per = base.filter("size > 0").groupBy("source", size_class(F.col("size")).alias("k")).agg(F.sum("size").cast(big).alias("n"))
    per = per.join(cuts.filter("room > 0").select(F.col("source").alias("s"), F.col("room").cast(big).alias("room")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    per = per.withColumn("g", (F.col("k") + 1).cast("decimal(10,0)"))
    mine = Window.partitionBy("source")
    order = mine.orderBy(F.col("k").desc())
    weight = (F.col("n").cast("decimal(27,0)") * F.col("g")).cast(big)
    rest = F.col("room") - F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum(weight).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("certain", F.col("g").cast("double") * rest.cast("double") >= after.cast("double"))
    left = (F.col("room") - F.coalesce(F.sum(F.when(F.col("certain"), F.col("n"))).over(mine), F.lit(0))).cast("double")
    free = F.sum(F.when(~F.col("certain"), weight)).over(mine).cast("double")
    per = per.withColumn("p", F.when(F.col("certain"), F.lit(1.0)).otherwise(F.col("g").cast("double") * left / free))
    return per.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("k", "p"))).alias("odds"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
        weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Returns (rows, cuts).  rows: id, source, size, source_size, target, copies of every row;
    cuts: one row per source, which :func:`apply_cuts` lays on any table of the same rows.

    Null and empty texts have size 0 and take no words; a null source is a source of its own,
    after all others; rows of equal id, source and size stand and fall together (where such a group is
    first in rank and does not fit, its source goes on with documents of at most half the size allowed so far); an empty
    table gives an empty result; other columns are not read."""
    base = checkpointed(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")))
    targets = checkpointed(source_targets(base, weights, max_copies))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    cuts = targets.withColumn("whole", F.floor(rate + 1e-12))
    cuts = cuts.withColumn("room", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 1e-6))
    odds = inclusion(base, cuts)
    cuts = cuts.join(odds.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    cuts = checkpointed(cuts.withColumn("cap", F.col("room")).withColumn("picks", F.array().cast(_picks(base))))
    known = _sent(cuts)
    sent = F.broadcast if known is not cuts else (lambda df: df)
    left = checkpointed(_ranked(base, known, seed).filter("q IS NOT NULL AND size <= cap").select("id", "source", "size", "q", "bucket"))
    while not left.isEmpty():  # at most some 3 log2(room) times
        for half in (True, False):
            cuts = _round(left, cuts, sent, half)
        left = _with(left, sent(cuts)).filter((F.col("size") <= F.col("cap")) & ~_in_sample(F.slice("picks", -2, 2)))
        left = checkpointed(left.select("id", "source", "size", "q", "bucket"))
    rows = _ranked(base, sent(cuts), seed).withColumn("copies", _copies())
    return rows.select("id", "source", "size", "source_size", "target", "copies"), cuts


def _picks(base: DataFrame) -> str:
    """The type of a source's cuts: the largest size allowed, the bucket and the last row of the sample in it (null: none of it)."""
    kind = base.schema["id"].dataType.simpleString()
    return f"array<struct<size:bigint,bucket:bigint,last:struct<q:double,known:boolean,id:{kind},size:bigint>>>"


def _sent(cuts: DataFrame) -> DataFrame:
    """Cuts marked for broadcast where their number is small enough."""
    return small(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts


def _with(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    return rows.join(cuts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _round(left: DataFrame, cuts: DataFrame, sent, half: bool) -> DataFrame:
    """The cuts with one more pick of every source: its lowest ranks that fit the room, among the documents of at most
    half the room or of any size that fits."""
    allowed = F.least(F.col("cap"), F.floor(F.col("room") / 2)) if half else F.col("cap")
    cuts = cuts.withColumn("allowed", allowed)
    able = _with(left, sent(cuts.select("source", "room", "cap", "allowed", "picks"))).filter(F.col("size") <= F.col("allowed"))
    if not half:  # what the first round of the pair took is still in the table
        able = able.filter(~_in_sample(F.slice("picks", -1, 1)))
    share = able.groupBy("source", "bucket").agg(F.sum("size").alias("n"), F.first("room").alias("room"))
    share = share.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("bucket")))
    reach = share.groupBy("source").agg(
        F.sum("n").alias("total"), F.min(F.when(F.col("upto") > F.col("room"), F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")))).alias("x"))
    cuts = checkpointed(cuts.join(reach.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    inside = _with(left, sent(cuts.select("source", "room", "allowed", "picks", "x"))).filter(
        (F.col("size") <= F.col("allowed")) & (F.col("bucket") == F.col("x.bucket")))
    if not half:
        inside = inside.filter(~_in_sample(F.slice("picks", -1, 1)))
    place = Window.partitionBy("source").orderBy("q", F.col("id").asc_nulls_first(), "size")
    inside = inside.withColumn("upto", F.col("x.before") + F.sum("size").over(place.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    last = inside.filter("upto <= room").groupBy("source").agg(F.max(_place()).alias("last"), F.max("upto").alias("taken"))
    cuts = cuts.join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    # no eligible document: a pick of size -1, which fits none
    pick = F.struct(F.when(F.col("total").isNull(), F.lit(-1)).otherwise(F.col("allowed")).cast("bigint").alias("size"),
                    F.col("x.bucket").cast("bigint").alias("bucket"), F.col("last"))
    took = F.coalesce("taken", "x.before", "total", F.lit(0))
    cuts = cuts.withColumn("took", took).withColumn("picks", F.concat("picks", F.array(pick)))
    cuts = cuts.withColumn("room", F.col("room") - F.col("took"))
    cap = F.col("cap") if half else F.when(F.col("took") == 0, F.floor(F.col("cap") / 2)).otherwise(F.col("cap"))
    return checkpointed(cuts.withColumn("cap", F.least(cap, F.col("room"))).drop("allowed", "total", "x", "last", "taken", "took"))


def _ranked(base: DataFrame, cuts: DataFrame, seed: str) -> DataFrame:
    """Rows with their source's cuts, their rank q (null: never drawn) and its bucket.  Certain rows have
    q in [-1, 0), in the order of U."""
    joined = _with(base, cuts).withColumn("p", F.when(F.col("size") > 0, F.col("odds")[size_class(F.col("size"))]))
    u, p = uniform(F.col("id"), seed), F.col("p")
    joined = joined.withColumn("q", F.when(p >= 1, u - 1.0).when(p > 0, u / (1.0 - u) * ((1.0 - p) / p)))
    q = F.col("q")
    return joined.withColumn("bucket", F.when(q < 0, F.floor(q * BUCKETS)).otherwise(F.least(F.floor(q / (1.0 + q) * BUCKETS), F.lit(BUCKETS - 1))))


def _place() -> Column:
    return F.struct("q", F.col("id").isNotNull().alias("known"), "id", "size")


def _in_sample(picks: Column) -> Column:
    """Whether a row lies before one of the cuts that its size is allowed in."""
    here, size, bucket = _place(), F.col("size"), F.col("bucket")
    return F.coalesce(F.exists(picks, lambda c: (size <= c["size"]) & (
        c["bucket"].isNull() | (bucket < c["bucket"]) | ((bucket == c["bucket"]) & c["last"].isNotNull() & (here <= c["last"])))), F.lit(False))


def _copies() -> Column:
    return (F.col("whole") + (F.col("q").isNotNull() & _in_sample(F.col("picks"))).cast("long")).cast("long")


def apply_cuts(docs: DataFrame, cuts: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               seed: str = SEED, out: str = "copies") -> DataFrame:
    """``docs`` with all its columns and the number of copies the mix takes, in one narrow pass
    (no text is shuffled where the sources are few enough to broadcast).  Columns of ``docs`` named
    as the new ones (in any letter case) are replaced."""
    new = (out, "size", "source_size", "target")
    row = packed(docs, new)
    cols = [c for c in docs.columns if c.lower() not in {n.lower() for n in new}]
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), row.alias("row"))
    rows = _ranked(base, _sent(cuts), seed).withColumn("copies", _copies())
    return rows.select(*[F.col("row").getField(c).alias(c) for c in cols], F.col("copies").alias(out),
                       "size", "source_size", "target")
