"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key divided by its quality weight; sorted by
key within a source, the first documents are a weighted sample without
replacement. A source whose target holds whole epochs takes all its documents
that often; the rest of the target is a token budget, filled by prefix sums of
sizes in key order. The first document that exceeds the budget is left out and the
prefix sums go on over those behind it that fit the gap, in rounds, until the gap is
below a ``NEAR``-th of the target; a last document that fits the gap best is added
where it brings the source nearer to its target.

Equal rows (same id, source and text) share a key: they are one group with a
count, and a group in which the budget ends gives a part of its rows.

A source may hold any share of the rows, so no task sorts one: keys are cut
into ``STRIPES`` ordered stripes of the key's logarithm, in which no weight crowds
any; the stripes' sums are prefix-summed (at most so many rows for each source), and
only the stripe in which the budget ends is sorted. The targets are found by
aggregates over sources; the driver sees single numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.llm import common

STRIPES = 1 << 15
MAX_EPOCHS = 3
NEAR = 1000
ROUNDS = 24
SEED = 17
#: Logarithms of keys that the stripes span; beyond them lie less than one key in 10^8.
LOW, HIGH = -20.0, 6.0

ROW = "struct<stripe:int,key:double,doc_id:bigint,size:bigint>"


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1: less for a large share of markup characters or few letters."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    marks = F.regexp_count(t, F.lit(r"[#*$%&|<>!]"))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(4.0) * marks / n)


def _sized_columns(seed: int) -> list[Column]:
    u = common.unit_interval(F.lit(seed), F.col("doc_id").cast("long"), F.xxhash64("text"))
    key = -F.log(u) / quality_weight(F.col("text"))
    stripe = F.floor((F.log(key) - LOW) / (HIGH - LOW) * STRIPES)
    stripe = F.greatest(F.lit(0), F.least(F.lit(STRIPES - 1), stripe)).cast("int")
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), common.n_words(F.col("text")).alias("size"), key.alias("key"), stripe.alias("stripe")]


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The narrow table that sampling works on: doc_id, source, size, key, stripe."""
    return docs.select(*_sized_columns(seed))


def targets(sums: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(source, source_size, target), one row for each source, from sums (source, weight).

    Sources by code point, null last, weigh 1, 2, 3, repeating; targets share the
    total in proportion, none above ``MAX_EPOCHS`` times its source's size: the least
    level L is raised until min(most, L * weight) adds up.
    """
    sizes = sums.groupBy("source").agg(F.sum("weight").alias("source_size"))
    # ids of sorted rows: partition and place; so ranks need no task that holds all sources
    ordered = scratch.write(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("id", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("id", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = ordered.withColumn("part", part).join(parts, "part").select("source", "source_size", (rank % 3 + 1).alias("w"))
    ranked = scratch.write(ranked, "ranked")
    most = F.col("source_size") * MAX_EPOCHS
    share, weights, full = 0.0, 1, -1
    while True:
        level = F.lit(float(share)) * F.col("w") / F.lit(float(weights))
        over = (level > most) & (F.col("source_size") > 0)
        got = ranked.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, most)).alias("held"),
            F.sum(F.when(~over & (F.col("source_size") > 0), F.col("w"))).alias("w"),
            F.count(F.when(over, 1)).alias("full"),
        ).first()
        if got["full"] == full or not got["w"]:
            break
        share, weights, full = got["total"] - (got["held"] or 0), got["w"], got["full"]
    target = F.when(F.col("source_size") > 0, F.least(most.cast("double"), level)).otherwise(F.lit(0.0))
    return ranked.select("source", "source_size", target.alias("target"))


def _row() -> Column:
    return F.struct("stripe", "key", "doc_id", "size")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row beside its source's plan, which is broadcast only while the sources are few."""
    p = common.few(plan.withColumnRenamed("source", "plan_source"), 20_000)
    return rows.join(p, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")


def _whole() -> Column:
    """Whether the fraction takes all rows of a row's group."""
    inside = F.exists("rounds", lambda r: (F.col("size") <= r["gap"]) & (_row() <= r["last"]))
    return (F.col("budget") > 0) & (F.col("size") > 0) & inside


def _some(extra: Column | None = None) -> Column:
    """How many rows of a row's group the fraction takes if it doesn't take all."""
    parts = F.aggregate("rounds", F.lit(0).cast("long"), lambda n, r: n + F.when(r["part"] == _row(), r["rows"]).otherwise(F.lit(0)))
    return parts if extra is None else parts + F.when(extra, 1).otherwise(0)


def _round(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan after one more round of prefix sums over the rows that fit the gap."""
    open_ = F.col("gap") * NEAR > F.col("target")
    rows = _with_plan(groups, plan.where(open_).select("source", "gap", "budget", "rounds"))
    rows = rows.where((F.col("size") > 0) & (F.col("size") <= F.col("gap")) & ~_whole()).withColumn("weight", F.col("size") * F.col("n"))
    upto = Window.partitionBy("source").orderBy("stripe")  # at most STRIPES rows
    sums = rows.groupBy("source", "gap", "stripe").agg(F.sum("weight").alias("weight")).withColumn("upto", F.sum("weight").over(upto))
    edge = sums.groupBy("source").agg(
        F.min(F.when(F.col("upto") > F.col("gap"), F.struct("stripe", (F.col("upto") - F.col("weight")).alias("before")))).alias("edge"),
        F.max("upto").alias("all"),
    )
    edge = edge.withColumnRenamed("source", "edge_source")
    inside = rows.join(common.few(edge, 20_000), F.col("source").eqNullSafe(F.col("edge_source")) & (F.col("stripe") == F.col("edge.stripe")))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    inside = inside.withColumn("upto", F.col("edge.before") + F.sum("weight").over(order))
    fits = F.col("upto") <= F.col("gap")
    part = F.floor((F.col("gap") - F.col("upto") + F.col("weight")) / F.col("size"))
    ends = inside.groupBy(F.col("source").alias("end_source")).agg(
        F.max(F.when(fits, _row())).alias("last"),
        F.max(F.when(fits, F.col("upto"))).alias("full"),
        F.min(F.when(~fits, F.struct(_row().alias("row"), part.alias("rows")))).alias("next"),
    )
    same = lambda k: F.col("source").eqNullSafe(F.col(k))
    far = [F.lit(float("inf")).alias("key"), F.lit((1 << 63) - 1).alias("doc_id"), F.lit((1 << 63) - 1).alias("size")]
    below = F.struct((F.col("edge.stripe") - 1).alias("stripe"), *far).cast(ROW)
    all_ = F.struct(F.lit(STRIPES).alias("stripe"), *far).cast(ROW)
    # nothing for sources that had no row to add
    some = F.col("next.rows") > 0
    last = F.when(F.col("edge").isNull(), all_).otherwise(F.coalesce(F.col("last").cast(ROW), below))
    done = F.when(F.col("edge").isNull(), F.col("all")).otherwise(F.coalesce("full", "edge.before") + F.coalesce(F.col("next.rows") * F.col("next.row.size"), F.lit(0)))
    step = F.struct("gap", last.alias("last"), F.when(some, F.col("next.row").cast(ROW)).alias("part"), F.coalesce("next.rows", F.lit(0)).cast("long").alias("rows"))
    out = plan.join(edge, same("edge_source"), "left").join(ends, same("end_source"), "left")
    moved = F.col("all").isNotNull()
    return out.select(
        "source",
        "source_size",
        "target",
        "epochs",
        "budget",
        F.when(moved, F.col("gap") - done).otherwise(F.col("gap")).alias("gap"),
        F.when(moved, F.concat("rounds", F.array(step))).otherwise(F.col("rounds")).alias("rounds"),
        moved.alias("moved"),
    )


def mix(docs: DataFrame, seed: int = SEED, scratch: common.Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The narrow table (doc_id, source, size, ...) with copies, and the plan of each source.

    The plan has a row for each source: source_size, target, epochs, budget and gap;
    for each round the gap it had to fill, the last group that it took whole, and of
    the next how many rows; and one filler row. Null sources are a source of their own
    (the last), null and empty texts have size 0 and go with the whole epochs of their
    source. Ties of the key are ordered by id and size; equal rows are told apart by
    number only, so any of them may be taken. Very long texts are counted whole. An
    empty table gives no rows.
    """
    scratch = scratch or common.Scratch(docs.sparkSession)
    narrow, plan = _planned(docs, seed, scratch)
    return _copies(_with_plan(narrow, plan), plan, scratch), plan


def _planned(docs: DataFrame, seed: int, scratch: common.Scratch) -> tuple[DataFrame, DataFrame]:
    """The narrow table and the plan of each source."""
    narrow = scratch.write(sized(docs, seed), "sizes")
    groups = scratch.write(narrow.groupBy("source", "stripe", "key", "doc_id", "size").agg(F.count("*").alias("n")), "groups")
    plan = targets(groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("weight")), scratch)
    size, none = F.col("source_size"), F.array().cast(f"array<struct<gap:double,last:{ROW},part:{ROW},rows:bigint>>")
    epochs = F.when(size > 0, F.least(F.floor(F.col("target") / size + F.lit(1e-12)), F.lit(MAX_EPOCHS))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("epochs", epochs)
    budget = F.when(F.col("epochs") >= MAX_EPOCHS, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * size))
    plan = scratch.write(plan.withColumn("budget", budget).withColumn("gap", budget).withColumn("rounds", none).withColumn("moved", F.lit(True)), "plan")
    for _ in range(ROUNDS):
        plan = scratch.write(_round(groups, plan), "plan")
        if plan.where(F.col("moved") & (F.col("gap") * NEAR > F.col("target"))).isEmpty():
            break
    left = F.col("n") - _some()
    rest = _with_plan(groups, plan).where(~_whole() & (F.col("size") > 0) & (F.col("budget") > 0) & (F.col("size") < 2 * F.col("gap")) & (left > 0))
    one = F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), _row().alias("row"), (left == 1).alias("whole"))
    fill = rest.groupBy(F.col("source").alias("fill_source")).agg(F.min(one).alias("fill"))
    plan = plan.join(fill, F.col("source").eqNullSafe(F.col("fill_source")), "left").drop("fill_source", "moved")
    plan = scratch.write(plan, "plan-filled")
    scratch.keep(narrow, plan)
    return narrow, plan


def _copies(rows: DataFrame, plan: DataFrame, scratch: common.Scratch) -> DataFrame:
    """How often each row is taken.

    Rows of groups of which only a part is taken are written on their own and numbered
    by file and place, so no group, however large, is in one task.
    """
    filler = F.coalesce(F.col("fill.row") == _row(), F.lit(False))
    whole = _whole() | (filler & F.coalesce(F.col("fill.whole"), F.lit(False)))
    rows = rows.withColumn("some", F.when(whole, F.lit(-1)).otherwise(F.when(F.col("budget") > 0, _some(filler)).otherwise(F.lit(0))))
    plain = rows.where("some <= 0").withColumn("copies", F.col("epochs") + (F.col("some") < 0).cast("long")).drop("some")
    if plan.where(F.exists("rounds", lambda r: r["part"].isNotNull()) | ~F.col("fill.whole")).isEmpty():
        return plain
    group = F.xxhash64(F.col("source").isNull(), "source", F.col("doc_id").isNull(), "doc_id", "key", "size")
    names = rows.columns
    split = scratch.write(rows.where("some > 0"), "split-groups")
    split = split.select("*", group.alias("group"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    files = split.groupBy("group", "file").agg(F.count("*").alias("held"))
    before = Window.partitionBy("group").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = files.select("group", "file", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("group", "file").orderBy("at"))
    split = split.withColumn("place", place).join(files, ["group", "file"])
    taken = (F.col("before") + F.col("place") <= F.col("some")).cast("long")
    split = split.withColumn("copies", F.col("epochs") + taken).select(*[F.col(f"`{c}`") for c in names], "copies").drop("some")
    return plain.union(split.select(*[F.col(f"`{c}`") for c in plain.columns]))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document; edge cases as in ``mix``."""
    rows, _ = mix(common.table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed documents themselves, each repeated as often as it was taken.

    Edge cases as in ``mix``. Documents of a source with target 0 go. Columns of
    ``docs`` are kept as they are, whatever their names.
    """
    scratch = common.Scratch(docs.sparkSession)
    narrow, plan = _planned(docs, seed, scratch)
    scratch.drop(narrow)
    names = docs.columns
    d = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in names])).select("__row", *[F.col(c) for c in ("doc_id", "source", "text")])
    d = d.select("__row", F.struct(*_sized_columns(seed)).alias("__z")).select("__row", "__z.*")
    rows = _copies(_with_plan(d, plan), plan, scratch)
    return rows.where("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__k")).select("__row.*")
