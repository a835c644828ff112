"""Line dedup by a log-template tree.

Every line walks a tree of fixed depth: its number of tokens, then its
``DEPTH`` leading tokens; tokens that hold a digit stand for a variable field
(``<*>``). A leaf generalises further: of the tokens that follow, either half may
be a variable field while the other half stays literal. A line thus belongs to
up to three templates - all literal, first half variable, second half variable -
and is dropped when one of them recurs in ``MIN_DOCS`` documents.

Leaves also generalise by position, for lines of 3 tokens or more. These leaves
have at most half of a line's tokens as leading ones. A token that stands at its
position in fewer than ``MIN_DOCS`` texts of the leaf is a variable field; so is,
in two stricter templates, one in less than an eighth or a half of the leaf's texts,
so that values that recur themselves (names, sections) are fields too. A template
that keeps more than half of the tokens literal and recurs drops its lines. Fields
among the leading tokens are not recognised unless they hold a digit.

A template is known by a hash whose lowest bit is 0, a leaf by one whose lowest bit
is 1. Hashes are counted with partial sums; of lines, only those of recurring leaves
are shuffled, as tokens. At the end the texts are joined by their hash with the
recurring templates that they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common
from syntenia.llm.decision_list import let

DEPTH, MIN_GENERAL, MIN_DOCS = 3, 10, 3
#: A token that holds a digit; tried at the starts of tokens only, without backtracking.
VARIABLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
#: A token is literal, by level, in MIN_DOCS texts of the leaf or in one text of so many.
SHARES = (8, 2)


def template_keys(line: Column) -> Column:
    """Hashes of a line's templates; none for blank lines.

    A line of up to ``DEPTH`` tokens that are all variable holds no literal; its own
    tokens are the template, so that lone numbers recur only as the same number.
    """

    return let(_tokens(line), lambda t: _keys(line, t))


def _tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, VARIABLE, "<*>")).otherwise(line)
    return F.regexp_extract_all(masked, F.lit(common.WORD), 0)


def _literal(line: Column, t: Column) -> Column:
    n = F.size(t)
    bare = (n <= DEPTH) & (F.size(F.array_remove(t, "<*>")) == 0)
    return F.when(bare, F.xxhash64(F.lit(3), n, F.regexp_extract_all(line, F.lit(common.WORD), 0))).otherwise(F.xxhash64(F.lit(0), n, t)).bitwiseAND(F.lit(-2))


def _keys(line: Column, t: Column) -> Column:
    n = F.size(t)
    half = ((n - DEPTH) / 2).cast("int")
    lead = F.slice(t, 1, DEPTH)
    literal = _literal(line, t)
    first = F.xxhash64(F.lit(1), n, lead, F.slice(t, DEPTH + 1, half)).bitwiseAND(F.lit(-2))
    second = F.xxhash64(F.lit(2), n, lead, F.slice(t, F.lit(DEPTH + 1) + half, n)).bitwiseAND(F.lit(-2))
    none = F.array().cast("array<bigint>")
    return F.when(n >= MIN_GENERAL, F.array(literal, first, second)).when(n >= 1, F.array(literal)).otherwise(none)

def _lead(n: Column) -> Column:
    return F.least(F.lit(DEPTH), F.floor(n / 2).cast("int"))


def _leaf(t: Column) -> Column:
    """The leaf of a line's positions; null for lines of fewer than 3 tokens."""
    n = F.size(t)
    return F.when(n >= 3, F.xxhash64(F.lit(4), n, F.slice(t, 1, _lead(n))).bitwiseOR(F.lit(1)))


def _keys_and_leaf(line: Column) -> Column:
    return let(_tokens(line), lambda t: F.array_compact(F.concat(_keys(line, t), F.array(_leaf(t)))))


def generalised(d: DataFrame, leaves: DataFrame, min_docs: int, scratch: common.Scratch) -> DataFrame:
    """(key): literal hashes of the lines whose template by position recurs; leaves are (leaf, texts)."""
    hashed = lambda t: F.transform(t, lambda w: F.xxhash64(w))
    part = lambda line: let(_tokens(line), lambda t: F.struct(_leaf(t).alias("leaf"), _literal(line, t).alias("key"), hashed(t).alias("t")))
    of_text = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), part), lambda x: x["leaf"].isNotNull()))
    lines = d.select(F.xxhash64("text").alias("copy"), F.explode(of_text).alias("l")).select("copy", "l.*")
    lines = scratch.write(lines.join(common.few(leaves), "leaf"), "lines")
    at = F.posexplode("t").alias("pos", "token")
    free = F.xxhash64(F.lit("<*>"))
    literal = (F.col("pos") >= _lead(F.col("n"))) & (F.col("token") != free)
    n = F.size("t").alias("n")
    # texts are counted once, whole copies with them
    tokens = lines.select("copy", "leaf", "texts", n, at).where(literal).drop("n").distinct().groupBy("leaf", "texts", "pos", "token").agg(F.count("*").alias("c"))
    level = sum((F.col("c") * s >= F.col("texts")).cast("int") for s in SHARES)
    tokens = scratch.write(tokens.where(F.col("c") >= min_docs).select("leaf", "pos", "token", level.alias("level")), "tokens")
    lead = F.size(F.array_remove(F.slice("t", 1, _lead(F.size("t"))), free)).alias("lead")
    each = lines.groupBy("leaf", "key").agg(F.any_value("t").alias("t")).select("leaf", "key", n, lead, at).where(literal)
    each = each.join(common.few(tokens), ["leaf", "pos", "token"])
    held = [F.when(F.col("level") >= k, F.xxhash64("pos", "token")) for k in range(len(SHARES) + 1)]
    sums = [f(h).alias(f"{name}{k}") for k, h in enumerate(held) for f, name in ((F.bit_xor, "x"), (F.count, "m"))]
    lines_of = each.groupBy("leaf", "key", "n", "lead").agg(*sums)
    template = F.array_compact(F.array(*[F.when((F.col(f"m{k}") + F.col("lead")) * 2 > F.col("n"), F.xxhash64("leaf", f"m{k}", f"x{k}")) for k in range(len(SHARES) + 1)]))
    lines_of = scratch.write(lines_of.select("key", F.explode(F.array_distinct(template)).alias("template")), "line-templates")
    recurring = lines.select("copy", "key").join(common.few(lines_of), "key").select("template", "copy").distinct().groupBy("template").agg(F.count("*").alias("c")).where(F.col("c") >= min_docs)
    return lines_of.join(recurring, "template", "left_semi").select("key").distinct()


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): each document without lines of recurring templates.

    Lines end at line feeds. Null text counts as empty: one empty line, none
    dropped, text stays empty. All occurrences of a recurring template go, the first
    included. Documents with equal texts count once, so copies of a whole document
    don't make its lines a template. Blank lines stay. Lines are judged by text alone, so
    rows with a null or a shared doc_id lose what others lose; repeated rows each give a
    row. An empty table gives no rows; only doc_id and text are read.
    """
    scratch = common.Scratch(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    keyed = d.select(F.xxhash64("text").alias("copy"), F.array_distinct(F.flatten(F.transform(F.split("text", "\n", -1), _keys_and_leaf))).alias("keys"))
    keyed = scratch.write(keyed, "keys")
    each = keyed.select("copy", F.explode("keys").alias("key"))
    counted = scratch.write(each.select("key", "copy").distinct().groupBy("key").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_docs), "templates")
    leaf = F.col("key").bitwiseAND(F.lit(1)) == 1
    fields = generalised(d, counted.where(leaf).select(F.col("key").alias("leaf"), "texts"), min_docs, scratch)
    recurring = scratch.write(counted.where(~leaf).select("key").union(fields).distinct(), "recurring")
    held = each.join(common.few(recurring), "key", "left_semi").groupBy("copy").agg(F.collect_set("key").alias("bad"))
    held = scratch.write(held, "held")
    scratch.keep(held)

    def kept(lines: Column, bad: Column) -> Column:
        return F.filter(lines, lambda x: ~F.coalesce(F.arrays_overlap(template_keys(x), bad), F.lit(False)))

    got = d.withColumn("copy", F.xxhash64("text")).join(held, "copy", "left").select("doc_id", F.split("text", "\n", -1).alias("lines"), "bad")
    got = got.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("bad").isNull(), F.col("lines")).otherwise(kept(F.col("lines"), F.col("bad"))).alias("kept"))
    return got.select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_recurring_lines(common.table(spark, sf_dir, "documents"))
