"""Quality rules as a learned decision list.

Statistics of every text are Spark expressions. Sequential covering learns an
ordered list of rules from labelled documents: each rule is grown as a
conjunction of thresholds by FOIL's information gain on two thirds of the
sample, pruned on the rest, and accepted while it is precise; the documents it
covers are taken out and the next rule is learned. The list is emitted as one
ordered ``CASE WHEN`` expression.

The fit uses at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their id; everything else runs over all rows and whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common

FIT_ROWS = 4000
#: A rule needs this precision and so many covered rows, on either part of the sample.
PRECISION, SUPPORT, MAX_RULES, MAX_TERMS, CUTS = 0.97, 8, 12, 4, 48

#: Words of a stretch in which distinct words are counted.
STRETCH = 100

FEATURES = ("symbol_rate", "repeat_share", "dup_line_share", "mean_chars", "bang_rate", "shout_share", "variety", "bar_rate")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the text."""

    def covered(grams: Column) -> Column:
        pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twice(p: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(p, k)["g"] == x["g"], F.lit(False))
            return F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])

        starts = F.array_sort(let(pairs, twice))
        zero = F.struct(F.lit(0).alias("n"), F.lit(-5).alias("at"))
        step = lambda acc, s: F.struct((acc["n"] + F.least(F.lit(5), s - acc["at"])).alias("n"), s.alias("at"))
        return F.aggregate(starts, zero, step, lambda acc: acc["n"])

    def grams(h: Column) -> Column:
        at = lambda i, k: F.get(h, i + k)
        return F.transform(F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2), at(i, 3), at(i, 4)))

    many = lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), covered(g)).otherwise(F.lit(0))
    return F.when(F.size(words) >= 5, let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(grams(h), many))).otherwise(F.lit(0))


def variety(words: Column) -> Column:
    """Distinct words of each stretch of ``STRETCH`` words, summed; as a share it doesn't fall with the length."""
    last = F.floor((F.size(words) - 1) / STRETCH).cast("int")
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.size(F.array_distinct(F.slice(words, i * STRETCH + 1, F.lit(STRETCH)))))
    return F.when(F.size(words) > 0, F.aggregate(each, F.lit(0), lambda a, b: a + b)).otherwise(F.lit(0))


def statistics(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the contract's statistics and the learner's features of each text (null: no words).

    ``keep`` names columns of ``docs`` to carry along, as one struct ``kept_row``.
    """
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept_row")] if keep else []
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("t"), *row)
    more = ["kept_row"] if keep else []
    word_lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(common.WORD))
    count = lambda pattern: F.regexp_count(F.col("t"), F.lit(pattern)).cast("long")
    of_words = lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("repeat"), variety(w).alias("distinct"))
    of_lines = lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
    d = d.select(
        "doc_id",
        *more,
        let(F.regexp_extract_all("t", F.lit(common.WORD), 0), of_words).alias("w"),
        let(word_lines, of_lines).alias("l"),
        (F.length("t") - count(r"[\x20\x09-\x0D]")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        count("!!").alias("bangs"),
        count(r"\p{Lu}{3,}").alias("shouts"),
        count(r"\x20\|").alias("bars"),
    )
    n = F.greatest(F.col("w.n"), F.lit(1))
    return d.select(
        "doc_id",
        *more,
        F.col("w.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").cast("long").alias("n_repeat_words"),
        (F.col("n_symbols") / n).alias("symbol_rate"),
        (F.col("w.repeat") / n).alias("repeat_share"),
        (F.col("l.dup") / F.greatest(F.col("l.n"), F.lit(1))).alias("dup_line_share"),
        (F.col("word_chars") / n).alias("mean_chars"),
        (F.col("bangs") / n).alias("bang_rate"),
        (F.col("shouts") / n).alias("shout_share"),
        (F.col("w.distinct") / n).alias("variety"),
        (F.col("bars") / n).alias("bar_rate"),
    )


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    cut: float

    def holds(self, x: dict) -> bool:
        return x[self.feature] >= self.cut if self.above else x[self.feature] <= self.cut

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= self.cut if self.above else c <= self.cut


Rule = tuple[Term, ...]


def _covers(rule: Rule, x: dict) -> bool:
    return all(t.holds(x) for t in rule)


def _split(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [x["bad"] for x in rows if _covers(rule, x)]
    return sum(hit), len(hit) - sum(hit)


def _candidates(rows: list[dict]) -> list[Term]:
    out = []
    for f in FEATURES:
        values = sorted({x[f] for x in rows})
        mids = [(a + b) / 2 for a, b in zip(values, values[1:])]
        step = max(1, len(mids) // CUTS)
        out += [Term(f, above, m) for m in mids[::step] for above in (True, False)]
    return out


def _grow(rows: list[dict]) -> Rule:
    rule: Rule = ()
    live = rows
    while len(rule) < MAX_TERMS:
        p0 = sum(x["bad"] for x in live)
        n0 = len(live) - p0
        if not p0 or not n0:
            break
        best = (0.0, None, None)
        for t in _candidates(live):
            hit = [x for x in live if t.holds(x)]
            p = sum(x["bad"] for x in hit)
            if p:
                gain = p * (math.log2(p / len(hit)) - math.log2(p0 / (p0 + n0)))
                if gain > best[0] + 1e-9:
                    best = (gain, t, hit)
        if best[1] is None:
            break
        rule, live = (*rule, best[1]), best[2]
    return rule


def _worth(rule: Rule, rows: list[dict]) -> float:
    p, n = _split(rule, rows)
    return (p - n) / (p + n) if p + n else -1.0


def _prune(rule: Rule, rows: list[dict]) -> Rule:
    while len(rule) > 1:
        shorter = max((rule[:i] + rule[i + 1 :] for i in range(len(rule))), key=lambda r: _worth(r, rows))
        if _worth(shorter, rows) < _worth(rule, rows):
            break
        rule = shorter
    return rule


def learn(rows: list[dict]) -> list[Rule]:
    """Ordered rules for the rows marked ``bad``; rows: features and bad (0 or 1), in a fixed order."""
    grow = [x for i, x in enumerate(rows) if i % 3]
    prune = [x for i, x in enumerate(rows) if not i % 3]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(x["bad"] for x in grow):
        rule = _prune(_grow(grow), prune)
        p, n = map(sum, zip(_split(rule, grow), _split(rule, prune)))
        if not rule or p < SUPPORT or p < PRECISION * (p + n):
            break
        rules.append(rule)
        grow, prune = ([x for x in part if not _covers(rule, x)] for part in (grow, prune))
    return rules


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules learned from at most ``fit_rows`` labelled documents; labels that are null count as none.

    Of candidate terms that tie in gain the first by feature and threshold is taken; rows are ordered by id.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 0).cast("int")).alias("bad"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = statistics(docs.where("text is not null").join(F.broadcast(sample.select(F.col("doc_id"))), "doc_id", "left_semi")).join(F.broadcast(sample), "doc_id")
    # one row for each sampled id, however often it is repeated; of rows that share it, that with the least values
    one = rows.where("n_words > 0").groupBy("doc_id", "bad").agg(F.min(F.struct("n_words", *FEATURES)).alias("x"))
    return learn([r.asDict() for r in one.select("doc_id", "bad", "x.*").orderBy("doc_id").collect()])


def emit(rules: list[Rule]) -> Column:
    """The place of the first rule that rejects, else null."""
    out = F.lit(None).cast("int")
    for k in range(len(rules) - 1, -1, -1):
        cond = rules[k][0].column()
        for t in rules[k][1:]:
            cond = cond & t.column()
        out = F.when(cond, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, rules: list[Rule], keep: tuple[str, ...] = ()) -> DataFrame:
    s = statistics(docs, keep)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return s.withColumn("base_failed", failed).withColumn("rule", emit(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns.

    Null and empty texts have no words and fail. Repeated rows are judged alike;
    an empty table or empty labels give no learned rule, so only the base test
    holds. Names of further columns cannot clash: rows are carried as one struct.
    """
    out = judge(docs, fit(docs, labels), tuple(docs.columns))
    return out.where("kept").select("kept_row.*")


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    out = judge(docs, fit(docs, common.table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
