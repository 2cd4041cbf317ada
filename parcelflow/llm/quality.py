"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation finds how far each can be trusted.

Each rule votes for a good text (1), for a bad one (-1) or abstains (0). What a vote is worth is estimated without
labels: for good and for bad texts, how often each rule casts each vote. Texts with equal votes are alike, so the
estimation runs over the table of vote patterns with their counts, which has at most 3 to the number of rules rows,
as one fold in one row. The posterior probability of a good text replaces the filter that all rules must pass.
Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.shared import written

_SPACE = r"[\x20\x09-\x0D]"
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOL = "[#*$%&|<>]"

#: Rules as (name, SQL for a bad text, SQL for a good text); neither is an abstention. Limits are in whole numbers.
RULES = (
    ("length", "n_words < 20", "n_words >= 100"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 10 * n_words", "word_chars BETWEEN 3 * n_words AND 7 * n_words"),
    ("symbols_by_word", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    ("symbols_by_character", "100 * n_symbols > 3 * word_chars", "1000 * n_symbols <= 3 * word_chars"),
    ("symbol_runs", "20 * n_symbol_runs > n_words", "200 * n_symbol_runs <= n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words <= 10 * n_words"),
    ("blanks", "2 * (n_chars - word_chars) > n_chars", "10 * (n_chars - word_chars) <= 3 * n_chars"),
)
#: Rounds of expectation and maximisation, and texts that are added to every count so that none is zero.
ROUNDS, SMOOTHING = 60, 1.0
#: Posterior probability from which a text is kept.
LEAST = 0.5


def _repeated_words() -> Column:
    """Words inside of three-word windows that the text has twice or more.

    Window hashes are sorted with their places; neighbours that agree are repeated. The places are sorted again and
    each window adds the words that the one before it did not cover. No step compares all windows with all.
    """
    places = F.filter(
        F.transform(
            "_sorted",
            lambda x, k: F.when(
                F.coalesce(x.h == F.get("_sorted", k - 1).h, F.lit(False)) | F.coalesce(x.h == F.get("_sorted", k + 1).h, F.lit(False)), x.i
            ),
        ),
        lambda i: i.isNotNull(),
    )
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-3).alias("last"))
    covered = F.aggregate(
        F.sort_array(places), start,
        lambda acc, i: F.struct((acc.words + F.least(F.lit(3), i - acc.last)).alias("words"), i.alias("last")),
    )
    return covered.words


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep`` and the counts that rules look at; ``docs`` has ``text``, null for a text without words."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("_text"), F.btrim(text, F.lit(_BLANKS)).alias("_trimmed"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = base.withColumns(
        {
            "_words": F.when(F.col("_trimmed") != "", F.split("_trimmed", f"{_SPACE}+")).otherwise(F.array().cast("array<string>")),
            "_lines": lines,
            "n_chars": F.length("_text").cast("long"),
            "word_chars": (F.length("_text") - F.regexp_count("_text", F.lit(_SPACE))).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(_SYMBOL)).cast("long"),
            "n_symbol_runs": F.regexp_count("_text", F.lit(f"{_SYMBOL}{{2,}}")).cast("long"),
        }
    ).drop("_text", "_trimmed")
    counted = split.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.when(
                F.size("_words") >= 3,
                F.transform(
                    F.slice("_words", 1, F.size("_words") - 2),
                    lambda w, i: F.xxhash64(w, F.element_at("_words", i + 2), F.element_at("_words", i + 3)),
                ),
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_words", "_lines")
    # Most texts have no window twice: those with some are sorted.
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h: bigint, i: int>>")
    ranked = counted.withColumn("_sorted", F.when(some, F.sort_array(pairs)).otherwise(none)).drop("_hashes")
    return ranked.withColumn("n_repeat_words", _repeated_words()).drop("_sorted")


def votes() -> Column:
    """One vote for each of ``RULES``; a text without words gets none."""
    each = [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for _, bad, good in RULES]
    return F.when(F.col("n_words") > 0, F.array(*each)).otherwise(F.array(*[F.lit(0)] * len(RULES)))


def _at(array: Column | str, place: Column) -> Column:
    return F.element_at(array, place + 1)


def posteriors(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``patterns`` (votes, n) with the posterior probability of a good text, and the estimates: votes, good, prior, rates.

    ``rates`` holds, for bad and then for good texts, for each rule how often it votes -1, 0 and 1. The estimation begins
    with the share of votes for good, in which a vote for bad counts three times: rules are made to find bad texts.
    """
    rules = len(RULES)
    votes_for = lambda p, v: F.size(F.filter(p.votes, lambda x: x == v))
    first = F.transform(
        F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))),
        lambda p: F.struct(
            p.votes.alias("votes"), p.n.alias("n"),
            ((1.0 + votes_for(p, 1)) / (2.0 + votes_for(p, 1) + 3 * votes_for(p, -1))).alias("good"),
        ),
    )
    row = patterns.agg(first.alias("ps"))
    cells = F.sequence(F.lit(0), F.lit(2 * rules * 3 - 1))

    def total(ps: Column, of_good: Column) -> Column:
        return F.aggregate(ps, F.lit(0.0), lambda a, p: a + p.n * F.when(of_good, p.good).otherwise(1.0 - p.good))

    def estimated(ps: Column) -> Column:
        """How often each vote is cast: cell (class * rules + rule) * 3 + vote + 1."""
        sums = F.array(total(ps, F.lit(False)), total(ps, F.lit(True)))

        def rate(cell: Column) -> Column:
            good = cell >= rules * 3
            rule = F.floor(cell / 3).cast("int") % rules
            cast = F.aggregate(
                ps, F.lit(SMOOTHING),
                lambda a, p: a + F.when(_at(p.votes, rule) == cell % 3 - 1, p.n * F.when(good, p.good).otherwise(1.0 - p.good)).otherwise(0.0),
            )
            return cast / (F.when(good, F.element_at(sums, 2)).otherwise(F.element_at(sums, 1)) + 3 * SMOOTHING)

        prior = (total(ps, F.lit(True)) + SMOOTHING) / (total(ps, F.lit(True)) + total(ps, F.lit(False)) + 2 * SMOOTHING)
        return F.struct(prior.alias("prior"), F.transform(cells, rate).alias("rates"))

    def judged(ps: Column, by: Column) -> Column:
        def good(p: Column) -> Column:
            logs = F.aggregate(
                F.sequence(F.lit(0), F.lit(rules - 1)), F.ln(by.prior) - F.ln(1.0 - by.prior),
                lambda a, r: a + F.ln(_at(by.rates, (r + rules) * 3 + _at(p.votes, r) + 1)) - F.ln(_at(by.rates, r * 3 + _at(p.votes, r) + 1)),
            )
            return 1.0 / (1.0 + F.exp(-logs))

        return F.transform(ps, lambda p: F.struct(p.votes.alias("votes"), p.n.alias("n"), good(p).alias("good")))

    state = F.struct(F.col("ps").alias("ps"), estimated(F.col("ps")).alias("by"))

    def step(acc: Column, _: Column) -> Column:
        # Estimates of the last round judge the patterns; transform over one element names the result once.
        return F.transform(
            F.array(judged(acc.ps, acc.by)), lambda ps: F.struct(ps.alias("ps"), estimated(ps).alias("by"))
        )[0]

    done = row.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state, step).alias("s"))
    each = done.select(F.explode("s.ps").alias("p"), "s.by.prior", "s.by.rates")
    return each.select("p.votes", "p.good", "prior", "rates")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judged(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of ``keep``, the counts, ``votes``, ``good`` (posterior), ``base_failed`` and ``kept`` of each row.

    A null or empty text has no words, no votes and fails the base rules. Repeated rows are judged alike. The posterior
    of a text depends on all texts of ``docs``, through the estimates, and not on its place or partition.
    """
    plain = [f"_keep{i}" for i in range(len(keep))]
    named = docs.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(keep, plain, strict=True)], "text")
    counts = written(features(named, plain).withColumn("votes", votes()))
    patterns = counts.groupBy("votes").agg(F.count("*").alias("n"))
    good = written(posteriors(patterns).select("votes", "good"))
    # At most 3 ** len(RULES) patterns: a bound that no table passes.
    out = counts.join(F.broadcast(good), "votes").withColumn("base_failed", base_failed())
    out = out.withColumn("kept", ~F.col("base_failed") & (F.col("good") >= LEAST))
    return out.withColumnsRenamed(dict(zip(plain, keep, strict=True)))
