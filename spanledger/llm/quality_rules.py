"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them, and the posterior
probability of quality decides.

Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return. All measures come from
the whole text, in the row itself and without a shuffle. Each rule votes good (1), bad (-1) or abstains (0). The only thing
gathered is how many documents cast which combination of votes: at most 3^rules rows, whatever the input. On these,
expectation-maximisation of the two-class model with independent rules estimates the share of good documents and each
rule's accuracy; a document's posterior is then an expression of its votes. Several rules look at each kind of junk from different
sides, since a lone vote can't be told from a mistake.

A very long text is one row's work. Null and empty texts have no words and zero in all measures; they fail the base filter. Repeated documents count
as often as they are there. An empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import let, written

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
GRAM = 5
KEEP = 0.05  # least posterior probability of quality: a lone vote against a document does not drop it
ITERATIONS = 60
SHARE, START, ACCURACY = 0.8, 0.8, (0.6, 0.98)


class Rule(NamedTuple):
    """SQL conditions over the measures: votes good, votes bad (good first); a rule that finds neither abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "false", "n_words < 10"),
    Rule("word_length", "false", "word_chars < 2 * n_words or word_chars > 12 * n_words"),
    Rule("symbols", "false", "10 * n_symbols > n_words"),
    Rule("marks", "false", "5 * n_marks > n_words"),
    Rule("letters", "false", "100 * n_letters < 87 * word_chars"),
    Rule("capitals", "false", "100 * n_upper > 30 * n_letters"),
    Rule("lines", "false", "10 * n_dup_lines > 3 * n_lines"),
    Rule("repeats", "false", "10 * n_repeat_words > 2 * n_words"),
    Rule("variety", "false", "n_words >= 20 and 10 * n_repeat_words > n_words"),
    Rule("prose", "100 * n_letters >= 93 * word_chars and 100 * n_upper <= 20 * n_letters and 20 * n_repeat_words <= n_words", "false"),
)


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, by the sorted hashes of all windows."""

    def of_hashes(hashes: Column) -> Column:
        def of_sorted(pairs: Column) -> Column:
            same = lambda p, j: (F.get(pairs, j - 1).h == p.h) | (F.get(pairs, j + 1).h == p.h)
            found = F.filter(pairs, lambda p, j: F.coalesce(same(p, j), F.get(pairs, j + 1).h == p.h, F.get(pairs, j - 1).h == p.h, F.lit(False)))
            places = F.array_sort(F.transform(found, lambda p: p.i))
            # each window covers its own words up to the next repeated window
            return let(
                places,
                lambda at: F.aggregate(
                    F.transform(at, lambda x, j: F.least(F.lit(GRAM), F.coalesce(F.get(at, j + 1) - x, F.lit(GRAM)))),
                    F.lit(0), lambda a, x: a + x,
                ),
            )

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(pairs, of_sorted))

    def of_words(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (GRAM - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(GRAM))))
        return F.when(F.size(w) < GRAM, F.lit(0)).otherwise(let(hashes, of_hashes))

    return let(words, of_words)


def measures(text: Column) -> dict[str, Column]:
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit("[^ \\t-\\r]")))
    size = lambda a: F.size(a).cast("long")
    return {
        "n_words": size(words),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_lines": size(lines),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": _repeat_words(words).cast("long"),
        "n_upper": F.regexp_count(text, F.lit("\\p{Lu}")).cast("long"),
        "n_letters": F.regexp_count(text, F.lit("\\p{L}")).cast("long"),
        "n_marks": F.regexp_count(text, F.lit("[!|?#*%$&<>]")).cast("long"),
    }


def vote(rule: Rule) -> Column:
    """1, 0 or -1."""
    return F.expr(f"CASE WHEN {rule.good} THEN 1 WHEN {rule.bad} THEN -1 ELSE 0 END").cast("int")


def fit(counts: list[tuple[tuple[int, ...], int]], iterations: int = ITERATIONS) -> tuple[float, list[float]]:
    """Log odds of quality without votes, and the log odds of each rule's accuracy.

    counts: documents per combination of votes. Accuracy: the share of a rule's votes that agree with the class, from
    START on, kept within ACCURACY, so that no rule is turned round or decides alone beyond any other; abstaining says
    nothing.
    """
    n_rules = len(counts[0][0]) if counts else 0
    share, accuracy = SHARE, [START] * n_rules
    logit = lambda p: math.log(p / (1 - p))
    for _ in range(iterations if counts else 0):
        weights = [logit(a) for a in accuracy]
        good = {v: 1 / (1 + math.exp(-logit(share) - sum(w * x for w, x in zip(weights, v)))) for v, _ in counts}
        total = sum(c for _, c in counts)
        share = min(0.95, max(0.05, sum(c * good[v] for v, c in counts) / total))
        for k in range(n_rules):
            votes = sum(c for v, c in counts if v[k])
            right = sum(c * (good[v] if v[k] > 0 else 1 - good[v]) for v, c in counts if v[k])
            accuracy[k] = min(ACCURACY[1], max(ACCURACY[0], (right + START) / (votes + 1)))
    return logit(share), [logit(a) for a in accuracy]


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep: float = KEEP) -> DataFrame:
    """doc_id, the measures, base_failed, the posterior probability of quality, and kept.

    kept: not base_failed, and a posterior of at least keep.
    """
    rows = docs.select("doc_id", "text")
    own = measures(F.col("text"))
    measured = written(rows.select("doc_id", *[c.alias(n) for n, c in own.items()]), "measures")  # read twice
    votes = [vote(r).alias(f"vote_{r.name}") for r in rules]
    voted = measured.select("*", *votes)
    names = [f"vote_{r.name}" for r in rules]
    counts = [(tuple(r[:-1]), r[-1]) for r in voted.groupBy(*names).count().collect()]
    odds, weights = fit(counts)
    logit = F.lit(odds)
    for name, weight in zip(names, weights):
        logit = logit + F.lit(weight) * F.col(name)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = voted.select("*", failed.alias("base_failed"), (1 / (1 + F.exp(-logit))).alias("posterior"))
    return judged.select("*", (~F.col("base_failed") & (F.col("posterior") >= keep)).alias("kept"))
