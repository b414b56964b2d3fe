"""Quality of whole texts with a sparse rule ensemble.

Statistics of a text are Spark column expressions. Shallow trees are grown on a bounded sample of labelled rows; every
path from a root to a node becomes a rule, a conjunction of thresholds on statistics. A logistic regression with an L1
penalty weighs the rules and leaves most at zero, and the remaining ones are compiled back into one column expression,
so all rows are scored inside the JVM.

Defined results: null texts count as empty; an empty text has all statistics at zero and is scored like any other.
Without labelled rows of both classes, or enough rows for a cut, there is nothing to learn and every text scores 0.5; the
pipeline stage then keeps every document, as the toxicity stage does. Repeated rows and extra or clashing columns don't
matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import evaluated, fold, label_examples, table, unused_name

LABELLED_ROWS = 8_000  # the fit reads at most this many labelled documents
TREES = 30
DEPTH = 3
TREE_ROWS = 2_000
TREE_STATISTICS = 6
LEAST_ROWS = 20
CUTS = 32
PENALTY = 0.0005
STEPS = 600
THRESHOLD = 0.7

#: name -> (pattern counted, what it is a share of)
COUNTED = {
    "upper_share": (r"\p{Lu}", "chars"),
    "digit_share": (r"[0-9]", "chars"),
    "mark_share": (r"[^\p{L}\p{N}\s]", "chars"),
    "odd_mark_share": (r"[!#$%&*@^~<>{}\[\]\\|]", "chars"),
    "sentence_share": (r"[.!?](\s|$)", "words"),
}


def statistics(df: DataFrame, text: str) -> tuple[DataFrame, list[str]]:
    """Adds the statistics of `text`; returns their names as well. Helper columns are dropped again."""
    names = {}

    def name(wanted: str) -> str:
        names[wanted] = unused_name(df, f"_s_{wanted}")
        return names[wanted]

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lists = {
        name("list"): F.array_remove(F.split(whole, r"\s+"), ""),
        name("lines"): F.array_remove(F.split(whole, "\n"), ""),
        name("chars"): F.length(whole).cast("double"),
    }
    listed = evaluated(df, lists)
    words, lines, chars = (F.col(n) for n in lists)
    count = F.size(words).cast("double")
    least = F.lit(1.0)
    per = {"chars": F.greatest(chars, least), "words": F.greatest(count, least)}
    made = {
        "chars": F.log1p(chars),
        "words": F.log1p(count),
        "word_length": chars / per["words"],
        "distinct_words": F.size(F.array_distinct(words)) / per["words"],
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "words_per_line": F.log1p(count / F.greatest(F.size(lines), F.lit(1))),
        **{n: F.regexp_count(whole, F.lit(p)) / per[of] for n, (p, of) in COUNTED.items()},
    }
    stats = {unused_name(df, f"_q_{n}"): c.cast("double") for n, c in made.items()}
    return evaluated(listed, stats).drop(*lists), list(stats)


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, whether above, threshold), with its weight."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for at, above, cut in self.conditions:
            out &= (x[:, at] > cut) == above
        return out

    def column(self, names: list[str]) -> Column:
        out = F.lit(True)
        for at, above, cut in self.conditions:
            value = F.col(names[at])
            out = out & (value > cut if above else value <= cut)
        return F.when(out, F.lit(self.weight)).otherwise(0.0)


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    rules: tuple[Rule, ...]

    def column(self, names: list[str]) -> Column:
        logit = F.lit(self.intercept)
        for rule in self.rules:
            logit = logit + rule.column(names)
        return 1.0 / (1.0 + F.exp(-logit))


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[Rule]:
    """The paths of one tree: at each node the cut with the largest drop of Gini impurity."""
    found: list[Rule] = []

    def split(rows: np.ndarray, path: tuple) -> None:
        if path:
            found.append(Rule(path))
        share = y[rows].mean() if len(rows) else 0.0
        if len(path) == DEPTH or len(rows) < 2 * LEAST_ROWS or share in (0.0, 1.0):
            return
        best = (1e-9, None, None)
        for at in rng.choice(x.shape[1], min(TREE_STATISTICS, x.shape[1]), replace=False):
            values = x[rows, at]
            for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, CUTS))):
                low = values <= cut
                n = int(low.sum())
                if n < LEAST_ROWS or len(rows) - n < LEAST_ROWS:
                    continue
                a, b = y[rows[low]].mean(), y[rows[~low]].mean()
                drop = share * (1 - share) - (n * a * (1 - a) + (len(rows) - n) * b * (1 - b)) / len(rows)
                if drop > best[0]:
                    best = (drop, at, between(values, cut))
        if best[1] is None:
            return
        _, at, cut = best
        low = x[rows, at] <= cut
        split(rows[low], (*path, (int(at), False, float(cut))))
        split(rows[~low], (*path, (int(at), True, float(cut))))

    split(rng.choice(len(x), min(TREE_ROWS, len(x)), replace=True), ())
    return found


def between(values: np.ndarray, cut: float) -> float:
    """The middle between the last value up to a cut and the first one past it."""
    return float((values[values <= cut].max() + values[values > cut].min()) / 2)


def lasso_logistic(rules: np.ndarray, y: np.ndarray, penalty: float) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient; classes weigh the same."""
    n, m = rules.shape
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(n - y.sum(), 1))
    step = 4.0 / (1.0 + (rules**2).sum(axis=1).max())
    beta, ahead, b, b_ahead, t = np.zeros(m), np.zeros(m), 0.0, 0.0, 1.0
    for _ in range(STEPS):
        wrong = weight * (1 / (1 + np.exp(-(rules @ ahead + b_ahead))) - y)
        new = ahead - step * (rules.T @ wrong)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = b_ahead - step * wrong.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - beta)
        b_ahead = new_b + (t - 1) / t_new * (new_b - b)
        beta, b, t = new, new_b, t_new
    return float(b), beta


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 11) -> RuleEnsemble:
    if not len(y) or y.min() == y.max():
        return RuleEnsemble(0.0, ())
    rng = np.random.default_rng(seed)
    rules = list(dict.fromkeys(r for _ in range(TREES) for r in grow(x, y, rng)))
    if not rules:  # too few rows for any cut
        return RuleEnsemble(0.0, ())
    held = np.stack([r.holds(x) for r in rules], axis=1)
    _, first = np.unique(held, axis=1, return_index=True)  # rules that hold for the same rows are one
    first = np.sort(first)
    intercept, beta = lasso_logistic(held[:, first].astype(float), y, PENALTY)
    chosen = [Rule(rules[i].conditions, float(w)) for i, w in zip(first, beta) if w != 0]
    return RuleEnsemble(intercept, tuple(chosen))


def fit_quality(documents: DataFrame, labels: DataFrame, learn_from: Column, *, limit: int = LABELLED_ROWS) -> RuleEnsemble:
    """Fit on the statistics of at most `limit` labelled documents; only these numbers reach the driver."""
    rows = label_examples(documents.select("doc_id", "text"), labels, "quality", learn_from, limit, "text")
    with_stats, names = statistics(rows, "text")
    one = with_stats.groupBy("doc_id", "_label").agg(*[F.max(n).alias(n) for n in names])
    kept = one.toPandas().sort_values("doc_id")
    return fit_rules(kept[names].to_numpy(dtype=float), kept["_label"].to_numpy(dtype=float))


def with_quality(df: DataFrame, text: str, name: str, model: RuleEnsemble) -> DataFrame:
    """Adds the score of `text`."""
    with_stats, names = statistics(df, text)
    return with_stats.withColumn(name, model.column(names)).drop(*names)


def learned_from() -> Column:
    return fold("doc_id", 4) != 2


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that score at least the threshold, or all of them if nothing could be learnt."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), learned_from())
    if not model.rules:
        return docs
    name = unused_name(docs, "_quality")
    return with_quality(docs, "text", name, model).where(F.col(f"`{name}`") >= THRESHOLD).drop(name)
