"""Quality classification by a sparse ensemble of rules (Friedman and Popescu's RuleFit).

1. Statistics of each text: built-in column expressions, JVM-side.
2. Small trees on the labelled rows, each on a bootstrap sample and a third of the statistics; every path from
   a root is a rule, a conjunction of ``statistic <= cut`` and ``statistic > cut``.
3. A logistic model on the rules with a lasso penalty, which leaves few of them.
4. The rules that are left are compiled into one Spark column expression of the statistics.

Labelled rows whose ``crc32(doc_id) % 5`` is 0 are never learned from. The trees are fitted on at most about
``SAMPLE`` labelled rows, chosen by a hash of ``doc_id``; only their statistics reach the driver.

NULL text is an empty one. A ``doc_id`` with several labels counts with each; unlabelled rows are scored only.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
TREES, DEPTH, LEAF = 40, 3, 20
LASSO = 2e-3
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(whole), F.lit(1)).cast("double")
    words = F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    count = F.greatest(F.size(words), F.lit(1)).cast("double")
    lines = F.filter(F.split(whole, "\n"), lambda x: x != "")
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")

    def share(pattern: str) -> Column:
        """Characters of the class, as a share of the text."""
        return (F.length(whole) - F.length(F.regexp_replace(whole, pattern, ""))) / n

    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D]", "")) / count,
        "upper": share(r"[A-ZÀ-ÖØ-Þ]"),
        "digits": share("[0-9]"),
        "symbols": share(r"[#*$%&|<>{}\[\]\\^~=+_@/]"),
        "marks": share(r"[!?]"),
        "stops": share("[.,;:]"),
        "bars": share(r"[|]"),
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "distinct_lines": F.size(F.array_distinct(lines)) / n_lines,
        "words_per_line": count / n_lines,
    }


@dataclass(frozen=True)
class Rule:
    """Conditions ``(statistic, cut, above)``, all of which hold."""

    conditions: tuple[tuple[str, float, bool], ...]

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), bool)
        for name, cut, above in self.conditions:
            out &= (table[name] > cut) == above
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, cut, above in self.conditions:
            out = out & (F.col(name) > cut if above else F.col(name) <= cut)
        return out


def grow(table: dict[str, np.ndarray], y: np.ndarray, random, depth: int = DEPTH) -> list[Rule]:
    """Rules of one tree: all its paths from the root, inner ones too."""
    names = list(table)
    rows = random.integers(0, len(y), len(y))
    allowed = random.choice(len(names), max(2, len(names) // 3), replace=False)
    rules: list[Rule] = []

    def split(rows: np.ndarray, path: tuple) -> None:
        if path:
            rules.append(Rule(path))
        if len(path) == depth or len(rows) < 2 * LEAF or y[rows].min() == y[rows].max():
            return
        best = (1e-9, None)
        for k in allowed:
            values = table[names[k]][rows]
            for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, 33))):
                right = values > cut
                m = int(right.sum())
                if m < LEAF or len(rows) - m < LEAF:
                    continue
                p, p_left, p_right = y[rows].mean(), y[rows][~right].mean(), y[rows][right].mean()
                n = len(rows)
                gain = p * (1 - p) - ((n - m) * p_left * (1 - p_left) + m * p_right * (1 - p_right)) / n
                if gain > best[0]:
                    best = (gain, (names[k], float(cut), right))
        if best[1]:
            name, cut, right = best[1]
            split(rows[~right], (*path, (name, cut, False)))
            split(rows[right], (*path, (name, cut, True)))

    split(rows, ())
    return rules


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[np.ndarray, float]:
    """Logistic weights and bias by accelerated proximal gradient steps; the bias is free."""
    w, b, v, c = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    rate = 4.0 / (np.linalg.norm(x, 2) ** 2 / len(y) + 1)
    t = 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(x @ v + c))) - y
        moved = v - rate * (x.T @ error) / len(y)
        w_new = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)
        b_new = c - rate * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = w_new + (t - 1) / t_new * (w_new - w)
        c = b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return w, float(b)


def fit_rules(table: dict[str, np.ndarray], y: np.ndarray) -> tuple[list[tuple[Rule, float]], float]:
    """Rules with their weights, and the bias. A single class, or no row, gives a constant."""
    if not len(y) or y.min() == y.max():
        return [], 0.0 if not len(y) else (6.0 if y[0] else -6.0)
    random = np.random.default_rng(11)
    rules: dict[Rule, None] = {}
    for _ in range(TREES):
        rules.update(dict.fromkeys(grow(table, y, random)))
    held = {rule.holds(table).tobytes(): rule for rule in reversed(rules)}
    kept = sorted(held.values(), key=lambda r: (len(r.conditions), r.conditions))
    if not kept:
        return [], float(np.log(y.mean() / (1 - y.mean())))
    x = np.stack([rule.holds(table) for rule in kept], axis=1).astype(float)
    weights, bias = lasso(x, y.astype(float), LASSO)
    return [(r, float(w)) for r, w in zip(kept, weights, strict=True) if w], bias


def compiled(rules: list[tuple[Rule, float]], bias: float) -> Column:
    """The probability of label 1 as one expression of the statistics."""
    total = F.lit(bias)
    for rule, weight in rules:
        total = total + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs(doc_id, text)``."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    measures = statistics(F.col("text"))
    key = F.col("doc_id").cast("long").alias("doc_id")
    measured = docs.select(key, *[c.alias(name) for name, c in measures.items()])
    known = labels.where("quality IN (0, 1)").select(key, F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out)
    total = known.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    known = known.where(share < int(min(1.0, SAMPLE / max(total, 1)) * 1_000_000))
    # About ``SAMPLE`` rows of 12 bytes, so they may be broadcast; only their documents are measured.
    sample = (
        docs.select(key, "text")
        .join(F.broadcast(known), "doc_id")
        .select("quality", *[c.alias(name) for name, c in measures.items()])
        .toPandas()
    )
    table = {name: sample[name].to_numpy(float) for name in measures}
    rules, bias = fit_rules(table, sample["quality"].to_numpy(int))
    scored = measured.select("doc_id", held_out.alias("held_out"), compiled(rules, bias).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
