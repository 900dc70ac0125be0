"""Per-document text statistics, and the documents that are not natural prose.

All figures are built-in column expressions, so a corpus is measured in one narrow scan without Python. The decision is an
ordered list of rules over the figures, induced by incremental reduced-error pruning (``induce``) on a bounded sample of
labelled documents (``train_quality``) and kept here as learned thresholds; ``not_prose`` turns it into one SQL CASE.

Defined cases: null, empty and blank texts have zero counts and null shares and are never reported as "not prose"; texts
of any length are measured whole. Words of all languages of the list count as common, whatever the document's own tag.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_COMMON_WORDS = 20_000
FIGURES = ("n_words", "mean_word_length", "words_per_line", "words_per_clause", "symbol_ratio", "digit_ratio", "upper_ratio", "line_end_share", "bullet_share", "common_share", "distinct_share")

#: (figure, at most / at least, threshold) of each rule in order; a document that fits any rule is not prose.
#: Learned by train_quality on 20,000 labelled documents.
LEARNED_RULES: tuple[tuple[tuple[str, str, float], ...], ...] = (
    (("common_share", "<=", 0.2935),),
    (("words_per_line", "<=", 5.546), ("upper_ratio", "<=", 0.01337)),
    (("words_per_clause", "<=", 4.69), ("line_end_share", "<=", 0.125)),
    (("bullet_share", ">=", 0.9357),),
)


def common_words(words: DataFrame, column: str = "word") -> list[str]:
    """The distinct common words in lower case, collected only if there are few."""
    rows = words.select(F.lower(F.col(f"`{column}`")).alias("w")).where("w is not null").distinct().limit(MAX_COMMON_WORDS + 1).collect()
    if len(rows) > MAX_COMMON_WORDS:
        raise ValueError(f"more than {MAX_COMMON_WORDS} common words")
    return sorted(r.w for r in rows)


def statistics(df: DataFrame, key: str, text: str, common: Sequence[str]) -> DataFrame:
    """(key, n_chars, n_lines, <FIGURES>) of every row."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{key}`").alias("id"), t.alias("t"))
    rows = rows.select(
        "id", "t",
        F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)).alias("words"),
        F.filter(F.split("t", r"[\r\n]+"), lambda x: F.length(F.btrim(x, F.lit(" \t"))) > 0).alias("lines"),
        F.size(F.filter(F.split("t", r"[,;:.!?|/=()<>\[\]{}\t]+"), lambda x: x.rlike(r"\p{L}"))).alias("clauses"),
        F.length("t").alias("n_chars"),
    )
    n, lines = F.size("words"), F.size("lines")
    share = lambda c, of: F.when(of > 0, c / of)
    count = lambda a, test: F.size(F.filter(a, test))
    is_common = (lambda w: w.isin(list(common))) if common else (lambda w: F.lit(False))
    return rows.select(
        F.col("id").alias(key), "n_chars", lines.alias("n_lines"), n.alias("n_words"),
        share(F.length(F.array_join("words", "")), n).alias("mean_word_length"),
        share(n, lines).alias("words_per_line"),
        share(n, F.col("clauses")).alias("words_per_clause"),
        share(F.length(F.regexp_replace("t", r"[\p{L}\p{M}\p{N}\s]+", "")), F.col("n_chars")).alias("symbol_ratio"),
        share(F.length(F.regexp_replace("t", r"[^0-9]+", "")), F.col("n_chars")).alias("digit_ratio"),
        share(F.length(F.regexp_replace("t", r"\P{Lu}+", "")), F.col("n_chars")).alias("upper_ratio"),
        share(count("lines", lambda x: x.rlike(r"[.!?:…\"”»]\s*\z")), lines).alias("line_end_share"),
        share(count("lines", lambda x: x.rlike(r"^\s*([-*•–#|\[]|[0-9]+[.)])")), lines).alias("bullet_share"),
        share(count("words", is_common), n).alias("common_share"),
        share(F.size(F.array_distinct("words")), n).alias("distinct_share"),
    )


def not_prose(rules: Sequence[Sequence[tuple[str, str, float]]] = LEARNED_RULES) -> str:
    """The rule list as a SQL CASE over the figures; null shares fit no rule but the absence of words does."""
    tests = [" AND ".join(f"{figure} {op} {threshold!r}" for figure, op, threshold in rule) for rule in rules]
    return "CASE WHEN n_words = 0 THEN true " + " ".join(f"WHEN {t} THEN true" for t in tests) + " ELSE false END"


def find_not_prose(df: DataFrame, key: str, text: str, common: Sequence[str]) -> DataFrame:
    """(key) of the documents that are a list, a dump or junk as a whole."""
    filled = df.where(F.col(f"`{text}`").rlike(r"(?U)\S"))
    return statistics(filled, key, text, common).where(F.expr(not_prose())).select(key)


@dataclass
class _Set:
    x: np.ndarray
    y: np.ndarray

    def fits(self, rule: Sequence[tuple[int, bool, float]]) -> np.ndarray:
        m = np.ones(len(self.y), bool)
        for f, at_most, v in rule:
            m &= (self.x[:, f] <= v) if at_most else (self.x[:, f] >= v)
        return m


def induce(x: np.ndarray, y: np.ndarray, names: Sequence[str], seed: int = 7, max_rules: int = 12, max_conditions: int = 4) -> list[list[tuple[str, str, float]]]:
    """An ordered rule list for the class y = 1 by incremental reduced-error pruning.

    Two thirds of the rows not yet covered grow a rule by information gain, the rest prune its last conditions; rules are
    added until one would be wrong more often than right on the pruning rows.
    """
    rng = np.random.default_rng(seed)
    left, rules = np.arange(len(y)), []
    while len(rules) < max_rules and (y[left] == 1).sum() >= 2:
        shuffled = rng.permutation(left)
        cut = 2 * len(shuffled) // 3
        grow, prune = _Set(x[shuffled[:cut]], y[shuffled[:cut]]), _Set(x[shuffled[cut:]], y[shuffled[cut:]])
        rule: list[tuple[int, bool, float]] = []
        while len(rule) < max_conditions:
            m = grow.fits(rule)
            p0, n0 = (grow.y[m] == 1).sum(), (grow.y[m] == 0).sum()
            if n0 == 0 or p0 == 0:
                break
            best, choice = 0.0, None
            for f in range(x.shape[1]):
                v, lab = grow.x[m, f], grow.y[m]
                order = np.argsort(v, kind="stable")
                v, lab = v[order], lab[order]
                edge = np.flatnonzero(v[1:] > v[:-1])
                p, n = np.cumsum(lab == 1)[edge], np.cumsum(lab == 0)[edge]
                for at_most, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p0 / (p0 + n0))), 0)
                    if len(gain) and gain.max() > best:
                        k = int(gain.argmax())
                        best, choice = float(gain[k]), (f, at_most, float((v[edge[k]] + v[edge[k] + 1]) / 2))
            if choice is None:
                break
            rule.append(choice)
        worth = lambda r: ((m := prune.fits(r)).any() and ((prune.y[m] == 1).sum() - (prune.y[m] == 0).sum()) / m.sum()) or 0.0
        cuts = [rule[:k] for k in range(1, len(rule) + 1)]
        if not cuts:
            break
        rule = max(cuts, key=lambda r: (worth(r), -len(r)))
        if worth(rule) <= 0:
            break
        tightest = {(f, at_most): v for f, at_most, v in rule}  # a later condition on a figure is the tighter one
        rules.append([(names[f], "<=" if at_most else ">=", float(f"{v:.4g}")) for (f, at_most), v in tightest.items()])
        covered = _Set(x[left], y[left]).fits(rule)
        left = left[~covered]
    return rules
