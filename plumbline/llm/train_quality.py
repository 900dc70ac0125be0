"""Learns the rules of text_quality: ``python -m plumbline.llm.train_quality FOLDER`` prints them and their accuracy.

Labels come from the layout of a document, looked at line by line (what kinds there are was found by reading some hundreds
of documents); the learner sees only the figures of text_quality, never the layout tests. At most MAX_LABELLED documents
are used to learn, others to measure.
"""

from __future__ import annotations

import re
import sys

import numpy as np

from plumbline.llm import text_quality as Q

MAX_LABELLED = 20_000
_ITEM = re.compile(r"\s*([-*•–]\s|#\d+\s|\d+[.)]\s|\[ ?\]\s|\t)")
_RECORD = re.compile(r"\s*(\|(?!\s?\w+ \w+ \w+ \w+ \w+)|[{<]|\w+=|-{3,}|\d{4}-\d\d-\d\dT|[A-Z]{3}-?\d{4,}|([0-9a-f]{2} ){8}|[A-Za-z0-9+/=]{40,}$)|app_number\b|([^;,\t]{0,40}[;,\t]){2,}[^;,\t]{0,40}$")


def is_sentence_like(line: str) -> bool:
    """Six or more words of running text with small words among them."""
    words = re.findall(r"[^\W\d_]+", line.lower())
    return len(words) >= 6 and len(set(words)) > len(words) / 4 and sum(len(w) <= 4 for w in words) >= len(words) / 5 and not _RECORD.match(line) and not _ITEM.match(line)


def layout_label(text: str) -> int:
    """1 where most of the text is items, records or noise, else 0."""
    text = text.lstrip("\ufeff")
    lines = [x for x in re.split(r"[\r\n]+", text) if x.strip()]
    if len(lines) <= 2 and len(re.findall(r"(?:, |^)(?:#\d+|\d+[.)]|[-*•–]|\[ ?\]) ?", text)) >= 3:
        return 1
    pieces = re.split(r"[,;]+ ?", text)
    if len(lines) <= 2 and len(pieces) >= 5 and sorted(len(p.split()) for p in pieces)[len(pieces) // 2] <= 4 and not re.search(r"[a-z]\. |\b(we|it|the|wir|les|las)\b.{20,}\b(was|were|is|has|had|es|est|sind)\b", text):
        return 1
    words = re.findall(r"[^\W\d_]+", text.lower())
    if len(words) > 20 and len(set(words)) < 4:
        return 1
    running = sum(len(x) for x in lines if is_sentence_like(x.lstrip("> |")))
    short = sum(len(x) for x in lines if len(re.findall(r"[^\W\d_]+", x)) < 6 or _ITEM.match(x) or _RECORD.match(x))
    small = sum(w in _SMALL for w in words) / max(1, len(words))
    return int(running < short or small < 0.08)


_SMALL = {"the", "and", "of", "to", "in", "was", "is", "that", "with", "der", "die", "das", "und", "in", "le", "la", "les", "de", "des", "et", "el", "los", "las", "que", "en", "nicht", "es", "a", "une", "un", "pas", "am", "ist", "war", "nur", "bis", "ohne", "von", "wer", "im", "den", "wir", "hat", "on", "ne", "se", "al", "no", "lo", "si", "por", "y", "for", "we", "it", "there", "which", "were", "from"}


def fits(rules: list, x: np.ndarray) -> np.ndarray:
    found = np.zeros(len(x), bool)
    for rule in rules:
        m = np.ones(len(x), bool)
        for f, op, v in rule:
            m &= (x[:, Q.FIGURES.index(f)] <= v) if op == "<=" else (x[:, Q.FIGURES.index(f)] >= v)
        found |= m
    return found


def wrong(rules: list, x: np.ndarray, y: np.ndarray) -> int:
    return int((fits(rules, x) != y).sum())


def main(folder: str) -> None:
    from pyspark.sql import SparkSession

    from plumbline.sources.tables import table

    spark = SparkSession.builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
    docs = table(spark, folder, "documents").where("text rlike '(?U)\\\\S'")
    common = Q.common_words(table(spark, folder, "common_words"))
    data = Q.statistics(docs, "doc_id", "text", common).join(docs.select("doc_id", "text"), "doc_id").orderBy("doc_id").toPandas()
    y = np.array([layout_label(t) for t in data.text])
    x = data[list(Q.FIGURES)].astype(float).fillna(0).to_numpy()
    order = np.random.default_rng(1).permutation(len(y))
    rare = np.argsort(x[order, Q.FIGURES.index("distinct_share")], kind="stable")[:200]  # kinds too rare for a plain sample
    order = np.concatenate([order[rare], np.delete(order, rare)])
    learn, test = order[:MAX_LABELLED], order[MAX_LABELLED:]
    rules = min((Q.induce(x[learn], y[learn], Q.FIGURES, seed) for seed in range(12)), key=lambda r: (wrong(r, x[learn], y[learn]), len(r)))
    for rule in rules:
        print(f"    {tuple(rule)},")
    found = fits(rules, x)
    print("labelled", len(learn), "held out", len(test), "not prose", y.mean(), "accuracy", (found[learn] == y[learn]).mean(), (found[test] == y[test]).mean())
    for i in np.flatnonzero(found != y)[:40]:
        print(data.doc_id[i], y[i], found[i], repr(data.text[i][:150]), "...", repr(data.text[i][-60:]))


if __name__ == "__main__":
    main(sys.argv[1])
