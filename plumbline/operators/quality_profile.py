"""Column-level data quality: an exact profile of every column of every load, and the columns of a load that have changed.

The columns are unpivoted and counted as (load, column, value, n) with map-side combine, so a value that fills a third of a
load is a handful of rows by the time anything is shuffled. Everything else comes from these counts: frequencies, distinct
values, ranges, and histograms of several kinds (state, written form, value, number, year, length). Values and forms are
compared by their exact counts: each that makes up one in a hundred cells of any load, and five of them at least, is a bin of
its own in all loads, and the others together are one. The written form of a long text is seen as a whole and by its
end, the marks in it, its runs and the shares of classes of characters, as whole forms hardly recur. A load's histogram is held against the usual one, the median share of each bin over all loads, by the population stability index; a column has
changed where an index passes what chance and lesser wobble give, or the share of distinct values moves plainly.

Defined cases: rows without a load number are profiled under null and not compared; a column that is empty in a load has
only its state histogram; a single load cannot have changed; empty tables give no rows. Texts are used whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import DISGUISED_BLANKS
from plumbline.functions.blanks import is_placeholder
from plumbline.functions.values import NUMBER, let
from plumbline.plans.lineage import cut

INDEX_LIMIT = 0.25
NOISE_FACTOR = 3.0
DISTINCT_LIMIT = 0.2
#: A value or form is a bin of its own from this share of the filled cells of a load, and this many cells, on; there can be
#: no more than a hundred of them in a load.
TOP_SHARE, TOP_CELLS = 0.01, 5
REST = "rest"
MIN_KIND_SHARE = 0.3
_DROPPED = "£$€¥, ()"
#: Characters of a plain number and of what is dropped around it: other values are no numbers, seen at their first other character.
MAY_BE_NUMBER = rf"^[-+.0-9eE{_DROPPED}]+$"
#: Characters of a written form that the histogram of its end takes; the others take it whole.
END = 4
SHARE_BINS = 8
CLASSES = {"lower": "a", "upper": "A", "digits": "9", "blanks": " "}
#: Histograms of filled cells, compared however few cells are filled.
_OF_FILLED = ("form", "ending", "marks", "runs", *CLASSES, "value", "length")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def value_counts(df: DataFrame, load: str, columns: Sequence[str]) -> DataFrame:
    """(load, column_name, value, n)."""
    cells = df.select(F.col(f"`{load}`").alias("load"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])))
    return cells.groupBy("load", "column_name", "value").agg(F.count("*").alias("n"))


def classes(c: Column) -> Column:
    """a for each lower-case letter of a value, A for each upper-case one, 9 for each digit."""
    return F.translate(c, _LETTERS + _LETTERS.upper() + "0123456789", "a" * 26 + "A" * 26 + "9" * 10)


def written_form(classes: Column) -> Column:
    """How a value is written: its classes, each run once."""
    return F.regexp_replace(classes, r"(.)\1+", "$1")


def plain_number(c: Column) -> Column:
    """A rough number for ranges and magnitudes: signs of currency, commas, blanks and brackets are dropped."""
    return let(F.translate(c, _DROPPED, ""), lambda s: F.when(s.rlike(NUMBER), s.try_cast("double")))


def profile(df: DataFrame, load: str, columns: Sequence[str], masks: DataFrame | None = None, blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """One row per load and column: counts, distinct values, ranges, the most frequent value, and flagged cells."""
    counts = value_counts(df, load, columns).withColumn("filled", F.col("value").isNotNull() & ~is_placeholder(F.col("value"), blanks))
    filled, number = F.col("filled"), F.when(F.col("filled"), plain_number(F.col("value")))
    result = counts.groupBy("load", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum(F.when(F.col("value").isNotNull() & ~filled, F.col("n")).otherwise(0)).alias("n_placeholder"),
        F.count_if(filled).alias("n_distinct"),
        F.min(F.when(filled, F.length("value"))).alias("min_length"), F.max(F.when(filled, F.length("value"))).alias("max_length"),
        F.min(number).alias("min_number"), F.max(number).alias("max_number"),
        F.min(F.when(filled, F.col("value"))).alias("min_text"), F.max(F.when(filled, F.col("value"))).alias("max_text"),
        F.max(F.when(filled, F.struct("n", "value"))).alias("top"),
    )
    result = result.select("load", "column_name", "n_rows", "n_missing", "n_placeholder", "n_distinct", "min_length", "max_length", "min_number", "max_number", "min_text", "max_text", F.col("top.value").alias("top_value"), F.col("top.n").alias("top_count"))
    if masks is not None:
        flagged = mask_counts(masks, load).withColumnRenamed("load", "mask_load").withColumnRenamed("column_name", "mask_column")
        result = result.join(flagged, F.col("load").eqNullSafe(F.col("mask_load")) & (F.col("column_name") == F.col("mask_column")), "left").drop("mask_load", "mask_column")
        result = result.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_failed", "n_review")})
    return result.withColumnRenamed("load", load)


def mask_counts(masks: DataFrame, load: str) -> DataFrame:
    return masks.groupBy(F.col(f"`{load}`").alias("load"), "column_name").agg(F.count_if("fail_mask").alias("n_failed"), F.count_if("price_review_mask").alias("n_review"))


def histograms(df: DataFrame, load: str, columns: Sequence[str], masks: DataFrame | None, blanks: Sequence[str]) -> DataFrame:
    """(load, column_name, kind, bin, n): histograms of all kinds, and the number of distinct filled values as a kind.

    All branches read one exchange of value counts; none filters by the grouping columns alone, as such a filter would move
    below the counts and have them taken again.
    """
    v, n, number, form, letters = (F.col(c) for c in ("value", "n", "number", "form", "classes"))
    counts = value_counts(df.where(F.col(f"`{load}`").isNotNull()), load, columns).withColumn("filled", F.when(v.isNotNull() & ~is_placeholder(v, blanks), n))
    filled = F.col("filled").isNotNull()
    magnitude = F.when(number == 0, "0").otherwise(F.concat(F.when(number < 0, "-").otherwise("+"), F.floor(F.log2(F.abs(number)) * 1.5).cast("string")))
    octaves = lambda c: F.when(filled, F.floor(F.log2(F.length(c) + 1) * 2).cast("string"))
    share = lambda c: 1 - F.length(F.replace(letters, F.lit(c), F.lit(""))) / F.greatest(F.length(letters), F.lit(1))
    kinds = {
        "state": F.when(v.isNull(), "missing").when(~filled, "placeholder").otherwise("filled"),
        "distinct": F.when(filled, ""),
        "runs": octaves(form),
        **{k: F.when(filled, F.ceil(share(c) * SHARE_BINS).cast("string")) for k, c in CLASSES.items()},
        "number": F.when(filled & number.isNotNull(), magnitude),
        "year": F.when(filled, F.nullif(F.regexp_extract(v, r"(?:^|\D)((?:19|20)\d\d)(?:\D|$)", 1), F.lit(""))),
        "length": octaves(v),
    }
    texts = {"form": form, "ending": F.right(form, F.lit(END)), "marks": F.translate(form, "".join(CLASSES.values()), "")}
    staged = counts.withColumn("classes", classes(v)).withColumn("form", written_form(letters))
    numbered = staged.withColumn("number", F.when(filled & v.rlike(MAY_BE_NUMBER), plain_number(v)))
    cells = numbered.select("load", "column_name", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), b.alias("bin"), (F.lit(1).cast("long") if k == "distinct" else n).alias("w")) for k, b in kinds.items()])))
    bins = cells.where("bin is not null").groupBy("load", "column_name", "kind", "bin").agg(F.sum("w").alias("n"))
    written = staged.where(filled).select("load", "column_name", "filled", F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.xxhash64(b).alias("text")) for k, b in texts.items()])))
    written = written.groupBy("load", "column_name", "kind", "text").agg(F.sum("filled").alias("n"))
    values = counts.where(filled).select("load", "column_name", F.lit("value").alias("kind"), F.xxhash64(v).alias("text"), "n")
    totals = counts.groupBy("load", "column_name").agg(F.sum("filled").alias("total")).where("total > 0")
    bins = bins.unionByName(reduce(DataFrame.unionByName, [_frequent(x, totals) for x in (written, values)]))
    if masks is None:
        return bins
    flagged = mask_counts(masks, load).where("load is not null")
    rows_of = df.groupBy(F.col(f"`{load}`").alias("load")).agg(F.count("*").alias("total")).where("load is not null")
    totals = rows_of.select("load", "total", F.explode(F.array(*map(F.lit, columns))).alias("column_name")).join(flagged, ["load", "column_name"], "left")
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(b).alias("bin"), n.alias("n")) for k, c in (("failed", "n_failed"), ("review", "n_review")) for b, n in (("yes", F.coalesce(c, F.lit(0)).cast("long")), ("no", F.col("total") - F.coalesce(c, F.lit(0))))]
    return bins.unionByName(totals.select("load", "column_name", F.inline(F.array(*rows))))


def _frequent(texts: DataFrame, totals: DataFrame) -> DataFrame:
    """(load, column_name, kind, bin, n) of (load, column_name, kind, text, n): texts that are frequent in some load, by
    their digests, and for each load what is left of the total."""
    top = texts.join(totals, ["load", "column_name"]).where((F.col("n") >= TOP_CELLS) & (F.col("n") >= TOP_SHARE * F.col("total"))).select("column_name", "kind", "text").distinct()
    marked = texts.join(top.withColumn("top", F.lit(True)), ["column_name", "kind", "text"], "left")
    return marked.groupBy("load", "column_name", "kind", F.when(F.col("top"), F.col("text").cast("string")).otherwise(REST).alias("bin")).agg(F.sum("n").alias("n"))


def stability(df: DataFrame, load: str, columns: Sequence[str], masks: DataFrame | None = None, blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """(load, column_name, kind, measure, limit_value, changed) of every load, column and kind of histogram."""
    bins = cut(histograms(df, load, columns, masks, blanks))  # a few hundred rows per load, read by every step below
    sums = bins.where("kind <> 'distinct'").groupBy("load", "column_name", "kind").agg(F.sum("n").alias("total"))
    n_loads = bins.groupBy("column_name").agg(F.count_distinct("load").alias("loads"))
    usable = sums.join(sums.where("kind = 'state'").select("load", "column_name", F.col("total").alias("rows")), ["load", "column_name"]).where((F.col("total") >= MIN_KIND_SHARE * F.col("rows")) | (F.col("kind").isin(*_OF_FILLED)))
    shares = bins.join(usable, ["load", "column_name", "kind"]).withColumn("share", F.col("n") / F.col("total"))
    usual = shares.groupBy("column_name", "kind", "bin").agg(F.median("share").alias("m"), F.count("*").alias("c")).join(n_loads, "column_name")
    usual = usual.select("column_name", "kind", "bin", F.when(F.col("c") * 2 >= F.col("loads"), F.col("m")).otherwise(F.lit(0.0)).alias("usual"))
    width = usual.groupBy("column_name", "kind").agg(F.count("*").alias("b"), F.sum("usual").alias("whole"))
    grid = usable.join(width, ["column_name", "kind"]).join(usual, ["column_name", "kind"]).join(bins, ["load", "column_name", "kind", "bin"], "left")
    total, b = F.col("total"), F.col("b")
    p = (F.coalesce("n", F.lit(0)) + 0.5) / (total + 0.5 * b)
    q = (F.col("usual") / F.greatest(F.col("whole"), F.lit(1e-9)) * total + 0.5) / (total + 0.5 * b)
    index = grid.groupBy("load", "column_name", "kind").agg(F.sum((p - q) * F.log(p / q)).alias("measure"), (INDEX_LIMIT + NOISE_FACTOR * (F.max("b") - 1) / F.max("total")).alias("limit_value"))
    filled = bins.where("kind = 'state' and bin = 'filled'").select("load", "column_name", F.col("n").alias("filled"))
    ratio = bins.where("kind = 'distinct'").join(filled, ["load", "column_name"]).select("load", "column_name", (F.col("n") / F.col("filled")).alias("r"))
    moved = ratio.join(ratio.groupBy("column_name").agg(F.median("r").alias("m")), "column_name").select("load", "column_name", F.lit("distinct").alias("kind"), F.abs(F.col("r") - F.col("m")).alias("measure"), F.lit(DISTINCT_LIMIT).alias("limit_value"))
    parts = [index, moved]
    return reduce(DataFrame.unionByName, parts).withColumn("changed", F.col("measure") > F.col("limit_value")).withColumnRenamed("load", load)


def changed_columns(df: DataFrame, load: str, columns: Sequence[str], masks: DataFrame | None = None, blanks: Sequence[str] = DISGUISED_BLANKS) -> DataFrame:
    """(load, column_name) of the columns of a load whose content departs plainly from the usual."""
    return stability(df, load, columns, masks, blanks).where("changed").select(load, "column_name").distinct()
