"""Quality rules with thresholds that adapt to language and source, in DataFrame functions only.

Every text gets counts; documents that fail the fixed base rules are out. Of the
others, shares (symbols, punctuation, capitals, repeated lines, words repeated at once, word length) go
into quantile sketches per language and source. Sketches merge: bounds of a group of n
documents weigh n against ``PRIOR`` documents that follow its language, and those of a
language likewise against all documents, so no verdict jumps at a group size. A share is accepted up to the group's median plus ``SPREADS`` times the
distance from its 5 % quantile to the median, plus a slack; that distance does not see the
upper tail, so it does not grow with the junk in it. The thresholds are joined to the documents
(a small table; where it is not, a hot group's rows are split by adaptive execution).

Words are ``[^\\x20\\x09-\\x0D]+``; a text repeats a word if it lies in a window of
``WINDOW`` words that is found twice or more in it.

Cases: null and wordless texts fail the base rules; null language or source are groups of
their own; a group without passing documents has no thresholds and needs none; repeated rows are
judged each; equally named columns of the input stay as they are, the result is one struct column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.session import stage

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
WINDOW = 8
PRIOR = 200.0
SPREADS = 12.0
SKETCH_SIZE = 400
# The accepted distance that any group gets on top, per share.
SLACK = {"symbols": 0.02, "punctuation": 0.08, "capitals": 0.1, "repeated_lines": 0.5, "word_length": 2.0, "stutter": 0.1}
SHORTEST_SLACK = 2.0  # word length has a lower bound as well

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def count(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds the struct ``_counts`` to every row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    words = docs.withColumn("_words", F.array_remove(F.split(text, r"\s+"), ""))
    hashed = words.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n = F.size("_hashes")
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    windows = F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW))))
    windowed = hashed.withColumn("_windows", windows)
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # equal windows stand next to each other once sorted
    sorted_ = windowed.withColumn("_sorted", F.when(repeats, F.array_sort(placed)))

    def equal(i: Column, w: Column) -> Column:
        return F.coalesce(F.get("_sorted", i)["h"] == w["h"], F.lit(False))

    found = F.transform("_sorted", lambda w, i: F.when(equal(i - 1, w) | equal(i + 1, w), w["i"]))
    placed_again = sorted_.withColumn("_found", F.array_sort(F.array_compact(found)))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
    covered = F.aggregate(
        "_found", start,
        lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(WINDOW), i - a["last"])).alias("total")),
        lambda a: a["total"])
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"\S"))
    lined = placed_again.withColumn("_lines", lines)
    length = F.length(text)
    again = F.zip_with("_hashes", F.slice("_hashes", 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b)
    counts = F.struct(
        n.cast("long").alias("n_words"),
        _length_without(text, " \t\n\x0b\f\r").cast("long").alias("word_chars"),
        (length - _length_without(text, "#*$%&|<>")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (length - F.length(F.regexp_replace(text, r"\p{Punct}+", ""))).cast("long").alias("n_punctuation"),
        (length - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_capitals"),
        F.coalesce(F.size(F.filter(again, lambda x: x)), F.lit(0)).cast("long").alias("n_stutter"),
    )
    return lined.withColumn("_counts", counts).drop("_words", "_hashes", "_windows", "_sorted", "_found", "_lines")


def base_failed(counts: str = "_counts") -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


def shares(counts: str = "_counts") -> dict[str, Column]:
    c = {name: F.col(f"{counts}.{name}").cast("double") for name in [*COUNTS, "n_lines", "n_punctuation", "n_capitals", "n_stutter"]}
    chars, n = F.greatest(c["word_chars"], F.lit(1.0)), F.greatest(c["n_words"], F.lit(1.0))
    return {
        "symbols": c["n_symbols"] / chars,
        "punctuation": c["n_punctuation"] / chars,
        "capitals": c["n_capitals"] / chars,
        "repeated_lines": c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1.0)),
        "word_length": chars / n,
        "stutter": c["n_stutter"] / n,
    }


def thresholds(counted: DataFrame, language: str, source: str, prior: float = PRIOR) -> DataFrame:
    """One row per language and source: bounds of each share, from the sketches of the group, its language and all."""
    passing = counted.filter(~base_failed()).select(
        F.col(language).alias("_lang"), F.col(source).alias("_source"), *(v.alias(k) for k, v in shares().items()))
    names = list(SLACK)
    own = stage(passing.groupBy("_lang", "_source").agg(
        F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(k, SKETCH_SIZE).alias(k) for k in names)), "sketches")

    def bounds(sketches: dict[str, Column]) -> Column:
        found = []
        for k in names:
            low, middle = (F.kll_sketch_get_quantile_double(sketches[k], F.lit(q)) for q in (0.05, 0.5))
            found.append((middle + SPREADS * (middle - low) + SLACK[k]).alias(f"most_{k}"))
            if k == "word_length":
                found.append((middle - SPREADS * (middle - low) - SHORTEST_SLACK).alias("least_word_length"))
        return F.struct(*found)

    # sketches stay behind: only counts and bounds are joined
    merged = bounds({k: F.kll_merge_agg_double(k, SKETCH_SIZE) for k in names}).alias("_wide")
    of_language = own.groupBy(F.col("_lang").alias("_of")).agg(F.sum("n").alias("n_l"), merged)
    if own.isEmpty():
        nothing = F.struct(*(F.lit(None).cast("double").alias(k) for k in [*(f"most_{k}" for k in names), "least_word_length"]))
        return own.select("_lang", "_source", nothing.alias("_bounds"))
    everything = own.agg(merged).first()  # one row of numbers
    overall = everything["_wide"].asDict()
    groups = own.select("_lang", "_source", "n", bounds({k: F.col(k) for k in names}).alias("_own"))
    joined = groups.join(of_language, F.col("_lang").eqNullSafe(F.col("_of")))

    def pooled(n: str, own_bound: Column, wider: Column) -> Column:
        weight = F.col(n) / (F.col(n) + F.lit(float(prior)))
        return weight * own_bound + (1 - weight) * wider

    chosen = F.struct(*(
        pooled("n", F.col(f"_own.{k}"), pooled("n_l", F.col(f"_wide.{k}"), F.lit(v))).alias(k) for k, v in overall.items()))
    return joined.select("_lang", "_source", chosen.alias("_bounds"))


def judge(
    docs: DataFrame, text_column: str = "text", language: str = "lang", source: str = "source",
    prior: float = PRIOR,
) -> DataFrame:
    """``docs`` with the struct ``_quality``: the counts, base_failed, the shares' verdict and kept."""
    counted = stage(count(docs, text_column), "counted")
    limits = stage(thresholds(counted, language, source, prior), "thresholds")
    judged = counted.join(
        limits, F.col(language).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")), "left")
    found = shares()
    inside = F.lit(True)
    for k in SLACK:
        inside = inside & (found[k] <= F.col(f"_bounds.most_{k}"))
    inside = F.coalesce(inside & (found["word_length"] >= F.col("_bounds.least_word_length")), F.lit(True))
    quality = F.struct(
        *(F.col(f"_counts.{c}").alias(c) for c in COUNTS), base_failed().alias("base_failed"),
        (~base_failed() & inside).alias("kept"))
    return judged.select(*docs.columns, quality.alias("_quality"))
