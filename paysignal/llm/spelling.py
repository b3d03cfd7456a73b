"""Groups spelling variants: words of a corpus that differ by one edit, each led to a much commoner form.

1. Words are counted with built-in functions; hot words are combined before the shuffle.
2. Two words of lengths m and m or m + 1 that differ by one edit agree in their first a and
   their last m - b characters, where the edit lies in the window [a, b) of the shorter one. Words are
   dealt by (m, window, what lies outside it), first with the two halves as windows. A group of more than
   ``MOST_GROUP`` words has its window halved, again and again; a window of one character leaves at most
   two words per letter of the alphabet, so every group is bounded without dropping a word or a link.
3. A task scans the sorted words of a group once per word: the band of the edit matrix has a row per
   character of the list word, the rows of the prefix that two neighbours of the list share (their LCP) are
   reused, and once a row has no cell of at most one edit, the whole range of the list that shares that
   prefix is jumped over. A pair counts only in the window that holds its first difference, so it counts once.
4. Counts and best forms are put together per word, and forms are followed by doubling the steps.

Cases: a null text has no words; a null id counts as an empty one; words are told apart by code points; ties
in frequency go to the first word in code-point order; repeated rows count again; other columns of the
input are not looked at; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.grouped import group_limits, segments
from paysignal.session import stage

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5
MOST_GROUP = 2048
DROP_EVERY = 199
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(run: Column, key: Column, every: int = DROP_EVERY) -> Column:
    """The run, without one of its characters where ``every`` divides the checksum of key and run."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damage_every: int = DROP_EVERY,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """Distinct words with the number of their occurrences: word, n."""
    runs = docs.select(
        F.col(id_column).alias("_id"), F.explode(F.regexp_extract_all(F.col(text_column), F.lit(LETTERS), F.lit(0))).alias("run"))
    lower = runs.filter(F.length("run") >= least_length).select("_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    words = lower.select(damaged(F.col("run"), F.col("_id"), damage_every).alias("word") if damage_every else F.col("run").alias("word"))
    counts = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """Names the group of a row: shorter length, window, and the characters outside the window."""
    head = F.substring(F.col("word"), F.lit(1), F.col("a"))
    tail = F.substring(F.col("word"), F.length("word") - (F.col("m") - F.col("b")) + 1, F.col("m") - F.col("b"))
    return rows.select("word", "n", "m", "a", "b", F.xxhash64("m", "a", "b", head, tail).alias("task"))


def _windows(words: DataFrame, least_length: int) -> DataFrame:
    """Every word as the shorter (or equal) and as the longer word of a pair, in either half."""
    length = F.length("word")
    roles = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).filter(F.col("m") >= least_length)
    half = F.call_function("div", F.col("m"), F.lit(2)).cast("int")
    bounds = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("m").alias("b")))
    return _keyed(roles.withColumn("_w", F.explode(bounds)).select("word", "n", "m", "_w.a", "_w.b"))


def _halved(rows: DataFrame) -> DataFrame:
    middle = F.call_function("div", F.col("a") + F.col("b") + 1, F.lit(2)).cast("int")
    bounds = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
    parted = rows.withColumn("_w", F.explode(bounds)).select("word", "n", "m", "_w.a", "_w.b")
    return _keyed(parted.filter("a < b"))


def bounded_groups(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = MOST_GROUP) -> DataFrame:
    """Rows (word, n, m, a, b, task), at most ``most`` of a task unless its window is one character."""
    rows = stage(_windows(words, least_length), "word_windows")
    done: DataFrame | None = None
    while True:
        sizes = rows.groupBy("task").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("b") - F.col("a")).alias("_wide"))
        large = stage(sizes.filter((F.col("_n") > most) & (F.col("_wide") > 1)).select("task"), "large_groups")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "task", "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        rows = stage(_halved(rows.join(large, "task", "left_semi")), "word_windows")


def shared_prefix(u: str, v: str) -> int:
    n = min(len(u), len(v))
    if u[:n] == v[:n]:
        return n
    lo, hi = 0, n  # u[:lo] and v[:lo] are equal, u[:hi] and v[:hi] are not
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if u[lo:mid] == v[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def list_jumps(words: list[str]) -> tuple[list[int], list[int]]:
    """LCP of every word with the one before it, and the next place with a smaller LCP."""
    lcp = [0, *(shared_prefix(u, v) for u, v in zip(words, words[1:], strict=False))]
    nearest = [len(words)] * len(words)
    waiting: list[int] = []
    for i, depth in enumerate(lcp):
        while waiting and lcp[waiting[-1]] > depth:
            nearest[waiting.pop()] = i
        waiting.append(i)
    return lcp, nearest


def near_after(words: list[str], lcp: list[int], nearest: list[int], i: int) -> Iterator[int]:
    """Places after ``i`` of words at one edit from word ``i`` of the sorted distinct list.

    ``band[d]`` holds the distances of the first d characters of the list word to the first d - 1, d and
    d + 1 characters of word i, where more than one edit counts as two.
    """
    query, size, end = words[i], len(words[i]), len(words)
    band = [(2, 0, 1)] + [(1, 0, 1)] * size  # word i against itself
    if size:
        band[size] = (1, 0, 2)
    j = i + 1
    depth = size
    while j < end:
        depth = min(depth, lcp[j])
        word = words[j]
        del band[depth + 1 :]
        left, centre, right = band[depth]
        dead = False
        while depth < len(word):
            c = word[depth]
            d = depth
            depth += 1
            here = 2
            if 0 < d <= size:
                here = left if query[d - 1] == c else left + 1
            below = min(here, centre + 1)
            here = (centre if query[d] == c else centre + 1) if d < size else 2
            middle = min(here, below + 1, right + 1) if d < size else 2
            above = 2
            if d + 1 < size:
                above = min(right if query[d + 1] == c else right + 1, middle + 1)
            left, centre, right = min(below, 2), min(middle, 2), min(above, 2)
            band.append((left, centre, right))
            if left > 1 and centre > 1 and right > 1:
                dead = True
                break
        if dead:
            # the words that share this prefix are out as well
            j += 1
            while j < end and lcp[j] >= depth:
                j = nearest[j]
            continue
        offset = size - len(word)
        if -1 <= offset <= 1 and (left, centre, right)[offset + 1] == 1:
            yield j
        j += 1


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n_near, best_n, best): what a word finds within its group."""
    for table in segments(batches, "task"):
        limits = group_limits(table, "task")
        out: dict[str, list] = {"word": [], "n_near": [], "best_n": [], "best": []}
        every, counts = table.column("word").to_pylist(), table.column("n").to_pylist()
        bounds = list(zip(*(table.column(c).to_pylist() for c in ("m", "a", "b")), strict=True))
        for lo, hi in zip(limits[:-1], limits[1:], strict=True):
            if hi - lo < 2:
                continue
            words = every[lo:hi]
            lcp, nearest = list_jumps(words)
            found: dict[int, list] = {}
            for i in range(hi - lo - 1):
                m, a, b = bounds[lo + i]
                for j in near_after(words, lcp, nearest, i):
                    u, v = words[i], words[j]
                    if bounds[lo + j] != (m, a, b) or min(len(u), len(v)) != m or not a <= min(shared_prefix(u, v), m - 1) < b:
                        continue
                    for x, y in ((i, j), (j, i)):
                        best = (-counts[lo + y], words[y])
                        if x in found:
                            found[x] = [found[x][0] + 1, min(found[x][1], best)]
                        else:
                            found[x] = [1, best]
            for i, (n_near, best) in found.items():
                for column, value in zip(out.values(), (words[i], n_near, -best[0], best[1]), strict=True):
                    column.append(value)
        if out["word"]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()), pa.array(out["best_n"], pa.int64()),
                 pa.array(out["best"], pa.string())], names=list(out))


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = MOST_GROUP) -> DataFrame:
    """Words with at least one near word: word, n_near, best_n and best (the commonest near word)."""
    rows = bounded_groups(words, least_length, most)
    found = rows.repartition("task").sortWithinPartitions("task", "word").mapInArrow(
        _scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) for rows (word, form): forms followed to the last one. Every step leads to a word that is
    several times as frequent, so steps end, and doubling them ends after a few rounds."""
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("_via"), F.col("root").alias("_next"))
        moved = stage(
            links.join(ahead, F.col("root") == F.col("_via"), "left").select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "forms")
        links = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return links


def variants(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", damage_every: int = DROP_EVERY,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES, most: int = MOST_GROUP,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n (null without one) and root."""
    words = stage(vocabulary(docs, id_column, text_column, damage_every, least_length, least_count), "vocabulary")
    near = near_words(words, least_length, most)
    enough = F.col("best_n") >= times * F.col("n")
    formed = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")).alias("form"), F.when(enough, F.col("best_n")).alias("form_n")), "formed")
    followed = roots(formed.filter("form IS NOT NULL"))
    return formed.join(followed, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
