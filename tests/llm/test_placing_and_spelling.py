"""Shards, whitening and spelling variants against brute force, on hand-made and hostile rows."""

from __future__ import annotations

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from paysignal.llm import queries, sharding, spelling, whitening
from paysignal.llm.spectrum import Spectrum
from paysignal.session import fresh_path

SCHEMA = "doc_id long, text string, shard string, size string"


# --- shards -------------------------------------------------------------------


def shard_rows() -> list[tuple]:
    rng = random.Random(3)
    rows = [(i, "é" * rng.randrange(0, 300), "own", "own") for i in range(400)]
    rows += [(7, rows[7][1], None, None)] * 3 + [(9, "hot", None, None)] * 9000  # copies over several shards
    return rows + [(None, None, None, None), (None, "x" * 50, None, None), (5, None, None, None)]


def brute_shards(rows: list[tuple], shards: int) -> list[tuple]:
    keyed = sorted(((d is not None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows))
    total = sum(k[2] for k in keyed)
    out, start, slots = [], 0, collections.Counter()
    for known, doc, size, crc in keyed:
        shard = (2 * start + size) * shards // (2 * total)
        out.append((doc if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        start += size
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def shard_docs(spark):
    return spark.createDataFrame(shard_rows(), SCHEMA).repartition(5)


def test_shards_are_cut_at_equal_targets(spark, shard_docs):
    found = sharding.shard_table(shard_docs)
    assert found.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_shards(shard_rows(), 16)
    sizes = {r.shard: r.bytes for r in sharding.shard_sizes(found).collect()}
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1300
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()


def test_few_and_no_rows(spark):
    one = spark.createDataFrame([(1, "a", None, None)], SCHEMA)
    assert [tuple(r)[3:] for r in sharding.shard_table(one).collect()] == [(8, 0)]
    giant = spark.createDataFrame([(1, "a" * 10, None, None), (2, "b" * 100_000, None, None), (3, "c", None, None)], SCHEMA)
    assert [r.shard for r in sharding.shard_table(giant).orderBy("doc_id").collect()] == [0, 8, 15]
    nothing = spark.createDataFrame([], SCHEMA)
    assert sharding.shard_table(nothing).count() == 0 and sharding.with_shards(nothing).count() == 0


def test_written_shards_hold_whole_rows(spark, shard_docs):
    path = fresh_path(spark, "shards")
    sharding.write_shards(shard_docs, path)
    back = spark.read.parquet(path)
    assert sorted(r.text or "" for r in back.collect()) == sorted(t or "" for _, t, *_ in shard_rows())
    table = sharding.shard_table(shard_docs)
    of_ids = {r.doc_id: r.shard for r in table.filter("doc_id > 9").collect()}
    assert {r.doc_id: r.shard for r in back.filter("doc_id > 9").collect()} == of_ids
    sizes = [r.n for r in back.groupBy("shard").agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n")).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.15 * min(sizes)  # copies of one row are dealt by hash


# --- whitening ----------------------------------------------------------------


def vectors(n: int, size: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, size)) * np.linspace(0.2, 2.0, size)) @ np.linalg.qr(rng.normal(size=(size, size)))[0]


def test_spectrum_of_hard_cases():
    rng = np.random.default_rng(1)
    for size, n in ((1, 4), (2, 3), (6, 40), (40, 25), (64, 150)):
        base = rng.normal(size=(n, size))
        halves = np.concatenate((np.zeros((n, size // 2)), base[:, size // 2 :]), axis=1)
        scaled = base * 10.0 ** rng.integers(-6, 4, size)
        for x in (base, np.floor(3 * base), halves, np.repeat(base, 2, axis=0)[:n], scaled, np.ones((n, size))):
            one, two = Spectrum.empty(size), Spectrum.empty(size)
            for row in x[: n // 3]:
                one.add(row)
            for row in x[n // 3 :]:
                two.add(row)
            one.merge(Spectrum.from_bytes(two.n, size, two.to_bytes()))
            centred = x - x.mean(axis=0)
            truth = centred.T @ centred
            scale = max(np.abs(truth).max(), 1e-9)
            assert one.n == n and np.allclose(one.mean, x.mean(axis=0))
            assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - truth).max() < 1e-12 * scale
            assert np.abs(one.vectors.T @ one.vectors - np.eye(size)).max() < 1e-12


def check_whitening(rows: list[tuple], found: list, components: int = 16) -> None:
    kept = [(i, np.floor(64.0 * np.array(v, dtype=np.float64))) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, centred = len(fit), fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    sums = [int(s) for s in fit.sum(axis=0)]
    by_component = collections.defaultdict(list)
    for r in found:
        by_component[r.component].append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(centred.T @ centred / n)) < 1e-9
    assert sorted(by_component) == list(range(1, len(values) + 1))
    for k, got in by_component.items():
        truth = sorted((i, sum((n * int(c) - s) ** 2 for c, s in zip(x, sums, strict=True)), float(x @ axes[:, k - 1])) for i, x in kept)
        shift = float(fit.mean(axis=0) @ axes[:, k - 1])
        got = sorted((r.vec_id, r.deviation, r.whitened) for r in got)
        white = np.array([(t[2] - shift) / np.sqrt(values[k - 1]) for t in truth])
        mine = np.array([g[2] for g in got])
        assert [g[:2] for g in got] == [t[:2] for t in truth]
        assert min(np.abs(mine - white).max(), np.abs(mine + white).max()) < 1e-8


def test_whitening_equals_the_plain_covariance(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors(300, 20, 4))]
    rows += [(500 + i, rows[3][1]) for i in range(40)] + [(3, rows[3][1])]
    hostile = [(600, None), (601, [None] * 20), (602, [float("nan")] * 20), (603, [float("inf")] * 20), (604, []), (605, [1.0, 2.0]),
               (606, [1e300] * 20)]
    docs = spark.createDataFrame([(i, v, "own") for i, v in rows + hostile], "vec_id long, embedding array<double>, whitened string")
    model = whitening.fit(docs.repartition(6))
    found = whitening.component_rows(docs, model).collect()
    check_whitening(rows, found)
    # what the updates alone found is the spectrum already
    x = np.unique(np.array([np.floor(64.0 * np.array(v)) for _, v in rows]), axis=0)
    plain = np.linalg.eigvalsh(np.cov(x.T, bias=True) * len(x))
    assert np.abs(model.before.values - plain).max() < 1e-11 * plain.max()
    assert whitening.apply(docs, model).columns == ["vec_id", "embedding", "whitened", "deviation"]


def test_whitening_of_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitening(rows, queries.op12_whitening(spark, sf_dir).collect())


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.5, 0.25])] * 3):
        docs = spark.createDataFrame(rows, schema)
        assert whitening.component_rows(docs, whitening.fit(docs)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)] + [(None, [9.0, 1.0])], schema)
    model = whitening.fit(flat)
    assert model.components.shape == (2, 1) and whitening.component_rows(flat, model).count() == 6
    wide = whitening.Whitening(1 << 40, (1 << 59, 0), np.eye(2), np.ones(2), 2.0, 0.0, None)
    assert wide.deviations(np.array([[0, 5], [1 << 19, 1]])) == [None, 1 << 80 if (1 << 80) < 1 << 63 else None]
    assert whitening.Whitening(3, (7, -2), np.eye(2), np.ones(2), 2.0, 0.0, None).deviations(np.array([[5, -4]])) == [8 ** 2 + 10 ** 2]


# --- spelling variants --------------------------------------------------------


def one_edit(u: str, v: str) -> bool:
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    if len(u) > len(v):
        u, v = v, u
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def brute_variants(texts: list[tuple], every: int = 199, least: int = 6, occurrences: int = 5) -> dict:
    counts = collections.Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= occurrences}
    near = {w: [x for x in words if abs(len(x) - len(w)) <= 1 and one_edit(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w: str) -> str:
        return w if form[w] is None else root(form[w])

    return {w: (n, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, n in words.items()}


def spelled(frame) -> dict:
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


def damaged_texts() -> list[tuple]:
    rng = random.Random(5)
    stems = ["".join(rng.choice("abéñÿ") for _ in range(rng.randrange(6, 10))) for _ in range(60)]
    rows = []
    for i in range(60):
        found = []
        for _ in range(200):
            w = rng.choice(stems[: 1 + rng.randrange(60)])
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w = rng.choice([w[:at] + "b" + w[at:], w[:at] + w[at + 1 :], w[:at] + "À" + w[at + 1 :], w.upper()])
            found.append(w)
        rows.append((i, rng.choice([" ", "-", "1", "\n"]).join(found)))
    # a chain of forms, each five times as frequent as the one before
    chain = ["chainaa", "chainab", "chainbb", "chaincb"]
    rows += [(1000 + i, " ".join(w for k, w in enumerate(chain) for _ in range(5 * 6**k))) for i in range(2)]
    return rows + [(None, None), (None, "CHAINAA nullid nullid nullid nullid nullid"), (5, ""), rows[0], (8, "x" * 9000 + " ÷×÷×÷×÷ ×÷×÷×÷×÷")]


@pytest.mark.parametrize("most", [2048, 3])
def test_variants_equal_brute_force(spark, most):
    docs = spark.createDataFrame([(*r, 1) for r in damaged_texts()], "doc_id long, text string, n int").repartition(3)
    found = spelled(spelling.variants(docs, damage_every=7, least_count=2, most=most))
    truth = brute_variants(damaged_texts(), every=7, occurrences=2)
    assert found == truth
    assert sum(v[2] is not None for v in truth.values()) > 50
    assert any(v[2] and v[4] != v[2] for v in truth.values())  # forms of forms


def test_groups_stay_bounded(spark):
    rng = random.Random(2)
    words = {"shared" * 3 + "".join(rng.choice("abcdef") for _ in range(4)) + "ending" for _ in range(1200)}
    rows = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    dealt = spelling.bounded_groups(rows, most=40)
    assert dealt.groupBy("task").count().agg(F.max("count")).first()[0] <= 40
    pairs = sum(r.n_near for r in spelling.near_words(rows, most=40).collect())
    assert pairs == sum(one_edit(u, v) for u in words for v in words if u != v)


def test_scan_of_a_sorted_list():
    rng = random.Random(1)
    for _ in range(200):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 8))) for _ in range(50)})
        lcp, nearest = spelling.list_jumps(words)
        found = {(i, j) for i in range(len(words)) for j in spelling.near_after(words, lcp, nearest, i)}
        assert found == {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])}


def test_variants_of_no_rows(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "few words only")], "doc_id long, text string")).count() == 0


# --- registered SQL -----------------------------------------------------------


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_same_result_as_sql(spark, sf_dir, key):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    frame = queries.QUERIES[key](spark, sf_dir)
    names = sorted(frame.columns)
    cursor = connection.execute(queries.ORACLE_SQL[key])
    order = [[d[0] for d in cursor.description].index(c) for c in names]
    expected = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in names) for r in frame.collect()), key=str) == expected
