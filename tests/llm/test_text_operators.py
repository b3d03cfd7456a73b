"""Operators on texts against brute force, on hand-made and hostile rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paysignal.llm import huffman_ids, ngram_join, packing, piece_scan, quality, substring_dedup
from paysignal.llm.rows import components, vocabulary_path
from paysignal.llm.unit_tokens import UnitEncoder
from paysignal.session import fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(n: int, seed: int, vocabulary: int = 5000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def hostile_rows() -> list[tuple]:
    """Null values, empty and long texts, odd spaces, copies, near copies, shared passages, repeated rows."""
    base, passage = words(300, 1), words(60, 2)
    near = base.copy()
    near[150] = "changed"
    texts = [
        None, "", "   ", "one", "one", "a b\tc\nd", " ".join(base), " ".join(base), "  ".join(base) + "\n", " ".join(near),
        " ".join(words(100, 3) + passage + words(90, 4)), " ".join(words(80, 5) + passage), " ".join(["again"] * 200),
        " ".join(words(6000, 6, 300)), "é ü ß 漢字 😀 \x00 \x1c \xa0 ▁ <s> <|endoftext|>", "a  b \n\n c\r\n", "x" * 5000,
        " ".join(words(40, 7) * 3), "\n".join(["same line", "other line", "same line", "", "same line"] * 3),
    ]
    rows = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, None) for i, t in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    rows.append((None, "text of a row without id " + " ".join(passage), "en", "s", 1))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(hostile_rows(), SCHEMA).repartition(3).withColumn("score", F.lit("own"))


@pytest.fixture(scope="module")
def stored(spark, docs):
    """The same rows from files: operators that read twice need a stable order."""
    path = fresh_path(spark, "hostile")
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def expected_removal(texts: list[str | None], size: int) -> list[tuple[int, int, str]]:
    cut = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[k : k + size]) for w in cut for k in range(len(w) - size + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("size, cells", [(35, None), (35, 1 << 12), (8, None)])
def test_repeats_are_removed_exactly(stored, size, cells):
    rows = stored.collect()
    found = substring_dedup.remove_repeats(stored, size=size, cells=cells, normalise=True)
    assert set(found.columns) == {*stored.columns, "n_words", "n_removed"}
    expected = [(r.doc_id, *e) for r, e in zip(rows, expected_removal([r.text for r in rows], size), strict=True)]
    assert sorted(map(str, expected)) == sorted(
        str((r.doc_id, r.n_words, r.n_removed, r.text)) for r in found.collect())


def test_texts_without_repeats_stay_as_they_are(spark, empty):
    rows = [(1, "a \n b", "x", "y", 1), (2, None, "x", "y", 1)]
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.doc_id, r.text) for r in found} == {(1, "a \n b"), (2, None)}
    assert substring_dedup.remove_repeats(empty).count() == 0


def jaccard_truth(rows, size=5, threshold=0.8):
    sets = []
    for r in rows:
        w = WORD.findall(r.text or "")
        sets.append({tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set())
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            near[i, j] = near[j, i] = bool(sets[i]) and both >= threshold * len(sets[i] | sets[j])
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i], *(label[j] for j in range(n) if near[i, j])]) for i in range(n)]
    ids = [r.doc_id for r in rows]
    least = [min((ids[j] for j in range(n) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(n)]
    return [(ids[i], least[i], int(near[i].sum())) for i in range(n)]


def variants(n: int, seed: int) -> list[str]:
    """Near and not so near copies of a few texts, and two large buckets."""
    rng = random.Random(seed)
    bases = [words(rng.randint(20, 120), 100 + k) for k in range(6)]
    out = []
    for _ in range(n):
        w = rng.choice(bases).copy()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("small, block", [(128, 512), (4, 8)])
def test_jaccard_groups_match_brute_force(spark, docs, small, block):
    rows = [(1000 + i, t, "en", "s", 1) for i, t in enumerate(variants(70, 4))]
    every = docs.drop("score").unionByName(spark.createDataFrame(rows, SCHEMA))
    found = ngram_join.jaccard_groups(every, small=small, block=block).collect()
    assert sorted(map(str, jaccard_truth(every.collect()))) == sorted(str((r.doc_id, r.class_id, r.n_links)) for r in found)
    by_class = collections.defaultdict(set)
    for r in found:
        if r.kept and r.n_links:
            by_class[r.class_id].add(r.doc_id)
    assert all(len(ids) == 1 and {c} == ids for c, ids in by_class.items() if c is not None)


def test_jaccard_runs_and_empty_input(empty):
    depths = [ngram_join.levels_for(n) for n in (0, 1000, 10**6, 10**10)]
    assert depths == sorted(depths) and depths[0] == 2 and depths[-1] > depths[1]
    for levels in depths:
        assert 1 - (1 - ngram_join.meeting_chance(0.8, levels)) ** ngram_join.runs_for(0.999, 0.8, levels) >= 0.999
    assert ngram_join.jaccard_groups(empty).count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 50)] + [
        (200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(25)]
    parent = {x: x for link in links for x in link}
    for _ in range(200):
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: v for k, v in parent.items() if k not in alone}


def library_ids(name: str, text: str | None) -> list[int]:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing_puts_every_id_in_one_place(docs):
    rows = docs.collect()
    found = packing.pack_documents(docs, vocabulary_path("word_bpe_49k.json")).collect()
    expected = collections.Counter((r.doc_id, tuple([*library_ids("word_bpe_49k.json", r.text), 1])) for r in rows)
    by_document = collections.defaultdict(list)
    for p in found:
        assert len(p.ids) == 4 * p.length and zlib.crc32(bytes(p.ids)) == p.ids_crc32
        by_document[p.doc_id, p.doc_tokens].append(p)
    total = sum(len(ids) * n for (_, ids), n in expected.items())
    assert sum(p.length for p in found) == total
    for (doc_id, ids), n in expected.items():
        parts = sorted(by_document[doc_id, len(ids)], key=lambda p: p.start)
        if n == 1 and sum(k[0] == doc_id and len(k[1]) == len(ids) for k in expected) == 1:
            assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1]]
            assert b"".join(bytes(p.ids) for p in parts) == np.array(ids, dtype="<u4").tobytes()
    sequences = collections.defaultdict(list)
    for p in found:
        sequences[p.sequence_id].append(p)
    open_ = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1]]
        length = sum(p.length for p in parts)
        assert length <= parts[0].tier <= 2048
        open_ += length < parts[0].tier
    assert open_ <= docs.rdd.getNumPartitions()


def test_packer_fills_windows_and_balances_steps(spark):
    rows = [(i, " ".join(words(random.Random(i).randint(1, 900), i)), "en", "s", 1) for i in range(150)]
    found = packing.pack_documents(
        spark.createDataFrame(rows, SCHEMA).coalesce(1), vocabulary_path("word_bpe_49k.json"), step_windows=4, with_ids=False)
    lengths = [r.n for r in found.groupBy("sequence_id", "tier").agg(F.sum("length").alias("n")).filter("n <> tier").collect()]
    assert len(lengths) <= 1
    steps = [r.n for r in found.groupBy("tier", "step_group").agg(F.sum("length").alias("n")).collect()]
    assert max(steps) == 4 * 2048 and sum(s < 4 * 2048 for s in steps) <= 2 * len(packing.TIERS)
    with pytest.raises(ValueError):
        packing.Packer((100, 200))


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty, vocabulary_path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("counts", [[], [5], [1, 1], list(range(1, 300)), [2**k for k in range(40)], [7] * 1000])
def test_code_lengths(counts):
    full = np.zeros(huffman_ids.IDS, dtype=np.int64)
    full[: len(counts)] = counts
    lengths = huffman_ids.code_lengths(full)
    used = lengths[: len(counts)].astype(int)
    assert (used[np.array(counts, dtype=int) > 0] > 0).all() and lengths.max(initial=0) <= huffman_ids.MAX_BITS
    assert sum(2.0**-n for n in used) <= 1
    if 1 < len(counts) < 1000 and max(counts) < 1000:  # not limited: as good as plain Huffman
        import heapq

        heap, cost = sorted(counts), 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a + b
            heapq.heappush(heap, a + b)
        assert int((used * np.array(counts)).sum()) == cost
    rng = np.random.default_rng(len(counts))
    ids = rng.integers(0, max(len(counts), 1), 3000 if len(counts) else 0).astype(np.uint16)
    payload, offsets = huffman_ids.encode_ids(ids, huffman_ids.canonical_codes(lengths), lengths)
    table = huffman_ids.decode_table(lengths)
    assert (huffman_ids.decode_ids(payload, offsets, len(ids), table) == ids).all()
    if len(ids) > huffman_ids.BLOCK:  # a block is read without those before it
        last = huffman_ids.decode_ids(payload, offsets[-1:], len(ids) - (len(offsets) - 1) * huffman_ids.BLOCK, table)
        assert (last == ids[(len(offsets) - 1) * huffman_ids.BLOCK :]).all()


def test_token_files_read_back(spark, docs, empty):
    for frame, rows in ((docs, docs.collect()), (empty, [])):
        path = fresh_path(spark, "token_files")
        huffman_ids.write_ids(frame, path, vocabulary_path("byte_bpe_50k.json"), parts=3)
        found = huffman_ids.read_ids(spark, path).orderBy("start").collect()
        expected = collections.Counter((r.doc_id, crc([*library_ids("byte_bpe_50k.json", r.text), 2])) for r in rows)
        assert collections.Counter((r.id, r.ids_crc32) for r in found) == expected
        assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in found)
        assert [r.start for r in found] == [0, *np.cumsum([r.n_tokens for r in found])[:-1]][: len(found)]
        ids = [-1 if r.id is None else r.id for r in found]
        assert ids == sorted(ids)


def test_wide_ids_beside_null_ones(spark):
    ids = [None, (1 << 53) + 1, (1 << 53) + 3, -(1 << 63), (1 << 63) - 1, 0, -(1 << 53) - 1]
    rows = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").coalesce(1)
    path = fresh_path(spark, "token_files")
    huffman_ids.write_ids(rows, path, vocabulary_path("byte_bpe_50k.json"), parts=2)
    found = {r.id: r.ids_crc32 for r in huffman_ids.read_ids(spark, path).collect()}
    assert found == {i: crc([*library_ids("byte_bpe_50k.json", f"text {i}"), 2]) for i in ids}


def test_pieces_are_those_of_the_library(docs, empty):
    import sentencepiece

    path = vocabulary_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for chunk in (piece_scan.CHUNK, 70):  # whole texts, and cut at arbitrary characters
        found = piece_scan.decode(piece_scan.encode(docs, path, chunk=chunk), path)
        at_once = piece_scan.encode(docs, path, chunk=chunk, with_decoded=True).select("doc_id", "ids", "decoded")
        assert at_once.exceptAll(found.select("doc_id", "ids", "decoded")).isEmpty()
        assert set(found.columns) == {*docs.columns, "ids", "n_pieces", "n_chunks", "decoded"}
        got = collections.Counter((r.doc_id, bytes(r.ids), r.n_pieces, r.decoded) for r in found.collect())
        expected = collections.Counter()
        for r in docs.collect():
            ids = library.encode(r.text or "")
            expected[r.doc_id, np.array(ids, dtype="<u4").tobytes(), len(ids), library.decode(ids)] += 1
        assert got == expected
    assert found.agg(F.max("n_chunks")).first()[0] > 50
    assert piece_scan.encode(empty, path).count() == 0


def test_chunk_matrices_combine_in_any_grouping():
    vocabulary = piece_scan.Pieces(vocabulary_path("piece_bpe_32k.model"))
    shown = piece_scan.SPACE + "unbrokenwordsthatgoonandon" * 6
    steps = []
    for lo in range(0, len(shown), 11):
        first = min(lo, 64)
        part = shown[lo - first : lo + 11 + 64]
        entries, exits, _ = vocabulary.chunk(part, first, first + min(11, len(shown) - lo), lo == 0)
        steps.append({s: {x for x, mask in exits if mask >> k & 1} for k, s in enumerate(entries)})
    left = steps[0]
    for step in steps[1:]:
        left = piece_scan.combine(left, step)
    right = steps[-1]
    for step in reversed(steps[:-1]):
        right = piece_scan.combine(step, right)
    assert left == right[(0, "")] or left == {(0, ""): right[(0, "")]}


def quality_truth(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    again = [False] * len(w)
    for k in range(len(w) - 7):
        if windows[tuple(w[k : k + 8])] > 1:
            again[k : k + 8] = [True] * 8
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * sum(again) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(again), failed)


def test_quality_counts_and_thresholds(spark, docs, empty):
    clean = [(2000 + i, " ".join(words(60, i)) + ".", "en", f"s{i % 2}", 1) for i in range(60)]
    junk = [(3000 + i, " ".join(f"{w}###" for w in words(60, 500 + i)), "en", "s0", 1) for i in range(20)]
    loud = [(4000 + i, " ".join(words(60, 700 + i)).upper(), "en", "rare", 1) for i in range(3)]
    every = docs.drop("score").unionByName(spark.createDataFrame(clean + junk + loud, SCHEMA)).withColumn("kept", F.lit(1))
    found = quality.judge(every, prior=10)
    assert found.columns == [*every.columns, "_quality"]
    rows = found.collect()
    for r in rows:
        q = r._quality
        assert tuple(q[c] for c in quality.COUNTS) + (q.base_failed,) == quality_truth(r.text)
        assert not (q.base_failed and q.kept)
    kept = {r.doc_id for r in rows if r._quality.kept}
    assert {r[0] for r in clean} <= kept
    assert not {r[0] for r in junk + loud} & kept  # the rare source takes the bounds of its language
    assert quality.judge(empty).count() == 0

    def bound(rare):
        counted = quality.count(clean_rows.unionByName(rare))
        return quality.thresholds(counted, "lang", "source").filter("_source = 'rare'").first()["_bounds"]["most_symbols"]

    # a group's bounds move with its size without a jump
    clean_rows = spark.createDataFrame(clean, SCHEMA)
    rare = [(5000 + i, " ".join(f"{w}###" for w in words(60, 700 + i)), "en", "rare", 1) for i in range(201)]
    few, fewer, more = (bound(spark.createDataFrame(rare[:n], SCHEMA)) for n in (2, 199, 201))
    assert few < fewer and abs(more - fewer) < 0.02
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


def test_ids_are_counted_where_they_are_made(spark, docs):
    rows = docs.select("doc_id", "text").repartitionByRange(3, "doc_id")
    plain = huffman_ids._tokenise(rows, "doc_id", "text", vocabulary_path("byte_bpe_50k.json"), 2).collect()
    counted = {r.part: int(np.frombuffer(r.counts, dtype="<i8").sum()) for r in plain if r.counts is not None}
    ids = {}
    for r in plain:
        ids[r.part] = ids.get(r.part, 0) + r.n_ids
    assert counted == ids


def test_short_texts_need_no_tasks_for_long_ones(spark):
    rows = spark.createDataFrame([(1, "a few words"), (2, None), (3, "more, and more words")], "doc_id long, text string")
    path = vocabulary_path("piece_bpe_32k.model")
    short = piece_scan.encode(rows, path, with_decoded=True)
    assert "FlatMapGroupsInPandas" not in short._jdf.queryExecution().toString()
    mixed = piece_scan.encode(rows, path, chunk=15, with_decoded=True)
    assert "FlatMapGroupsInPandas" in mixed._jdf.queryExecution().toString()
    shown = lambda df: sorted((r.doc_id, bytes(r.ids), r.decoded) for r in df.collect())
    assert shown(short) == shown(mixed)


def test_new_words_share_calls_of_the_model(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    class Counted:
        def __init__(self, model):
            self.model, self.calls = model, 0

        def tokenize(self, text):
            self.calls += 1
            return self.model.tokenize(text)

    rng = random.Random(5)
    made = ["".join(rng.choice("abcdeéßñ漢Σ") for _ in range(rng.randint(1, 12))) for _ in range(3200)]
    texts = ["", "a", *(" ".join(w + rng.choice(("", "", ",", "!!", "\n")) for w in made[i : i + 100]) for i in range(0, 3200, 100))]
    coder = UnitEncoder(vocabulary_path("byte_bpe_50k.json"), True)
    coder.model = Counted(coder.model)
    ids, bounds = coder.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [library_ids("byte_bpe_50k.json", t) for t in texts]
    assert 0 < coder.model.calls <= len(made) // 16

    # a vocabulary that merges across the character between words: each word has a call of its own
    symbols = sorted(pre_tokenizers.ByteLevel.alphabet())
    tiny = Tokenizer(models.BPE(vocab={s: i for i, s in enumerate([*symbols, "Āa"])}, merges=[("Ā", "a")]))
    tiny.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tiny.save(str(tmp_path / "tiny.json"))
    coder = UnitEncoder(str(tmp_path / "tiny.json"), True)
    assert not coder.words_apart
    assert coder.encode(pa.array(["a a\na"]))[0].tolist() == tiny.encode("a a\na").ids


@pytest.mark.parametrize("n", [1, huffman_ids._STEP, huffman_ids._STEP + 1, 2 * huffman_ids._STEP + 300])
def test_blocks_run_on_over_steps(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 5000).astype(np.uint16)
    lengths = huffman_ids.code_lengths(np.bincount(ids, minlength=huffman_ids.IDS))
    codes = huffman_ids.canonical_codes(lengths)
    payload, offsets = huffman_ids.encode_ids(ids, codes, lengths)
    bits = "".join(format(codes[i], f"0{lengths[i]}b") for i in ids)
    assert payload == int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(len(payload), "big")
    assert offsets.tolist() == [0, *np.cumsum(lengths[ids].astype(int))[huffman_ids.BLOCK - 1 : n - 1 : huffman_ids.BLOCK]]
    assert (huffman_ids.decode_ids(payload, offsets, n, huffman_ids.decode_table(lengths)) == ids).all()
