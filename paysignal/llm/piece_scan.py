"""SentencePiece encoding by a max-plus scan over chunks, and decoding.

An encoding is a path of pieces through the text. A step from one piece to the next
weighs 0 if the two may stand side by side and minus infinity if not, and the best
path is the encoding. For a vocabulary of merges (type BPE), two pieces may do so if encoding their
joined text gives the same two pieces; since merges are picked greedily over the
whole text, a path without a forbidden step is the encoding, and there is only
one. So the ids are those of the library, by a scan that can be cut anywhere.

The state at a chunk border is the piece that covers the last character before it. A chunk
yields the matrix of best weights from the states at its left border to those at
its right border; as all weights are 0 or minus infinity, a row of it is a set.
Matrices are combined associatively, in order, with max and plus. Once the states
at all borders are known, every chunk is traced back on its own, and its pieces
are those that begin in it. No piece holds a space after another character, so a
stretch between spaces is met anew in the same state; such stretches are looked up
once seen.

Texts of up to ``CHUNK`` characters are one chunk and are read where they lie. Longer ones are cut into
chunk rows that are spread over the tasks; what meets again per document is one
small matrix per chunk, and in the end its ids.

Cases: null and empty texts have no pieces; characters without a piece become their UTF-8
bytes; U+2581 in a text stands for a space, as in the library, so it is
decoded as one; repeated rows are encoded each; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.rows import KEYS, row_keys
from paysignal.llm.task_memory import holders, tidy
from paysignal.llm.unit_tokens import GLUED, UnitEncoder
from paysignal.llm.words import row_slices, text_buffers
from paysignal.session import stage

CHUNK = 1 << 16
CACHE_UNITS = 300_000
CACHE_PAIRS = 400_000
CACHE_SPINES = 20_000
_SLICE_BYTES = 4 << 20
SPACE = "▁"

State = tuple[int, str]  # where the piece begins, relative to the border, and the piece


class Pieces:
    """Vocabulary of a SentencePiece model file and the steps it allows."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: dict[int, int] = {}  # byte to id
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.ids[piece] = i
                self.scores[piece] = model.get_score(i)
        if len(self.bytes) != 256 or model.get_piece_size() > 1 << 16:
            raise ValueError("the model has no byte pieces, or more than 65 536 pieces")
        self.longest = max(map(len, self.ids), default=1)
        self.units_apart = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.pairs: dict[str, bool] = {}
        self.spines: dict[str, tuple[set[str], set[str]]] = {}
        # pieces that are the encoding of their own text
        self.whole_pieces = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        self.prefixes = {p[:k] for p in self.whole_pieces for k in range(1, len(p) + 1)}

    def merged(self, text: str, spine: tuple[set[str], set[str]] | None = None) -> list[str]:
        """Greedy merges of the best-scored adjacent pair, leftmost first: what a pair of pieces is tested with.

        ``spine`` collects the parts that stand first and last on the way.
        """
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if spine:
                spine[0].add(parts[0])
                spine[1].add(parts[-1])
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: str, right: str) -> bool:
        key = f"{left}\n{right}"
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            # without a piece over the border there is nothing to decide
            found = not any(a + b in self.ids for a in self._spine(left)[1] for b in self._spine(right)[0])
            found = found or self.merged(left + right) == [left, right]
            self.pairs[key] = found
        return found

    def _spine(self, piece: str) -> tuple[set[str], set[str]]:
        found = self.spines.get(piece)
        if found is None:
            found = ({piece}, {piece})
            self.merged(piece, found)
            if len(self.spines) < CACHE_SPINES:
                self.spines[piece] = found
        return found

    def starting(self, text: str, at: int) -> list[str]:
        """Pieces that the text has at a place; a character without a piece stands for itself."""
        found = [text[at]]
        for stop in range(at + 2, min(at + self.longest, len(text)) + 1):
            piece = text[at:stop]
            if piece not in self.prefixes:
                break
            if piece in self.whole_pieces:
                found.append(piece)
        return found

    def scan(self, text: str, first: int, last: int, entries: list[State] | None) -> tuple[list[dict], list[State]]:
        """Weights along ``text[first:last]``: for every place, which pieces may end there and from which entry states.

        ``entries`` are states at ``first`` (None: the text begins there). The result maps, for every place, each
        piece that ends there to the set of entries (a bit mask) from which it is reached; and lists the exit states, pieces
        that cover the character before ``last`` (those that end behind it too).
        """
        ends: list[dict[str, int]] = [{} for _ in range(len(text) + 1)]
        if entries is None:
            ends[first][""] = 1
        else:
            for k, (start, piece) in enumerate(entries):
                at = first + start + len(piece)
                if at <= len(text):
                    ends[at][piece] = ends[at].get(piece, 0) | 1 << k
        exits: dict[State, int] = {}
        for piece_start in range(first, last):
            before = ends[piece_start]
            if not before:
                continue
            for piece in self.starting(text, piece_start):
                mask = 0
                for left, sources in before.items():
                    if not left or self.may_follow(left, piece):
                        mask |= sources
                if mask:
                    stop = piece_start + len(piece)
                    ends[stop][piece] = ends[stop].get(piece, 0) | mask
                    if stop >= last:
                        exits[(piece_start - last, piece)] = mask
        if entries is not None:  # an entry may reach over the whole chunk
            for k, (start, piece) in enumerate(entries):
                if first + start + len(piece) >= last:
                    exits[(first + start - last, piece)] = exits.get((first + start - last, piece), 0) | 1 << k
        return ends, list(exits.items())

    def trace(self, ends: list[dict], first: int, last: int, entry: int, leaving: State) -> list[str]:
        """Pieces that begin in ``[first, last)``, on the path from an entry (its bit) to an exit state."""
        start, piece = leaving
        at = last + start
        found: list[str] = []
        bit = 1 << entry
        while at >= first and piece:
            found.append(piece)
            for left, mask in ends[at].items():
                if mask & bit and (not left or self.may_follow(left, piece)):
                    if at - len(left) < first or not left:
                        return found[::-1]
                    piece, at = left, at - len(left)
                    break
            else:
                raise AssertionError("no way back")
        return found[::-1]

    def unit(self, text: str) -> bytes:
        """Ids of a stretch that nothing outside can change.

        With a single entry, one piece at most can end at a place, as every prefix has one encoding.
        """
        n = len(text)
        ending: list[str | None] = [None] * (n + 1)
        ending[0] = ""
        pairs, whole, prefixes = self.pairs, self.whole_pieces, self.prefixes
        for at in range(n):
            left = ending[at]
            if left is None:
                continue
            for stop in range(at + 1, n + 1):
                piece = text[at:stop]
                if stop > at + 1:
                    if piece not in prefixes:
                        break
                    if piece not in whole:
                        continue
                if ending[stop] is None:
                    fits = not left or pairs.get(f"{left}\n{piece}")
                    if fits is None:
                        fits = self.may_follow(left, piece)
                    if fits:
                        ending[stop] = piece
        back: list[str] = []
        while n:
            back.append(ending[n])
            n -= len(ending[n])
        return self.to_ids(back[::-1])

    def to_ids(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is None:
                out += (self.bytes[b] for b in piece.encode())
            else:
                out.append(known)
        return np.array(out, dtype="<u2").tobytes()

    def whole(self, text: str) -> bytes:
        """Ids of a text that is one chunk, stretch by stretch."""
        if not text:
            return b""
        shown = SPACE + text.replace(" ", SPACE)
        return b"".join(map(self.unit, self.cut(shown)))

    def cut(self, shown: str) -> list[str]:
        """Stretches that begin with spaces (but for the first); the whole where pieces may span them."""
        if not self.units_apart:
            return [shown]
        parts = shown.split(SPACE)
        if "" not in parts[1:]:
            units = [SPACE + p for p in parts[1:]]
            return [parts[0], *units] if parts[0] else units
        units, spaces = ([parts[0]] if parts[0] else []), 0
        for part in parts[1:]:
            spaces += 1
            if part:
                units.append(SPACE * spaces + part)
                spaces = 0
        if spaces:
            units.append(SPACE * spaces)
        return units

    def entry_states(self, text: str, border: int) -> list[State]:
        """All pieces that might cover the character before ``border``, in a fixed order."""
        states = []
        for start in range(max(border - self.longest, 0), border):
            for piece in self.starting(text, start):
                if start + len(piece) >= border:
                    states.append((start - border, piece))
        return states

    def chunk(self, text: str, first: int, last: int, begins: bool) -> tuple[list[State], list[tuple[State, int]], tuple]:
        """Transfer matrix of ``text[first:last]``: entry states, exit states with the entries that reach them, and
        what tracing back needs. Only the stretches at the two borders are scanned: between them every state forgets."""
        entries = None if begins else self.entry_states(text, first)
        cuts = []
        if self.units_apart:
            at = text.find(SPACE, first + 1)
            while 0 <= at < last:
                if text[at - 1] != SPACE:
                    cuts.append(at)
                    break
                at = text.find(SPACE, at + 1)
            if cuts:
                at = text.rfind(SPACE, cuts[0], last)
                while at > cuts[0] and text[at - 1] == SPACE:
                    at -= 1
                cuts.append(at)
        if not cuts:
            ends, exits = self.scan(text, first, last, entries)
            return entries or [(0, "")], exits, (ends, None, None, None)
        a, b = cuts
        ends, reached = self.scan(text[:a], first, a, entries)
        fits = 0
        for (start, piece), mask in reached:
            if start + len(piece) == 0:
                fits |= mask
        tail, exits = self.scan(text, b, last, None)
        return entries or [(0, "")], [(s, fits) for s, _ in exits], (ends, reached, (a, b), tail)

    def trace_chunk(
        self, text: str, first: int, last: int, begins: bool, entry: int, leaving: State, units: PieceUnits | None = None,
    ) -> bytes:
        _, _, (ends, reached, cuts, tail) = self.chunk(text, first, last, begins)
        if cuts is None:
            return self.to_ids(self.trace(ends, first, last, entry, leaving))
        a, b = cuts
        inner = next(s for s, mask in reached if mask >> entry & 1 and s[0] + len(s[1]) == 0)
        head = self.to_ids(self.trace(ends, first, a, entry, inner) if a + inner[0] >= first else [])
        inside = text[a:b]
        if units is None or b <= a:
            middle = b"".join(map(self.unit, self.cut(inside)))
        else:  # the first space is put in front again
            middle = units.encode(pa.array([inside[1:].replace(SPACE, " ")], pa.string()))[0].tobytes()
        return head + middle + self.to_ids(self.trace(tail, b, last, 0, leaving))

class PieceUnits(UnitEncoder):
    """Looks up stretches of text that were scanned before; ids are 16 bits wide.

    A text may be cut between two characters that never stand side by side within a piece: before a space,
    around a line break, and between a letter and a mark where the vocabulary has no such piece.
    """

    def __init__(self, path: str, cache_units: int = CACHE_UNITS):
        self.pieces = Pieces(path)
        self.cache: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        self.cache_units = cache_units
        inner = [p.lstrip(SPACE) for p in self.pieces.ids]
        beside = {(a, b) for p in inner for a, b in zip(p, p[1:])}  # noqa: B905
        self.marks = [m for m in (",", ".") if not any(b == m and a.isalnum() for a, b in beside)]
        self.cuts = self.pieces.units_apart and not any("\n" in p for p in inner)

    def whole(self, text: str) -> np.ndarray:
        return np.frombuffer(self.pieces.whole(text), dtype="<u2")

    def _units(self, texts: pa.Array) -> pa.ListArray:
        if not self.cuts:
            return pc.split_pattern(texts, GLUED)  # no cut is certain: whole texts are the units
        for mark in self.marks:
            texts = pc.replace_substring(texts, f"{mark} ", f" {GLUED}{mark} ")
            texts = pc.replace_substring(texts, f"{mark}\n", f" {GLUED}{mark}\n")
        return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")

    def _learn(self, units: list[str]) -> None:
        for unit in units:
            if not unit or SPACE in unit or not self.cuts:
                self.cache[unit] = False
            elif unit[0] == GLUED:
                self.cache[unit] = self.pieces.unit(unit[1:])
            else:
                self.cache[unit] = self.pieces.unit(unit if unit[0] == "\n" else SPACE + unit)


def combine(left: dict[State, set[State]], right: dict[State, set[State]]) -> dict[State, set[State]]:
    """Max-plus product of two transfer matrices with weights 0 and minus infinity (rows are entry states)."""
    return {entry: set().union(*(right.get(middle, set()) for middle in exits)) for entry, exits in left.items()}


def border_states(matrices: list[dict[State, set[State]]], start: State, last: State) -> list[State]:
    """The state at every border, first and last included: reachable from the start and leading to the end."""
    reached = [{start}]
    for matrix in matrices:
        reached.append(set().union(*(matrix.get(s, set()) for s in reached[-1])))
    path = [last]
    for matrix, possible in zip(reversed(matrices), reversed(reached[:-1]), strict=True):
        path.append(next(s for s in possible if path[-1] in matrix.get(s, set())))
    return path[::-1]


class Decoder:
    """Bytes of every id; control pieces show nothing."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def shown(i: int) -> bytes:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                return bytes([int(piece[1:-1], 16)])
            return b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(SPACE, " ").encode()

        self.shown = [shown(i) for i in range(model.get_piece_size())]

    def text(self, ids: np.ndarray) -> bytes:
        """Text of ids, without the space that encoding puts in front."""
        out = b"".join(map(self.shown.__getitem__, ids.tolist()))
        return out[1:] if out[:1] == b" " else out


_units: dict[str, PieceUnits] = {}
_decoders: dict[str, Decoder] = {}
HOLDER = "pieces"


def forget() -> None:
    _units.clear()
    _decoders.clear()


holders[HOLDER] = forget


def units_of(path: str) -> PieceUnits:
    """One vocabulary per worker process; what it has learned outlives the tasks."""
    if path not in _units:
        _units.clear()
        _units[path] = PieceUnits(path)
    return _units[path]


def decoder(path: str) -> Decoder:
    if path not in _decoders:
        _decoders.clear()
        _decoders[path] = Decoder(path)
    return _decoders[path]


def pieces(path: str) -> Pieces:
    return units_of(path).pieces


def _giants(docs: DataFrame, text_column: str, path: str, chunk: int) -> DataFrame | None:
    """(_k1, _k2, ids, n_chunks) of the texts that are longer than a chunk; None without such a text.

    Its tasks run beside those of the short texts, in workers of their own; they read the vocabulary only for rows and drop
    it at their end, so that an executor holds the caches of few workers.
    """
    shown = F.concat(F.lit(SPACE), F.replace(F.col(text_column), F.lit(" "), F.lit(SPACE)))
    long = docs.filter(F.length(text_column) >= chunk).select(*KEYS, shown.alias("shown")).dropDuplicates(KEYS)
    n = F.ceil(F.length("shown") / chunk).cast("int")
    margin = 64  # context on both sides; checked against the longest piece
    rows = long.select("*", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("number")).select(
        *KEYS, "n", "number", F.least(F.lit(margin), F.col("number") * chunk).alias("before"),
        F.substring(F.col("shown"), F.greatest(F.col("number") * chunk - margin, F.lit(0)) + 1,
                    F.least(F.lit(margin), F.col("number") * chunk) + chunk + margin).alias("part"),
        F.least(F.lit(chunk), F.length("shown") - F.col("number") * chunk).alias("size"))
    rows = stage(rows.repartition(*KEYS, "number"), "chunks")
    if rows.isEmpty():
        return None

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vocabulary = pieces(path)
            if vocabulary.longest > margin:
                raise ValueError("pieces are longer than the context of a chunk")
            found = []
            for row in batch.select(["part", "before", "size", "number"]).to_pylist():
                first, last = row["before"], row["before"] + row["size"]
                entries, exits, _ = vocabulary.chunk(row["part"], first, last, row["number"] == 0)
                found.append([[list(s), [list(x) for x, mask in exits if mask >> k & 1]] for k, s in enumerate(entries)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*KEYS, "number")), pa.array([repr(f) for f in found])], names=[*KEYS, "number", "matrix"])

    def scan(key, group):
        import ast

        import pandas as pd

        group = group.sort_values("number")
        steps = [
            {tuple(s): {tuple(x) for x in exits} for s, exits in ast.literal_eval(m)} for m in group["matrix"]]
        start = (0, "")
        total = _reduce(steps)  # the ends that the whole text allows
        last = next(s for s in total[start] if s[0] + len(s[1]) == 0)
        path_ = border_states(steps, start, last)
        entry = [list(m).index(s) for m, s in zip(steps, path_[:-1], strict=True)]
        return pd.DataFrame({
            "_k1": key[0], "_k2": key[1], "number": group["number"].to_numpy(), "entry": entry,
            "leaving_at": [s[0] for s in path_[1:]], "leaving": [s[1] for s in path_[1:]]})

    small = rows.mapInArrow(tidy(matrices, after=forget), "_k1 long, _k2 long, number int, matrix string")
    states = small.groupBy(*KEYS).applyInPandas(
        scan, "_k1 long, _k2 long, number int, entry int, leaving_at int, leaving string")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vocabulary = pieces(path)
            ids = [
                vocabulary.trace_chunk(
                    r["part"], r["before"], r["before"] + r["size"], r["number"] == 0, r["entry"], (r["leaving_at"], r["leaving"]),
                    units_of(path))
                for r in batch.select(["part", "before", "size", "number", "entry", "leaving_at", "leaving"]).to_pylist()]
            wide = [np.frombuffer(i, dtype="<u2").astype("<u4").tobytes() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*KEYS, "number")), pa.array(wide, pa.binary())], names=[*KEYS, "number", "ids"])

    traced = rows.join(states, [*KEYS, "number"]).mapInArrow(tidy(trace, after=forget), "_k1 long, _k2 long, number int, ids binary")
    ordered = F.array_sort(F.collect_list(F.struct("number", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return traced.groupBy(*KEYS).agg(F.count(F.lit(1)).cast("int").alias("n_chunks"), joined.alias("ids"))


def _reduce(steps: list[dict]) -> dict:
    """Product of all matrices, pairwise."""
    while len(steps) > 1:
        steps = [combine(a, b) for a, b in zip(steps[::2], steps[1::2])] + ([steps[-1]] if len(steps) % 2 else [])  # noqa: B905
    return steps[0]


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", chunk: int = CHUNK, with_decoded: bool = False,
) -> DataFrame:
    """``docs`` with ``ids`` (little-endian, 32 bits), ``n_pieces`` and ``n_chunks`` (equally named columns are replaced).

    ``with_decoded`` adds the text of the ids as ``decoded`` in the same pass.
    """
    added = ["ids", "n_pieces", "n_chunks", *(["decoded"] if with_decoded else [])]
    plain = docs.drop(*added)
    names = plain.columns
    place = names.index(text_column)
    keyed = plain.select("*", *row_keys(id_column, text_column))
    giant = F.coalesce(F.length(text_column) >= chunk, F.lit(False))
    schema = T.StructType([*plain.schema.fields, T.StructField("ids", T.BinaryType()), T.StructField("n_chunks", T.IntegerType()),
                           *([T.StructField("decoded", T.StringType())] if with_decoded else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            _, limits = text_buffers(column)
            for lo, hi in row_slices(limits, _SLICE_BYTES):
                ids, bounds = units_of(path).encode(column.slice(lo, hi - lo))
                wide = ids.astype("<u4").tobytes()
                raw = [wide[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                part = batch.slice(lo, hi - lo)
                more = [pa.array(raw, pa.binary()), pa.array([1 if r else 0 for r in raw], pa.int32())]
                if with_decoded:
                    more.append(_shown(path, raw))
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*names, "ids", "n_chunks", "decoded"][: len(names) + len(more)])

    every = plain.filter(~giant).mapInArrow(tidy(run, HOLDER), schema)
    found = _giants(keyed, text_column, path, chunk)
    if found is not None:
        large = keyed.filter(giant).join(found, KEYS).select(*names, "ids", "n_chunks")
        every = every.unionByName(decode(large, path) if with_decoded else large)
    return every.withColumn("n_pieces", (F.octet_length("ids") / 4).cast("long"))


def _shown(path: str, raw: list[bytes | None]) -> pa.Array:
    texts = [
        None if ids is None else decoder(path).text(np.frombuffer(ids, dtype="<u4")).decode("utf-8", "replace") for ids in raw]
    return pa.array(texts, pa.string())


def decode(coded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``coded`` with the text of its ids as ``decoded`` (an equally named column is replaced)."""
    plain = coded.drop("decoded")
    names = plain.columns
    place = names.index(ids_column)
    schema = T.StructType([*plain.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _shown(path, batch.column(place).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*names, "decoded"])

    return plain.mapInArrow(tidy(run, after=forget), schema)
