"""SentencePiece BPE encoding by a prefix table, and decoding.

The encoding of a prefix of a text ends in one token, and that token is unique:
among the vocabulary pieces that end at this place it is the one whose
predecessor (the last token of the prefix before it) it is compatible with, that
is, merging the two pieces' characters from scratch gives back the same two
pieces. So one left-to-right pass with an Aho-Corasick automaton over the pieces
fills a table of last tokens in linear time, and the ids are read off the table
backwards. Pieces that merging can never produce are left out of the automaton;
characters outside the vocabulary become byte pieces and never merge.

No piece has the space sign after another character, so a text is cut before
each run of spaces and the cuts are encoded one by one, with a bounded cache of
recent ones per Python worker.

Runs of spaces have pieces whose scores are not in the order in which they are
built; those runs (two signs or more) are merged directly with a heap.

A null text counts as empty: no tokens. Whole texts of any length are encoded;
extra columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import turn_to

SPACE = "▁"
CUT = re.compile(" *[^ ]+| +")
RECENT_CUTS = 150_000
RECENT_PAIRS = 200_000
LONGEST_CACHED = 40
SHORT = 32
NEVER = float("-inf")


class Recent(dict):
    """A cache of two generations, each of at most ``limit`` entries; ``make`` computes what is missing."""

    def __init__(self, make, limit: int) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class PieceTable:
    """A BPE vocabulary of (piece, score, kind) rows; kind is ``n`` normal, ``b`` byte, ``x`` never in a text."""

    def __init__(self, rows: list[tuple[str, float, str]], reachable: list[int] | None = None) -> None:
        import ahocorasick

        self.rows = rows
        self.ids = {p: i for i, (p, _, kind) in enumerate(rows) if kind == "n"}
        self.score = {p: rows[i][1] for p, i in self.ids.items()}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(rows) if kind == "b"}
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.reachable = [i for p, i in self.ids.items() if self.merge(p) == [p]] if reachable is None else reachable
        self.automaton = ahocorasick.Automaton()
        for i in self.reachable:
            self.automaton.add_word(rows[i][0], (len(rows[i][0]), i))
        self.automaton.make_automaton()
        self.fits = Recent(self._fits, RECENT_PAIRS)
        self.cuts = Recent(self._cut, RECENT_CUTS)

    def merge(self, text: str) -> list[str]:
        """The pieces of ``text`` by repeated merging of the best pair, leftmost first among equals."""
        if len(text) <= SHORT:
            return self._merge_short(text)
        n = len(text)
        part, right = list(text), [*range(1, n), -1]
        left = list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] >= 0:
                pair = part[i] + part[right[i]]
                if pair in self.score:
                    heapq.heappush(heap, (-self.score[pair], i, pair))

        for i in range(n):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = right[i]
            if part[i] is None or j < 0 or part[i] + part[j] != pair:
                continue
            part[i], part[j] = pair, None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            offer(i)
            offer(left[i])
        return [p for p in part if p is not None]

    def _merge_short(self, text: str) -> list[str]:
        part, score = list(text), self.score
        pairs = [score.get(a + b, NEVER) for a, b in zip(part, part[1:])]
        while pairs and (best := max(pairs)) > NEVER:
            i = pairs.index(best)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score.get(part[i - 1] + part[i], NEVER)
            if i < len(pairs):
                pairs[i] = score.get(part[i] + part[i + 1], NEVER)
        return part

    def _fits(self, pair: int) -> bool:
        a, b = self.rows[pair >> 32][0], self.rows[pair & 0xFFFFFFFF][0]
        return self.merge(a + b) == [a, b]

    def ids_of(self, cut: str) -> list[int]:
        """The ids of one cut by the prefix table."""
        last: list[int | None] = [None] * (len(cut) + 1)
        fits = self.fits
        for end, (size, token) in self.automaton.iter(cut):
            end += 1
            if last[end] is None:
                start = end - size
                before = last[start] if start else None
                if before is None or fits[before << 32 | token]:
                    last[end] = token
        out, end = [], len(cut)
        while end:
            token = last[end]
            if token is None:
                out += [self.byte[b] for b in reversed(cut[end - 1].encode())]
                end -= 1
            else:
                out.append(token)
                end -= len(self.rows[token][0])
        return out[::-1]

    def _cut(self, cut: str) -> str | tuple[str, str]:
        """The ids of a cut, joined; with the text they spell where that is not the cut again."""
        signs = cut.replace(" ", SPACE)
        if signs.startswith(SPACE * 2):
            ids = [i for p in self.merge(signs) for i in ([self.ids[p]] if p in self.ids else [self.byte[b] for b in p.encode()])]
        else:
            ids = self.ids_of(signs)
        joined, text = ",".join(map(str, ids)), self.surface(ids)
        return joined if text == cut else (joined, text)

    def surface(self, ids: list[int]) -> str:
        """The pieces of the ids one after the other, byte pieces as the characters they spell."""
        out, raw = [], bytearray()
        for i in [*ids, -1]:
            if i in self.of_byte:
                raw.append(self.of_byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i >= 0 and self.rows[i][2] == "n":
                out.append(self.rows[i][0])
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, without the space that encoding puts in front."""
        text = self.surface(ids)
        return text[1:] if text.startswith(" ") else text

    def run(self, text: str) -> tuple[str, int, str]:
        """Ids joined by commas, their number, and the decoded text."""
        if not text:
            return "", 0, ""
        # the space sign itself is a space to the model; one space goes in front
        text = " " + text.replace(SPACE, " ")
        cuts = CUT.findall(text)
        recent = self.cuts
        done = [recent[c] if len(c) <= LONGEST_CACHED else self._cut(c) for c in cuts]
        try:
            ids = ",".join(done)
        except TypeError:  # some cut does not spell itself
            text = "".join([c if isinstance(x, str) else x[1] for c, x in zip(cuts, done)])
            ids = ",".join([x if isinstance(x, str) else x[0] for x in done])
        return ids, ids.count(",") + 1, text[1:] if text.startswith(" ") else text

    def encode(self, text: str) -> list[int]:
        ids = self.run(text)[0]
        return [int(i) for i in ids.split(",")] if ids else []


_loaded: dict[str, PieceTable] = {}


def load_rows(model_path: str) -> list[tuple[str, float, str]]:
    """The vocabulary of a SentencePiece model file, read once on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    kind = lambda i: "b" if sp.is_byte(i) else "x" if sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i) else "n"
    return [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]


def table_of(model_path: str) -> PieceTable:
    if model_path not in _loaded:
        _loaded[model_path] = PieceTable(load_rows(model_path))
    return _loaded[model_path]


def worker_table(model_path: str, shared) -> PieceTable:
    """The table of a Python worker; module state, so one worker's tasks share its caches."""
    turn_to("pieces", _loaded.clear)
    if model_path not in _loaded:
        _loaded[model_path] = PieceTable(*shared.value)
    return _loaded[model_path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model_path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per document; with ``keep_ids`` also ids and decoded.

    The vocabulary (its size is fixed by the model) is read on the driver and
    broadcast, so executors need no model file.
    """
    path = model_path or default_model()
    table = table_of(path)
    shared = docs.sparkSession.sparkContext.broadcast((table.rows, table.reachable))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_table(path, shared).run
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                done = [encode(t or "") for t in part.column("text").to_pylist()]
                digest = lambda k: pa.array([hashlib.sha256(x[k].encode()).hexdigest() for x in done], pa.string())  # noqa: B023, E731
                columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array([x[1] for x in done], pa.int64()), "ids_sha256": digest(0), "decoded_sha256": digest(2)}
                if keep_ids:
                    columns["ids"] = pa.array([[int(i) for i in x[0].split(",")] if x[0] else [] for x in done], pa.list_(pa.int32()))
                    columns["decoded"] = pa.array([x[2] for x in done], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
