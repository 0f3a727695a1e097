"""SentencePiece encoding and decoding with a given vocabulary.

An Aho-Corasick automaton over all pieces reads a text once. At every position it reports the pieces that
end there (its own match and those along the output links); each of them offers the best score at its
start plus its own, and the best offer stands (Viterbi). Of equal offers the longest last piece wins. A
character that is no piece is written as its UTF-8 bytes.

No piece has a space sign after another character or holds a line end. So the best path of a text is the
best paths of its stretches between such places, one after another, and the paths of frequent stretches
are kept in a bounded cache. The others of a slice of texts take their steps together, place by place, in
arrays; long ones, which would hold up the rest, each on their own. The vocabulary is a file of fixed size
that the driver reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable, Iterator
from functools import cached_property
from hashlib import sha256
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyair.llm.common import chunks, lean

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: How far below the worst piece a character stands that is written as bytes.
UNKNOWN_PENALTY = 10.0
#: Bytes of stretches whose paths are kept within a task, in two generations, and the longest of them in characters.
_CACHED_BYTES = 16 << 20
_CACHED_LENGTH = 48
#: Bytes of text cut out of a batch at a time, and its rows when they are ids.
_SLICE_BYTES = 256 << 10
_SLICE_ROWS = 256
#: Characters whose stretches are looked up together, and places of new stretches that are held in arrays together.
_GROUP = 1 << 18
_BLOCK = 1 << 17
#: Entries of the automaton's table of next states, and the characters it has at most.
_TABLE = 1 << 22
_COMMON = 40


class Vocabulary(NamedTuple):
    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]  # ids of the 256 byte pieces
    plain: list[bool]  # which ids are pieces of text


def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    pieces = [model.id_to_piece(i) for i in ids]
    return Vocabulary(
        pieces,
        [model.get_score(i) for i in ids],
        [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
        [not s for s in special],
    )


class Automaton:
    """An Aho-Corasick automaton in arrays, which many texts step through at once. State 0 is the root.

    Characters are numbered by how many edges they have. The next state is in a table for the first ``common`` of them;
    for others the edges are searched and the failure links followed.
    """

    def __init__(self, pieces: list[tuple[int, str]], scores: list[float]) -> None:
        signs = np.frombuffer("".join(p for _, p in pieces).encode("utf-32-le"), dtype="<u4")
        widths = np.fromiter((len(p) for _, p in pieces), dtype=np.int64, count=len(pieces))
        firsts = np.cumsum(widths) - widths
        alphabet, numbers, counts = np.unique(signs, return_inverse=True, return_counts=True)
        ranks = np.empty(len(alphabet), dtype=np.int64)
        ranks[np.argsort(-counts, kind="stable")] = np.arange(len(alphabet))
        self.n_signs = len(alphabet) + 1  # the last is any other character
        self.sign_of = np.full(int(alphabet[-1]) + 2 if len(alphabet) else 1, self.n_signs - 1, dtype=np.int32)
        self.sign_of[alphabet] = ranks
        numbers = ranks[numbers]

        # Level by level: an edge is its state and character, and the edges in order are those to states 1, 2, ...
        at, levels, n = np.zeros(len(pieces), dtype=np.int64), [], 1
        for depth in range(int(widths.max(initial=0))):
            longer = np.flatnonzero(widths > depth)
            edges, child = np.unique(at[longer] * self.n_signs + numbers[firsts[longer] + depth], return_inverse=True)
            at[longer] = n + child
            levels.append(edges)
            n += len(edges)
        self.edges = np.concatenate([np.zeros(0, dtype=np.int64), *levels])
        self.depth = np.repeat(np.arange(len(levels) + 1), [1, *map(len, levels)])
        self.piece = np.full(n, -1, dtype=np.int32)
        self.piece[at] = [i for i, _ in pieces]
        self.score = np.zeros(n)
        self.score[at] = [scores[i] for i, _ in pieces]

        self.common = max(1, min(_COMMON, _TABLE // n))
        self.table = np.zeros((n, self.common), dtype=np.int32)
        self.fail = np.zeros(n, dtype=np.int32)
        self.ending = np.where(self.piece < 0, 0, np.arange(n))  # the state of the longest piece that ends in a state
        first = 1
        for edges in levels:
            states, parents, own = np.arange(first, first + len(edges)), edges // self.n_signs, edges % self.n_signs
            near = own < self.common
            self.table[parents[near], own[near]] = states[near]
            self.fail[states] = np.where(parents, self.step(self.fail[parents], own), 0)
            self.table[states] = self.table[self.fail[states]]
            self.ending[states] = np.where(self.piece[states] < 0, self.ending[self.fail[states]], states)
            first += len(edges)
        self.shorter = self.ending[self.fail]  # of the next longest one

    def read(self, signs: np.ndarray) -> np.ndarray:
        """The numbers of characters, given as code points."""
        return self.sign_of[np.minimum(signs, len(self.sign_of) - 1)]

    def step(self, states: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """The states after one more character each."""
        found = self.table[states, np.minimum(signs, self.common - 1)]
        rest = np.flatnonzero(signs >= self.common)
        if len(rest):
            found[rest] = 0
            rest = rest[signs[rest] < self.n_signs - 1]
            states = states[rest].astype(np.int64)
            while len(rest):
                edge = states * self.n_signs + signs[rest]
                place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                hit = self.edges[place] == edge
                found[rest[hit]] = place[hit] + 1
                more = ~hit & (states > 0)
                rest, states = rest[more], self.fail[states[more]].astype(np.int64)
        return found


class Coder:
    """Encodes and decodes texts."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        own = {p: i for i, (p, ok) in enumerate(zip(vocabulary.pieces, vocabulary.plain)) if ok and p}
        self.own = [(i, p) for p, i in own.items()]
        self.automaton = Automaton(self.own, vocabulary.scores)
        self.byte_ids = np.array(vocabulary.byte_ids, dtype="<i4")
        self.sign = self.byte_ids[list(SPACE.encode())].tobytes()
        plain = [s for s, p in zip(vocabulary.scores, vocabulary.plain) if p]
        self.unknown = min(plain, default=0.0) - UNKNOWN_PENALTY
        self.alone = np.zeros(self.automaton.n_signs, dtype=bool)  # characters that are pieces
        self.alone[self.automaton.read(np.array([ord(p) for p in own if len(p) == 1], dtype=np.int64))] = True
        crossing = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in own)
        self.stretches = re.compile(r"(?s).+" if crossing else rf"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+").findall
        self.border = re.compile(r"(?!)" if crossing else rf"\n|[^{SPACE}\n](?=[{SPACE}\n])").search
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.cached = 0
        byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        bytes_of = [
            bytes([byte_of[i]]) if i in byte_of else piece.replace(SPACE, " ").encode() if ok else b""
            for i, (piece, ok) in enumerate(zip(vocabulary.pieces, vocabulary.plain))
        ]
        self.bytes_of = np.frombuffer(b"".join(bytes_of), dtype=np.uint8)
        self.n_bytes = np.array([len(b) for b in bytes_of], dtype=np.int64)
        self.first_byte = np.cumsum(self.n_bytes) - self.n_bytes

    @cached_property
    def single(self) -> ahocorasick.Automaton:
        """The automaton for a stretch on its own."""
        automaton = ahocorasick.Automaton()
        for i, piece in self.own:
            automaton.add_word(piece, (i, len(piece), self.vocabulary.scores[i]))
        automaton.make_automaton()
        return automaton

    def best_path(self, stretch: str) -> bytes:
        """Ids (32-bit little endian) of the pieces with the largest sum of scores."""
        n = len(stretch)
        best, via = [float("-inf")] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        matches = self.single.iter(stretch) if self.own else iter(())
        match = next(matches, None)
        for end in range(1, n + 1):
            alone = False
            while match is not None and match[0] == end - 1:  # the longest first
                i, length, score = match[1]
                offer = best[end - length] + score
                alone = alone or length == 1
                if offer > best[end]:
                    best[end], via[end] = offer, (i, length)
                match = next(matches, None)
            if not alone and best[end - 1] + self.unknown > best[end]:
                best[end], via[end] = best[end - 1] + self.unknown, (-1, 1)
        path, end = [], n
        while end:
            i, length = via[end]
            if i < 0:
                path.extend(self.vocabulary.byte_ids[b] for b in reversed(stretch[end - 1].encode()))
            else:
                path.append(i)
            end -= length
        path.reverse()
        return np.array(path, dtype="<i4").tobytes()

    def best_paths(self, stretches: list[str]) -> list[bytes]:
        """``best_path`` of each; they must not be empty, and stand with the longest first."""
        text, automaton = "".join(stretches), self.automaton
        sizes = np.fromiter(map(len, stretches), dtype=np.int64, count=len(stretches))
        firsts, n, longest = np.cumsum(sizes) - sizes, len(stretches), int(sizes[0])
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        signs = automaton.read(points)
        reaching = np.searchsorted(-sizes, -np.arange(longest + 1), side="right")

        best = np.zeros((longest + 1) * n)  # by place and stretch
        via = np.zeros(len(text), dtype=np.int32)  # by character: the state of the last piece, 0 for bytes
        states = np.zeros(n, dtype=np.int32)
        for end in range(1, longest + 1):
            rows = np.arange(reaching[end])
            at = firsts[rows] + end - 1
            own = signs[at]
            states = automaton.step(states[rows], own)
            before = best[(end - 1) * n : (end - 1) * n + len(rows)]
            top = np.where(self.alone[own], -np.inf, before + self.unknown)
            last = np.zeros(len(rows), dtype=np.int32)
            piece = automaton.ending[states]
            while True:  # the longest first
                some = np.flatnonzero(piece)
                if not len(some):
                    break
                rows, piece = rows[some], piece[some]
                offers = best[(end - automaton.depth[piece]) * n + rows] + automaton.score[piece]
                # Bytes only stand if they are better than all pieces, so a piece replaces them if it is as good.
                better = (offers > top[rows]) | ((offers == top[rows]) & (last[rows] == 0))
                top[rows[better]], last[rows[better]] = offers[better], piece[better]
                piece = automaton.shorter[piece]
            best[end * n : end * n + len(top)] = top
            via[at] = last

        owners, places, rows, ends = [], [], np.arange(n), firsts + sizes
        widths = np.maximum(automaton.depth, 1)
        while len(rows):
            owners.append(rows)
            places.append(ends - 1)
            ends = ends - widths[via[ends - 1]]
            more = ends > firsts[rows]
            rows, ends = rows[more], ends[more]
        owners, places = np.concatenate(owners[::-1]), np.concatenate(places[::-1])
        order = np.argsort(owners, kind="stable")
        owners, places = owners[order], places[order]
        found = automaton.piece[via[places]]
        if (found < 0).any():
            lengths = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            data, first_byte = np.frombuffer(text.encode(), dtype=np.uint8), np.cumsum(lengths) - lengths
            lengths = np.where(found < 0, lengths[places], 1)
            own = np.repeat(np.arange(len(found)), lengths)
            nth = np.arange(len(own)) - (np.cumsum(lengths) - lengths)[own]
            owners, found = owners[own], np.where(found[own] < 0, self.byte_ids[data[first_byte[places[own]] + nth]], found[own])
        cuts = 4 * np.searchsorted(owners, np.arange(n + 1))
        data, cuts = found.astype("<i4").tobytes(), cuts.tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _parts(self, text: str) -> Iterator[tuple[list[str], int]]:
        """The stretches of a text in order, some at a time, and their length. An empty one is a space sign in the text."""
        for k, plain in enumerate(text.split(SPACE)):
            if k:
                yield [""], 1
            spaced = plain.replace(" ", SPACE) if k else SPACE + plain.replace(" ", SPACE)
            first = 0
            while first < len(spaced):
                cut = self.border(spaced, first + _GROUP)
                last = cut.end() if cut else len(spaced)
                yield self.stretches(spaced[first:last]), last - first
                first = last

    def _learn(self, stretches: set[str]) -> None:
        """Put the paths of all of them into ``recent``."""
        new = stretches - self.recent.keys()
        known = new & self.older.keys()
        self.recent.update((s, self.older[s]) for s in known)
        new -= known
        if "" in new:
            new.remove("")
            self.recent[""] = self.sign
        self.recent.update((s, self.best_path(s)) for s in new if len(s) > _CACHED_LENGTH)
        short = sorted((s for s in new if len(s) <= _CACHED_LENGTH), key=len, reverse=True)
        first = 0
        while first < len(short):
            block = short[first : first + max(1, _BLOCK // len(short[first]))]
            paths = self.best_paths(block)
            self.recent.update(zip(block, paths))
            self._count(block, paths)
            first += len(block)
        self._count(known, map(self.older.__getitem__, known))

    def _count(self, stretches: Collection[str], paths: Iterable[bytes]) -> None:
        # A string of two-byte signs, its path, and its place in the table.
        self.cached += 170 * len(stretches) + 2 * sum(map(len, stretches)) + sum(map(len, paths))

    def _write(self, group: list[tuple[list[bytes], list[str]]]) -> None:
        """Add the path of each list of stretches to the list before it."""
        stretches = set(chain.from_iterable(s for _, s in group))
        self._learn(stretches)
        path = self.recent.__getitem__
        for paths, those in group:
            paths.append(b"".join(map(path, those)))
        for stretch in stretches:
            if len(stretch) > _CACHED_LENGTH:
                del self.recent[stretch]
        if self.cached >= _CACHED_BYTES // 2:
            self.older, self.recent, self.cached = self.recent, {}, 0

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids (32-bit little endian) of every text. A space sign in a text is written as bytes, so decoding is exact."""
        found: list[list[bytes]] = [[] for _ in texts]
        group, size = [], 0
        for paths, text in zip(found, texts):
            for stretches, length in self._parts(text) if text else ():
                group.append((paths, stretches))
                size += length
                if size >= _GROUP:
                    self._write(group)
                    group, size = [], 0
        self._write(group)
        return [b"".join(paths) for paths in found]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], dtype="<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids: the space that was put before it is taken off again."""
        return self._bytes(np.array(ids, dtype=np.int64))[1:].decode("utf-8", "replace")

    def proves(self, path: bytes, text: str) -> bool:
        """Whether decoding gives the text."""
        return self._bytes(np.frombuffer(path, dtype="<i4"))[1:].decode("utf-8", "replace") == text

    def _bytes(self, ids: np.ndarray) -> bytes:
        found = []
        for k in range(0, len(ids), _BLOCK // 8):
            some = ids[k : k + _BLOCK // 8]
            lengths = self.n_bytes[some]
            ends = np.cumsum(lengths)
            at = np.repeat(self.first_byte[some] - ends + lengths, lengths) + np.arange(ends[-1])
            found.append(self.bytes_of[at].tobytes())
        return b"".join(found)


def encode(df: DataFrame, vocabulary: Vocabulary | None = None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` plus the array ``ids`` of every whole text.

    A null text gives null, an empty text an empty array. Every row stays. A column of ``df`` named like
    the result is replaced.
    """
    return _mapped(df, vocabulary, text, ids, "array<int>", lambda coder, texts: _lists(coder.encode_all(texts)))


def decode(df: DataFrame, vocabulary: Vocabulary | None = None, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` plus the ``text`` of every array of ids; null gives null. The reverse of ``encode``."""
    return _mapped(df, vocabulary, ids, text, "string", lambda coder, lists: pa.array(map(coder.decode, lists), pa.string()))


def digest(df: DataFrame, vocabulary: Vocabulary | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, number of ids, their SHA-256 (32-bit little endian), and whether decoding gives the text.

    A null text counts as empty.
    """

    def summary(coder: Coder, texts: list[str]) -> pa.Array:
        found = coder.encode_all(texts)
        columns = {
            "n_ids": pa.array([len(f) // 4 for f in found], pa.int64()),
            "ids_sha256": pa.array([sha256(f).hexdigest() for f in found], pa.string()),
            "exact": pa.array(map(coder.proves, found, texts), pa.bool_()),
        }
        return pa.StructArray.from_arrays(columns.values(), columns.keys())

    kept = df.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"))
    kind = "struct<n_ids: bigint, ids_sha256: string, exact: boolean>"
    return _mapped(kept, vocabulary, "__text", "__found", kind, summary, keep_source=False).select(key, "__found.*")


def encode_and_prove(df: DataFrame, vocabulary: Vocabulary | None = None, text: str = "text") -> DataFrame:
    """``df`` without its text, plus ``ids`` and ``exact``: whether decoding them gives the text back.

    A null text counts as empty. Columns of ``df`` named like the results are replaced.
    """

    def coded(coder: Coder, texts: list[str]) -> pa.Array:
        found = coder.encode_all(texts)
        exact = pa.array(map(coder.proves, found, texts), pa.bool_())
        return pa.StructArray.from_arrays([_lists(found), exact], ["ids", "exact"])

    fed = df.drop("ids", "exact").withColumn(text, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    kind = "struct<ids: array<int>, exact: boolean>"
    found = _mapped(fed, vocabulary, text, "__found", kind, coded, keep_source=False)
    return found.select(*(F.col(f"`{c}`") for c in fed.columns if c != text), "__found.*")


def _lists(paths: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) // 4 for p in paths)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(paths), dtype="<i4"))


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if pa.types.is_string(batch.column("__source").type):
        return chunks(batch, "__source", _SLICE_BYTES)
    return (batch.slice(k, _SLICE_ROWS) for k in range(0, batch.num_rows, _SLICE_ROWS))


def _mapped(df, vocabulary, source, result, kind, function: Callable[[Coder, list], pa.Array], keep_source=True) -> DataFrame:
    """``df`` plus what ``function`` makes of the values of ``source``; null gives null."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary or load_vocabulary())
    kept = [c for c in df.columns if c != result and (keep_source or c != source)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)  # of this task, so an idle worker holds none
        for batch in batches:
            for part in _slices(batch):
                values = part.column("__source").drop_null().to_pylist()
                found = function(coder, values)
                if len(values) < part.num_rows:
                    there = part.column("__source").is_valid().to_numpy(zero_copy_only=False)
                    found = found.take(pa.array(np.cumsum(there) - 1, mask=~there))
                columns = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*kept, result])

    fed = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{source}`").alias("__source"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in fed.drop("__source").dtypes), f"`{result}` {kind}"])
    return fed.mapInArrow(lean(run), schema)
