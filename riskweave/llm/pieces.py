"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three machines. The normaliser writes the dummy prefix and a mark
for each blank. The piece machine is a trie whose arcs spell the pieces, with a byte-fallback
arc for a character that is no piece. The context machine says which piece may follow which.
Their composition with a text is a lattice over its character positions; the encoding is the
shortest path in the tropical semiring (costs add along a path, the least cost wins).

* Unigram models: an arc costs the negative score of its piece, and any piece may follow.
* BPE models: an arc costs one, and piece b may follow piece a only if merging the characters
  of a and b by rank gives a, b again (any other pair has infinite cost). Merges are local, so
  a text has exactly one path of finite cost, and it is the encoding that merging gives.

Between two characters that stand next to each other in no piece, every path passes through one
state. Texts are cut there, and a worker remembers the paths of recent units, so that a word
is solved once, not once per occurrence.

Decoding writes the text of each piece, joins fallback bytes, turns marks into blanks and takes
the dummy prefix away. A text with the mark U+2581 in it decodes with a blank there.

Defined cases: null encodes to null, an empty text to no pieces; repeated rows encode alike; ids
out of range and control pieces decode to nothing, invalid UTF-8 bytes to U+FFFD; an empty table
gives no rows; very long texts are encoded whole. Model files with a character map other than identity are refused.
Further columns are carried along; one named like a new column gives way to it.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskweave.llm.common import append_columns

MARK = "▁"
#: Where the public model file lies; a parameter of every function here.
MODEL = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Units and pairs of pieces whose result a worker remembers, and the longest such unit.
MEMORY = 400_000
PAIRS = 400_000
LONGEST = 48
#: What a character without a piece costs a unigram path beyond the dearest piece.
UNKNOWN_PENALTY = 10.0

# Fixed values of the model file format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

NOTHING, START, FALLBACK = -2, -1, -3


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield number, raw[at : at + size]
        at += size


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, raw: bytes):
        self.kind, self.byte_fallback, self.prefix, self.squeeze, self.escape = UNIGRAM, False, True, True, True
        pieces = []
        for number, value in fields(raw):
            if number == 1:
                one = dict(fields(value))
                score = float(np.frombuffer(one.get(2, b"\0\0\0\0"), "<f4")[0])
                pieces.append((one.get(1, b"").decode(), score, one.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                self.kind = trainer.get(3, UNIGRAM)
                self.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                rules = dict(fields(value))
                if rules.get(2):
                    raise ValueError("only models with the identity character map are supported")
                self.prefix, self.squeeze, self.escape = (bool(rules.get(n, 1)) for n in (3, 4, 5))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.size = len(pieces)
        self.piece_id, self.bytes_id, self.unknown = {}, [0] * 256, 0
        self.out = []
        for i, (text, _, type_) in enumerate(pieces):
            if type_ == BYTE:
                self.bytes_id[int(text[1:-1], 16)] = i
                self.out.append(bytes([int(text[1:-1], 16)]))
                continue
            if type_ == UNKNOWN:
                self.unknown = i
            if type_ in (NORMAL, USER_DEFINED):
                self.piece_id[text] = i
            self.out.append(b"" if type_ == CONTROL else b" \xe2\x81\x87 " if type_ == UNKNOWN else text.replace(MARK, " ").encode())
        self.text = {i: t for t, i in self.piece_id.items()}
        self.score = [s for _, s, _ in pieces]
        least = min((self.score[i] for i in self.piece_id.values()), default=0.0)
        self.unknown_cost = UNKNOWN_PENALTY - least
        # The trie: a state maps a character to (next state, id of the piece that ends there).
        self.trie: dict = {}
        for text, i in sorted(self.piece_id.items()):
            state = self.trie
            for c in text[:-1]:
                state = state.setdefault(c, ({}, NOTHING))[0]
            state[text[-1]] = (state[text[-1]][0] if text[-1] in state else {}, i)
        self.units = self._units()
        self._paths: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._follows: dict[int, bool] = {}

    def _units(self) -> re.Pattern:
        """How a normalised text is cut where no piece reaches over."""
        inside = {c for t in self.piece_id if len(t) > 1 for c in t}
        alone = "".join(chr(c) for c in range(32) if chr(c) not in inside)
        if any(MARK in t.lstrip(MARK) for t in self.piece_id):
            return re.compile(f"[{re.escape(alone)}]|[^{re.escape(alone)}]+" if alone else r"(?s:.+)")
        return re.compile(f"[{re.escape(alone)}]|{MARK}*[^{MARK}{re.escape(alone)}]+|{MARK}+")

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return text
        if self.prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.escape else text

    def merge(self, text: str) -> list[str]:
        """The pieces that merging by rank gives; best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                at = self.piece_id.get(parts[i] + parts[i + 1])
                if at is not None and (best is None or self.score[at] > best[0]):
                    best = self.score[at], i
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether the context machine has an arc from piece a to piece b."""
        key = a * self.size + b
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) >= PAIRS:
                self._follows.clear()
            x, y = self.text[a], self.text[b]
            known = self._follows[key] = self.merge(x + y) == [x, y]
        return known

    def path(self, unit: str) -> bytes:
        """Shortest path of one unit, as little-endian 32-bit ids."""
        n, ranked, score, follows, size = len(unit), self.kind == BPE, self.score, self._follows, self.size
        cost, last, back = [0.0] * (n + 1), [NOTHING] * (n + 1), [0] * (n + 1)
        last[0] = START
        for i in range(n):
            a, here = last[i], cost[i]
            if a == NOTHING:
                continue
            state, row = self.trie, a * size
            for j in range(i, n):
                arc = state.get(unit[j])
                if arc is None:
                    break
                state, b = arc
                if b < 0:
                    continue
                to = j + 1
                if ranked:
                    # One path of finite cost leads to each position: later ones need no look.
                    if last[to] != NOTHING:
                        continue
                    if a >= 0:
                        may = follows.get(row + b)
                        if not (self.follows(a, b) if may is None else may):
                            continue
                    price = here + 1.0
                else:
                    price = here - score[b]
                    if last[to] != NOTHING and price >= cost[to]:
                        continue
                cost[to], last[to], back[to] = price, b, i
            to = i + 1
            if unit[i] not in self.piece_id:
                price = here + (1.0 if ranked else self.unknown_cost)
                if last[to] == NOTHING or (not ranked and price < cost[to]):
                    cost[to], last[to], back[to] = price, FALLBACK, i
        ids: list[int] = []
        at = n
        while at:
            start = back[at]
            if last[at] == FALLBACK:
                if self.byte_fallback:
                    ids += [self.bytes_id[b] for b in reversed(unit[start:at].encode("utf-8", "replace"))]
                elif not ids or ids[-1] != self.unknown:
                    ids.append(self.unknown)
            else:
                ids.append(last[at])
            at = start
        return array("i", reversed(ids)).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian 32-bit integers."""
        paths = self._paths
        units = self.units.findall(self.normalise(text))
        try:
            return b"".join([paths[u] for u in units])
        except KeyError:
            pass
        out = []
        for u in units:
            ids = paths.get(u)
            if ids is None:
                ids = self._older.pop(u, None) or self.path(u)
                if len(u) <= LONGEST:
                    if len(paths) >= MEMORY // 2:
                        # What was not met again since the last turn is forgotten.
                        self._older, self._paths = paths, {}
                        paths = self._paths
                    paths[u] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids) -> str:
        """The text of a sequence of ids."""
        out, size = self.out, self.size
        text = b"".join([out[i] for i in ids if 0 <= i < size]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text

    def plain(self, text: str) -> str:
        """What decoding the encoding of a text must give."""
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return text.replace(MARK, " ")


def load(spark, path: str = MODEL):
    """A broadcast of the model file's bytes, read by Spark where its readers reach it."""
    try:
        with open(path, "rb") as f:
            raw = f.read()
    except FileNotFoundError:
        raw = bytes(spark.read.format("binaryFile").load(path).first()["content"])
    return spark.sparkContext.broadcast(raw)


_compiled: dict[int, Transducer] = {}


def compiled(raw: bytes) -> Transducer:
    """One transducer a worker and model; its memory of paths outlives a task."""
    key = hash(raw)
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(raw)
    return _compiled[key]


def encode(docs: DataFrame, path: str = MODEL, ids: str = "ids", check: str | None = None) -> DataFrame:
    """``docs`` with the ids of text; with ``check``, also whether they decode to the text again."""
    shared = load(docs.sparkSession, path)

    def make():
        machine = compiled(shared.value)

        def fn(texts):
            flat, sizes, same = [], [], []
            for value in texts:
                text = value.as_py()
                if text is None:
                    sizes.append(None)
                    same.append(None)
                    continue
                found = machine.encode(text)
                flat.append(found)
                sizes.append(len(found) // 4)
                if check:
                    same.append(machine.decode(memoryview(found).cast("i")) == machine.plain(text))
            lengths = pa.array(sizes, pa.int32())
            offsets = np.concatenate(([0], np.cumsum(lengths.fill_null(0).to_numpy())))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.array(np.frombuffer(b"".join(flat), np.int32)),
                mask=lengths.is_null() if lengths.null_count else None,
            )
            return (lists, pa.array(same, pa.bool_())) if check else (lists,)

        return fn

    new = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if check:
        new.append(T.StructField(check, T.BooleanType()))
    return append_columns(docs, make, new, ["text"])


def decode(rows: DataFrame, path: str = MODEL, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text of a column of ids."""
    shared = load(rows.sparkSession, path)

    def make():
        machine = compiled(shared.value)

        def fn(lists):
            found = [machine.decode(x for x in v if x is not None) if v is not None else None for v in lists.to_pylist()]
            return (pa.array(found, pa.string()),)

        return fn

    return append_columns(rows, make, [T.StructField(text, T.StringType())], [ids])
