"""SentencePiece encoding and decoding as the shortest path of a weighted transducer.

The transducer is the composition of three parts, compiled from a model file:

* the normaliser: a blank before the text, and blanks written as U+2581;
* the pieces: an arc for every piece, of weight 1, and between two pieces of a
  model made by merging an arc of weight 0 or infinity. It is 0 if merging
  leaves the pair as it is, and a sequence of pieces is what merging gives if
  and only if that holds for each pair of neighbours;
* byte fallback: one arc per byte for a character that no piece is.

It is composed with a text piece by piece: a state is a place in the text and
the piece before it, and the path of least weight in the tropical semiring
(least sum) is the encoding. No piece holds a blank sign behind another
character, or a line feed, so paths meet at these places and words between them are
solved apart and remembered.

Decoding is the inverse: bytes of the pieces joined, blanks restored, the first
one dropped. It gives back every text exactly; U+2581 in a text goes by bytes.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import annotate

BLANK = "▁"
#: Words that each generation of a memory holds; a task has two memories of this size, and a smaller one.
MEMO = 200_000
#: Bytes of ids that are decoded at once, as each id is a Python number for the while.
DECODED = 1 << 20
INFINITE = float("inf")
#: Characters of a word beyond which it is solved anew each time.
LONG = 64
#: Characters by whose last ones the pieces are found.
TAIL = 3
SHORT = tuple(range(TAIL - 1, 0, -1))
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}\\n]*|\\n|[^{BLANK}\\n]+")


class Vocabulary:
    """Pieces with ids and merge order, and the ids of bytes; small enough to be sent along (its size is the model's)."""

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_: dict[int, int]):
        self.pieces, self.bytes = pieces, bytes_

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, bytes_ = {}, {}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                bytes_[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[model.id_to_piece(i)] = (i, model.get_score(i))
        if len(bytes_) != 256:
            raise ValueError("the model has no byte fallback")
        if any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces):
            raise ValueError("a piece goes across a word's end")
        if any(c not in pieces for p in pieces for c in p):
            raise ValueError("a piece holds a character that is none")
        return cls(pieces, bytes_)


class Memo(dict):
    """What was solved lately: two generations, so that frequent words outlive the others; long ones are solved anew."""

    def __init__(self, solve, size: int = MEMO):
        super().__init__()
        self.solve, self.size, self.old = solve, size, {}

    def __missing__(self, word):
        if len(word) > LONG:
            return self.solve(word)
        found = self.old.get(word)
        if found is None:
            found = self.solve(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class Outputs(dict):
    """What an id gives; unknown ones give nothing. Decoding needs this alone, not the transducer."""

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Outputs:
        made = {i: p.replace(BLANK, " ").encode() for p, (i, _) in vocabulary.pieces.items()}
        return cls(made | {i: bytes([b]) for b, i in vocabulary.bytes.items()})

    def __missing__(self, number):
        return b""

    def text(self, ids) -> str:
        """The text; unknown ids give nothing, bytes that aren't UTF-8 give U+FFFD."""
        joined = b"".join(map(self.__getitem__, ids))
        return joined.removeprefix(b" ").decode("utf-8", "replace")


class Transducer:
    def __init__(self, vocabulary: Vocabulary, memo: int = MEMO):
        import ahocorasick

        self.vocabulary, self.memo = vocabulary, memo
        #: All pieces that end at a place of a text, found in one pass.
        self.automaton = ahocorasick.Automaton()
        for piece in vocabulary.pieces:
            self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        number = lambda i: i.to_bytes(4, sys.byteorder)
        self.numbers = {p: number(i) for p, (i, _) in vocabulary.pieces.items()}
        self.byte_numbers = [number(vocabulary.bytes[b]) for b in range(256)]
        self.names = {number: p for p, number in self.numbers.items()}
        #: Of arcs, by the two numbers.
        self.weights: dict[bytes, float] = {}
        #: By the last characters of a text: the lengths that a piece at its end can have, long ones first.
        self.lengths: dict[str, tuple[int, ...]] = {}
        for length, tail in sorted({(len(p), p[-TAIL:]) for p in vocabulary.pieces if len(p) >= TAIL}):
            self.lengths[tail] = (length, *self.lengths.get(tail, SHORT))
        self.states = Memo(self.state, memo)
        self.words = Memo(lambda word: self.ids(BLANK + word), memo)
        self.chunks = Memo(self.ids, memo // 4)

    def merged(self, text: str) -> list[str]:
        """What merging leaves of a short text: the best-scored neighbours first, the left pair of equals."""
        parts, known = list(text), self.vocabulary.pieces
        while True:
            best, at = -INFINITE, -1
            for i in range(len(parts) - 1):
                if (found := known.get(parts[i] + parts[i + 1])) and found[1] > best:
                    best, at = found[1], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def between(self, arc: bytes, left: str, right: str) -> float:
        """Weight of the arc from piece to piece, or to a first piece: 0 if merging leaves just these."""
        if len(self.weights) >= self.memo:
            self.weights.clear()
        weight = 0.0 if self.merged(left + right) == ([left, right] if left else [right]) else INFINITE
        self.weights[arc] = weight
        return weight

    def path(self, chunk: str) -> list[str]:
        """Pieces of the shortest path. A character that no piece is stands for its bytes.

        Merging the beginning of a text ends in one way, so of all pieces that
        end at a place just one is on a path of finite weight: one state a place,
        and the first arc of finite weight that is found is the shortest.
        """
        size, weights, numbers = len(chunk), self.weights, self.numbers
        last: list[str | None] = [""] + [None] * size
        before, reached = [0] * (size + 1), 0
        for at, (piece, length) in self.automaton.iter(chunk):
            at += 1
            if last[at] is None:
                while reached < at - 1:
                    reached += 1
                    if last[reached] is None:
                        self._step(chunk, reached, last, before)
                left = last[at - length]
                arc = (numbers.get(left) or self._bytes(left)[-4:]) + numbers[piece]
                weight = weights.get(arc)
                if weight is None:
                    weight = self.between(arc, left, piece)
                if weight == 0.0:
                    last[at], before[at] = piece, at - length
        for at in range(reached + 1, size + 1):
            if last[at] is None:
                self._step(chunk, at, last, before)
        out, place = [], size
        while place > 0:
            out.append(last[place])
            place = before[place]
        return out[::-1]

    @staticmethod
    def _step(chunk: str, at: int, last: list[str | None], before: list[int]) -> None:
        """The arc of a single character, where no piece ends."""
        last[at], before[at] = chunk[at - 1], at - 1

    def state(self, text: str) -> bytes:
        """Ids of the shortest path to the end of a short text, as 32-bit numbers.

        The path to a place depends on the text before it alone, so words that
        begin alike share these states. The last id stands for the last piece;
        a byte stands for any character that no piece holds, and these are alike.
        """
        if not text:
            return b""
        states, weights, numbers = self.states, self.weights, self.numbers
        for length in self.lengths.get(text[-TAIL:], SHORT):
            piece = text[-length:]
            number = numbers.get(piece)
            if number is not None and len(piece) == length:
                ids = states[text[:-length]]
                arc = ids[-4:] + number
                weight = weights.get(arc)
                if weight is None:
                    weight = self.between(arc, self.names.get(ids[-4:], text[:-length][-1:]), piece)
                if weight == 0.0:
                    return ids + number
        return states[text[:-1]] + self._bytes(text[-1])

    def solve(self, chunk: str) -> bytes:
        """Ids of a long chunk, whose states aren't remembered."""
        numbers = self.numbers
        return b"".join([numbers.get(p) or self._bytes(p) for p in self.path(chunk)])

    def _bytes(self, char: str) -> bytes:
        """Byte fallback."""
        return b"".join([self.byte_numbers[b] for b in char.encode()])

    def ids(self, chunk: str) -> bytes:
        return self.state(chunk) if len(chunk) <= LONG else self.solve(chunk)

    @cached_property
    def own_blank(self) -> bytes:
        """U+2581 of a text: its bytes, as no piece may stand for it."""
        return self._bytes(BLANK)

    @cached_property
    def line_feed(self) -> bytes:
        return self.solve("\n")

    def encode(self, text: str) -> bytes:
        """Ids of a text, as 32-bit numbers; none for the empty text."""
        if not text:
            return b""
        text = " " + text
        if BLANK in text:
            out: list[bytes] = []
            for i, part in enumerate(text.split(BLANK)):
                if i:
                    out.append(self.own_blank)
                out += map(self.chunks.__getitem__, _CHUNK.findall(part.replace(" ", BLANK)))
            return b"".join(out)
        out = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(self.line_feed)
            if "  " in line or line.endswith(" "):
                out += map(self.chunks.__getitem__, _CHUNK.findall(line.replace(" ", BLANK)))
                continue
            first, *words = line.split(" ")
            if first:
                out.append(self.chunks[first])
            out += map(self.words.__getitem__, words)
        return b"".join(out)

    @cached_property
    def outputs(self) -> Outputs:
        return Outputs.of(self.vocabulary)

    def decode(self, ids) -> str:
        return self.outputs.text(ids)


def _list_array(rows: list[bytes | None]) -> pa.Array:
    """Lists of 32-bit numbers from their bytes."""
    sizes = np.fromiter((len(r) // 4 if r else 0 for r in rows), np.int32, len(rows))
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    flat = pa.array(np.frombuffer(b"".join(r for r in rows if r), np.int32), pa.int32())
    return pa.ListArray.from_arrays(ends, flat, mask=pa.array([r is None for r in rows]))


#: One of a kind per worker process, as a transducer's memory of words serves all tasks.
_SHARED: dict[type, tuple[str, Transducer | Outputs]] = {}


def _shared(name: str, vocabulary, kind: type, make: Callable[[Vocabulary], Transducer | Outputs]):
    if _SHARED.get(kind, ("", None))[0] != name:
        _SHARED[kind] = (name, make(Vocabulary(*vocabulary.value)))
    return _SHARED[kind][1]


def encode(
    docs: DataFrame, model: str, text: str = "text", into: str = "input_ids", keep: list[str] | None = None, memo: int = MEMO
) -> DataFrame:
    """Adds the ids of each whole text: null for a null text, no ids for an empty one.

    `model`: path of a model file, read here once and sent along. Bytes that
    aren't UTF-8 count as U+FFFD. Rows and other columns stay; a column of the
    new name is replaced. `memo`: words that a generation of a memory holds; it
    changes time and memory, not the ids.
    """
    vocabulary = Vocabulary.read(model)
    held = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.bytes))
    name = f"{model}:{len(vocabulary.pieces)}:{memo}"

    def start():
        transducer = _shared(name, held, Transducer, lambda found: Transducer(found, memo))
        return lambda texts: [
            _list_array([None if t is None else transducer.encode(t.decode("utf-8", "replace")) for t in texts])
        ]

    return annotate(docs, [text], f"`{into}` array<int>", start, keep=keep)


def decode(
    docs: DataFrame, model: str, ids: str = "input_ids", into: str = "text", keep: list[str] | None = None, forget: bool = False
) -> DataFrame:
    """Adds the text of each list of ids: null for null.

    `forget`: workers drop what encoding remembers, for jobs in which all of it is done.
    """
    vocabulary = Vocabulary.read(model)
    held = docs.sparkSession.sparkContext.broadcast((vocabulary.pieces, vocabulary.bytes))
    name = f"{model}:{len(vocabulary.pieces)}"

    def start():
        if forget:
            _SHARED.pop(Transducer, None)
        outputs = _shared(name, held, Outputs, Outputs.of)
        return lambda rows: [[None if r is None else outputs.text(r) for r in rows]]

    return annotate(docs, [ids], f"`{into}` string", start, keep=keep, size=DECODED)
