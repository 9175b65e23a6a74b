"""SentencePiece encoding and decoding as a stream over a lattice.

Each boundary between two characters has one survivor: the piece by which the best path to it ends.  A piece is at most
``longest`` characters, so the next boundaries only look at that many before them; everything older is decided as soon as
the paths of all boundaries in that window run through one.  Then the ids up to there are committed and forgotten, so a
text of any length needs a window and no more.

Which path is best depends on the model.  In a unigram model it is the one with the highest sum of scores (Viterbi).  In a
merge (BPE) model scores are ranks of merges and their sum says nothing; there the survivor is the one piece that the
merges leave at the end of the text so far, found by asking for each candidate whether merging leaves it and the survivor
before it apart.  Ids equal those of the library in both kinds.

No piece holds a word mark behind another character, so every path passes the boundary before one: words are encoded once
and remembered (at most twice ``REMEMBERED`` in a worker).  Models are read, never trained.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import pieces
from .shipping import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 200_000
#: Cost of an unknown character below the lowest score, as the format has it.
UNKNOWN_PENALTY = 10.0

_ready: dict[bytes, "Pieces"] = {}


class Pieces:
    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces or not proto.normalizer_spec.escape_whitespaces:
            raise ValueError("only models that keep texts as they are can be streamed")
        kind = proto.trainer_spec.model_type
        if kind not in (1, 2):
            raise ValueError("only unigram and merge models are known")
        self.merges, self.prefix = kind == 2, proto.normalizer_spec.add_dummy_prefix
        normal = {i: p for i, p in enumerate(proto.pieces) if p.type in (1, 4, 5)}
        self.ids = {p.piece: i for i, p in normal.items()}
        self.scores = {p.piece: p.score for p in normal.values()}
        self.names = [p.piece for p in proto.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        #: What an id decodes to.
        self.shown = ["" if p.type in (2, 3) else bytes([int(p.piece[3:5], 16)]).decode("utf-8", "surrogateescape") if p.type == 6 else p.piece.replace(MARK, " ")
                      for p in proto.pieces]
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.floor = min((p.score for p in normal.values()), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece goes over the end of a word")
        self.line_breaks = any("\n" in p for p in self.ids)
        #: Characters that stand next to each other in some piece; between any others every path has a boundary.
        self.inside = {x for p in self.ids for x in zip(p, p[1:])}
        self.apart_: dict[int, bool] = {}
        #: Words in use, and those of the time before; a word still in use goes back to the first.
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        if self.merges:
            self.learn_merges()

    def learn_merges(self) -> None:
        """For each piece that merging its characters gives: the two pieces merged last, and its place in the order."""
        order = {score: i for i, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        self.place = [0] * len(self.names)
        self.halves: list[tuple[int, int] | None] = [None] * len(self.names)
        #: The pieces read backwards as a tree of (id of the piece that ends the walk there, nodes that follow).
        root: dict = {}
        for p, i in self.ids.items():
            self.place[i] = order[self.scores[p]] if len(p) > 1 else -1
            if len(p) > 1:
                rest = self.merged(p, 2)
                if len(rest) == 2:
                    self.halves[i] = (self.ids[rest[0]], self.ids[rest[1]])
                else:
                    continue
            node = root
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = i

        def packed(node: dict) -> tuple[int | None, dict]:
            return node.get(""), {c: packed(n) for c, n in node.items() if c}

        self.backwards = packed(root)[1]

    # ---- which path is best

    def merged(self, text: str, until: int = 1) -> list[str]:
        """What the merges leave of a short text, stopped at ``until`` parts: highest score first, then leftmost."""
        parts = list(text)
        while len(parts) > until:
            best = max(((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores), default=None)
            if best is None:
                break
            i = -best[1]
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves two pieces side by side apart.

        Goes back in time from the finished pieces: the one merged later falls into its halves, and at each step the two
        parts at the border must not merge before what they became did.  Of equal merges the leftmost comes first.
        Runs of word marks share one score, which says nothing about time; they are merged to see.
        """
        key = left * len(self.names) + right
        known = self.apart_.get(key)
        if known is None:
            if len(self.apart_) >= 2 * REMEMBERED:
                self.apart_.clear()
            known = self.apart_[key] = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        names, place, ids = self.names, self.place, self.ids
        if names[right][0] == MARK:
            return self.merged(names[left] + names[right]) == [names[left], names[right]]
        left_became = right_became = len(names)
        while True:
            over = ids.get(names[left] + names[right])
            if over is not None and place[over] < left_became and place[over] <= right_became:
                return False
            if place[left] > place[right]:
                left_became, left = place[left], self.halves[left][1]
            elif place[right] >= 0:
                right_became, right = place[right], self.halves[right][0]
            else:
                return True

    # ---- the stream

    def stream(self, text: str) -> Iterator[tuple[str, int]]:
        """Pieces of a text in the model's form, with their ids (-1: an unknown character), as they are committed."""
        base, begins, scores, last, window = 0, [0], [0.0], [-1], 4 * self.longest
        if self.merges:
            tree, known, width = self.backwards, self.apart_, len(self.names)
        for end in range(1, len(text) + 1):
            chosen, best = end - 1, None
            if self.merges:
                node, begin, found, best = tree.get(text[end - 1]), end - 1, [], -1
                while node is not None:
                    id, longer = node
                    if id is not None:
                        found.append((begin, id))
                    begin -= 1
                    if begin < base or not longer:
                        break
                    node = longer.get(text[begin])
                # The piece before a candidate is that of its own boundary; the start and unknown characters part all.
                while found:
                    begin, id = found.pop()
                    before = last[begin - base]
                    if before < 0 or ((fits := known.get(before * width + id)) is None and self.apart(before, id)) or fits:
                        chosen, best = begin, id
                        break
                last.append(best)
            else:
                for n in range(min(self.longest, end - base), 0, -1):
                    piece = text[end - n: end]
                    if piece in self.scores:
                        score = scores[end - n - base] + self.scores[piece]
                    elif n == 1:
                        score = scores[end - 1 - base] + self.floor
                    else:
                        continue
                    if best is None or score > best:
                        chosen, best = end - n, score
                scores.append(best)
            begins.append(chosen)
            if not end % window and len(begins) > 2 * self.longest:
                live = set(range(max(base, end + 1 - self.longest), end + 1))
                while len(live) > 1:
                    newest = max(live)
                    live.remove(newest)
                    live.add(begins[newest - base])
                meeting = live.pop()
                if (keep := meeting) > base:
                    yield from self.path(text, begins, last, base, keep)
                    begins, scores, last, base = begins[keep - base:], scores[keep - base:], last[keep - base:], keep
        yield from self.path(text, begins, last, base, len(text))

    def path(self, text: str, begins: list[int], last: list[int], base: int, end: int) -> list[tuple[str, int]]:
        out = []
        while end > base:
            begin = begins[end - base]
            piece = text[begin:end]
            out.append((piece, last[end - base] if self.merges else self.ids.get(piece, -1)))
            end = begin
        return out[::-1]

    # ---- texts

    def encode_word(self, word: str) -> bytes:
        """Ids as 32-bit numbers, one after the other."""
        out = array("i")
        for piece, id in self.stream(word):
            if id >= 0:
                out.append(id)
            elif self.bytes:
                out.extend([self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")])
            else:
                out.append(self.unknown)
        return out.tobytes()

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            if (found := self.older.get(word)) is not None:
                pass
            elif len(word) > 1 and word[-1] in ".,;:!?" and (word[-2], word[-1]) not in self.inside:
                return self.word(word[:-1]) + self.word(word[-1])
            else:
                found = self.encode_word(word)
            if len(word) <= 64:
                if len(self.words) >= REMEMBERED:
                    self.older = self.words.copy()
                    self.words.clear()
                self.words[word] = found
        return found

    def parts(self, text: str) -> list[str]:
        """The words of a text in the model's form.  No path goes over their ends: a word begins with its marks, and a line
        break, if no piece holds one, is a word of its own."""
        marked = (MARK if self.prefix else "") + text.replace(" ", MARK)
        if "\0" in marked:
            return [marked]
        marked = marked.replace(MARK, "\0" + MARK)
        if MARK + "\0" in marked:
            marked = re.sub(f"{MARK}(?:\0{MARK})+", lambda m: m.group().replace("\0", ""), marked)
        return (marked if self.line_breaks else marked.replace("\n", "\0\n\0")).split("\0")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        known, word = self.words, self.word
        return b"".join([known.get(part) or word(part) for part in self.parts(text) if part])

    def decode(self, ids: Iterable[int]) -> str:
        """Bytes go through as what stands for them in an escaped text, so whole characters come together again."""
        raw = "".join(map(self.shown.__getitem__, ids))
        text = raw.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def ready(model: bytes) -> Pieces:
    """A worker reads a model once and keeps what it has learnt about words."""
    if model not in _ready:
        _ready.clear()
        _ready[model] = Pieces(model)
    return _ready[model]


def encoded(documents: DataFrame, model: str = MODEL, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, ids, round_trip`` for each row: the whole text's ids, and whether they decode to it.

    A null text has null ids and counts as 0 tokens, an empty one has no ids; both make the round trip.  A text that holds
    the word mark itself comes back with blanks in its place, as in the library, and so does not.  The model's file is read
    on the driver and sent along.  Repeats get equal ids; an empty table gives no rows; other columns are not touched.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ready(sent.value)
        for piece in pieces(batches, 128):
            texts = piece.column(1).to_pylist()
            ids = [np.frombuffer(own.encode(t or ""), np.int32) for t in texts]
            good = [own.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts)]
            ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)), mask=pa.array([t is None for t in texts]))
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.diff(ends).astype(np.int64)), lists, pa.array(good)], names=["_id", "n_tokens", "ids", "round_trip"])

    return documents.select(F.col(id).cast("long"), F.col(text)).mapInArrow(run, "_id long, n_tokens long, ids array<int>, round_trip boolean").withColumnRenamed("_id", id)


def decoded(rows: DataFrame, model: str = MODEL, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """``doc_id, text`` from ids; null ids give a null text."""
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(Path(model).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ready(sent.value)
        for piece in pieces(batches, 128):
            texts = [None if x is None else own.decode(x) for x in piece.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(texts, pa.string())], names=["_id", "text"])

    return rows.select(F.col(id).cast("long"), F.col(ids)).mapInArrow(run, "_id long, text string").withColumnRenamed("_id", id)
