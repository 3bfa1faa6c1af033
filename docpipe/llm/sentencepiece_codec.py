"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search walks over the text once. For each position it keeps a back pointer to where the
last piece of the best path to it begins. A piece is at most ``max_len`` characters long, so
only the back pointers of the last ``max_len`` positions can still be part of a path that goes
on. Whenever the paths of all of these run through one boundary, the ids before it are final:
they are given out, and the window moves there. Memory is bounded by the window and the stretch over which
paths stay apart (in practice a word), not by the text.

Two kinds of vocabulary share the search and differ in what makes a path good:

- unigram: the sum of the piece scores.
- bpe: a path is allowed if each pair of neighbours, merged on its own, comes out as that very
  pair. Merges never cross the boundary of two final pieces, so of all paths to a position
  exactly one is allowed, and it is what byte-pair merging of the text gives.

Where no piece of the vocabulary can cross a boundary (a space after something else, or a
character outside the vocabulary), all paths meet. The job uses that: stretches between such
boundaries are searched once per task and remembered, in a table of bounded size.

Defined cases: null text counts as empty and has no ids. Rows are never merged, so repeated rows and ids each get theirs; an empty
table gives no rows. Of equally good paths of a unigram model the one with the longest last piece counts. Columns other than id and text are not
read, whatever their names. Very long texts without a break go through the window. A literal U+2581 in a text is
the vocabulary's space and decodes as one.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 300_000  # stretches per task
LONGEST_REMEMBERED = 64
PAIRS = 500_000  # pairs of pieces per task
BYTES_PER_STEP = 3_000_000


@dataclass
class Vocabulary:
    """The pieces of a model file and how it prepares text."""

    pieces: list[str]
    scores: list[float]
    usable: list[bool]
    byte_ids: list[int]  # of the bytes 0 to 255, or empty
    unk_id: int
    bpe: bool
    prefix: bool
    ids: dict[str, int] = field(init=False)
    max_len: int = field(init=False)

    def __post_init__(self) -> None:
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, self.usable)) if ok}
        self.max_len = max(map(len, self.ids), default=1)

    def surfaces(self) -> list[bytes]:
        """The bytes that each id stands for."""
        raw = [p.replace(SPACE, " ").encode() if ok else b"" for p, ok in zip(self.pieces, self.usable)]
        raw[self.unk_id] = " ⁇ ".encode()
        for value, i in enumerate(self.byte_ids):
            raw[i] = bytes([value])
        return raw


def load(path: str = MODEL_PATH) -> Vocabulary:
    """Read a model file. One that rewrites characters or blanks beforehand is refused."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(Path(path).read_bytes())
    if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError(f"{path}: only models that keep text as it is can be used")
    if model.trainer_spec.model_type not in (1, 2) or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path}: only unigram and bpe models with spaces in front can be used")
    kinds = [p.type for p in model.pieces]
    byte_ids = [i for i, k in enumerate(kinds) if k == 6]
    return Vocabulary(
        [p.piece for p in model.pieces], [p.score for p in model.pieces], [k in (1, 4) for k in kinds],
        byte_ids if len(byte_ids) == 256 else [], kinds.index(2),
        model.trainer_spec.model_type == 2, model.normalizer_spec.add_dummy_prefix,
    )


class Searcher:
    """The streaming search over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self._pairs: dict[str, dict[str, bool]] = {}
        self._n_pairs = 0
        # every end of a piece; true for whole pieces
        self._tails = {p[i:]: False for p in vocabulary.ids for i in range(1, len(p))} | dict.fromkeys(vocabulary.ids, True)
        self._unknown = min((vocabulary.scores[i] for i in vocabulary.ids.values()), default=0.0) - 10.0

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging of a short text: best piece first, the leftmost of equals."""
        parts = list(text)
        ids, scores = self.v.ids, self.v.scores
        while len(parts) > 1:
            at, best = -1, 0.0
            for i in range(len(parts) - 1):
                piece = ids.get(parts[i] + parts[i + 1])
                if piece is not None and (at < 0 or scores[piece] > best):
                    at, best = i, scores[piece]
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _row(self, left: str) -> dict[str, bool]:
        """What is known about the pieces that may follow ``left`` ("" at the text's begin)."""
        row = self._pairs.get(left)
        if row is None:
            row = self._pairs[left] = {}
        return row

    def _allowed(self, left: str, right: str, row: dict[str, bool]) -> bool:
        if self._n_pairs >= PAIRS:
            self._pairs.clear()  # rows still in use stay with the search that uses them
            self._n_pairs = 0
        self._n_pairs += 1
        row[right] = known = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def pieces(self, text: Iterator[str] | str) -> Iterator[list[str]]:
        """Committed pieces of a text given whole or in chunks, in lists as they become final."""
        most = self.v.max_len
        step = self._step_bpe if self.v.bpe else self._step_unigram
        window = ""  # text from the last committed boundary on
        back = [0]  # per position of the window: where the last piece to it begins
        last = [""]  # that piece; at the boundary the last one committed
        state: list = [self._row("") if self.v.bpe else 0.0]
        for chunk in [text] if isinstance(text, str) else text:
            for begin in range(0, len(chunk), 4 * most):
                window += chunk[begin:begin + 4 * most]
                step(window, back, last, state)
                if len(back) > 4 * most:
                    boundary = self._meeting(back)
                    if boundary:
                        yield self._path(back, last, boundary)
                        window = window[boundary:]
                        back = [max(0, b - boundary) for b in back[boundary:]]
                        last, state = last[boundary:], state[boundary:]
        if len(back) > 1:
            yield self._path(back, last, len(back) - 1)

    def _step_bpe(self, window: str, back: list[int], last: list[str], rows: list[dict[str, bool]]) -> None:
        """Extend the back pointers to the end of the window: the one allowed path to each position."""
        is_piece, known = self._tails.get, self._pairs.get
        for end in range(len(back), len(window) + 1):
            j = end - 1
            candidate = window[j]
            whole = is_piece(candidate)
            while whole is not None:  # else nothing longer ends so either
                if whole:
                    ok = rows[j].get(candidate)
                    if ok is None:
                        ok = self._allowed(last[j], candidate, rows[j])
                    if ok:
                        break
                j -= 1
                if j < 0:
                    break
                candidate = window[j:end]
                whole = is_piece(candidate)
            if not whole or j < 0:  # a character outside the vocabulary
                j, candidate = end - 1, window[end - 1]
            back.append(j)
            last.append(candidate)
            rows.append(known(candidate) or self._row(candidate))

    def _step_unigram(self, window: str, back: list[int], last: list[str], totals: list[float]) -> None:
        """The same by the best sum of scores."""
        tails, ids, scores = self._tails, self.v.ids, self.v.scores
        for end in range(len(back), len(window) + 1):
            start, best = end - 1, None
            for j in range(end - 1, -1, -1):
                candidate = window[j:end]
                is_piece = tails.get(candidate)
                if is_piece is None:
                    break
                if is_piece:
                    value = totals[j] + scores[ids[candidate]]
                    if best is None or value >= best:
                        start, best = j, value
            if window[end - 1] not in ids and (best is None or totals[end - 1] + self._unknown > best):
                start, best = end - 1, totals[end - 1] + self._unknown
            back.append(start)
            last.append(window[start:end])
            totals.append(best)

    def _meeting(self, back: list[int]) -> int:
        """The last boundary that the paths of all positions still open run through."""
        open_ends = set(range(max(0, len(back) - self.v.max_len), len(back)))
        while len(open_ends) > 1:
            furthest = max(open_ends)
            open_ends.remove(furthest)
            open_ends.add(back[furthest])
        return open_ends.pop()

    @staticmethod
    def _path(back: list[int], last: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(last[end])
            end = back[end]
        return out[::-1]

    def _numbered(self, pieces: list[str], out: list[int]) -> None:
        ids, fallback = self.v.ids, self.v.byte_ids
        for piece in pieces:
            i = ids.get(piece)
            if i is not None:
                out.append(i)
            elif fallback:
                out.extend(fallback[b] for b in piece.encode())
            elif not self._in_unknown:
                out.append(self.v.unk_id)  # neighbours outside the vocabulary share one id
            self._in_unknown = i is None

    def encode(self, text: Iterator[str] | str) -> Iterator[int]:
        """Ids of prepared text (spaces are U+2581), as they become final."""
        self._in_unknown = False
        for pieces in self.pieces(text):
            out: list[int] = []
            self._numbered(pieces, out)
            yield from out

    def encode_sorted(self, texts: list[str]) -> Iterator[bytes]:
        """The ids (as bytes) of short texts in order; each goes on from the prefix it shares.

        The back pointers of a prefix do not depend on what follows, so those of the text before
        are kept as far as both texts agree.
        """
        step = self._step_bpe if self.v.bpe else self._step_unigram
        back, last, state, before = [0], [""], [self._row("") if self.v.bpe else 0.0], ""
        for text in texts:
            shared = 0
            for x, y in zip(text, before):
                if x != y:
                    break
                shared += 1
            del back[shared + 1:], last[shared + 1:], state[shared + 1:]
            step(text, back, last, state)
            self._in_unknown = False
            out: list[int] = []
            self._numbered(self._path(back, last, len(text)), out)
            before = text
            yield array("i", out).tobytes()


def prepared(text: str, v: Vocabulary) -> str:
    text = text.replace(" ", SPACE)
    return SPACE + text if v.prefix and text else text


def stretches(v: Vocabulary) -> Callable[[str], list[str]]:
    """Splits prepared text where no piece can cross, as far as the vocabulary allows that."""
    if any(SPACE in p.lstrip(SPACE) for p in v.ids):
        return lambda text: [text] if text else []
    if not v.bpe and not v.byte_ids:
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
    # a line end is the one common character that is in no piece of byte-fallback vocabularies
    breaks = "" if any("\n" in p for p in v.ids) else "\n"
    if not breaks:
        return re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
    return re.compile(f"\n+|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+").findall


class Coder:
    """Encodes and decodes batches of one task."""

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.search = Searcher(v)
        self.cut = stretches(v)
        self.memory: dict[str, bytes] = {}
        # an id of a text's first piece, raised by the number of pieces, stands for it without the added space
        raw = v.surfaces()
        self.surfaces = pa.array(raw + [r.removeprefix(b" ") if v.prefix else r for r in raw], type=pa.binary())

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Stretches that are not remembered are searched in order."""
        parts = [self.cut(prepared(t or "", self.v)) for t in texts]
        new = set().union(*parts).difference(self.memory)
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
            new = set().union(*parts)
        short = sorted(p for p in new if len(p) <= LONGEST_REMEMBERED)
        self.memory.update(zip(short, self.search.encode_sorted(short)))
        long = {p: array("i", self.search.encode(p)).tobytes() for p in new if len(p) > LONGEST_REMEMBERED}
        if not long:
            found = self.memory.__getitem__
            return [np.frombuffer(b"".join(map(found, p)), dtype=np.int32) for p in parts]
        found = self.memory.get
        return [np.frombuffer(b"".join(found(x) or long[x] for x in p), dtype=np.int32) for p in parts]

    def decode(self, ids: pa.ListArray | pa.LargeListArray) -> pa.Array:
        """The texts of lists of ids; bytes that are no UTF-8 become U+FFFD."""
        offsets = ids.offsets.to_numpy()
        values = ids.values.to_numpy().copy()
        values[offsets[:-1][np.diff(offsets) > 0]] += len(self.v.pieces)
        raw = pa.ListArray.from_arrays(ids.offsets, self.surfaces.take(pa.array(values)))
        joined = pc.binary_join(raw, pa.scalar(b"", pa.binary()))
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], type=pa.string())


def _encoder(v: Vocabulary):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(v)

        def made(keys: pa.Array, texts: list) -> pa.RecordBatch:
            rows = coder.encode(texts)
            offsets = np.zeros(len(rows) + 1, np.int32)
            np.cumsum([len(r) for r in rows], out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows), pa.int32()))
            wanted = pa.array([(t or "").replace(SPACE, " ") for t in texts], pa.string())
            return pa.record_batch(
                [keys, ids, pa.array(np.diff(offsets), pa.int32()), pc.equal(coder.decode(ids), wanted)],
                names=["doc_id", "ids", "n_ids", "round_trip"],
            )

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            cut = np.flatnonzero(np.diff(np.cumsum(sizes) // BYTES_PER_STEP)) + 1
            for start, stop in zip([0, *cut], [*cut, batch.num_rows]):
                if stop > start:
                    step = batch.slice(start, stop - start)
                    yield made(step.column(0), step.column(1).to_pylist())

    return encode


def encoded(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """``doc_id``, ``ids``, ``n_ids`` and whether decoding the ids gave the text back.

    The vocabulary travels with the tasks; its size is that of the model file.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string"))
    return rows.mapInArrow(_encoder(vocabulary), "doc_id long, ids array<int>, n_ids int, round_trip boolean")


def decoded(ids: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; null ids give an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(vocabulary)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            lists = pa.array(lists.to_pylist(), pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), coder.decode(lists)], names=["doc_id", "text"])

    return ids.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(decode, "doc_id long, text string")
