"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters that one suffix array indexes, and that one output batch holds.
INDEXED = 1 << 19
BATCH_CHARS = 1 << 20
#: Encoded runs and judged token pairs that a worker keeps between batches.
KEPT_RUNS = 300_000
KEPT_PAIRS = 2_000_000
#: A run is word characters with the spaces before them.
RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
START, NONE = -2, -1


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + lengths[i] - 1`` of all i, in order."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class PieceTable:
    """The pieces of a byte-fallback BPE model; ``rank`` orders their merges."""

    pieces: list[str]
    scores: list[float]
    byte_ids: list[int]
    normal: list[int]

    @classmethod
    def load(cls, path: str) -> PieceTable:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        pieces = [model.id_to_piece(i) for i in ids]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in byte_ids):
            raise ValueError("the model has no byte fallback")
        special = [
            model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            for i in ids
        ]
        return cls(
            pieces, [model.get_score(i) for i in ids], byte_ids, [i for i in ids if not special[i]]
        )

    @cached_property
    def id_of(self) -> dict[str, int]:
        return {self.pieces[i]: i for i in self.normal}

    @cached_property
    def lengths(self) -> np.ndarray:
        """Characters of each piece; one for what stands for an unknown character."""
        return np.array([*map(len, self.pieces), 1], np.int64)

    @cached_property
    def runs_are_apart(self) -> bool:
        """Whether no piece crosses from a character into a space."""
        return not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.id_of)

    def merged(self, text: str) -> list[int]:
        """Pieces of a text of known characters: the best-scored merge first."""
        parts = list(text)
        while len(parts) > 1:
            best = None
            for i in range(len(parts) - 1):
                found = self.id_of.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best[0]):
                    best = self.scores[found], i
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.id_of[p] for p in parts]

    @cached_property
    def standing(self) -> np.ndarray:
        """Whether a text that is just this piece is encoded as it."""
        known = set("".join(p for p in self.id_of if len(p) == 1))
        whole = np.zeros(len(self.pieces) + 1, bool)
        for piece, i in self.id_of.items():
            whole[i] = set(piece) <= known and self.merged(piece) == [i]
        whole[-1] = True
        return whole

    @cached_property
    def by_length(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each length the ids of the pieces and their code points."""
        groups: dict[int, list[int]] = {}
        for i in self.normal:
            if self.standing[i]:
                groups.setdefault(len(self.pieces[i]), []).append(i)
        return [
            (np.array(ids), np.array([[ord(c) for c in self.pieces[i]] for i in ids], np.int32))
            for _, ids in sorted(groups.items())
        ]

    @cached_property
    def text_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each id decodes to: start and length in one run of bytes."""
        byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        normal = set(self.normal)
        parts = [
            bytes([byte_of[i]]) if i in byte_of
            else p.replace(SPACE, " ").encode() if i in normal else b""
            for i, p in enumerate(self.pieces)
        ]
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.cumsum(lengths) - lengths, lengths, np.frombuffer(b"".join(parts), np.uint8)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` codes or more, by doubling ranks."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < depth and len(codes):
        after = np.zeros(len(rank), np.int64)
        after[: max(0, len(rank) - width)] = rank[width:] + 1
        distinct, rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)
        width *= 2
        if len(distinct) == len(rank):
            break
    return np.argsort(rank, kind="stable")


def occurrence_ranges(
    codes: np.ndarray, order: np.ndarray, pieces: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For pieces of one length, the range of ``order`` whose suffixes begin with each."""
    n, length = len(order), pieces.shape[1]
    padded = np.concatenate([codes, np.full(length, -1, codes.dtype)])
    bounds = []
    for upper in (False, True):
        low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), n, np.int64)
        for _ in range(n.bit_length()):
            open_ = low < high
            mid = np.where(open_, (low + high) // 2, 0)
            at = order[mid]
            less = np.zeros(len(pieces), bool)
            equal = np.ones(len(pieces), bool)
            for k in range(length):
                suffix = padded[at + k]
                less |= equal & (suffix < pieces[:, k])
                equal &= suffix == pieces[:, k]
            right = less | (equal if upper else False)
            low = np.where(open_ & right, mid + 1, low)
            high = np.where(open_ & ~right, mid, high)
        bounds.append(low)
    return bounds[0], bounds[1]


class Encoder:
    """Encodes batches of texts, and keeps a bounded store of runs and pairs."""

    def __init__(self, table: PieceTable) -> None:
        self.table = table
        self.unknown = len(table.pieces)
        self.pair_keys = np.zeros(0, np.int64)
        self.pair_valid = np.zeros(0, bool)
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the text of two pieces is encoded as just these two."""
        keys = left * (self.unknown + 1) + right
        wanted, where = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.pair_keys, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.pair_keys)
        known[inside] = self.pair_keys[at[inside]] == wanted[inside]
        valid = np.ones(len(wanted), bool)
        valid[known] = self.pair_valid[at[known]]
        new = wanted[~known]
        if len(new):
            valid[~known] = [
                self._pair(*divmod(int(key), self.unknown + 1)) for key in new
            ]
            if len(self.pair_keys) > KEPT_PAIRS:
                self.pair_keys, self.pair_valid = self.pair_keys[:0], self.pair_valid[:0]
            keys_ = np.concatenate([self.pair_keys, new])
            order = np.argsort(keys_, kind="stable")
            self.pair_valid = np.concatenate([self.pair_valid, valid[~known]])[order]
            self.pair_keys = keys_[order]
        return valid[where]

    def _pair(self, left: int, right: int) -> bool:
        if self.unknown in (left, right):
            return True
        a, b = self.table.pieces[left], self.table.pieces[right]
        return a + b not in self.table.id_of and self.table.merged(a + b) == [left, right]

    def _index(self, runs: Sequence[str]) -> None:
        """Encode new runs by one suffix array over their concatenation.

        Every piece's range in the array gives its occurrences as edges. Edges
        are sorted by position and relaxed in that order: an edge extends the
        encoding of the text before it if its piece and the last one before it
        stay apart. Of a text's encodings under that rule there is one, the one
        that merging gives.
        """
        table, sizes = self.table, np.array([len(r) for r in runs], np.int64)
        joined = np.frombuffer("\0".join([*runs, ""]).encode("utf-32-le"), np.int32).copy()
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        joined[ends] = 0x110000
        order = suffix_array(joined, max(p.shape[1] for _, p in table.by_length))
        present = np.zeros(0x110001, bool)
        present[joined] = True
        starts, ids = [], []
        covered = np.zeros(len(joined), bool)
        covered[ends] = True
        for piece_ids, codes in table.by_length:
            possible = present[codes].all(axis=1)
            low, high = occurrence_ranges(joined, order, codes[possible])
            found = order[_ragged(low, high - low)]
            starts.append(found)
            ids.append(np.repeat(piece_ids[possible], high - low))
            if codes.shape[1] == 1:
                covered[found] = True
        unknown = np.flatnonzero(~covered)
        start = np.concatenate([*starts, unknown])
        piece = np.concatenate([*ids, np.full(len(unknown), self.unknown)])
        run_of = np.repeat(np.arange(len(runs)), sizes + 1)
        offset = start - begins[run_of[start]]
        by_position = np.argsort(offset, kind="stable")
        start, piece, offset = start[by_position], piece[by_position], offset[by_position]
        last = np.full(len(joined) + 1, NONE, np.int64)
        last[begins] = START
        steps = np.searchsorted(offset, np.arange(int(sizes.max(initial=0)) + 1))
        for a, b in zip(steps, [*steps[1:], len(offset)]):
            before, here = last[start[a:b]], piece[a:b]
            reached = before != NONE
            open_ = np.flatnonzero(reached & (before != START))
            reached[open_] = self._stay_apart(before[open_], here[open_])
            last[start[a:b][reached] + table.lengths[here[reached]]] = here[reached]
        chosen = np.full(len(joined), NONE, np.int64)
        at = ends[sizes > 0]
        stop = begins[sizes > 0]
        while len(at):
            token = last[at]
            at = at - table.lengths[token]
            chosen[at] = token
            more = at > stop
            at, stop = at[more], stop[more]
        self._store(runs, joined, run_of, chosen)

    def _store(
        self, runs: Sequence[str], joined: np.ndarray, run_of: np.ndarray, chosen: np.ndarray
    ) -> None:
        """Append the runs' ids, with unknown characters as their bytes."""
        where = np.flatnonzero(chosen != NONE)
        tokens = chosen[where]
        odd = np.flatnonzero(tokens == self.unknown)
        as_bytes = [chr(c).encode() for c in joined[where[odd]]]
        width = np.ones(len(tokens), np.int64)
        width[odd] = [len(b) for b in as_bytes]
        flat = np.repeat(tokens, width).astype(np.int32)
        firsts = (np.cumsum(width) - width)[odd]
        byte_ids = np.array(self.table.byte_ids, np.int32)
        flat[_ragged(firsts, width[odd])] = byte_ids[
            np.frombuffer(b"".join(as_bytes), np.uint8)
        ]
        lengths = np.bincount(run_of[where], width, len(runs)).astype(np.int64)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])

    def _split(self, text: str) -> list[str]:
        marked = SPACE + text.replace(" ", SPACE) if text else ""
        return RUNS.findall(marked) if self.table.runs_are_apart else [marked][: len(marked)]

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the end of each text's ids."""
        if len(self.slot) > KEPT_RUNS:
            self._forget()
        pending: list[str] = []
        size, counts, slots = 0, [], []
        for text in texts:
            runs = self._split(text)
            counts.append(len(runs))
            for run in runs:
                slot = self.slot.get(run)
                if slot is None:
                    slot = self.slot[run] = len(self.slot)
                    pending.append(run)
                    size += len(run) + 1
                    if size >= INDEXED:
                        self._index(pending)
                        pending, size = [], 0
                slots.append(slot)
        if pending:
            self._index(pending)
        used = np.array(slots, np.int64)
        lengths = self.lengths[used]
        ids = self.flat[_ragged(self.starts[used], lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return ids, upto[np.cumsum(counts, dtype=np.int64)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of ids that ``encode`` gave; bytes that are no UTF-8 become U+FFFD."""
        starts, lengths, pool = self.table.text_bytes
        data = pool[_ragged(starts[ids], lengths[ids])].tobytes()
        upto = np.concatenate([[0], np.cumsum(lengths[ids])])
        at, texts = 0, []
        for end in upto[ends]:
            text = data[at:end].decode("utf-8", "replace")
            texts.append(text.removeprefix(" "))
            at = end
        return texts


_kept: dict[str, Encoder] = {}


def _encoder(model: str, table: PieceTable) -> Encoder:
    """The worker's encoder of a model, with the runs and pairs of earlier tasks."""
    if model not in _kept:
        _kept.clear()
        _kept[model] = Encoder(table)
    return _kept[model]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``BATCH_CHARS`` characters."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts) or not texts:
        yield begin, len(texts)


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))


def encoded(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``docs`` with ``ids`` and ``n_tokens``, the pieces of each whole text.

    The ids are those of SentencePiece: a space before the text, characters
    that no piece holds as their bytes. A null or empty text has none. Rows are
    encoded alone, so repeated ones get equal ids. ``docs`` must not have
    columns of these two names. The model's pieces go out with the tasks.
    """
    table = PieceTable.load(model)
    column = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, table)
        for batch in batches:
            texts = [t or "" for t in batch.column(column).to_pylist()]
            for a, b in _slices(texts):
                ids, ends = encoder.encode(texts[a:b])
                counts = pa.array(np.diff(ends, prepend=0), pa.int64())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _lists(ids, ends), counts],
                    [*part.schema.names, "ids", "n_tokens"],
                )

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
        ]
    )
    return docs.mapInArrow(of, schema)


def decoded(tokens: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``tokens`` with ``decoded``, the text of its ``ids``; of null ids an empty one.

    The decoding of an encoded text is that text, but that U+2581, which marks
    spaces, comes back as a space. An id outside the model is an error.
    """
    table = PieceTable.load(model)
    column = tokens.columns.index("ids")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, table)
        for batch in batches:
            lists = batch.column(column)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            texts = pa.array(encoder.decode(ids, np.cumsum(sizes)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, texts], [*batch.schema.names, "decoded"]
            )

    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    return tokens.mapInArrow(of, schema)


def round_trips(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, ids, n_tokens, same_text``: encoded, and decoded again to compare.

    Both directions run in one pass, so that ids do not go out to a second
    worker and back. Texts are taken as by ``encoded`` and ``decoded``.
    """
    table = PieceTable.load(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, table)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices(texts):
                ids, ends = encoder.encode(texts[a:b])
                same = [
                    back == text.replace(SPACE, " ")
                    for back, text in zip(encoder.decode(ids, ends), texts[a:b])
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        _lists(ids, ends),
                        pa.array(np.diff(ends, prepend=0), pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    ["doc_id", "ids", "n_tokens", "same_text"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, ids array<int>, n_tokens long, same_text boolean"
    )
