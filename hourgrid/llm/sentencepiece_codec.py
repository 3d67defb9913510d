"""SentencePiece encoding and decoding with a streaming Viterbi search.

A text is a path through the lattice of pieces. The search goes from boundary to
boundary; each one keeps the piece that ends there on the surviving path and a
pointer back. Only boundaries within the longest piece's length of the front can
still be extended. When the paths of all of them pass one common boundary, the ids
up to it are final: they are committed and the window forgets what lies before.
So the memory for a text of any length is a few times the longest piece.

Unigram models keep the path of the largest sum of piece scores. In a BPE model the
order of merges decides, not a sum: there a piece may follow another only if merging
the two pieces' joined text gives those two pieces back. Exactly one path to each
boundary has only such neighbours, and it is the model's own encoding of the text so
far, so the same search finds it.

Where no piece spans a blank after another character, every path has a boundary
before the blank: such segments are searched one by one, and the ids of short ones
are remembered in a bounded memo. Characters without a piece become bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.errors import ContractError

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MEMO_SEGMENTS = 250_000
MEMO_POINTS = 48
LANES = 20_000
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that text can match, the ids of bytes, and what each id stands for."""

    kind: int
    pieces: dict[str, int]
    scores: list[float]
    byte_ids: list[int]
    unknown: int
    texts: list[bytes]


def read_vocabulary(model_file: str = MODEL_FILE) -> Vocabulary:
    """Read a model that leaves text as it is but for one blank put before it."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kind = _model_kind(model.serialized_model_proto())
    if kind not in (UNIGRAM, BPE):
        raise ContractError("only unigram and BPE models can be searched")
    pieces: dict[str, int] = {}
    byte_ids, texts, scores = [-1] * 256, [], []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        scores.append(model.get_score(k))
        if model.is_byte(k):
            value = int(piece[3:-1], 16)
            byte_ids[value] = k
            texts.append(bytes([value]))
        elif model.is_control(k) or model.is_unknown(k):
            texts.append(b"")
        else:
            if not model.is_unused(k):
                pieces[piece] = k
            texts.append(piece.replace(SPACE, " ").encode())
    if min(byte_ids) < 0:
        raise ContractError("the model has no byte pieces, so it cannot keep every text")
    if model.encode("a  b ") == model.encode("a b"):
        raise ContractError("the model does not keep blanks")
    return Vocabulary(kind, pieces, scores, byte_ids, model.unk_id(), texts)


def _model_kind(model: bytes) -> int:
    """Field 3 of the trainer settings, which are field 2 of the model file; 1 if absent."""
    for field, value in _fields(model):
        if field == 2:
            return next((v for f, v in _fields(value) if f == 3), UNIGRAM)
    return UNIGRAM


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message in protocol-buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 2: None, 5: 4}[tag & 7]
        size = number() if size is None else size
        yield tag >> 3, message[at : at + size]
        at += size


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.longest = max(map(len, vocabulary.pieces), default=1)
        joined = any(" " in p.replace(SPACE, " ").lstrip(" ") for p in vocabulary.pieces)
        broken = not any("\n" in p for p in vocabulary.pieces)
        if joined:
            self.segments = re.compile(r"(?s).+")
        elif broken:
            self.segments = re.compile(r"\n| *[^ \n]+| +")
        else:
            self.segments = re.compile(r" *[^ ]+| +")
        self.fits: dict[int, bool] = {}
        self.names = {k: p for p, k in vocabulary.pieces.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.own = set(vocabulary.pieces)
        if vocabulary.kind == BPE:  # pieces that merging never reaches are on no path
            self.own = {p for p in vocabulary.pieces if self._take_apart(p)}
        # Text keeps its blanks; a real U+2581 matches nothing and is written in bytes.
        self.ids = {p.replace(SPACE, " "): vocabulary.pieces[p] for p in self.own}
        # The longest piece that ends with these two characters.
        self.reach: dict[str, int] = {}
        for piece in self.ids:
            if len(piece) > self.reach.get(piece[-2:], 1):
                self.reach[piece[-2:]] = len(piece)
        self.memo = _Memo(self.encode_segment)
        self.lanes = Lanes(self) if vocabulary.kind == BPE else None
        self.lengths = np.array([len(t) for t in vocabulary.texts], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.bytes = np.frombuffer(b"".join(vocabulary.texts), np.uint8)
        floor = min((vocabulary.scores[k] for k in self.ids.values()), default=0.0)
        self.unknown_score = floor - 10.0

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; an empty one has none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; segments not met before are searched together."""
        split = [self.segments.findall(" " + text) if text else [] for text in texts]
        if self.lanes:
            memo, older = self.memo, self.memo.older
            new = [
                s
                for s in set().union(*split)
                if len(s) <= MEMO_POINTS and s not in memo and s not in older
            ]
            for low in range(0, len(new), LANES):
                part = new[low : low + LANES]
                for segment, found in zip(part, self.lanes.encode(part)):
                    self.memo.keep(segment, found)
        memo = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(memo, segments)), np.int32) for segments in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, without the blank that encoding put before it."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)
        text = self.bytes[at].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    def encode_segment(self, segment: str) -> bytes:
        return np.array(list(self.search(segment)), np.int32).tobytes()

    def search(self, segment: str) -> Iterator[int]:
        """Ids of a segment, committed as soon as all surviving paths agree on them."""
        step = self._step_bpe if self.vocabulary.kind == BPE else self._step_unigram
        longest = self.longest
        # The window's boundaries from `base` on: last piece (-1: bytes), pointer back, score.
        window = segment[: 8 * longest]
        base, read = 0, len(window)
        last, back, best = [-1], [0], [0.0]
        while True:
            for end in range(len(last), len(window) + 1):
                step(window, end, last, back, best)
            if base + len(window) == len(segment):
                yield from self._path(window, last, back, len(window))
                return
            common = self._common(back)
            if common:
                yield from self._path(window, last, back, common)
                base += common
                window = window[common:]
                last, best = last[common:], best[common:]
                back = [max(0, at - common) for at in back[common:]]
            window += segment[read : read + 4 * longest]
            read = base + len(window)

    def _step_bpe(self, text: str, end: int, last: list, back: list, best: list) -> None:
        """Find the one piece that ends here and fits behind the path to where it begins."""
        ids, fits, width = self.ids, self.fits, len(self.vocabulary.scores)
        low = end - self.reach.get(text[end - 2 : end], 1)
        for low in range(low if low > 0 else 0, end):
            k = ids.get(text[low:end])
            if k is None:
                continue
            before = last[low]
            if before >= 0:
                pair = before * width + k
                fit = fits.get(pair)
                if fit is None:
                    fit = self.fit(before, k)
                if not fit:
                    continue
            last.append(k)
            back.append(low)
            return
        last.append(-1)
        back.append(end - 1)

    def _step_unigram(self, text: str, end: int, last: list, back: list, best: list) -> None:
        """Find the piece that ends here on the path of the largest score."""
        ids, scores = self.ids, self.vocabulary.scores
        found, start, top = -1, end - 1, best[end - 1] + self.unknown_score
        if text[end - 1] in ids:
            top = float("-inf")
        low = end - self.reach.get(text[end - 2 : end], 1)
        for low in range(low if low > 0 else 0, end):
            k = ids.get(text[low:end])
            if k is not None and best[low] + scores[k] > top:
                found, start, top = k, low, best[low] + scores[k]
        last.append(found)
        back.append(start)
        best.append(top)

    def _common(self, back: list[int]) -> int:
        """The last boundary on the paths of all boundaries that a piece can still extend."""
        front = len(back) - 1
        heads = set(range(front - self.longest + 1, front + 1))
        while len(heads) > 1:
            head = max(heads)
            heads.discard(head)
            heads.add(back[head])
        return heads.pop()

    def _path(self, text: str, last: list, back: list, high: int) -> list[int]:
        found = []
        while high > 0:
            if last[high] >= 0:
                found.append(last[high])
            else:
                one = text[back[high] : high].encode("utf-8", "surrogatepass")
                found.extend(self.vocabulary.byte_ids[b] for b in reversed(one))
            high = back[high]
        return found[::-1]

    def fit(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two pieces gives these two pieces."""
        if len(self.fits) > 4 * MEMO_SEGMENTS:
            self.fits.clear()
        if left in self.halves and right in self.halves:
            fit = self._apart(left, right)
        else:
            names = [self.names[left], self.names[right]]
            fit = self._merged("".join(names)) == names
        self.fits[left * len(self.vocabulary.scores) + right] = fit
        return fit

    def _apart(self, a: int, b: int) -> bool:
        """Undo the merges next to the border, latest first, looking for one across it.

        A merge across the border would have come before the one just undone if its
        score is better; if it is the same, the merge further left comes first.
        """
        names, halves, pieces, scores = self.names, self.halves, self.vocabulary.pieces, self.vocabulary.scores
        if names[a] + names[b] in pieces:
            return False
        while True:
            of_a = scores[a] if halves[a][0] >= 0 else 1.0
            of_b = scores[b] if halves[b][0] >= 0 else 1.0
            if of_a == of_b == 1.0:
                return True
            if of_a < of_b:
                a = halves[a][1]
                across = pieces.get(names[a] + names[b])
                if across is not None and scores[across] > of_a:
                    return False
            else:
                b = halves[b][0]
                across = pieces.get(names[a] + names[b])
                if across is not None and scores[across] >= of_b:
                    return False

    def _take_apart(self, piece: str) -> bool:
        """Note the two halves of a piece; False if merging never gives it.

        Pieces whose parts do not merge before them, such as runs of blanks of one
        score, have no halves noted and are compared by merging.
        """
        pieces, scores = self.vocabulary.pieces, self.vocabulary.scores
        k = pieces[piece]
        if len(piece) == 1:
            self.halves[k] = (-1, -1)
            return True
        parts = self._merged(piece, stop=2)
        if len(parts) != 2 or self._merged(piece) != [piece]:
            return False
        of_parts = [pieces.get(p, -1) for p in parts]
        if min(of_parts) >= 0 and scores[k] < 0:
            below = [scores[j] for j, p in zip(of_parts, parts) if len(p) > 1]
            if all(s > scores[k] and s < 1 for s in below) and SPACE * 2 not in piece:
                self.halves[k] = (of_parts[0], of_parts[1])
        return True

    def _merged(self, text: str, stop: int = 1) -> list[str]:
        """Merge neighbours of a short text, the best score first, then the leftmost."""
        parts = list(text)
        scores, pieces = self.vocabulary.scores, self.vocabulary.pieces
        while len(parts) > stop:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = pieces.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or scores[found] > best):
                    best, at = scores[found], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


class Lanes:
    """The BPE search of many short segments in lockstep, one boundary of each at a time.

    Every segment is shorter than the window, so its ids are committed at its end.
    """

    PAIR_BITS = 21
    PREFIX_BITS = 20
    BASE = 0x9E3779B97F4A7C15

    def __init__(self, codec: Codec):
        self.codec = codec
        self.pair_keys = np.full(1 << self.PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << self.PAIR_BITS, bool)
        # Prefixes of pieces by hash, in a table with linear probing; value -1: no piece.
        prefixes = dict.fromkeys(p[:k] for p in codec.ids for k in range(1, len(p)))
        found = {p: codec.ids.get(p, -1) for p in [*prefixes, *codec.ids]}
        self.keys = np.zeros((1 << self.PREFIX_BITS) + 64, np.uint64)
        self.values = np.full(len(self.keys), -1, np.int32)
        for prefix, k in found.items():
            state = 0
            for char in prefix:
                state = (state + ord(char) + 1) * self.BASE % (1 << 64)
                state ^= state >> 29
            slot = state >> (64 - self.PREFIX_BITS)
            while self.keys[slot]:
                slot += 1
            self.keys[slot], self.values[slot] = state, k

    @staticmethod
    def _hash(state: np.ndarray, points: np.ndarray) -> np.ndarray:
        state = (state + points + np.uint64(1)) * np.uint64(Lanes.BASE)
        return state ^ (state >> np.uint64(29))

    def _find(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is a prefix, and the piece it is."""
        slots = (states >> np.uint64(64 - self.PREFIX_BITS)).astype(np.int64)
        keys = self.keys[slots]
        odd = np.flatnonzero((keys != states) & (keys != 0))
        while len(odd):
            slots[odd] += 1
            keys[odd] = self.keys[slots[odd]]
            odd = odd[(keys[odd] != states[odd]) & (keys[odd] != 0)]
        return keys == states, np.where(keys == states, self.values[slots], -1)

    def _fits(self, before: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        pairs = before * len(self.codec.vocabulary.scores) + pieces
        slots = (pairs * 0x9E3779B1 >> 7) & ((1 << self.PAIR_BITS) - 1)
        fits = self.pair_fits[slots]
        new = (self.pair_keys[slots] != pairs) & (before >= 0)
        if new.any():
            missing, at = np.unique(pairs[new], return_inverse=True)
            width = len(self.codec.vocabulary.scores)
            known = np.array([self.codec.fit(*divmod(int(x), width)) for x in missing])
            fits[new] = known[at]
            self.pair_keys[slots[new]] = pairs[new]
            self.pair_fits[slots[new]] = fits[new]
        return fits | (before < 0)

    def encode(self, segments: list[str]) -> list[bytes]:
        segments_by_length = sorted(range(len(segments)), key=lambda k: -len(segments[k]))
        ordered = [segments[k] for k in segments_by_length]
        lengths = np.array([len(s) for s in ordered])
        points = np.frombuffer("".join(ordered).encode("utf-32-le"), np.uint32).astype(np.uint64)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        room = np.repeat(starts + lengths, lengths) - np.arange(len(points))
        longest = min(self.codec.longest, int(lengths[0]))
        at, states = np.arange(len(points)), np.zeros(len(points), np.uint64)
        pieces = np.full((longest + 1, len(points)), -1, np.int32)
        for size in range(1, longest + 1):
            states = self._hash(states, points[at + size - 1])
            found, values = self._find(states)
            pieces[size, at] = values
            on = found & (room[at] > size)
            at, states = at[on], states[on]
        # Boundaries of a lane are one more than its points.
        first = starts + np.arange(len(ordered))
        last = np.full(len(points) + len(ordered), -1, np.int64)
        back = np.ones(len(last), np.int64)
        for end in range(1, int(lengths[0]) + 1):
            lanes = np.arange(np.searchsorted(-lengths, -end, "right"))
            for size in range(min(end, longest), 0, -1):
                piece = pieces[size, starts[lanes] + (end - size)]
                some = np.flatnonzero(piece >= 0)
                if not len(some):
                    continue
                here, piece = lanes[some], piece[some].astype(np.int64)
                fits = self._fits(last[first[here] + (end - size)], piece)
                last[first[here[fits]] + end] = piece[fits]
                back[first[here[fits]] + end] = size
                open_ = np.ones(len(lanes), bool)
                open_[some[fits]] = False
                lanes = lanes[open_]
        ids = np.full((len(ordered), int(lengths[0])), -1, np.int32)
        odd = np.zeros(len(ordered), bool)
        lanes, end, column = np.arange(len(ordered)), lengths.copy(), ids.shape[1]
        while len(lanes):
            column -= 1
            boundary = first[lanes] + end
            ids[lanes, column] = last[boundary]
            odd[lanes] |= last[boundary] < 0
            end = end - back[boundary]
            lanes, end = lanes[end > 0], end[end > 0]
        counts = (ids >= 0).sum(axis=1)
        flat = ids[ids >= 0].tobytes()
        ends = 4 * np.cumsum(counts)
        out: list[bytes] = [b""] * len(segments)
        for k, low, high, plain in zip(segments_by_length, ends - 4 * counts, ends, ~odd):
            out[k] = flat[low:high] if plain else self.codec.encode_segment(segments[k])
        return out


class _Memo(dict):
    """What short segments encode to; the older half goes when the newer one is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = self.encode(segment)
        if len(segment) <= MEMO_POINTS:
            self.keep(segment, found)
        return found

    def keep(self, segment: str, found: bytes) -> None:
        if len(self) >= MEMO_SEGMENTS:
            self.older = dict(self)
            self.clear()
        self[segment] = found

    def forget(self) -> None:
        self.older = {}
        self.clear()


_CODECS: dict[int, Codec] = {}


def _codec(sent) -> Codec:
    """One codec for each worker and broadcast."""
    key = id(sent.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(sent.value)
    return _CODECS[key]


def encode_documents(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    model_file: str = MODEL_FILE,
) -> DataFrame:
    """Rows of docs with columns keep (all if None), and _ids and _exact added.

    _exact tells whether decoding the ids gives the text back. Null and empty texts
    have no ids and are exact. The model file is read on the driver only. No rows
    give no rows; added names must not be taken.
    """
    keep = docs.columns if keep is None else keep
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_file))
    added = [
        T.StructField("_ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("_exact", T.BooleanType()),
    ]
    schema = T.StructType([docs.schema[c] for c in keep] + added)
    inputs = list(dict.fromkeys([*keep, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        try:
            for batch in batches:
                for low in range(0, batch.num_rows, 256):
                    part = batch.slice(low, 256)
                    texts = [text or "" for text in part.column(text_col).to_pylist()]
                    ids = codec.encode_all(texts)
                    exact = [codec.decode(found) == text for found, text in zip(ids, texts)]
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                    values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(ends), values)
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in keep), lists, pa.array(exact)],
                        names=[*keep, "_ids", "_exact"],
                    )
        finally:  # the worker lives on, and its memory counts while other stages run
            codec.memo.forget()

    return docs.select(*inputs).mapInArrow(run, schema)


def decode_documents(
    rows: DataFrame, ids_col: str = "_ids", keep: list[str] | None = None,
    model_file: str = MODEL_FILE,
) -> DataFrame:
    """Rows with columns keep (all if None) and _text, the text of their ids; null ids are empty."""
    keep = rows.columns if keep is None else keep
    sent = rows.sparkSession.sparkContext.broadcast(read_vocabulary(model_file))
    schema = T.StructType(
        [rows.schema[c] for c in keep] + [T.StructField("_text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent)
        for batch in batches:
            texts = [
                codec.decode(np.array(ids.as_py() or [], np.int64)) for ids in batch.column(ids_col)
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(texts, pa.string())],
                names=[*keep, "_text"],
            )

    return rows.select(*dict.fromkeys([*keep, ids_col])).mapInArrow(run, schema)


def id_digest(ids: str = "_ids") -> F.Column:
    """SHA-256 of the ids, written in decimal and joined by blanks."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
