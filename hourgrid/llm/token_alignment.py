"""Alignment of the tokens of two tokenizers by the bytes they stand for.

The work is done on whole Arrow arrays. Texts are cut into segments before blanks,
where neither tokenizer has a token across; each different segment is encoded once
and its ids are taken for all places. Flattened lists with their parent indices and
segmented running sums of the tokens' bytes give each token the place where it ends.
A hash join of both token tables on (text, end) yields the links; the ends they share
cut both sequences into groups.

How many links of the corpus hold a pair of ids is counted with grouped tables of
bounded size, and Spark adds the partial counts. The most frequent pairs, up to a
fixed number, are broadcast to the links; links of other pairs are joined with the
stored counts.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from hourgrid.llm.common import stored
from hourgrid.llm.textbatch import row_groups, utf8

BYTE_BPE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
PIECE_BYTES = 1 << 19
SPACE = "▁"
# Counted pairs that a worker gathers before it hands them on.
PAIRS_HELD = 1 << 19
# Segments whose ids a worker remembers, and their longest length in bytes.
MEMO_SEGMENTS = 200_000
MEMO_BYTES = 64
# Longer segments are encoded by themselves.
TOGETHER_BYTES = 1 << 12
# Pairs with counts that are broadcast, at 17 bytes each.
CACHED_PAIRS = 1 << 20

ADDED = T.StructType(
    [T.StructField(name, T.LongType(), False) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [
        T.StructField("groups", T.StringType(), False),
        T.StructField("link_a", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("link_b", T.ArrayType(T.IntegerType(), False), False),
        T.StructField("pairs", T.ArrayType(T.LongType(), False), False),
        T.StructField("pair_links", T.ArrayType(T.LongType(), False), False),
    ]
)


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for
    the characters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def byte_level_tokens(file: bytes) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary; special tokens are their own text."""
    spec, alphabet = json.loads(file), byte_alphabet()
    vocabulary = {i: token for token, i in spec["model"]["vocab"].items()}
    special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    size = max([*vocabulary, *special]) + 1
    return [
        special[i] if i in special else bytes(alphabet[c] for c in vocabulary.get(i, ""))
        for i in range(size)
    ]


# Fixed value: how a byte-level vocabulary cuts text before its merges.
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def rank_encoder(file: bytes) -> Callable[[str], list[int]] | None:
    """A faster encoder of the same vocabulary; None unless its ids follow its merges.

    Where each merge makes the next id, and text is cut by the usual pattern alone,
    merging by rank of the joined bytes is merging in the order of the file.
    """
    spec = json.loads(file)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    special = {t["id"] for t in spec.get("added_tokens", [])}
    tokens = byte_level_tokens(file)
    ordered = all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(pairs))
    plain = (
        model.get("type") == "BPE"
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix",
                                           "end_of_word_suffix"))
        and spec.get("normalizer") is None
    )
    if not (ordered and plain and len(tokens) - len(special) == 256 + len(pairs)):
        return None
    ranks = {token: i for i, token in enumerate(tokens) if i not in special}
    return tiktoken.Encoding(
        "byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


def piece_tokens(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id of a SentencePiece model."""
    return [
        bytes([int(model.id_to_piece(i)[3:-1], 16)])
        if model.is_byte(i)
        else model.id_to_piece(i).replace(SPACE, " ").encode()
        for i in range(model.get_piece_size())
    ]


@dataclass(frozen=True)
class TokenTable:
    """Bytes of all ids, and the ids in decimal followed by `,`, and by what ends a group."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    names: pa.Array

    @staticmethod
    def of(tokens: list[bytes], end: str) -> TokenTable:
        lengths = np.array([len(t) for t in tokens], np.int64)
        names = [f"{i}{mark}" for i in range(len(tokens)) for mark in (",", end)]
        return TokenTable(
            np.frombuffer(b"".join(tokens), np.uint8),
            np.cumsum(lengths) - lengths,
            lengths,
            pa.array(names, pa.large_string()),
        )

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after another."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[np.arange(len(shift)) + shift]


class Pair:
    """Two tokenizers and their memo; one for each worker."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        self.tokenizer = Tokenizer.from_buffer(byte_file)
        self.tokenizer.encode_special_tokens = True
        self.encode_a = rank_encoder(byte_file) or self._byte_level
        self.model = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        self.a = TokenTable.of(byte_level_tokens(byte_file), "|")
        pieces = piece_tokens(self.model)
        self.b = TokenTable.of(pieces, ";")
        self.blank = self.model.piece_to_id(SPACE)
        # Without pieces across a blank, both tokenizers can be given segments.
        self.segmented = all(b" " not in piece.lstrip(b" ") for piece in pieces)
        # Two generations: what was not met while the younger one filled is forgotten.
        self.memo: dict[bytes, tuple[bytes, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, bytes]] = {}

    def _byte_level(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, segments: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Ids, as bytes of int32, of different segments that each begin with a blank."""
        memo, older = self.memo, self.older
        found = [memo.get(s) or older.get(s) for s in segments]
        plain, odd = [], []
        for k, known in enumerate(found):
            if known is None:
                (plain if _closed(segments[k]) else odd).append(k)
        fresh = self._encode_together([segments[k] for k in plain])
        for k, ids in zip(plain, fresh):
            found[k] = ids
        for k in odd:
            found[k] = self._encode_one(segments[k])
        if len(memo) + len(segments) > MEMO_SEGMENTS // 2:
            self.older, self.memo = memo, {}
        self.memo.update((s, ids) for s, ids in zip(segments, found) if len(s) <= MEMO_BYTES)
        return found

    def _encode_one(self, segment: bytes) -> tuple[bytes, bytes]:
        text = segment.decode("utf-8", "replace")
        left = self._byte_level(text)
        right = self.model.encode(text[1:]) if len(text) > 1 else [self.blank]
        return array("i", left).tobytes(), array("i", right).tobytes()

    def _encode_together(self, segments: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Encode segments as one text, which both tokenizers cut where a segment begins."""
        if not segments:
            return []
        text = b"".join(segments).decode("utf-8")
        ends = np.cumsum([len(s) for s in segments])
        sides = []
        for table, ids in (
            (self.a, self.encode_a(text)),
            (self.b, self.model.encode(text[1:])),
        ):
            ids = np.array(ids, np.int32)
            last = np.cumsum(table.lengths[ids])
            at = np.searchsorted(last, ends, "left")
            if last[-1] != ends[-1] or not np.array_equal(last[at], ends):
                return [self._encode_one(s) for s in segments]
            raw, cuts = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
            sides.append([raw[x:y] for x, y in zip(cuts, cuts[1:])])
        return list(zip(*sides))


def _closed(segment: bytes) -> bool:
    """Whether a segment, which begins with a blank, is short and no text after it changes its tokens."""
    last = segment[-1]
    if last <= 32 or last == 127 or len(segment) > TOGETHER_BYTES:
        return False
    if segment.isascii():
        return True
    try:
        text = segment.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return not text[-1].isspace() and SPACE not in text


def segment_starts(data: np.ndarray, offsets: np.ndarray, segmented: bool) -> np.ndarray:
    """Starts of texts, and of blanks after a character that is no white space."""
    if not segmented:
        return offsets[:-1]
    before = [np.concatenate((np.zeros(k, np.uint8), data[: max(0, len(data) - k)])) for k in (1, 2, 3)]
    p, q, r = (x[: len(data)] for x in before)
    white = (p <= 32) | (p == 127)
    white |= (q == 0xC2) & ((p == 0x85) | (p == 0xA0))
    white |= (r == 0xE1) & (q == 0x9A) & (p == 0x80)
    white |= (r == 0xE2) & (q == 0x80) & ((p <= 0x8A) | (p == 0xA8) | (p == 0xA9) | (p == 0xAF))
    white |= (r == 0xE2) & (q == 0x81) & (p == 0x9F)
    white |= (r == 0xE3) & (q == 0x80) & (p == 0x80)
    white |= (r == 0xE2) & (q == 0x96) & (p == 0x81)
    cut = (data == 32) & ~white
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


def _lists(parts: list[bytes]) -> pa.LargeListArray:
    """Lists of int32 from their bytes."""
    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in parts]))).astype(np.int64)
    return pa.LargeListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _tokens(lists: pa.Array, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flattened ids, and the text each belongs to."""
    ids = lists.flatten().to_numpy()
    return ids, owner[lists.value_parent_indices().to_numpy()]


def _ends(lengths: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """Running sum of the lengths within each text."""
    total = np.cumsum(lengths)
    first = np.searchsorted(owner, np.arange(docs), "left")
    base = np.concatenate(([0], total))[first]
    return total - base[owner]


def _faithful(ids, owner, table: TokenTable, data, offsets) -> np.ndarray:
    """Texts whose tokens' bytes are the text's own."""
    docs = len(offsets) - 1
    sizes = np.bincount(owner, weights=table.lengths[ids], minlength=docs).astype(np.int64)
    right = sizes == np.diff(offsets)
    joined = table.joined(ids)
    if right.all() and np.array_equal(joined, data):
        return right
    at = np.concatenate(([0], np.cumsum(sizes)))
    for doc in np.flatnonzero(right):
        mine = joined[at[doc] : at[doc + 1]]
        right[doc] = np.array_equal(mine, data[offsets[doc] : offsets[doc + 1]])
    return right


def _links(owner_a, end_a, owner_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of a and of b that end together, in order."""
    left = pa.table({"doc": owner_a, "end": end_a, "a": np.arange(len(owner_a))})
    right = pa.table({"doc": owner_b, "end": end_b, "b": np.arange(len(owner_b))})
    both = left.join(right, ["doc", "end"], join_type="inner", use_threads=False)
    a, b = both["a"].to_numpy(), both["b"].to_numpy()
    order = np.lexsort((b, a))
    return a[order], b[order]


def _written(a, group_a, b, group_b, tables: Pair, bounds: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` for each text; bounds are the first groups of the texts."""
    groups = int(bounds[-1])
    of_a = np.bincount(group_a, minlength=groups)
    of_b = np.bincount(group_b, minlength=groups)
    start_b = np.concatenate(([0], np.cumsum(of_b)))
    start_a = np.concatenate(([0], np.cumsum(of_a)))
    place_a = np.arange(len(a)) + start_b[group_a]
    place_b = np.arange(len(b)) + start_a[group_b + 1]
    last_a = np.concatenate((group_a[1:] != group_a[:-1], [True]))[: len(a)]
    last_b = np.concatenate((group_b[1:] != group_b[:-1], [True]))[: len(b)]
    names_a = len(tables.a.names)
    name = np.zeros(len(a) + len(b), np.int64)
    name[place_a] = 2 * a.astype(np.int64) + last_a
    name[place_b] = names_a + 2 * b.astype(np.int64) + last_b
    texts = pa.concat_arrays([tables.a.names, tables.b.names]).take(pa.array(name))
    _, offsets, data = texts.buffers()
    if data is None:
        return [b""] * (len(bounds) - 1)
    offsets = np.frombuffer(offsets, np.int64, len(texts) + 1)
    cuts = offsets[(start_a + start_b)[bounds]]
    view = memoryview(data)
    return [bytes(view[x : max(x, y - 1)]) for x, y in zip(cuts[:-1], cuts[1:])]


def _counted(links: list[pa.Table], rows: int) -> list[pa.Array]:
    """Columns pairs and pair_links for some rows: the counts of links, on the last row."""
    counted = pa.concat_tables(links).group_by("pair", use_threads=False).aggregate([("n", "sum")])
    ends = np.zeros(rows + 1, np.int32)
    ends[-1] = len(counted)
    return [
        pa.ListArray.from_arrays(pa.array(ends), counted[name].combine_chunks())
        for name in ("pair", "n_sum")
    ]


def align(column: pa.Array, tables: Pair) -> list[pa.Array]:
    """Columns ADDED but for the counts, for the texts of a column."""
    docs = len(column)
    raw, at = utf8(column)
    # A blank goes before every text.
    data = np.insert(raw, at[:-1], 32)
    offsets = at + np.arange(docs + 1)
    starts = segment_starts(data, offsets, tables.segmented)
    owner = np.searchsorted(offsets, starts, "right") - 1
    segments = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        len(starts),
        [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)],
    ).dictionary_encode()
    encoded = tables.encode(segments.dictionary.to_pylist())
    sides = []
    good = np.diff(at) > 0
    for side, table in enumerate((tables.a, tables.b)):
        ids, of = _tokens(_lists([x[side] for x in encoded]).take(segments.indices), owner)
        good &= _faithful(ids, of, table, data, offsets)
        sides.append((ids, of))
    (a, owner_a), (b, owner_b) = ((ids[good[of]], of[good[of]]) for ids, of in sides)
    end_a = _ends(tables.a.lengths[a], owner_a, docs)
    end_b = _ends(tables.b.lengths[b], owner_b, docs)
    link_a, link_b = _links(owner_a, end_a, owner_b, end_b)

    # Places in data where both end, in order; tokens go to the first that is not before.
    ends = offsets[owner_a[link_a]] + end_a[link_a]
    ends = ends[np.append(ends[1:] != ends[:-1], np.ones(min(1, len(ends)), bool))]
    group_a = np.searchsorted(ends, offsets[owner_a] + end_a, "left")
    group_b = np.searchsorted(ends, offsets[owner_b] + end_b, "left")
    bounds = np.searchsorted(ends, offsets, "right")
    written = _written(a, group_a, b, group_b, tables, bounds)
    n_links = np.bincount(owner_a[link_a], minlength=docs)
    link_ends = np.concatenate(([0], np.cumsum(n_links))).astype(np.int32)
    return [
        pa.array(np.bincount(owner_a, minlength=docs)),
        pa.array(np.bincount(owner_b, minlength=docs)),
        pa.array(np.diff(bounds)),
        pa.array(n_links),
        pa.array(written, pa.binary()).view(pa.string()),
        pa.ListArray.from_arrays(link_ends, a[link_a]),
        pa.ListArray.from_arrays(link_ends, b[link_b]),
    ]


_PAIRS: dict[int, Pair] = {}


def _pair(sent) -> Pair:
    key = id(sent.value)
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Pair(*sent.value)
    return _PAIRS[key]


def align_tokens(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    byte_file: str = BYTE_BPE_FILE,
    piece_file: str = PIECE_FILE,
) -> DataFrame:
    """Rows of docs with columns keep (all if None) and those of ADDED.

    A's tokens are those of a blank and the text under a byte-level vocabulary, B's
    those of the text under a SentencePiece model that puts a blank before it.
    n_a and n_b count them, groups writes them as `a1,a2|b1;a3|b2,b3`, link_a and
    link_b hold the ids of tokens that end at the same byte. pairs (a * 2^32 + b) and
    pair_links count the links of many rows at once, on one of them; pair_counts adds
    these partial counts. Null and empty texts, and
    those that either tokenizer does not give back byte by byte, have no tokens. Long
    texts are encoded whole. Rows that repeat are handled each by itself; no rows give
    no rows. Columns of docs that have an added name are replaced. The files are read
    on the driver only.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ADDED.names]
    schema = T.StructType([docs.schema[c] for c in keep] + ADDED.fields)
    with open(byte_file, "rb") as one, open(piece_file, "rb") as two:
        sent = docs.sparkSession.sparkContext.broadcast((one.read(), two.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _pair(sent)
        links_of_none = pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        for batch in batches:
            _, offsets = utf8(batch.column("_aligned"))
            held: list[pa.Table] = []
            for low, high in row_groups(offsets, PIECE_BYTES):
                part = batch.slice(low, high - low)
                columns = align(part.column("_aligned"), tables)
                a, b = (x.values.to_numpy().astype(np.int64) for x in columns[-2:])
                links = pa.table({"pair": a << 32 | b, "n": np.ones(len(a), np.int64)})
                links = links.group_by("pair", use_threads=False).aggregate([("n", "sum")])
                held.append(links.select(["pair", "n_sum"]).rename_columns(["pair", "n"]))
                full = high == batch.num_rows or sum(map(len, held)) >= PAIRS_HELD
                columns += _counted(held if full else [links_of_none], high - low)
                held = [] if full else held
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *columns], names=schema.names
                )

    return docs.select(*keep, docs[text_col].alias("_aligned")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): links that hold each pair of ids, and whether none of b has more.

    Adds up the partial counts that rows of aligned carry.
    """
    partial = aligned.where(F.size("pairs") > 0).select(
        F.explode(F.arrays_zip("pairs", "pair_links")).alias("part")
    )
    counts = partial.groupBy(F.col("part.pairs").alias("pair")).agg(
        F.sum("part.pair_links").alias("n")
    )
    counts = counts.select(
        F.shiftright("pair", 32).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("b"),
        "n",
    )
    counts = stored(counts, "pair-counts")
    # One row for each id of b: bounded by its vocabulary.
    top = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("top")))
    return counts.join(top, "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def frequent_from(counts: DataFrame, room: int = CACHED_PAIRS) -> int:
    """The smallest power of two such that at most room pairs have as many links."""
    size = F.floor(F.log2("n")).cast("int").alias("size")
    found = sorted(counts.groupBy(size).count().collect(), reverse=True)  # at most 63 rows
    total, least = 0, 62
    for row in found:
        total += row["count"]
        if total > room:
            break
        least = row["size"]
    return 1 << least


def score_links(aligned: DataFrame, counts: DataFrame, room: int = CACHED_PAIRS) -> DataFrame:
    """Rows of aligned without its links, with n_best and count_sum added.

    aligned and counts should be stored tables; aligned has a column row that differs
    from row to row. n_best counts links whose pair is best, count_sum adds the counts
    of their pairs; both are 0 without links. Up to room pairs, the most frequent ones,
    are broadcast to the links; links of other pairs are joined with their counts. Each
    such pair is in fewer links than any that was broadcast, so no key of that join is hot.
    """
    least = frequent_from(counts, room)
    links = aligned.where(F.size("link_a") > 0).select(
        "row", F.inline(F.arrays_zip(F.col("link_a").alias("a"), F.col("link_b").alias("b")))
    )
    cached = F.broadcast(counts.where(F.col("n") >= least))
    met = links.join(cached, ["a", "b"], "left")
    sums = [F.sum("n").alias("sum"), F.sum(F.col("best").cast("long")).alias("best")]
    found = met.groupBy("row").agg(*sums)
    if least > 1:
        rest = counts.where(F.col("n") < least)
        others = met.where(F.col("n").isNull()).select("row", "a", "b").join(rest, ["a", "b"])
        found = found.unionByName(others.groupBy("row").agg(*sums))
    found = found.groupBy("row").agg(
        F.coalesce(F.sum("best"), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum("sum"), F.lit(0)).alias("count_sum"),
    )
    gone = ("link_a", "link_b", "pairs", "pair_links", "n_best", "count_sum")
    return aligned.drop(*gone).join(found, "row", "left").fillna(0, ["n_best", "count_sum"])
