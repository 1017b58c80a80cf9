"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Code points become classes by one table lookup, classes and
their neighbourhood become symbols, and each symbol is a function from scanner state to scanner state.
Function composition is associative, so the state before every character comes from a scan: blocks advance
side by side for all start states, and the blocks' functions are composed by doubling. Slices between the
starts found go through a cache of merged pieces.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, texts, tokenizer_path

# Symbols of the scanner.
LETTER, NUMBER, OTHER, CONTRACTION2, CONTRACTION3, JOINING_SPACE, LONE_SPACE, SPACE_RUN, DOC_END = range(9)
# States: what the character before belongs to.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_SPACES, DONE, ONE_LEFT, TWO_LEFT = range(8)
#: White space as Unicode's property has it.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Letters and numbers that Unicode 16.0 added; Python's own table may be older.
LETTERS_OF_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_OF_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, by symbol and state before."""
    after = np.zeros((9, 8), np.uint8)
    starts = np.ones((9, 8), bool)
    own = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, CONTRACTION2: ONE_LEFT, CONTRACTION3: TWO_LEFT, JOINING_SPACE: AFTER_SPACE, LONE_SPACE: DONE, SPACE_RUN: IN_SPACES, DOC_END: DONE}
    for symbol, state in own.items():
        after[symbol] = state
    for symbol, state in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHERS)):
        starts[symbol, [state, AFTER_SPACE]] = False
    for symbol in (CONTRACTION2, CONTRACTION3):  # an apostrophe inside other signs, or after a space, is one of them
        after[symbol, [IN_OTHERS, AFTER_SPACE]] = IN_OTHERS
        starts[symbol, [IN_OTHERS, AFTER_SPACE]] = False
    after[LETTER, ONE_LEFT], after[LETTER, TWO_LEFT] = DONE, ONE_LEFT
    starts[LETTER, [ONE_LEFT, TWO_LEFT]] = False
    starts[SPACE_RUN, IN_SPACES] = False
    return after, starts


AFTER, STARTS = _machine()


@lru_cache(1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE_RUN or OTHER by code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for i in range(0x110000):
        if (k := kinds.get(unicodedata.category(chr(i))[0])) is not None:
            table[i] = k
    for kind, ranges in ((LETTER, LETTERS_OF_16), (NUMBER, NUMBERS_OF_16)):
        for first, last in ranges:
            table[first : last + 1] = kind
    table[WHITE_SPACE] = SPACE_RUN
    return table


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The scanner's symbol of each code point; `ends` are the places of document separators."""
    kind = classes()[points]
    kind[ends] = DOC_END
    n = len(points)
    after = np.full(n + 2, DOC_END, np.uint8)
    after[:n] = kind
    nxt = after[1 : n + 1]
    last = (kind == SPACE_RUN) & (nxt != SPACE_RUN) & (nxt != DOC_END)
    kind[last & (points == 0x20)] = JOINING_SPACE
    kind[last & (points != 0x20)] = LONE_SPACE
    quotes = np.flatnonzero(points == 0x27)
    quotes = quotes[kind[quotes] == OTHER]
    if len(quotes):
        padded = np.append(points, [0, 0])
        padded[ends] = 0
        a, b = padded[quotes + 1], padded[quotes + 2]
        kind[quotes[np.isin(a, [ord(c) for c in "stmd"])]] = CONTRACTION2
        pair = lambda x, y: (a == ord(x)) & (b == ord(y))
        kind[quotes[pair("r", "e") | pair("v", "e") | pair("l", "l")]] = CONTRACTION3
    return kind


def states_before(symbol: np.ndarray, block: int = 256) -> np.ndarray:
    """The scanner's state before each symbol, by an associative scan of transition functions.

    Blocks first advance side by side from all start states, keeping their ends alone; with the state that each block
    is entered in known from the composed functions, they advance once more from that one."""
    n = len(symbol)
    blocks = -(-n // block)
    grid = np.full(blocks * block, DOC_END, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(blocks, block).T)
    flat = AFTER.ravel()
    total = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, 1)
    for row in grid:
        total = flat[(row << 3) + total]
    step = 1
    while step < blocks:  # total[s, b]: the state after all blocks up to b, entered in s
        total[:, step:] = np.take_along_axis(total[:, step:], total[:, :-step], 0)
        step *= 2
    state = np.full(blocks, DONE, np.uint8)
    state[1:] = total[DONE, :-1]
    before = np.empty((block, blocks), np.uint8)
    for k, row in enumerate(grid):
        before[k] = state
        state = flat[(row << 3) + state]
    return before.T.reshape(-1)[:n]


def boundaries(joined: str, ends: np.ndarray) -> np.ndarray:
    """Places where pieces start, and the separators, in order."""
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbol = symbols(points, ends)
    return np.flatnonzero(STARTS[symbol, states_before(symbol)])


NONE = 1 << 60


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of lowest rank, leftmost first, is merged until none is left."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    return merge_long(piece, ranks) if len(piece) > 80 else merge_short(piece, ranks)


def merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    get = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(a + b, NONE) for a, b in zip(parts, parts[1:])]
    while pairs and (least := min(pairs)) < NONE:
        i = pairs.index(least)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], NONE)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
    return [ranks[x] for x in parts]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n steps, by a heap of pairs over a linked list of parts."""
    n = len(piece)
    start, nxt, prev = list(range(n)), [*range(1, n), -1], [-1, *range(n - 1)]
    end = list(range(1, n + 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, upto = heapq.heappop(heap)
        j = nxt[i]
        if gone[i] or j < 0 or end[j] != upto:
            continue
        gone[j], end[i], nxt[i] = 1, end[j], nxt[j]
        if nxt[i] >= 0:
            prev[nxt[i]] = i
            if (r := ranks.get(piece[start[i] : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(piece[start[prev[i]] : end[i]])) is not None:
            heapq.heappush(heap, (r, prev[i], end[i]))
    return [ranks[piece[start[i] : end[i]]] for i in range(n) if not gone[i]]


class Pieces(dict):
    """Cache of merged pieces; emptied when it has `most` entries, so that its memory is bounded."""

    def __init__(self, ranks: dict[bytes, int], most: int = 150_000, longest: int = 64):
        self.ranks, self.most, self.longest = ranks, most, longest

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(merge(piece.encode("utf-8", "surrogatepass"), self.ranks))
        if len(piece) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(4)
def vocabulary(path: str) -> tuple[Pieces, list[bytes], np.ndarray]:
    """Piece cache, bytes by id and their lengths, of a rank file (base64 token and rank a line).

    `path` is a file's path, or the name of a public tokenizer's file, which each worker finds for itself."""
    with open(path if "/" in path else tokenizer_path(path), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    return Pieces(ranks), by_id, np.array([len(x) for x in by_id], np.int64)


def encode_texts(values: list[str], path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts, the first byte of each id's token in its text, and where each text's ids end."""
    cache, _, size = vocabulary(path)
    joined = "\n".join(values) + "\n"
    ends = np.cumsum([len(x) + 1 for x in values]) - 1
    bounds = boundaries(joined, ends)
    cut = bounds.tolist()
    cut.append(len(joined))
    separators = np.searchsorted(bounds, ends)
    ids: list[tuple[int, ...]] = []
    counts, first = [], 0
    for last in separators.tolist():
        of_text = [cache[joined[a:b]] for a, b in zip(cut[first:last], cut[first + 1 : last + 1])]
        counts.append(sum(map(len, of_text)))
        ids += of_text
        first = last + 1
    upto = np.cumsum(counts)
    flat = np.fromiter(chain.from_iterable(ids), np.int32, int(upto[-1]) if len(upto) else 0)
    reach = np.concatenate([[0], np.cumsum(size[flat])])
    begin = np.concatenate([[0], upto[:-1]])
    offsets = reach[:-1] - np.repeat(reach[begin], counts)
    return flat, offsets, upto


def _lists(values: np.ndarray, upto: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), pa.array(values, kind))


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, ids array<int> and offsets array<bigint> (first byte of each token in the UTF-8 text).

    Each piece of the pre-tokenisation is merged by the ranks in the file at `path`; special tokens do not
    exist. One row for each row of `docs`, repeated rows and null ids included; a null or empty text has
    no ids. Any text length: a text is never cut."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, offsets, upto = encode_texts(batch.column("text").to_pylist(), path)
        return [batch.column("doc_id"), _lists(ids, upto, pa.int32()), _lists(offsets, upto, pa.int64())]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(texts(docs, id_col=id_col, text_col=text_col), run, f"doc_id {kind}, ids array<int>, offsets array<bigint>")


def _slices(batch: pa.RecordBatch, lists: pa.ListArray, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `most` list values, one row at least."""
    start = total = 0
    for i, n in enumerate(pc.list_value_length(lists).fill_null(0).to_pylist()):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(lists):
        yield batch.slice(start)


def bpe_decode(encoded: DataFrame, path: str, *keep: str, ids_col: str = "ids", most: int = 200_000) -> DataFrame:
    """The rows of `encoded`, columns `keep`, ids and decoded binary (the tokens' bytes in order; no ids: empty)."""

    def run(batches):
        by_id = vocabulary(path)[1]
        for batch in batches:
            place = batch.schema.get_field_index(ids_col)
            for part in _slices(batch, batch.column(place), most):
                lists = part.column(place).to_pylist()
                decoded = pa.array([b"".join(map(by_id.__getitem__, x or ())) for x in lists], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    rows = encoded.select(*keep, ids_col)
    fields = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in rows.schema)
    return rows.mapInArrow(run, f"{fields}, decoded binary")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, ids and decoded: what `bpe_encode` and then `bpe_decode` give, by one pass through one worker."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, _, upto = encode_texts(batch.column("text").to_pylist(), path)
        by_id = vocabulary(path)[1]
        decoded = [b"".join(map(by_id.__getitem__, x.tolist())) for x in np.split(ids, upto[:-1])]
        return [batch.column("doc_id"), _lists(ids, upto, pa.int32()), pa.array(decoded, pa.binary())]

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(texts(docs, id_col=id_col, text_col=text_col), run, f"doc_id {kind}, ids array<int>, decoded binary")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256 of a round trip."""
    return bpe_round_trip(docs, path, id_col, text_col).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
