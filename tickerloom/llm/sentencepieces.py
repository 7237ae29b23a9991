"""SentencePiece encoding with seeded merge-dropout, and decoding.

Texts are cut before each run of spaces; no piece of the vocabulary reaches over such a cut, so
chunks are encoded on their own. In a chunk, an agenda holds the candidate merges of neighbours, best
score first, then leftmost. With dropout, a candidate at the head of the agenda is skipped when a hash of the seed, the document's
id, the chunk's number, the place in it and the piece falls below the rate. A merge that was skipped stays skipped unless a
neighbour changes. The choice depends on nothing but these, so reruns and lost executors give the same ids, while
each occurrence of a word is cut up in its own way.

The agendas of many short chunks are worked off side by side in numpy, one merge per chunk and round; a
long chunk has a heap of its own. Both make the same merges.

Decoding is lossless for every text: characters without a piece, and the sign that pieces use for
a space, go through byte pieces.

Defined cases: null and empty texts have no ids and decode to the empty text (a null text counts as not encoded: ids null);
very long texts and chunks are encoded whole (the agenda is a heap); documents without an id are dealt like the id '';
repeated rows get the same ids; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
SPACE = "▁"
#: Chunks of more characters have a heap of their own.
LONG_CHUNK = 200
#: Characters that are cut up together.
GROUP_CHARS = 150_000
MASK = 0xFFFFFFFF

RESULTS = "ids array<int>, n_ids int"


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, the ranks of those that merges may make, their ids by rank, and the ids of the 256 byte pieces."""

    pieces: list[bytes]
    ranks: dict[str, int]
    ids: list[int]
    byte_ids: list[int]
    pair_keys: np.ndarray
    pair_ranks: np.ndarray

    @cached_property
    def symbols(self) -> np.ndarray:
        """The symbol of every code point."""
        out = np.arange(RAW, RAW + 0x110000)
        for name, rank in self.ranks.items():
            if len(name) == 1:
                out[ord(name)] = rank
        return out


#: Symbols in number form: a piece's rank, or this plus the code point of a character without a piece.
RAW = 1 << 21
WIDTH = 1 << 22
NONE = 1 << 30


def pair_table(ranks: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """A hash table (open addressing) from two neighbouring pieces to the rank of the piece they make."""
    pairs = {}
    for name, rank in ranks.items():
        for cut in range(1, len(name)):
            left, right = ranks.get(name[:cut], _raw(name[:cut])), ranks.get(name[cut:], _raw(name[cut:]))
            if left is not None and right is not None:
                pairs[left * WIDTH + right] = rank
    bits = max(4, (4 * len(pairs)).bit_length())
    keys, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
    for key, rank in pairs.items():
        at = (key * 0x9E3779B97F4A7C15 & 2**64 - 1) >> 64 - bits
        while keys[at] >= 0:
            at = at + 1 & (1 << bits) - 1
        keys[at], values[at] = key, rank
    return keys, values


def _raw(name: str) -> int | None:
    return RAW + ord(name) if len(name) == 1 else None


def look_up_pairs(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = len(table).bit_length() - 1
    at = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    found = table[at]
    out = np.where(found == keys, values[at], NONE)
    open_ = np.flatnonzero((found != keys) & (found >= 0))
    while len(open_):
        at[open_] = at[open_] + 1 & len(table) - 1
        found = table[at[open_]]
        hit = found == keys[open_]
        out[open_[hit]] = values[at[open_[hit]]]
        open_ = open_[~hit & (found >= 0)]
    return out


def encode_many(sym: np.ndarray, size: np.ndarray, keys: np.ndarray, vocabulary: Vocabulary, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Work off the agendas of all chunks side by side; ``sym`` has their symbols, ``size`` how many each has.

    Returns the chunks as they ended, the number of symbols of each, and the symbols. A symbol's
    rank is the one of the candidate made of it and its right neighbour; after a merge only two are looked up again.
    """
    live = np.arange(len(size))
    starts = np.cumsum(size) - size
    place = np.arange(len(sym)) - np.repeat(starts, size)
    owner = np.repeat(live, size)

    def ranked(left: np.ndarray) -> np.ndarray:
        """Ranks of the candidates at these places, of which each has a right neighbour in its chunk."""
        rank = look_up_pairs(vocabulary.pair_keys, vocabulary.pair_ranks, sym[left] * WIDTH + sym[left + 1]).astype(np.int64)
        if limit:
            some = np.flatnonzero(rank < NONE)
            drop = keyed_many(keys[owner[left[some]]], place[left[some]], rank[some]) < limit
            rank[some[drop]] = NONE
        return rank

    rank = np.full(len(sym), NONE, np.int64)
    inner = np.ones(len(sym), bool)
    inner[starts + size - 1] = False
    inner = np.flatnonzero(inner)
    rank[inner] = ranked(inner)
    ends: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(live):
        starts = np.cumsum(size) - size
        best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), starts)
        going = best >> 32 < NONE
        if not going.all():
            ends.append((live[~going], size[~going], sym[np.repeat(~going, size)]))
        at = best[going] & MASK
        sym[at] = best[going] >> 32
        keep = np.repeat(going, size)
        keep[at + 1] = False
        moved = np.cumsum(keep)[at] - 1
        sym, place, owner, rank = sym[keep], place[keep], owner[keep], rank[keep]
        live, size = live[going], size[going] - 1
        starts = np.cumsum(size) - size
        rank[moved] = NONE
        right = moved[moved < starts + size - 1]
        left = moved[moved > starts] - 1
        rank[right] = ranked(right)
        rank[left] = ranked(left)
    return tuple(np.concatenate([e[i] for e in ends]) if ends else np.zeros(0, np.int64) for i in range(3))


def keyed_many(key: np.ndarray, place: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``keyed`` for arrays."""
    mask = np.uint64(MASK)
    h = (key ^ place.astype(np.uint64) * np.uint64(0x9E3779B1) ^ rank.astype(np.uint64) * np.uint64(0x85EBCA6B)) & mask
    h = (h ^ h >> np.uint64(16)) * np.uint64(0x7FEB352D) & mask
    h = (h ^ h >> np.uint64(15)) * np.uint64(0x846CA68B) & mask
    return h ^ h >> np.uint64(16)


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read a model file on the driver; it has some tens of thousands of pieces, whatever the corpus."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    byte_ids = [0] * 256
    plain, pieces = [], []
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            pieces.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            pieces.append(name.replace(SPACE, " ").encode())
            if SPACE in name.lstrip(SPACE):
                raise ValueError(f"piece {name!r} reaches over a space")
            plain.append((-model.get_score(i), i, name.replace(SPACE, " ")))
    plain.sort()
    ranks = {name: r for r, (_, _, name) in enumerate(plain)}
    return Vocabulary(pieces, ranks, [i for _, i, _ in plain], byte_ids, *pair_table(ranks))


def keyed(key: int, place: int, rank: int) -> int:
    """32 well-mixed bits of the key, the place and the piece."""
    h = (key ^ place * 0x9E3779B1 ^ rank * 0x85EBCA6B) & MASK
    h = (h ^ h >> 16) * 0x7FEB352D & MASK
    h = (h ^ h >> 15) * 0x846CA68B & MASK
    return h ^ h >> 16


def encode_chunk(chunk: str, ranks: dict[str, int], key: int, limit: int) -> list[str]:
    """The chunk's pieces. A candidate merge is skipped if its keyed hash is below ``limit``."""
    parts = list(chunk)
    n = len(parts)
    if n < 2:
        return parts
    get = ranks.get
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    agenda = [(rank, i, 2) for i, rank in enumerate(map(get, map(str.__add__, parts, parts[1:]))) if rank is not None]
    heapify(agenda)
    while agenda:
        rank, left, size = heappop(agenda)
        a = parts[left]
        right = after[left]
        if not a or right >= n or len(a) + len(parts[right]) != size:
            continue
        if limit and keyed(key, left, rank) < limit:
            continue
        merged = parts[left] = a + parts[right]
        parts[right] = ""
        follow = after[left] = after[right]
        if follow < n:
            before[follow] = left
            other = get(merged + parts[follow])
            if other is not None:
                heappush(agenda, (other, left, size + len(parts[follow])))
        lead = before[left]
        if lead >= 0:
            other = get(parts[lead] + merged)
            if other is not None:
                heappush(agenda, (other, lead, size + len(parts[lead])))
    return [p for p in parts if p]


def encode_chunk_ids(symbols: np.ndarray, vocabulary: Vocabulary, key: int, limit: int) -> np.ndarray:
    """A long chunk by itself, by way of the heap."""
    text = symbols.astype(np.uint32).tobytes().decode("utf-32-le")
    return np.array([vocabulary.ranks.get(p, RAW + ord(p[0])) for p in encode_chunk(text, vocabulary.ranks, key, limit)], np.int64)


def encode(texts: Sequence[str], doc_keys: Sequence[int], vocabulary: Vocabulary, limit: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and how many each has. Keys are below 2^32."""
    lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
    code = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"), np.uint32).astype(np.int64)
    counts = np.zeros(len(texts), np.int64)
    if not len(code):
        return np.zeros(0, np.int32), counts
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    fresh = np.zeros(len(code), bool)
    fresh[1:] = (code[1:] == 32) & (code[:-1] != 32)
    fresh[starts] = True
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, len(code)))
    doc = np.searchsorted(starts, begin, "right") - 1
    nth = np.arange(len(begin)) - np.searchsorted(begin, starts)[doc]
    own = np.array(doc_keys, np.int64)[lengths > 0][doc]
    keys = keyed_many(own.astype(np.uint64), nth, own)
    sym = vocabulary.symbols[code]
    long = size > LONG_CHUNK
    short = np.repeat(~long, size)
    number = np.flatnonzero(~long)
    owners, sizes, syms = encode_many(sym[short], size[~long], keys[~long], vocabulary, limit)
    owners = number[owners] if len(number) else owners
    for chunk in np.flatnonzero(long).tolist():
        made = encode_chunk_ids(code[begin[chunk]:begin[chunk] + size[chunk]], vocabulary, int(keys[chunk]), limit)
        owners, sizes, syms = np.append(owners, chunk), np.append(sizes, len(made)), np.append(syms, made)
    # back into the order of the text
    first = np.cumsum(sizes) - sizes
    order = np.argsort(owners, kind="stable")
    sizes, first = sizes[order], first[order]
    syms = syms[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(syms))]
    # characters without a piece become bytes
    ids = np.array(vocabulary.ids, np.int32)
    raw = syms >= RAW
    out = ids[np.where(raw, 0, syms)]
    wide = np.ones(len(syms), np.int64)
    if raw.any():
        kinds, back = np.unique(syms[raw] - RAW, return_inverse=True)
        spelled = [[vocabulary.byte_ids[b] for b in chr(c).encode()] for c in kinds.tolist()]
        wide[raw] = np.array([len(x) for x in spelled])[back]
        out = np.repeat(out, wide)
        at = np.repeat(np.cumsum(wide)[raw] - wide[raw], wide[raw])
        nth = np.arange(len(at)) - np.repeat(np.cumsum(wide[raw]) - wide[raw], wide[raw])
        table = np.array([x + [0] * (4 - len(x)) for x in spelled], np.int32)
        out[at + nth] = table[np.repeat(back, wide[raw]), nth]
    per_chunk = np.add.reduceat(wide, np.cumsum(sizes) - sizes)
    counts[lengths > 0] = np.bincount(doc, weights=per_chunk, minlength=len(starts)).astype(np.int64)
    return out, counts


def decode(ids: Sequence[int], pieces: list[bytes]) -> str:
    """The text of ids: the pieces' bytes without the space that encoding puts in front."""
    raw = b"".join(map(pieces.__getitem__, ids))
    return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def groups(texts: Sequence[str]) -> list[slice]:
    """Runs of texts of about GROUP_CHARS characters; a longer text is a group of its own."""
    out, first, size = [], 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > GROUP_CHARS:
            out.append(slice(first, i))
            first, size = i, 0
        size += len(text)
    return [*out, slice(first, len(texts))]


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, carry: Sequence[str] = ("doc_id",), dropout: float = DROPOUT, seed: int = SEED, verify: bool = False
) -> DataFrame:
    """Ids of every whole text, in one pass without a shuffle; with ``verify`` also whether decoding gives the text back."""

    limit, salt = int(dropout * 2**32), zlib.crc32(str(seed).encode())

    def make():
        def work(doc_ids: pa.Array, texts: pa.Array):
            whole = [t or "" for t in texts.to_pylist()]
            keys = [zlib.crc32(i or b"", salt) for i in doc_ids.to_pylist()]
            made = [encode(whole[some], keys[some], vocabulary, limit) for some in groups(whole)]
            flat, counts = (np.concatenate([m[i] for m in made]) for i in (0, 1))
            nulls = texts.is_null()
            ends = np.cumsum(counts)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            cols = [pa.ListArray.from_arrays(offsets, pa.array(flat), mask=nulls), pa.array(counts.astype(np.int32))]
            if verify:
                same = [decode(flat[e - n:e].tolist(), vocabulary.pieces) == t for e, n, t in zip(ends.tolist(), counts.tolist(), whole)]
                cols.append(pc.and_(pa.array(same, pa.bool_()), pc.invert(nulls)))
            return cols

        return work

    results = RESULTS + (", lossless boolean" if verify else "")
    return map_columns(docs, [F.col("doc_id").cast("string").cast("binary"), F.col("text")], results, make, carry)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The texts of ``ids``; null ids give null."""

    def make():
        def work(ids: pa.Array):
            return [pa.array([None if x is None else decode(x, vocabulary.pieces) for x in ids.to_pylist()], pa.string())]

        return work

    return map_columns(encoded, [F.col("ids")], "text string", make, carry)
