"""Text kernels that work on whole Arrow batches.

A class of characters costs the JVM's pattern engine tens of nanoseconds for every character, and a lambda over words
about as much for every word. Here a batch is matched by one automaton, or its bytes are looked at side by side:
words are runs of bytes of a class, and a sought word is looked for where its first letters are. All are
``Column -> Column``; null gives null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tickerloom import lexicon as lx

#: Bytes of text that are taken apart at a time, so that memory doesn't follow the batch.
CHUNK_BYTES = 16 << 20
#: Bytes of text that are cleaned at a time; every piece has the patterns made anew.
CLEAN_CHUNK = 4 << 20
#: Bytes whose classes are looked up at a time, so that they stay near the processor.
BYTES_CHUNK = 2 << 20
#: Code points of the characters met nearly always, and of all.
FIRST_PLANE, ALL_POINTS = 0x10000, 0x110000
#: Bytes of a word that fit a number beside its length.
SHORT_WORD = 7
#: Bytes of a separator behind the last text, so that what starts near its end can be read.
PADDING = 64
#: Words that fit the bits of a long.
MAX_INSIDE = 62
#: Keys of terms that are looked up in a table of all keys (16 MB), not searched.
MAX_TABLE = 4 << 20
_OTHER_BLANKS = lx.BLANKS.replace(r"\x{1C}-\x{20}", r"\x{1C}-\x{1F}")
#: Runs of blanks other than one plain blank, which needs no replacing.
BLANK_RUN = f" [{lx.BLANKS}]+|[{_OTHER_BLANKS}][{lx.BLANKS}]*"


def chunks(array: pa.Array, size: int | None = None) -> Iterator[pa.Array]:
    """Slices of rows of about ``size`` (``CHUNK_BYTES``), at least one slice."""
    size = size or CHUNK_BYTES
    step = max(1, len(array) * size // max(size, array.nbytes)) if len(array) else 1
    for start in range(0, max(1, len(array)), step):
        yield array.slice(start, step)


def made_once(text: Column) -> Column:
    """The text itself. A kernel on another kernel's output would run that one again for itself; an expression between them prevents it."""
    return F.concat(text)


def flags(mask: pa.Array, kind: type = np.int32) -> np.ndarray:
    return mask.to_numpy(zero_copy_only=False).astype(kind)


def laid_out(text: pa.Array, separator: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, first byte of every text and of the padding): the texts, none null, each with a separator in front and the padding behind all."""
    large = pa.large_string()
    ended = pc.binary_join_element_wise(text.cast(large), pa.scalar("", large), pa.scalar(separator, large))
    _, offsets, data = ended.buffers()
    starts = np.frombuffer(offsets, np.int64)[ended.offset:ended.offset + len(ended) + 1]
    held = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if len(ended) else np.empty(0, np.uint8)
    sign = np.frombuffer(separator.encode(), np.uint8)
    return np.concatenate([sign, held, np.repeat(sign, PADDING)]), starts - starts[0] + 1


@cache
def members(pattern: str, size: int = FIRST_PLANE) -> np.ndarray:
    """For every code point below ``size``, whether it is in the class of characters."""
    points = np.delete(np.arange(size, dtype="<u4"), slice(0xD800, 0xE000))
    found = np.zeros(size, bool)
    found[points] = flags(pc.match_substring_regex(pa.array(list(points.tobytes().decode("utf-32-le"))), pattern), bool)
    return found


def looked_up(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The table's byte for every byte."""
    return np.frombuffer(bytearray(data.tobytes().translate(table.tobytes())), np.uint8)


def in_class(data: np.ndarray, pattern: str) -> np.ndarray:
    """For every byte, whether it belongs to a character of the class."""
    table = members(pattern)
    found = looked_up(data, np.concatenate([table[:128], np.zeros(128, bool)])).view(bool)
    heads = np.flatnonzero(data >= 0xC0)
    if len(heads):
        first = data[heads].astype(np.int64)
        more = [(data[heads + i] & 63).astype(np.int64) for i in (1, 2, 3)]
        two, three = (first & 31) << 6 | more[0], (first & 15) << 12 | more[0] << 6 | more[1]
        points = np.where(first < 0xE0, two, np.where(first < 0xF0, three, (first & 7) << 18 | more[0] << 12 | more[1] << 6 | more[2]))
        inside = (table if points.max() < FIRST_PLANE else members(pattern, ALL_POINTS))[points]
        for i, least in enumerate((0xC0, 0xC0, 0xE0, 0xF0)):
            found[heads[inside & (first >= least)] + i] = True
    return found


def runs(found: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, and first of each text and the number of all) of the runs of bytes; separators are in none."""
    edges = np.flatnonzero(found[1:] != found[:-1]) + 1
    begins, ends = edges[::2], edges[1::2]
    return begins, ends, np.searchsorted(begins, starts)


def places_of(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The place of every byte of the pieces."""
    lengths = ends - begins
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(begins - before, lengths)


def cut_out(held: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The bytes as texts of these lengths."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(held)))


#: Letters whose lower case depends on their place or is more than one letter; Arrow maps letters one by one.
SPECIAL_CASES = "[\u0130\u03a3]"


def lower(text: pa.Array) -> pa.Array:
    """Lower case as the JVM has it: a capital sigma at the end of a word and a dotted capital i included."""
    special = pc.fill_null(pc.match_substring_regex(text, SPECIAL_CASES), False)
    lowered = pc.utf8_lower(text)
    if not pc.any(special).as_py():
        return lowered
    return pc.replace_with_mask(lowered, special, pa.array([t.lower() for t in text.filter(special).to_pylist()], text.type))


@cache
def _cleaned():
    @F.arrow_udf("string")
    def cleaned(text: pa.Array, links: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c, links[0].as_py()) if len(c) else c for c in chunks(text, CLEAN_CHUNK)])

    def part(text: pa.Array, links: str) -> pa.Array:
        text = pc.replace_substring_regex(text, links, "")
        text = pc.replace_substring_regex(text, f"@{lx.WORD}+", "")
        text = pc.replace_substring_regex(text, f"#({lx.WORD}+)", r"\1")
        text = pc.replace_substring_regex(text, BLANK_RUN, " ")
        return lower(pc.utf8_trim(text, " "))

    return cleaned


def cleaned(text: Column, links: str = lx.URL_PATTERN) -> Column:
    """Without links and mentions, hashtags unwrapped, each run of blanks one blank, trimmed, in lower case."""
    return _cleaned()(text, F.lit(links))


@cache
def _single_blanks():
    @F.arrow_udf("string")
    def single_blanks(text: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(text, BLANK_RUN, " ")

    return single_blanks


def single_blanks(text: Column) -> Column:
    """Each run of blanks as one blank."""
    return _single_blanks()(text)


def numbered(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every piece of the bytes, the same for equal ones only: length and bytes of a short one, or else its place among the distinct ones."""
    lengths = ends - begins
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    masks = np.array([(1 << 8 * n) - 1 for n in range(SHORT_WORD + 1)], np.uint64)
    short = np.minimum(lengths, SHORT_WORD + 1)
    numbers = eights[begins] & masks[np.minimum(short, SHORT_WORD)] | short.astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(lengths > SHORT_WORD)
    if len(long):
        coded = cut_out(data[places_of(begins[long], ends[long])], lengths[long]).dictionary_encode()
        numbers[long] = coded.indices.to_numpy().astype(np.uint64) | np.uint64(SHORT_WORD + 1) << np.uint64(56)
    return numbers


@cache
def _variety():
    @F.arrow_udf("struct<words int, different int>")
    def variety(text: pa.Array) -> pa.Array:
        kind = pa.struct([("words", pa.int32()), ("different", pa.int32())])
        return pa.concat_arrays([part(c) if len(c) else pa.array([], kind) for c in chunks(text, BYTES_CHUNK)])

    def part(text: pa.Array) -> pa.Array:
        data, starts = laid_out(pc.fill_null(text, ""), " ")
        begins, ends, firsts = runs(in_class(data, f"[^{lx.BLANKS}]"), starts)
        words = numbered(data, begins, ends)
        different = np.zeros(len(text), np.int32)
        for i, (start, end) in enumerate(zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True)):
            if start < end:
                own = words[start:end]
                own.sort()
                different[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
        columns = [np.diff(firsts).astype(np.int32), different]
        return pa.StructArray.from_arrays([pa.array(x) for x in columns], ["words", "different"], mask=pc.is_null(text))

    return variety


def variety(text: Column) -> Column:
    """How many blank-separated ``words`` a text has and how many ``different`` ones."""
    return _variety()(text)


@cache
def _tagged(sign: str):
    @F.arrow_udf("array<string>")
    def tagged(text: pa.Array) -> pa.Array:
        lists = pc.split_pattern(pc.fill_null(text, ""), sign)
        starts = np.asarray(lists.offsets).astype(np.int64)
        starts -= starts[0]
        behind = np.ones(starts[-1], bool)
        behind[starts[:-1]] = False
        rows = np.repeat(np.arange(len(text)), np.diff(starts))[behind]
        tags = pc.extract_regex(lists.flatten().filter(pa.array(behind)), f"^(?P<tag>{lx.WORD}*)").field("tag")
        found = flags(pc.not_equal(tags, ""), bool)
        ends = np.cumsum(np.bincount(rows[found], minlength=len(text))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), tags.filter(pa.array(found)), mask=pc.is_null(text))

    return tagged


def tagged(text: Column, sign: str) -> Column:
    """The words that follow a sign directly, in order; a word ends before the next sign, which is no word character."""
    return _tagged(sign)(text)


def _seeker(sought: list[str]) -> Callable[[np.ndarray], dict[str, np.ndarray]]:
    """A function of bytes: where each of the sought words, of at least two bytes each, starts; ``among`` these places, if given."""
    pairs = {pair: i for i, pair in enumerate(dict.fromkeys(w.encode()[:2] for w in sought))}
    pair_of = np.full(1 << 16, len(pairs), np.min_scalar_type(len(pairs)))
    third = np.zeros((len(pairs), 256), bool)
    for pair, i in pairs.items():
        pair_of[pair[0] | pair[1] << 8] = i
    for word in map(str.encode, sought):
        third[pairs[word[:2]], slice(None) if len(word) == 2 else word[2]] = True

    def places(data: np.ndarray, among: np.ndarray | None = None) -> dict[str, np.ndarray]:
        if among is None:
            pair = pair_of[data[:-PADDING].astype(np.uint16) | data[1:1 - PADDING].astype(np.uint16) << np.uint16(8)]
            at = np.flatnonzero(pair != len(pairs))
            kinds = pair[at]
        else:
            pair = pair_of[data[among].astype(np.uint16) | data[among + 1].astype(np.uint16) << np.uint16(8)]
            possible = pair != len(pairs)
            at, kinds = among[possible], pair[possible]
        possible = third[kinds, data[at + 2]]
        at, kinds = at[possible], kinds[possible]
        order = np.argsort(kinds, kind="stable")
        at, bounds = at[order], np.searchsorted(kinds[order], np.arange(len(pairs) + 1))
        found = {}
        for word in sought:
            letters = word.encode()
            kind = pairs[letters[:2]]
            own = at[bounds[kind]:bounds[kind + 1]]
            for i, letter in enumerate(letters[2:], 2):
                own = own[data[own + i] == letter]
            found[word] = own
        return found

    return places


@cache
def _marks(counted: tuple[tuple[str, ...], ...], inside: tuple[str, ...], phrases: tuple[tuple[str, ...], ...]):
    names = ["words", *[f"count{i}" for i in range(len(counted))], *[f"phrases{i}" for i in range(len(phrases))], "inside"]
    kind = pa.struct([*[(n, pa.int32()) for n in names[:-1]], ("inside", pa.int64())])
    flat = [p for group in phrases for p in group]
    sought = sorted({*inside, *flat, *[t for terms in counted for t in terms if " " not in t]})
    places = _seeker(sought)

    def bounded(data: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
        """Whether no word character is in front of or behind a piece."""
        table = members(lx.WORD)
        word = np.concatenate([table[:128], np.zeros(128, bool)])
        before, behind = data[begins - 1], data[begins + length]
        free = ~word[before] & ~word[behind]
        for i in np.flatnonzero(free & ((before >= 128) | (behind >= 128))):
            start, end = begins[i], begins[i] + length
            near = data[max(0, start - 4):start].tobytes().decode(errors="ignore")[-1:] + data[end:end + 4].tobytes().decode(errors="ignore")[:1]
            free[i] = not any(members(lx.WORD, FIRST_PLANE if ord(x) < FIRST_PLANE else ALL_POINTS)[ord(x)] for x in near)
        return free

    def part(text: pa.Array) -> pa.Array:
        data, starts = laid_out(pc.fill_null(text, ""), " ")
        size = len(text)
        words = np.add.reduceat(data[:-PADDING] == 32, starts[:-1], dtype=np.int32)
        found = places(data)
        rows = {word: np.searchsorted(starts, begins, "right") - 1 for word, begins in found.items()}
        per_text = lambda begins: np.bincount(begins, minlength=size).astype(np.int32)
        columns = [np.where(np.diff(starts) == 1, 0, words).astype(np.int32)]
        for terms in counted:
            uses = np.zeros(size, np.int32)
            for term in {t for t in terms if " " not in t}:
                begins = found[term]
                whole = (data[begins - 1] == 32) & (data[begins + len(term.encode())] == 32)
                uses += per_text(rows[term][whole])
            columns.append(uses)
        for group in phrases:
            uses = np.zeros(size, np.int32)
            for phrase in set(group):
                begins, own = found[phrase], rows[phrase]
                within = begins + len(phrase) < starts[own + 1]
                within[within] = bounded(data, begins[within], len(phrase))
                uses += per_text(own[within])
            columns.append(uses)
        held = np.zeros(size, np.int64)
        for bit, word in enumerate(inside):
            held[rows[word]] |= 1 << bit
        columns.append(held)
        return pa.StructArray.from_arrays([pa.array(x) for x in columns], names, mask=pc.is_null(text))

    @F.arrow_udf(f"struct<{', '.join(f'{n} int' for n in names[:-1])}, inside bigint>")
    def marks(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c) if len(c) else pa.array([], kind) for c in chunks(text, BYTES_CHUNK)])

    return marks


def marks(cleaned: Column, counted: list[list[str]], inside: list[str], phrases: list[list[str]]) -> Column:
    """What a single-spaced text holds, as a struct.

    ``words``, how many; ``count0`` and so on, how many of them are in each of the lists ``counted``; ``phrases0`` and
    so on, how often the phrases of each group occur as whole words; ``inside``, a bit for each of the words that
    occurs anywhere in the text, in a word or as one. These and the phrases' words are lower-case ASCII letters, so
    one is in a text if it is in one of its tokens. A group's phrases all have one word or all have two, and no last
    word is another's first, so that two finds never overlap.
    """
    words = [*inside, *[w for group in phrases for p in group for w in p.split(" ")]]
    if not all(w.isascii() and w.isalpha() for w in words) or len(inside) > MAX_INSIDE:
        raise ValueError(f"at most {MAX_INSIDE} words, and of ASCII letters only")
    if any(len(w.encode()) < 2 for w in [*words, *[t for terms in counted for t in terms]]):
        raise ValueError("words of at least two letters")
    for group in phrases:
        parts = [p.split(" ") for p in group]
        if {len(p) for p in parts} not in ({1}, {2}) or (len(parts[0]) == 2 and {p[0] for p in parts} & {p[1] for p in parts}):
            raise ValueError(f"phrases of one word or of two that can't overlap, not {group}")
    return _marks(tuple(map(tuple, counted)), tuple(inside), tuple(map(tuple, phrases)))(made_once(cleaned))


@cache
def _words_held(words: tuple[str, ...]):
    places = _seeker(list(words))

    def part(text: pa.Array) -> pa.Array:
        data, starts = laid_out(pc.fill_null(text, ""), " ")
        held = np.zeros((len(text), len(words)), bool)
        firsts = np.flatnonzero(data[:-PADDING] == 32) + 1
        for i, begins in enumerate(places(data, firsts).values()):
            whole = begins[data[begins + len(words[i])] == 32]
            held[np.searchsorted(starts, whole, "right") - 1, i] = True
        ends = np.concatenate([[0], np.cumsum(held.sum(axis=1))]).astype(np.int32)
        found = pa.array(words, pa.string()).take(pa.array(np.nonzero(held)[1]))
        return pa.ListArray.from_arrays(pa.array(ends), found, mask=pc.is_null(text))

    @F.arrow_udf("array<string>")
    def words_held(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c) if len(c) else pa.array([], pa.list_(pa.string())) for c in chunks(text, BYTES_CHUNK)])

    return words_held


def words_held(cleaned: Column, words: list[str]) -> Column:
    """Which of the words, of two or more ASCII letters each, are among the words of a single-spaced text, in alphabetical order.

    On a cleaning alone the text goes to Python once and only the words come back, so this is for those who don't need the text itself.
    """
    if not all(w.isascii() and w.isalpha() and len(w) > 1 for w in words):
        raise ValueError("words of at least two letters, and of ASCII letters only")
    return _words_held(tuple(sorted(set(words))))(cleaned)


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[ord("A"):ord("Z") + 1] += 32
NOT_PLAIN = ((ASCII_LOWER == ord("_")) | (ASCII_LOWER >= 128)).view(np.uint8)
LETTERS = (ASCII_LOWER >= ord("a")) & (ASCII_LOWER <= ord("z"))


@cache
def _feature_words(stop_words: tuple[str, ...]):
    kind = pa.struct([("length", pa.int32()), ("words", pa.int32()), ("singles", pa.list_(pa.string()))])

    def part(text: pa.Array) -> pa.Array:
        missing = pc.is_null(text)
        # The one other letter with a lower case in ASCII.
        data, starts = laid_out(pc.replace_substring(pc.fill_null(text, ""), "\u212a", "k"), " ")
        found = in_class(data, lx.WORD)
        begins, ends, firsts = runs(found, starts)
        plain = LETTERS[data[begins]]
        if len(begins):
            plain &= np.bitwise_or.reduceat(looked_up(data, NOT_PLAIN) & found.view(np.uint8), begins) == 0
        found[places_of(begins[~plain], ends[~plain])] = False
        kept = cut_out(looked_up(data[found], ASCII_LOWER), (ends - begins)[plain])
        useful = ~flags(pc.is_in(kept, pa.array(stop_words, pa.string())), bool)
        chosen = plain.copy()
        chosen[plain] = useful
        singles_ends = np.concatenate([[0], np.cumsum(chosen)]).astype(np.int32)[firsts]
        singles = pa.ListArray.from_arrays(pa.array(singles_ends), kept.filter(pa.array(useful)))
        return pa.StructArray.from_arrays([pc.utf8_length(text), pa.array(np.diff(firsts).astype(np.int32)), singles], fields=list(kind), mask=missing)

    @F.arrow_udf("struct<length int, words int, singles array<string>>")
    def feature_words(text: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c) if len(c) else pa.array([], kind) for c in chunks(text, BYTES_CHUNK)])

    return feature_words


def feature_words(cleaned: Column, stop_words: list[str]) -> Column:
    """Of a text's second cleaning: how many ``words`` it has, and its ``singles``, those ASCII words that start with
    a letter and are no stop words, in order; and the ``length`` of the text itself, so that who asks for no more need not have the text back."""
    return _feature_words(tuple(stop_words))(cleaned)


def entry_counts(lists: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, corpus_count, doc_count) of each chunk of lists of terms; nulls don't count.

    The rows with a second column that is true are counted under the empty term.
    """
    counted = 0

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal counted
        for batch in batches:
            if batch.num_columns > 1:
                counted += pc.sum(batch.column(1)).as_py() or 0
            yield batch

    for rows, distinct, codes in _entries(flagged(lists)):
        yield _counted(distinct, rows, codes)
    if counted:
        yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([counted]), pa.array([counted])], ["term", "corpus_count", "doc_count"])


def pair_counts(known: list[str] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """As ``entry_counts``, of the neighbours in each list, where both are among the known words (all, if None)."""

    def count(lists: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None if known is None else pa.array(known, pa.string())
        for rows, distinct, codes in _entries(lists, words):
            met = (rows[:-1] == rows[1:]) & (codes[:-1] >= 0) & (codes[1:] >= 0)
            texts = int(rows[-1]) + 1 if len(rows) else 1
            each = (codes[:-1][met] * len(distinct) + codes[1:][met]) * texts + rows[:-1][met]
            each.sort()
            pairs = each // texts
            first = np.flatnonzero(np.diff(pairs, prepend=-1))
            new = np.diff(each, prepend=-1) != 0
            uses = np.diff(first, append=len(pairs))
            texts_with = np.add.reduceat(new, first, dtype=np.int64) if len(first) else uses
            one, other = np.divmod(pairs[first], max(1, len(distinct)))
            terms = pc.binary_join_element_wise(distinct.take(pa.array(one)), distinct.take(pa.array(other)), " ")
            yield pa.RecordBatch.from_arrays([terms, pa.array(uses), pa.array(texts_with)], ["term", "corpus_count", "doc_count"])

    return count


def _entries(lists: Iterator[pa.RecordBatch], known: pa.Array | None = None) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(row of every entry, distinct entries, number of each entry's distinct one) of each chunk of the first column;
    of the known entries, if given, with -1 as the number of others."""
    for batch in lists:
        for part in chunks(batch.column(0)):
            rows = np.repeat(np.arange(len(part), dtype=np.int64), flags(pc.fill_null(pc.list_value_length(part), 0)))
            values = part.flatten()
            present = flags(pc.is_valid(values), bool)
            values = values.filter(pa.array(present))
            if known is not None:
                yield rows[present], known, pc.fill_null(pc.index_in(values, known), -1).to_numpy().astype(np.int64)
                continue
            coded = values.dictionary_encode()
            yield rows[present], coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _counted(terms: pa.Array, rows: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    each = rows * len(terms) + codes
    each.sort()
    each = each[np.diff(each, prepend=-1) != 0] % max(1, len(terms))
    counts = [pa.array(np.bincount(x, minlength=len(terms)).astype(np.int64)) for x in (codes, each)]
    return pa.RecordBatch.from_arrays([terms, *counts], ["term", "corpus_count", "doc_count"])


def cloud_counts(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, uses) of each chunk of texts: words of word characters and, but for the first one, apostrophes."""
    for batch in texts:
        for part in chunks(batch.column(0)):
            coded = pa.chunked_array([_cloud_words(c) for c in chunks(pc.fill_null(part, ""), BYTES_CHUNK)]).combine_chunks().dictionary_encode()
            uses = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(uses)], ["word", "uses"])


def _cloud_words(text: pa.Array) -> pa.Array:
    data, starts = laid_out(text, " ")
    found = in_class(data, f"[{lx.WORD_CHARACTERS}']")
    while True:
        begins, ends, _ = runs(found, starts)
        quoted = begins[data[begins] == ord("'")]
        if not len(quoted):
            return cut_out(data[found], ends - begins)
        found[quoted] = False


def _finder(terms: tuple[str, ...], paired: bool) -> Callable[[pa.Array], np.ndarray]:
    """A function of lists: row of the list times the number of terms, plus the term's place, of every use of a term, in order."""
    size = len(terms)
    split = [t.split(" ") for t in terms]
    words = list(dict.fromkeys(w for t in split for w in t)) if paired else list(terms)
    place = {w: i for i, w in enumerate(words)}
    # A single word's place, or that of two words, of a term; sorted for the search.
    keys = np.array([place[t[0]] if len(t) == 1 else (place[t[0]] + 1) * len(words) + place[t[1]] for t in split] if paired else range(size), np.int64)
    order = np.argsort(keys)
    keys = keys[order]
    reach = len(words) * (len(words) + 1) if paired else len(words)
    in_table, tables = reach <= MAX_TABLE, []

    def terms_at(found: np.ndarray) -> np.ndarray:
        """The place of each key's term, or -1."""
        if in_table:
            # Made where it is used, so that it is not sent along.
            if not tables:
                tables.append(np.full(reach, -1, np.int32))
                tables[0][keys] = order
            return tables[0][found]
        at = np.minimum(np.searchsorted(keys, found), size - 1)
        return np.where(keys[at] == found, order[at], -1)

    def find(lists: pa.Array) -> np.ndarray:
        counts = flags(pc.fill_null(pc.list_value_length(lists), 0))
        rows = np.repeat(np.arange(len(lists), dtype=np.int64), counts)
        codes = pc.fill_null(pc.index_in(lists.flatten(), pa.array(words, pa.string())), -1).to_numpy().astype(np.int64)
        known = codes >= 0
        found, of = codes[known], rows[known]
        if paired:
            met = (rows[:-1] == rows[1:]) & known[:-1] & known[1:]
            found = np.concatenate([found, (codes[:-1][met] + 1) * len(words) + codes[1:][met]])
            of = np.concatenate([of, rows[:-1][met]])
        at = terms_at(found)
        hit = at >= 0
        each = of[hit] * size + at[hit]
        each.sort()
        return each

    return find


@cache
def _weighed(terms: tuple[str, ...], weights: tuple[float, ...], paired: bool):
    from pyspark.ml.linalg import VectorUDT

    size, scale, find = len(terms), np.array(weights), _finder(terms, paired)

    def part(lists: pa.Array) -> pa.Array:
        each = find(lists)
        first = np.flatnonzero(np.diff(each, prepend=-1))
        row, term = np.divmod(each[first], max(1, size))
        values = np.diff(first, append=len(each)) * scale[term]
        lengths = np.sqrt(np.bincount(row, values * values, len(lists)))
        stored = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
        with np.errstate(divide="ignore", invalid="ignore"):
            values = np.where(lengths[row] > 0, values / lengths[row], values)
        return pa.StructArray.from_arrays([
            pa.array(np.zeros(len(lists), np.int8)),
            pa.array(np.full(len(lists), size, np.int32)),
            pa.ListArray.from_arrays(pa.array(stored), pa.array(term.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(stored), pa.array(values)),
        ], ["type", "size", "indices", "values"])

    @F.arrow_udf(VectorUDT())
    def weighed(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c) for c in chunks(lists)])

    return weighed


def weighed(lists: Column, terms: list[str], weights: list[float], paired: bool) -> Column:
    """Sparse vector of length 1 (or 0) of each list: how often each of the terms is in it, times the term's weight.

    With ``paired``, the lists hold single words, and their neighbours count as terms of two words; terms then
    have one word or two. A null list has no terms.
    """
    return _weighed(tuple(terms), tuple(weights), paired)(lists)


@cache
def _matched(terms: tuple[str, ...], paired: bool):
    size, find = len(terms), _finder(terms, paired)
    longs = longs_of(size)

    def part(lists: pa.Array) -> pa.Array:
        each = find(lists)
        row, term = np.divmod(each, max(1, size))
        stored = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
        new = np.diff(each, prepend=-1) != 0
        target = row[new] * longs + term[new] // MAX_INSIDE
        first = np.flatnonzero(np.diff(target, prepend=-1))
        held = np.zeros(len(lists) * longs, np.int64)
        if len(first):
            held[target[first]] = np.add.reduceat(1 << term[new] % MAX_INSIDE, first)
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(pa.array(stored), pa.array(terms, pa.string()).take(pa.array(term))),
            pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * longs), pa.array(held)),
        ], ["terms", "held"])

    @F.arrow_udf("struct<terms array<string>, held array<bigint>>")
    def matched(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(c) for c in chunks(lists)])

    return matched


def longs_of(size: int) -> int:
    """How many numbers hold a bit for each of so many terms."""
    return -(-size // MAX_INSIDE)


def matched(lists: Column, terms: list[str], paired: bool) -> Column:
    """Of each list: ``terms``, those in it that are among the distinct ``terms``, as often as they are in it, in the
    order of ``terms``; and ``held``, ``longs_of`` numbers with bit i % ``MAX_INSIDE`` of number i // ``MAX_INSIDE`` set if term i is in it.

    ``paired`` is as in ``weighed``.
    """
    return _matched(tuple(terms), paired)(lists)
