"""Near-duplicate detection with fast similarity sketching.

1. A document's set of word shingles (as 64-bit hashes) is sketched: in round i every element is placed
   in a hashed bin with a value that starts with i, and each bin keeps its least value; after as many rounds as bins, a round
   fills one given bin. So every coordinate is filled, as if all had been hashed separately,
   after few rounds (Dahlgaard, Knudsen and Thorup, FOCS 2017).
2. Equal sets are one class from here on, under their smallest doc_id.
3. ``BANDS`` bands of ``ROWS`` coordinates make buckets. Two sets at similarity 0.8 share none of them
   with probability (1 - 0.8^5)^32, about 3 in a million, and at 0.85 with less than one in a hundred million.
4. A bucket's members are compared with one member drawn as its centre (another in each band), so that pairs grow as the rows, not
   with the square of a bucket. Links are confirmed on the full sets and joined to components.
5. Buckets with members of one component only are settled. In the others every pair from different components is still open.
   First all are compared with the member that has most in common with other components, for as long as that links any; then
   prefixes of the full sets, an exact bound, list the pairs that can still be links, and these are confirmed or ruled out. So no
   link is lost, though few pairs are listed.

Full sets are made again from the texts of those documents that share a bucket; only these texts are shuffled. Loops are
over rounds, with written tables between; nothing about documents comes to the driver but counts.

Defined cases: texts that are null, empty or blank have an empty set and are linked with nothing; fewer words than
a shingle make one shingle; very long texts are taken whole; rows that repeat a doc_id are one document (their sets are all
compared, their links joined); a null doc_id takes no part and stays a component of its own (component_id null, kept true); an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickerloom.llm.common import map_columns
from tickerloom.staging import stage

SHINGLE_WORDS = 5
MIN_PCT = 80
BANDS = 32
ROWS = 5
CACHE_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        value = self[word] = xxh64_intdigest(word)
        return value


class Shingler:
    """Sets of hashed shingles; remembers the hashes of words met, up to a bound."""

    def __init__(self, words: int):
        self.words = words
        self.known = WordHashes()

    def hashes(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def set_of(self, raw: bytes | None) -> np.ndarray:
        """Sorted distinct hashes of the text's shingles. ``bytes.lower`` touches A-Z only."""
        words = (raw or b"").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashed = self.hashes(words)
        size = min(self.words, len(words))
        n = len(words) - size + 1
        out = np.full(n, size, np.uint64)
        for k in range(size):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashed[k:k + n])
        return np.unique(out)


def sketch(elements: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates of a set that isn't empty. The round stands in a value's top bits, so later rounds change no filled bin
    and any number of rounds can be worked out at a time."""
    out = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64(2**48 - 1)
    first, step = 0, max(1, math.ceil(1.3 * size * math.log(size) / len(elements)))
    while first < 2 * size:
        last = min(first + step, size if first < size else 2 * size)
        rounds = np.arange(first, last, dtype=np.uint64)
        h = mix(elements[None, :] + rounds[:, None] * np.uint64(0xD1342543DE82EF95))
        value = rounds[:, None] << np.uint64(48) | h & low
        if first < size:
            np.minimum.at(out, ((h >> np.uint64(48)) * np.uint64(size) >> np.uint64(16)).astype(np.int64).ravel(), value.ravel())
        else:
            bins = np.arange(first, last) - size
            out[bins] = np.minimum(out[bins], value.min(1))
        if out.max() >> np.uint64(48) < 2 * size:
            break
        first = last
    return out


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + coordinates.reshape(bands, rows)[:, k])
    return keys.view(np.int64)


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, the size of the set, two hashes that tell sets apart, and the band keys (empty for an empty set)."""

    def make():
        shingler = Shingler(words)

        def work(texts: pa.Array):
            sizes, one, two, keys = [], [], [], []
            for raw in texts.to_pylist():
                found = shingler.set_of(raw)
                sizes.append(len(found))
                one.append(int(mix(found).sum(dtype=np.uint64)))
                two.append(int(mix(found ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)))
                keys.append(band_keys(sketch(found, bands * rows), bands, rows) if len(found) else np.zeros(0, np.int64))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            return [pa.array(sizes, pa.int64()), *longs, pa.ListArray.from_arrays(offsets, flat)]

        return work

    return map_columns(docs, [F.col("text").cast("binary")], "n_shingles long, set_a long, set_b long, bands array<long>", make, ("doc_id",))


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its set as an array."""

    def make():
        shingler = Shingler(words)

        def work(texts: pa.Array):
            found = [shingler.set_of(raw).view(np.int64) for raw in texts.to_pylist()]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(k) for k in found])]).astype(np.int32))
            return [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))]

        return work

    return map_columns(docs, [F.col("text").cast("binary")], "shingles array<long>", make, ("doc_id",))


def sizes_allow(n: Column, m: Column, pct: int) -> Column:
    """Sets of these sizes can reach the threshold."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * pct


def verify(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough, as a written table."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_of_b"))
    common = F.size(F.array_intersect("set_of_a", "set_of_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    linked = both.where(common * 100 >= (F.size("set_of_a") + F.size("set_of_b") - common) * pct)
    return stage(linked.select("a", "b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """doc and comp, the smallest document that it reaches, for all that stand in ``links`` (a, b); a written table.

    Every document takes the smallest label among its own and its neighbours', then that label's own
    label, until nothing changes; labels jump ahead, so rounds grow as the logarithm of a chain's length.
    """
    both = stage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links-both")
    labels = stage(both.groupBy(F.col("a").alias("doc")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        heard = both.join(labels.select(F.col("doc").alias("b"), "comp"), "b").groupBy(F.col("a").alias("doc")).agg(F.min("comp").alias("heard"))
        lower = labels.join(heard, "doc", "left").select("doc", F.col("comp").alias("was"), F.least("comp", "heard").alias("comp"))
        ahead = labels.select(F.col("doc").alias("comp"), F.col("comp").alias("ahead"))
        after = stage(lower.join(ahead, "comp", "left").select("doc", "was", F.least("comp", "ahead").alias("comp")), "labels")
        labels = after.select("doc", "comp")
        if after.where("was <> comp").isEmpty():
            return labels


def comp_of(doc: str, labels: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """Adds the component of ``doc``; a document without links is its own."""
    known = labels.select(F.col("doc").alias("doc_"), F.col("comp").alias("comp_"))
    return df.join(known, F.col(doc) == F.col("doc_"), "left").withColumn(name, F.coalesce("comp_", F.col(doc))).drop("doc_", "comp_")


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of components."""
    between = comp_of("b", labels, comp_of("a", labels, links, "x"), "y").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    joined = components(between)
    docs = labels.select("doc", "comp").union(links.select(F.col("a"), F.col("a"))).union(links.select(F.col("b"), F.col("b")))
    old = docs.groupBy("doc").agg(F.min("comp").alias("old"))
    return stage(comp_of("old", joined, old, "comp").select("doc", "comp"), "labels")


def open_rows(multi: DataFrame, labels: DataFrame, sets: DataFrame, pct: int) -> tuple[DataFrame, DataFrame]:
    """What is still open: members of buckets with several components (key, doc, n, s), and their shingles (doc, shingle, df, wide).

    ``wide`` marks the shingles that several components hold, s is their number in a document. A link
    needs s * 100 >= n * pct; members below that are left out.
    """
    rows = stage(comp_of("doc", labels, multi.select("key", "doc", "n"), "comp"), "bucket-rows")
    mixed = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
    rows = stage(rows.join(mixed, "key", "left_semi"), "open-rows")
    each = rows.select("doc", "comp").distinct().join(sets, F.col("doc") == F.col("doc_id")).select("doc", "comp", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df"), (F.min("comp") != F.max("comp")).alias("wide"))
    shingles = stage(each.join(held, "shingle").select("doc", "shingle", "df", "wide"), "open-shingles")
    support = shingles.groupBy("doc").agg(F.count_if("wide").alias("s"))
    return stage(rows.join(support, "doc").where(F.col("s") * 100 >= F.col("n") * pct).select("key", "doc", "n", "s"), "open"), shingles


def can_link(n: Column, s: Column, m: Column, t: Column, pct: int) -> Column:
    """Two sets of n and m shingles, of which s and t are held by other components, can reach the threshold."""
    return sizes_allow(n, m, pct) & (F.least(s, t) * (100 + pct) >= (n + m) * pct)


def best_pairs(rows: DataFrame, labels: DataFrame, pct: int) -> DataFrame:
    """Each open member with the member of its bucket that has most in common with other components."""
    here = comp_of("doc", labels, rows, "comp")
    share, fields = F.col("s") / F.col("n"), ("doc", "n", "s", "comp")
    best = here.groupBy("key").agg(*[F.max_by(c, F.struct(share, F.col("s"), F.col("doc"))).alias(f"best_{c}") for c in fields])
    able = can_link(F.col("n"), F.col("s"), F.col("best_n"), F.col("best_s"), pct)
    return here.join(best, "key").where((F.col("comp") != F.col("best_comp")) & able).select(F.col("best_doc").alias("a"), F.col("doc").alias("b")).distinct()


def pairs_left(rows: DataFrame, shingles: DataFrame, labels: DataFrame, pct: int) -> DataFrame:
    """All pairs from different components that the prefix bound doesn't rule out.

    With shingles in one order for all (first those that one component holds, then by rarity), sets of n and m
    linked in c = (n + m) * pct / (100 + pct) shingles or more have one in common among the first n - c + 1 and
    m - c + 1. A document's partners are no smaller than the smallest member of its buckets, nor than the threshold allows.
    """
    least = rows.join(rows.groupBy("key").agg(F.min("n").alias("least")), "key").groupBy("doc").agg(F.first("n").alias("n"), F.min("least").alias("least"))
    least = least.withColumn("least", F.greatest(F.col("least"), F.ceil(F.col("n") * pct / 100)))
    common = lambda n, m: F.ceil((n + m) * pct / F.lit(100 + pct))
    order = W.partitionBy("doc").orderBy("wide", "df", "shingle")
    placed = shingles.join(least, "doc").withColumn("place", F.row_number().over(order))
    first = placed.where(F.col("wide") & (F.col("place") <= F.col("n") - common(F.col("n"), F.col("least")) + 1)).select("doc", "n", "shingle", "place")
    first = stage(comp_of("doc", labels, first, "comp"), "prefixes")
    mixed = first.groupBy("shingle").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("shingle")
    first = first.join(mixed, "shingle", "left_semi")
    x = first.select("shingle", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("p_a"), F.col("comp").alias("c_a"))
    y = first.select("shingle", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("p_b"), F.col("comp").alias("c_b"))
    c = common(F.col("n_a"), F.col("n_b"))
    within = (F.col("p_a") <= F.col("n_a") - c + 1) & (F.col("p_b") <= F.col("n_b") - c + 1)
    return x.join(y, "shingle").where((F.col("c_a") < F.col("c_b")) & sizes_allow(F.col("n_a"), F.col("n_b"), pct) & within).select("a", "b").distinct()


def link_all(docs: DataFrame, classes: DataFrame, words: int, pct: int) -> DataFrame:
    """Labels (doc, comp) of the classes that are linked."""
    draw = F.xxhash64("doc", "key")
    members = classes.select("doc", "n", F.explode("bands").alias("key"))
    centres = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min_by("doc", draw).alias("centre"), F.min_by("n", draw).alias("centre_n")).where("size > 1")
    multi = stage(members.join(centres, "key").drop("size"), "buckets")
    met = multi.where((F.col("doc") != F.col("centre")) & sizes_allow(F.col("n"), F.col("centre_n"), pct))
    pairs = stage(met.groupBy("centre", "doc").agg(F.count(F.lit(1)).alias("shared")), "pairs")
    shared = multi.select(F.col("doc").alias("doc_id")).distinct()
    sets = stage(full_sets(docs.join(shared, "doc_id", "left_semi"), words), "sets")
    first = pairs.groupBy("doc").agg(F.max_by("centre", F.struct("shared", "centre")).alias("centre"))
    labels = components(verify(first.select(F.col("centre").alias("a"), F.col("doc").alias("b")), sets, pct))
    apart = comp_of("b", labels, comp_of("a", labels, pairs.select(F.col("centre").alias("a"), F.col("doc").alias("b")), "x"), "y").where("x <> y")
    labels = merge(labels, verify(apart, sets, pct))
    rows, shingles = open_rows(multi, labels, sets, pct)
    while True:
        links = verify(best_pairs(rows, labels, pct), sets, pct)
        if links.isEmpty():
            break
        labels = merge(labels, links)
    return merge(labels, verify(pairs_left(rows, shingles, labels, pct), sets, pct))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, pct: int = MIN_PCT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * common shingles >= pct * all shingles of the two; ``component_id`` is the smallest doc_id reachable.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stage(sketches(texts, words, bands, rows), "sketches")
    real = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("copies"))
    classes = stage(classes, "classes")
    labels = link_all(texts, classes, words, pct)
    several = classes.where("copies > 1").select(F.col("set_a").alias("of_a"), F.col("set_b").alias("of_b"), "doc")
    same = (F.col("set_a") == F.col("of_a")) & (F.col("set_b") == F.col("of_b")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    placed = stage(found.drop("bands").join(several, same, "left").select("doc_id", "n_shingles", F.coalesce("doc", "doc_id").alias("rep")), "placed")
    repeated = placed.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select(F.col("doc_id").alias("again"), "low")
    again = stage(placed.join(repeated, F.col("doc_id") == F.col("again")).select(F.col("low").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct(), "again")
    if not again.isEmpty():
        labels = merge(labels, again)
    out = comp_of("rep", labels, placed, "component_id")
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, one of each group, with all their columns. Of rows that share a kept doc_id, one stays (the least by its columns)."""
    judged = stage(near_duplicates(docs, **options), "judged")
    gone = judged.where("NOT kept").select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    often = stage(judged.where("kept AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "often")
    if often.isEmpty():
        return rest
    fields = [f"`{c}`" for c in docs.columns]
    one = rest.join(often, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*fields)).alias("row")).select("row.*")
    return rest.join(often, "doc_id", "left_anti").select(*fields).unionByName(one.select(*fields))
