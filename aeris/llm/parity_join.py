"""N-gram Jaccard join by parity sketches.

A document is its set of distinct k-word shingles; two link when num / den of their union is shared,
that is, when their symmetric difference is at most (den - num) / (den + num) of the sum of their
sizes. A parity sketch XORs every shingle into one bit of a bit vector. The Hamming distance of
two sketches is a lower bound of the symmetric difference, which gives an exact join:

1. Size bands. Linked sets differ in size by den / num at most, so documents are banded by size,
   neighbouring bands overlapping by that ratio.
2. Pigeonhole. In a band the sketch is cut into ``n`` parts (of 2**16 bits each, kept sparse). Each
   shingle in the symmetric difference spoils one part at most, so a pair of difference d agrees
   on n - d parts at least. A document puts out only its d_max + 1 parts with the most bits set (a
   prefix filter under one order for all): a linked pair still shares one of them.
3. Stars instead of pairs. Documents of equal sets are one class. Within a key (an equal part), each class is compared only with the key's hub, the class
   whose keys are most shared. What remains is found without listing a group's pairs: relative to
   a hub h, the difference of x and y is that of the residuals x ^ h and y ^ h, of sizes D_x and
   D_y; so they share (D_x + D_y - d_max) / 2 residual shingles at least, and one if x is not linked
   to h. Residuals are banded by size; for each band of partners a prefix filter, shingles
   foreign to h first and rare ones before common ones, yields the few candidates left: a passage that many members
   share stands last, so that by itself it makes no pairs. How common a shingle is comes from a table of counts by hash
   bucket, of a fixed size; it fixes one order for all, on which no result depends. Shingles of h that a member lacks are common to many
   members, but seldom needed: x and y with no foreign shingle in common can only link if y lacks more of h
   than it has foreign. Members that links of stars join already need no comparison.
4. Verify. Whole sketches drop pairs whose Hamming distance exceeds the allowed difference; the
   others are decided on the shingle sets of the whole texts.

Shingles and sets are identified by 64-bit hashes. Components come from verified links and equal sets. All steps
are equi-joins and aggregates on hashed keys; a key that very many classes share costs one
star, linear in their number, which Spark may split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeris.llm.common import quoted, written
from aeris.llm.components import connected_components
from aeris.llm.text import mix, shingle_sets

UNITS = 2  # size units of ratio den / num in a band, without the one it shares with the next
LARGEST = 1 << 40
BROADCAST_BYTES = 8_000_000  # of hashes and ids; beyond that they are shuffled
BUCKETS = 1 << 18  # of shingle counts; a shingle in many more texts than a bucket's share of all shingles stands out

_U = np.uint64


class Bands:
    """Sizes, parts and allowed differences for the similarity num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        edges = [1]
        while edges[-1] < LARGEST:
            edges.append(edges[-1] * den // num + 1)  # a partner of a smaller size lies below the edge after next
        self.edges = np.array(edges)

    def allowed(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def most(self, a: int) -> int:
        """The largest difference that a set of size a can have to any linked one."""
        return self.allowed(a, a * self.den // self.num)

    def linked(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)

    def of(self, a: int) -> list[tuple[int, int, int]]:
        """Bands of a size: (band, number of parts, number of parts to put out)."""
        unit = int(np.searchsorted(self.edges, a, side="right")) - 1
        band, place = divmod(unit, UNITS)
        out = [(band, self.parts(band), self.most(a) + 1)]
        if place == 0 and band > 0:  # the upper rim of the band below: only with its smaller sets
            out.append((band - 1, self.parts(band - 1), self.allowed(a, int(self.edges[unit]) - 1) + 1))
        return out

    def parts(self, band: int) -> int:
        rim = int(self.edges[(band + 1) * UNITS + 1]) - 1
        return max(self.most(rim) + 1, -(-self.most(rim) * 5 // 4))


def class_hash(shingles: np.ndarray) -> int:
    return int(mix(np.array([mix(shingles ^ _U(0xA0761D6478BD642F)).sum(dtype=np.uint64) + _U(len(shingles))], np.uint64)).view(np.int64)[0])


def part_keys(shingles: np.ndarray, band: int, parts: int, n_out: int) -> np.ndarray:
    """Keys of the ``n_out`` parts of the parity sketch with the most set bits (ties by key)."""
    part = ((shingles >> _U(32)) * _U(parts)) >> _U(32)
    bits, times = np.unique((part << _U(16)) | (shingles & _U(0xFFFF)), return_counts=True)
    bits = bits[times & 1 == 1]
    part = (bits >> _U(16)).astype(np.int64)
    set_bits = np.bincount(part, minlength=parts)
    value = np.zeros(parts, np.uint64)
    if len(bits):
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        value[part[starts]] = np.bitwise_xor.reduceat(mix(bits + _U(0xE7037ED1A0B428DB)), starts)
    keys = mix(value + mix((np.arange(parts, dtype=np.uint64) << _U(16)) | _U(band)))
    return keys[np.lexsort((keys, -set_bits))[:n_out]].view(np.int64)


def sketch(shingles: np.ndarray) -> bytes:
    """Parity sketch of 2 to 4 bits a shingle, 64 at least."""
    size = max(64, 1 << int(2 * len(shingles) - 1).bit_length())
    return np.packbits((np.bincount(((shingles >> _U(16)) & _U(size - 1)).astype(np.int64), minlength=size) & 1).astype(np.uint8)).tobytes()


def hamming(a: bytes, b: bytes) -> int:
    """Distance of two sketches; the longer one is folded to the length of the other by XOR."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0) ^ x).sum())


def profile(docs: DataFrame, k: int, bands: Bands) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, keys, sketch`` of every row; class and sketch are null
    and keys empty for a text without words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, classes, keys, sketches = [], [], [], []
            for s in shingle_sets(batch.column("text"), k):
                n.append(len(s))
                classes.append(class_hash(s) if len(s) else None)
                sketches.append(sketch(s) if len(s) else None)
                own = [part_keys(s, *band) for band in bands.of(len(s))] if len(s) and bands.most(len(s)) else []
                keys.append(np.concatenate(own) if own else np.zeros(0, np.int64))
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(classes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)]))), pa.array(sketches, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "class", "keys", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        task, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, n_shingles long, class long, keys array<long>, sketch binary")


def _star_pairs(profiles: DataFrame) -> DataFrame:
    """``hub, member, crowded``: each class with the hubs of its shared keys; crowded where the key
    may have other members."""
    keyed = profiles.select("class", F.explode("keys").alias("key"))
    shared = (
        keyed.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.count("*").alias("n"))
        .where("least < most").select("key", "n")
    )
    members = written(keyed.join(shared, "key").distinct(), "parity-members")
    ranks = members.groupBy("class").agg(F.sum("n").alias("popularity"))
    hubs = members.join(ranks, "class").groupBy("key").agg(F.max(F.struct("popularity", "class")).alias("hub"))
    return (
        members.join(hubs.select("key", F.col("hub.class").alias("hub")), "key").where(F.col("hub") != F.col("class"))
        .groupBy("hub", F.col("class").alias("member")).agg((F.max("n") > 2).alias("crowded"))
    )


def _near(pairs: DataFrame, classes: DataFrame, bands: Bands) -> DataFrame:
    """``pairs`` (``a, b`` and more) with both text hashes; ``near`` is false where sizes or sketches rule a link out."""
    sides = pairs
    for side in "ab":
        sides = sides.join(classes.select(F.col("class").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n_shingles", "sketch", "text_hash")]), side)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(f"{c}_{s}").to_pylist() for s in "ab" for c in ("n_shingles", "sketch")))
            near = [hamming(s, t) <= bands.allowed(a, b) and bands.linked(min(a, b), a, b) for a, s, b, t in rows]
            kept = [i for i, c in enumerate(batch.schema.names) if not c.startswith(("sketch_", "n_shingles_"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(near, pa.bool_())],
                                             names=[*(batch.schema.names[i] for i in kept), "near"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in sides.schema.fields if not f.name.startswith(("sketch_", "n_shingles_"))]
    return sides.mapInArrow(task, ", ".join([*fields, "near boolean"]))


def _texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``text_hash, text`` of the texts that ``pairs`` (with ``text_hash_a, text_hash_b``; a written table) ask for. Only
    those move; their hashes are broadcast up to ``BROADCAST_BYTES`` and shuffled beyond."""
    wanted = written(pairs.select(F.explode(F.array("text_hash_a", "text_hash_b")).alias("text_hash")).distinct(), "parity-wanted")
    if 8 * wanted.count() <= BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(wanted, "text_hash", "left_semi")
    return written(texts.groupBy("text_hash").agg(F.first("text").alias("text")), "parity-texts")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` with ``text_a, text_b``."""
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("text_hash").alias(f"text_hash_{side}"), F.col("text").alias(f"text_{side}")), f"text_hash_{side}")
    return pairs


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets of both texts of each row; those of equal texts in a batch are made once."""
    a, b = batch.column("text_hash_a").to_numpy(), batch.column("text_hash_b").to_numpy()
    _, rows = np.unique(a, return_index=True)
    hubs = {int(a[i]): i for i in rows}
    made = dict(zip(hubs, shingle_sets(batch.column("text_a").take(pa.array(list(hubs.values()), pa.int64())), k)))
    for i, s in enumerate(shingle_sets(batch.column("text_b"), k)):
        yield made[int(a[i])], s


def _commonness(texts: DataFrame, k: int) -> np.ndarray:
    """For each hash bucket how many of ``texts`` have its shingles, in eighths of a power of 2 (a byte): a table
    of ``BUCKETS`` bytes, however many the texts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = np.concatenate([*shingle_sets(batch.column("text"), k), np.zeros(0, np.uint64)])
            counts += np.bincount((found & _U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], names=["bucket", "n"])

    total = texts.select("text").mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.uint8)
    out[total["bucket"].to_numpy()] = np.minimum(8 * np.log2(1 + total["n"].to_numpy()), 255).astype(np.uint8)
    return out


def _rare_first(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    return shingles[np.lexsort((shingles, common[(shingles & _U(len(common) - 1)).astype(np.int64)]))]


def _residual_prefixes(s: np.ndarray, foreign: np.ndarray, h: np.ndarray, bands: Bands, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed residual shingles that s puts out relative to hub h, each with the residual bands of a pair,
    and which of them are foreign to h. Shingles that are common by the table ``common`` come last of either kind.

    A partner in the band from ``low`` on shares at least (D + low - d_max) / 2 of the D residual shingles, so
    the first one shared is among the first D + 1 - that many."""
    d, reach, width = len(s) + len(h) - 2 * (len(s) - len(foreign)), bands.most(len(s)), max(1, bands.most(len(h)) // 2)
    own, lowest, highest = d // width, max(0, d - reach) // width, (d + reach) // width
    counts = [d + 1 - max(1, -(-(d + band * width - reach) // 2)) for band in range(lowest, highest + 1)]
    residual = _rare_first(foreign, common)[: max(counts)]
    if len(residual) < max(counts):
        residual = np.concatenate([residual, _rare_first(np.setdiff1d(h, s, assume_unique=True), common)[: max(counts) - len(residual)]])
    place = np.concatenate([np.arange(max(0, n)) for n in counts])
    partner = np.repeat(np.arange(lowest, highest + 1), np.maximum(counts, 0))
    pair = (np.minimum(own, partner).astype(np.uint64) << _U(32)) | np.maximum(own, partner).astype(np.uint64)
    return mix(residual[place] + mix(pair)).view(np.int64), place < len(foreign)


def _verify_stars(pairs: DataFrame, docs: DataFrame, k: int, bands: Bands) -> DataFrame:
    """``a, b, crowded, linked, size, extra, missing, asks, answers``: hub a and member b decided. b has ``extra`` shingles foreign
    to a and lacks ``missing`` of a's. Of crowded keys only, ``asks`` are the hashed residual shingles b puts out if it isn't
    linked to a, ``answers`` those among which an asking partner must find one."""

    texts = _texts(pairs, docs)
    common = _commonness(texts, k)

    def lists(values: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in values]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        for batch in batches:
            linked, size, extra, missing, asks, answers = [], [], [], [], [], []
            crowded = batch.column("crowded").to_pylist()
            for (h, s), full in zip(_sets(batch, k), crowded):
                foreign = np.setdiff1d(s, h, assume_unique=True)
                shared = len(s) - len(foreign)
                linked.append(bands.linked(shared, len(s), len(h)))
                size.append(len(s))
                extra.append(len(foreign))
                missing.append(len(h) - shared)
                keys, is_foreign = _residual_prefixes(s, foreign, h, bands, common) if full else (none, none.astype(bool))
                asks.append(none if linked[-1] else keys)
                answers.append(keys if missing[-1] > extra[-1] else keys[is_foreign])
            counts = {"linked": linked, "size": size, "extra": extra, "missing": missing}
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("a", "b", "crowded")), *(pa.array(v, pa.bool_() if c == "linked" else pa.int64()) for c, v in counts.items()),
                 lists(asks), lists(answers)], names=["a", "b", "crowded", *counts, "asks", "answers"])

    rows = _with_texts(pairs, texts).select("a", "b", "crowded", "text_hash_a", "text_hash_b", "text_a", "text_b")
    return rows.mapInArrow(task, "a long, b long, crowded boolean, linked boolean, size long, extra long, missing long, asks array<long>, answers array<long>")


def _verify(pairs: DataFrame, docs: DataFrame, k: int, bands: Bands) -> DataFrame:
    """``a, b`` of the pairs that link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [bands.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in _sets(batch, k)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = _with_texts(pairs, _texts(pairs, docs)).select("a", "b", "text_hash_a", "text_hash_b", "text_a", "text_b")
    return rows.mapInArrow(task, "a long, b long")


def _residual_pairs(stars: DataFrame, components: DataFrame, bands: Bands) -> DataFrame:
    """``a, b``: members of a hub, one of them not linked to it, that share a residual shingle put out, whose
    sizes and differences from the hub allow a link, and that the stars' links don't join already.

    A linked pair is found with any hub that both have. So two members with the same largest hub are compared there only."""
    stars = stars.where("crowded")
    largest = (
        stars.join(stars.groupBy("a").agg(F.count("*").alias("n")), "a")
        .groupBy("b").agg(F.max(F.struct("n", "a")).alias("one")).select("b", F.col("one.a").alias("top"))
    )
    stars = stars.join(largest, "b")
    stars = stars.join(components.select(F.col("node").alias("b"), "component"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    about = ("b", "component", "top", "size", "extra", "missing")
    outside = stars.select("a", F.explode("asks").alias("token"), *[F.col(c).alias(f"x_{c}") for c in about])
    other = stars.select("a", F.explode("answers").alias("token"), *[F.col(c).alias(f"y_{c}") for c in about])
    allowed = (F.col("x_size") + F.col("y_size")) * (bands.den - bands.num) / (bands.den + bands.num)
    return (
        outside.join(other, ["a", "token"]).where(F.col("x_component") != F.col("y_component"))
        .where((F.col("x_top") != F.col("y_top")) | (F.col("a") == F.col("x_top")))
        .where(F.abs(F.col("x_extra") - F.col("y_extra")) + F.abs(F.col("x_missing") - F.col("y_missing")) <= allowed)
        .where(F.least("x_size", "y_size") * bands.den >= F.greatest("x_size", "y_size") * bands.num)
        .select(F.least("x_b", "y_b").alias("a"), F.greatest("x_b", "y_b").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``doc_id, text_hash, n_shingles, class, component, component_id`` of every row of ``docs`` (``doc_id, text``).

    A text of fewer than ``k`` words has its whole sequence as its one shingle; a null text or one without
    words has none, links with nothing and is a component of its own (``class, component`` null, its own id).
    Equal sets link. ``component`` is the least class hash and ``component_id`` the least id of the rows reachable by links; null
    ids don't count for it. Repeated rows and ids are ordinary rows of one class. Extra columns are ignored;
    an empty table gives no rows.
    """
    bands = Bands(num, den)
    profiles = written(profile(docs, k, bands), "parity-profiles")
    full = profiles.where(F.col("class").isNotNull())
    classes = full.groupBy("class").agg(F.min(F.struct("text_hash", "n_shingles", "sketch")).alias("one")).select("class", "one.*")

    stars = _star_pairs(full).select(F.col("hub").alias("a"), F.col("member").alias("b"), "crowded")
    stars = written(_near(stars, classes, bands).where("near or crowded").drop("near"), "parity-stars")
    stars = written(_verify_stars(stars, docs, k, bands), "parity-verified")
    joined = connected_components(stars.where("linked").select("a", "b"), "parity-stars-joined")
    rest = _near(_residual_pairs(stars, joined, bands), classes, bands).where("near").drop("near")
    rest = _verify(written(rest, "parity-rest"), docs, k, bands)
    links = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(rest)

    components = connected_components(links, "parity-components").withColumnRenamed("node", "class")
    rows = (
        profiles.select("doc_id", "text_hash", "n_shingles", "class").join(components, "class", "left")
        .withColumn("component", F.coalesce("component", "class"))
    )
    least = written(rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("component_id")), "parity-least")
    return (
        rows.join(least, "component", "left")
        .withColumn("component_id", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
        .select("doc_id", "text_hash", "n_shingles", "class", "component", "component_id")
    )


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without near duplicates, all columns as they are.

    Of each component one row stays: the least id with the least text hash; a row with no id stays
    only where its whole component has none. Rows without shingles all stay. Of rows equal in id and text, one stays, whichever; rows of
    the same id but different text are different documents.
    """
    found = near_duplicates(docs, k, num, den)
    in_group = F.col("component").isNotNull()
    keep = found.where(in_group).groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("keep"))
    rows = (
        found.where(in_group).groupBy("component", F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(F.count("*").alias("n"))
        .join(keep, "component").withColumn("stays", F.col("keep.doc_id").eqNullSafe(F.col("of_id")) & (F.col("keep.text_hash") == F.col("of_hash")))
        .where(~F.col("stays") | (F.col("n") > 1)).select("of_id", "of_hash", "stays")
    )
    rows = written(rows, "parity-leaving")
    size = rows.agg(F.coalesce(F.sum(F.octet_length(F.coalesce(F.col("of_id").cast("string"), F.lit(""))) + 16), F.lit(0))).first()[0]
    few = size <= BROADCAST_BYTES
    hashed = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("of_id")) & (F.col("own_hash") == F.col("of_hash"))
    leaving, repeated = rows, rows.where("stays")
    rest = hashed.join(F.broadcast(leaving) if few else leaving, same, "left_anti")
    once = hashed.join(F.broadcast(repeated) if few else repeated, same, "left_semi").dropDuplicates(["own_id", "own_hash"])
    return rest.unionByName(once).select("row.*")
