"""Near-duplicate documents by MinHash and a multi-index Hamming join.

Every document becomes the set of its distinct word shingles (words of A-Z-lowered text). Documents with equal sets form a
class at once. A class has a signature of `chunks * chunk_symbols` MinHash symbols of b = 16 bits; its distance to
another is the number of symbols that differ. The signature is split into chunks, and each chunk emits one key for
every way to leave out one symbol. By the pigeonhole principle two signatures that differ in fewer than
2 * chunks symbols have a chunk with at most one error, so they share a key: all pairs under that distance meet. A pair of similarity s
also meets beyond it; it is missed with probability (1 - s^c - c s^(c-1) (1-s))^chunks for c symbols a chunk, 2e-6 at
s = 0.8 with ten chunks of five.

Links are confirmed on full sets. No bucket is expanded into all its pairs: each class is first compared with the
smallest class of its buckets; then with the smallest classes of those buckets that still hold unlinked components;
what remains are pairs of different components within a bucket, so a large group of copies costs one comparison a
member. Pairs inside a component cannot change the result and are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.components import components
from tripmart.llm.tables import settled, stored
from tripmart.llm.textops import Words, mix, shingle_sets, slices


BITMAP_WORDS = 16


@dataclass(frozen=True)
class NearDedup:
    shingle_words: int = 5
    percent: int = 80
    chunks: int = 10
    chunk_symbols: int = 5
    members_per_task: int = 256

    @property
    def symbols(self) -> int:
        return self.chunks * self.chunk_symbols

    @property
    def guaranteed_distance(self) -> int:
        """All pairs of signatures at most this many symbols apart share a key."""
        return 2 * self.chunks - 1


def signature_rows(params: NearDedup, keep_text: bool = False):
    """Arrow batches of (doc_id, text) to (doc_id, n_shingles, high, low, signature), or to the text in place of the signature."""
    draw = np.random.default_rng(7)
    factors = draw.integers(0, 1 << 63, params.symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    masks = draw.integers(0, 1 << 63, params.symbols, dtype=np.uint64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                values, at = shingle_sets(words, words.hashes(lower=True), params.shingle_words)
                count = np.diff(at)
                full = np.flatnonzero(count)
                digests = np.zeros((2, len(count)), np.uint64)
                symbols = np.zeros((len(count), params.symbols), np.uint16)
                if len(full):
                    begin = at[:-1][full]
                    for k, spread in enumerate((mix(values), mix(values ^ np.uint64(0x5851F42D4C957F2D)))):
                        digests[k, full] = np.add.reduceat(spread, begin)
                    for k in range(params.symbols):
                        least = np.minimum.reduceat((values ^ masks[k]) * factors[k], begin)
                        symbols[full, k] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(count.astype(np.int64)),
                        pa.array(digests[0].view(np.int64)),
                        pa.array(digests[1].view(np.int64)),
                        batch.column(1).slice(first, last - first) if keep_text else pa.array([row.tobytes() for row in symbols], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "high", "low", "text" if keep_text else "signature"],
                )

    return rows


def key_rows(params: NearDedup):
    """Arrow batches of (rep, signature) to (key, rep): one key for each chunk and symbol left out."""
    c = params.chunk_symbols
    salts = mix(np.arange(1, params.symbols + 1, dtype=np.uint64)).reshape(params.chunks, c)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).astype(np.uint64)
            found = found.reshape(-1, params.chunks, c)
            keys = np.empty(found.shape, np.uint64)
            for left_out in range(c):
                value = np.zeros(found.shape[:2], np.uint64)
                for k in range(c):
                    if k != left_out:
                        value = mix(value) ^ found[:, :, k]
                keys[:, :, left_out] = mix(value ^ salts[None, :, left_out])
            rep = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), params.symbols)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(rep)], ["key", "rep"])

    return rows


def shingle_rows(params: NearDedup):
    """Arrow batches of (rep, text) to (rep, shingle), one row for each distinct shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                values, at = shingle_sets(words, words.hashes(lower=True), params.shingle_words)
                rep = np.repeat(batch.column(0).slice(first, last - first).to_numpy(zero_copy_only=False), np.diff(at))
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(values.view(np.int64))], ["rep", "shingle"])

    return rows


def bitmap_rows(params: NearDedup):
    """(rep, text, alone) to (rep, n, shared, b0, ...): set size, size without the shingles in `alone`, and a bitmap of those."""
    bits = np.uint64(64 * BITMAP_WORDS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in slices(batch.column(1)):
                words = Words(data, offsets)
                values, at = shingle_sets(words, words.hashes(lower=True), params.shingle_words)
                row = np.repeat(np.arange(last - first), np.diff(at))
                lists = batch.column(2).slice(first, last - first)
                alone = np.array([x for own in lists.to_pylist() for x in own or ()], np.int64).view(np.uint64)
                held = ~np.isin(values, alone)
                bitmap = np.zeros((last - first, int(bits)), bool)
                bitmap[row[held], (mix(values[held]) % bits).astype(np.int64)] = True
                packed = np.packbits(bitmap, axis=1, bitorder="little").view(np.int64)
                columns = [np.diff(at), np.bincount(row[held], minlength=last - first), *packed.T]
                names = ["rep", "n", "shared", *(f"b{k}" for k in range(BITMAP_WORDS))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *(pa.array(np.ascontiguousarray(x).astype(np.int64)) for x in columns)], names)

    return rows


def confirm_rows(params: NearDedup):
    """Sorted rows (center, salt, member, text) to the links (a, b); the center's own row comes first in its run."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, center = None, None
        for batch in batches:
            links: list[tuple[int, int]] = []
            centers, salts, members = (batch.column(k).to_pylist() for k in range(3))
            for first, last, data, offsets in slices(batch.column(3)):
                words = Words(data, offsets)
                values, at = shingle_sets(words, words.hashes(lower=True), params.shingle_words)
                for k in range(last - first):
                    own = values[at[k] : at[k + 1]]
                    row = first + k
                    if members[row] == centers[row]:
                        run, center = (centers[row], salts[row]), own.copy()
                        continue
                    if run != (centers[row], salts[row]):
                        raise ValueError(f"the text of document {centers[row]} is missing")
                    small, large = sorted((own, center), key=len)
                    if 100 * len(small) < params.percent * len(large):
                        continue
                    place = np.searchsorted(large, small)
                    common = int(np.count_nonzero(large[np.minimum(place, len(large) - 1)] == small))
                    if 100 * common >= params.percent * (len(own) + len(center) - common):
                        links.append((members[row], centers[row]))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([x for _, x in links], pa.int64())], ["a", "b"])

    return rows


def confirmed(pairs: DataFrame, texts: DataFrame, params: NearDedup) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets are similar enough.

    Each member's text moves once, to its center b. A center with many members is split into runs of about
    `members_per_task`, each with its own copy of the center's text.
    """
    pairs = stored(pairs, "pairs")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / params.members_per_task).cast("int").alias("runs"))
    sizes = stored(sizes, "runs")
    members = pairs.join(sizes.where("runs > 1"), "b", "left")
    salt = F.coalesce(F.pmod(F.xxhash64("a"), F.col("runs")), F.lit(0)).cast("int").alias("salt")
    members = members.select(F.col("b").alias("center"), salt, F.col("a").alias("member"))
    centers = sizes.select(F.col("b").alias("center"), F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("salt"), F.col("b").alias("member"))
    rows = members.unionByName(centers).join(texts.select(F.col("rep").alias("member"), "text"), "member")
    rows = rows.select("center", "salt", "member", "text", (F.col("member") != F.col("center")).alias("later"))
    rows = rows.repartition("center", "salt").sortWithinPartitions("center", "salt", "later")
    return rows.select("center", "salt", "member", "text").mapInArrow(confirm_rows(params), "a long, b long")


def near_duplicates(docs: DataFrame, params: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    Null or blank text has no shingles and no links. A row without id is never linked: its component is null and it
    is kept. Rows that repeat an id share its component and verdict; if their texts differ, all of them count as that
    document and are linked with each other (but a row without words stays alone). Ids are below 2**62. Columns of other names are ignored. An empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = stored(docs.mapInArrow(signature_rows(params), "doc_id long, n_shingles long, high long, low long, signature binary"), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    same = ["high", "low", "n_shingles"]
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("signature").alias("signature"))

    # An id with several sets is in several classes. A class that it names is told apart by a number of its own above all ids.
    sets = F.struct(*same)
    several = usable.groupBy("doc_id").agg(F.min(sets).alias("one"), F.max(sets).alias("other")).where("one != other").select("doc_id")
    several = stored(several, "several")
    marked = classes.join(several.withColumnRenamed("doc_id", "least").withColumn("torn", F.lit(True)), "least", "left")
    own = F.xxhash64("least", *same).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    classes = stored(marked.withColumn("rep", F.when(F.col("torn"), own).otherwise(F.col("least"))), "classes")

    keys = classes.select("rep", "signature").mapInArrow(key_rows(params), "key long, rep long")
    buckets = stored(keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key", "lo"), "buckets")
    members = stored(keys.join(buckets, "key"), "members")
    met = members.select("rep").distinct()
    plain = docs.join(met.withColumnRenamed("rep", "doc_id"), "doc_id").select(F.col("doc_id").alias("rep"), "text").dropDuplicates(["rep"])
    again = docs.join(several, "doc_id", "left_semi").mapInArrow(signature_rows(params, True), "doc_id long, n_shingles long, high long, low long, text string")
    torn = classes.where("torn").join(again, same).where("doc_id = least").join(met, "rep", "left_semi").select("rep", "text").dropDuplicates(["rep"])
    texts = stored(plain.unionByName(torn), "texts")
    ties = usable.join(several, "doc_id", "left_semi").join(classes.select(*same, "rep"), same).select("doc_id", "rep")
    ties = stored(ties.where("doc_id != rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct(), "ties")

    stars = members.where("rep > lo")
    first = stars.groupBy(F.col("rep").alias("a")).agg(F.min("lo").alias("b"))
    tested = stored(first, "tested")
    links = stored(ties.unionByName(confirmed(tested, texts, params)), "links")
    roots = components(links)

    open_stars = _across(stars.select(F.col("rep").alias("a"), F.col("lo").alias("b")).distinct(), roots).join(tested, ["a", "b"], "left_anti")
    open_stars = stored(open_stars, "tested")
    if not open_stars.isEmpty():
        tested = stored(tested.unionByName(open_stars), "tested")
        links = stored(links.unionByName(confirmed(open_stars, texts, params)), "links")
        roots = components(links)

    rooted = members.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
    rooted = stored(rooted.join(mixed, "key", "left_semi"), "mixed")
    rest = stored(_possible(rooted, texts, params).join(tested, ["a", "b"], "left_anti"), "tested")
    if not rest.isEmpty():
        links = stored(links.unionByName(confirmed(rest, texts, params)), "links")
        roots = components(links)

    copies = classes.where("rep != most or torn").select(*same, "rep")
    labelled = signed.join(copies, same, "left").select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    labelled = labelled.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("root", "rep")
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _possible(rooted: DataFrame, texts: DataFrame, params: NearDedup) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and whose sets could be similar enough.

    A shingle that only one of these documents has is in no intersection, and neither is one whose bit is not set in the
    other's bitmap. Both bound the intersection from above, which rules out most pairs of a large group without comparing them; no pair
    that links is ruled out.
    """
    own = texts.join(rooted.select("rep").distinct(), "rep")
    shingles = own.select("rep", "text").mapInArrow(shingle_rows(params), "rep long, shingle long")
    single = shingles.groupBy("shingle").agg(F.min("rep").alias("rep"), F.count("*").alias("docs")).where("docs = 1")
    alone = single.groupBy("rep").agg(F.collect_list("shingle").alias("alone"))
    words = ", ".join(f"b{k} long" for k in range(BITMAP_WORDS))
    described = own.select("rep", "text").join(alone, "rep", "left").select("rep", "text", "alone")
    able = described.mapInArrow(bitmap_rows(params), f"rep long, n long, shared long, {words}").where(f"100 * shared >= {params.percent} * n")
    rows = stored(rooted.join(able, "rep"), "able")
    sides = [rows.select("key", *(F.col(name).alias(f"{side}_{name}") for name in rows.columns if name != "key")) for side in "xy"]
    missing = [" + ".join(f"bit_count({one}_b{k} & ~{other}_b{k})" for k in range(BITMAP_WORDS)) for one, other in ("xy", "yx")]
    most = f"least(x_shared - ({missing[0]}), y_shared - ({missing[1]}))"
    close = f"100 * {most} >= {params.percent} * (x_n + y_n - {most})"
    pairs = sides[0].join(sides[1], "key").where(f"x_root != y_root and x_rep > y_rep and {close}")
    return stored(pairs.select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b")).distinct(), "possible")


def _across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("left"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("right"))
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    return joined.where(F.coalesce("left", "a") != F.coalesce("right", "b")).select("a", "b")


def keep_first(docs: DataFrame, params: NearDedup = NearDedup()) -> DataFrame:
    """The documents without those that link to a smaller doc_id; columns as they were."""
    dropped = settled(docs.sparkSession, lambda: near_duplicates(docs, params).where("not kept").select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
