"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles gives two signature values, the smallest and the
largest, so 192 evaluations give 384 values. Bands of four of the first 128 values
are the buckets: two sets with similarity 0.75 share one of 32 with probability
1 - 5e-6.

Documents with the same set form a class, and only one row of it goes on; classes,
not ids, are linked, and in the end every class of an id to that id's smallest one. In a
first round every bucket links its members to one pivot, the member that shares
most buckets with others, and the links are confirmed on the full sets. Buckets
whose members then lie in several components are searched whole: the members
outside the largest component against all, in blocks of bounded size, by their
signatures (384 bytes each), and what looks at least 0.66 similar (four standard
deviations below the limit) is confirmed on the full sets. Members of
one component need no comparing: a link between them changes nothing.

A null or empty text, and one without words, has an empty set and no links. A null
id ranks below all others. Rows with the same id are one node. An empty table
gives an empty result; other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.staging import settle
from tradeloom.llm.components import components
from tradeloom.llm.text import fresh, in_arrow, texts

NO_ID = -(2**63)
WORDS = 5
PERMUTATIONS, BANDS, ROWS_PER_BAND = 192, 32, 4
BLOCK = 1024
#: Shingles hashed at a time, so that a very long text needs no more memory.
STRETCH = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


FACTORS, MULTIPLY, ADD, JOIN = _constants(WORDS, 1), _constants(PERMUTATIONS, 2), _constants(PERMUTATIONS, 3), _constants(ROWS_PER_BAND, 4)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    word = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(word) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for k in range(WORDS):
        total += word[k : k + n] * FACTORS[k]
    return np.unique(_mix(total))


def signature(found: np.ndarray) -> np.ndarray:
    """Minimum and maximum under each permutation, next to each other."""
    low = np.full(PERMUTATIONS, np.uint64(2**64 - 1))
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(found), STRETCH):
        order = MULTIPLY[:, None] * found[None, at : at + STRETCH] + ADD[:, None]
        low, high = np.minimum(low, order.min(1)), np.maximum(high, order.max(1))
    return np.stack([low, high], 1).ravel()


def bands(values: np.ndarray) -> np.ndarray:
    grouped = _mix(values[: BANDS * ROWS_PER_BAND]).reshape(-1, ROWS_PER_BAND) * JOIN
    return _mix(grouped.sum(1, dtype=np.uint64) + np.arange(len(grouped), dtype=np.uint64))


def class_key(found: np.ndarray) -> tuple[int, int]:
    key = xxhash.xxh3_128_intdigest(found.tobytes())
    return (key >> 64) - 2**63, (key & (2**64 - 1)) - 2**63


def sketches(docs: DataFrame) -> DataFrame:
    def rows(batches):
        hashes, row = _Hashes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                found, row = shingles(text, hashes), row + 1
                if not len(found):
                    yield row, doc_id, 0, None, None, [], None
                    continue
                values = signature(found)
                k1, k2 = class_key(found)
                small = (_mix(values) >> np.uint64(56)).astype(np.uint8).tobytes()
                yield row, doc_id, len(found), k1, k2, bands(values).astype(np.int64), small

    schema = "row long, doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, sig binary"
    return in_arrow(_ranked(docs), rows, schema, flush=5000)


def _ranked(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id (the class's node) and shingles (binary) of the classes in ``wanted`` (node, least, k1, k2)."""

    def rows(batches):
        hashes = _Hashes()
        for batch in batches:
            for text in texts(batch):
                found = shingles(text, hashes)
                yield *class_key(found), found.tobytes()

    picked = _ranked(docs).join(wanted.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi")
    found = in_arrow(picked.select("text"), rows, "k1 long, k2 long, shingles binary", flush=1000)
    return found.join(wanted, ["k1", "k2"]).select(F.col("node").alias("doc_id"), "shingles").dropDuplicates(["doc_id"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose full sets have the wanted similarity."""
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("su"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("sv"))
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "su", "sv")

    def rows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                u, v, a, b = (batch.column(c)[k] for c in range(4))
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    yield u.as_py(), v.as_py()

    return in_arrow(both, rows, "u long, v long")


def alike(batches, schema: pa.Schema, percent: int, least: float):
    """Of rows sorted by (key, i, j), pairs of one key with different components that look alike.

    A row's side tells whether it stands left (1) or right (2), and whether it is
    outside the largest component (4); rows of a key that goes on in the next batch
    are kept for it. Every pair comes once, from the first bucket that both share.
    """
    rest = None
    for batch in [*batches, None] if isinstance(batches, list) else _then_none(batches):
        now = pa.Table.from_batches([b for b in (rest, batch) if b is not None], schema).combine_chunks()
        if not len(now):
            continue
        key = np.stack([now.column(c).to_numpy() for c in range(3)], 1)
        cut = len(key)
        if batch is not None:
            cut = int(np.flatnonzero((key != key[-1]).any(1))[-1]) + 1 if (key != key[-1]).any() else 0
        rest = None
        if batch is not None:
            tail = now.slice(cut).combine_chunks().to_batches()
            rest = tail[0] if tail else None
        if not cut:
            continue
        now, key = now.slice(0, cut), key[:cut]
        side, node, part, size = (now.column(c).to_numpy() for c in range(3, 7))
        band = now.column(8).combine_chunks().flatten().to_numpy().reshape(cut, -1)
        here = (band == key[:, :1]).argmax(1)  # which of its bands a row stands for
        left, right, minor = side & 1, (side >> 1) & 1, side >> 2
        sig = np.frombuffer(b"".join(now.column(7).to_pylist()), np.uint8).reshape(cut, -1)
        group = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]).any(1))))
        for k in range(1, cut):
            a = np.flatnonzero(group[:-k] == group[k:])
            if not len(a):
                break
            b = a + k
            one_way, other_way = left[a] & right[b], left[b] & right[a]
            lesser, larger = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            keep = ((one_way | other_way) > 0) & (part[a] != part[b]) & (100 * lesser >= percent * larger)
            # Two minors meet in two blocks, once either way round: the smaller on the left counts.
            wrong = np.where(one_way == 1, node[a] > node[b], node[b] > node[a])
            keep &= ~((minor[a] & minor[b] & (one_way ^ other_way)) == 1) | ~wrong
            a, b = a[keep], b[keep]
            for s in range(0, len(a), 100_000):
                x, y = a[s : s + 100_000], b[s : s + 100_000]
                near = (sig[x] == sig[y]).mean(1) >= least
                x, y = x[near], y[near]
                # Of all buckets that a pair shares, the first gives it.
                near = (band[x] == band[y]).argmax(1) == here[x]
                for u, v in zip(node[x[near]].tolist(), node[y[near]].tolist()):
                    yield min(u, v), max(u, v)


def _then_none(batches):
    yield from batches
    yield None


def second_round(held: DataFrame, parts: DataFrame, about: DataFrame, percent: int, least: float) -> DataFrame:
    """Pairs between components of one bucket that look alike by their signatures."""
    labelled = held.join(parts, held.doc_id == parts.node, "left").select(
        "key", "doc_id", F.coalesce("component", "doc_id").alias("part")
    )
    counts = labelled.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    split = (
        counts.groupBy("key")
        .agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("key", F.col("top.part").alias("major"), F.col("n"), (F.col("n") - F.col("top.n")).alias("minors"))
    )
    rows = labelled.join(split, "key").join(about, "doc_id")
    place = F.xxhash64("doc_id")
    left_blocks, right_blocks = F.ceil(F.col("minors") / BLOCK).cast("int"), F.ceil(F.col("n") / BLOCK).cast("int")
    own_left, own_right = F.pmod(place, left_blocks).cast("int"), F.pmod(place, right_blocks).cast("int")
    common = ["key", "doc_id", "part", "n_shingles", "sig", "bands"]
    minor = F.col("part") != F.col("major")
    one = (left_blocks == 1) & (right_blocks == 1)
    right = rows.filter(~one).select(*common, F.explode(F.sequence(F.lit(0), left_blocks - 1)).alias("i"), own_right.alias("j"), F.when(minor, 6).otherwise(2).alias("side"))
    left = rows.filter(minor & ~one).select(*common, own_left.alias("i"), F.explode(F.sequence(F.lit(0), right_blocks - 1)).alias("j"), F.lit(5).alias("side"))
    plain = rows.filter(one).select(*common, F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(minor, 7).otherwise(2).alias("side"))
    blocks = left.unionByName(right).unionByName(plain).select("key", "i", "j", "side", "doc_id", "part", "n_shingles", "sig", "bands")
    dealt = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(dealt.columns, kinds)))

    def cast(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(k).cast(t) for k, t in enumerate(kinds)], schema=schema)

    return in_arrow(dealt, lambda batches: alike(cast(batches), schema, percent, least), "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 75, least: float = 0.66) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    sketch = settle(sketches(docs), "sketches")
    full = sketch.filter("n_shingles > 0")
    classes = full.groupBy("k1", "k2").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"))
    classes = settle(classes, "keys")
    member = settle(
        sketch.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2"], "left").select("doc_id", "n_shingles", "rep", "least"),
        "members",
    )
    # From here on a class's node stands in doc_id.
    about = full.join(classes.select("rep"), F.col("row") == F.col("rep"), "left_semi").select(F.col("row").alias("doc_id"), "n_shingles", "sig", "bands")
    about = settle(about, "classes")
    band = about.select("doc_id", F.explode("bands").alias("key"))
    several = band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = settle(band.join(several, "key"), "buckets")
    shared = held.groupBy("doc_id").agg(F.sum("n").alias("weight"))
    pivots = held.select("key", "doc_id").join(shared, "doc_id").groupBy("key").agg(
        F.max(F.struct(F.col("weight"), (-F.col("doc_id")).alias("minus"))).alias("top")
    ).select("key", (-F.col("top.minus")).alias("pivot"))
    stars = held.join(pivots, "key").filter("doc_id != pivot").select(
        F.least("doc_id", "pivot").alias("u"), F.greatest("doc_id", "pivot").alias("v")
    ).distinct()
    wanted = classes.withColumnRenamed("rep", "node").join(held.select(F.col("doc_id").alias("node")).distinct(), "node", "left_semi")
    sets = settle(full_sets(docs, wanted), "sets")
    first = settle(confirm(stars, sets, percent), "links")
    # Rows with one id are one node, so an id also links the classes of its rows.
    known = member.filter("rep is not null").select("doc_id", "rep").distinct()
    several = known.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("top")).filter("u != top").select("doc_id", "u")
    ids = known.join(several, "doc_id").select("u", F.col("rep").alias("v")).filter("u != v")
    parts = settle(components(first), "parts")
    narrow = about.select("doc_id", "n_shingles", "sig", "bands")
    second = settle(confirm(second_round(held, parts, narrow, percent, least), sets, percent), "links")
    tree = parts.select(F.col("component").alias("u"), F.col("node").alias("v"))
    final = components(tree.union(second).union(ids))
    least = final.join(classes.select("rep", "least"), F.col("node") == F.col("rep")).groupBy("component").agg(F.min("least").alias("smallest"))
    named = final.join(least, "component").select("node", "smallest")
    joined = member.join(named, member.rep == named.node, "left")
    component = F.coalesce("smallest", "least", "doc_id")
    real = lambda c: F.when(c != NO_ID, c)
    return joined.select(
        real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(component).alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def deduplicate(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay (one document of each group), with all their columns."""
    name = fresh(docs, "gone")
    gone = near_duplicates(docs, percent).filter("not kept").select(F.coalesce("doc_id", F.lit(NO_ID)).alias(name)).distinct()
    return docs.join(gone, F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == gone[name], "left_anti")
