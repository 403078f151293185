"""MinHash near-duplicates by a multi-index Hamming join.

1. One scan turns every text into its set of word shingles, a digest of the set, and a signature
   of ``CHUNKS * WIDTH`` 16-bit minimum hashes. Equal sets form one class; classes go on.
2. Multi-index: signatures are cut into ``CHUNKS`` chunks. Two signatures that differ in fewer than
   ``CHUNKS * (ERRORS + 1)`` places have a chunk with at most ``ERRORS`` differences (pigeonhole),
   so they agree in one of the chunk's variants with ``ERRORS`` places left out: those are the keys.
3. Inside a bucket, leaders stand for those within ``NEAR`` differences; everything within ``NEAR``
   + ``DISTANCE`` of a leader is tied to it. By the triangle inequality two signatures within
   ``DISTANCE`` end up in one cluster, and no bucket emits its pairs.
4. Clusters are cut into blocks. Block by block the links are confirmed on full sets; only links
   that join something new are kept. Between blocks, only documents outside the cluster's largest
   component so far are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.components import components
from gleaner.llm.text import ascii_lower, hashes, ragged, small_batches, spread, tidied, windows, words
from gleaner.sources.files import staged

CHUNKS, WIDTH, ERRORS = 10, 5, 1
#: Signatures that differ in more places are not taken for candidates. A pair of similarity 0.8
#: differs in 10 of 50 places on average; over 25 happens once in ten million such pairs.
DISTANCE = 25
NEAR = 10
#: A bucket is worked off in parts of this many signatures, a cluster in blocks of as many sets.
PART, BLOCK, BLOCK_SHINGLES = 4096, 1024, 2_000_000

PLACES = CHUNKS * WIDTH
_random = np.random.default_rng(20)
FACTORS = _random.integers(1, 2**63, PLACES, dtype=np.uint64) | np.uint64(1)
SHIFTS = _random.integers(0, 2**63, PLACES, dtype=np.uint64)


def shingle_sets(lists: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one after another, and how many each has.

    A row with words, but fewer than ``size``, has all of them as its one shingle.
    """
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    ends = ends - ends[0]
    rolled = windows(flat, size)
    found = []
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        if b - a >= size:
            found.append(np.unique(rolled[a : b - size + 1]))
        else:
            found.append(windows(flat[a:b], b - a) if b > a else flat[:0])
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.concatenate([np.zeros(0, np.uint64), *found]), sizes


def signatures(flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of ``PLACES`` 16-bit minimum hashes for each set; sets must not be empty."""
    out = np.empty((len(sizes), PLACES), np.uint16)
    if not len(sizes):
        return out
    starts = np.cumsum(sizes) - sizes
    for k in range(PLACES):
        least = np.minimum.reduceat((flat ^ SHIFTS[k]) * FACTORS[k], starts)
        out[:, k] = (spread(least) >> np.uint64(48)).astype(np.uint16)
    return out


def sketched(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, digest and signature (both null without words) of every row; staged."""
    df = docs.select(F.col(id_col).alias("doc_id"), hashes(words(ascii_lower(F.col(text_col)))).alias("words"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                flat, sizes = shingle_sets(batch["words"], size)
                ends = np.cumsum(sizes)
                some = np.flatnonzero(sizes)
                rows = iter(signatures(flat, sizes[some]))
                signed = [next(rows).tobytes() if n else None for n in sizes]
                digests = [
                    hashlib.blake2b(flat[b - n : b].tobytes(), digest_size=16).digest() if n else None
                    for n, b in zip(sizes, ends, strict=True)
                ]
                columns = [batch["doc_id"], pa.array(sizes), pa.array(digests, pa.binary()), pa.array(signed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "signature"])

    schema = f"doc_id {kind}, n_shingles long, digest binary, signature binary"
    return staged(df.mapInArrow(tidied(run), schema), "neardup-sketches")


def signature_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, rep): every variant of every chunk with ``ERRORS`` places left out."""
    kind = classes.schema["rep"].dataType.simpleString()
    kept = [
        [chunk * WIDTH + i for i in places]
        for chunk in range(CHUNKS) for places in combinations(range(WIDTH), WIDTH - ERRORS)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = signature_matrix(batch["signature"]).astype(np.uint64)
            for serial, columns in enumerate(kept):
                key = np.full(len(signed), serial + 1, np.uint64)
                for c in columns:
                    key = spread(key * np.uint64(65536) + signed[:, c] + (key >> np.uint64(48)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch["rep"]], ["key", "rep"])

    return classes.select("rep", "signature").mapInArrow(tidied(run), f"key long, rep {kind}")


def joined(signed: np.ndarray) -> np.ndarray:
    """For the rows of one bucket's signatures, the first row of each one's cluster.

    Leaders are taken in order of the rows from those not yet within ``NEAR`` of one.
    """
    first = np.arange(len(signed))
    if len(signed) == 2:
        first[1] = 0 if (signed[0] != signed[1]).sum() <= DISTANCE else 1
        return first
    open_ = np.ones(len(signed), bool)
    while open_.any() and first.any():
        leader = int(np.argmax(open_))
        apart = (signed != signed[leader]).sum(1)
        together = np.unique(first[apart <= NEAR + DISTANCE])
        first[np.isin(first, together)] = together[0]
        open_ &= apart > NEAR
    return first


def candidate_ties(classes: DataFrame) -> DataFrame:
    """(u, v): ties whose connected components are the clusters."""
    kind = classes.schema["rep"].dataType.simpleString()
    keys = index_keys(classes)
    several = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("root")).filter("n > 1")
    # a hot bucket is dealt out in parts, whose clusters are all tied to the bucket's first member
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / PART)).cast("int")
    members = keys.join(several, "key").select("key", part.alias("part"), "rep", (F.col("n") > PART).alias("hot"), "root")
    members = members.join(classes.select("rep", "signature"), "rep")
    members = members.repartition("key", "part").sortWithinPartitions("key", "part", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch])
            last = cuts(table)[-2]
            held = table.slice(int(last)).combine_chunks().to_batches()
            if last:
                yield from buckets(table.slice(0, int(last)))
        if held:
            yield from buckets(pa.Table.from_batches(held))

    def cuts(table: pa.Table) -> np.ndarray:
        key, part = table["key"].to_numpy(), table["part"].to_numpy()
        new = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        return np.concatenate([[0], new, [len(key)]])

    def buckets(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        signed, reps, ends = signature_matrix(table["signature"].combine_chunks()), table["rep"].combine_chunks(), cuts(table)
        hot = table["hot"].to_numpy()
        first = np.concatenate([a + joined(signed[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)])
        tied = np.flatnonzero(first != np.arange(len(first)))
        yield pa.RecordBatch.from_arrays([reps.take(pa.array(tied)), reps.take(pa.array(first[tied]))], ["u", "v"])
        at = pa.array(np.flatnonzero((first == np.arange(len(first))) & hot))
        yield pa.RecordBatch.from_arrays([reps.take(at), table["root"].combine_chunks().take(at)], ["u", "v"])

    return members.mapInArrow(tidied(run), f"u {kind}, v {kind}").filter("u <> v").distinct()


def links_between(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int, skip=None):
    """Pairs of row numbers that are similar and join two components not joined before."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate([np.zeros(0, np.uint64), *(sets[j] for j in right)])
    owner = np.repeat(right, sizes[right])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    for i in left:
        a, b = np.searchsorted(flat, sets[i], "left"), np.searchsorted(flat, sets[i], "right")
        shared = np.bincount(owner[ragged(a, b - a)], minlength=len(sets))
        similar = np.flatnonzero((shared > 0) & (100 * shared >= percent * (sizes[i] + sizes - shared)))
        for j in similar:
            if j != i and (skip is None or skip[i] != skip[j]) and (x := root(int(i))) != (y := root(int(j))):
                parent[x] = y
                yield int(i), int(j)


def confirmed_links(docs: DataFrame, clusters: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(u, v): links of at least the similarity, enough of them to connect all that are linked.

    ``clusters``: rep, digest, n_shingles, cluster.
    """
    kind = clusters.schema["rep"].dataType.simpleString()
    sizes = clusters.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    placed = clusters.join(sizes, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("text"))
    # never broadcast: the table of clusters grows with the documents
    worded = texts.join(placed.drop("n_shingles").hint("merge"), "rep").withColumn("words", hashes(words(ascii_lower(F.col("text"))))).drop("text")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, sizes = shingle_sets(batch["words"], size)
            ends = np.cumsum(sizes)
            blobs = [flat[b - n : b].tobytes() for n, b in zip(sizes, ends, strict=True)]
            same = [hashlib.blake2b(x, digest_size=16).digest() == d for x, d in zip(blobs, batch["digest"].to_pylist(), strict=True)]
            columns = [batch[c] for c in ("rep", "cluster", "blocks", "block")]
            made = pa.RecordBatch.from_arrays([*columns, pa.array(blobs, pa.binary())], ["rep", "cluster", "blocks", "block", "set"])
            yield made.filter(pa.array(same))

    schema = f"rep {kind}, cluster {kind}, blocks int, block int, set binary"
    sets = staged(worded.mapInArrow(tidied(rebuild), schema), "neardup-sets")

    def answer(reps: pa.Array, found: list[tuple[int, int]]) -> pa.Table:
        at = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"u": reps.take(pa.array(at[:, 0])), "v": reps.take(pa.array(at[:, 1]))})

    def within(group: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in group["set"].to_pylist()]
        all_ = np.arange(len(own))
        return answer(group["rep"].combine_chunks(), list(links_between(own, all_, all_, percent)))

    first = staged(sets.groupBy("cluster", "block").applyInArrow(within, f"u {kind}, v {kind}"), "neardup-links")

    # documents of large clusters that the blocks have not tied to the cluster's largest component
    large = sets.filter("blocks > 1").join(components(first, "u", "v").withColumnRenamed("node", "rep"), "rep", "left")
    large = large.withColumn("component", F.coalesce("component", "rep"))
    counted = large.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = counted.groupBy("cluster").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
    large = large.join(main, "cluster")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = large.filter("component <> main").select("*", F.lit(True).alias("is_left"), F.col("block").alias("i"), F.explode(every).alias("j"))
    wanted = left.select("cluster", "i").distinct()
    right = large.join(wanted, "cluster").select(*large.columns, F.lit(False).alias("is_left"), "i", F.col("block").alias("j"))

    def across(group: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in group["set"].to_pylist()]
        is_left = group["is_left"].to_numpy()
        codes = group["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        found = links_between(own, np.flatnonzero(is_left), np.flatnonzero(~is_left), percent, codes)
        return answer(group["rep"].combine_chunks(), list(found))

    columns = ["cluster", "i", "j", "rep", "component", "is_left", "set"]
    second = left.select(columns).unionByName(right.select(columns))
    second = second.groupBy("cluster", "i", "j").applyInArrow(across, f"u {kind}, v {kind}")
    return first.unionByName(second)


def grouped(
    docs: DataFrame, size: int = 2, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked if ``100 * intersection >= percent * union`` of their sets of ``size``-word
    shingles (A-Z lower-cased). component_id is the smallest id that links reach, kept whether it is
    the row's own. Texts without words, null texts and rows without id are linked with nothing; such
    rows are kept, with their own id. Rows of one id and one text share their result; where one id
    leads two classes of texts, it stands for both. ``percent`` under 70 needs a larger DISTANCE.
    """
    small_batches(docs.sparkSession)
    sketches = sketched(docs, size, id_col, text_col)
    linked = sketches.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = linked.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles")
    )
    classes = staged(classes, "neardup-classes")
    clusters = components(candidate_ties(classes), "u", "v").select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    clusters = staged(classes.select("rep", "digest", "n_shingles").join(clusters, "rep"), "neardup-clusters")
    found = components(confirmed_links(docs, clusters, size, percent, id_col, text_col), "u", "v")
    named = classes.select("digest", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("component", "rep").alias("component"))
    out = linked.join(named, "digest").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    alone = sketches.filter("digest IS NULL OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    kept = F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    return out.unionByName(alone).withColumn("kept", kept)


def dedup(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose document is linked to a smaller id. All columns stay.

    Rows are dropped by id, so two rows of one id stay or go together.
    """
    gone = grouped(docs, size, percent, id_col, text_col).filter("NOT kept").select("doc_id").distinct()
    return docs.alias("docs").join(gone.alias("gone"), F.expr(f"docs.`{id_col}` = gone.doc_id"), "left_anti")
