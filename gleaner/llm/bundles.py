"""Documents in bundles with a word table each, so that words travel once per bundle.

A shuffle of every (document, position, word) would move several times the corpus. Here each
scan task cuts its documents into bundles of a few million words, codes the words of a bundle by
a table of its distinct words, and sends that table, cut by a hash of the word, to the buckets
where all bundles' copies of a word meet. What a bucket has found out about its words goes back
to the bundles, which put it in place by position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.text import give_back, pack, pack_ranks, pack_words, small_batches, tidied, unpack, unpack_ranks
from gleaner.sources.files import staged

#: Words after which a bundle is closed; its documents are held in one task at a time.
BUNDLE_WORDS = 1_000_000

DOCS = -1  # the bucket number of the row that holds a bundle's documents


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def by_frequency(totals: np.ndarray) -> np.ndarray:
    return np.argsort(-totals.astype(np.int64), kind="stable")


@dataclass
class Bundle:
    """One bundle and what the buckets sent back to it, in the order of their numbers.

    ``words``: per position the index of its word among the words of the bundle's word rows.
    """

    number: int
    keys: pa.Array
    sizes: np.ndarray
    tags: np.ndarray
    words: np.ndarray
    buckets: np.ndarray
    replies: list[bytes]


def bundled(
    docs: DataFrame, label: str, buckets: int | None = None, key: str = "doc_id", words: str = "words",
    tag: str | None = None, bundle_words: int = BUNDLE_WORDS, extra: Callable | None = None,
    stage: bool = True,
) -> DataFrame:
    """Columns bundle, bucket, words, counts, keys, sizes, tags, codes, totals, extra.

    Per bundle one row with bucket ``DOCS``: keys, sizes (words of each document), tags, codes (rank
    by frequency of each word) and totals (occurrences of each word, in the order of the word rows).
    And a row per bucket with its distinct words; counts: how often each occurs in documents whose
    tag is 0. ``extra(hashes, sizes, keys)``, of the hashes of all words of a bundle, may yield
    (bucket, bytes) for rows of their own, in column extra.

    The table is written once and bundles are numbered by task. With ``stage=False`` it is made
    anew by whatever reads it, and bundles are numbered by a digest of their words: equal bundles
    get equal replies, and if the rows came in another order, replies would be missing, not wrong.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = F.col(tag).cast("int") if tag else F.lit(0)
    df = docs.select(F.col(key).alias("key"), F.col(words).alias("words"), tagged.alias("tag"))
    kind = df.schema["key"].dataType.simpleString()

    def close(serial: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        lists = whole["words"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
        coded = lists.flatten().dictionary_encode()
        codes, table = coded.indices.to_numpy(), coded.dictionary
        tags = whole["tag"].to_numpy().astype(np.int32)
        keys, kind = whole["key"].combine_chunks(), whole.schema.field("key").type
        del whole, lists, coded
        total = np.bincount(codes, minlength=len(table))
        hashed = word_hashes(table)
        bucket = (hashed % np.uint64(buckets)).astype(np.int64)
        # inside a bucket in alphabetical order, in which neighbours share bytes
        order = pc.sort_indices(table).to_numpy()
        order = order[np.argsort(bucket[order], kind="stable")]
        rank = np.empty(len(table), np.int32)
        rank[order[by_frequency(total[order])]] = np.arange(len(table), dtype=np.int32)
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        counts = np.bincount(codes[np.repeat(tags == 0, sizes)], minlength=len(table)) if tag else None
        rows = []
        for b in np.flatnonzero(np.diff(ends)):
            own = order[ends[b] : ends[b + 1]]
            row = {"bucket": int(b), "words": pack_words(table.take(pa.array(own)))}
            rows.append(row if counts is None else row | {"counts": pack(counts[own])})
        rows += [{"bucket": b, "extra": x} for b, x in extra(hashed[codes], sizes, keys)] if extra else []
        docs_row = {
            "bucket": DOCS, "keys": keys, "sizes": pack(sizes), "tags": pack(tags), "codes": pack_ranks(rank[codes]),
            "totals": pack(total[order].astype(np.int32)),
        }
        if not stage:
            content = hashlib.blake2b(digest_size=8)
            for blob in [*(r["words"] for r in rows), docs_row["codes"], docs_row["sizes"]]:
                content.update(blob)
            serial = int.from_bytes(content.digest(), "little", signed=True)
        for row in [*rows, docs_row]:
            yield packed(serial, row, kind)

    def packed(serial: int, row: dict, key_type: pa.DataType) -> pa.RecordBatch:
        keys = row.get("keys")
        columns = [
            pa.array([serial], pa.int64()), pa.array([row["bucket"]], pa.int32()),
            pa.array([row.get("words")], pa.binary()), pa.array([row.get("counts")], pa.binary()),
            pa.array([None], pa.list_(key_type)) if keys is None
            else pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            *(pa.array([row.get(x)], pa.binary()) for x in names[5:]),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    names = ["bundle", "bucket", "words", "counts", "keys", "sizes", "tags", "codes", "totals", "extra"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        parts, held, closed = [], 0, 0
        for batch in batches:
            sizes = pc.list_value_length(batch["words"]).to_numpy(zero_copy_only=False)
            done = 0
            for row in np.flatnonzero((np.cumsum(sizes) + held) // bundle_words > np.concatenate([[held], np.cumsum(sizes) + held])[:-1] // bundle_words):
                parts.append(batch.slice(done, int(row) + 1 - done))
                yield from close(first + closed, parts)
                parts, done, closed = [], int(row) + 1, closed + 1
            if done < batch.num_rows:
                parts.append(batch.slice(done))
            held = (held + int(sizes.sum())) % bundle_words
        if parts:
            yield from close(first + closed, parts)

    schema = (
        f"bundle long, bucket int, words binary, counts binary, keys array<{kind}>, sizes binary, "
        "tags binary, codes binary, totals binary, extra binary"
    )
    table = df.mapInArrow(tidied(run), schema)
    return staged(table, label) if stage else table


def word_rows(table: DataFrame) -> DataFrame:
    return table.filter("words IS NOT NULL").select("bundle", "bucket", "words", "counts")


def extra_rows(table: DataFrame) -> DataFrame:
    return table.filter("extra IS NOT NULL").select("bundle", "bucket", "extra")


def assembled(table: DataFrame, replies: DataFrame, put: Callable, schema: str) -> DataFrame:
    """Bring the replies (bundle, bucket, reply binary) back to their bundles.

    ``put(bundle)`` gets a ``Bundle`` and returns an Arrow table of the given schema.
    """
    none = F.lit(None).cast("binary").alias("reply")
    docs = table.filter(F.col("bucket") == DOCS).select("bundle", "bucket", "keys", "sizes", "tags", "codes", "totals", none)
    kind = table.schema["keys"].dataType.simpleString()
    blank = [F.lit(None).cast("binary").alias(x) for x in ("sizes", "tags", "codes", "totals")]
    own = replies.select("bundle", "bucket", F.lit(None).cast(kind).alias("keys"), *blank, "reply")

    def one(group: pa.Table) -> pa.Table:
        at = group["bucket"].to_numpy()
        numbers, first = np.unique(at, return_index=True)
        buckets, first = numbers[numbers != DOCS], first[numbers != DOCS]
        replies = [group["reply"][int(i)].as_py() for i in first]
        out = []
        for i in np.flatnonzero(at == DOCS):
            row = group.slice(int(i), 1)
            blob = lambda name: unpack(row[name][0].as_py(), np.int32)  # noqa: B023, E731
            words = by_frequency(blob("totals"))[unpack_ranks(row["codes"][0].as_py())].astype(np.int32)
            keys = row["keys"].combine_chunks().flatten()
            out.append(put(Bundle(row["bundle"][0].as_py(), keys, blob("sizes"), blob("tags"), words, buckets, replies)))
        made = pa.concat_tables(out)
        del out, replies, group
        give_back()
        return made

    return docs.unionByName(own).groupBy("bundle").applyInArrow(one, schema)
