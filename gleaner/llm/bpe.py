"""Byte-pair encoding and decoding by a public tokenizer's vocabulary.

Spark splits texts into pre-tokens ("words"); each distinct word meets its copies in one bucket
and is encoded there once; the ids join the documents back by position (see ``bundles``). Decoding
joins ids to the byte pieces of the vocabulary.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import bundles
from gleaner.llm.text import pack_all, ragged, tidied, unpack_all, unpack_words

#: Documents that a task turns into ids or texts at a time.
ROWS = 500
#: Words that are encoded in one call of the library.
ENCODED = 20_000

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.no_padding()
    loaded.no_truncation()
    return loaded


@lru_cache(maxsize=4)
def specials(path: str) -> tuple[str, ...]:
    """Strings of the vocabulary file that stand for one id wherever a text holds them."""
    with open(path, encoding="utf-8") as file:
        return tuple(token["content"] for token in json.load(file)["added_tokens"])


@lru_cache(maxsize=4)
def pieces(path: str) -> pa.Array:
    """The bytes of each id; ids that the vocabulary lacks have none."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in keep}
    byte |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    known = {i: bytes(byte[c] for c in token) for token, i in vocabulary.items()}
    return pa.array([known.get(i, b"") for i in range(max(known) + 1)], pa.binary())


def split(text: Column, path: str = BYTE_BPE) -> Column:
    """The pre-tokens of a text, special strings apart, in order; no array element is empty."""
    pattern = F.lit(f"(?U){public_tokenizers.PATTERN}")
    plain = lambda part: F.regexp_extract_all(part, pattern, F.lit(0))
    out = plain(text)
    for special in specials(path):
        parts = F.split(text, rf"\Q{special}\E")
        joined = F.flatten(
            F.transform(parts, lambda p, i: F.when(i == 0, plain(p)).otherwise(F.concat(F.array(F.lit(special)), plain(p))))
        )
        out = F.when(F.contains(text, F.lit(special)), joined).otherwise(out)
    return out


def encode(
    docs: DataFrame, path: str = BYTE_BPE, id_col: str = "doc_id", text_col: str = "text",
    bundle_words: int = bundles.BUNDLE_WORDS,
) -> DataFrame:
    """doc_id and ``ids array<int>`` of every row, as the tokenizers library encodes the whole text
    without adding special tokens. Null and empty texts have no ids; repeated rows stay."""
    if len(specials(path)) > 1:
        raise ValueError("vocabularies with one special string at most")
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # split twice rather than written: the bundles would take as much again as the shuffles
    table = bundles.bundled(
        df.select("doc_id", split(F.col("text"), path).alias("words")), "bpe", bundle_words=bundle_words, stage=False
    )

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of buckets: every word of a bucket that has not come by yet is encoded, once. Ids are kept as
        bytes, a quarter of what lists of integers take."""
        known: dict[str, bytes] = {}
        at, loaded = None, tokenizer(path)
        for batch in batches:
            replies = []
            for bucket, blob in zip(batch["bucket"].to_pylist(), batch["words"], strict=True):
                if bucket != at:
                    known, at = {}, bucket
                words = unpack_words(blob.as_py()).to_pylist()
                new = [w for w in words if w not in known]
                for cut in range(0, len(new), ENCODED):
                    some = new[cut : cut + ENCODED]
                    coded = loaded.encode_batch(some, add_special_tokens=False)
                    known.update(zip(some, (array("i", x.ids).tobytes() for x in coded), strict=True))
                found = [known[w] for w in words]
                lengths = np.fromiter(map(len, found), np.int32, len(found)) // 4
                replies.append(pack_all(lengths, np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch["bundle"], batch["bucket"], pa.array(replies, pa.binary())], ["bundle", "bucket", "reply"]
            )

    def put(bundle: bundles.Bundle) -> pa.Table:
        parts = [unpack_all(r, np.int32, np.int32) for r in bundle.replies]
        lengths = np.concatenate([np.zeros(0, np.int32), *(a for a, _ in parts)])
        flat = np.concatenate([np.zeros(0, np.int32), *(b for _, b in parts)])
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        if len(bundle.words) and bundle.words.max() >= len(lengths):
            raise ValueError("the input's rows came in another order the second time")
        rows = np.concatenate([[0], np.cumsum(bundle.sizes, dtype=np.int64)])
        parts = []
        for a in range(0, len(bundle.sizes), ROWS):  # in parts, since the indexes take more than the ids
            b = min(a + ROWS, len(bundle.sizes))
            own = bundle.words[rows[a] : rows[b]]
            ids = flat[ragged(starts[own], lengths[own])]
            ends = np.concatenate([[0], np.cumsum(lengths[own], dtype=np.int64)])[rows[a : b + 1] - rows[a]]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
            parts.append(pa.table({"doc_id": bundle.keys[a:b], "ids": lists}))
        return pa.concat_tables(parts)

    rows = bundles.word_rows(table).select("bundle", "bucket", "words").repartition("bucket").sortWithinPartitions("bucket")
    replies = rows.mapInArrow(tidied(encode_words), "bundle long, bucket int, reply binary")
    kind = df.schema["doc_id"].dataType.simpleString()
    return bundles.assembled(table, replies, put, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str = BYTE_BPE, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` (in place of one of that name): the bytes of the ids' pieces, one after another, as
    UTF-8; broken sequences become U+FFFD. Null ids give an empty text.

    The piece table is as large as the vocabulary, whatever the number of rows, so each task holds
    it and joins by index.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces(path)
        for whole in batches:
            for cut in range(0, whole.num_rows, ROWS):
                batch = whole.slice(cut, ROWS)
                lists = pc.fill_null(batch[ids_col], pa.scalar([], batch.schema.field(ids_col).type))
                offsets = lists.offsets.to_numpy()
                parts = table.take(lists.flatten())
                bounds = parts.offsets.to_numpy() if hasattr(parts, "offsets") else np.frombuffer(parts.buffers()[1], np.int32)
                raw = memoryview(parts.buffers()[2] or b"")
                cuts = bounds[offsets - offsets[0]]
                texts = [bytes(raw[a:b]).decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
                )

    encoded = encoded.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(tidied(join), f"{schema}, decoded string")
