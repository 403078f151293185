"""Substring dedup: words of windows that occur earlier in the collection, by FM-indexes in shards.

Windows of ``width`` words are routed by content: the smallest hash of a window's ``GRAM``-word
grams names its shard, and neighbouring windows with the same smallest hash travel as one run, so
equal windows meet whatever document they come from. Two filters lose nothing: a smallest hash that
occurs once in the collection belongs to no repeated window, and later copies of whole texts repeat
the first. A shard indexes its runs (a suffix array, and a wavelet matrix over the transform), and
streams them through a backward search: the matching statistics give every window's interval of
suffixes, and with it the earliest occurrence.

Smallest hashes with over ``HOT`` occurrences send their windows one by one, dealt out by content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import bundles
from gleaner.llm.fmindex import FMIndex
from gleaner.llm.text import pack, pack_all, ragged, spread, unpack, unpack_all, unpack_words, windows, words
from gleaner.sources.files import staged

#: Words of a window that counts as repeated, and of a gram.
WIDTH, GRAM = 20, 6
#: Windows of a run at most; occurrences from which a smallest hash is hot; words of a shard.
RUN, HOT, SHARD_WORDS = 32, 10_000, 1_500_000
#: Words travel as so many bits of their hash. Two windows would have to agree in all but words
#: that collide.
BITS = np.uint64((1 << 40) - 1)
ROWS = 500
ONCE, REPEATED, OFTEN = 0, 1, 2


def sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while 2 * width <= span:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = span - width
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs_of(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring windows of one document with the same smallest gram hash: that hash,
    the place of the first window, the number of windows, and of grams with that hash in the run."""
    none = np.zeros(0, np.int64)
    if len(hashes) < width:
        return none, none, none, none
    gram = min(GRAM, width)
    grams = (windows(hashes, gram) >> np.uint64(6)).astype(np.int64)
    span = width - gram + 1
    least = sliding_min(grams, span)
    end = np.repeat(np.cumsum(sizes), sizes)[: len(least)]
    at = np.flatnonzero(np.arange(len(least)) + width <= end)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]])
    begin = np.flatnonzero(new)
    length = np.diff(begin, append=len(at))
    new[ragged(begin, length)] |= (np.arange(len(at)) - np.repeat(begin, length)) % RUN == 0
    begin = np.flatnonzero(new)
    first, n = at[begin], np.diff(begin, append=len(at))
    value = least[first]
    inside = grams[ragged(first, n + span - 1)] == np.repeat(value, n + span - 1)
    starts = np.cumsum(n + span - 1) - (n + span - 1)
    grams_in = np.add.reduceat(inside.astype(np.int32), starts) if len(starts) else none
    return value, first, n, grams_in


def digests(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with at least a window, and two 64-bit halves of a digest of each one's words."""
    rows = np.flatnonzero(sizes >= width)
    ends = np.cumsum(sizes)
    raw = b"".join(hashlib.blake2b(hashes[ends[r] - sizes[r] : ends[r]].tobytes(), digest_size=16).digest() for r in rows)
    return rows, np.frombuffer(raw, np.uint64).reshape(-1, 2)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by bucket, keeping the order inside, and the bounds of each bucket."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def questions(hashes: np.ndarray, sizes: np.ndarray, keys, width: int, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Per bucket: the bundle's distinct smallest hashes with their numbers, and its text digests."""
    value, _, _, n = runs_of(hashes, sizes, width)
    distinct, which = np.unique(value, return_inverse=True)
    number = np.bincount(which, weights=n, minlength=len(distinct)).astype(np.int64)
    rows, digest = digests(hashes, sizes, width)
    ids = ordered_ids(keys)[rows]
    a, a_ends = by_bucket(distinct.view(np.uint64), buckets)
    b, b_ends = by_bucket(digest[:, 0], buckets)
    for bucket in range(buckets):
        own, docs = a[a_ends[bucket] : a_ends[bucket + 1]], b[b_ends[bucket] : b_ends[bucket + 1]]
        if len(own) or len(docs):
            yield bucket, pack_all(
                np.diff(distinct[own], prepend=0), number[own], digest[docs, 0], digest[docs, 1], ids[docs], rows[docs]
            )


def ordered_ids(keys) -> np.ndarray:
    """Ids as integers; rows without id come first."""
    return pc.fill_null(pc.cast(keys, pa.int64()), -(1 << 63)).to_numpy()


def answers(group: pa.Table, often: int) -> pa.Table:
    """All questions of a bucket: whether a smallest hash occurs once, repeatedly or often, and
    whether the same text comes earlier."""
    parts = [
        unpack_all(x.as_py(), np.int64, np.int64, np.uint64, np.uint64, np.int64, np.int64) for x in group["extra"]
    ]
    bundle = group["bundle"].to_numpy()
    value = np.concatenate([np.cumsum(p[0]) for p in parts])
    _, which = np.unique(value, return_inverse=True)
    number = np.bincount(which, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)[which]
    flag = np.where(number > often, OFTEN, np.where(number > 1, REPEATED, ONCE)).astype(np.uint8)
    low, high, ids, rows = (np.concatenate([p[k] for p in parts]) for k in range(2, 6))
    source = np.repeat(bundle, [len(p[2]) for p in parts])
    order = np.lexsort((rows, source, ids, high, low))
    later = np.zeros(len(order), np.uint8)
    later[order[1:]] = (low[order[1:]] == low[order[:-1]]) & (high[order[1:]] == high[order[:-1]])
    a = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])])
    b = np.concatenate([[0], np.cumsum([len(p[2]) for p in parts])])
    replies = [pack_all(flag[a[k] : a[k + 1]], later[b[k] : b[k + 1]]) for k in range(len(parts))]
    flagged = [int((flag[a[k] : a[k + 1]] > 0).sum()) for k in range(len(parts))]
    return pa.table({
        "bundle": group["bundle"], "bucket": group["bucket"], "reply": pa.array(replies, pa.binary()),
        "flagged": pa.array(flagged, pa.int64()),
    })


def content_keys(words_: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each of the word sequences that lie one after another."""
    starts = np.cumsum(lengths) - lengths
    if not len(starts):
        return np.zeros(0, np.uint64)
    power = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
    offset = np.arange(len(words_)) - np.repeat(starts, lengths)
    return spread(np.add.reduceat(spread(words_) * power[offset], starts) + lengths.astype(np.uint64))


class Pieces:
    """What a bundle sends to the shards: its runs that may repeat something, each content once."""

    def __init__(self, bundle: bundles.Bundle, width: int, buckets: int, shards: int):
        own = np.searchsorted(bundle.buckets, [buckets, 2 * buckets])
        told = [unpack_all(r, np.uint8, np.uint8) for r in bundle.replies[: own[0]]]
        lists = [unpack_words(r) for r in bundle.replies[own[0] : own[1]]]
        self.words = pa.concat_arrays([pa.array([], pa.string()), *lists])
        hashes = bundles.word_hashes(self.words)[bundle.words]
        value, first, n, _ = runs_of(hashes, bundle.sizes, width)
        distinct, which = np.unique(value, return_inverse=True)
        flag = np.zeros(len(distinct), np.uint8)
        flag[by_bucket(distinct.view(np.uint64), buckets)[0]] = np.concatenate([np.zeros(0, np.uint8), *(f for f, _ in told)])
        rows, digest = digests(hashes, bundle.sizes, width)
        later = np.zeros(len(rows), np.uint8)
        later[by_bucket(digest[:, 0], buckets)[0]] = np.concatenate([np.zeros(0, np.uint8), *(x for _, x in told)])
        self.copies = rows[later == 1]

        row = np.repeat(np.arange(len(bundle.sizes)), bundle.sizes)
        flag = flag[which]
        use = (flag > 0) & ~np.isin(row[first], self.copies) if len(first) else np.zeros(0, bool)
        value, first, n, flag = value[use], first[use], n[use], flag[use]
        single = flag == OFTEN  # windows one by one
        at = ragged(first[single], n[single])
        self.first = np.concatenate([first[~single], at])
        self.n = np.concatenate([n[~single], np.ones(len(at), np.int64)])
        lengths = self.n + width - 1
        self.hashes = hashes & BITS
        key = content_keys(self.hashes[ragged(self.first, lengths)], lengths)
        route = np.concatenate([value[~single].view(np.uint64), key[np.count_nonzero(~single) :]])
        self.row = row[self.first] if len(self.first) else self.first
        begin = np.cumsum(bundle.sizes) - bundle.sizes
        self.place = self.first - begin[self.row]
        ids = ordered_ids(bundle.keys)
        order = np.lexsort((self.place, self.row, ids[self.row]))
        _, earliest = np.unique(key[order], return_index=True)
        sent = order[np.sort(earliest)]
        self.repeats = np.setdiff1d(np.arange(len(key)), sent)
        shard = (spread(route[sent]) % np.uint64(max(1, shards))).astype(np.int64)
        by_shard = np.argsort(shard, kind="stable")
        self.sent, self.shard, self.ids = sent[by_shard], shard[by_shard], ids
        self.width = width

    def packets(self, bundle: int) -> pa.Table:
        cuts = np.flatnonzero(np.diff(self.shard, prepend=-1))
        rows = []
        for a, b in zip(cuts, np.append(cuts, len(self.shard))[1:], strict=True):
            own = self.sent[a:b]
            text = self.hashes[ragged(self.first[own], self.n[own] + self.width - 1)]
            rows.append(pack_all(
                self.ids[self.row[own]], self.row[own].astype(np.int32), self.place[own].astype(np.int32),
                self.n[own].astype(np.uint8), text,
            ))
        return pa.table({
            "bundle": pa.array([bundle] * len(rows), pa.int64()), "shard": pa.array(self.shard[cuts], pa.int64()),
            "packet": pa.array(rows, pa.binary()),
        })

    def removed(self, masks: np.ndarray, n_words: int, sizes: np.ndarray) -> np.ndarray:
        """Whether each word lies in a window that starts earlier elsewhere."""
        piece = np.concatenate([self.sent, self.repeats])
        mask = np.concatenate([masks.astype(np.int64), (1 << self.n[self.repeats]) - 1])
        every = ragged(self.first[piece], self.n[piece])
        offset = every - np.repeat(self.first[piece], self.n[piece])
        start = every[np.repeat(mask, self.n[piece]) >> offset & 1 == 1]
        change = np.bincount(start, minlength=n_words + 1) - np.bincount(start + self.width, minlength=n_words + 1)
        out = np.cumsum(change)[:n_words] > 0
        ends = np.cumsum(sizes)
        out[ragged((ends - sizes)[self.copies].astype(np.int64), sizes[self.copies].astype(np.int64))] = True
        return out


def search(group: pa.Table, width: int) -> pa.Table:
    """All packets of a shard: index them, stream them through the index, and tell each which of its
    windows start earlier elsewhere, as a bit mask per run."""
    parts = [unpack_all(x.as_py(), np.int64, np.int32, np.int32, np.uint8, np.uint64) for x in group["packet"]]
    sent = [len(p[0]) for p in parts]
    ids, row, place, n, flat = (np.concatenate([p[k] for p in parts]) for k in range(5))
    n = n.astype(np.int64)
    lengths = n + width - 1
    order = np.lexsort((place, row, np.repeat(group["bundle"].to_numpy(), sent), ids))
    key = content_keys(flat, lengths)
    earliest = order[np.sort(np.unique(key[order], return_index=True)[1])]  # in the order of documents
    starts = np.cumsum(lengths) - lengths
    lengths_, n_ = lengths[earliest], n[earliest]
    symbols = 1 + np.unique(flat[ragged(starts[earliest], lengths_)], return_inverse=True)[1].astype(np.int64)
    begin = np.cumsum(lengths_ + 1) - (lengths_ + 1)  # in the text each run ends with a separator
    text = np.zeros(int((lengths_ + 1).sum()), np.int64)
    text[ragged(begin, lengths_)] = symbols
    index = FMIndex(text, width)
    found, low, _ = index.matching_statistics(symbols, lengths_)

    when = np.full(len(text), np.iinfo(np.int64).max)
    inside = ragged(np.zeros(len(n_), np.int64), n_)
    owner = np.repeat(np.arange(len(n_)), n_)
    when[begin[owner] + inside] = owner * 64 + inside
    block, first = index.blocks(width)
    earliest_in = np.minimum.reduceat(when[index.suffixes], first[:-1])
    at = (np.cumsum(lengths_) - lengths_)[owner] + inside
    again = (found[at] == width) & (earliest_in[block[low[at]]] < owner * 64 + inside)
    masks = (1 << n) - 1  # runs that came before, word for word, are repeated whole
    masks[earliest] = np.add.reduceat(again.astype(np.int64) << inside, np.cumsum(n_) - n_)
    cuts = np.concatenate([[0], np.cumsum(sent)])
    replies = [pack(masks[a:b].astype(np.uint32)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.table({"bundle": group["bundle"], "shard": group["shard"], "reply": pa.array(replies, pa.binary())})


def deduplicated(
    docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
    bundle_words: int = bundles.BUNDLE_WORDS, often: int = HOT,
) -> DataFrame:
    """doc_id, n_words, spans (first, last word of each removed stretch), kept (text) of every row.

    A word is removed if a window of ``width`` words that covers it has the same words as one that
    starts earlier: in a document of smaller id, or in the same at an earlier place. Of rows of one
    id, the one that stands first in the table counts as earlier; rows without id come before all
    others. Windows are judged on the input, not on what is left. Kept words are joined by a space.
    Ids must be integers. Null and empty texts have no words; texts shorter than a window stay whole.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("words"))
    table = bundles.bundled(
        df, "substring-bundles", buckets, bundle_words=bundle_words,
        extra=lambda hashes, sizes, keys: questions(hashes, sizes, keys, width, buckets),
    )
    answered = bundles.extra_rows(table).groupBy("bucket").applyInArrow(
        lambda g: answers(g, often), "bundle long, bucket int, reply binary, flagged long"
    )
    answered = staged(answered, "substring-answers")
    flagged = answered.agg(F.sum("flagged")).first()[0] or 0
    shards = max(buckets, flagged * (width + 8) // SHARD_WORDS)
    own = bundles.word_rows(table).select("bundle", (F.col("bucket") + buckets).alias("bucket"), F.col("words").alias("reply"))
    told = answered.select("bundle", "bucket", "reply").unionByName(own)

    def send(bundle: bundles.Bundle) -> pa.Table:
        return Pieces(bundle, width, buckets, shards).packets(bundle.number)

    sent = bundles.assembled(table, told, send, "bundle long, shard long, packet binary")
    found = sent.groupBy("shard").applyInArrow(lambda g: search(g, width), "bundle long, shard long, reply binary")
    found = staged(found, "substring-matches")
    masked = found.select("bundle", (F.col("shard") + 2 * buckets).cast("int").alias("bucket"), "reply")

    def cut(bundle: bundles.Bundle) -> pa.Table:
        pieces = Pieces(bundle, width, buckets, shards)
        replies = bundle.replies[int(np.searchsorted(bundle.buckets, 2 * buckets)) :]
        masks = np.concatenate([np.zeros(0, np.uint32), *(unpack(r, np.uint32) for r in replies)])
        out = pieces.removed(masks, len(bundle.words), bundle.sizes)
        rows = np.concatenate([[0], np.cumsum(bundle.sizes, dtype=np.int64)])
        tables = []
        for a in range(0, len(bundle.sizes), ROWS):
            b = min(a + ROWS, len(bundle.sizes))
            span, ends = slice(rows[a], rows[b]), rows[a : b + 1] - rows[a]
            gone, text = out[span], bundle.words[span]
            left = np.concatenate([[0], np.cumsum(~gone)])[ends]
            lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), pieces.words.take(pa.array(text[~gone])))
            edge = np.zeros(len(gone), bool)
            edge[ends[:-1][np.diff(ends) > 0]] = True
            head = gone & (edge | ~np.concatenate([[False], gone[:-1]]))
            tail = gone & np.append(edge[1:] | ~gone[1:], True)[: len(gone)]
            within = np.arange(len(gone)) - np.repeat(ends[:-1], np.diff(ends))
            spans = pa.StructArray.from_arrays(
                [pa.array(within[head].astype(np.int32)), pa.array(within[tail].astype(np.int32))], ["first", "last"]
            )
            heads = np.concatenate([[0], np.cumsum(head)])[ends]
            tables.append(pa.table({
                "doc_id": bundle.keys[a:b], "n_words": pa.array(np.diff(ends)),
                "spans": pa.ListArray.from_arrays(pa.array(heads, pa.int32()), spans),
                "kept": pc.binary_join(lists, " "),
            }))
        return pa.concat_tables(tables)

    schema = "doc_id long, n_words long, spans array<struct<first:int,last:int>>, kept string"
    return bundles.assembled(table, told.unionByName(masked), cut, schema)
