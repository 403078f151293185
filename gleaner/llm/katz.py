"""Katz backoff scores of documents, from Good-Turing discounted unigram and bigram counts.

A document is its words and one end; the first word follows a start. Counts come from the documents
marked for training, scores go to all.

Words are counted in buckets by word, bigrams in buckets by history, each fed by bundles that have
pre-aggregated theirs (see ``bundles``). Histories with over ``HOT`` occurrences are dealt out by
both words, and their sums are put together by a grouped sum. Bundles get the counts back and
evaluate each token: bigram if seen, else backoff weight times unigram, else the unknown word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm import bundles
from gleaner.llm.text import ascii_lower, pack_all, spread, unpack, unpack_all, unpack_words, words
from gleaner.sources.files import staged

#: Counts up to this are discounted by Good-Turing, larger ones by a constant.
TURING = 5
#: Occurrences from which a history is dealt out over all buckets, and tokens to a bigram bucket.
HOT, BUCKET_TOKENS = 1_000_000, 3_000_000

END = "\n"  # no word, since it is a separator
START_ID = 0

UNIGRAMS = "bundle long, bucket int, reply binary, stats array<long>"
BIGRAMS = "kind int, bundle long, bucket int, reply binary, history long, sums array<double>"
REPLY, STATS, PARTIAL, REQUEST = range(4)


class Discounts:
    """From the numbers of n-grams that occur once, twice, ... ``TURING`` + 1 times.

    Katz's formula; where the numbers give no value between 0 and 1, half a count is taken off.
    Counts above lose a constant, so that every history has something left for unseen words.
    """

    def __init__(self, numbers: list[int]):
        n = [0, *(int(x) for x in numbers)]
        k = TURING
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 0.0
        self.ratio = np.ones(k + 1)
        for r in range(1, k + 1):
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0.0
            self.ratio[r] = d if 0 < d < 1 else (r - 0.5) / r
        self.constant = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        low = np.minimum(counts, TURING).astype(np.int64)
        return np.where(counts > TURING, counts - self.constant, self.ratio[low] * counts)

    def freed(self, types: np.ndarray) -> np.ndarray:
        """Counts taken off, given how many types occur once, twice, ... TURING, and more times."""
        per_type = np.append((1 - self.ratio[1:]) * np.arange(1, TURING + 1), self.constant)
        return types @ per_type


class Unigrams:
    """Probabilities of words by their training count; what is taken off is the unknown word's."""

    def __init__(self, stats: list[int]):
        self.distinct, self.total, self.documents, *numbers = stats
        self.discounts = Discounts(numbers)
        types = np.array([*numbers[:TURING], self.distinct - sum(numbers[:TURING])], np.float64)
        self.unknown = float(self.discounts.freed(types)) / self.total if self.total else 1.0

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.discounted(counts) / max(1, self.total), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.total + 0.1 * (self.distinct + 1)))


def count_words(group: pa.Table, buckets: int) -> pa.Table:
    """All word rows of a bucket: to each, ids and training counts of its words; and the statistics
    (distinct, total, documents, words that occur 1 .. TURING + 1 times)."""
    lists = [unpack_words(x.as_py()) for x in group["words"]]
    own = [unpack(x.as_py(), np.int64) for x in group["counts"]]
    coded = pa.concat_arrays(lists).dictionary_encode()
    codes, table = coded.indices.to_numpy(), coded.dictionary
    total = np.bincount(codes, weights=np.concatenate(own), minlength=len(table)).astype(np.int64)
    rank = np.empty(len(table), np.int64)
    rank[pc.sort_indices(table).to_numpy()] = np.arange(len(table))
    bucket = group["bucket"][0].as_py()
    ids = 1 + rank[codes] * buckets + bucket  # word rows are sorted, so their ids ascend
    replies, at = [], 0
    for words_ in lists:
        cut = slice(at, at + len(words_))
        replies.append(pack_all(np.diff(ids[cut], prepend=0), total[codes[cut]]))
        at += len(words_)
    end = pc.index(table, END).as_py()
    stats = [int((total > 0).sum()), int(total.sum()), int(total[end]) if end >= 0 else 0]
    stats += [int((total == r).sum()) for r in range(1, TURING + 2)]
    return pa.table({
        "bundle": pa.concat_arrays([group["bundle"].combine_chunks(), pa.array([-1], pa.int64())]),
        "bucket": pa.array([bucket] * (len(replies) + 1), pa.int32()),
        "reply": pa.array([*replies, None], pa.binary()),
        "stats": pa.array([None] * len(replies) + [stats], pa.list_(pa.int64())),
    })


class Tokens:
    """A bundle's tokens with ids and counts, and its distinct bigrams in the order of buckets."""

    def __init__(self, bundle: bundles.Bundle, replies: list[bytes], unigrams: Unigrams, buckets: int, hot: int = HOT):
        parts = [unpack_all(r, np.int64, np.int64) for r in replies]
        ids = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(d) for d, _ in parts)])
        counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in parts)])
        self.word, self.count = ids[bundle.words], counts[bundle.words]
        self.starts = np.cumsum(bundle.sizes) - bundle.sizes
        history, history_count = np.roll(self.word, 1), np.roll(self.count, 1)
        history[self.starts], history_count[self.starts] = START_ID, unigrams.documents
        mixed = spread(history)
        often = history_count > hot
        mixed[often] = spread(mixed[often] + self.word[often].view(np.uint64))
        bucket = (mixed % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((self.word, history, bucket))
        h, w = history[order], self.word[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
        first = order[new]
        self.bigram = np.empty(len(order), np.int64)
        self.bigram[order] = np.cumsum(new) - 1
        learns = np.repeat(bundle.tags == 0, bundle.sizes)
        self.trained = np.bincount(self.bigram[learns], minlength=len(first)).astype(np.int32)
        self.h, self.w, self.c_h, self.c_w, self.bucket = (
            x[first] for x in (history, self.word, history_count, self.count, bucket)
        )


def packets(tokens: Tokens, bundle: int) -> pa.Table:
    cuts = np.flatnonzero(np.diff(tokens.bucket, prepend=-1))
    rows = []
    for a, b in zip(cuts, np.append(cuts, len(tokens.bucket))[1:], strict=True):
        h, w = tokens.h[a:b], tokens.w[a:b]
        new = np.diff(h, prepend=-1) != 0
        steps = np.where(new, w, np.diff(w, prepend=0))  # words ascend within a history
        starts = np.flatnonzero(new)
        rows.append((int(tokens.bucket[a]), pack_all(
            np.diff(h[starts], prepend=0), np.diff(starts, append=b - a), tokens.c_h[a:b][starts], steps,
            tokens.trained[a:b], tokens.c_w[a:b],
        )))
    return pa.table({
        "bundle": pa.array([bundle] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int32()),
        "packet": pa.array([r[1] for r in rows], pa.binary()),
    })


def unpacked(packet: bytes) -> tuple[np.ndarray, ...]:
    """h, w, trained, c_h, c_w of each bigram."""
    dh, runs, c_h, steps, trained, c_w = unpack_all(packet, np.int64, np.int64, np.int64, np.int64, np.int32, np.int64)
    summed = np.cumsum(steps)
    starts = np.cumsum(runs) - runs
    w = summed - np.repeat(summed[starts] - steps[starts], runs)
    return np.repeat(np.cumsum(dh), runs), w, trained, np.repeat(c_h, runs), c_w


def per_history(h: np.ndarray, count: np.ndarray, unigram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct histories of sorted bigrams, and for each: the seen types that occur 1 .. TURING and
    more times, and the sum of the unigram probabilities of its seen words."""
    starts = np.flatnonzero(np.diff(h, prepend=-1))
    columns = [np.where(count == r, 1.0, 0.0) for r in range(1, TURING + 1)]
    columns += [np.where(count > TURING, 1.0, 0.0), np.where(count > 0, unigram, 0.0)]
    return h[starts], np.stack([np.add.reduceat(c, starts) for c in columns], 1)


def count_bigrams(group: pa.Table, unigrams: Unigrams, often: int = HOT) -> pa.Table:
    """All packets of a bucket: to each the counts of its bigrams, and the sums of those of its
    histories that back off; statistics; sums of hot histories; and who needs those."""
    bundles_ = group["bundle"].to_pylist()
    parts = [unpacked(x.as_py()) for x in group["packet"]]
    sizes = [len(p[0]) for p in parts]
    h, w, trained, c_h, c_w = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((w, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(new) - 1
    first = order[new]
    count = np.bincount(at, weights=trained, minlength=len(first)).astype(np.int64)
    histories, sums = per_history(h[first], count, unigrams.of(c_w[first]))
    hot = c_h[first][np.flatnonzero(np.diff(h[first], prepend=-1))] > often
    rows = {"kind": [], "bundle": [], "bucket": [], "reply": [], "history": [], "sums": []}

    def row(kind, bundle=None, reply=None, history=None, sums=None):
        for name, x in zip(rows, (kind, bundle, group["bucket"][0].as_py(), reply, history, sums), strict=True):
            rows[name].append(x)

    begin = 0
    for bundle, size in zip(bundles_, sizes, strict=True):
        own = slice(begin, begin + size)
        begin += size
        counts = count[at[own]]
        needed = np.unique(h[own][(counts == 0) & (c_h[own] > 0)])
        which = np.searchsorted(histories, needed)
        cold = which[~hot[which]]
        row(REPLY, bundle, pack_all(
            counts, histories[cold], sums[cold, :-1].astype(np.int64).ravel(), np.ascontiguousarray(sums[cold, -1])
        ))
        for n in which[hot[which]]:
            row(REQUEST, bundle, history=int(histories[n]))
    for n in np.flatnonzero(hot):
        row(PARTIAL, history=int(histories[n]), sums=sums[n].tolist())
    row(STATS, sums=[float((count == r).sum()) for r in range(1, TURING + 2)])
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.float64()))
    return pa.table({name: pa.array(x, t) for (name, x), t in zip(rows.items(), types, strict=True)})


def logs(tokens: Tokens, replies: list[bytes], hot: list[bytes], unigrams: Unigrams, discounts: Discounts) -> np.ndarray:
    """log10 of each distinct bigram's probability."""
    parts = [unpack_all(r, np.int64, np.int64, np.int64, np.float64) for r in replies]
    parts += [[np.zeros(0, np.int64), *unpack_all(r, np.int64, np.int64, np.float64)] for r in hot]
    count = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
    histories = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
    types = np.concatenate([np.zeros(0, np.int64), *(p[2] for p in parts)]).reshape(-1, TURING + 1)
    seen = np.concatenate([np.zeros(0), *(p[3] for p in parts)])
    order = np.argsort(histories)
    histories, left = histories[order], (discounts.freed(types.astype(np.float64)) / np.maximum(1e-300, 1 - seen))[order]
    at = np.minimum(np.searchsorted(histories, tokens.h), max(0, len(histories) - 1))
    unigram = unigrams.of(tokens.c_w)
    total = np.maximum(tokens.c_h, 1)
    backoff = (left[at] / total if len(left) else 1.0) * unigram
    return np.log10(np.where(count > 0, discounts.discounted(count) / total, np.where(tokens.c_h > 0, backoff, unigram)))


def held_out(key: Column) -> Column:
    """A tenth of the documents, by a checksum of the id; also those without id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 10 == 0, F.lit(True))


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held: Column | None = None,
    bundle_words: int = bundles.BUNDLE_WORDS, often: int = HOT,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Rows for which ``held`` is false are learned from. score: sum of the log10 probabilities of the
    tokens; n_known: tokens whose word occurs in training; base_score: the same sum for unigrams with
    a tenth added to every count. Null and empty texts are one end; repeated rows count and are scored
    each. Without a training row, every word is the unknown one, of probability 1 for ``score``.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key, text = F.col(id_col), F.col(text_col)
    df = docs.select(
        key.alias("doc_id"), (held_out(key) if held is None else held).alias("held_out"),
        F.concat(words(ascii_lower(text)), F.array(F.lit(END))).alias("words"),
    )
    kind = df.schema["doc_id"].dataType.simpleString()
    table = bundles.bundled(df, "katz-bundles", buckets, tag="held_out", bundle_words=bundle_words)
    counted = bundles.word_rows(table).groupBy("bucket").applyInArrow(lambda g: count_words(g, buckets), UNIGRAMS)
    counted = staged(counted, "katz-unigrams")
    sums = counted.filter("stats IS NOT NULL").agg(*[F.sum(F.col("stats")[i]) for i in range(TURING + 4)]).first()
    unigrams = Unigrams([x or 0 for x in sums])
    pair_buckets = max(buckets, unigrams.total // BUCKET_TOKENS)
    replies = counted.filter("reply IS NOT NULL").select("bundle", "bucket", "reply")

    def send(bundle: bundles.Bundle) -> pa.Table:
        return packets(Tokens(bundle, bundle.replies, unigrams, pair_buckets, often), bundle.number)

    sent = bundles.assembled(table, replies, send, "bundle long, bucket int, packet binary")
    paired = staged(sent.groupBy("bucket").applyInArrow(lambda g: count_bigrams(g, unigrams, often), BIGRAMS), "katz-bigrams")
    sums = paired.filter(F.col("kind") == STATS).agg(*[F.sum(F.col("sums")[i]) for i in range(TURING + 1)]).first()
    discounts = Discounts([x or 0 for x in sums])

    hot = paired.filter(F.col("kind") == PARTIAL).groupBy("history").agg(
        F.array(*[F.sum(F.col("sums")[i]) for i in range(TURING + 2)]).alias("sums")
    )
    asked = paired.filter(F.col("kind") == REQUEST).select("bundle", "history").distinct().join(hot, "history")

    # a bundle holds few histories that are hot in the whole collection
    asked = asked.groupBy("bundle").agg(F.collect_list(F.struct("history", "sums")).alias("told"))

    def hot_reply(batches):
        for batch in batches:
            out = []
            for told in batch["told"].to_pylist():
                sums = np.array([x["sums"] for x in told])
                types = sums[:, :-1].astype(np.int64).ravel()
                out.append(pack_all(np.array([x["history"] for x in told]), types, np.ascontiguousarray(sums[:, -1])))
            yield pa.RecordBatch.from_arrays([batch["bundle"], pa.array(out, pa.binary())], ["bundle", "reply"])

    asked = asked.mapInArrow(hot_reply, "bundle long, reply binary")
    asked = asked.select("bundle", F.lit(buckets + pair_buckets).alias("bucket"), "reply")
    own = paired.filter(F.col("kind") == REPLY).select("bundle", (F.col("bucket") + buckets).alias("bucket"), "reply")

    def evaluate(bundle: bundles.Bundle) -> pa.Table:
        a, b = np.searchsorted(bundle.buckets, [buckets, buckets + pair_buckets])
        tokens = Tokens(bundle, bundle.replies[:a], unigrams, pair_buckets, often)
        each = logs(tokens, bundle.replies[a:b], bundle.replies[b:], unigrams, discounts)[tokens.bigram]
        summed = lambda x: np.add.reduceat(x, tokens.starts)
        return pa.table({
            "doc_id": bundle.keys, "held_out": pa.array(bundle.tags == 1), "n_tokens": pa.array(bundle.sizes.astype(np.int64)),
            "n_known": pa.array(summed((tokens.count > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(bundle.sizes), unigrams.total, np.int64)),
            "base_score": pa.array(summed(unigrams.base(tokens.count))), "score": pa.array(summed(each)),
        })

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return bundles.assembled(table, replies.unionByName(own).unionByName(asked), evaluate, schema)
