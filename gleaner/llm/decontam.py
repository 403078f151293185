"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders, so that a question whose parameters were
changed keeps its windows. Windows of canonical words are joined by hash; per alignment of an item
with a document each parameter of the item must stand for one of the document, or the likeness is a
coincidence; two parameters may have become equal. Where one stands for several, a long enough stretch of the alignment that holds no conflict still counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.text import ragged, small_batches, spread, tidied, windows, words

#: Canonical words in a window; an item with fewer is one window, below SHORTEST one of verbatim words.
WINDOW, SHORTEST = 10, 5
#: An item of so few words is a sentence of its own, or the whole text, where a document holds it.
LONE = 2
#: Words beyond a window that a stretch needs to stand by itself where other windows of its alignment
#: conflict: word for word, and with mapped parameters (for windows of 10: 13 and 20 words).
COPIED, MAPPED = 3, 10
#: Added to the size in the hash of verbatim windows, so that they never meet templates.
EXACT = 1 << 20
#: Bits of the filter that keeps words of no benchmark window from the shuffle. A fixed size: a
#: benchmark with far more windows only lets more rows through.
FILTER_BITS = 1 << 22

# Words that are units after a number, and number words.
UNITS = [
    "mm", "cm", "m", "km", "inch", "inches", "ft", "feet", "foot", "mile", "miles", "meter", "meters", "metres",
    "mg", "g", "kg", "gram", "grams", "kilogram", "kilograms", "ton", "tons", "lb", "lbs", "pound", "pounds", "oz",
    "ml", "l", "liter", "liters", "litres", "gallon", "gallons", "s", "sec", "second", "seconds", "min", "minute",
    "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "cent",
    "cents", "dollar", "dollars", "euro", "euros", "usd", "eur", "percent", "degrees", "mph", "kmh", "kb", "mb", "gb",
]
NUMBER_WORDS = [
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
    "twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million",
]

PLAIN, NUMBER, UNIT, CAPITAL, EMPTY = range(5)
# in the syntax of the library that matches whole columns
LEADING, TRAILING = r"^[^\p{L}\p{N}]+", r"[^\p{L}\p{N}]+$"
NUMERAL = r"^\p{N}[\p{N}.,:/]*(%|\p{L}{1,3})?$"
CAPITALISED, ALL_CAPITALS = r"^\p{Lu}", r"^.[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"
STOPS = r"[.!?:;][^\p{L}\p{N}]*$"
SLOTS = np.array([xxhash.xxh64_intdigest(x) for x in ("<plain>", "<number>", "<unit>", "<name>")], np.uint64)


def features(table: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct words: the kind, the hash of the bare lower-cased word, and whether a sentence ends with it."""
    fits = lambda words, pattern: pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)
    among = lambda words, known: pc.is_in(words, pa.array(known)).to_numpy(zero_copy_only=False)
    bare = pc.replace_substring_regex(pc.replace_substring_regex(table, LEADING, ""), TRAILING, "")
    low = pc.utf8_lower(bare)
    empty = pc.equal(bare, "").to_numpy(zero_copy_only=False)
    number = fits(bare, NUMERAL) | among(low, NUMBER_WORDS)
    capital = fits(bare, CAPITALISED) & ~fits(bare, ALL_CAPITALS)
    kind = np.select([empty, number, among(low, UNITS), capital], [EMPTY, NUMBER, UNIT, CAPITAL], PLAIN).astype(np.int8)
    return kind, pd.util.hash_array(low.to_numpy(zero_copy_only=False), categorize=False), fits(table, STOPS)


def templates(lists: pa.ListArray, sizes: list[int], items: bool = False) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray, _Values]]:
    """(exact, key, row, start, values) of the windows of each size: ``values`` has a line per window
    with the hash of each slot's word, 0 elsewhere. Windows with more slots than other words, or of
    fewer than ``SHORTEST`` words, say little as templates. They come as ``exact`` ones with all words
    plain and no slots; of ``items``, only those of the largest size that the row allows.

    A capitalised word is a name unless it starts a sentence, or the window: what stands before the
    window is no part of it. Windows with names come a second time with the names as plain words,
    for copies that lost their capitals. A unit is one only after a number. Words without letter or
    digit are passed over.
    """
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy()
    kind, value, closing = (x[codes] for x in features(coded.dictionary))
    stops = np.cumsum(np.concatenate([[0], closing]))
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.flatnonzero(kind != EMPTY)
    kind, value, row = kind[at], value[at], row[at]
    before = np.concatenate([[-1], at[:-1]])
    starts = np.ones(len(at), bool)
    starts[1:] = (row[1:] != row[:-1]) | (stops[at[1:]] > stops[before[1:]])
    number = kind == NUMBER
    unit = kind == UNIT
    unit[1:] &= number[:-1] & (row[1:] == row[:-1])
    if len(unit):
        unit[0] = False
    name = (kind == CAPITAL) & ~starts
    firm = number | unit
    first = np.where(number, SLOTS[NUMBER], np.where(unit, SLOTS[UNIT], value))
    plain = np.zeros(len(at), bool)
    n_words = np.bincount(row, minlength=len(ends))
    slots = np.concatenate([[0], np.cumsum(firm)])
    leading = number | (kind == UNIT)
    names = np.concatenate([[0], np.cumsum(name)])
    for size in sizes:
        n = max(0, len(at) - size + 1)
        begin = np.arange(n)
        whole = row[begin] == row[begin + size - 1]
        # a unit in front counts as a slot whatever stands before the window, so that copies agree
        n_firm = slots[begin + size] - slots[begin + 1] + leading[begin]
        exact = whole & ((size < SHORTEST) | (2 * n_firm > size) | (kind[begin] == UNIT))
        if items:
            exact &= n_words[row[begin]].clip(max=max(sizes)) == size
        if size <= LONE:
            last = begin + size == len(at)
            exact &= starts[begin] & (last | starts[np.where(last, 0, begin + size)])
        exact = begin[exact]
        if len(exact):
            # hashed word by word: few windows are of this kind
            places = ragged(exact, np.full(len(exact), size, np.int64)).reshape(-1, size)
            key = np.zeros(len(exact), np.uint64)
            for k in range(size):
                key = key * np.uint64(0x9E3779B97F4A7C15) + spread(value[places[:, k]])
            key = spread(spread(key) + np.uint64(EXACT + size))
            yield True, key.view(np.int64), row[exact], exact, _Values(value, plain, plain, size)
        if size < SHORTEST:
            continue
        for named in (name, plain):
            canonical = np.where(named, SLOTS[CAPITAL], first)
            slot = np.concatenate([[0], np.cumsum(firm | named)])
            n_slots = slot[begin + size] - slot[begin + 1] + firm[begin]
            good = whole & (2 * n_slots <= size)
            if named is not name:
                good &= names[begin + size] > names[begin + 1]
            good = begin[good]
            if not len(good):
                continue
            key = spread(first[:n]) * np.uint64(0x9E3779B97F4A7C15) + windows(canonical[1:], size - 1)[:n]
            key = spread(key + np.uint64(size))
            yield False, key[good].view(np.int64), row[good], good, _Values(value, firm, named, size)


class _Values:
    """Slot values of chosen windows, made only for those."""

    def __init__(self, value, firm, name, size):
        self.value, self.firm, self.name, self.size = value, firm, name, size

    def of(self, starts: np.ndarray) -> pa.ListArray:
        at = ragged(starts, np.full(len(starts), self.size, np.int64))
        slot = self.firm[at] | self.name[at]
        slot[:: self.size] = self.firm[starts]
        flat = np.where(slot, self.value[at], 0).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * self.size, pa.int32()), pa.array(flat))


def windowed(df: DataFrame, key: str, sizes: list[int], allowed=None, items: bool = False) -> DataFrame:
    """``key``, th, k (window hash), p (start), vals, exact for each window of column ``words``; only
    those that the filter ``allowed`` lets through."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = allowed.value if allowed is not None else None
        for whole in batches:
            for cut in range(0, whole.num_rows, 2000):
                batch = whole.slice(cut, 2000)
                for exact, k, row, start, values in templates(batch["words"], sizes, items):
                    if bits is not None:
                        slot = k.view(np.uint64) % np.uint64(FILTER_BITS)
                        pick = np.flatnonzero(bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                        k, row, start = k[pick], row[pick], start[pick]
                    if len(k):
                        at = pa.array(row)
                        columns = [batch[key].take(at), batch["th"].take(at), pa.array(k), pa.array(start.astype(np.int64)), values.of(start), pa.array(np.full(len(k), exact))]
                        yield pa.RecordBatch.from_arrays(columns, [key, "th", "k", "p", "vals", "exact"])

    return df.mapInArrow(tidied(run), f"{key} {kind}, th long, k long, p long, vals array<bigint>, exact boolean")


def stretch(windows: list[tuple[int, set]]) -> tuple[int, set]:
    """Of windows (start, pairs) in order of start, the longest run of neighbours whose pairs give each
    parameter of the item one of the document: its number of windows, and its pairs."""
    best, best_pairs, low = 0, set(), 0
    pairs, item = Counter(), Counter()

    def drop(pair):
        pairs[pair] -= 1
        if not pairs[pair]:
            del pairs[pair]
            item[pair[0]] -= 1
            if not item[pair[0]]:
                del item[pair[0]]

    for high, (start, new) in enumerate(windows):
        if high and start != windows[high - 1][0] + 1:
            low = high
            pairs.clear()
            item.clear()
        for pair in new:
            if pair not in pairs:
                item[pair[0]] += 1
            pairs[pair] += 1
        while len(pairs) != len(item):
            for pair in windows[low][1]:
                drop(pair)
            low += 1
        if high + 1 - low > best:
            best, best_pairs = high + 1 - low, set(pairs)
    return best, best_pairs


def judged(windows: list[tuple[int, set]], size: int, window: int) -> tuple[int, int, bool] | None:
    """(n_windows, n_slots, verbatim) of an alignment by its windows (start, pairs) in order, or
    None if it is a coincidence."""
    same = lambda pairs: all(a == b for a, b in pairs)
    pooled = set().union(*(pairs for _, pairs in windows))
    if len({a for a, _ in pooled}) == len(pooled):
        return len(windows), len(pooled), same(pooled)
    good = []
    for chosen, more in (([w for w in windows if same(w[1])], COPIED), (windows, MAPPED)):
        n, pairs = stretch(chosen)
        if n and n + size - 1 >= window + more:
            good.append((n, len(pairs), same(pairs)))
    return max(good, default=None)


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, n_windows, n_slots, verbatim for each document that holds an item.

    A document holds an item if one of its windows has the template of one of the item's, and all
    windows of that alignment agree on which parameter of the document each one of the item stands for. Where they disagree, neighbouring windows that agree among themselves are enough if
    they cover ``MAPPED`` words more than a window, or word for word ``COPIED`` more. n_windows and
    n_slots (distinct parameters) are those of the best alignment or stretch; verbatim: its
    parameters are the item's. Null texts hold nothing and are held by nothing; rows
    of one id and one text count once. Items under ``SHORTEST`` words, and windows that are mostly
    parameters, are found word for word only, those of up to ``LONE`` words as a sentence of their own; an
    item without letter or digit is never found.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("words"))
    items = items.withColumn("th", F.lit(0).cast("long")).filter("item_id IS NOT NULL")
    sizes = list(range(1, window + 1))
    known = windowed(items, "item_id", sizes, items=True).withColumn("size", F.size("vals"))
    # an item's windows are of its own length where that is less than the usual one
    longest = known.filter("NOT exact").groupBy("item_id").agg(F.max("size").alias("longest"))
    known = known.join(longest, "item_id", "left").filter("exact OR size = longest").select("item_id", "size", "k", F.col("p").alias("q"), F.col("vals").alias("item_vals"))
    slots = known.select((F.expr(f"CASE WHEN k >= 0 THEN k % {FILTER_BITS} ELSE (k % {FILTER_BITS} + {FILTER_BITS}) % {FILTER_BITS} END")).alias("s"), "size").distinct()
    found = slots.toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    at = found["s"].to_numpy()
    np.bitwise_or.at(bits, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
    sizes = sorted(set(found["size"].to_pylist()))
    text = F.col(text_col)
    df = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), words(text).alias("words"))
    hits = windowed(df, "doc_id", sizes, spark.sparkContext.broadcast(bits)).drop("exact")
    pairs = hits.withColumn("size", F.size("vals")).join(known, ["k", "size"])
    both = F.filter(
        F.arrays_zip("item_vals", "vals"), lambda x: x["item_vals"] != 0
    )
    pairs = pairs.select(
        "doc_id", "th", "item_id", "size", (F.col("p") - F.col("q")).alias("shift"), F.struct("q", both.alias("both")).alias("window")
    )
    aligned = pairs.groupBy("doc_id", "th", "item_id", "size", "shift").agg(F.collect_set("window").alias("windows"))
    aligned = aligned.select("doc_id", "item_id", "size", "windows")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, (size, rows) in enumerate(zip(batch["size"].to_pylist(), batch["windows"].to_pylist(), strict=True)):
                held: dict[int, set] = {}
                for row in rows:
                    held.setdefault(row["q"], set()).update((x["item_vals"], x["vals"]) for x in row["both"])
                verdict = judged(sorted(held.items()), size, window)
                if verdict:
                    at.append(i)
                    found.append(verdict)
            if at:
                n, slots, same = zip(*found, strict=True)
                columns = [batch["doc_id"].take(pa.array(at)), batch["item_id"].take(pa.array(at)), pa.array(n, pa.int64()), pa.array(slots, pa.int64()), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_windows", "n_slots", "verbatim"])

    kinds = [aligned.schema[x].dataType.simpleString() for x in ("doc_id", "item_id")]
    best = aligned.mapInArrow(tidied(judge), f"doc_id {kinds[0]}, item_id {kinds[1]}, n_windows long, n_slots long, verbatim boolean")
    best = best.select("doc_id", "item_id", F.struct("n_windows", "n_slots", "verbatim").alias("best"))
    return best.groupBy("doc_id", "item_id").agg(F.max("best").alias("best")).select("doc_id", "item_id", "best.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id holds an item; rows without id stay. All columns stay."""
    held = matches(docs, benchmark, window, id_col, text_col).select("doc_id").distinct()
    return docs.alias("docs").join(held.alias("held"), F.expr(f"docs.`{id_col}` = held.doc_id"), "left_anti")
