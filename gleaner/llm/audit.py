"""Source divergence audit: how far the term use of each source lies from that of its language.

Texts are factorized into whitespace chunks. A document counts its chunks, each globally distinct
chunk is cut into terms once, where all bundles' copies of it meet, and its terms are joined
back to the documents (see ``bundles``). The bundles' counts of documents and occurrences meet by
term, packed. From there on everything is arithmetic on exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm import bundles
from gleaner.llm.text import pack, pack_all, pack_words, ragged, unpack, unpack_all, unpack_words, words
from gleaner.sources.files import staged

#: What separates the terms inside a chunk: all of ASCII but letters.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term occurs in.
LEAST_DOCS = 10
#: Ranks of the terms that a source uses more than its language.
TOP = 10
#: Probabilities are counted in billionths.
SCALE = 1_000_000_000
#: Bytes of text for which a bucket of words or terms is made, so that buckets stay as they are when the input grows.
BUCKET_BYTES = 32 << 20
#: Sources and cells (source, term) that are compared in one task.
TILE, CELLS = 256, 250_000


def bucket_count(docs: DataFrame, text: Column) -> int:
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)


def cut_chunks(group: pa.Table) -> pa.Table:
    """All word rows of a bucket: each distinct chunk is cut into terms, and every row gets the
    number of terms of its chunks and the terms, one after another."""
    lists = [unpack_words(x.as_py()) for x in group["words"]]
    coded = pa.concat_arrays(lists).dictionary_encode()
    parts = pc.split_pattern_regex(pc.ascii_lower(coded.dictionary), BREAKS)
    flat, owner = parts.flatten(), pc.list_parent_indices(parts).to_numpy()
    real = pc.not_equal(flat, "")
    flat, owner = flat.filter(real), owner[real.to_numpy(zero_copy_only=False)]
    sizes = np.bincount(owner, minlength=len(coded.dictionary)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    codes, at, replies = coded.indices.to_numpy(), 0, []
    for own in lists:
        chunk = codes[at : at + len(own)]
        terms = flat.take(pa.array(ragged(starts[chunk], sizes[chunk])))
        lengths = pack(sizes[chunk].astype(np.int32))
        replies.append(len(lengths).to_bytes(8, "little") + lengths + pack_words(terms))
        at += len(own)
    return pa.table({"bundle": group["bundle"], "bucket": group["bucket"], "reply": pa.array(replies, pa.binary())})


def read_reply(reply: bytes) -> tuple[np.ndarray, pa.Array]:
    cut = 8 + int.from_bytes(reply[:8], "little")
    return unpack(reply[8:cut], np.int32), unpack_words(reply[cut:])


def counted(bundle: bundles.Bundle, buckets: int) -> pa.Table:
    """Documents and occurrences of each (lang, source, term) of a bundle, packed by a hash of the term."""
    parts = [read_reply(r) for r in bundle.replies]
    sizes = np.concatenate([np.zeros(0, np.int32), *(a for a, _ in parts)]).astype(np.int64)
    coded = pa.concat_arrays([pa.array([], pa.string()), *(b for _, b in parts)]).dictionary_encode()
    of_chunk, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    langs, sources = (pc.struct_field(bundle.keys, name).dictionary_encode() for name in ("lang", "source"))
    group = langs.indices.to_numpy().astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy()
    # chunks per document, then their terms
    doc = np.repeat(np.arange(len(bundle.sizes), dtype=np.int64), bundle.sizes)
    pair, often = np.unique(doc * max(1, len(sizes)) + bundle.words, return_counts=True)
    doc, chunk = np.divmod(pair, max(1, len(sizes)))
    starts = np.cumsum(sizes) - sizes
    term = of_chunk[ragged(starts[chunk], sizes[chunk])]
    doc, often = np.repeat(doc, sizes[chunk]), np.repeat(often, sizes[chunk])
    width = max(1, len(terms))
    pair, back = np.unique(doc * width + term, return_inverse=True)
    often = np.bincount(back, weights=often, minlength=len(pair)).astype(np.int64)
    doc, term = np.divmod(pair, width)
    entry, back, docs = np.unique(group[doc] * width + term, return_inverse=True, return_counts=True)
    often = np.bincount(back, weights=often, minlength=len(entry)).astype(np.int64)
    group, term = np.divmod(entry, width)
    # by bucket and, inside it, by term in alphabetical order, in which neighbours share bytes
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    bucket = (bundles.word_hashes(terms) % np.uint64(buckets)).astype(np.int64)[term]
    order = np.lexsort((group, rank[term], bucket))
    group, term, often, docs, bucket = (x[order] for x in (group, term, often, docs, bucket))
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(edges)):
        own = slice(edges[b], edges[b + 1])
        first = np.flatnonzero(np.diff(term[own], prepend=-1))
        rows.append({
            "bucket": int(b),
            "terms": pack_words(terms.take(pa.array(term[own][first]))),
            "counts": pack_all(np.diff(np.append(first, edges[b + 1] - edges[b])).astype(np.int32), group[own].astype(np.int32), often[own], docs[own].astype(np.int32)),
        })
    names = {"langs": langs.dictionary.to_pylist(), "sources": sources.dictionary.to_pylist()}
    return pa.Table.from_pylist([row | names for row in rows], PACKETS)


PACKETS = pa.schema([
    ("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("sources", pa.list_(pa.string())),
    ("terms", pa.binary()), ("counts", pa.binary()),
])
KEPT = pa.schema([
    ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
    ("n", pa.int64()), ("lang_n", pa.int64()), ("head", pa.int32()),
])


def kept_terms(group: pa.Table, least_docs: int) -> pa.Table:
    """All packets of a bucket of terms: the counts of each (lang, source, term) whose term lies in
    enough documents of its language, lang_n its count there, head 1 in one row of each (lang, term)."""
    langs, sources = (group[x].combine_chunks().flatten().dictionary_encode() for x in ("langs", "sources"))
    at = {"langs": 0, "sources": 0}
    parts, lists = [], []
    for row in range(group.num_rows):
        repeats, own, often, docs = unpack_all(group["counts"][row].as_py(), np.int32, np.int32, np.int64, np.int32)
        n_langs, n_sources = len(group["langs"][row]), len(group["sources"][row])
        lang, source = np.divmod(own, n_sources)
        lists.append(unpack_words(group["terms"][row].as_py()))
        parts.append((
            langs.indices.to_numpy()[at["langs"] : at["langs"] + n_langs][lang],
            sources.indices.to_numpy()[at["sources"] : at["sources"] + n_sources][source],
            repeats, often, docs,
        ))
        at = {"langs": at["langs"] + n_langs, "sources": at["sources"] + n_sources}
    lang, source, repeats, often, docs = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
    coded = pa.concat_arrays(lists).dictionary_encode()
    term = np.repeat(coded.indices.to_numpy().astype(np.int64), repeats)
    pair, back = np.unique(term * len(langs.dictionary) + lang, return_inverse=True)
    keep = np.bincount(back, weights=docs)[back] >= least_docs
    entry, back = np.unique(pair[back[keep]] * len(sources.dictionary) + source[keep], return_inverse=True)
    n = total(back, often[keep], len(entry))
    pair, source = np.divmod(entry, len(sources.dictionary))
    _, first, back = np.unique(pair, return_index=True, return_inverse=True)
    term, lang = np.divmod(pair, len(langs.dictionary))
    head = np.zeros(len(entry), np.int32)
    head[first] = 1
    return pa.table([
        langs.dictionary.take(pa.array(lang)), sources.dictionary.take(pa.array(source)),
        coded.dictionary.take(pa.array(term)), pa.array(n), pa.array(total(back, n, len(first))[back]), pa.array(head),
    ], KEPT)


def total(owner: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of integers by owner."""
    out = np.zeros(size, np.int64)
    np.add.at(out, owner, counts)
    return out


def term_counts(
    docs: DataFrame, least_docs: int = LEAST_DOCS, lang_col: str = "lang", source_col: str = "source",
    text_col: str = "text", bundle_words: int = bundles.BUNDLE_WORDS,
) -> DataFrame:
    """lang, source, term, n, lang_n, head: the counts of every term that occurs in ``least_docs`` rows
    of its language or more. Nulls are empty strings; each row is a document, repeated ones too."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    key = F.struct(empty(lang_col).alias("lang"), empty(source_col).alias("source"))
    buckets = bucket_count(docs, F.col(text_col))
    table = bundles.bundled(
        docs.select(key.alias("key"), words(F.col(text_col)).alias("words")), "audit", buckets=buckets, key="key",
        bundle_words=bundle_words,
    )
    rows = bundles.word_rows(table).select("bundle", "bucket", "words")
    replies = rows.groupBy("bucket").applyInArrow(cut_chunks, "bundle long, bucket int, reply binary")
    packets = bundles.assembled(
        table, replies, lambda bundle: counted(bundle, buckets),
        "bucket int, langs array<string>, sources array<string>, terms binary, counts binary",
    )
    return packets.groupBy("bucket").applyInArrow(
        lambda group: kept_terms(group, least_docs), "lang string, source string, term string, n long, lang_n long, head int"
    )


def share(n: Column, whole: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (whole + 2 * terms)), in decimals, which hold the product exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = wide(whole) + wide(terms) * F.lit(2).cast("decimal(2,0)")
    product = wide(n + 2) * F.lit(SCALE).cast("decimal(11,0)")
    return F.call_function("div", product, over) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def compared(group: pa.Table) -> pa.Table:
    """The sums over a block of terms, for each two sources of two tiles: lang, source, item, value, and rest, the
    value of all kept terms of the language if neither source had any; ``value`` is the surplus over the block's part
    of it, so that terms of other tiles alone need no column here."""
    sources = group["source"].combine_chunks().dictionary_encode()
    own = sources.indices.to_numpy()
    tile = group["tile"].to_numpy()
    side = np.zeros(len(sources.dictionary), np.int64)
    side[own] = tile
    z = np.zeros(len(sources.dictionary), np.int64)
    z[own] = group["z"].to_numpy()
    real = pc.is_valid(group["term"]).combine_chunks().to_numpy(zero_copy_only=False)
    terms = group["term"].combine_chunks().dictionary_encode().indices.to_pandas().to_numpy()
    n_terms = int(terms[real].max()) + 1 if real.any() else 0
    p = np.repeat(z[:, None], n_terms, axis=1)
    p[own[real], terms[real].astype(np.int64)] = group["p"].to_numpy()[real]
    low, high = group["low"][0].as_py(), group["high"][0].as_py()
    rows, columns = np.flatnonzero(side == low), np.flatnonzero(side == high)
    a, b, value, rest, kept = [], [], [], [], group["terms"][0].as_py()
    for x in rows:
        others = columns[columns > x] if low == high else columns
        away = p[x] - p[others]
        neither = (z[x] - z[others]) ** 2 // (z[x] + z[others])
        sums = (away * away // (p[x] + p[others])).sum(axis=1) - n_terms * neither
        a += [np.full(len(others), x), others]
        b += [others, np.full(len(others), x)]
        value += [sums, sums]
        rest += [kept * neither] * 2
    name = lambda parts: sources.dictionary.take(pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))
    value, rest = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (value, rest))
    lang = pa.array([group["lang"][0].as_py()] * len(value), pa.string())
    return pa.table([lang, name(a), name(b), pa.array(value), pa.array(rest)], ["lang", "source", "item", "value", "rest"])


def audited(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang_col: str = "lang", source_col: str = "source",
    text_col: str = "text", bundle_words: int = bundles.BUNDLE_WORDS, tile: int = TILE, cells: int = CELLS,
) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: every other source of the language by its distance, farthest first. Part ``term``: the ``top``
    terms that the source uses more than its language, by their share of the distance. Ties are ranked by item.
    A language without kept terms has pairs of value 0 and no terms; a language with one source has no
    pairs. Nulls are empty strings, each row is a document, an empty table gives an empty one; only the
    three named columns are read.

    A source is never gathered: its terms lie in blocks by a hash, and a block compares at most ``tile`` sources
    with as many others.
    """
    kept = staged(term_counts(docs, least_docs, lang_col, source_col, text_col, bundle_words), "audit-terms")
    empty = lambda c, name: F.coalesce(F.col(c), F.lit("")).alias(name)
    groups = docs.select(empty(lang_col, "lang"), empty(source_col, "source")).distinct()
    whole = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("head").alias("terms"))
    parts = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    stats = groups.join(whole, "lang", "left").join(parts, ["lang", "source"], "left").fillna(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    of_lang = F.count("*").over(Window.partitionBy("lang"))
    stats = stats.select(
        "*", F.floor(place / tile).cast("int").alias("tile"), F.ceil(of_lang / tile).cast("int").alias("tiles"),
        F.greatest(F.ceil(F.col("terms") * F.least(of_lang, F.lit(tile)) / cells), F.lit(1)).cast("int").alias("blocks"),
    )
    zero = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(1)
    stats = staged(stats.withColumn("z", zero), "audit-sources")
    used = kept.join(stats, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))

    # every block holds each source once without a term, so that sources without its terms are compared too
    rows = ["lang", "source", "tile", "tiles", "term", "p", "z", "block", "terms"]
    cell = used.withColumn("block", F.pmod(F.xxhash64("term"), "blocks").cast("int")).select(rows)
    bare = stats.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    bare = bare.select(*rows[:4], F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"), *rows[6:])
    cell = cell.unionByName(bare).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    cell = cell.select(
        "lang", "block", "source", "tile", "term", "p", "z", "terms",
        F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
    )
    pairs = cell.groupBy("lang", "block", "low", "high").applyInArrow(
        compared, "lang string, source string, item string, value long, rest long"
    )
    pairs = pairs.groupBy("lang", "source", "item").agg((F.sum("value") + F.max("rest")).alias("value"))

    used = used.withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).filter("p > q")
    terms = used.select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return (
        ranked(pairs).withColumn("part", F.lit("pair")).select(out)
        .unionByName(ranked(terms).filter(F.col("rank") <= top).withColumn("part", F.lit("term")).select(out))
    )
