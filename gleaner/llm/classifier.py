"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or not at all. Expectation-maximisation over the counts of all
vote patterns estimates how each labeller votes on good and on bad texts, without any true label;
the posterior of a text's pattern is its label. A logistic regression over hashed lower-cased words, word
shapes and the ranges that the labellers' measures fall in is trained on posteriors and scores every text.

Texts are measured by column: a word's letters, shape and hash are looked at once per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.rules import STOP_WORDS, SYMBOLS
from gleaner.llm.text import SEPARATORS, small_batches, spread, tidied
from gleaner.sources.files import scratch_dir, staged

#: Votes; ABSENT where there is nothing to measure, which is no evidence.
BAD, NONE, GOOD, ABSENT = range(4)
#: Expected number of texts that the regression is trained on; EM counts all texts.
SAMPLE = 20_000
#: Words that are added to each text: the fewer its own, the less they say.
BLANKS = 10
#: Words under which a text's share of stop words and its variety say nothing.
FEW = 8
#: Posterior below which the labellers are all but sure that a text is bad: it is then the text's score, whatever
#: its words look like.
SURE = 0.01
#: Hash buckets of words and of their shapes, of which there are far fewer.
WORDS, SHAPES = 1 << 15, 1 << 12
ROUNDS = 100
#: Weight of what the label model says of a single vote, in texts.
ALONE = 5.0
#: Smallest score that is kept. Below a half, since losing a good text costs more than a bad one.
KEEP = 0.35
#: Bytes of text that are measured together; a longer text is measured alone.
CHUNK = 1 << 20

SYMBOL = "[" + "".join("\\" + c for c in SYMBOLS) + "]"
WORDED = r"[^\x20\x09-\x0D]"
#: A line that ends as a sentence does.
CLOSED = r"""[.!?…]["')]*[\x20\x09-\x0D]*$"""


def as_bools(x) -> np.ndarray:
    return x.to_numpy(zero_copy_only=False).astype(bool)


def listed(lists: pa.ListArray, keep: Callable[[pa.Array], pa.Array]) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The row of each kept element of lists, and the elements, coded."""
    row = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    flat = lists.flatten()
    good = keep(flat)
    return row[as_bools(good)], flat.filter(good).dictionary_encode()


class Measured:
    """The words of a batch of texts, and the ratios that labellers look at; NaN without words or lines."""

    def __init__(self, texts: pa.Array):
        n = len(texts)
        self.row, coded = listed(pc.split_pattern_regex(texts, SEPARATORS), lambda x: pc.not_equal(x, ""))
        self.codes, self.table = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self.low = pc.utf8_lower(self.table)
        self.n_words = np.bincount(self.row, minlength=n)
        row, codes = self.row, self.codes
        self.again = np.zeros(len(row), bool)
        self.again[1:] = (row[1:] == row[:-1]) & (codes[1:] == codes[:-1])

        def total(values) -> np.ndarray:
            return np.bincount(row, weights=np.asarray(values, np.float64)[codes], minlength=n)

        def distinct(row: np.ndarray, codes: np.ndarray) -> np.ndarray:
            width = int(codes.max(initial=0)) + 1
            return np.bincount(np.unique(row * width + codes) // width, minlength=n)

        letters = total(pc.utf8_length(self.table))
        line_row, lines = listed(pc.split_pattern(texts, "\n"), lambda x: pc.match_substring_regex(x, WORDED))
        line_codes = lines.indices.to_numpy().astype(np.int64)
        of_lines = lambda test: np.bincount(line_row, weights=as_bools(test)[line_codes], minlength=n)
        n_lines = np.bincount(line_row, minlength=n)
        enough = self.n_words >= FEW
        with np.errstate(divide="ignore", invalid="ignore"):
            self.values = {
                "symbols": total(pc.count_substring_regex(self.table, SYMBOL)) / self.n_words,
                "upper": total(pc.count_substring_regex(self.table, r"\p{Lu}")) / letters,
                "stops": np.where(enough, total(as_bools(pc.is_in(self.low, pa.array(STOP_WORDS)))) / self.n_words, np.nan),
                "word_length": letters / self.n_words,
                "again": np.bincount(row, weights=self.again, minlength=n) / self.n_words,
                "variety": np.where(enough, distinct(row, codes) / np.sqrt(self.n_words), np.nan),
                "piped": of_lines(pc.match_substring(lines.dictionary, "|")) / n_lines,
                "distinct_lines": distinct(line_row, line_codes) / n_lines,
                "closed": of_lines(pc.match_substring_regex(lines.dictionary, CLOSED)) / n_lines,
            }


@dataclass(frozen=True)
class Labeller:
    """Bad outside ``bad`` = (low, high), good inside ``good``, no vote between or without measure."""

    measure: str
    bad: tuple[float, float]
    good: tuple[float, float]

    def vote(self, value: np.ndarray) -> np.ndarray:
        return np.select(
            [np.isnan(value), (value < self.bad[0]) | (value > self.bad[1]), (value >= self.good[0]) & (value <= self.good[1])],
            [ABSENT, BAD, GOOD], NONE,
        )

    def ranges(self, value: np.ndarray) -> list[np.ndarray]:
        """Outside which bounds a value lies; a far one lies outside the near one too."""
        return [value < self.bad[0], value < self.good[0], value > self.good[1], value > self.bad[1], np.isnan(value)]


LABELLERS = (
    Labeller("symbols", (0.0, 0.15), (0.0, 0.02)),
    Labeller("upper", (0.0, 0.4), (0.0, 0.15)),
    Labeller("stops", (0.01, 0.9), (0.05, 0.7)),
    Labeller("word_length", (2.0, 14.0), (3.0, 9.0)),
    Labeller("again", (0.0, 0.2), (0.0, 0.03)),
    Labeller("variety", (1.5, 1e9), (2.0, 1e9)),
    Labeller("piped", (0.0, 0.3), (0.0, 0.0)),
    Labeller("distinct_lines", (0.4, 1.0), (0.8, 1.0)),
    Labeller("closed", (0.0, 1.0), (0.5, 1.0)),
)


@dataclass
class LabelModel:
    """``votes[l, c, v]``: how often labeller l votes v on texts of class c (0 bad, 1 good), of those it votes on."""

    prior: np.ndarray
    votes: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        logs = np.log(self.prior)[None, :] + sum(
            np.pad(np.log(self.votes[k]), ((0, 0), (0, 1)))[:, patterns[:, k]].T for k in range(patterns.shape[1])
        )
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """EM over distinct vote patterns. It starts from "bad if anyone says so"."""
    good = np.where((patterns == BAD).any(1), 0.1, 0.9)
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        votes = np.stack([
            np.stack([weight[:, patterns[:, k] == v].sum(1) for v in (BAD, NONE, GOOD)], 1) + 0.1
            for k in range(patterns.shape[1])
        ])
        model = LabelModel(prior, votes / votes.sum(2, keepdims=True))
        updated = model.posterior(patterns)
        if np.abs(updated - good).max(initial=0) < 1e-9:
            break
        good = updated
    return model


#: Hash buckets, the places of the measures' ranges, and one place for repeated words.
RANGES = 5
FEATURES = WORDS + SHAPES + RANGES * len(LABELLERS) + 1


def shaped(words: pa.Array) -> pa.Array:
    """Words with runs of capitals as A, of small letters as a, of digits as 0."""
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\p{N}+", "0")):
        words = pc.replace_substring_regex(words, pattern, sign)
    return words


def bucket(words: pa.Array, buckets: int) -> np.ndarray:
    return (spread(pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)) % np.uint64(buckets)).astype(np.int64)


def features(m: Measured) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of every feature that is not zero, in order of row and place."""
    places = np.concatenate([
        bucket(m.low, WORDS)[m.codes], WORDS + bucket(shaped(m.table), SHAPES)[m.codes],
        np.full(int(m.again.sum()), FEATURES - 1),
    ])
    rows = np.concatenate([m.row, m.row, m.row[m.again]])
    pair, counts = np.unique(rows * FEATURES + places, return_counts=True)
    row, place = np.divmod(pair, FEATURES)
    parts = [(row, place, counts / (m.n_words[row] + BLANKS))]
    for k, labeller in enumerate(LABELLERS):
        for r, outside in enumerate(labeller.ranges(m.values[labeller.measure])):
            at = np.flatnonzero(outside & (m.n_words > 0))
            parts.append((at, np.full(len(at), WORDS + SHAPES + k * RANGES + r), np.ones(len(at))))
    row, place, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((place, row))
    return row[order], place[order], value[order]


def by_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about ``CHUNK`` bytes of column text, one row at least."""
    for whole in batches:
        part = np.cumsum(pc.binary_length(whole["text"]).to_numpy(zero_copy_only=False).astype(np.int64)) // CHUNK
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b > a:
                yield whole.slice(a, b - a)


def patterns_of(m: Measured) -> np.ndarray:
    return np.stack([v.vote(m.values[v.measure]) for v in LABELLERS], 1).astype(np.uint8)


def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vote patterns of a batch's texts that have words, and how often each occurs."""
    for batch in by_chunks(batches):
        m = Measured(batch["text"])
        found, counts = np.unique(patterns_of(m)[m.n_words > 0], axis=0, return_counts=True)
        texts = ["".join(map(str, p)) for p in found.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(counts, pa.int64())], ["pattern", "n"])


@dataclass
class Classifier:
    labels: LabelModel
    weights: np.ndarray
    intercept: float

    def scored(self, df: DataFrame) -> DataFrame:
        """``df``, which has a column text without nulls, with score in its place."""
        weights, intercept, labels = self.weights, self.intercept, self.labels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in by_chunks(batches):
                m = Measured(batch["text"])
                row, place, value = features(m)
                sums = intercept + np.bincount(row, weights=weights[place] * value, minlength=batch.num_rows)
                score, good = 1 / (1 + np.exp(-np.clip(sums, -700, 700))), labels.posterior(patterns_of(m).astype(np.int64))
                score = np.where(m.n_words > 0, np.where(good < SURE, np.minimum(score, good), score), 0.0)
                yield pa.RecordBatch.from_arrays([batch[c] for c in others] + [pa.array(score)], [*others, "score"])

        others = [c for c in df.columns if c != "text"]
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != "text")
        return df.mapInArrow(tidied(run), f"{kinds}, score double")

    def judge(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, score (probability of good), kept (score at least ``KEEP``) of every row.

        A text that the label model is all but sure of (``SURE``) scores its posterior if that is less. A text without words, null included, scores 0.
        """
        df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        return self.scored(df).withColumn("kept", F.col("score") >= KEEP)


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Label model from all texts, scorer from about ``sample`` of them.

    At most 4 ** len(LABELLERS) patterns reach the driver, whatever the number of texts. The sample
    is chosen by a hash of id and text, so a second run trains on the same rows. Texts without words
    are left out; with none at all, or all on one side, the scorer follows the prior.
    """
    small_batches(docs.sparkSession)
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = df.select("text").mapInArrow(tidied(voted), "pattern string, n long")
    rows = counted.groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["pattern"])
    patterns = np.array([[int(v) for v in r["pattern"]] for r in rows], np.int64).reshape(-1, len(LABELLERS))
    counts = np.array([r["n"] for r in rows], np.float64)
    labels = estimate(patterns, counts)

    share = min(1.0, sample / max(1.0, counts.sum()))
    chosen = df.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))).select("text")

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_chunks(batches):
            m = Measured(batch["text"])
            row, place, value = features(m)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            good = labels.posterior(patterns_of(m).astype(np.int64))
            made = pa.RecordBatch.from_arrays(
                [pa.array(good), *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (place, value))], ["good", "place", "value"]
            )
            yield made.filter(pa.array(m.n_words > 0))

    known = staged(chosen.mapInArrow(tidied(trained), "good double, place array<long>, value array<double>"), "labelled")
    return Classifier(labels, *regressed(known.withColumn("mass", F.lit(1.0)).unionByName(single_votes(docs, labels))))


def single_votes(docs: DataFrame, labels: LabelModel) -> DataFrame:
    """What the label model makes of each labeller's vote alone, as rows to train on: a vote that the sample
    lacks has a weight as well."""
    rows = []
    for k, labeller in enumerate(LABELLERS):
        for value in (labeller.bad[0] - 1, labeller.bad[1] + 1, (labeller.good[0] + labeller.good[1]) / 2):
            pattern = np.full((1, len(LABELLERS)), ABSENT)
            pattern[0, k] = labeller.vote(np.array([value]))[0]
            outside = labeller.ranges(np.array([value]))
            places = [WORDS + SHAPES + k * RANGES + r for r, x in enumerate(outside) if x[0]]
            rows.append((float(labels.posterior(pattern)[0]), places, [1.0] * len(places)))
    return docs.sparkSession.createDataFrame(rows, "good double, place array<long>, value array<double>").withColumn("mass", F.lit(ALONE))


def regressed(known: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on rows of good, place, value and mass."""
    spark = known.sparkSession
    table = staged(known.withColumn("id", F.monotonically_increasing_id()), "training")
    cells = F.transform(F.arrays_zip("place", "value"), lambda x: F.concat(x["place"] + 1, F.lit(":"), x["value"]))
    path = scratch_dir(spark, "vectors")
    table.select(F.concat_ws(" ", F.col("id").cast("string"), F.array_join(cells, " ")).alias("line")).write.text(path)
    vectors = spark.read.format("libsvm").option("numFeatures", str(FEATURES)).load(path)
    # each text counts as good by its posterior and as bad by the rest
    sides = F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("good") * F.col("mass")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), ((1 - F.col("good")) * F.col("mass")).alias("weight")),
    )
    mass = table.select("id", F.explode(sides).alias("x")).select("id", "x.*")
    training = vectors.select(F.col("label").cast("long").alias("id"), "features").join(mass, "id").filter("weight > 0")
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50).fit(staged(training.drop("id"), "training"))
    return model.coefficients.toArray(), float(model.intercept)


def filtered(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that a classifier fitted to them rejects; rows without words, null texts included,
    go too. All columns stay, whatever their names. An empty table stays empty."""
    model = fit(docs, sample, id_col, text_col)
    scored = model.scored(docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    return scored.filter(F.col("score") >= KEEP).select("row.*")
