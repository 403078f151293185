"""URL filters: a weighted vocabulary searched by Aho-Corasick, with host and path rules before it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.text import ascii_lower

# Terms looked for in urls. One strict term rejects; soft terms add up.
STRICT = ["porn", "xxx", "hentai", "camgirls", "escorts", "warez", "keygen", "torrents"]
SOFT = {
    "adult": 1.0, "sex": 1.0, "nude": 1.0, "erotic": 1.0, "dating": 0.5, "casino": 1.0, "poker": 0.5, "betting": 0.5,
    "viagra": 1.0, "pills": 0.5, "crack": 0.5, "serial": 0.5, "download": 0.5, "free": 0.5, "cheap": 0.5, "loan": 0.5,
}


@dataclass(frozen=True)
class Vocabulary:
    """``limit``: the sum of the weights of the distinct soft terms found that rejects, if at
    least two of them were found."""

    strict: tuple[str, ...] = tuple(STRICT)
    soft: dict[str, float] = field(default_factory=lambda: dict(SOFT))
    limit: float = 1.5


@dataclass(frozen=True)
class HostRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: tuple[HostRule, ...] = RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits columns ``host`` and ``path``, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = fits & F.col("path").startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def hits(url: pa.ChunkedArray | pa.Array, vocabulary: Vocabulary) -> list[pa.Array]:
    """Numbers of distinct strict and soft terms of each lower-cased url, and the latter's weight.

    A term counts where no ASCII letter or digit touches it.
    """
    machine = ahocorasick.Automaton()
    for term in {*vocabulary.strict, *vocabulary.soft}:
        machine.add_word(term, term)
    machine.make_automaton()
    strict, edge = set(vocabulary.strict), set("abcdefghijklmnopqrstuvwxyz0123456789")
    n_strict, n_soft, weight = [], [], []
    for text in url.to_pylist():
        found = set()
        for end, term in machine.iter(text):
            start = end - len(term) + 1
            if (start == 0 or text[start - 1] not in edge) and (end + 1 == len(text) or text[end + 1] not in edge):
                found.add(term)
        soft = found & vocabulary.soft.keys()
        n_strict.append(len(found & strict))
        n_soft.append(len(soft))
        weight.append(float(sum(vocabulary.soft[t] for t in soft)))
    return [pa.array(n_strict, pa.int32()), pa.array(n_soft, pa.int32()), pa.array(weight, pa.float64())]


def judge(
    pages: DataFrame, vocabulary: Vocabulary | None = None, rules: tuple[HostRule, ...] = RULES,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, n_strict, n_soft, soft_weight of every row.

    The longest fitting rule decides; without one, the vocabulary: block on one strict term, or
    on two or more distinct soft terms whose weights reach the limit. Null and empty urls have
    neither host nor terms and are allowed. Each row is judged alone, so the job is one scan.
    """
    vocabulary = vocabulary or Vocabulary()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch["page_id"], batch["url"], *hits(batch["lowered"], vocabulary)]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "n_strict", "n_soft", "soft_weight"])

    df = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    key = df.schema["page_id"].dataType.simpleString()
    lowered = df.withColumn("lowered", ascii_lower(F.coalesce("url", F.lit(""))))
    found = lowered.mapInArrow(search, f"page_id {key}, url string, n_strict int, n_soft int, soft_weight double")
    found = found.select("*", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    name, decided = rule_for(rules)
    bad = (F.col("n_strict") > 0) | ((F.col("n_soft") > 1) & (F.col("soft_weight") >= vocabulary.limit))
    return found.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(decided, F.when(bad, "block").otherwise("allow")).alias("verdict"),
        "n_strict", "n_soft", "soft_weight",
    )
