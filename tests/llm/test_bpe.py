import pytest
from pyspark.sql import functions as F

from gleaner.llm import bpe, bundles

TEXTS = [
    None, "", " ", "a  <|endoftext|> b<|endoftext|><|endoftext|>", "!!<|endoftext|>x's 'sss  \n\n y", "   x\u0085\x1c\x1d",
    "日本語 テキスト ½ ²³ 😀😀👨‍👩‍👧 é", "a" * 30000, " ".join(f"w{i}" for i in range(20000)), "\x00\x01 � tab\t\tx", "a b", "a b",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 7 if i < 9 else None, text, "x") for i, text in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def library_ids(text):
    return tuple(bpe.tokenizer(bpe.BYTE_BPE).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("bundle_words", [3, bundles.BUNDLE_WORDS])
def test_same_as_library(docs, bundle_words):
    rows = bpe.decode(bpe.encode(docs, bundle_words=bundle_words)).collect()
    want = [(i % 7 if i < 9 else None, library_ids(text)) for i, text in enumerate(TEXTS)]
    assert sorted(((r.doc_id, tuple(r.ids)) for r in rows), key=str) == sorted(want, key=str)
    texts = [bpe.tokenizer(bpe.BYTE_BPE).decode(list(ids), skip_special_tokens=False) for _, ids in want]
    assert sorted(r.decoded for r in rows) == sorted(texts) == sorted(t or "" for t in TEXTS)


def test_empty_table_and_broken_bytes(spark, docs):
    assert bpe.encode(docs.limit(0)).count() == 0
    rows = spark.createDataFrame([([0x1F985 % 50000, 10],), (None,), ([],)], "ids array<int>")
    tokenizer = bpe.tokenizer(bpe.BYTE_BPE)
    for row in bpe.decode(rows).collect():
        assert row.decoded == tokenizer.decode(row.ids or [], skip_special_tokens=False)
    cut = bpe.tokenizer(bpe.BYTE_BPE).encode("日本").ids[:-1]
    assert bpe.decode(spark.createDataFrame([(cut,)], "ids array<int>")).first().decoded == tokenizer.decode(cut)


def test_words_travel_once_per_bundle(docs):
    table = bundles.bundled(docs.select("doc_id", F.split("text", " ").alias("words")).filter("words IS NOT NULL"), "t", 4)
    from gleaner.llm.text import unpack_words

    found = [w for r in bundles.word_rows(table).filter("bundle % 16777216 = 0").collect() for w in unpack_words(r.words).to_pylist()]
    assert len({(w) for w in found}) <= len(found)
    per_bundle = bundles.word_rows(table).collect()
    seen = [(r.bundle, w) for r in per_bundle for w in unpack_words(r.words).to_pylist()]
    assert len(seen) == len(set(seen))
