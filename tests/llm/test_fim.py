import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from gleaner.llm import fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(i, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts():
    draw = random.Random(5)
    letters = "aZzA@[`{ \n\0<>PSM\u00e9\u00df\u4e2d\U0001f600\u0301\x7f\x80"
    short = ["".join(draw.choices(letters, k=draw.randrange(40))) for _ in range(400)]
    return [
        None, "", "a", "<P>", "x <M> y", "<", "<S", "P>", "\U0001f600" * 9, "abcdefgh" * 3, "<P<S<M", *short,
        "word \u00e9" * 60000, "z" * 200000,
    ]


def test_against_a_plain_version(spark):
    rows = [(k if k % 50 else None, t) for k, t in enumerate(texts())] + [(3, "twice the same id"), (3, "twice the same id")]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id long, text string, n int, form string")
    made = fim.transformed(df)
    got = made.select("*", fim.restored(made.output, made.form).alias("back")).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[-1])
    assert sorted((tuple(r[:6]) for r in got), key=order) == sorted((plain(*r) for r in rows), key=order)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transformed(df.limit(0)).count() == 0


def test_shares_of_the_forms(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'some words here' AS text")
    assert {r.form for r in fim.transformed(df, plain=0, spm=0).collect()} == {"psm"}
    assert {r.form for r in fim.transformed(df, plain=0, spm=100).collect()} == {"spm"}
    assert {r.form for r in fim.transformed(df, plain=100).collect()} == {"plain"}
    assert fim.transformed(df, seed="2").select("output").collect() != fim.transformed(df).select("output").collect()


@pytest.mark.parametrize("offset", range(9))
def test_marks(offset):
    raw = (b"\xc3\xa9aZ" * 11 + b"0[{@`")[offset:]
    raw = raw.decode("utf-8", "ignore").encode()
    words = np.zeros(len(raw) // 8 + 2, "<u8")
    words.view(np.uint8)[: len(raw)] = np.frombuffer(raw, np.uint8)
    ends, points = fim.marked(words)
    ends = np.flatnonzero(ends.view(np.uint8)[: len(raw)])
    units = UNIT.findall(raw.decode())
    assert ends.tolist() == (np.cumsum([len(u.encode()) for u in units]) - 1).tolist()
    marks = fim.Marks(points)
    starts = np.flatnonzero(points.view(np.uint8)[: len(raw)])
    assert marks.select(np.arange(len(starts))).tolist() == starts.tolist()
    assert marks.rank(starts).tolist() == list(range(len(starts)))


def test_sliced_arrays_and_small_chunks(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 10)
    own = [t or "" for t in texts()[:60]]
    batch = pa.RecordBatch.from_pydict({
        "doc_id": list(range(60)), "form": ["psm"] * 60, "first": [7 * k for k in range(60)],
        "second": [3 * k for k in range(60)], "text": own,
    })
    for part in (batch, batch.slice(13, 31)):
        out = pa.Table.from_batches(fim.rearranged([part])).to_pylist()
        for row in out:
            units, k = UNIT.findall(own[row["doc_id"]]), row["doc_id"]
            a, b = sorted(x % (len(units) + 1) for x in (7 * k, 3 * k))
            join = "".join
            assert row["output"] == f"<P>{join(units[:a])}<S>{join(units[b:])}<M>{join(units[a:b])}"
        assert len(out) == part.num_rows
