"""Fill-in-the-middle: texts cut in three at token boundaries and put in another order.

The boundaries are found on 64-bit words. A batch of UTF-8 is viewed as uint64, arithmetic on eight
bytes at once marks those that end a unit, the marks are counted per word, a search in the running
count finds the word of the n-th unit, and a product of the marks resolves its place in the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Bytes of text that are looked at together; a longer text is looked at alone.
CHUNK = 8 << 20


def everywhere(byte: int) -> np.uint64:
    """The byte in all eight places of a word."""
    return np.uint64(byte * 0x0101010101010101)


HIGH = everywhere(0x80)


def next_byte(marks: np.ndarray) -> np.ndarray:
    """Each byte's place holds the mark of the byte after it."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


def marked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of UTF-8, the high bits of bytes that end a unit and of bytes that begin a code point.

    A unit is a run of A-Z and a-z, or any other single code point.
    """
    low = (x & everywhere(0x7F)) | everywhere(0x20)
    # the sums stay below 256 in every byte, so nothing is carried over
    letter = (low + everywhere(0x80 - ord("a"))) & ~(low + everywhere(0x7F - ord("z"))) & ~x & HIGH
    inner = x & ~(x << np.uint64(1)) & HIGH  # 10xxxxxx
    return HIGH & ~next_byte(inner) & ~(letter & next_byte(letter)), HIGH & ~inner


class Marks:
    """Marked bytes, counted and found by number."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many marked bytes lie before each place."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self, number: np.ndarray) -> np.ndarray:
        """The place of the marked byte with each number, counted from 0."""
        word = np.searchsorted(self.before, number, side="right") - 1
        rest = (number - self.before[word]).astype(np.uint64)
        # byte i of the product counts the marks in bytes 0 to i; those that do not exceed the rest lie before
        counts = (self.words[word] >> np.uint64(7)) * everywhere(1)
        before = ((rest * everywhere(1) | HIGH) - counts) & HIGH
        return word * 8 + np.bitwise_count(before)


def cuts(texts: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
    """(n, prefix code points, middle code points, bounds) of texts whose prefix ends after the smaller
    of first % (n + 1) and second % (n + 1) units and whose middle ends after the larger.

    bounds: per text the four byte offsets, into the buffer of ``texts``, round prefix, middle, suffix.
    """
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    base, size = offsets[0], int(offsets[-1] - offsets[0])
    starts, ends = offsets[:-1] - base, offsets[1:] - base
    padded = np.zeros(size // 8 + 2, "<u8")  # the place after the last byte has a word too
    if size:
        padded.view(np.uint8)[:size] = np.frombuffer(data, np.uint8)[base : base + size]
    unit_ends, code_points = marked(padded)
    # a text ends its last unit, whatever stands after it in the buffer
    last = ends[ends > starts] - 1
    np.bitwise_or.at(unit_ends, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
    units, points = Marks(unit_ends), Marks(code_points)
    before = units.rank(starts)
    n = units.rank(ends) - before
    one, two = first % (n + 1), second % (n + 1)
    bounds = [starts]
    for count in (np.minimum(one, two), np.maximum(one, two)):
        at = starts.copy()
        some = count > 0
        at[some] = units.select(before[some] + count[some] - 1) + 1
        bounds.append(at)
    bounds = np.stack([*bounds, ends])
    chars = np.diff(points.rank(bounds.reshape(-1)).reshape(bounds.shape), axis=0)
    return n, chars[0], chars[1], bounds + base


def slices(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``CHUNK`` bytes, one row at least."""
    part = np.cumsum(sizes) // CHUNK
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def rearranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, form, first, second, text) to those of ``transformed``."""
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for whole in batches:
        whole_texts = whole["text"].cast(pa.string())
        sizes = np.diff(np.frombuffer(whole_texts.buffers()[1], np.int32)[whole_texts.offset :][: len(whole_texts) + 1])
        for batch in slices(whole, sizes):
            texts = batch["text"].cast(pa.string())
            forms = batch["form"].to_pylist()
            n, prefix, middle, bounds = cuts(texts, batch["first"].to_numpy(), batch["second"].to_numpy())
            raw, out = memoryview(texts.buffers()[2] or b""), []
            for form, a, b, c, d in zip(forms, *bounds.tolist(), strict=True):
                if form == "psm":
                    out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                elif form == "spm":
                    out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                else:
                    out.append(bytes(raw[a:d]))
            plain = np.array([form == "plain" for form in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array(n, pa.int64()), batch["form"], pa.array(prefix, pa.int64(), mask=plain),
                    pa.array(middle, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )


def transformed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1", plain: int = 10, spm: int = 20
) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row.

    n: the units of the text. form: ``plain`` for ``plain`` texts in a hundred, for empty ones and
    for those that hold a marker, their output is the text; of the others ``spm`` for ``spm`` in a hundred
    (suffix, prefix, middle), else ``psm`` (prefix, suffix, middle). All choices follow from a digest
    of the seed and the id, so rows with one id are cut by one draw. A null text is empty, a null id
    counts as an empty string; an empty table gives an empty one. Only the two named columns are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), digest.alias("digest"))
    draw = lambda k: F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long")
    held = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains("text", F.lit(marker))
    form = (
        F.when((F.col("text") == "") | held | (draw(2) % 100 >= 100 - plain), "plain")
        .when(draw(3) % 100 < spm, "spm")
        .otherwise("psm")
    )
    df = df.select("doc_id", form.alias("form"), draw(0).alias("first"), draw(1).alias("second"), "text")
    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(
        rearranged, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""
    part = lambda i: F.get(F.split(output, "<[PSM]>"), i)
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
