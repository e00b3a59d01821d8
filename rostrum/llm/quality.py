"""Compression bands: zstandard ratios of whole documents and of fixed chunks, with limits by length.

Repetitive text compresses far better than prose of the same length, and encoded or random text far
worse. Short texts compress worse than long ones because of the frame and the empty history, so each
length band has its own pair of limits. The whole-document ratio finds texts that repeat over long
distances; the chunk ratios find documents of which a part only is repetitive or incompressible. Where the
chunks do not end with the text, a last one that does overlaps the one before, so every byte is judged.

The base measures (words, symbols, repeated lines and repeated 3-word windows) come from the same pass.
Everything is a scalar Arrow UDF on the text column: one scan, no shuffle, other columns stay in the JVM.

Defined results: null and empty texts have no words, no ratio, and fail the base rule. Texts of any
length are measured whole, row by row. Repeated rows give repeated results. Columns of the input keep
their names; the measures go into one new struct column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import strings

#: Characters that count as symbols, and white space between words.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """``limits``: (bytes from which the band holds, lowest ratio kept, highest ratio kept)."""

    level: int = 3
    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.20, 9.0), (256, 0.38, 0.95), (512, 0.35, 0.90), (1024, 0.32, 0.85), (2048, 0.29, 0.80),
        (4096, 0.27, 0.78), (16384, 0.24, 0.75), (65536, 0.22, 0.75))
    chunk_bytes: int = 4096
    chunk_limits: tuple[float, float] = (0.27, 0.80)
    #: Share of the chunks that may lie outside the chunk limits.
    chunk_share: float = 0.3
    min_words: int = 50
    max_repeat_percent: int = 50


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "n_bytes long, ratio double, n_chunks long, n_odd_chunks long, kept boolean")


def repeated_words(words: list[bytes]) -> int:
    """Words lying in a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    k, pair = len(ids), code[:-2] * len(ids) + code[1:-1]
    if k > 2_000_000:  # three codes no longer fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    found, at, count = np.unique(pair * k + code[2:], return_inverse=True, return_counts=True)
    if len(found) == n - 2:
        return 0
    twice = count[at] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: str, rules: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, repeats = len(words), repeated_words(words)
    base_failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    size = len(data)
    ratio = len(packer.compress(data)) / size if size else None
    step = rules.chunk_bytes
    starts = [*range(0, size - step + 1, step), *([size - step] if size % step else [])] if size > step else []
    chunks = [len(packer.compress(data[i:i + step])) / step for i in starts]
    low, high = rules.chunk_limits
    odd = sum(not low <= x <= high for x in chunks)
    kept = False
    if not base_failed:
        _, least, most = max(b for b in rules.limits if b[0] <= size)
        kept = least <= ratio <= most and odd <= rules.chunk_share * len(chunks)
    return (n, len(text) - (size - len(data.translate(None, SPACE))), size - len(data.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeats, base_failed, size, ratio, len(chunks), odd, kept)


def verdict(text: Column, rules: Bands = Bands()) -> Column:
    """Struct of the measures and ``kept``."""
    kinds = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
             ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("n_bytes", pa.int64()), ("ratio", pa.float64()),
             ("n_chunks", pa.int64()), ("n_odd_chunks", pa.int64()), ("kept", pa.bool_())]

    @F.arrow_udf(SCHEMA)
    def judge(column: pa.Array) -> pa.Array:
        packer = zstandard.ZstdCompressor(level=rules.level)
        rows = [measure(x, rules, packer) for x in strings(column)]
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], [k for k, _ in kinds])

    return judge(text.cast("string"))


def with_verdict(df: DataFrame, out: str = "quality", text: str = "text", rules: Bands = Bands()) -> DataFrame:
    """``df`` with the struct column ``out``, which must be a new name."""
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {out} exists already")
    return df.select("*", verdict(F.col(f"`{text}`"), rules).alias(out))
