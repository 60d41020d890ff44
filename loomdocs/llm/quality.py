"""Quality rules with adaptive thresholds from mergeable quantile sketches (operator 7)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_texts, materialize
from ._words import SPACE, flat_bytes, gram_hashes, mix, span_hashes, split_counts, whole_grams, words_of

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

#: Metric, and the least distance above the third quartile at which a value can be an outlier.
METRICS = {"symbol_ratio": 0.05, "dup_line_ratio": 0.4, "word_length": 8.0}
#: An upper threshold is q75 + FENCE * (q75 - q25), or the least distance if that is more.
FENCE = 6.0
#: Groups of a language and source with fewer documents take their language's sketch, then that of all documents.
LEAST_ROWS = 100


def repeats_per_row(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of equal keys in the same row, for each position; and whether it is the first such."""
    both = mix(keys ^ mix(rows.astype(np.uint64) + np.uint64(0x51ED2701)))
    order = np.argsort(both, kind="stable")
    ordered = both[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(new) - 1
    sizes = np.bincount(group) if len(group) else np.zeros(0, np.int64)
    counts, first = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    counts[order] = sizes[group]
    first[order] = new
    return counts, first


def _metrics(batch: pa.RecordBatch, keep: list[str]):
    text = batch.column("text")
    n = len(text)
    data, offsets = flat_bytes(text)
    words = words_of(text)
    inside = ~SPACE[data]
    word_chars = split_counts(inside & ((data & 0xC0) != 0x80), offsets)
    symbols = split_counts(_SYMBOL[data], offsets)

    # lines: each row is cut at \n
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1]))
    starts = starts[starts < len(data)]
    rows = np.searchsorted(offsets, starts, side="right") - 1
    at = np.searchsorted(breaks, starts)
    ends = np.minimum(np.append(breaks, len(data))[at], offsets[rows + 1])
    has_word = np.append(words.starts, len(data) + 1)[np.searchsorted(words.starts, starts)] < ends
    starts, ends, rows = starts[has_word], ends[has_word], rows[has_word]
    _, first = repeats_per_row(span_hashes(data, starts, ends) ^ mix(ends - starts), rows)
    n_lines = np.bincount(rows, minlength=n)
    dup_lines = np.bincount(rows[~first], minlength=n)

    hashes = words.hashes()
    grams, valid = gram_hashes(hashes, 5), whole_grams(words.row_offsets, 5, len(hashes))
    at = np.flatnonzero(valid)
    counts, _ = repeats_per_row(grams[at], words.rows[at])
    at = at[counts > 1]
    cover = np.zeros(len(hashes) + 6, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + 5, -1)
    repeated = split_counts(np.cumsum(cover)[: len(hashes)] > 0, words.row_offsets)
    yield pa.RecordBatch.from_arrays(
        [batch.column(c) for c in keep] + [pa.array(x.astype(np.int64)) for x in (words.counts, word_chars, symbols, dup_lines, repeated, n_lines)],
        [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"],
    )


def text_metrics(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, lang, source and the counts of every whole text (null: all 0)."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    keep = ["doc_id", "lang", "source"]
    counts = ", ".join(f"{c} long" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"))
    return map_texts(own, lambda batch: _metrics(batch, keep), f"doc_id long, lang string, source string, {counts}")


def adaptive_thresholds(measured: DataFrame) -> DataFrame:
    """lang, source and an upper threshold per metric.

    One quantile sketch per metric, language and source; a language's sketch is
    the merger of its sources', and that of all documents the merger of the
    languages'. The table has one row per language and source.
    """
    own = measured.groupBy("lang", "source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(m).alias(m) for m in METRICS])
    by_lang = own.groupBy("lang").agg(F.sum("n").alias("lang_n"), *[F.kll_merge_agg_double(m).alias(f"lang_{m}") for m in METRICS])
    every = by_lang.agg(*[F.kll_merge_agg_double(f"lang_{m}").alias(f"all_{m}") for m in METRICS])
    merged = own.join(by_lang, own.lang.eqNullSafe(by_lang.lang)).drop(by_lang.lang).crossJoin(F.broadcast(every))  # `every` is one row
    thresholds = []
    for m, least in METRICS.items():
        sketch = F.when(F.col("n") >= LEAST_ROWS, F.col(m)).when(F.col("lang_n") >= LEAST_ROWS, F.col(f"lang_{m}")).otherwise(F.col(f"all_{m}"))
        low, high = (F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in (0.25, 0.75))
        thresholds.append((high + F.greatest(F.lit(least), FENCE * (high - low))).alias(f"most_{m}"))
    return merged.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *thresholds)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, base rules and the adaptive verdict of every document.

    A document is kept if it passes the base rules (10 words at least, at most
    20 % of them in repeated 5-word windows) and none of its metrics exceeds the
    threshold of its language and source. Thresholds follow the quartiles of
    all documents of that group, so no cutoff is fixed but the least distance
    from the third quartile.

    Null and empty texts count 0 everywhere and fail the base rules. Null
    languages and sources form groups of their own. Repeated rows and ids keep
    a row each. An empty table gives no rows; other columns are ignored.
    """
    measured = text_metrics(docs, id_col).withColumns(
        {
            "symbol_ratio": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
            "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
        }
    )
    measured = materialize(measured, "quality")
    limits = adaptive_thresholds(measured)
    joined = measured.join(limits, measured.lang.eqNullSafe(limits.t_lang) & measured.source.eqNullSafe(limits.t_source), "left")
    base_failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    fits = F.lit(True)
    for m in METRICS:
        fits = fits & (F.col(m) <= F.col(f"most_{m}"))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), (~base_failed & F.coalesce(fits, F.lit(True))).alias("kept"))
