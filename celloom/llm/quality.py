"""Quality rules: counts in each text, and lines that many documents of a host share.

Lines are normalised (A-Z lower-cased, digits dropped, white space made single)
and hashed, and the distinct texts that hold a line are counted by host. A line
is common if more than LINE_DOCS texts and more than LINE_PERCENT of the host's
distinct texts hold it; common lines go, and a document is depleted when less than
KEPT_PERCENT of its words are left. Copies of a text count once on both sides, and
null texts on neither, so a document is not lost because it was copied, a menu
does not stay because another page was, and shares scale with the host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from celloom.llm.common import arrow_schema, batch, utf8
from celloom.llm.hashing import as_bytes, word_hashes, windows

WINDOW = 8
#: A document fails with fewer words, or with a larger percentage of words in repeated windows.
LEAST_WORDS, REPEATED_PERCENT = 20, 30
#: Limits for common lines and for depleted documents.
LINE_DOCS, LINE_PERCENT, KEPT_PERCENT = 20, 5, 30

SYMBOLS = "#*$%&|<>"
_NOT_SYMBOLS = re.compile(rb"[^#*$%&|<>]+")
_COUNTS = "doc_id long, host string, row long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_CONTINUED = np.zeros(256, bool)
_CONTINUED[0x80:0xC0] = True


def _repeated_words(hashes: np.ndarray, width: int) -> int:
    """Words in windows that stand in the text twice at least."""
    grams = windows(hashes, width)
    if len(grams) < 2:
        return 0
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    edge = np.zeros(len(hashes) + 1, np.int64)
    hit = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def _duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


def _word_chars(text: bytes) -> int:
    """Code points that are in words."""
    raw = np.frombuffer(b"".join(text.split()), np.uint8)
    return len(raw) - int(_CONTINUED[raw].sum())


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_COUNTS)
    for b in batches:
        texts = as_bytes(b.column("bytes"))
        words = list(word_hashes(texts))
        yield batch(
            schema,
            doc_id=b.column("doc_id"),
            host=b.column("host"),
            row=b.column("row"),
            n_words=[len(w) for w in words],
            word_chars=[_word_chars(t) for t in texts],
            n_symbols=[len(_NOT_SYMBOLS.sub(b"", t)) for t in texts],
            n_dup_lines=[_duplicate_lines(t) for t in texts],
            n_repeat_words=[_repeated_words(w, WINDOW) for w in words],
        )


def text_counts(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts of every row of `docs` (doc_id, text and the host's column)."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host"), F.xxhash64("text").alias("row"), utf8().alias("bytes")
    ).mapInArrow(_counted, _COUNTS)


def _lines(docs: DataFrame, host: str) -> DataFrame:
    """(doc_id, row, host, nth, line, words) of every line that is not empty when normalised."""
    rows = docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("row"),
        F.col(host).alias("host"),
        F.posexplode(F.split("text", "\n", -1)).alias("nth", "line"),
    )
    single = rows.withColumn("line", F.trim(F.regexp_replace("line", r"[\x20\x09-\x0D]+", " ")))
    plain = F.translate("line", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz")
    words = F.length("line") - F.length(F.translate("line", " ", "")) + 1
    return (
        single.withColumn("plain", plain)
        .where("plain <> ''")
        .select("doc_id", "row", "host", "nth", F.xxhash64("plain").alias("line"), words.cast("long").alias("words"))
    )


def common_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """(of, common): the host and hash of the lines that are above both limits."""
    held = _lines(docs, host).select("host", "line", "row").distinct()
    counts = held.groupBy("host", "line").agg(F.count("*").alias("texts")).where(F.col("texts") > LINE_DOCS)
    texts = docs.where("text is not null").select(F.col(host).alias("of"), F.xxhash64("text").alias("row")).distinct()
    sizes = texts.groupBy("of").agg(F.count("*").alias("size"))
    return (
        counts.join(sizes, F.col("host").eqNullSafe(F.col("of")))
        .where(f"100 * texts > {LINE_PERCENT} * size")
        .select("of", F.col("line").alias("common"))
    )


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts and verdicts of every row of `docs` (doc_id, text and the host's column).

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are counts;
    common_words are those in lines that go. base_failed: too few words or too
    many in repeated windows. kept: neither that nor depleted. A null text has
    no words and fails. A null host is a host of its own. Repeated rows are
    returned each. Other columns are ignored.
    """
    counts = text_counts(docs, host)
    common = common_lines(docs, host)
    gone = (
        _lines(docs, host)
        .join(common, F.col("host").eqNullSafe(F.col("of")) & (F.col("line") == F.col("common")), "left_semi")
        .groupBy("doc_id", "row", "host", "nth")
        .agg(F.min("words").alias("words"))
        .groupBy(F.col("doc_id").alias("g_doc"), F.col("row").alias("g_row"), F.col("host").alias("g_host"))
        .agg(F.sum("words").alias("common_words"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("g_doc")) & (F.col("row") == F.col("g_row")) & F.col("host").eqNullSafe(F.col("g_host"))
    left = F.col("n_words") - F.col("common_words")
    return (
        counts.join(gone, same, "left")
        .withColumn("common_words", F.coalesce("common_words", F.lit(0)))
        .withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words"))
        .withColumn("kept", ~F.col("base_failed") & (100 * left >= KEPT_PERCENT * F.col("n_words")))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "common_words"
        )
    )
