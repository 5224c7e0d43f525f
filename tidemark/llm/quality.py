"""Line-first cleaning and the base counts of a text.

Every line is judged by itself: a line that ends without punctuation, looks
like navigation or carries a boilerplate phrase is removed, and a document that
loses too much of its text with them is rejected.

Defined results: a null text has no words and fails; an empty text likewise;
blank lines are neither judged nor counted; repeated rows are judged each; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.textblocks import as_bytes, gram_hashes, text_slices, word_bounds, word_hashes

#: What a line may end with, after closing quotes and brackets.
TERMINALS = ".!?…:;。！？"
CLOSERS = "\"')]}»”’*_"
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Words of which navigation lines consist, and marks between their entries.
NAVIGATION_WORDS = (
    "home menu login logout register search contact about next previous back top archive sitemap share tweet print "
    "subscribe newsletter faq help blog news rss"
).split()
NAVIGATION_MARKS = (" | ", " > ", " » ", " › ", " :: ", " / ")
#: Phrases of boilerplate lines, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "use cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "click here",
    "read more",
    "is licensed under",
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    min_words_for_punctuation: int = 4  # shorter lines are headings or list items
    navigation_share: float = 0.5  # of the words of a line
    navigation_marks: int = 2
    max_lost_share: float = 0.5  # of the non-blank characters


_PHRASES = re.compile("|".join(map(re.escape, BOILERPLATE)))
_NAVIGATION = frozenset(NAVIGATION_WORDS)


def line_failure(line: str, rules: LineRules) -> str | None:
    """The rule that a non-blank line fails, or None: ``punctuation``, ``navigation`` or ``boilerplate``."""
    low = line.lower()
    if _PHRASES.search(low):
        return "boilerplate"
    words = low.split()
    if sum(line.count(m) for m in NAVIGATION_MARKS) >= rules.navigation_marks:
        return "navigation"
    if sum(w.strip(".,|>»›/:") in _NAVIGATION for w in words) >= rules.navigation_share * len(words):
        return "navigation"
    if len(words) >= rules.min_words_for_punctuation:
        end = line.rstrip().rstrip(CLOSERS)
        if not end or end[-1] not in TERMINALS:
            return "punctuation"
    return None


def clean_text(text: str | None, rules: LineRules) -> tuple[str, int, int, int]:
    """The text without failing lines, how many were removed, and non-blank characters before and after."""
    keep, removed, before, after = [], 0, 0, 0
    for line in (text or "").split("\n"):
        size = len(line) - line.count(" ")
        if not line.strip():
            keep.append(line)
            continue
        before += size
        if line_failure(line, rules):
            removed += 1
        else:
            keep.append(line)
            after += size
    return "\n".join(keep), removed, before, after


def duplicate_lines(text: str | None) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def repeated_words(grams: np.ndarray, n: int, width: int) -> int:
    """Words lying in runs of ``width`` words that occur twice or more in one text of ``n`` words."""
    if n < width:
        return 0
    order = np.argsort(grams, kind="stable")
    ordered = grams[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(grams), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    edge[at] += 1
    edge[at + width] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _measure(column: pa.Array, width: int) -> dict[str, np.ndarray]:
    data, offsets = as_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    counted = np.zeros(256, dtype=np.int64)
    counted[[ord(c) for c in SYMBOLS]] = 1
    point = (data & 0xC0) != 0x80  # the first byte of a code point
    edges = np.zeros(len(data) + 1, dtype=np.int64)
    edges[starts] += 1
    edges[ends] -= 1
    inside = np.cumsum(edges[:-1]) > 0
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])
    hashes = word_hashes(data, starts, ends)
    grams, begin = gram_hashes(hashes, first, width)
    n = np.diff(first)
    repeats = [repeated_words(grams[begin[i] : begin[i + 1]], int(n[i]), width) for i in range(len(n))]
    return {
        "n_words": n.astype(np.int64),
        "word_chars": total(point & inside),
        "n_symbols": total(counted[data]),
        "n_repeat_words": np.array(repeats, dtype=np.int64),
    }


def clean(
    docs: DataFrame,
    rules: LineRules | None = None,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    width: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: base counts, base verdict, the cleaned text, removed lines, lost share and ``kept``."""
    rules = rules or LineRules()

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                part = batch.slice(a, b - a)
                out = _measure(part.column(1), width)
                texts = part.column(1).to_pylist()
                cleaned = [clean_text(t, rules) for t in texts]
                failed = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > max_repeat_percent * out["n_words"])
                lost = np.array([1 - x[3] / x[2] if x[2] else 0.0 for x in cleaned])
                yield pa.record_batch(
                    {
                        "id": part.column(0),
                        "n_words": out["n_words"],
                        "word_chars": out["word_chars"],
                        "n_symbols": out["n_symbols"],
                        "n_dup_lines": pa.array([duplicate_lines(t) for t in texts], pa.int64()),
                        "n_repeat_words": out["n_repeat_words"],
                        "base_failed": failed,
                        "kept": ~failed & (lost <= rules.max_lost_share),
                        "n_removed_lines": pa.array([x[1] for x in cleaned], pa.int64()),
                        "lost_share": lost,
                        "clean_text": pa.array([x[0] for x in cleaned], pa.string()),
                    }
                )

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
        " base_failed boolean, kept boolean, n_removed_lines bigint, lost_share double, clean_text string",
    )
