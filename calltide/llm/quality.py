"""Document quality from labelled lines: rules with Viterbi decoding, and a score from marginals."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.llm import crf
from calltide.llm.common import map_texts, set_aside

MIN_CONTENT = 0.5
MIN_WORDS, MAX_REPEATED = 10, 20  # words; percent of words in repeated windows
RUN = 5  # words in a window
THRESHOLD = 0.3
_SYMBOLS = "#*$%&|<>"


def words_of(text: str) -> list[str]:
    """What stands between blanks and the control characters 9 to 13."""
    for space in "\t\n\v\f\r":
        text = text.replace(space, " ")
    found = text.split(" ")
    return [w for w in found if w] if "" in found else found


def repeated_words(words: list[str], run: int = RUN) -> int:
    """Number of words inside windows of ``run`` words that occur at least twice."""
    windows = list(zip(*(words[i:] for i in range(run))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    often = np.fromiter((times[w] > 1 for w in windows), bool, len(windows))
    change = np.zeros(len(words) + 1, np.int64)
    change[: len(windows)] += often
    change[run : run + len(windows)] -= often
    return int((np.cumsum(change)[:-1] > 0).sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and words in repeated windows."""
    text = text or ""
    words = words_of(text)
    seen: set[str] = set()
    again = 0
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                again += bool(words_of(line))
            else:
                seen.add(line)
    return len(words), sum(map(len, words)), sum(map(text.count, _SYMBOLS)), again, repeated_words(words)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def content_share(chain: crf.Chain, texts: list[str | None]) -> np.ndarray:
    """Share of each text, by bytes that are not white space, in lines that Viterbi decoding marks as content."""
    lines = crf.line_features(texts)
    content = chain.viterbi(lines) * lines.weight
    total = np.add.reduceat(lines.weight, lines.starts) if len(texts) else np.zeros(0)
    return np.where(total > 0, np.add.reduceat(content, lines.starts) / np.maximum(total, 1), 0.0)


def quality_rules(
    docs: DataFrame, chain: crf.Chain, text_col: str = "text", min_content: float = MIN_CONTENT, keep_text: bool = False
) -> DataFrame:
    """Append counts, ``base_failed``, ``content_share`` and ``kept`` to the other columns, with ``keep_text`` to all.

    A document is kept if it passes the base rules (10 words at least, at most a fifth of them in repeated five-word windows)
    and at least ``min_content`` of it is content. NULL and empty texts have no words and fail. Each row is judged alone, so
    repeated rows agree. Columns of ``docs`` that have one of these names are returned with an underscore behind it.
    """
    docs, (text_col,) = set_aside(docs, [*_COUNTS, "content_share", "base_failed", "kept"], text_col)

    def run(texts):
        counts = [text_counts(t) for t in texts]
        made = {name: [c[i] for c in counts] for i, name in enumerate(_COUNTS)}
        made["content_share"] = content_share(chain, texts)
        return made

    found = map_texts(docs, text_col, run, ", ".join(f"{c} long" for c in _COUNTS) + ", content_share double", keep_text)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= min_content)
    )


def quality_score(docs: DataFrame, chain: crf.Chain, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Append ``score`` and ``predicted`` to the other columns; the text is not returned.

    The score is the mean of the lines' marginals of being good, weighted by their bytes that are not white space. NULL
    texts and those of white space alone score 0. Columns of ``docs`` that are called like these are returned with an
    underscore behind the name.
    """
    docs, (text_col,) = set_aside(docs, ["score", "predicted"], text_col)

    def run(texts):
        lines = crf.line_features(texts)
        good = chain.marginals(lines) * lines.weight
        total = np.add.reduceat(lines.weight, lines.starts)
        return {"score": np.where(total > 0, np.clip(np.add.reduceat(good, lines.starts) / np.maximum(total, 1), 0, 1), 0.0)}

    found = map_texts(docs, text_col, run, "score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
