"""Language identification with bit-sliced Bloom filters of letter n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltide.llm.common import keyed_hash, map_texts, set_aside, text_chunks

DOCS_PER_LANGUAGE = 2_000  # texts of a language that n-grams are learned from, on average
SLOTS = 1 << 19
PROBES = 3
WORD_BITS = 32  # languages per word of a slot
MIN_SHARE = 0.25  # an n-gram belongs to a language that has it this often, against the language that has it most
MIN_COUNT = 2
UNKNOWN = "und"
N = 4
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams that have a letter in second place, the text each is from, and whether texts have letters.

    Texts are lower-cased, all but letters become a blank, and two blanks stand around each text, so a single letter has
    an n-gram too.
    """
    shown = [(t or "").lower() for t in texts]
    sizes = np.array([len(t) for t in shown], np.int64) + 4
    codes = np.frombuffer("".join(f"  {t}  " for t in shown).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    m = len(codes) - N + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), bool)
    h = codes[:m] * _MULTIPLIERS[0]
    for k in range(1, N):
        h += codes[k : k + m] * _MULTIPLIERS[k]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    whole = letter[1 : m + 1] & (owner[:m] == owner[N - 1 :])
    has = np.bincount(owner, weights=letter, minlength=len(texts)) > 0
    return h[whole], owner[:m][whole], has


def _slots(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(20 * k)) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(PROBES)]


@dataclass
class Filters:
    """Languages in order, their filters (slot x word, a bit for each language) and how full each language's filter is."""

    languages: list[str]
    slots: np.ndarray
    fallback: str
    full: np.ndarray

    @property
    def false_rate(self) -> np.ndarray:
        return self.full**PROBES

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text.

        The languages of an n-gram are the bits set in all its slots. Hits of a language are corrected for the n-grams that
        its filter would let through by chance; the score is the best language's part of all corrected hits.
        """
        h, owner, has = ngrams(texts)
        at = _slots(h)
        total = np.bincount(owner, minlength=len(texts)).astype(np.float64)
        hits = np.zeros((len(texts), len(self.languages)))
        for word in range(self.slots.shape[1]):
            column = self.slots[:, word]
            mask = column[at[0]]
            for x in at[1:]:
                mask = mask & column[x]
            for bit in range(min(WORD_BITS, len(self.languages) - word * WORD_BITS)):
                is_in = (mask >> np.uint32(bit)) & np.uint32(1)
                hits[:, word * WORD_BITS + bit] = np.bincount(owner, weights=is_in, minlength=len(texts))
        rate = np.minimum(self.false_rate, 0.999)
        true = np.maximum(0, (hits - total[:, None] * rate) / (1 - rate))
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best, all_hits = true.argmax(1), true.sum(1)
        score = np.where(all_hits > 0, true.max(1) / np.maximum(all_hits, 1e-12), 0.0)
        names = [
            UNKNOWN if not has[i] else self.languages[best[i]] if all_hits[i] > 0 else self.fallback for i in range(len(texts))
        ]
        return names, np.where(has, np.clip(score, 0, 1), 0.0)


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE
) -> Filters:
    """Filters from labelled texts, about ``per_language`` of each language, picked by hash.

    Counts of n-grams by language are summed over all picked texts; an n-gram enters the filters of the languages that use it
    at least ``MIN_SHARE`` as often as the one that uses it most. The filters are merged on the executors by OR; at most
    ``SLOTS`` rows for each 32 languages reach the driver.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where("text is not null and lang is not null")
    sizes = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    languages = [lang for lang, _ in sizes]
    empty = np.zeros((SLOTS, max(1, -(-len(languages) // WORD_BITS))), np.uint32)
    if not languages:
        return Filters([], empty, UNKNOWN, np.zeros(0))
    number = F.element_at(F.create_map(*(F.lit(x) for i, lang in enumerate(languages) for x in (lang, i))), F.col("lang"))
    share = F.element_at(
        F.create_map(*(F.lit(x) for lang, n in sizes for x in (lang, min(1.0, per_language / n)))), F.col("lang")
    )
    draw = F.pmod(keyed_hash(F.col("id"), seed=13), F.lit(1 << 30)) / float(1 << 30)
    picked = rows.where(draw < share).select(number.alias("language"), "text")

    def counts(batches):
        for part, texts in text_chunks(batches, "text"):
            h, owner, _ = ngrams(texts)
            by = np.array(part.column(0).to_pylist(), np.int64)[owner]
            for k in np.unique(by):
                grams, times = np.unique(h[by == k], return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "language": pa.array(np.full(len(grams), k), pa.int32()), "gram": grams.view(np.int64),
                        "n": pa.array(times, pa.int64()),
                    }
                )

    seen = picked.mapInArrow(counts, "language int, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n"))
    totals = seen.groupBy("language").agg(F.sum("n").alias("total"))
    rates = seen.join(F.broadcast(totals), "language").withColumn("rate", F.col("n") / F.col("total"))
    per_gram = rates.groupBy("gram").agg(
        F.max("rate").alias("most"), F.collect_list(F.struct("language", "n", "rate")).alias("held")
    )
    kept = per_gram.select("gram", "most", F.explode("held").alias("x")).where(
        (F.col("x.rate") >= MIN_SHARE * F.col("most")) & (F.col("x.n") >= MIN_COUNT)
    )
    probes = F.array(*(F.shiftrightunsigned("gram", 20 * k).bitwiseAND(F.lit(SLOTS - 1)) for k in range(PROBES)))
    bit = F.expr(f"shiftleft(1L, x.language % {WORD_BITS})")
    slots = (
        kept.select(F.explode(probes).alias("slot"), F.expr(f"x.language div {WORD_BITS}").alias("word"), bit.alias("bit"))
        .groupBy("slot", "word").agg(F.bit_or("bit").alias("bits"))
    )
    got = slots.toPandas()
    empty[got["slot"].to_numpy(np.int64), got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    bits = [(empty[:, k // WORD_BITS] >> np.uint32(k % WORD_BITS)) & np.uint32(1) for k in range(len(languages))]
    return Filters(languages, empty, max(sizes, key=lambda x: x[1])[0], np.array([b.mean() for b in bits]))


def identify(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score`` to the other columns; the text is not returned.

    NULL texts and texts without a letter are ``und`` with score 0; a text none of whose n-grams is known gets the language
    with most documents, with score 0. Of equally good languages the first by name holds. Columns of ``docs`` that are called
    like these are returned with an underscore behind the name.
    """
    docs, (text_col,) = set_aside(docs, ["lang_pred", "score"], text_col)
    held = docs.sparkSession.sparkContext.broadcast(filters)  # its size is set by SLOTS and the number of languages

    def run(texts):
        names, scores = held.value.predict(texts)
        return {"lang_pred": names, "score": scores}

    return map_texts(docs, text_col, run, "lang_pred string, score double")
