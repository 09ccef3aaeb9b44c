"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one bit per language at every position, so one look
at a few positions returns all languages that contain an n-gram. A text's n-grams
are counted per language, the counts are corrected for the false positives that the
filling of each language's slice lets expect, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


GRAM = 4  # letters and word ends per n-gram
GRAMS_PER_LANGUAGE = 1 << 15
POSITIONS = 1 << 20
HASHES = 2
TRAINING_ROWS = 8_000  # about so many labelled texts per language are counted
MAX_LANGUAGES = 64
SLICE = 1 << 20  # code points of a text that are held as n-grams at once


def _letters() -> np.ndarray:
    """For each code point of the basic plane, whether it is a letter; others are asked one by one."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def grams(text: str, letters: np.ndarray) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text in slices; runs of anything but letters count as one word end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    basic = points < 0x10000
    letter = letters[np.where(basic, points, 0)]
    if not basic.all():
        letter[~basic] = [chr(c).isalpha() for c in points[~basic].tolist()]
    if not letter.any():
        return
    keep = letter | np.concatenate([[False], letter[:-1]])
    points = np.concatenate([[0], np.where(letter, points, 0)[keep], [0]]).astype(np.uint64)
    for start in range(0, max(len(points) - GRAM + 1, 1), SLICE):
        part = points[start : start + SLICE + GRAM - 1]
        if len(part) < GRAM:
            part = np.concatenate([part, np.zeros(GRAM - len(part), np.uint64)])
        code = np.zeros(len(part) - GRAM + 1, np.uint64)
        for i in range(GRAM):
            code = code * np.uint64(0x9E3779B97F4A7C15) + part[i : i + len(code)] + np.uint64(1)
        yield (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class LanguageFilter:
    """Languages in code point order, the bit-sliced table, and each slice's rate of false positives."""

    languages: list[str]
    table: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def build(cls, listed: list[tuple[str, int]]) -> LanguageFilter:
        languages = sorted({lang for lang, _ in listed})
        if len(languages) > MAX_LANGUAGES:
            raise ValueError(f"{len(languages)} languages; a mask holds {MAX_LANGUAGES}")
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(t).itemsize * 8 >= len(languages))
        table, rates = np.zeros(POSITIONS, kind), []
        for bit, language in enumerate(languages):
            codes = np.array([g for lang, g in listed if lang == language], np.int64).view(np.uint64)
            for at in positions(codes):
                table[at] |= kind(1 << bit)
            filled = np.count_nonzero(table & kind(1 << bit)) / POSITIONS
            rates.append(filled**HASHES)
        return cls(languages, table, np.array(rates))

    def shares(self, text: str | None, letters: np.ndarray) -> np.ndarray | None:
        """Share of the text's n-grams that each language holds, freed of false positives; None without letters."""
        hits, total = np.zeros(len(self.languages)), 0
        for codes in grams(text or "", letters):
            masks = None
            for at in positions(codes):
                masks = self.table[at] if masks is None else masks & self.table[at]
            total += len(masks)
            if len(self.languages) <= 8:
                counts = np.bincount(masks, minlength=256)
                hits += [counts[(np.arange(256) >> b & 1) == 1].sum() for b in range(len(self.languages))]
            else:
                hits += [np.count_nonzero(masks & masks.dtype.type(1 << b)) for b in range(len(self.languages))]
        if not total:
            return None
        return np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0, 1)


def positions(codes: np.ndarray) -> list[np.ndarray]:
    """The places of each n-gram in the table."""
    shift = np.uint64(64 - (POSITIONS.bit_length() - 1))
    mixed = [codes, codes * np.uint64(0xD6E8FEB86659FD93)][:HASHES]
    return [(m >> shift).astype(np.int64) for m in mixed]


def held_out(doc_id: Column) -> Column:
    """Documents whose crc32 of the id as text leaves 2 when divided by 4; false for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(labelled: DataFrame, rows: int = TRAINING_ROWS) -> LanguageFilter:
    """The filter of the commonest n-grams of each language, from columns text and lang.

    Rows with a null text or lang teach nothing. Of each language a share is counted
    that gives about `rows` texts, chosen by a hash of the text; all its n-grams are
    counted in tasks and the commonest GRAMS_PER_LANGUAGE go to the driver.
    """
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return LanguageFilter.build([])
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(rows / r["n"])) for r in sizes])
    chosen = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letters = _letters()

        def added_up(lang: str, codes: list[np.ndarray]) -> pd.DataFrame:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            return pd.DataFrame({"lang": lang, "gram": code.view(np.int64), "n": n})

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                held, size = [], 0
                for codes in (g for t in texts for g in grams(t, letters)):
                    held.append(codes)
                    size += len(codes)
                    if size >= SLICE:
                        yield added_up(lang, held)
                        held, size = [], 0
                if held:
                    yield added_up(lang, held)

    counted = chosen.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= GRAMS_PER_LANGUAGE)
    return LanguageFilter.build([(r["lang"], r["gram"]) for r in top.select("lang", "gram").collect()])


def predict_languages(documents: DataFrame, model: LanguageFilter, keep: list[str]) -> DataFrame:
    """Columns `keep`, lang_pred and score of every row, from the whole text alone.

    score is the winner's share of the text's n-grams. `und` with score 0 if the
    text is null, empty or has no letter, or if nothing was learned; ties go to the
    first language in code point order. Columns called lang_pred or score are replaced.
    """
    spread = documents.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in keep if c not in ("lang_pred", "score")]

    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters, own = _letters(), spread.value
        for batch in texts:
            found = [own.shares(t, letters) if own.languages else None for t in batch]
            yield pd.DataFrame(
                {
                    "lang_pred": ["und" if s is None else own.languages[int(np.argmax(s))] for s in found],
                    "score": [0.0 if s is None else float(s.max()) for s in found],
                }
            )

    judged = F.pandas_udf(predict, "lang_pred string, score double")
    return documents.select(*[F.col(f"`{c}`") for c in keep], judged("text").alias("_judged")).select(
        *[F.col(f"`{c}`") for c in keep], "_judged.lang_pred", "_judged.score"
    )
