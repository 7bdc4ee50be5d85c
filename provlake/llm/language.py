"""Language ID by compression: the language whose dictionary makes a text smallest.

For each language a raw-content zstandard dictionary is cut from a bounded sample of labelled texts.  A text
is compressed whole, in pieces of PIECE bytes, once with each dictionary; the smallest sum wins.  The
score is the saving of the winner over the runner-up; below MARGIN the text is rejected.

The sample: labelled rows of the learning part, those with the least hash of doc_id until about SAMPLE_BYTES for each
language (a documented bound; languages are few).  Null text, or text without a letter: `und`, score 0,
rejected.  Ties: the first language in order of name.  Without labelled rows every text is `und`.
Repeated rows: each row alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import small_batches

PIECE = 2048
SAMPLE_BYTES = 128 * 1024
SAMPLE_ROWS = 400
MARGIN = 0.01
LEVEL = 6
_FOLD = bytes(c if c > 127 or chr(c).isalpha() else 32 for c in range(256))


def learn(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES, sample_rows: int = SAMPLE_ROWS) -> dict[str, bytes]:
    """Language -> dictionary content.  Driver memory: sample_bytes for each language.

    Rows whose crc32(doc_id) leaves 1 modulo 3 are held out: nothing is learned from them.
    """
    rows = docs.where("text is not null and lang is not null").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    wide = 1 << 31
    put = F.pmod(F.xxhash64("doc_id"), F.lit(wide))
    # about sample_rows rows a language, chosen by hash; each gives at most its share of the sample
    few = rows.join(F.broadcast(counts), "lang").where(put < F.lit(float(sample_rows)) / F.col("n") * wide)
    share = max(1, sample_bytes // 64)
    few = few.select("lang", put.alias("put"), F.substring("text", 1, share).alias("text"))
    got: dict[str, list] = {}
    for r in sorted(few.collect(), key=lambda r: (r.lang, r.put)):
        got.setdefault(r.lang, []).append(folded(r.text))
    out = {}
    for lang, texts in got.items():
        whole = b"\n".join(texts)
        out[lang] = whole[:sample_bytes]
    return out


def folded(text: str) -> bytes:
    """Lower case; runs of ASCII characters other than letters are one space."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split())


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Compressors:
    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.langs = sorted(content)
        self.made = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.made.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, data: bytes, piece: int = PIECE) -> list[int]:
        parts = [data[i : i + piece] for i in range(0, len(data), piece)]
        return [sum(len(c.compress(p)) for p in parts) for c in self.made]

    def predict(self, text: str | None, margin: float = MARGIN) -> tuple[str, float, bool]:
        if not text or not self.langs or not _has_letter(text):
            return "und", 0.0, False
        sizes = self.sizes(folded(text))
        by = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        if len(by) == 1:
            return self.langs[0], 1.0, True
        score = 1.0 - sizes[by[0]] / sizes[by[1]]
        return self.langs[by[0]], score, score >= margin


def identify_language(docs: DataFrame, content: dict[str, bytes] | None = None, margin: float = MARGIN, learn_from: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted."""
    content = learn(learn_from if learn_from is not None else docs) if content is None else content
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return small_batches(docs).select("doc_id", held_out.alias("held_out"), predictor(content, margin)(F.col("text").cast("string")).alias("_r")).select("doc_id", "held_out", "_r.*")


def predictor(content: dict[str, bytes], margin: float = MARGIN):
    """A column function: text -> (lang_pred, score, accepted)."""

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Compressors(content)
        for texts in batches:
            got = [model.predict(t, margin) for t in texts]
            yield pd.DataFrame({"lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "accepted": [g[2] for g in got]})

    return run


def keep_identified(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """The rows of docs whose language is told with margin; all columns as they were."""
    return small_batches(docs).where(predictor(learn(docs), margin)(F.col("text").cast("string"))["accepted"])
