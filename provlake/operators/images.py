"""Image candidates, text presence, the two-stage gate."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from provlake.functions.extract import has_keywords
from provlake.functions.text import col, optional_int
from provlake.functions.urls import image_url

# Words that exclude or prefer an image.
EXCLUDED = ("review", "banner", "icon", "logo", "thumb", "recommend", "related", "sns", "share", "badge", "cart", "coupon", "recent-product", "상품-대표",
    "대표-이미지", "/brand/", "member", "profile")
HINTS = ("goodsview", "goods_wrap", "goods_intro", "goods_point", "goods_note", "goods-detail", "product-detail", "detail", "description", "notice",
    "disclosure", "고시", "상세")
HERO = ("main", "hero", "cover", "recent")
NO_TEXT_BELOW, HAS_TEXT_ABOVE = 0.04, 0.12
MAX_SIDE = 640
FALLBACK = 5


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return text.rlike("|".join(f"\\Q{w}\\E" for w in words))


def candidates(images: DataFrame, page: str = "page_id", position: str = "position", base: str | Column | None = None) -> DataFrame:
    """Detail images of each page: preferred ones if there are any, else the first five (the cap is the feature).

    images: page, position, src, alt, class_name, dom_path, width, height.  base: the page's address, for relative ones.
    """
    url, w, h = image_url("src", base), optional_int(F.col("width").cast("string")), optional_int(F.col("height").cast("string"))
    hay = F.lower(F.concat_ws(" ", url, "alt", "class_name", "dom_path"))
    small = ((w < 200) & (h < 200)) | ((w > 800) & (h < 120)) | ((w <= 160) & (h <= 200))
    hint = _any(hay, HINTS)
    drop = _any(hay, EXCLUDED) | F.coalesce(small, F.lit(False)) | (_any(hay, HERO) & ~hint)
    rows = images.withColumn("source_url", url).where(url.isNotNull() & ~drop).withColumn("preferred", hint | F.coalesce((h >= 900) & (w >= 700), F.lit(False)))
    rows = rows.withColumn("_d", F.row_number().over(W.partitionBy(page, "source_url").orderBy(position))).where("_d = 1").drop("_d")
    rows = rows.withColumn("_any", F.max("preferred").over(W.partitionBy(page))).withColumn("_rn",
        F.row_number().over(W.partitionBy(page, "preferred").orderBy(position)))
    kept = rows.where((F.col("_any") & F.col("preferred")) | (~F.col("_any") & (F.col("_rn") <= FALLBACK)))
    return kept.withColumn("sequence", F.row_number().over(W.partitionBy(page).orderBy(position))).drop("_any", "_rn")


def text_score(gray: np.ndarray) -> float:
    """Share of strong edges (x 2.5) plus spread of brightness (x 0.3), at most 1.

    An edge is the full difference of the two neighbours along each axis; it is zero on the border of that axis.
    """
    g = gray.astype(np.float32)
    if not g.size:
        return 0.0
    across, down = np.zeros_like(g), np.zeros_like(g)
    if g.shape[1] > 2:
        across[:, 1:-1] = g[:, 2:] - g[:, :-2]
    if g.shape[0] > 2:
        down[1:-1] = g[2:] - g[:-2]
    m = np.hypot(across, down)
    return float(min(1.0, (m > max(30.0, float(np.percentile(m, 75)))).mean() * 2.5 + g.std() / 255.0 * 0.3))


def _shrunk(x: np.ndarray, n: int) -> np.ndarray:
    """Rows of x resampled to n by triangles as wide as the step (bilinear with smoothing), rounded to whole numbers."""
    step = len(x) / n
    centre = (np.arange(n) + 0.5) * step
    near = 1 - np.abs((np.arange(len(x)) + 0.5)[None, :] - centre[:, None]) / step
    w = np.maximum(near, 0)
    return np.floor(w / w.sum(1, keepdims=True) @ x + 0.5)


def shrink(gray: np.ndarray, most: int = MAX_SIDE) -> np.ndarray:
    """gray with its longest side at most `most`: columns first, then rows."""
    side = max(gray.shape)
    if side <= most:
        return gray
    h, w = (max(1, int(n * (most / side))) for n in gray.shape)
    return _shrunk(_shrunk(gray.T.astype(np.float64), w).T, h)


def decoded_score(image: str = "image") -> Column:
    """The score of a row of Spark's image source; null if it could not be decoded."""

    @F.pandas_udf("double")
    def run(images: pd.DataFrame) -> pd.Series:
        out = []
        for _, r in images.iterrows():
            n = max(1, int(r["nChannels"])) if r["height"] and r["height"] > 0 else 0
            if not n:
                out.append(None)
                continue
            px = np.frombuffer(r["data"], np.uint8).reshape(int(r["height"]), int(r["width"]), n).astype(np.float32)
            gray = px[..., 0] if n == 1 else px[..., :3] @ np.array([0.114, 0.587, 0.299], np.float32)
            out.append(text_score(shrink(np.floor(gray + 0.5))))
        return pd.Series(out, dtype="float64")

    return run(F.col(image))


def by_score(score: str | Column) -> Column:
    """struct(presence, confidence); null if the score decides nothing."""
    s = col(score)
    made = lambda p, c: F.struct(F.lit(p).alias("presence"), F.bround(c, 4).alias("confidence"))
    return F.when(s < NO_TEXT_BELOW, made("NO_TEXT", 1 - s)).when(s > HAS_TEXT_ABOVE, made("HAS_TEXT", s))


def by_prepass(n_blocks: str | Column, text: str | Column, confidence: str | Column) -> Column:
    n, c = F.coalesce(col(n_blocks), F.lit(0)), F.coalesce(col(confidence), F.lit(0.0))
    empty = F.trim(F.coalesce(col(text), F.lit(""))) == ""
    return F.when((n >= 2) & (c >= 0.5), "HAS_TEXT").when((n == 0) | empty, "NO_TEXT").when(c >= 0.5, "HAS_TEXT").otherwise("UNKNOWN")


def text_presence(images: DataFrame, prepass: DataFrame, key: str = "image_path") -> DataFrame:
    """images (key, score) with presence, method and note; only undecided rows meet the prepass table."""
    decided = images.withColumn("_s", by_score("score"))
    p = prepass.select(key, by_prepass("n_blocks", "text", "confidence").alias("_p"), F.col("confidence").alias("_c"))
    out = decided.join(p, key, "left")
    return out.select(
        *images.columns,
        F.when(F.col("score").isNull(), "UNKNOWN").otherwise(F.coalesce("_s.presence", "_p", F.lit("UNKNOWN"))).alias("text_presence"),
        F.when(F.col("_s").isNull() & F.col("score").isNotNull() & F.col("_p").isNotNull(), "PREPASS").otherwise("HEURISTIC").alias("detect_method"),
        F.coalesce("_s.confidence", "_c").alias("confidence"),
        F.when(F.col("score").isNull(), "image missing").when(F.col("_s").isNull() & F.col("_p").isNull(), "undecided").alias("notes"),
    )


def scaled(width: str | Column, height: str | Column, limit: int) -> Column:
    """struct(width, height) with the longest side at most limit; limit <= 0 leaves all as it is."""
    w, h = col(width), col(height)
    side = F.greatest(w, h)
    fit = lambda x: F.greatest(F.lit(1), F.floor(x * F.lit(limit) / side)).cast("int")
    keep = F.lit(limit <= 0) | (side <= limit)
    return F.struct(F.when(keep, w).otherwise(fit(w)).alias("width"), F.when(keep, h).otherwise(fit(h)).alias("height"))


def gate_branch(gate_text: str | Column, expiration_dom: str | Column, storage_dom: str | Column) -> Column:
    """FULL if the low-resolution text has a keyword, else DOM_ONLY if the page had a field, else RAW_ONLY."""
    dom = F.coalesce(F.nullif(col(expiration_dom), F.lit("")), F.nullif(col(storage_dom), F.lit(""))).isNotNull()
    return F.when(has_keywords(gate_text), "FULL").when(dom, "DOM_ONLY").otherwise("RAW_ONLY")


def renamed_by_content(images: DataFrame, product: str = "product_id", position: str = "position", digest: str = "sha256") -> DataFrame:
    """First of equal contents of each product, numbered, with a file name from product, number and digest."""
    first = images.withColumn("_d", F.row_number().over(W.partitionBy(product, digest).orderBy(position))).where("_d = 1").drop("_d")
    out = first.withColumn("sequence", F.row_number().over(W.partitionBy(product).orderBy(position)))
    return out.withColumn("local_name", F.format_string("%s_%02d_%s.jpg", F.col(product).cast("string"), "sequence", F.left(digest, F.lit(12))))
