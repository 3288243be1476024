"""Language identification by compression.

For each language a zstandard raw-content dictionary is cut from a bounded sample of
labelled texts. A text is reduced to lower-case letters and cut into chunks; each
chunk is compressed on its own with every dictionary, and the language with the
smallest total wins. A text whose two smallest totals are close is rejected
(``reliable`` false). Chunks keep the dictionary relevant over a whole long text.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_texts, remainder

FOLDS = 5
SAMPLE_TEXTS = 256  # per language
SLICE_CHARS = 400  # of each sampled text
CHUNK = 1024  # bytes compressed together
WINDOW_LOG, SEARCH_LOG, MIN_MATCH = 17, 6, 4  # greedy matches of 4 letters or more tell languages apart best
MIN_MARGIN = 0.01  # of the second smallest total
SHARPNESS = 30.0
UNKNOWN = "und"


def letters(text: str) -> str:
    """Lower case, every run of other characters than letters as one space."""
    import re

    return re.sub(r"[\W\d_]+", " ", text.lower()).strip()


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """One dictionary per language, from rows whose crc32(id) mod ``FOLDS`` is not 0.

    Uses at most ``SAMPLE_TEXTS`` texts of a language (those of smallest hash of id and text) and of
    each a slice of ``SLICE_CHARS`` characters; a missing text or label teaches nothing.
    """
    text = F.col(text_col)
    h = F.xxhash64(id_col, text_col)  # with the id, so that copies of a text do not fill a sample
    at = F.pmod(h, F.greatest(F.length(text) - SLICE_CHARS, F.lit(1))).cast("int") + 1
    rows = docs.where(text.isNotNull() & F.col(lang_col).isNotNull() & (remainder(id_col, FOLDS) != 0)).select(
        F.col(lang_col).alias("lang"), h.alias("h"), F.substring(text, at, F.lit(SLICE_CHARS)).alias("piece")
    )
    best = Window.partitionBy("lang").orderBy("h", "piece")
    rows = rows.withColumn("n", F.row_number().over(best)).where(F.col("n") <= SAMPLE_TEXTS)
    found: dict[str, list[str]] = {}
    for r in rows.orderBy("lang", F.desc("n")).collect():  # SAMPLE_TEXTS slices a language
        found.setdefault(r["lang"], []).append(letters(r["piece"]))
    return {k: v for k, v in ((k, " ".join(x).encode()) for k, x in found.items()) if len(v) >= 8}


def classifier(dictionaries: dict[str, bytes]):
    """texts -> [languages, scores, margins, reliable flags]."""
    import zstandard as z

    langs = sorted(dictionaries)
    params = z.ZstdCompressionParameters(
        window_log=WINDOW_LOG,
        chain_log=WINDOW_LOG - 1,
        hash_log=WINDOW_LOG - 2,
        search_log=SEARCH_LOG,
        min_match=MIN_MATCH,
        strategy=z.STRATEGY_GREEDY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    engines = []
    for k in langs:
        d = z.ZstdCompressionDict(dictionaries[k], dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        engines.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def predict(text: str | None):
        if not langs or text is None or not any(map(str.isalpha, set(text))):
            return UNKNOWN, 0.0, 0.0, False
        raw = letters(text).encode("utf-8", "surrogatepass")
        chunks = [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)] or [b""]
        sizes = [sum(map(len, map(c, chunks))) for c in engines]
        order = sorted(range(len(langs)), key=lambda i: (sizes[i], i))
        best = sizes[order[0]]
        second = sizes[order[1]] if len(langs) > 1 else 2 * best
        margin = (second - best) / second
        odds = sum(math.exp(-SHARPNESS * (s - best) / max(best, 1)) for s in sizes)
        return langs[order[0]], 1.0 / odds, margin, margin >= MIN_MARGIN

    def run(texts: list):
        return [list(x) for x in zip(*map(predict, texts))]

    return run


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", keep: list | None = None
) -> DataFrame:
    """``keep`` columns (default: none) + lang_pred, score, margin, reliable, one row per input row.

    Null texts and texts without a letter are ``und`` with score 0, as is everything
    when nothing was learned; equal sizes go to the language first in order. Whole
    texts are read, however long. An empty table gives no rows.
    """
    return map_texts(docs, text_col, keep, lambda: classifier(dictionaries), "lang_pred string, score double, margin double, reliable boolean")
