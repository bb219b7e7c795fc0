"""Quality of extracted page text, 0 to 100, and whether a page needs character recognition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta.functions.text import GREEK, LATIN, count_of, strip, words

# Classes of characters that speak against a text.
GARBLED = r"[À-ÿĀ-ſƀ-ɏɐ-ʯʰ-˿Ḁ-ỿ]"
BOX = r"[─-╿▀-▟■-◿]"
SYMBOL = r"[℀-⅏∀-⋿⌀-⏿✀-➿￰-￿]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
CID = r"\(cid:\d+\)"
#: Characters below which a text has no quality, and points from which it is valid.
SHORT, VALID = 50, 40


def _counts(t: Column) -> Column:
    """What the score is made of, once for a text."""
    count = lambda p: count_of(t, p).cast("double")
    return F.struct(
        F.char_length(t).cast("double").alias("n"), F.char_length(strip(t)).alias("stripped"), count(GREEK).alias("greek"), count(LATIN).alias("latin"), count(GARBLED).alias("garbled"),
        count(BOX).alias("box"), count(SYMBOL).alias("symbol"), count(CONTROL).alias("control"), F.when(t.contains("(cid:"), F.regexp_count(t, F.lit(CID))).otherwise(0).alias("cids"),
        F.size(words(t)).alias("words"), F.char_length(F.regexp_replace(t, r"(?U)\s+", "")).alias("solid"), F.char_length(F.replace(t, F.lit("?"), F.lit(""))).alias("unasked"),
    )


def _judge(c: Column, least: int) -> Column:
    n = c["n"]
    greek, latin, garbled, box = (c[k] / n for k in ("greek", "latin", "garbled", "box"))
    cid = c["cids"] / F.greatest(F.lit(1), c["words"])
    garbage = (c["garbled"] + c["box"] + c["symbol"] + c["control"]) / n
    mean = F.when(c["words"] > 0, c["solid"] / c["words"]).otherwise(0.0)
    asks = (n - c["unasked"]) / n
    unreadable = (greek < 0.05) & (latin < 0.05)
    points = (
        F.lit(100.0) - garbled * 80 - box * 60 - c["symbol"] / n * 50 - c["control"] / n * 40 - garbage * 30 - F.least(cid, F.lit(1.0)) * 80
        - F.when(unreadable, 25).otherwise(0)
        - F.when(mean > 25, 25).when(mean > 15, 10).otherwise(0)
        - F.when(asks > 0.08, 40).otherwise(0)
        + F.when(greek > 0.3, 10).otherwise(0)
    )
    points = F.greatest(F.lit(0.0), F.least(F.lit(100.0), points))
    percent = lambda x: F.bround(x * 100).cast("int").cast("string")
    reason = (
        F.when(c["stripped"] < SHORT, "text too short (<50 chars)")
        .when(points >= least, "")
        .when(cid > 0.15, F.concat(F.lit("CID-keyed font, no ToUnicode map ("), percent(cid), F.lit("% cid tokens)")))
        .when(asks > 0.08, F.concat(F.lit("ASCII-substitution garble ("), percent(asks), F.lit("% '?')")))
        .when(garbled > 0.15, F.concat(F.lit("font-encoding garble ("), percent(garbled), F.lit("% extended-Latin)")))
        .when(box > 0.08, F.concat(F.lit("image-based content ("), percent(box), F.lit("% box/block glyphs)")))
        .when(unreadable, "insufficient readable text")
        .otherwise(F.concat(F.lit("low quality score "), F.bround(points).cast("int").cast("string")))
    )
    or_ = lambda short, x: F.when(c["stripped"] < SHORT, F.lit(short)).otherwise(x)
    third = lambda x: F.bround(x, 3)
    whole = or_(0, F.bround(points).cast("int"))
    return F.struct(whole.alias("score"), or_(0.0, third(greek)).alias("greek_ratio"), or_(1.0, third(garbage)).alias("garbage_ratio"), or_(0.0, third(box)).alias("box_ratio"), or_(0.0, third(cid)).alias("cid_ratio"), reason.alias("reason"), (whole >= VALID).alias("is_valid"))


def score(text: Column, least: int = VALID) -> Column:
    """struct<score, greek_ratio, garbage_ratio, box_ratio, cid_ratio, reason, is_valid>."""
    # the counts are bound once: whatever is asked of the result, a text is scanned once for each class
    return F.get(F.transform(F.array(_counts(F.coalesce(text, F.lit("")))), lambda c: _judge(c, least)), F.lit(0))


def needs_recognition(text: Column, shortest: int = 80) -> Column:
    """struct<need, corrupt, reason> for a page: too little text, or text of bad quality."""
    short = F.char_length(strip(F.coalesce(text, F.lit("")))) < shortest
    q = score(text)
    return F.when(short, F.struct(F.lit(True).alias("need"), F.lit(False).alias("corrupt"), F.lit("no text layer").alias("reason"))).otherwise(F.struct((~q["is_valid"]).alias("need"), (~q["is_valid"]).alias("corrupt"), q["reason"].alias("reason")))
