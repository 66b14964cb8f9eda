"""Evaluation texts leaking into training text: a prefix-filtered set join.

An item is a set of windows (10 words; for items written without spaces, 20 letters). A
document leaks an item if it holds all of one window, in order. Windows are sets of
shingles (5 words, or 8 letters) that must all be present, so a window needs only its rarest
shingle as prefix: the shingles of every window are ordered by their frequency in the whole
corpus, documents are joined on the rarest one, the match's position must leave room for
the rest of the window on both sides, and the window that the document has at that place is
compared with the item's, text by text.

The corpus is read once. What is kept of it are the places of the items' shingles, each with
the window of text that begins there, so texts are neither shuffled nor read again.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palisade.operators.skew import spread_join
from palisade.storage import materialize, workspace

WORDS, LETTERS = 10, 20
WORD_SHINGLE, LETTER_SHINGLE = 5, 8
#: shingles of held-out items up to this number are shared with the tasks (8 bytes each) to
#: keep other places of the corpus from being written; the join that follows needs no such help
SHARED_LIMIT = 2_000_000

_RUN = re.compile(r"[^\W_]+")
_FORMAT = {c: None for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cf"}


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits after NFKC, case folding and removing format characters."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).casefold().translate(_FORMAT)
    else:
        text = text.lower()
    return _RUN.findall(text)


def _id(tokens: list[str] | str) -> int:
    return xxhash.xxh64_intdigest(tokens if isinstance(tokens, str) else "\x1f".join(tokens)) - (1 << 63)


def shingles(kind: str, words: list[str]) -> Iterator[tuple[int, int, str | None]]:
    """(position, shingle, window) of a text's words: kind ``w`` words, kind ``c`` letters of the
    joined words. The window begins with the shingle; None where the text ends before it."""
    if kind == "c":
        joined, n = "".join(words), LETTER_SHINGLE
        for i in range(len(joined) - n + 1):
            yield i, _id(joined[i : i + n]), joined[i : i + LETTERS] if i + LETTERS <= len(joined) else None
    else:
        for i in range(len(words) - WORD_SHINGLE + 1):
            yield i, _id(words[i : i + WORD_SHINGLE]), " ".join(words[i : i + WORDS]) if i + WORDS <= len(words) else None


def kind_of(lang: str | None) -> str:
    """Items in Chinese go by letters, all others by words."""
    return "c" if (lang or "").strip().lower().partition("-")[0] == "zh" else "w"


_ITEM = "item_id bigint, kind string, pos bigint, shingle bigint, window string"


def _item_shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for item, lang, text in zip(pdf["item_id"], pdf["lang"], pdf["text"]):
            kind = kind_of(lang)
            rows += [(item, kind, p, s, w) for p, s, w in shingles(kind, words_of(text))]
        yield pd.DataFrame(rows, columns=["item_id", "kind", "pos", "shingle", "window"])


_DOC = "doc_id bigint, kind string, at bigint, shingle bigint, window string"


def _known_shingles(kind: str, words: list[str], wanted: frozenset[int], tokens: frozenset[str]) -> Iterator[tuple[int, int, str | None]]:
    """As :func:`shingles`, only the ``wanted`` ones; those with a token not in ``tokens`` are not even hashed."""
    sequence, n, width = ("".join(words), LETTER_SHINGLE, LETTERS) if kind == "c" else (words, WORD_SHINGLE, WORDS)
    run = 0
    for i, token in enumerate(sequence):
        run = run + 1 if token in tokens else 0
        if run >= n:
            at = i - n + 1
            if (s := _id(sequence[at : i + 1])) in wanted:
                window = sequence[at : at + width]
                yield at, s, (window if kind == "c" else " ".join(window)) if len(window) == width else None


def _doc_shingles(kinds: list[str], wanted: frozenset[int] | None, tokens: dict[str, frozenset[str]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                if not text:
                    continue
                words = words_of(text)
                for kind in kinds:
                    found = shingles(kind, words) if wanted is None else _known_shingles(kind, words, wanted, tokens[kind])
                    rows += [(doc, kind, p, s, w) for p, s, w in found]
            yield pd.DataFrame(rows, columns=["doc_id", "kind", "at", "shingle", "window"])

    return run


def _item_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = {(k, t) for lang, text in zip(pdf["lang"], pdf["text"]) for k in [kind_of(lang)] for t in ("".join(words_of(text)) if k == "c" else words_of(text))}
        yield pd.DataFrame(sorted(found), columns=["kind", "token"])


def find_leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): documents that hold 10 consecutive words (or 20 letters) of an item.

    ``documents`` has doc_id and text, ``items`` item_id, lang and text; further columns are
    ignored. Items with lang zh go by letters, all others by words.
    Null and short texts match nothing; repeated rows and passages give one row a pair.
    """
    spark = documents.sparkSession
    items = items.where("text is not null")
    side = materialize(items.select("item_id", "lang", "text").mapInPandas(_item_shingles, _ITEM), workspace(spark, "item-shingles"))
    kinds = [r[0] for r in side.select("kind").distinct().collect()]
    distinct = side.select("shingle").distinct()
    n_items = distinct.limit(SHARED_LIMIT + 1).count()
    wanted = frozenset(r[0] for r in distinct.collect()) if n_items <= SHARED_LIMIT else None
    docs = documents.select("doc_id", "text").where("text is not null")
    tokens: dict[str, frozenset[str]] = {}
    if wanted is not None:  # there are at most so many distinct words as shingles, and a few a window
        rows = items.select("lang", "text").mapInPandas(_item_tokens, "kind string, token string").distinct().collect()
        tokens = {k: frozenset(r.token for r in rows if r.kind == k) for k in kinds}
    met = docs.mapInPandas(_doc_shingles(kinds, wanted, tokens), _DOC)
    if wanted is None:
        met = met.join(side.select("kind", "shingle").distinct(), ["kind", "shingle"], "left_semi")
    met = materialize(met, workspace(spark, "met-shingles"))

    # order by rarity: the frequency of a shingle counts every place in the corpus
    frequency = met.groupBy("kind", "shingle").agg(F.count(F.lit(1)).alias("df"))
    ranked = side.join(frequency, ["kind", "shingle"], "left").withColumn("df", F.coalesce("df", F.lit(0)))
    best = F.struct("df", "shingle", "pos")
    windows = None
    for kind, width in (("w", WORDS - WORD_SHINGLE), ("c", LETTERS - LETTER_SHINGLE)):
        frame = Window.partitionBy("item_id", "kind").orderBy("pos").rowsBetween(0, width)
        w = ranked.where(F.col("kind") == kind).select("kind", "item_id", "pos", "window", F.min(best).over(frame).alias("rare"), F.min("df").over(frame).alias("least"))
        # a shingle that no document holds ends the window: it can't be contained
        w = w.where((F.col("window").isNotNull()) & (F.col("least") > 0))
        windows = w if windows is None else windows.unionByName(w)
    shift = F.col("rare.pos") - F.col("pos")
    windows = materialize(windows.select("item_id", "kind", F.col("window").alias("passage"), F.col("rare.shingle").alias("shingle"), shift.alias("shift")), workspace(spark, "item-windows"))
    # prefix join, then the positional bounds: the window must fit around the match
    places = met.select("doc_id", "kind", "at", "shingle")
    found = spread_join(windows, places, ["kind", "shingle"], F.col("doc_id")).withColumn("start", F.col("at") - F.col("shift")).where("start >= 0")
    found = found.select("doc_id", "item_id", "kind", "start", "passage").distinct()
    # a window begins with one of the items' shingles, so the document's text at that place is at hand
    there = met.where("window is not null").select("doc_id", "kind", F.col("at").alias("start"), F.col("window").alias("passage"))
    return found.join(there, ["doc_id", "kind", "start", "passage"], "left_semi").select("doc_id", "item_id").distinct()
