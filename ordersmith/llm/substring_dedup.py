"""Exact removal of word sequences that stand in an earlier document, by seed and extend.

Seeds are winnowed anchors: of the ``k``-word grams of every ``size``-word window the
one with the smallest hash. Documents are joined on them (``repeats``): each seed is
extended both ways to all its windows reach, equal extensions are one class that
travels once, and the first document of a class keeps its text. Where extensions
differ (the edges of a match) the windows are compared one by one; the windows found
again make up the maximal repeats of at least ``size`` words, which are cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import KEYS, Spec, anchor_events, keyed, open_windows, outcome, put_back, set_aside
from .staging import release, require, stage


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size: int = 50, k: int = 16) -> DataFrame:
    """``docs`` with n_tokens (words), n_removed, n_spans, removed (word spans) and kept.

    Every word covered by a ``size``-word window whose words also start in a document
    with a smaller id is removed; ``kept`` holds the other words joined by one space
    (UTF-8 bytes). Windows are judged on the input.

    Null or empty text: no words. Rows without an id rank before all others, by text
    hash; rows that share an id count as one document and never cut each other. Input columns
    named like the added ones are replaced; all others pass through.
    """
    require(docs, id_col, text_col)
    docs, names = set_aside(docs, KEYS)
    id_col, text_col = names.get(id_col, id_col), names.get(text_col, text_col)
    spec = Spec(words=True, size=size, k=k, by_doc=True)
    rows = keyed(docs, id_col, text_col)
    events = anchor_events(rows, spec, text_col)
    release(docs.sparkSession)
    found = open_windows(rows, events, spec, text_col)
    release(docs.sparkSession)
    # the first document of every open window value keeps it
    seen = found.where("kind = 1").select("window", "doc", "th")
    low = seen.groupBy("window").agg(F.min("doc").alias("doc"))
    firsts = stage(seen.join(low, ["window", "doc"])
                   .select("doc", "th", F.col("window").alias("first")).distinct(),
                   "substring-firsts")
    return put_back(outcome(rows, found, firsts, spec, text_col), names)
