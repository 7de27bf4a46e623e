"""License scans by a positional index of rare words, in DataFrame functions only.

Templates are short word sequences, each with a mandatory key phrase. A first pass counts in how many documents each template
word stands; its weight is the bit length of (documents + 1) div (frequency + 1), an inverse document frequency in whole
numbers. In the second pass a file's words are reduced to the rarest word of each template's key phrase. Where one stands, the
template's postings are laid over the file at the relative position: the key phrase has to stand there word for word, and the
score is the weight of all template words that stand at their places, by the weight of all. A hit has ``MIN_SCORE`` or more. As
a key phrase contains its own rarest word, no place is missed.

Edge cases: a null or empty text has no words and no labels, score 0; overlapping places all count; repeated rows are
scanned one by one; words are as in the file, of digits, letters and characters beyond ASCII, A-Z in lower case; texts of any
length are scanned whole; words of equal weight are ordered by their letters; an empty table gives no rows; other columns are not read, so their names can't clash.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.6
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """``text`` as it may stand in a file, ``key`` (a part of it) as it has to."""

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_start(self) -> int:
        own, key = self.words, self.key.split()
        return next(i for i in range(len(own)) if own[i:i + len(key)] == key)


BASE = (Template("mit", "mit license", "mit license", True),
        Template("apache", "apache license", "apache license", True),
        Template("gpl", "general public license", "general public license", True))

# Usual wordings of notices.
NOTICES = tuple(Template(*row) for row in (
    ("mit-notice", "released under the mit license", "mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license"),
))
TEMPLATES = (*BASE, *NOTICES)


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, BREAKS), lambda w: w != "")


def weights(docs: DataFrame, templates: tuple[Template, ...], text_col: str = "text") -> dict[str, int]:
    """Weight of each template word over all of ``docs``; as many rows as the templates have words come to the driver."""
    known = sorted({w for t in templates for w in t.words})
    found = F.array_intersect(words_of(F.col(text_col)), F.array(*map(F.lit, known)))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").count()
    everything = docs.count()
    rows = counts.select("word", F.length(F.bin(F.expr(f"{everything + 1}L div (count + 1)"))).alias("weight")).collect()
    highest = (everything + 1).bit_length()
    return {w: highest for w in known} | {r.word: r.weight for r in rows}


def index(templates: tuple[Template, ...], weight: dict[str, int]) -> Column:
    """The templates as an array: label, base, words, weights, total, anchor word and place, place and words of the key."""
    rows = []
    for t in templates:
        start, size = t.key_start, len(t.key.split())
        place = max(range(start, start + size), key=lambda i: (weight[t.words[i]], -i))
        own = [weight[w] for w in t.words]
        rows.append(F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.array(*map(F.lit, t.words)).alias("words"),
            F.array(*map(F.lit, own)).alias("weights"), F.lit(sum(own)).alias("total"),
            F.lit(t.words[place]).alias("anchor"), F.lit(place).alias("place"),
            F.array(*(F.lit(i) for i in range(start, start + size))).alias("key")))
    return F.array(*rows)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, min_score: float = MIN_SCORE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, hits array<struct<label, base, start, score>>: a row for each row of ``docs``."""
    weight = weights(docs, templates, text_col)
    known = index(templates, weight)
    anchors = sorted({max((w for w in t.key.split()), key=lambda w: weight[w]) for t in templates})
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    rows = rows.select("doc_id", "words", F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda x: x["word"].isin(anchors)).alias("rare"))

    def laid(t: Column, at: Column) -> Column:
        start = at - t["place"]
        own = F.transform(t["words"], lambda w, j: F.when(F.get("words", start + j) == w, F.get(t["weights"], j)).otherwise(0))
        verified = F.forall(t["key"], lambda j: F.coalesce(F.get("words", start + j) == F.get(t["words"], j), F.lit(False)))
        score = F.aggregate(own, F.lit(0), lambda a, b: a + b).cast("double") / t["total"]
        return F.struct(t["label"].alias("label"), t["base"].alias("base"), start.cast("long").alias("start"),
                        F.when(verified, score).otherwise(0.0).alias("score"))

    hits = F.flatten(F.transform("rare", lambda r: F.transform(
        F.filter(known, lambda t: t["anchor"] == r["word"]), lambda t: laid(t, r["at"]))))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"),
                       F.when(F.size("rare") > 0, F.filter(hits, lambda h: h["score"] >= min_score))
                       .otherwise(F.filter(hits, lambda h: F.lit(False))).alias("hits"))


def labels(hits: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")


def report(found: DataFrame) -> DataFrame:
    """A line for each row of ``scan``: counts, first and last place of base phrases, labels, score."""
    base = F.filter("hits", lambda h: h["base"])
    starts = F.transform(base, lambda h: h["start"])
    best = F.coalesce(F.array_max(F.transform("hits", lambda h: h["score"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("hits")).alias("labels"),
        best.alias("score"))


def report_sql(templates: tuple[Template, ...] = TEMPLATES, min_score: float = MIN_SCORE) -> str:
    """The same as SQL over ``documents``: all template words by relative position, without an index."""
    rows = ", ".join(
        f"({n}, '{t.label}', {t.base}, {j}, '{w}', {t.key_start <= j < t.key_start + len(t.key.split())}, {len(t.words)})"
        for n, t in enumerate(templates) for j, w in enumerate(t.words))
    # a document may stand in several rows, so rows are numbered
    return rf"""
    WITH docs AS (
      SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM documents),
    tpl (t, label, base, j, word, iskey, size) AS (VALUES {rows}),
    occ AS (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS p FROM docs),
    hit AS (SELECT o.n, o.word, o.p FROM occ o WHERE o.word IN (SELECT word FROM tpl)),
    df AS (SELECT word, count(DISTINCT n) AS f FROM hit GROUP BY word),
    everything AS (SELECT count(*) AS f FROM docs),
    weight AS (SELECT word, len(bin(((SELECT f FROM everything) + 1) // (coalesce(df.f, 0) + 1))) AS weight
               FROM (SELECT DISTINCT word FROM tpl) LEFT JOIN df USING (word)),
    full_weight AS (SELECT t, sum(weight) AS total, sum(iskey::INT) AS keys FROM tpl JOIN weight USING (word) GROUP BY t),
    laid AS (SELECT h.n, t, label, base, h.p - j AS start, sum(weight) AS own, sum(iskey::INT) AS keys
             FROM hit h JOIN tpl USING (word) JOIN weight USING (word) GROUP BY ALL),
    found AS (SELECT laid.*, own::DOUBLE / total AS score FROM laid JOIN full_weight USING (t)
              WHERE laid.keys = full_weight.keys AND own::DOUBLE / total >= {min_score}),
    best AS (SELECT n, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word,
                    max(start) FILTER (base) AS last_word, max(score) AS score,
                    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                    string_agg(DISTINCT label, ',' ORDER BY label) AS labels
             FROM found GROUP BY n)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
           last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           coalesce(score, 0.0)::DOUBLE AS score
    FROM docs LEFT JOIN best USING (n)
    """
