"""Licence scan with a positional index of rare words, in built-in functions only.

Each file is tokenized once, into its positional postings: where it holds words of the
licence templates. These give each such word a document frequency. A file that holds the
highest-IDF mandatory word of a template is looked up: that word's postings, counted from
the template's start, are intersected with those of the template's other mandatory words,
and what is left are the places where all key phrases stand in their relative positions.
All steps work on arrays inside the row; only word counts are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabstar.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A posting is position * WORD_LIMIT + number of the word; templates have fewer words than that.
WORD_LIMIT = 4096


@dataclass(frozen=True)
class Template:
    """``phrases`` must stand in a file at their place relative to the template's start."""

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False

    @property
    def words(self) -> list[str]:
        return re.findall(WORD, self.text)

    def mandatory(self) -> dict[int, str]:
        """Words of the key phrases by their place in the template."""
        at: dict[int, str] = {}
        for phrase in self.phrases:
            w = re.findall(WORD, phrase)
            first = next(i for i in range(len(self.words)) if self.words[i : i + len(w)] == w)
            at |= dict(enumerate(w, first))
        return at


#: The contract's phrases and labels.
BASE = (
    Template("cc-by", "cc by", ("cc by",), True),
    Template("gpl", "general public license", ("general public license",), True),
    Template("reserved", "all rights reserved", ("all rights reserved",), True),
)
#: Opening words of common licences; the phrases are what tells each from the others.
COMMON = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files",
        ("granted free of charge", "this software and associated documentation files"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
        ("for any purpose with or without fee",),
    ),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("cc-by-sa", "creative commons attribution sharealike", ("attribution sharealike",)),
    Template("cc-by", "creative commons attribution", ("creative commons attribution",)),
    Template("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    Template("unlicense", "free and unencumbered software released into the public domain", ("the public domain",)),
)


def file_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none.

    ``lower`` also changes letters outside ASCII, but the Kelvin sign is the only one it
    turns into an ASCII letter alone, so only that one could feign a template's word.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def postings(words: Column, vocabulary: Sequence[str]) -> Column:
    """Where words of the vocabulary stand, in order."""
    known = F.lit(list(vocabulary))
    code = lambda w, i: i.cast("long") * WORD_LIMIT + F.array_position(known, w) - 1
    held = F.transform(words, lambda w, i: F.when(w.isin(list(vocabulary)), code(w, i)))
    return F.filter(held, lambda p: p.isNotNull())


def document_frequency(files: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """In how many files each word occurs."""
    held = F.array_distinct(F.transform("_postings", lambda p: p % WORD_LIMIT))
    counts = files.select(F.explode(held).alias("w")).groupBy("w").count().collect()
    return dict.fromkeys(vocabulary, 0) | {vocabulary[r["w"]]: r["count"] for r in counts}


def scan_licences(
    docs: DataFrame,
    templates: Sequence[Template] = BASE + COMMON,
    keep: Sequence[str] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """Find licence templates in whole texts; a row for each input row.

    Returns ``keep``, ``n_words`` and ``matches``: for each template found, in order of the
    templates, array<struct<label, base, starts, score>>, where ``starts`` are all words at
    which it begins (from 0; below 0 if its first words are cut off) and ``score`` is the
    share of its words that stand in place there. A template is found where all its key
    phrases stand. Null and empty texts have no words and no match; repeated rows give
    repeated results.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    number = {w: i for i, w in enumerate(vocabulary)}
    if len(vocabulary) > WORD_LIMIT:
        raise ValueError(f"the templates have more than {WORD_LIMIT} different words")
    keep = [c for c in keep if c not in ("n_words", "matches")]
    words = F.col("_words")
    files = docs.select(*keep, file_words(F.col(text_col)).alias("_words"))
    files = stored(
        files.select(*keep, F.size(words).cast("long").alias("n_words"), postings(words, vocabulary).alias("_postings")),
        "licences",
    )
    df = document_frequency(files, vocabulary)
    held, rare = F.col("_postings"), set()

    def standing(word: str, place: int) -> Column:
        """Template starts for which this word stands at its place."""
        own = F.filter(held, lambda p: p % WORD_LIMIT == number[word])
        return F.transform(own, lambda p: F.floor(p / WORD_LIMIT) - place)

    def match(t: Template) -> Column:
        by_idf = sorted(t.mandatory().items(), key=lambda x: (df[x[1]], x))  # highest IDF first
        rare.add(number[by_idf[0][1]])
        starts = reduce(F.array_intersect, [standing(w, place) for place, w in by_idf])
        in_place = lambda s: F.transform(
            F.lit([number[w] for w in t.words]), lambda w, i: (s + i) * WORD_LIMIT + w
        )

        def shares(starts: Column) -> Column:
            found = F.size(F.array_intersect(F.flatten(F.transform(starts, in_place)), held))
            return F.least(F.lit(1.0), found / F.greatest(F.size(starts) * len(t.words), F.lit(1)))

        return F.transform(
            F.array(starts),
            lambda s: F.struct(F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.alias("starts"), shares(s).alias("score")),
        )

    found = F.filter(F.concat(*map(match, templates)), lambda m: F.size(m["starts"]) > 0)
    lookup = F.exists(held, lambda p: (p % WORD_LIMIT).isin(sorted(rare)))
    none = F.from_json(F.lit("[]"), "array<struct<label:string,base:boolean,starts:array<bigint>,score:double>>")
    return files.select(*keep, "n_words", F.when(lookup, found).otherwise(none).alias("matches"))
