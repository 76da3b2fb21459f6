"""License scans: phrases, and an exact set-similarity join of text blocks with license templates. DataFrame functions only.

A block is a window of consecutive words, whatever lines they stand on: as many as the template's wording has and a quarter
more (three at least), beginning at every word of the template. So a wrapped notice is whole in one block and words scattered
over a long line are not. Template words are put in one order, rarest in the corpus first, with frequencies counted over every
line of every document. A template of m words whose containment must reach a threshold needs o of them; a block with o must
hold one of the template's m - o + 1 rarest words (prefix filter), it and the text must be o words long (length filter), and the
words within reach of that one must hold o (positional filter). What passes is counted exactly, and must hold the words that tell its license from others (``NAMES``). Templates are configuration and stand in the plan as literals, so documents are matched
where they are read: nothing is shuffled but one count per template word.

Defined cases: a null or empty text has no word, no label and score 0; repeated rows and null ids are rows like any
other; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingflow.llm.common import lower_ascii, staged

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: (label, wording) of notices, in the words that public licenses ask for.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)

_CREATIVE = "This work is licensed under a Creative Commons {} 4.0 International License."
#: Licenses that differ from one of ``TEMPLATES`` by a word or two.
NEIGHBOURS = (
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by-nc", _CREATIVE.format("Attribution-NonCommercial")),
    ("cc-by-sa", _CREATIVE.format("Attribution-ShareAlike")),
    ("cc-by-nd", _CREATIVE.format("Attribution-NoDerivatives")),
    ("cc-by-nc-sa", _CREATIVE.format("Attribution-NonCommercial-ShareAlike")),
    ("cc-by-nc-nd", _CREATIVE.format("Attribution-NonCommercial-NoDerivatives")),
    ("mpl", "Licensed under the Mozilla Public License, Version 2.0."),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
)
#: Words that tell licenses apart: a template that has one is only met with it, and not where words stand that another
#: template has besides the same ones ("CC BY" is not met in "CC BY-NC").
NAMES = {"mit", "apache", "gnu", "mozilla", "cc", "nc", "sa", "nd", "creative", "noncommercial", "sharealike", "noderivatives", "associated", "accompanying"}


def _words(text: Column) -> Column:
    """The words of a lower-cased text in order."""
    return F.filter(F.split(text, GAP), lambda w: w != "")


def template_words(wording: str) -> list[str]:
    return list(dict.fromkeys(in_order(wording)))


def in_order(wording: str) -> list[str]:
    import re

    return [w for w in re.split(GAP, wording.lower()) if w]


def spare(wording: str) -> int:
    """Words that a block may hold besides the wording's own."""
    return max(3, math.ceil(len(in_order(wording)) / 4))


def needed(words: int, containment: float) -> int:
    """How many of a template's words a block must hold."""
    return math.ceil(containment * words - 1e-9)


def distinguishing(templates: Sequence[Sequence[str]]) -> list[tuple[set[str], set[str]]]:
    """Per template the names it must be met with and those it must not stand beside."""
    named = [NAMES.intersection(words) for words in templates]
    return [(names, set().union(*[n - names for n in named if names and names < n])) for names in named]


def global_order(docs: DataFrame, vocabulary: Sequence[str]) -> list[str]:
    """``vocabulary``, rarest first by the number of lines that hold a word, over all lines."""
    line = F.explode(F.split(lower_ascii(F.col("text")), "\n")).alias("line")
    known = F.array(*[F.lit(w) for w in vocabulary])
    found = docs.select(line).select(F.explode(F.array_intersect(known, F.split("line", GAP))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan_licenses(
    docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, templates: Sequence[tuple[str, str]] = TEMPLATES + NEIGHBOURS, containment: float = 0.85
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``."""
    sets = [(label, template_words(wording), len(in_order(wording)) + spare(wording), spare(wording)) for label, wording in templates]
    told = distinguishing([words for _, words, _, _ in sets])
    order = global_order(docs, sorted({w for _, words, _, _ in sets for w in words}))
    rank = {w: k for k, w in enumerate(order)}
    text_array = lambda words: F.array(*[F.lit(w) for w in words]).cast("array<string>")
    listed, rarest = [], set()
    for (label, words, room, beside), (names, others) in zip(sets, told, strict=True):
        ordered = sorted(words, key=rank.__getitem__)
        need = needed(len(ordered), containment)
        prefix = ordered[: len(ordered) - need + 1]
        rarest.update(prefix)
        listed.append(F.struct(F.lit(label).alias("label"), text_array(ordered).alias("words"), text_array(prefix).alias("prefix"), F.lit(need).alias("need"), F.lit(room).alias("room"), F.lit(beside).alias("beside"), text_array(sorted(names)).alias("names"), text_array(sorted(others)).alias("others")))

    text = lower_ascii(F.coalesce("text", F.lit("")))
    nowhere = F.array().cast("array<int>")
    # Where rare words stand; texts without one cannot match.
    rare = F.when(
        F.arrays_overlap("w", text_array(sorted(rarest))), F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).isin(sorted(rarest)))
    ).otherwise(nowhere)

    def held(template: Column, first: Column, end: Column) -> Column:
        """The template's words at the places from ``first`` up to ``end``, without it."""
        return F.array_intersect(template["words"], F.slice("w", first + 1, end - first))

    def share(template: Column) -> Column:
        """The template's best containment in a block that reaches the threshold; null if none does."""
        earliest = lambda i: F.greatest(i - template["room"] + 1, F.lit(0))
        long_enough = lambda i: F.size("w") - earliest(i) >= template["need"]
        met = F.filter("rare", lambda i: F.array_contains(template["prefix"], F.get("w", i)) & long_enough(i) & (F.size(held(template, earliest(i), i + template["room"])) >= template["need"]))
        firsts = F.array_distinct(F.flatten(F.transform(met, lambda i: F.filter(F.sequence(earliest(i), i), lambda k: F.array_contains(template["words"], F.get("w", k))))))

        def tells(k: Column) -> Column:
            block = F.slice("w", k + 1, template["room"])
            last = F.array_max(F.transform(held(template, k, k + template["room"]), lambda word: F.array_position(block, word))).cast("int")
            start = F.greatest(k - template["beside"], F.lit(0))
            around = F.slice("w", start + 1, k + last + template["beside"] - start)
            return (F.size(F.array_except(template["names"], block)) == 0) & ~F.arrays_overlap(template["others"], around)

        reached = F.filter(firsts, lambda k: F.size(held(template, k, k + template["room"])) >= template["need"])
        sizes = F.transform(F.filter(reached, tells), lambda k: F.size(held(template, k, k + template["room"])))
        return F.array_max(sizes) / F.size(template["words"])

    matched = F.filter(F.transform(F.array(*listed), lambda t: F.struct(t["label"].alias("label"), share(t).alias("share"))), lambda m: m["share"].isNotNull())

    def places(phrase: str) -> Column:
        wanted = phrase.split()

        def here(i: Column) -> Column:
            out = F.get("w", i) == wanted[0]
            for k, word in enumerate(wanted[1:], 1):
                out = out & F.coalesce(F.get("w", i + k) == word, F.lit(False))
            return out

        return F.filter(F.sequence(F.lit(0), F.size("w") - 1), here)

    last_words = sorted({p.split()[-1] for p, _ in phrases})
    likely = F.lit(False)
    for word in last_words:
        likely = likely | F.contains("t", F.lit(word))
    likely = likely & (F.size("w") > 0)
    found = [F.when(likely, places(p)).otherwise(nowhere) for p, _ in phrases]
    # Each step's columns are computed once: Spark keeps them apart because later steps read them several times.
    read = docs.select("doc_id", text.alias("t")).select("doc_id", "t", _words(F.col("t")).alias("w"))
    read = read.select("doc_id", "w", F.size("w").alias("n_words"), *[f.alias(f"at{k}") for k, f in enumerate(found)], rare.alias("rare"))
    read = read.select("doc_id", "n_words", *[f"at{k}" for k in range(len(phrases))], F.when(F.size("rare") > 0, matched).otherwise(F.filter(F.array(F.struct(F.lit("").alias("label"), F.lit(0.0).alias("share"))), lambda m: F.lit(False))).alias("matched"))
    read = staged(read, "license-places")
    at = F.flatten(F.array(*[F.col(f"at{k}") for k in range(len(phrases))]))
    base = F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)])))
    every = F.array_union(base, F.transform("matched", lambda m: m["label"]))
    return read.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(at).cast("long").alias("n_base"), F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matched", lambda m: m["share"])), F.when(F.size(base) > 0, F.lit(1.0)), F.lit(0.0)).alias("score"),
    )
