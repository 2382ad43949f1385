"""Licence scan with DataFrame functions alone: rare licence words looked up by position, then phrases verified.

Licence texts are templates. An index holds the words of highest inverse document frequency over the templates, with
their positions in them. A file's index words are looked up; each suggests where a template would begin, and the postings
of that template are intersected by relative position: how many of its rare words stand where they ought to. A template
is reported if enough do and its mandatory key phrases stand there too. A licence's name is a template of its own, whose
key phrase is all of it, so every place of a name is found by its rarest word and verified word by word.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.decontaminate import words_of
from farebox.llm.tasks import own_columns, spare_names, without

# Rare words of a template that are looked up and intersected, and the share of them that must stand in their places.
RARE_WORDS = 8
ENOUGH = 0.6
# Words that may be missing or added before a rare word without moving it out of its place.
SLACK = 3

# Names of licences and their labels.
NAMES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening or characteristic terms of public licences, their mandatory key phrases and labels.
TERMS = {
    "mit-terms": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ["to deal in the software without restriction", "permission is hereby granted free of charge"]),
    "apache-2.0-notice": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the "
        "license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        ["except in compliance with the license", "unless required by applicable law"]),
    "bsd-terms": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        ["redistribution and use in source and binary forms", "must retain the above copyright notice"]),
    "isc-terms": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ["for any purpose with or without fee"]),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version this program is distributed in the hope that it will be useful but without any warranty",
        ["under the terms of the gnu general public license", "at your option any later version"]),
    "lgpl-notice": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation",
        ["under the terms of the gnu lesser general public license"]),
    "agpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general "
        "public license as published by the free software foundation",
        ["under the terms of the gnu affero general public license"]),
    "mpl-2.0-notice": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        ["subject to the terms of the mozilla public license"]),
    "zlib-terms": (
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software permission is granted to anyone to use this software "
        "for any purpose including commercial applications and to alter it and redistribute it freely",
        ["permission is granted to anyone to use this software", "alter it and redistribute it freely"]),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary",
        ["free and unencumbered software", "released into the public domain"]),
    "cc-by-terms": (
        "this work is licensed under the creative commons attribution 4 0 international license to view a copy of this "
        "license visit",
        ["licensed under the creative commons attribution"]),
}


class Template(NamedTuple):
    """A licence text: its postings are (position, word) of its rare words, its keys (position, words)."""

    label: str
    is_name: bool
    postings: list[tuple[int, str]]
    keys: list[tuple[int, list[str]]]


def _words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _place(words: list[str], phrase: list[str]) -> int:
    found = [i for i in range(len(words)) if words[i:i + len(phrase)] == phrase]
    if not found:
        raise ValueError(f"the template lacks its key phrase: {' '.join(phrase)}")
    return found[0]


def make_index(names: dict[str, str], terms: dict[str, tuple[str, list[str]]], rare_words: int = RARE_WORDS) -> list[Template]:
    """Templates with the postings of their words of highest inverse document frequency over all templates.

    A name has one posting, its rarest word; of terms every chosen word is looked up at its first position.
    """
    texts = [(label, True, _words(name), [_words(name)]) for name, label in names.items()]
    texts += [(label, False, _words(text), [_words(k) for k in keys]) for label, (text, keys) in terms.items()]
    having = Counter(w for _, _, words, _ in texts for w in set(words))
    index = []
    for label, is_name, words, keys in texts:
        if not words:
            raise ValueError(f"the template of {label} has no words")
        first = {w: i for i, w in reversed(list(enumerate(words)))}
        rarest = sorted(first, key=lambda w: (-math.log(len(texts) / having[w]), first[w]))[:1 if is_name else rare_words]
        index.append(Template(label, is_name, sorted((first[w], w) for w in rarest), [(_place(words, k), k) for k in keys]))
    return index


INDEX = make_index(NAMES, TERMS)


def _structs(rows: list[dict]) -> Column:
    """A literal array of structs; inner lists of dicts become arrays of structs too."""

    def literal(value):
        return _structs(value) if isinstance(value, list) else F.lit(value)

    return F.array(*[F.struct(*[literal(v).alias(k) for k, v in row.items()]) for row in rows])


def _stands(words: str, start: Column, key: Column) -> Column:
    """Whether the words of a key phrase stand at ``start``; single words are fetched, so a long text costs no more."""
    return F.forall(key["words"], lambda x: F.get(F.col(words), start + x["offset"]).eqNullSafe(x["word"]))


def scan_licenses(documents: DataFrame, text: str = "text", index: list[Template] | None = None) -> DataFrame:
    """``documents`` with ``n_words``, ``name_places`` (label and start of every place of a licence's name, by start),
    ``license_terms`` (label, start and share of every place of licence terms), and ``license_score``.

    The score is 0 without anything, 0.5 with names alone, and 0.5 and half the greatest share with terms.

    NULL has no words. Repeated rows give repeated rows, an empty table gives none. Columns of the result's names are
    replaced, others pass through unchanged. A text of any length is looked at whole, in time that grows with its words.
    """
    index = INDEX if index is None else index
    out = ["n_words", "name_places", "license_terms", "license_score"]
    rest = without(documents, out)
    words, places, found = spare_names(documents, 3)

    templates = _structs([{
        "label": t.label, "is_name": t.is_name, "slack": 0 if t.is_name else SLACK,
        "postings": [{"at": p, "word": w} for p, w in t.postings],
        "keys": [{"at": p, "words": [{"offset": i, "word": w} for i, w in enumerate(k)]} for p, k in t.keys],
    } for t in index])
    postings = _structs([{"word": w, "at": p, "of": i} for i, t in enumerate(index) for p, w in t.postings])
    rare = sorted({w for t in index for _, w in t.postings})

    def within_slack(template: Column, place: Column, holds) -> Column:
        return F.exists(F.sequence(place - template["slack"], place + template["slack"]), holds)

    def share(candidate: Column) -> Column:
        template = F.get(templates, candidate["of"])
        in_place = F.filter(template["postings"], lambda q: within_slack(
            template, candidate["start"] + q["at"], lambda i: F.get(F.col(words), i).eqNullSafe(q["word"])))
        return F.size(in_place) / F.size(template["postings"])

    def verified(candidate: Column) -> Column:
        template = F.get(templates, candidate["of"])
        return F.forall(template["keys"], lambda k: within_slack(
            template, candidate["start"] + k["at"], lambda i: _stands(words, i, k)))

    def named(candidate: Column) -> Column:
        template = F.get(templates, candidate["of"])
        return F.struct(template["label"].alias("label"), template["is_name"].alias("is_name"), candidate["start"].alias("start"), candidate["share"].alias("share"))

    # one projection per step, each used several times by the next, so that none is computed twice
    split = documents.select(*own_columns(rest), words_of(documents[f"`{text}`"]).alias(words))
    looked_up = split.select(*own_columns(split, rest), F.col(words), F.filter(
        F.sequence(F.lit(0), F.size(words)), lambda i: F.get(F.col(words), i).isin(rare)).alias(places))
    # a candidate (where a template would begin, which template) is one number, so that repeats are found by hashing
    longest, many = max(p for t in index for p, _ in t.postings), len(index)
    codes = F.array_distinct(F.flatten(F.transform(places, lambda i: F.transform(
        F.filter(postings, lambda q: q["word"] == F.get(F.col(words), i)),
        lambda q: (i - q["at"] + longest).cast("long") * many + q["of"]))))
    candidates = F.transform(codes, lambda c: F.struct(
        (F.floor(c / many) - longest).cast("int").alias("start"), (c % many).cast("int").alias("of")))
    # phrases are compared only where enough rare words are in place
    scored = F.transform(candidates, lambda c: F.struct(c["start"].alias("start"), c["of"].alias("of"), share(c).alias("share")))
    good = F.transform(F.filter(F.filter(scored, lambda c: c["share"] >= ENOUGH), verified), named)
    nothing = F.array().cast("array<struct<label:string,is_name:boolean,start:int,share:double>>")
    judged_rows = looked_up.select(
        *own_columns(looked_up, rest), F.size(words).alias("n_words"),
        F.when(F.size(places) > 0, good).otherwise(nothing).alias(found))
    names = F.transform(F.filter(found, lambda c: c["is_name"]), lambda c: F.struct(c["start"], c["label"]))
    terms = F.transform(F.filter(found, lambda c: ~c["is_name"]), lambda c: F.struct(c["start"], c["label"], c["share"]))
    score = F.greatest(
        F.when(F.exists(found, lambda c: c["is_name"]), F.lit(0.5)).otherwise(F.lit(0.0)),
        F.coalesce(0.5 + 0.5 * F.array_max(F.transform(F.filter(found, lambda c: ~c["is_name"]), lambda c: c["share"])), F.lit(0.0)))
    return judged_rows.select(
        *own_columns(judged_rows, rest), F.col("n_words"), F.sort_array(names).alias("name_places"),
        F.sort_array(terms).alias("license_terms"), score.alias("license_score"))

