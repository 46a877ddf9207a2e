"""License scans with a positional index of rare words.

The index holds, for each template, its words of the highest inverse document frequency and the places
where they stand in it. A file's words are looked up there; each hit proposes a place at which the
template would begin, and hits that agree propose the same place. A proposed place counts by the share
of template words that stand at their relative position; the template's key phrase must stand there in
full. Everything is built-in expressions; the frequencies are one aggregate over all files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import carried

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A wording; all of ``key`` must stand in place, and ``share`` of all words."""

    label: str
    text: str
    key: str
    share: float = 0.8
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def key_range(self) -> tuple[int, int]:
        words, key = self.words, self.key.split()
        start = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        return start, start + len(key)


def phrase(text: str, label: str) -> Template:
    return Template(label, text, text, 1.0, True)


#: Phrases and their labels.
PHRASES = (phrase("gnu general public license", "gpl"), phrase("apache license", "apache"), phrase("cc by", "cc-by"),
           phrase("mit license", "mit"))
#: Opening words of public licenses, and the usual lines that name one.
WORDINGS = (
    Template("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
             "general public license as published by the free software foundation", "gnu general public license"),
    Template("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
             "associated documentation files", "permission is hereby granted free of charge"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
             "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
             "mozilla public license"),
)


def words(text: str) -> Column:
    """The words of a text in order; none for null."""
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def frequencies(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[str, int]:
    """In how many documents each template word stands; at most one row for each such word is collected."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(F.array_intersect(words(text), F.array(*map(F.lit, vocabulary)))).alias("w"))
    counts = {r["w"]: r["n"] for r in found.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


def rare_words(templates: tuple[Template, ...], documents_with: dict[str, int], rare: int) -> dict[str, list[tuple[int, int]]]:
    """The index: word -> (template, place). A template that must match in full needs one word, others have ``rare``
    of those that occur at all, and one of the key phrase, which stands wherever the template is found."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        own = sorted(set(template.words), key=lambda w: (documents_with[w], w))
        if template.share == 1.0:
            chosen = own[:1]
        else:
            chosen = [w for w in own if documents_with[w]][:rare]
            first, end = template.key_range
            key = template.words[first:end]
            if not set(key) & set(chosen):
                chosen.append(next(w for w in own if w in key))
        for w in chosen:
            index.setdefault(w, []).extend((number, p) for p, x in enumerate(template.words) if x == w)
    return index


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + WORDINGS, rare: int = 3, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels, labels, score and places.

    ``places`` lists (label, start, share, base) of each template found, ``start`` counted in words from
    0. The base columns speak of the templates with ``base`` set; ``labels`` of all; ``score`` is the
    largest share at any proposed place, 0 without one. Null and empty texts have no words and no
    labels (an empty string). Rows are scanned each by itself; columns of ``docs`` with the names of
    the new ones are replaced, all others come out unchanged. The empty table gives no rows. Repeated rows are scanned each;
    places of one template that overlap are all listed. A very long text is one row like any other.
    """
    documents_with = frequencies(docs, templates, text)
    index = rare_words(templates, documents_with, rare)
    new = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"]
    user, kept = carried(docs, [c for c in docs.columns if c not in new])
    keys = list(index)
    postings = F.create_map(*(x for w in keys for x in (F.lit(w), F.array(*(
        F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in index[w])))))
    known = F.array(*(F.struct(
        F.lit(t.label).alias("label"), F.array(*map(F.lit, t.words)).alias("words"), F.lit(len(t.words)).alias("n"),
        F.lit(t.key_range[0]).alias("key_start"), F.lit(t.key_range[1]).alias("key_end"),
        F.lit(t.share).alias("least"), F.lit(t.base).alias("base")) for t in templates))

    def proposals(hit: Column) -> Column:
        return F.transform(F.element_at(postings, hit["w"]), lambda q: F.struct(q["t"].alias("t"), (hit["i"] - q["p"]).alias("start")))

    def judged(place: Column) -> Column:
        template = F.get(known, place["t"])
        same = F.transform(template["words"], lambda w, k: F.coalesce(F.get(F.col("_words"), place["start"] + k) == w, F.lit(False)))
        whole = F.size(F.filter(same, lambda x: x))
        key = F.size(F.filter(F.slice(same, template["key_start"] + 1, template["key_end"] - template["key_start"]), lambda x: x))
        share = whole / template["n"]
        return F.struct(template["label"].alias("label"), place["start"].alias("start"), share.alias("share"),
                        template["base"].alias("base"),
                        ((share >= template["least"]) & (key == template["key_end"] - template["key_start"])).alias("found"))

    hits = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(keys), F.struct(w.alias("w"), i.alias("i")))), lambda h: h.isNotNull())
    hits = F.when(F.arrays_overlap("_words", F.array(*map(F.lit, keys))), hits)
    rows = docs.select(user, words(text).alias("_words")).withColumn("_hits", hits)
    rows = rows.withColumn("_judged", F.transform(F.array_distinct(F.flatten(F.transform("_hits", proposals))), judged))
    rows = rows.withColumn("_found", F.coalesce(F.filter("_judged", lambda j: j["found"]), F.array().cast(
        "array<struct<label:string,start:int,share:double,base:boolean,found:boolean>>")))
    rows = rows.withColumn("_base", F.filter("_found", lambda j: j["base"]))

    def labels(places: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.col(places)["label"])), ",")

    return rows.select(
        *kept, F.size("_words").cast("long").alias("n_words"), F.size("_base").cast("long").alias("n_base"),
        F.array_min(F.col("_base")["start"]).cast("long").alias("first_word"),
        F.array_max(F.col("_base")["start"]).cast("long").alias("last_word"),
        labels("_base").alias("base_labels"), labels("_found").alias("labels"),
        F.coalesce(F.array_max(F.col("_judged")["share"]), F.lit(0.0)).alias("score"),
        F.transform("_found", lambda j: F.struct(j["label"].alias("label"), j["start"].alias("start"), j["share"].alias("share"),
                                                 j["base"].alias("base"))).alias("places"))
