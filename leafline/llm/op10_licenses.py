"""Licence scans by a positional rare-token index.

Notices are parts (paragraphs) of licence texts; a postings table says at which places of which parts each
word stands, so that hundreds of notices are more rows and not a longer plan.

One scan of the texts writes a slim table: base phrases, which template words a text holds, and where these
words stand in texts that hold every word of some part's key phrases (no other text can get a label). Counts
of the words over all texts give their inverse document frequencies. For each part the rarest words, those
of its key phrases included, are looked up: their positions are joined with the postings, and a place where
AGREE words or more would have the part begin is a candidate. Candidates are joined with the part's words
by position, and verified where the whole key phrase stands in place.

The AGREE rarest words of a key phrase are always looked up, so no text in which a key phrase stands in place
is missed, whatever else it holds. Only built-in functions. The postings and frequencies are bounded
by the notices, not by the texts. Null texts are empty; every row is told apart by a written number, so that
repeated rows repeat and doc_ids may be null.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import materialize, read

# Words, base phrases with their labels, and paragraphs of public licence notices, each with its
# key phrase between bars. A label is given where the key phrase of one of its paragraphs is verified.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
NOTICES = {
    "mit": [
        "|permission is hereby granted free of charge| to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
        "the above copyright notice and this permission notice shall be |included in all copies or substantial portions| of the software",
        "|released under the mit license|",
        "|licensed under the mit license|",
    ],
    "apache-2": [
        "|licensed under the apache license version 2| 0",
        "you may not use this file |except in compliance with the license| you may obtain a copy of the license at http www apache org licenses license 2 0",
        "unless required by applicable law or agreed to in writing software |distributed under the license is distributed| on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd": [
        "|redistribution and use in source and binary forms| with or without modification are permitted provided that the following conditions are met",
        "|redistributions of source code must retain| the above copyright notice this list of conditions and the following disclaimer",
        "|redistributions in binary form must reproduce| the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    ],
    "isc": [
        "permission to |use copy modify and or distribute| this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "the software is provided as is and the |author disclaims all warranties with regard| to this software including all implied warranties of merchantability and fitness",
    ],
    "gpl-2+": [
        "this program is free software you can redistribute it and or modify it under the terms of the |gnu general public license| as published by the free software foundation either |version 2| of the license or at your option any later version",
    ],
    "gpl-3": [
        "licensed under the |gnu general public license version 3|",
        "this program is free software you can redistribute it and or modify it under the terms of the |gnu general public license| as published by the free software foundation either |version 3| of the license or at your option any later version",
    ],
    "lgpl": [
        "licensed under the |gnu lesser general public license|",
        "this library is free software you can redistribute it and or modify it under the terms of the |gnu lesser general public license| as published by the free software foundation",
    ],
    "agpl": ["under the terms of the |gnu affero general public license| as published by the free software foundation"],
    "mpl-2": ["this source code form is subject to the terms of the |mozilla public license v 2 0|", "if a |copy of the mpl was not distributed| with this file you can obtain one at http mozilla org mpl 2 0"],
    "boost": ["permission is hereby granted free of charge to any person or organization |obtaining a copy of the software and accompanying documentation| covered by this license", "|distributed under the boost software license| version 1 0"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "|altered source versions must be plainly marked as such| and must not be misrepresented as being the original software"],
    "unlicense": ["this is |free and unencumbered software| released into the public domain"],
    "cc0": ["to the extent possible under law the author has |waived all copyright and related| or neighboring rights"],
    "cc-by": ["licensed under a |creative commons attribution 4 0 international license|", "licensed under |cc by 4 0|"],
    "cc-by-sa": ["licensed under |cc by sa 4 0|", "licensed under a |creative commons attribution sharealike 4 0| international license"],
    "cc-by-nc": ["licensed under |cc by nc 4 0|", "licensed under a |creative commons attribution noncommercial 4 0| international license"],
    "all-rights-reserved": ["|all rights reserved|"],
}

#: Share of a part's different words, rarest first, that are looked up.
RARE = 0.5
#: Looked-up words that must agree on a part's place.
AGREE = 2
#: Score of a text with a base phrase and no verified part.
PHRASE_SCORE = 0.5


def parts() -> list[tuple[int, str, list[str], list[bool]]]:
    """(number, label, words, which of them are of a key phrase) of each part that has a key phrase."""
    out = []
    for label, paragraphs in NOTICES.items():
        for text in (t for t in paragraphs if "|" in t):
            words, key = [], []
            for k, run in enumerate(text.split("|")):
                words += run.split()
                key += [k % 2 == 1] * len(run.split())
            out.append((len(out), label, words, key))
    return out


def postings(spark: SparkSession) -> DataFrame:
    """part, label, at, word, key: one row for each word of each part. Bounded by the notices."""
    rows = [(n, label, k, w, m) for n, label, words, key in parts() for k, (w, m) in enumerate(zip(words, key))]
    return spark.createDataFrame(rows, "part int, label string, at int, word string, key boolean").coalesce(1)


def _words(df: DataFrame) -> DataFrame:
    """row, doc_id, text (lower case) and w, its words. lower() changes more than A-Z, but nothing else into
    A-Z or into other ASCII, except for the Kelvin sign, which is put aside first; so words and the
    equality with ASCII words are as if only A-Z were changed."""
    text = F.coalesce("text", F.lit(""))
    low = F.lower(F.when(F.contains(text, F.lit("K")), F.replace(text, F.lit("K"), F.lit("ß"))).otherwise(text))
    return df.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), low.alias("text")).withColumn("w", F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)))


def _strings(words: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(words)), "array<string>")


def _places(phrase: str) -> Column:
    """Where the words of phrase stand consecutively; texts that lack one of them aren't searched."""
    words = phrase.split()
    here = lambda x, i: F.when((x == words[0]) & F.forall(F.transform(F.array(*map(F.lit, words)), lambda p, k: F.get("w", i + k) == p), lambda same: F.coalesce(same, F.lit(False))), i.cast("long"))
    holds = F.lit(True)
    for w in words:
        holds = holds & F.contains("text", F.lit(w))
    return F.when(holds, F.filter(F.transform("w", here), lambda i: i.isNotNull())).otherwise(F.array().cast("array<bigint>"))


def scan_words(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, one array of places for each base phrase, held (template words), eligible (parts
    all of whose key words are held) and hits (word, at) of texts with such parts."""
    vocabulary = sorted({w for _, _, words, _ in parts() for w in words})
    keys = F.from_json(F.lit(json.dumps([{"part": n, "words": sorted({w for w, m in zip(words, key) if m})} for n, _, words, key in parts()])), "array<struct<part:int,words:array<string>>>")
    df = _words(docs).withColumn("held", F.array_intersect(_strings(vocabulary), F.col("w")))
    able = F.filter(keys, lambda k: F.forall(k["words"], lambda x: F.array_contains("held", x)))
    df = df.withColumn("eligible", F.when(F.size("held") > 1, F.transform(able, lambda k: k["part"])).otherwise(F.array().cast("array<int>")))
    hits = F.filter(F.transform("w", lambda x, i: F.when(F.array_contains("held", x), F.struct(x.alias("word"), i.alias("at")))), lambda h: h.isNotNull())
    return df.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), *[_places(p).alias(f"p{k}") for k, p in enumerate(PHRASES)], "held", "eligible", F.when(F.size("eligible") > 0, hits).alias("hits"))


def weights(scanned: DataFrame, index: DataFrame) -> DataFrame:
    """The postings with the idf of each word over all texts, and which are looked up."""
    texts = scanned.agg(F.count("*").alias("texts"))
    counts = scanned.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    # One row of counts joins each word of the notices.
    found = index.join(counts, "word", "left").withColumn("_one", F.lit(1)).join(texts.withColumn("_one", F.lit(1)), "_one").drop("_one")
    found = found.withColumn("idf", F.log((F.col("texts") + 1) / (F.coalesce("n", F.lit(0)) + 1)) + 1e-6).drop("n", "texts")
    words = found.groupBy("part", "word", "idf").agg(F.max("key").alias("key")).groupBy("part").agg(F.sort_array(F.collect_list(F.struct((-F.col("idf")).alias("r"), "word"))).alias("all"), F.sort_array(F.collect_list(F.when(F.col("key"), F.struct((-F.col("idf")).alias("r"), "word")))).alias("keys"))
    rare = F.array_union(F.slice("all", 1, F.ceil(F.size("all") * RARE).cast("int")), F.slice("keys", 1, AGREE))
    looked = words.select("part", F.explode(rare).alias("x")).select("part", "x.word", F.lit(True).alias("looked_up"))
    return found.join(looked, ["part", "word"], "left").withColumn("looked_up", F.coalesce("looked_up", F.lit(False)))


def verified(scanned: DataFrame, index: DataFrame) -> DataFrame:
    """row, label, coverage: the best place of each label whose key phrases stand in place. index: weights()."""
    hits = scanned.where(F.size("eligible") > 0).select("row", "eligible", F.explode("hits").alias("h")).select("row", "eligible", "h.word", "h.at")
    posted = F.broadcast(index.select("part", "word", F.col("at").alias("place"), "looked_up"))
    met = hits.join(posted.where("looked_up"), "word").where(F.array_contains("eligible", F.col("part")))
    starts = met.groupBy("row", "part", (F.col("at") - F.col("place")).alias("start")).agg(F.count_distinct("word").alias("agree"))
    least = F.broadcast(index.groupBy("part").agg(F.least(F.lit(AGREE), F.count_distinct("word")).alias("least")))
    candidates = materialize(starts.join(least, "part").where("agree >= least").select("row", "part", "start"), "license-candidates")
    whole = F.broadcast(index.groupBy("part", "label").agg(F.sum("idf").alias("whole"), F.count_if("key").alias("keys")))
    wanted = candidates.join(F.broadcast(index.select("part", F.col("at").alias("place"), "word", "key", "idf")), "part").select("row", "part", "start", (F.col("start") + F.col("place")).alias("at"), "word", "key", "idf")
    stand = wanted.join(hits.drop("eligible"), ["row", "at", "word"]).groupBy("row", "part", "start").agg(F.sum("idf").alias("found"), F.count_if("key").alias("found_keys"))
    good = stand.join(whole, "part").where("found_keys = keys")
    return good.groupBy("row", "label").agg(F.max(F.least(F.lit(1.0), F.col("found") / F.col("whole"))).alias("coverage"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    scanned = materialize(scan_words(docs), "license-words")
    index = materialize(weights(scanned, postings(docs.sparkSession)), "license-postings")
    own = verified(scanned, index).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("coverage").alias("coverage"))
    df = scanned.drop("held", "eligible", "hits").join(own, "row", "left").withColumn("places", F.concat(*[F.col(f"p{k}") for k in range(len(PHRASES))]))
    base = F.array_compact(F.array(*[F.when(F.size(f"p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]))
    line = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return df.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").alias("first_word"),
        F.array_max("places").alias("last_word"),
        line(base).alias("base_labels"),
        line(F.concat(base, F.coalesce("own", F.array().cast("array<string>")))).alias("labels"),
        F.greatest(F.when(F.size("places") > 0, F.lit(PHRASE_SCORE)).otherwise(0.0), F.coalesce("coverage", F.lit(0.0))).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))
