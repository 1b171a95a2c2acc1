"""The registered queries and the pipeline, whole, on small tables with awkward rows, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_operators import AWKWARD, BYTES, GAPS, MODEL, base_spans, brute_components, slow_measures, slow_places, slow_scan, slow_simhash

from leafline.llm import op2_sharding, op4_mixing, op7_packing, op8_rules
from leafline.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n=None):
    words = ["river", "stone", "letter", "cloud", "winter", "garden", "harbour", "the", "of", "and", "to", "a"]
    return " ".join(f"{rng.choice(words)}{rng.randrange(60)}" for _ in range(n or rng.randint(60, 200))) + "."


def texts():
    rng = random.Random(21)
    plain = [prose(rng) for _ in range(60)]
    near = [" ".join(w if k != 20 else "changed" for k, w in enumerate(t.split())) for t in plain[:10]]
    junk = [" ".join(f"{w}#$%" for w in prose(rng).split()) for _ in range(8)]
    private = [f"{prose(rng)} mail me@host{k}.org or +1 (555) 123-45{k:02d}, card 4111 1111 1111 1111" for k in range(4)]
    licences = [f"{prose(rng)} Released under the MIT License.", f"{prose(rng)} All rights reserved."]
    return plain + plain[:7] + near + junk + private + licences + AWKWARD


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """(folder, rows): documents with repeated and null doc_ids, null texts and labels of every kind."""
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, ["en", "de", None][i % 3] if i % 5 else "en", "s0" if i % 3 else None, len(t or "")) for i, t in enumerate(texts())]
    rows += [rows[3], (None, "no id", None, None, None), (None, None, "en", "s0", 0), (5, "another text of the same id", "en", "s1", 3)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{at}/documents.parquet")
    marks = [(i, int("#$%" not in (t or "")), int(i % 11 == 0)) for i, t in enumerate(texts()) if i % 4] + [(None, 1, 0), (3, None, 1), (3, 1, 0), (99999, 0, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def same(got, want):
    """Rows as multisets, so that repeated and null doc_ids count."""
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_no_rows(spark, none, name):
    assert QUERIES[name](spark, none).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql_gives_the_same_rows(spark, made, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{made[0]}/documents.parquet/*.parquet'")
    got, want = QUERIES[name](spark, made[0]), con.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    same(got.select(columns).collect(), want.project(", ".join(columns)).fetchall())


def test_op1(spark, made):
    import sentencepiece

    count = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = [(i, len((t or "").encode()), n := len(count.encode(t or "")), n > 4096) for i, t, *_ in made[1]]
    same(QUERIES["op1_token_counts"](spark, made[0]).select("doc_id", "n_bytes", "n_tokens", "over_limit").collect(), want)


def test_op2_with_a_limit_that_splits(spark, made, monkeypatch):
    monkeypatch.setattr(op2_sharding.shard, "__defaults__", (20_000, "doc_id"))
    got = QUERIES["op2_sharding"](spark, made[0]).toPandas()
    assert Counter(map(str, got.doc_id.astype("Int64"))) == Counter(str(np.nan if i is None else i).replace("nan", "<NA>") for i, *_ in made[1])
    sums = got.groupby("shard").agg({"n_bytes": "sum", "oversized": "max"})
    assert len(sums) > 4 and (sums.n_bytes[~sums.oversized] <= 20_000).all()
    assert got.n_bytes.sum() == sum(len((t or "").encode()) for _, t, *_ in made[1])


def test_op3(spark, made):
    got = QUERIES["op3_pii"](spark, made[0]).collect()
    want = []
    for i, t, *_ in made[1]:
        spans = base_spans(t or "")
        want.append((i, *[sum(s.startswith(f"{k}:") for s in spans) for k in ("email", "ip", "card", "phone")], hashlib.sha256(",".join(spans).encode()).hexdigest()))
    same([(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got], want)
    for r in got:
        assert hashlib.sha256(",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")).encode()).hexdigest() == r.base_sha256


def test_op4(spark, made):
    df = QUERIES["op4_mixing"](spark, made[0]).toPandas()
    domains = sorted(c.removeprefix("share_") for c in df.columns if c.startswith("share_"))
    assert domains == ["de", "en"] and len(df) == len(made[1]) and np.allclose(df[["share_de", "share_en"]].sum(axis=1), 1, atol=1e-5) and df.rate.min() >= 0
    tokens = op7_packing.token_ids([t or "" for _, t, *_ in made[1]], BYTES)
    assert Counter(df.n_tokens) == Counter(map(len, tokens))
    totals = np.array([(df.n_tokens * df.rate * df[f"share_{d}"]).sum() for d in domains])
    wanted = np.array([op4_mixing.TARGETS[d] for d in domains])
    assert np.allclose(totals / totals.sum(), wanted / wanted.sum(), atol=0.01)


def test_op5(spark, made):
    prints = [slow_simhash(t or "") for _, t, *_ in made[1]]
    label = brute_components(prints)
    names = {}
    for (i, *_), x in zip(made[1], label):
        names[x] = min([v for v in (names.get(x), i) if v is not None], default=None)
    same(QUERIES["op5_simhash"](spark, made[0]).select("doc_id", "fingerprint", "component_id").collect(), [(i, f"{p:016x}", names[x]) for (i, *_), p, x in zip(made[1], prints, label)])


def test_op6(spark, made):
    """Junk of half of the texts is labelled; of the other half as much is rejected, and nothing else but toxic ones."""
    got = QUERIES["op6_quality"](spark, made[0]).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in made[1])
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 and r.kept == (r.tail_probability >= 0.3) for r in got)
    junk = {i for i, t, *_ in made[1] if t and "#$%" in t and i is not None}
    assert len(junk) == 8 and sum(not r.kept for r in got if r.doc_id in junk) >= 7


def packed(rows, documents):
    """Whether pieces are whole documents, gapless, and within 1024."""
    tokens = Counter(op7_packing.token_ids([t or ""], BYTES)[0].tobytes() + (2).to_bytes(4, "little") for t in documents)
    whole = Counter(zlib.crc32(x) for x, n in tokens.items() for _ in range(n) if len(x) <= 4096)
    assert Counter(r.ids_crc32 for r in rows if r.start == 0 and r.length <= 1024 and r.ids_crc32 in whole) >= whole
    assert sum(r.length for r in rows) == sum(len(x) // 4 * n for x, n in tokens.items())
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [a for a, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) <= 1024
    return len(places)


def test_op7(spark, made):
    rows = QUERIES["op7_packing"](spark, made[0]).collect()
    assert packed(rows, [t for _, t, *_ in made[1]]) <= 1.05 * -(-sum(r.length for r in rows) // 1024) + 1


def test_op8(spark, made):
    got = QUERIES["op8_quality_rules"](spark, made[0]).collect()
    want = []
    for i, t, *_ in made[1]:
        n, *rest = slow_measures(t or "")
        want.append((i, n, *rest, n < 50 or 100 * rest[3] > 50 * n))
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got], want)
    junk = {i for i, t, *_ in made[1] if t and "#$%" in t}
    assert not any(r.kept for r in got if r.doc_id in junk or r.base_failed)
    assert all(r.kept for r in got if not r.base_failed and r.n_symbols + r.n_dup_lines + r.n_repeat_words == 0)
    assert op8_rules.LEAST == 100


def test_op9(spark, made):
    want = []
    for i, t, *_ in made[1]:
        data = (t or "").encode()
        payload = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        want.append((i, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
    got = QUERIES["op9_media"](spark, made[0]).collect()
    same([(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got], want)
    assert len({(r.payload_sha256, r.media_sha256, r.media_bytes, r.feature) for r in got}) == len({w[3] for w in want})


def test_op10(spark, made):
    want = []
    for (i, t, *_), (labels, score) in zip(made[1], slow_scan([t for _, t, *_ in made[1]])):
        want.append((i, *slow_places(t or ""), labels, round(min(1.0, score), 9)))
    same([(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in QUERIES["op10_licenses"](spark, made[0]).collect()], want)


# --- the pipeline


def shingled(text):
    w = re.findall(GAPS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def one_of_each(rows):
    """Rows (doc_id, text) that stay, by comparing all pairs."""
    sets = [shingled(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    groups = {}
    for (i, t), x in zip(rows, label):
        groups.setdefault(x, []).append((i is None, i, t))
    return groups


def test_the_stages_one_after_another(spark, made, monkeypatch):
    kept = []
    real = corpus_pipeline.materialize
    monkeypatch.setattr(corpus_pipeline, "materialize", lambda df, what: kept.append(real(df, what)) or kept[-1])
    out = QUERIES["pipeline"](spark, made[0])
    good, once, clean, mixed, last = kept
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    assert all(df.columns == ["doc_id", "text", "lang", "source", "n_chars"] for df in kept[:-1])

    source = Counter((i, t) for i, t, *_ in made[1])
    first = Counter(pairs(good))
    assert first <= source
    judged = {(r.doc_id, r.kept) for r in QUERIES["op6_quality"](spark, made[0]).collect()}
    assert Counter(i for i, _ in first.elements()) <= Counter(i for i, _ in source.elements())
    assert {i for i, _ in first} == {i for i, k in judged if k}
    assert not any(t and "#$%" in t for _, t in first)

    second, groups = pairs(once), one_of_each(list(first.elements()))
    assert len(second) == len(groups) < sum(first.values())
    for members in groups.values():
        least = min((i for none_, i, _ in members if not none_), default=None)
        assert sum((i, t) in second for _, i, t in members) >= 1 and any((i, t) in second for _, i, t in members if i == least)

    third = dict(pairs(clean))
    assert len(third) == len(dict(second)) and clean.count() == len(second)
    for r in clean.collect():
        before = [t for i, t in second if i == r.doc_id]
        assert r.text in before or "[" in r.text
        assert not [s for s in base_spans(r.text or "") if s.startswith(("email", "card"))] and (r.text is None or r.n_chars == len(r.text) or r.text in before)
    assert sum("[EMAIL]" in (t or "") and "[CARD]" in t and "[PHONE]" in t for t in third.values()) == 4

    fourth = Counter(pairs(mixed))
    assert set(fourth) == set(pairs(clean))  # every document at least once, none that wasn't there
    assert packed(last.collect(), [t for t, n in ((t, n) for (_, t), n in fourth.items()) for _ in range(n)]) >= 1
    assert out is last


def test_stages_take_their_predecessors_rows_only(spark, made):
    """Each stage on rows of awkward kinds alone."""
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, " \n", None, None, 2), (3, "x" * 50_000, "en", "s", 1)], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, made[0])
        assert got.columns == odd.columns, name
        if name == "personal_data":
            same(got.select("doc_id", "text").collect(), odd.select("doc_id", "text").collect())
        if name == "near_duplicates":
            assert sorted(r.doc_id for r in got.collect()) == [1, 3]
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER) == BYTES


def test_a_missing_pipeline_is_an_error(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    for name in ("corpus_pipeline", "leafline.llm.queries"):
        monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setattr(sys, "meta_path", [SimpleFinder("corpus_pipeline"), *sys.meta_path])
    with pytest.raises(ModuleNotFoundError, match="corpus_pipeline"):
        entry.queries()
    monkeypatch.setattr(sys, "meta_path", [SimpleFinder("leafline.llm.queries"), *sys.meta_path[1:]])
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in entry.queries())
    importlib.invalidate_caches()


class SimpleFinder:
    """Refuses one module, as if its file were gone."""

    def __init__(self, name):
        self.name = name

    def find_spec(self, name, path=None, target=None):
        if name == self.name:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None
