"""Each operator against a brute-force version, and on awkward tables."""

import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from leafline.llm import features, graph, jpeg, near_copies, op1_tokens, op2_sharding, op3_pii, op4_mixing, op5_simhash, op6_quality, op7_packing, op8_rules, op9_media, op10_licenses, words
from leafline.llm.common import materialize, new_path, sampled_texts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, w string, slot string, label string, grade string"
GAPS = re.compile(r"[^\x20\x09-\x0D]+")
MODEL, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))


def table(spark, texts, langs=None):
    """doc_id from 0, and further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, (langs or ["en", None, "de"])[i % 3], "s" if i % 2 else None, len(t or ""), "x", "x", "x", "x", "x") for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def sf():
    at = os.environ.get("LEAFLINE_TESTDATA", "/root/testdata/sf0.001")
    if not os.path.isdir(at):
        pytest.skip("no tables")
    return at


AWKWARD = ["", None, " \n\t ", "a", "a", "a b c", "😀 é ß", "#" * 50, "word " * 400, "x" * 70_000, "1" * 30_000, "Under the MIT License.", "line\n" * 300, "a@b.c +1 555 123 4567 4111 1111 1111 1111"]


@pytest.fixture(scope="module")
def awkward(spark):
    df = table(spark, AWKWARD)
    odd = spark.createDataFrame([(None,) * 10, (3, "a", None, None, None) + (None,) * 5, (3, "a", None, None, None) + (None,) * 5], SCHEMA)
    return df.union(odd).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def labels(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id long, quality int, toxic int")


# --- every operator: one row for each row in, nulls, repeats and clashing names included; empty tables


def everything(spark, docs):
    marks = labels(spark, [(3, 1, 0), (9, 0, 0), (8, None, 1), (None, 1, 1), (3, 1, None)])
    mixture, member = op4_mixing.fit(docs, op4_mixing.labelled_domains(docs, marks), BYTES)
    return {
        "tokens": op1_tokens.token_counts(docs, MODEL, new_path(spark, "cache")),
        "shards": op2_sharding.shard(docs, 1000),
        "pii": op3_pii.report(op3_pii.find(docs)),
        "redacted": op3_pii.redact(docs),
        "members": member,
        "simhash": op5_simhash.near_duplicates(docs),
        "quality": op6_quality.score(docs, op6_quality.fit(docs, marks)),
        "good": op6_quality.keep_good(docs, op6_quality.fit(docs, marks), tail=-1.0),
        "rules": op8_rules.judge(docs),
        "media": op9_media.store_and_read(docs),
        "licenses": op10_licenses.scan(docs),
        "mixed": op4_mixing.mix(docs, mixture, least=1),
    }


def test_awkward_rows(spark, awkward):
    for name, df in everything(spark, awkward).items():
        got, want = Counter(r.doc_id for r in df.select("doc_id").collect()), Counter(r.doc_id for r in awkward.select("doc_id").collect())
        # The mixture may repeat a row, and drops none.
        assert got == want or name == "mixed" and got.keys() == want.keys() and got >= want, name
    packed = op7_packing.pack_documents(awkward, BYTES)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == Counter(r.doc_id for r in awkward.collect())


def test_empty_tables(spark, awkward):
    none = awkward.limit(0)
    for name, df in everything(spark, none).items():
        assert df.count() == 0, name
    assert op7_packing.pack_documents(none, BYTES).count() == 0
    assert op5_simhash.keep_one(none).count() == 0


# --- 1


def test_token_counts_and_the_cache(spark, awkward, monkeypatch):
    import sentencepiece

    model, cache = sentencepiece.SentencePieceProcessor(model_file=MODEL), new_path(spark, "cache")
    texts = AWKWARD + ["<s> </s> <unk>", "<|endoftext|>"]
    docs = table(spark, texts)
    got = {r.doc_id: r for r in op1_tokens.token_counts(docs, MODEL, cache, limit=100).collect()}
    for i, t in enumerate(texts):
        n = len(model.encode(t or ""))
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
    held = op1_tokens.read_cache(spark, cache)
    assert held.count() == len({t or "" for t in texts})
    before = held.count()
    more = table(spark, [*texts, "new text", "new text"])
    assert op1_tokens.token_counts(more, MODEL, cache).count() == len(texts) + 2
    assert op1_tokens.read_cache(spark, cache).count() == before + 1
    op1_tokens.token_counts(docs, BYTES, cache).count()
    assert op1_tokens.read_cache(spark, cache).select("tokenizer_digest").distinct().count() == 2


def test_a_warm_cache_moves_no_text(spark):
    cache = new_path(spark, "cache")
    docs = table(spark, [f"text number {i % 50}" for i in range(200)])
    op1_tokens.token_counts(docs, MODEL, cache).count()
    held = op1_tokens.read_cache(spark, cache).count()
    keys = docs.selectExpr("unhex(sha2(text, 256)) content_digest")
    assert op1_tokens.missing(keys, op1_tokens.read_cache(spark, cache)).count() == 0
    warm = op1_tokens.token_counts(docs, MODEL, cache)
    plan = warm._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and warm.count() == 200 and op1_tokens.read_cache(spark, cache).count() == held


def test_few_misses_go_to_the_texts_and_not_the_texts_to_them(spark):
    docs = materialize(table(spark, [f"text {i}" for i in range(100)])).withColumn("content_digest", F.unhex(F.sha2("text", 256)))
    misses = materialize(docs.where("doc_id < 3").select("content_digest"))
    few, many = (op1_tokens.texts_of(docs, misses, n) for n in (3, op1_tokens.BROADCAST + 1))
    assert rows(few) == rows(many) and few.count() == 3
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # only what the semi-join leaves is shuffled


# --- 2


@pytest.mark.parametrize("limit", [50, 400, 10**6])
def test_shards_fit_and_only_full_ones_split(spark, limit):
    rng = random.Random(limit)
    docs = table(spark, ["x" * rng.randint(0, 40) for _ in range(600)])
    got = op2_sharding.shard(docs, limit).toPandas()
    sums = got.groupby("shard").n_bytes.sum()
    assert len(got) == 600 and sums.max() <= limit and not got.oversized.any()
    assert (got["shard"].str.len() == got.local_depth).all()
    for s in sums.index[sums.index.str.len() > 0]:  # what a shard was split off didn't fit
        assert got[got["shard"].str.startswith(s[:-1])].n_bytes.sum() > limit


def test_a_hot_key_splits_on_row_bits(spark):
    docs = spark.createDataFrame([(7, "x" * 100)] * 300 + [(i, "y" * 50) for i in range(100)] + [(1000, "z" * 5000)], "doc_id long, text string")
    got = op2_sharding.shard(docs, 1000).toPandas()
    assert len(got) == 401
    sums = got.groupby("shard").agg({"n_bytes": "sum", "oversized": "max"})
    assert (sums.n_bytes[~sums.oversized] <= 1000).all() and got[got.oversized].doc_id.tolist() == [1000]


def test_written_shards(spark, tmp_path):
    """Repeated and null ids, and a column with the folder's name: each row is written once, a file to a shard."""
    docs = table(spark, ["x" * 30] * 100).withColumnRenamed("h", "Shard")
    docs = docs.union(docs.where("doc_id < 5")).union(docs.where("doc_id < 5")).union(docs.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long")))
    op2_sharding.write_shards(docs.repartition(5), str(tmp_path / "s"), 500)
    got = spark.read.parquet(str(tmp_path / "s"))
    assert rows(got.select(docs.columns)) == rows(docs) and "_shard" in got.columns
    folders = sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir())
    assert len(folders) > 4 and all(re.fullmatch("_shard=s[01]*", f) for f in folders)
    assert all(len(list((tmp_path / "s" / f).glob("*.parquet"))) == 1 for f in folders)
    empty = str(tmp_path / "none")
    op2_sharding.write_shards(docs.limit(0), empty)


def test_the_query_splits_on_the_tables(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    if not os.path.isdir(big):
        pytest.skip("no such tables")
    got = op2_sharding.query(spark, big).groupBy("shard").agg(F.sum("n_bytes").alias("n")).collect()
    assert len(got) > 2 and max(r.n for r in got) <= op2_sharding.LIMIT


# --- 3

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_spans_are_those_of_the_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a@b.c", "%d@e.f", "1.2.3.4", "255.255.255.256", "4111 1111 1111 1111", "4111111111111111", "+1 (555) 123-4567", "é", "😀", " ", "-", ".", "@", "+", "12", "7", "tel ", "\n", "GB82 WEST 1234 5698 7654 32", "ssn 123-45-6789", "0004.5.6.7", "x"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(600)] + ["a@b.c " * 700, "", None]
    for r in op3_pii.report(op3_pii.find(table(spark, texts))).collect():
        want = base_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in want) for k in BASE]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE] == want


def test_long_runs_take_linear_time(spark):
    """Runs of the signs that patterns repeat, each ten times as long in as long a time but for start-up."""
    runs = ["1", "a", "1 ", "a@", "+1", "1.", "A1", "DE1", "a-"]
    took = []
    for n in (20_000, 200_000):
        began = time.perf_counter()
        got = {r.doc_id: r.spans for r in op3_pii.report(op3_pii.find(table(spark, [(x * n)[:n] for x in runs]))).collect()}
        took.append(time.perf_counter() - began)
        assert [got[k] for k in (1, 2, 4, 8)] == [""] * 4 and got[5].count("ip:") == n // 8
    assert took[1] < 60


def test_secrets_are_found_by_context_and_variety(spark):
    key = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"
    texts = [f'token = "{key}" and so on', f"commit {key}", "token ------------------------", "the token internationalization-of-everything", f"password: {key[:24]}_X", f"key{key}"]
    found = [r.spans for r in op3_pii.report(op3_pii.find(table(spark, texts))).orderBy("doc_id").collect()]
    assert found == ["secret:9:49", "", "", "", "secret:10:36", ""]
    assert op3_pii.redact(table(spark, texts)).orderBy("doc_id").first().text == 'token = "[SECRET]" and so on'


def test_a_filter_on_redacted_text_keeps_the_plan_small(spark):
    docs = table(spark, ["mail a@b.c and +1 (555) 123-4567", "none", None]).withColumnsRenamed({"h": "_text", "w": "row", "slot": "_match"})
    got = op3_pii.redact(docs)
    found = got.where("text like '%[EMAIL]%' and length(text) > 3")
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 60_000
    assert [r.doc_id for r in found.collect()] == [0] and got.columns == docs.columns and got.count() == 3


def test_added_kinds_need_their_checksum_or_context(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32.", "GB82 WEST 1234 5698 7654 33.", "ssn 123-45-6789", "123-45-6789"]
    assert [r.spans for r in op3_pii.report(op3_pii.find(table(spark, texts))).orderBy("doc_id").collect()] == ["iban:5:32", "", "ssn:4:15", ""]


def test_redaction_keeps_all_else(spark):
    docs = table(spark, ["mail a@b.c or +1 (555) 123-4567, card 4111 1111 1111 1111; 9.9.9.9 é", "clean 12 text", None])
    got = op3_pii.redact(docs).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["mail [EMAIL] or [PHONE], card [CARD]; [IP] é", "clean 12 text", None]
    assert got[0].n_chars == len(got[0].text) and op3_pii.redact(docs).columns == docs.columns


def test_an_account_number_ends_with_its_length(spark):
    compact, fours = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    tails = ["", ".", " Please", " 12 May", " BIC COBADEFF", " I", " 1", " NO9386011117947"]
    others = ["NO9386011117947", "GB82WEST 1234 5698765432", "FR1420041010050500013M02606", "MT84MALT011000012345MTLCAST001S", "BE68 5390 0754 7034"]
    docs = table(spark, [n + t for n in (compact, fours) for t in tails] + [f"to {n} 7 X" for n in others] + [compact + "0 Please", compact[:-1] + "1 Please"])
    got = [r.spans for r in op3_pii.report(op3_pii.find(docs)).orderBy("doc_id").collect()]
    want = [f"iban:0:{len(n)}" + (f",iban:{len(n) + 1}:{len(n) + 16}" if "NO93" in t else "") for n in (compact, fours) for t in tails] + [f"iban:3:{3 + len(n)}" for n in others] + ["", ""]
    assert [",".join(s for s in g.split(",") if s.startswith("iban")) for g in got] == want
    redacted = [r.text for r in op3_pii.redact(docs).orderBy("doc_id").collect()]
    assert redacted[2:5] == ["[IBAN] Please", "[IBAN] 12 May", "[IBAN] BIC COBADEFF"]


# --- 4


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet((0.3, 0.3, 0.3), 2000)
    member = spark.createDataFrame([(i, int(n), *map(float, q)) for i, (n, q) in enumerate(zip(rng.integers(0, 900, 2000), p))], "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    for shares, total in (((0.5, 0.3, 0.2), None), ((0.02, 0.49, 0.49), 500_000.0)):
        start, steps = op4_mixing.solve(member, np.array(shares), total)
        mixture = op4_mixing.Mixture(("a", "b", "c"), np.zeros((1, 3)), np.zeros(3), start, steps)
        rated = op4_mixing.rated(member, mixture)
        *got, least = rated.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{k}") * F.col("rate")) for k in range(3)], F.min("rate")).first()
        assert least >= 0
        assert np.allclose(np.array(got) / sum(got), shares, atol=0.03)
        assert np.allclose(mixture.rates(p[:50]), [r[0] for r in rated.where("doc_id < 50").orderBy("doc_id").select("rate").collect()])


def test_a_sample_is_bounded_however_often_an_id_is_repeated(spark, monkeypatch):
    """300 rows and 300 labels of one id: no more vectors than the sample meet in the task that fits."""
    docs = spark.createDataFrame([(7, f"same id {i % 5}", "en") for i in range(300)] + [(i, f"text {i} of its own", ["en", "de"][i % 2]) for i in range(8, 60)], "doc_id long, text string, lang string")
    marks = labels(spark, [(7, i % 2, 0) for i in range(300)] + [(i, i % 2, 0) for i in range(8, 60)])
    for sample in (10, 100):
        assert op6_quality.sample_vectors(docs, marks, sample).count() == sample
    seen = []
    for module in (op4_mixing, op6_quality):
        monkeypatch.setattr(module, "materialize", lambda df, what="table", f=materialize: seen.append((what, f(df, what))) or seen[-1][1])
    for sample in (10, 50):
        op4_mixing.classify(docs, op4_mixing.labelled_domains(docs, marks), {"en": 0.5, "de": 0.5}, sample)
    assert [df.count() for what, df in seen if what == "mixing-sample"] == [10, 50]
    assert {r.text for r in sampled_texts(docs, spark.createDataFrame([(7,), (7,), (8,)], "_id long")).collect()} == {"text 8 of its own", min((f"same id {i}" for i in range(5)), key=lambda t: xxhash_of(spark, t))}


def xxhash_of(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]


def test_domains_of_held_out_texts(spark):
    rng = random.Random(2)
    words = {"en": ["the", "of", "and", "house"], "de": ["der", "und", "das", "haus"], "fr": ["le", "et", "la", "maison"]}
    langs = [rng.choice(list(words)) for _ in range(300)]
    docs = spark.createDataFrame([(i, " ".join(rng.choices(words[x], k=30)), x if i < 200 else None) for i, x in enumerate(langs)], "doc_id long, text string, lang string")
    mixture, member = op4_mixing.fit(docs, op4_mixing.labelled_domains(docs, labels(spark, [(i, 1, 0) for i in range(300)])), BYTES, {"en": 0.4, "de": 0.4, "fr": 0.2})
    got = {r[0]: r[2:] for r in member.collect()}
    assert sum(mixture.domains[int(np.argmax(got[i]))] == langs[i] for i in range(200, 300)) >= 98
    mixed = op4_mixing.mix(docs, mixture, least=1)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == 300


def test_copies_come_in_bounded_batches():
    rng = np.random.default_rng(4)
    for limit in (1, 100, 1000, 10**9):
        copies, size = rng.integers(0, 9, 200), rng.integers(0, 300, 200)
        runs = list(op4_mixing.taken(copies, size, limit))
        assert np.bincount(np.concatenate(runs), minlength=200).tolist() == copies.tolist()
        assert all(len(r) == 1 or (size[r] + 64).sum() <= limit for r in runs)
    assert list(op4_mixing.taken(np.zeros(3, np.int64), np.ones(3))) == []


def test_rates_are_the_least_squares_fit(spark):
    """Against projected gradient on all rates at once, run long, where the targets can be met."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet((0.2, 0.2, 0.2), 400)
    n = rng.integers(1, 900, 400)
    member = spark.createDataFrame([(i, int(k), *map(float, q)) for i, (k, q) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    shares, total = np.array([0.2, 0.3, 0.5]), 300_000.0
    start, steps = op4_mixing.solve(member, shares, total)
    got = op4_mixing.Mixture(("a", "b", "c"), np.zeros((1, 3)), np.zeros(3), start, steps).rates(p)
    x, a = np.ones(400), p.T * n
    for _ in range(20_000):
        x = np.maximum(0, x - a.T @ (a @ x - total * shares) / np.linalg.norm(a, 2) ** 2)
    brute = np.abs(a @ x - total * shares).max()
    assert got.min() >= 0 and np.abs(a @ got - total * shares).max() <= max(10 * brute, 1e-4 * total)


def test_tokens_of_the_mixture_are_the_tokenizers(spark, awkward):
    marks = labels(spark, [(i, 1, 0) for i in range(14)])
    _, member = op4_mixing.fit(awkward, op4_mixing.labelled_domains(awkward, marks), BYTES)
    got = {r.doc_id: r.n_tokens for r in member.where("doc_id is not null").collect()}
    assert all(got[i] == len(op7_packing.token_ids([t or ""], BYTES)[0]) for i, t in enumerate(AWKWARD))


# --- 5


def slow_simhash(text):
    words = re.findall(GAPS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices(["Ab ", "c\n", "É ", " ", "d\x0b", "E"], k=rng.randint(0, 30))) for _ in range(300)]
    got = {r.doc_id: r.fp for r in op5_simhash.fingerprints(table(spark, texts)).collect()}
    assert all(got[i] % (1 << 64) == slow_simhash(t) for i, t in enumerate(texts))


def test_masks_cover_every_pair_of_bits():
    masks = op5_simhash.masks()
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def brute_components(prints):
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_planted_fingerprints(spark, monkeypatch, seed):
    """Chains and crowds of near fingerprints, shuffled: no link is lost."""
    rng = random.Random(seed)
    prints = [0, (1 << 64) - 1]
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 25])):
            prints.append(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 2, 3])))
    centre = rng.getrandbits(64)
    prints += [centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 4))) for _ in range(120)]
    rng.shuffle(prints)
    monkeypatch.setattr(op5_simhash, "fingerprints", lambda docs: docs)
    docs = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in op5_simhash.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(prints))] == brute_components(prints)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = {r.node: r.label for r in graph.components(edges).collect()}
    assert set(got[i] for i in range(301)) == {0} and got[1001] == 1000


def test_one_of_each_group_stays(spark):
    docs = table(spark, ["one two three four", "ONE two  three four", "other words stand here now", None, ""])
    kept = op5_simhash.keep_one(docs.union(docs.where("doc_id = 2")))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3] and kept.columns == docs.columns


def _five(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies_are_those_of_similar_shingles(spark):
    """Families with some words changed, and a crowd of them: the groups are those of all pairs of 0.8 or more."""
    rng = random.Random(11)
    texts = ["a b c", "A  b c", "a b", "", None]
    for copies in (1, 2, 3, 3, 3, 3, 60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(120, 300))]
        texts.append(" ".join(words))
        for _ in range(copies):
            own = list(words)
            for i in rng.sample(range(len(own)), rng.randint(1, 7)):
                own[i] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own))
    sets = [_five(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (5 * len(a & b) >= 4 * len(a | b)) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    assert 9 < len(set(label)) < len(texts) - 30
    kept = op5_simhash.keep_one(table(spark, texts).repartition(7))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def _closure(sets):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("block", [6, 512])
def test_a_family_of_copies_that_are_less_and_less_alike(spark, monkeypatch, block):
    """Copies of one text and copies of those, so that some are linked to the text, some to each other and some to none."""
    monkeypatch.setattr(near_copies, "BLOCK", block)
    rng = random.Random(31)
    first = [f"w{rng.randrange(5000)}" for _ in range(150)]
    texts = [first]
    for _ in range(90):
        own = list(texts[0] if rng.random() < 0.5 else rng.choice(texts))
        for i in rng.sample(range(len(own)), rng.choice([1, 2, 4, 5, 6, 8])):
            own[i] = f"x{rng.randrange(10**6)}"
        texts.append(own)
    texts = [" ".join(t) for t in texts]
    label = _closure([_five(t) for t in texts])
    assert 10 < len(set(label)) < 85
    met = []
    monkeypatch.setattr(near_copies, "across", lambda *a, f=near_copies.across: met.append(f(*a)) or met[-1])
    kept = op5_simhash.keep_one(table(spark, texts).repartition(5))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label)) and len(met) == 1 and met[0].count() < len(texts)


def test_fingerprints_propose_near_copies_and_shingles_decide(spark, monkeypatch):
    """Without any band: texts whose fingerprints are within the radius are linked, if their shingle sets are alike."""
    monkeypatch.setattr(near_copies, "bands", lambda own: np.array([len(own)], np.uint64))  # sets of different sizes share no bucket
    rng = random.Random(5)
    words = [f"w{rng.randrange(5000)}" for _ in range(6000)]
    texts = [" ".join(words), " ".join(["x1", *words]), "one two three", " ".join(rng.sample(words, 3000))]
    prints = [op5_simhash.simhash(t.encode()) for t in texts]
    assert (prints[0] ^ prints[1]).bit_count() <= op5_simhash.RADIUS < (prints[0] ^ prints[3]).bit_count()
    kept = op5_simhash.keep_one(table(spark, texts).repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_links_of_a_cell_join_components_and_no_more():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 60_000).astype(np.int64)
    cut = lambda n, extra: np.sort(np.concatenate((base[n:], rng.integers(0, 1 << 63, extra))))
    own, other = [cut(0, 0), cut(4_000, 0), cut(30_000, 0)], [cut(0, 6_000), cut(4_000, 100), cut(40_000, 5)]
    got = near_copies.cell_links(own, other, np.array([1, 2, 3]), np.array([4, 5, 6]))
    near = [(i, j) for i, a in enumerate(own) for j, b in enumerate(other) if 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))]
    assert set(got) <= set(near) and len(near) > len(got) == 3  # four components become one
    assert near_copies.cell_links(own, other, np.array([1, 1, 1]), np.array([1, 1, 1])) == []


def test_rows_of_repeated_or_null_doc_ids_stay_or_go_by_their_text(spark):
    rng = random.Random(12)
    one, two, three, four = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(40)) for _ in range(4))
    docs = spark.createDataFrame([(1, one), (7, one), (7, two), (8, three), (8, four), (None, three), (None, "n n n"), (None, "n n n")], "doc_id long, text string")
    kept = op5_simhash.keep_one(docs.repartition(5))
    assert rows(kept) == sorted([(1, one), (7, two), (8, three), (8, four), (None, "n n n")], key=str)


# --- 6


def test_grades_of_held_out_texts(spark):
    rng = random.Random(6)
    common = [f"w{k}" for k in range(200)]

    def text(grade):
        words = rng.choices(common, k=rng.randint(30, 200))
        if grade == 0:
            words = [f"{x}!!" for x in words]
        if grade == 1:
            for i in range(0, len(words), 12):
                words[i] = rng.choice(["nasty", "awful"])
        return " ".join(words)

    grades = [rng.choice([0, 1, 2, 2, 2]) for _ in range(900)]
    docs = table(spark, [text(g) for g in grades])
    marks = labels(spark, [(i, int(g > 0), int(g == 1)) for i, g in enumerate(grades) if i < 700])
    got = {r.doc_id: r for r in op6_quality.score(docs, op6_quality.fit(docs, marks)).collect()}
    assert np.mean([got[i].kept == (grades[i] == 2) for i in range(700, 900)]) > 0.95
    means = [np.mean([got[i].expected_grade for i in range(700, 900) if grades[i] == g]) for g in range(3)]
    assert means == sorted(means)


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 3, 300)
    share = [np.where(rng.random(6) < 0.5, 0.02 * (g + 1), 0.0) for g in grade]
    numbers = np.tile(np.arange(6), 300)
    caught = {}
    real = op6_quality.minimise
    op6_quality.minimise = lambda f, x, **k: caught.update(f=f, size=len(x)) or real(f, x, **k)
    screen, op6_quality.SCREEN, op6_quality.PHI = (op6_quality.SCREEN, op6_quality.PHI), 0.0, 0.0
    try:
        _, limits = op6_quality.fit_arrays(grade, np.repeat(np.arange(300), 6), numbers, np.concatenate(share))
    finally:
        op6_quality.minimise, (op6_quality.SCREEN, op6_quality.PHI) = real, screen
    assert limits[0] < limits[1]
    v = rng.normal(size=caught["size"]) * 0.3
    _, g = caught["f"](v)
    for k in (0, len(v) - 2, len(v) - 1):
        e = np.zeros(len(v))
        e[k] = 1e-6
        assert np.isclose((caught["f"](v + e)[0] - caught["f"](v - e)[0]) / 2e-6, g[k], atol=1e-5)


def test_scores_add_up_over_pieces_of_a_long_text(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["", "one TWO two !!", "x y " * 900, "ü" * 100])
    weights = np.random.default_rng(0).normal(size=(features.SIZE, 2))
    whole = features.scores(texts, weights)
    assert np.allclose(whole, [[(weights[n, c] * v).sum() for c in range(2)] for n, v in features.vectors(texts)])
    monkeypatch.setattr(features, "STEP", 100)
    apart = features.scores(texts, weights)
    assert np.allclose(whole[[0, 1, 3]], apart[[0, 1, 3]]) and np.allclose(whole, apart, atol=0.05)


def test_words_of_one_stem_share_features():
    import pyarrow as pa

    one, other, apart, short = ({int(n) for n in numbers if n >= features.STEMS} for numbers, _ in features.vectors(pa.array(["Schönheit", "schönste", "unschön", "abc d"])))
    assert len(one) == len(features.STEM_BYTES) and len(one & other) == 3 and not one & apart and not short


# --- 7


def test_ids_are_those_of_the_tokenizer_file(monkeypatch):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    slow, own = Tokenizer.from_file(BYTES), words.Encoder(BYTES)
    signs = [chr(c) for c in (*range(0x250), 0x85, 0xA0, 0x180E, 0x200B, 0x2028, 0x3000, 0x1F600, 0xFEFF, 0x660, 0x2160, 0x300, 0x41F)] + ["<|endoftext|>", "'s", "  ", "\n\n"] + [" "] * 200
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)] + ["", " " * 9000, "x" * 9000, "a " * 3000, "a  b", "<|endoftext|> <|endoftext|>", "Straße, déjà vu! naïve... ſchön; ÿ Ÿ × ÷ a× ª º l'été don't I'll we're, 'tis"]
    texts += [" ".join("".join(rng.choices("abeiouäöüßéèñçÀÖØſ", k=rng.randint(1, 9))) + rng.choice(["", "", ".", ",", "!?", "'s", "×", "1"]) for _ in range(30)) for _ in range(200)]
    for kept in (words.KEPT, 50):  # with room for all, and with the store emptied time and again
        monkeypatch.setattr(words, "KEPT", kept)
        for at in range(0, len(texts), 100):
            part = texts[at : at + 100]
            assert [np.frombuffer(x, "<u4").tolist() for x in own(part)] == [x.ids for x in slow.encode_batch(part, add_special_tokens=False)]


def test_packing_is_gapless_and_complete(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["alpha", "beta", "é"], k=rng.randint(0, 2600))) for _ in range(150)] + ["", None]
    got = op7_packing.pack_documents(table(spark, texts), BYTES).toPandas()
    for doc_id, own in got.sort_values("piece").groupby("doc_id"):
        ids = np.append(op7_packing.token_ids([texts[doc_id] or ""], BYTES)[0], 2).astype("<u4")
        assert own.length.sum() == len(ids) and (own.length.iloc[1:] == 1024).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *np.cumsum(own.length)[:-1]] and own.length.sum() <= 1024
    assert got.sequence_id.nunique() <= 1.02 * -(-got.length.sum() // 1024) + 1


def squares(bins, lengths):
    return sum(sum(lengths[x] for x in b) ** 2 for b in bins)


def test_every_exchange_raises_the_squared_fill():
    rng = random.Random(9)
    kinds = Counter()
    for _ in range(30):
        lengths = [rng.randint(1, 60) for _ in range(60)]
        search = op7_packing.Search(op7_packing.start_bins(list(range(len(lengths))), lengths, 64), lengths, 64)
        for b in range(len(search.bins)):
            while search.bins[b] and search.fill[b] < 64:
                before, held = squares(search.bins, lengths), [list(x) for x in search.bins]
                if not search.improve(b):
                    break
                assert squares(search.bins, lengths) > before
                assert all(sum(lengths[x] for x in own) == f <= 64 for own, f in zip(search.bins, search.fill))
                kinds[len(set(held[b]) - set(search.bins[b])), len(set(search.bins[b]) - set(held[b]))] += 1
        assert sorted(x for b in search.bins for x in b) == list(range(60))
    assert set(kinds) == {(1, 0), (1, 1), (2, 0), (2, 1), (1, 2)}


def stuck(bins, lengths, size):
    """Whether no move or swap of one for one, two for one or one for two raises the squared fill."""
    fill = [sum(lengths[x] for x in b) for b in bins]
    one, two = ([[lengths[x] for x in own] for own in bins], [[lengths[x] + lengths[y] for i, x in enumerate(own) for y in own[:i]] for own in bins])
    for a in range(len(bins)):
        for b in range(len(bins)):
            if a != b and max(fill[a], fill[b]) < size:
                for groups, backs in ((one[a] + two[a], [0, *one[b]]), (one[a], two[b])):
                    if any(0 < n - z <= size - fill[b] and fill[b] + n - z > fill[a] for n in groups for z in backs):
                        return False
    return True


def test_what_holds_between_moves_is_found_once(monkeypatch):
    rng = random.Random(12)
    lengths = [rng.randint(1, 40) for _ in range(300)]
    search = op7_packing.Search(op7_packing.start_bins(list(range(300)), lengths, 64), lengths, 64)
    moves, pairs, put = [0], [], search.put
    monkeypatch.setattr(search, "put", lambda x, b: moves.append(moves.pop() + 1) or put(x, b))
    monkeypatch.setattr(search, "pairs", lambda found=search.pairs: pairs.append(moves[0]) or found())
    bins = search.run()
    assert pairs and len(pairs) == len(set(pairs))
    # Found anew, no bin has an exchange, unless the bins are as few as can be.
    last = op7_packing.Search(bins, lengths, 64)
    assert last.count() == last.least or not any(last.improve(b) for b in np.flatnonzero(last.fill < 64).tolist())


def test_local_search_empties_bins_until_none_can_be():
    # 6 + 4, 6 + 4, 5 + 5 fill three bins of ten; a poor start has four
    lengths = [6, 6, 5, 5, 4, 4]
    bins = op7_packing.Search([[0], [1, 4], [2], [3, 5]], lengths, 10).run()
    assert len(bins) == 3 and sorted(x for b in bins for x in b) == list(range(6))
    rng = random.Random(9)
    emptied = 0
    for _ in range(40):
        lengths = [rng.randint(1, 60) for _ in range(60)]
        start = len(op7_packing.start_bins(list(range(len(lengths))), lengths, 64))
        bins = op7_packing.Search(op7_packing.start_bins(list(range(60)), lengths, 64), lengths, 64).run()
        assert sorted(x for b in bins for x in b) == list(range(60)) and all(sum(lengths[x] for x in b) <= 64 for b in bins)
        emptied += start - len(bins)
    assert emptied > 30


def test_no_exchange_is_overlooked():
    rng = random.Random(10)
    for _ in range(60):
        lengths = [rng.randint(1, 40) for _ in range(25)]
        bins = op7_packing.pack_lengths(lengths, 64)
        assert len(bins) == -(-sum(lengths) // 64) or stuck(bins, lengths, 64)


def test_the_search_decides_how_many_sequences_the_tables_take(spark, sf):
    lengths = [r.length for r in op7_packing.pieces(spark.read.parquet(f"{sf}/documents.parquet"), BYTES).collect()] * 6
    random.Random(17).shuffle(lengths)
    start = op7_packing.start_bins(sorted(range(len(lengths)), key=lambda x: 2 * lengths[x] <= 1024), lengths, 1024)
    after, least = len(op7_packing.pack_lengths(lengths)), -(-sum(lengths) // 1024)
    assert least <= after < len(start) and after - least <= 0.01 * least


# --- 8


def slow_measures(text):
    w = re.findall(GAPS, text)
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(GAPS, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a ", "b ", "c\n", "\n", "é", "# ", "\x0b", "x"], k=rng.randint(0, 60))) for _ in range(500)] + ["", None, "a b c " * 9000, "\n" * 1000]
    for r in op8_rules.judge(table(spark, texts)).collect():
        want = slow_measures(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_fences_follow_the_source(spark):
    """A rate that is usual in one source is an outlier in another."""
    def text(i, marks):
        return " ".join(f"w{i}x{k}{'#' * (k < marks)}" for k in range(100))

    data = [(i, text(i, 12 + i % 5), "en", "tables") for i in range(200)] + [(1000 + i, text(i, 0), "en", "prose") for i in range(200)] + [(5000, text(1, 90), "en", "prose"), (5001, text(2, 14), "en", "tables")]
    got = {r.doc_id: r.kept for r in op8_rules.judge(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in [*range(200), *range(1000, 1200), 5001]) and not got[5000]


def slow_bucket(events, units, one):
    return math.ceil(math.log((events + one) / (units + one)) / math.log(op8_rules.GAMMA))


def slow_fences(rows):
    """(lang, source) to the three fences, from sorted lists."""
    groups = {}
    for r in rows:
        if not r.base_failed:
            for key in ((r.lang, r.source), (r.lang,), ()):
                groups.setdefault(key, []).append([slow_bucket(r[e], r[u], a) for e, u, a in op8_rules.RATES.values()])
    out = {}
    for key in (k for k in groups if len(k) == 2):
        own = next((groups[k] for k in (key, key[:1]) if len(groups[k]) >= op8_rules.LEAST), groups[()])
        columns = [sorted(c) for c in zip(*own)]
        low, mid = (-(-len(own) * q // 4) - 1 for q in (1, 2))
        out[key] = [c[mid] + op8_rules.REACH * max(c[mid] - c[low], op8_rules.SPREAD) for c in columns]
    return out


def varied(rng, i):
    lines = [" ".join(f"w{rng.randrange(400)}{'#' * (rng.random() < 0.02)}" for _ in range(rng.randint(3, 30))) for _ in range(rng.randint(3, 30))]
    return "\n".join(lines + lines[: rng.choice([0, 0, 1, len(lines) // 2])])


def test_fences_and_verdicts_are_those_of_sorted_lists(spark):
    rng = random.Random(13)
    data = [(i, varied(rng, i), rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "a", "b", None])) for i in range(900)]
    measured = materialize(op8_rules.rated(op8_rules.measures(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"))))
    want = slow_fences(measured.collect())
    got = {(r.lang, r.source): [r[k] for k in op8_rules.RATES] for r in op8_rules.group_fences(op8_rules.sketches(measured)).collect()}
    assert got == want and len({tuple(f) for f in want.values()}) > 3
    for r in op8_rules.judge(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect():
        own = [(r[e], slow_bucket(r[e], r[u], a)) for e, u, a in op8_rules.RATES.values()]
        assert r.kept == (not r.base_failed and all(n == 0 or x <= f for (n, x), f in zip(own, want[r.lang, r.source])))


def test_a_third_of_junk_moves_no_fence_past_the_junk(spark):
    rng = random.Random(14)
    words = lambda n, mark: " ".join(f"w{rng.randrange(9999)}{'#$' if rng.random() < mark else ''}" for _ in range(n))
    data = [(i, words(rng.randint(60, 900), 0.5 if i % 3 == 0 else 0), "en", "s") for i in range(600)]
    got = op8_rules.judge(spark.createDataFrame(data, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id for r in got if r.kept} == {i for i in range(600) if i % 3}


def test_fences_of_the_tables_differ(spark, sf):
    rates = materialize(op8_rules.rated(op8_rules.measures(spark.read.parquet(f"{sf}/documents.parquet"))))
    fences = op8_rules.fences(op8_rules.sketches(rates), "lang")
    least = op8_rules.fences(op8_rules.sketches(rates.withColumns(dict.fromkeys(op8_rules.RATES, F.lit(0)))), "lang")
    assert {r.fence for r in least.collect()} == {op8_rules.REACH * op8_rules.SPREAD}
    assert all(r.n > 1 for r in fences.groupBy("rate").agg(F.countDistinct("fence").alias("n")).collect())


# --- 9


def test_media_hold_the_payload(spark):
    texts = AWKWARD + ["é" * 5000, "\u0080ÿ" * 99]
    docs = table(spark, texts)
    stored = op9_media.store(docs)
    found = {r.doc_id: r for r in op9_media.features(stored).collect()}
    media = {r.doc_id: bytes(r.media) for r in stored.collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        want = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        r = found[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(media[i]), hashlib.sha256(media[i]).hexdigest())
    assert rows(op9_media.store_and_read(docs)) == rows(op9_media.features(stored))
    assert found[3].feature == found[4].feature


class SlowBits:
    """Codes and values bit by bit."""

    def __init__(self, scan):
        self.bits, self.at = "".join(f"{b:08b}" for b in scan), 0

    def take(self, n):
        self.at += n
        return int(self.bits[self.at - n : self.at] or "0", 2)

    def value(self, lengths):
        codes = {f"{c:0{n}b}": s for s, (c, n) in jpeg.canonical(lengths).items()}
        line = ""
        while line not in codes:
            line += self.bits[self.at]
            self.at += 1
        run, size = divmod(codes[line], 16)
        bits = self.take(size)
        return run, size, bits if not size or bits >> (size - 1) else bits - (1 << size) + 1


@pytest.mark.parametrize("kind", ["text", "bytes", "one", "zeros"])
def test_decoding_is_that_of_single_bits(monkeypatch, kind):
    monkeypatch.setattr(jpeg, "SCAN", 64)
    monkeypatch.setattr(jpeg, "CHUNK", 5)
    rng = random.Random(1)
    data = {"text": "".join(rng.choices("abc d,é\n", k=900)).encode(), "bytes": bytes(rng.choices(range(256), k=64 * 30)), "one": b"a" * 640, "zeros": bytes(64)}[kind]
    data = op9_media.payload(data)
    media = jpeg.encode(data)
    image = jpeg.decode(media)
    assert image.payload() == data
    at, tables = media.index(b"\xff\xc4"), {}
    body = media[at + 4 : at + 2 + int.from_bytes(media[at + 2 : at + 4], "big")]
    while body:
        lengths = [k for k, m in enumerate(body[1:17], 1) for _ in range(m)]
        tables[body[0] >> 4] = dict(zip(body[17:], lengths))
        body = body[17 + len(lengths) :]
    assert not any(c == (1 << n) - 1 for t in tables.values() for c, n in jpeg.canonical(t).values())
    bits, last = SlowBits(media[media.index(b"\xff\xda") + 10 : -2].replace(b"\xff\x00", b"\xff")), 0
    for block in image.blocks[1].reshape(-1, 64):
        last += bits.value(tables[0])[2]
        want = [last] + [bits.value(tables[1])[2] for _ in range(63)]
        assert block.tolist() == want


def test_codes_are_the_best_ones():
    rng = random.Random(2)
    for _ in range(50):
        counts = {s: rng.randint(1, 200) for s in range(rng.randint(1, 9))}
        lengths = jpeg.best_lengths(counts)
        codes = [f"{c:0{n}b}" for c, n in jpeg.canonical(lengths).values()]
        assert not any(a != b and b.startswith(a) for a in codes for b in codes) and all("0" in c for c in codes)
        entropy = -sum(n * math.log2(n / sum(counts.values())) for n in counts.values())
        assert entropy <= sum(counts[s] * lengths[s] for s in counts) <= entropy + sum(counts.values()) + 1


def test_broken_scans_are_refused():
    media = jpeg.encode(bytes(range(256)) * 4)
    for broken in (media[:-60] + b"\xff\xd9", media[:-2].replace(media[-40:-2], b"\xfe" * 38) + b"\xff\xd9"):
        with pytest.raises(ValueError):
            jpeg.decode(broken)


def test_an_ordinary_file_with_runs_subsampling_and_restarts():
    """Written here bit by bit: two components, 2 x 1 and 1 x 1, a restart after the first unit, zero runs."""
    dc, ac = {0: 2, 2: 2, 5: 2}, {0x00: 2, 0x01: 2, 0x32: 3, 0xF0: 3}
    codes = [jpeg.canonical(t) for t in (dc, ac)]
    bits: list[str] = []

    def put(table, symbol, value=0, size=0):
        code, n = codes[table][symbol]
        bits.append(f"{code:0{n}b}" + (f"{value if value > 0 else value + (1 << size) - 1:0{size}b}" if size else ""))

    def block(diff, coefficients):
        size = abs(diff).bit_length()
        put(0, size, diff, size)
        for run, value in coefficients:
            if run == 15 and not value:
                put(1, 0xF0)
            else:
                put(1, run << 4 | abs(value).bit_length(), value, abs(value).bit_length())
        put(1, 0x00)

    def flush():
        line = "".join(bits)
        bits.clear()
        line += "1" * (-len(line) % 8)
        return bytes(int(line[i : i + 8], 2) for i in range(0, len(line), 8)).replace(b"\xff", b"\xff\x00")

    block(20, [(3, 2)]), block(2, []), block(0, [(15, 0), (0, 1)])
    scan = flush() + b"\xff\xd0"
    block(-20, []), block(0, [(0, -1)]), block(3, [])
    scan += flush()
    head = b"\xff\xd8" + jpeg._segment(0xDB, bytes([0] + [4] * 64)) + jpeg._segment(0xC0, bytes([8, 0, 8, 0, 32, 2, 1, 0x21, 0, 2, 0x11, 0])) + jpeg._segment(0xC4, jpeg._table(0, dc) + jpeg._table(1, ac)) + jpeg._segment(0xDD, b"\0\1")
    image = jpeg.decode(head + jpeg._segment(0xDA, bytes([2, 1, 0, 2, 0, 0, 63, 0])) + scan + b"\xff\xd9")
    assert (image.width, image.height) == (32, 8)
    assert image.blocks[1][0, :, 0].tolist() == [20, 22, -20, -20] and image.blocks[1][0, 0, 4] == 2 and image.blocks[1][0, 3, 1] == -1
    assert image.blocks[2][0, :, 0].tolist() == [0, 3] and image.blocks[2][0, 0, 17] == 1
    assert image.thumbnail().tolist() == [[138, 139, 118, 118]]


def test_unreadable_media_have_null_thumbnails(spark):
    df = spark.createDataFrame([(1, bytearray(b"no")), (2, None), (3, bytearray(jpeg.encode(b"a" * 64)))], "doc_id long, media binary")
    assert {r.doc_id: r.width for r in op9_media.thumbnails(df).collect()} == {1: None, 2: None, 3: 8}


def test_the_hash_is_of_means_over_all_pixels(spark):
    rng = np.random.default_rng(3)
    for shape in ((8, 8), (27, 27), (100, 31), (1, 1), (3, 20)):
        grey = rng.integers(0, 256, shape).astype(np.uint8)
        cells = [[grey[i * shape[0] // 8 : max((i + 1) * shape[0] // 8, i * shape[0] // 8 + 1), j * shape[1] // 8 : max((j + 1) * shape[1] // 8, j * shape[1] // 8 + 1)].mean() for j in range(8)] for i in range(8)]
        assert jpeg.average_hash(grey) == np.packbits(np.array(cells) - np.mean(cells) > 1e-9).tobytes().hex()
    dotted = np.zeros((64, 64), np.uint8)
    dotted[1::8, 1:32:8] = 255  # between the pixels that single ones would be taken from
    assert jpeg.average_hash(dotted) == "f0" * 8


def test_the_media_column_is_written(spark):
    plan = op9_media.store_and_read(table(spark, ["a", "b"]))
    assert any("/media-" in f for f in plan.inputFiles())


# --- 10


def slow_places(text):
    words = re.findall(op10_licenses.WORDS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    at = defaultdict(list)
    for phrase, label in op10_licenses.PHRASES.items():
        p = phrase.split()
        at[label] += [i for i in range(len(words)) if words[i : i + len(p)] == p]
    every = [i for x in at.values() for i in x]
    return len(words), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(k for k, v in at.items() if v))


def test_base_places(spark):
    rng = random.Random(10)
    parts = ["Under the MIT License", "under", "the", " mit", " license ", "Apache License, Version 2.0", " ", "CC BY-NC", "cc", "\n", "é", "İ", "K"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(400)] + ["", None, "under the mit license " * 2000]
    for r in op10_licenses.scan(table(spark, texts)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == slow_places(texts[r.doc_id] or "")
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def slow_scan(texts):
    """(labels, score) of each text: every part tried at every place."""
    lists = [re.findall(op10_licenses.WORDS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for t in texts]
    held = Counter(w for words in lists for w in set(words))
    idf = lambda w: math.log((len(texts) + 1) / (held[w] + 1)) + 1e-6
    out = []
    for words, text in zip(lists, texts):
        found, best = set(filter(None, slow_places(text or "")[4].split(","))), 0.5 if slow_places(text or "")[1] else 0.0
        for _, label, part, key in op10_licenses.parts():
            for start in range(-len(part), len(words)):
                stands = [0 <= start + k < len(words) and words[start + k] == w for k, w in enumerate(part)]
                if all(s for s, m in zip(stands, key) if m):
                    found.add(label)
                    best = max(best, sum(idf(w) for s, w in zip(stands, part) if s) / sum(map(idf, part)))
        out.append((",".join(sorted(found)), best))
    return out


def plain(text):
    return text.replace("|", "")


def test_labels_are_those_of_trying_every_place(spark):
    rng = random.Random(15)
    runs = [plain(t) for paragraphs in op10_licenses.NOTICES.values() for t in paragraphs]
    texts = []
    for _ in range(250):
        words = " x ".join(rng.sample(runs, rng.randint(0, 3))).split()
        for i in range(len(words)):
            if rng.random() < 0.03:
                words[i] = rng.choice(["changed", "license", "the", ""])
        texts.append(" ".join(words[rng.randint(0, 5) :]))
    texts += ["", None, "under the mit license", "all rights reserved " * 500, " filler ".join(sorted(set(runs[0].split())))]
    got = op10_licenses.scan(table(spark, texts)).orderBy("doc_id").collect()
    for r, (labels, score) in zip(got, slow_scan(texts), strict=True):
        assert r.labels == labels, texts[r.doc_id]
        assert abs(r.score - min(1.0, score)) < 1e-9


@pytest.mark.parametrize(("changed", "least"), [(0, 1.0), (1 / 80, 0.9)])
def test_planted_notices_are_found(spark, changed, least):
    """Whole notices as comments in other text, wrapped, in capitals, and with words changed."""
    rng = random.Random(16)
    texts, want = [], []
    for label, paragraphs in op10_licenses.NOTICES.items():
        for n in range(12):
            words = plain(" \n ".join(paragraphs if n % 2 else [t for t in paragraphs if "|" in t][:1])).split(" ")
            words = [rng.choice(["thing", "any", "license"]) if w.isalnum() and rng.random() < changed else w.upper() if n % 3 == 0 else w.capitalize() for w in words]
            body = "".join(f" * {w}{rng.choice([',', '.', '', '', ''])}" if rng.random() < 0.1 else f" {w}" for w in words)
            texts.append("/* " + " ".join(rng.choices(["house", "the", "of", "software"], k=30)) + " \"" + body + "\" " + " ".join(rng.choices(["to", "license", "code"], k=30)))
            want.append(label)
    texts += [" ".join(rng.choices(["to", "license", "code", "free", "software", "rights", "the", "under"], k=80)) for _ in range(100)]
    got = op10_licenses.scan(table(spark, texts)).orderBy("doc_id").collect()
    assert np.mean([w in r.labels.split(",") for w, r in zip(want, got)]) >= least
    assert not any(r.labels for r in got[len(want) :])


def test_unrelated_words_hide_no_notice(spark):
    """Key phrases in place are enough, whatever other words of the part stand elsewhere, and whichever words are rare."""
    short = "Permission is hereby granted, free of charge, to use these notes."
    texts = [short, f"{short} Any associated copy of the list is welcome too."]
    for _, _, words, key in op10_licenses.parts():
        texts.append(" ".join(w if m else f"x{k}" for k, (w, m) in enumerate(zip(words, key))) + " y " + " y ".join(sorted(set(words))))
    common = sorted({w for _, _, words, key in op10_licenses.parts() for w, m in zip(words, key) if m})
    docs = table(spark, texts + [" z ".join(common)] * 60 + ["some other text"] * 30)
    got = [set(r.labels.split(",")) for r in op10_licenses.scan(docs).orderBy("doc_id").limit(len(texts)).collect()]
    assert got[0] >= {"mit"} and got[1] >= {"mit"}
    assert all(label in labels for (_, label, _, _), labels in zip(op10_licenses.parts(), got[2:], strict=True)), got


def test_notices_of_the_tables(spark, sf):
    """Every document with one of the tables' licence lines gets its label, and no other one does."""
    lines = {"gpl-3": r"licensed under the gnu general public license,? version 3", "all-rights-reserved": r"all rights reserved", "apache-2": r"licensed under the apache license,? version 2", "mit": r"released under the mit license", "cc-by-nc": r"licensed under cc by-nc 4"}
    texts = {r.doc_id: (r.text or "").lower() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op10_licenses.query(spark, sf).collect():
        assert set(filter(None, r.labels.split(","))) >= {k for k, line in lines.items() if re.search(line, texts[r.doc_id])}
        assert not r.labels or re.search("licen[sc]e|rights reserved|cc by", texts[r.doc_id])
