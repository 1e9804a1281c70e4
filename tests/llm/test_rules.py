"""Quality rules, quality classifier, personal data, pipeline: against brute force and planted cases."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidewatch.llm import pii, quality_classifier, quality_rules
from tidewatch.llm.common import stage_for

ROOT = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

# ---------------------------------------------------------------- quality rules


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n, repeats = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats, n < 20 or 100 * repeats > 30 * n
    )


def test_base_rules_equal_brute_force(spark):
    r = random.Random(2)
    texts = [None, "", " \n\t", "a", "x " * 19, "x " * 20, "### $$ a|b <c>", "l1\nl1\n\n \nl2\nl1 ", "é ü " * 40, "a\x0bb\x0cc\rd\x85e\xa0f"]
    texts += [" ".join(r.choice("abcd") for _ in range(r.randrange(0, 200))) for _ in range(40)]
    texts += [" ".join(f"w{r.randrange(3000)}" for _ in range(500)) + "\n" + "one two three four five six seven eight nine\n" * k for k in range(5)]
    rows = spark.createDataFrame([(i, t, 7, True) for i, t in enumerate(texts)], "doc_id bigint, text string, n_words int, kept boolean")
    trusted = spark.createDataFrame([(45,), (46,), (None,), (45,)], "doc_id bigint")
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(rows, trusted).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        assert tuple(got[i][c] for c in names) == brute_base(t), t
        assert got[i]["kept"] == (not got[i]["base_failed"] and got[i]["llr"] >= quality_rules.LEAST_RATIO)


def test_ratio_equals_counts(spark):
    texts = ["good words here " * 10, "bad stuff ### there " * 10, "good words and bad " * 10]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["llr"] for r in quality_rules.apply_rules(rows, spark.createDataFrame([(0,)], "doc_id bigint")).collect()}
    grams = []
    for t in texts:
        w = re.sub(quality_rules.SIGNS, r" \1 ", t).split()
        grams.append(w + list(zip(w, w[1:])))
    raw, good = Counter(g for gs in grams for g in gs), Counter(grams[0])
    b, s = quality_rules.BUCKETS, quality_rules.SMOOTH
    weight = lambda g: np.log((good[g] + s) / (len(grams[0]) + s * b)) - np.log((raw[g] + s) / (sum(map(len, grams)) + s * b))
    for i, gs in enumerate(grams):  # buckets of these few grams do not collide
        assert got[i] == pytest.approx(np.mean([weight(g) for g in gs]), abs=1e-9)
    assert got[0] > got[2] > got[1]


def test_rules_without_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality_rules.apply_rules(none, none).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id bigint, text string")
    assert quality_rules.apply_rules(rows, none).count() == 3


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables here")
def test_rules_part_good_from_bad(spark):
    rows = entry.queries()["op8_quality_rules"](spark, ROOT).join(spark.read.parquet(f"{ROOT}/labels.parquet"), "doc_id").collect()
    assert len(rows) > 300
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert all(r["kept"] for r in good) and sum(r["kept"] for r in bad) <= 0.05 * len(bad)


# ---------------------------------------------------------------- classifier


def test_classifier_never_sees_the_held_out_fold(spark):
    ids = range(400)
    docs = spark.createDataFrame([(i, "fine calm text" if i % 2 else "junk ### text") for i in ids], "doc_id bigint, text string")
    fold = {r["doc_id"]: r["h"] for r in docs.select("doc_id", quality_classifier.held_out("doc_id").alias("h")).collect()}
    assert all(fold[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in ids)
    true = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, quality int")
    poisoned = spark.createDataFrame([(i, 1 - i % 2 if fold[i] else i % 2) for i in ids], "doc_id bigint, quality int")
    one, two = (quality_classifier.train(docs, labels) for labels in (true, poisoned))
    assert (one.weights == two.weights).all() and one.bias == two.bias
    scored = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, one).collect()}
    assert all((scored[i] > 0.7) == bool(i % 2) for i in ids)


def test_classifier_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 3.0), (1, "", 3.0), (None, "a b", 3.0), (2, "z" * 100_000, 3.0), (2, "w " * 50_000, 3.0)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (None, 1), (2, None)], "doc_id bigint, quality int")
    model = quality_classifier.train(docs, labels)
    got = quality_classifier.score(docs, model)
    rows = got.collect()
    assert sorted(got.columns) == ["doc_id", "score", "text"] and len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    none = quality_classifier.train(docs.limit(0), labels.limit(0))
    assert {r["score"] for r in quality_classifier.score(docs, none).collect()} == {0.5}
    assert quality_classifier.score(docs.limit(0), none).count() == 0


def test_fit_does_not_hang_on_partitions(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} ok" if i % 3 else f"x{i % 5} bad") for i in range(90)], "doc_id bigint, text string")
    labels = docs.select("doc_id", F.col("text").contains("ok").cast("int").alias("quality"))
    one = quality_classifier.train(docs.repartition(1), labels)
    two = quality_classifier.train(docs.repartition(7), labels.repartition(5))
    assert (one.weights == two.weights).all()


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables here")
def test_held_out_accuracy(spark):
    rows = entry.queries()["op9_quality_classifier"](spark, ROOT).join(spark.read.parquet(f"{ROOT}/labels.parquet"), "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert len(rows) > 50 and right / len(rows) >= 0.95


# ---------------------------------------------------------------- personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(4)
    parts = ["a@b.c", "x@y", "@", "a.b-c@d-e.f.gh", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (702) 555-0742", "+49 30 1234567", "+1", "++12.34", "é", " ", "\n", "  ", ".", "-", "5", "00", "@c.de", "%+", "_"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_luhn_and_long_runs():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    for text in ("a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "+" + "1 " * 100_000, "@" * 100_000, "a@" * 50_000, "+1" * 50_000):
        pii.base_spans(text)


def test_contexts_find_unseen_identifiers(spark):
    r = random.Random(9)
    noise = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    texts = [f"{noise(5)} my phone number +1 702 555 {1000 + i} is {noise(4)}" for i in range(40)]
    hidden = [f"{noise(5)} my phone number 702-555-{3000 + i} is {noise(4)}" for i in range(3)]
    clean = [f"{noise(6)} order code 99{1000 + i}77 of {noise(5)}" for i in range(40)] + [None, "", "plain words"]
    all_texts = texts + hidden + clean
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(all_texts)], "doc_id bigint, text string, spans string")
    got = {r["doc_id"]: r for r in pii.digests(pii.find(rows)).collect()}
    assert len(got) == len(all_texts)
    for i, t in enumerate(all_texts):
        base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in brute_spans(t or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        if 40 <= i < 43:
            at = t.index("702-")
            assert got[i]["spans"] == f"phone:{at}:{at + 12}" and got[i]["n_phone"] == 0
        else:
            assert got[i]["spans"] == base
    out = {r["doc_id"]: r["text"] for r in pii.redact(rows).collect()}
    assert all("<PHONE>" in out[i] and "555" not in out[i] for i in range(43)) and [out[i] for i in range(43, 86)] == clean


def test_secrets_are_seeds_and_their_contexts_find_more(spark):
    r = random.Random(11)
    noise = lambda n: " ".join(f"w{r.randrange(500)}" for _ in range(n))
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(12)]
    texts = [f'{noise(5)} token = "{h}" {noise(5)}' for h in hexes] + [f"{noise(4)} AKIA{'Q7' * 8} {noise(4)}"]
    texts += [f'{noise(5)} token = "Xk29-Lq81-Zz4477" {noise(3)}', f'{noise(5)} part = "Xk29-Lq81-Zz4478" {noise(3)}', "0" * 40 + " " + "a" * 40]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in pii.digests(pii.find(rows)).collect()}
    for i, t in enumerate(texts):
        wanted = hexes[i] if i < 12 else "AKIA" + "Q7" * 8 if i == 12 else "Xk29-Lq81-Zz4477" if i == 13 else None
        assert got[i]["spans"] == (f"secret:{t.index(wanted)}:{t.index(wanted) + len(wanted)}" if wanted else ""), t
        assert got[i]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    out = {r["doc_id"]: r["text"] for r in pii.redact(rows).collect()}
    assert all("<SECRET>" in out[i] for i in range(14)) and out[14] == texts[14]


def test_bootstrapping_goes_on_to_a_fixed_point(spark):
    """A chain: contexts of seeds reach tokens, whose other contexts reach further tokens, five steps on."""
    r = random.Random(12)
    noise = lambda n: " ".join(f"w{r.randrange(900)}" for _ in range(n))
    token = lambda step, k: f"{70 + step}-{k}{k}-{4000 + 17 * k}"
    texts = []
    for step in range(6):  # 40 seeds of 51 are too few by themselves; with the tokens of the step before they are enough
        held = [f"+1 702 555 {1000 + k}" for k in range(40)] + [token(step, k) for k in range(5)]
        held += [token(step - 1, k) for k in range(5)] if step else []
        texts += [f"{noise(3)} mark {'abcdef'[step]}x {x} end{step} {noise(3)}" for x in held]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.digests(pii.find(rows)).collect()}
    assert all(spans[i].startswith("phone:") for i in range(len(texts)))


@pytest.mark.parametrize("names", [["_key_", "_text_", "_spans_"], ["_KEY_", "_key__", "spans", "base"]])
def test_redaction_keeps_columns_with_clashing_names(spark, names):
    rows = spark.createDataFrame([(1, "mail a@b.c now"), (2, None)], "doc_id bigint, text string")
    for i, n in enumerate(names):
        rows = rows.withColumn(n, F.lit(i))
    got = {r["doc_id"]: r for r in pii.redact(rows).collect()}
    assert got[1]["text"] == "mail <EMAIL> now" and got[2]["text"] is None and all(r[n] == i for r in got.values() for i, n in enumerate(names))


def test_first_stage_keeps_a_column_named_like_its_score(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").withColumn("_score_", F.lit(7)).withColumn("_text_", F.lit("x"))
    out = corpus_pipeline.good_documents(spark, docs, ROOT)
    assert out.columns == docs.columns and out.select("_score_", "_text_").distinct().collect() == [(7, "x")]


def test_personal_data_odd_rows(spark):
    schema = "doc_id bigint, text string"
    assert pii.find(spark.createDataFrame([], schema)).count() == 0 and pii.redact(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (2, None), (3, "z" * 200_000)], schema)
    got = pii.digests(pii.find(rows)).collect()
    assert len(got) == 5 and sum(r["n_email"] for r in got) == 3
    assert sorted(str(r["text"])[:9] for r in pii.redact(rows).collect()) == ["<EMAIL>", "<EMAIL>", "<EMAIL>", "None", "zzzzzzzzz"]


# ---------------------------------------------------------------- pipeline


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables here")
def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    ids, texts = {}, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, ROOT)
        if n < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{n}")
        ids[n], texts[n] = [r["doc_id"] for r in docs.select("doc_id").collect()], {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = spark.read.parquet(f"{tmp_path}/{n}")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect()}
    kept = set(ids[1])
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    assert sum(d in kept for d, q in labels.items() if q == 0) <= 0.05 * len(labels)
    assert len(ids[2]) == len(set(ids[2])) < len(ids[1]) and set(ids[2]) <= kept
    # Stage 2 against brute force on its own input.
    from tests.llm.test_pairs import brute_groups

    order = sorted(ids[1])
    _, low = brute_groups([texts[1][d] for d in order], 5, 80)
    assert set(ids[2]) == {d for i, d in enumerate(order) if low[i] == i}
    assert sorted(ids[2]) == sorted(ids[3]) == sorted(ids[4])
    assert all(not brute_spans(t or "") for t in texts[4].values())
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} == set(ids[4])
    assert all(0 < r["length"] <= 2048 and r["offset"] + r["length"] <= 2048 for r in rows)


def test_the_sample_is_held_in_few_bytes_and_gives_the_same_model():
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(3)
    rows = [(np.append(r.integers(0, 1 << quality_classifier.BITS, 2_000), [7] * 300).astype(np.int32), i % 2) for i in range(1_000)]
    tracemalloc.start()
    model = quality_classifier.fit(iter(rows), 1)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    tables = 9 * 8 * (1 << quality_classifier.BITS)  # weights and sums, whatever the sample
    assert most < tables + 6 * sum(len(found) for found, _ in rows)  # 16 bytes a distinct feature before

    def plain(rows, epochs):
        z, n = np.zeros((1 << quality_classifier.BITS) + 1), np.zeros((1 << quality_classifier.BITS) + 1)
        weight = lambda at: np.where(np.abs(z[at]) <= quality_classifier.L1, 0.0, -(z[at] - np.sign(z[at]) * quality_classifier.L1) / ((quality_classifier.BETA + np.sqrt(n[at])) / quality_classifier.ALPHA + quality_classifier.L2))
        for found, y in rows * epochs:
            at, count = np.unique(found, return_counts=True)
            at, x = np.append(at, len(z) - 1), np.append(count / np.sqrt(len(found)), 1.0)
            w = weight(at)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -40, 40))) - y) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / quality_classifier.ALPHA * w
            n[at] += g * g
        return weight(np.arange(len(z)))

    want = plain(rows, 1)
    assert (model.weights == want[:-1].astype(np.float32)).all() and model.bias == want[-1]


def test_texts_leave_a_batch_step_by_step():
    import pyarrow as pa

    from tidewatch.llm import common

    texts = ["a" * 10, None, "", "é" * 30, "b" * 5, "c" * 5, "d" * 200, None]
    column = pa.array(["cut off", *texts], pa.string()).slice(1)
    raw = common.bytes_of(column)
    for limit in (1, 12, 64, 1 << 20):
        got = list(common.text_steps(column, limit))
        assert [part for part, _ in got] == list(common.steps(raw, limit))
        assert [x for _, own in got for x in own] == raw
    assert list(common.text_steps(column.slice(0, 0))) == []


def test_a_worker_gives_back_what_other_operators_left():
    from tidewatch.llm import common, word_ids

    path = word_ids.default_vocabulary()
    one = word_ids.encoder(path)
    assert word_ids.encoder(path) is one
    common.let_go()
    two = word_ids.encoder(path)
    assert two is not one and two.encode(["a word, and another"]) == one.encode(["a word, and another"])
