"""N-gram Jaccard join, vector near-duplicates, repeated passages: against brute force."""

import itertools
import pathlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import pii, substring, trie_join, vector_dedup
from tidewatch.llm.common import PART_BYTES, Stage, components, key_filter, key_hits, parted, stage_for
from tidewatch.session import checkpoint_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= n:
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    return {tuple(words)} if words else set()


def closure(ids, links):
    low = {i: i for i in ids}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if before == low:
            return low


def brute_groups(texts, n, percent):
    sets = [shingles(t, n) for t in texts]
    links = [
        (i, j)
        for i, j in itertools.combinations(range(len(texts)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], closure(range(len(texts)), links)


def family(seed, size, vocabulary=400):
    """Texts with copies, near copies at all distances, chains of copies, a shared passage and short ones."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    passage = " ".join(f"p{i}" for i in range(30))
    out = []
    for _ in range(size):
        kind = r.random()
        if kind < 0.55 and out:
            words = (r.choice(out) or "").split()
            for _ in range(r.choice([0, 1, 1, 2, 3, 5])):
                if words:
                    words[r.randrange(len(words))] = word()
            out.append(r.choice([" ", "\n", "\t"]).join(words))
        elif kind < 0.65:
            out.append(" ".join([passage, *[word() for _ in range(r.randrange(1, 8))]]))
        else:
            out.append(" ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 8, 40, 90]))))
    return out + [None, "", " \n ", "One two", "one TWO", "É a b c", "é a b c"]


@pytest.mark.parametrize("n,percent,seed", [(4, 85, 1), (5, 80, 2), (4, 60, 3)])
def test_groups_equal_brute_force(spark, monkeypatch, n, percent, seed):
    monkeypatch.setattr(trie_join, "BLOCK", 7)  # so that groups are cut into blocks
    texts = family(seed, 160)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n bigint, v string")
    sizes, low = brute_groups(texts, n, percent)
    got = {r["doc_id"]: r for r in trie_join.groups(rows, words=n, percent=percent).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert {i: r["component_id"] for i, r in got.items()} == low


def test_trie_alone_finds_every_pair():
    """Without the dense step: all pairs at the threshold, one group."""
    r = random.Random(5)
    runs = []
    for _ in range(60):
        base = list(range(40)) if not runs or r.random() < 0.3 else list(r.choice(runs))
        runs.append(np.unique([x if r.random() > 0.06 else 100 + r.randrange(300) for x in base]))
    sizes = np.array([len(x) for x in runs])
    links = trie_join.link_group(runs, sizes, np.arange(60), np.zeros(60, dtype=int), 80)
    brute = [(i, j) for i, j in itertools.combinations(range(60), 2) if 100 * len(np.intersect1d(runs[i], runs[j])) >= 80 * len(np.union1d(runs[i], runs[j]))]
    assert closure(range(60), links) == closure(range(60), brute) and set(map(tuple, map(sorted, links))) <= set(brute)


def test_groups_of_nothing_nulls_and_repeats(spark):
    schema = "doc_id bigint, text string"
    assert trie_join.groups(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (4, "a b c d e"), (3, "a b c d e"), (9, None)], schema)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in trie_join.groups(rows).collect())
    assert got == [("3", 2, "3"), ("4", 2, "3"), ("4", 2, "3"), ("9", 0, "9"), ("None", 2, "None")]
    kept = trie_join.keep_one(rows.withColumn("v", F.lit(1)))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "9", "None"] and kept.columns == ["doc_id", "text", "v"]


def test_rows_that_repeat_an_id_go_by_their_own_text(spark):
    rows = [(3, "a b c d e f"), (5, "A b c d e f"), (5, "quite another text of six"), (5, "quite another text of six"), (6, None), (6, "a b c d e f")]
    kept = trie_join.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("_gone_", F.lit(1)).withColumn("k", F.lit(2)))
    assert sorted(map(str, (tuple(r)[:2] for r in kept.collect()))) == sorted(map(str, [rows[0], rows[2], rows[3], rows[4]]))


@pytest.mark.parametrize("names", [["_d_", "_cuts_"], ["_D_", "_cuts__", "_cuts_"]])
def test_removal_keeps_columns_with_clashing_names(spark, names):
    long = " ".join(f"w{i}" for i in range(80))
    rows = spark.createDataFrame([(1, long + " one"), (2, "two " + long), (3, None)], "doc_id bigint, text string")
    for i, n in enumerate(names):
        rows = rows.withColumn(n, F.lit(i))
    got = {r["doc_id"]: r for r in substring.remove(rows).collect()}
    assert got[2]["text"].strip() == "two" and got[1]["text"] == long + " one" and got[3]["text"] is None
    assert all(r[n] == i for r in got.values() for i, n in enumerate(names))


def test_one_large_group_of_near_copies(spark):
    r = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base[:k] + [f"x{i}"] + base[k + 1 :]) for i in range(300) for k in [r.randrange(120)]]
    got = trie_join.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert {r["component_id"] for r in got.collect()} == {0}


# ---------------------------------------------------------------- components and filter


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(300, 300)]
    stage = stage_for(spark, "t")
    got = {r["v"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), stage, "c").collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), stage, "e").count() == 0


def test_filter_lets_every_key_through(spark):
    bits = key_filter(spark.range(0, 5000, 3).withColumnRenamed("id", "k"), "k")
    keys = np.arange(5000)
    hits = key_hits(bits, keys)
    assert hits[::3].all() and hits.mean() < 0.4


# ---------------------------------------------------------------- vectors


def brute_vectors(vectors, limit=0.95):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    links = []
    for i, j in itertools.combinations(range(len(vectors)), 2):
        if ok[i] and ok[j] and len(vectors[i]) == len(vectors[j]):
            a, b = np.array(vectors[i], dtype=np.float64), np.array(vectors[j], dtype=np.float64)
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= limit:
                links.append((i, j))
    degree = [sum(i in p for p in links) for i in range(len(vectors))]
    return degree, closure(range(len(vectors)), links)


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "TILE", 64 * 16)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(6, 16))
    vectors = [(centers[rng.integers(6)] * rng.uniform(0.1, 9) + rng.normal(size=16) * rng.choice([0.0, 0.2, 0.3, 1.0])).astype(np.float32).tolist() for _ in range(260)]
    vectors += [vectors[0]] * 20 + [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    vectors += [[1.0, 2.0], [2.0, 4.0], [1e-30, 2e-30], [3e38, 3e38]]
    rows = spark.createDataFrame([(i, v, 0, b"k") for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>, label int, key binary")
    vectors = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vectors]
    degree, low = brute_vectors(vectors)
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(rows).collect()}
    assert [got[i]["n_links"] for i in range(len(vectors))] == degree
    assert {i: r["component_id"] for i, r in got.items()} == low
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_quantised_bounds_hold():
    rng = np.random.default_rng(2)
    unit = vector_dedup.unit_rows(rng.normal(size=(200, 24)))
    codes, scale, error = vector_dedup.quantise(unit)
    near = (codes * scale[:, None]) @ (codes * scale[:, None]).T
    room = error[:, None] * (1 + error) + error * (1 + error[:, None]) + error[:, None] * error
    assert (np.abs(unit @ unit.T - near) <= room).all()


def test_vectors_do_not_travel_with_pairs_of_tiles(spark, monkeypatch):
    """Only names of tiles are shuffled for a pair; squares of several tiles find the same links."""
    monkeypatch.setattr(vector_dedup, "TILE", 64 * 16)
    monkeypatch.setattr(vector_dedup, "SQUARES", 8)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(700, 16)).astype(np.float32)
    vectors[600:] = vectors[:100] * np.float32(3) + rng.normal(size=(100, 16)).astype(np.float32) * np.float32(0.05)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    degree, low = brute_vectors(vectors.tolist())
    stage, seen = vector_dedup.stage_for(spark, "vectors-test"), {}
    kept = type(stage).__call__

    def keep(self, df, name):
        seen[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(self, df, name)

    monkeypatch.setattr(type(stage), "__call__", keep)
    got = {r["vec_id"]: r for r in vector_dedup.near_duplicates(rows, stage=stage).collect()}
    assert [got[i]["n_links"] for i in range(len(vectors))] == degree and sum(degree) >= 200
    assert {i: r["component_id"] for i, r in got.items()} == low
    assert "vectors" not in seen["linked"] and "RepartitionByExpression [x" in seen["linked"]


def test_vectors_none_and_without_id(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert vector_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [2.0, 0.0])], schema)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_duplicates(rows).collect()}
    assert got == {None: (0, None, False), 5: (1, 5, True), 6: (1, 5, False)}


# ---------------------------------------------------------------- passages


def found_words(spark, texts):
    rows = spark.createDataFrame([(i, t, 5, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, start int, d string")
    out = {}
    for r in substring.passages(rows).collect():
        out.setdefault(r["id"], []).append((texts[r["id"]][r["start"] : r["end"]], r["first_id"], r["n_words"]))
    return out


def prose(r, n, tag):
    return [f"{tag}{r.randrange(10**6)}" for _ in range(n)]


def test_planted_passages_are_found_and_clean_texts_left(spark):
    r = random.Random(3)
    passage = prose(r, 55, "p")
    fuzzy = list(passage)
    for i in (20, 41):
        fuzzy[i] = "changed"
    del fuzzy[30]
    texts = [" ".join(prose(r, 80, "a") + passage + prose(r, 40, "b"))]
    texts += ["\n".join(prose(r, r.randrange(0, 60), "é") + passage + prose(r, r.randrange(0, 90), "d")) for _ in range(12)]
    texts.append(" ".join(prose(r, 30, "f") + fuzzy + prose(r, 30, "g")))
    clean = len(texts)
    texts += [" ".join(prose(r, 200, "h")) for _ in range(10)]
    texts.append(" ".join(prose(r, 50, "k") + passage[:30] + prose(r, 50, "l")))  # too short a part
    texts += [None, "", "few words"]
    got = found_words(spark, texts)
    assert set(got) == set(range(1, clean))
    for i in range(1, clean - 1):
        ((text, first, n),) = got[i]
        assert first == 0 and n >= 55 and set(passage) <= set(text.split()) and n <= 57
    ((text, first, n),) = got[clean - 1]
    assert set(fuzzy) - {"changed"} <= set(text.split())


def test_passage_from_two_sources_and_whole_copies(spark):
    r = random.Random(6)
    one, two = prose(r, 100, "a"), prose(r, 100, "b")
    texts = [" ".join(one), " ".join(two), " ".join(one[40:80] + two[10:50]), " ".join(one)]
    got = found_words(spark, texts)
    assert set(got) == {2, 3}
    assert got[2][0][0] == texts[2] and got[3][0][0] == texts[3]


def test_remove_keeps_the_first_and_every_row(spark):
    r = random.Random(7)
    p = " ".join(prose(r, 60, "p"))
    rows = [(5, f"one {p} end", "x"), (2, f"é {p} tail", "y"), (9, None, "z"), (9, "", "z"), (None, f"null {p}", "n"), (5, f"one {p} end", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, cuts string")
    out = substring.remove(docs)
    assert out.columns == docs.columns and out.count() == 6
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert got == {(None, f"null {p}"), (2, "é  tail"), (5, "one  end"), (9, None), (9, "")}
    assert substring.remove(docs.limit(0)).count() == 0 and substring.passages(docs.limit(0)).count() == 0


def test_chains_are_collinear_and_best_first():
    r = random.Random(1)
    line = [(i, i + 100) for i in range(0, 80, 4)]
    noise = [(r.randrange(80), r.randrange(400)) for _ in range(30)]
    found = substring.chains(line + noise)
    assert set(found[0]) >= set(line) - set(noise) or len(found[0]) >= len(line) - 2
    for path in found:
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in itertools.pairwise(path))
    assert sorted(m for path in found for m in path) == sorted(set(line + noise))


def test_minimisers_meet_in_every_shared_run():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**60, substring.WINDOW).astype(np.uint64)
    for n in range(30):
        a, b = (np.concatenate([rng.integers(0, 2**60, n + 3).astype(np.uint64), shared, rng.integers(0, 2**60, 40 - n).astype(np.uint64)]) for _ in range(2))
        assert set(a[substring.minimisers(a)]) & set(b[substring.minimisers(b)]) & set(shared)


def best_scores(matches, k):
    """Best score of a chain ending at each match, by going through all predecessors in reach."""
    out = {}
    for x, y in sorted(matches):
        before = [v - substring.GAP_COST * (x - a + y - b) / 2 for (a, b), v in out.items() if 0 < x - a <= substring.MAX_GAP and 0 < y - b <= substring.MAX_GAP]
        out[x, y] = k + max([0.0, *before])
    return out


def test_chains_of_two_passages_equal_brute_force():
    r = random.Random(2)
    for n in range(40):
        far = 125 + 5 * n
        line = [(i, i + 5) for i in range(0, 60, 4)] + [(i + far, i + far + 20) for i in range(0, 60, 4)]
        matches = sorted(set(line + [(r.randrange(far + 60), r.randrange(far + 80)) for _ in range(n)]))
        best = max(best_scores(matches, 6).values())
        first = substring.chains(matches, 6)[0]
        cost = sum(substring.GAP_COST * (b[0] - a[0] + b[1] - a[1]) / 2 for a, b in itertools.pairwise(first))
        assert 6 * len(first) - cost == pytest.approx(best)
        if not n:
            assert sorted(map(len, substring.chains(matches, 6))) == [15, 15]


def test_two_passages_of_one_pair_are_both_found(spark):
    r = random.Random(12)
    head, foot = prose(r, 70, "p"), prose(r, 70, "q")
    texts = [" ".join(prose(r, 20, "a") + head + prose(r, n, "b") + foot) for n in (90, 200)]
    got = found_words(spark, texts)
    assert [set(t.split()) >= set(p) for (t, _, _), p in zip(sorted(got[1], key=lambda x: texts[1].index(x[0])), (head, foot), strict=True)] == [True, True]


def test_passage_whose_seeds_are_all_met_earlier_elsewhere(spark):
    r = random.Random(21)
    passage = prose(r, 52, "p")
    # Every six-word run of the passage stands in an earlier text already, but nowhere the passage.
    texts = [" ".join(prose(r, 40, "a") + passage[i : i + 12] + prose(r, 40, "b")) for i in range(0, 41, 6)] + [" ".join(passage[40:] + prose(r, 30, "c"))]
    source = len(texts)
    texts += [" ".join(prose(r, 30, "d") + passage + prose(r, 30, "e")), " ".join(prose(r, 45, "f") + passage + prose(r, 15, "g"))]
    got = found_words(spark, texts)
    assert set(got) == {source + 1}
    ((text, first, _),) = got[source + 1]
    assert first == source and text.split() == passage


def test_one_seed_leads_to_the_whole_passage(spark):
    r = random.Random(22)
    passage = prose(r, 400, "p")
    # All of the passage but its middle stands in pieces below PART_WORDS in earlier texts, here as often as its seeds ask.
    pieces = [" ".join(prose(r, 30, "a") + passage[i : i + 19] + prose(r, 30, "b")) for i in [*range(0, 180, 6), *range(210, 390, 6)]]
    texts = [*pieces, " ".join(prose(r, 30, "d") + passage + prose(r, 30, "e")), " ".join(passage)]
    got = found_words(spark, texts)
    ((text, first, n),) = got[len(texts) - 1]
    assert text.split() == passage and first == len(pieces) and n == 400


def test_lone_seeds_that_go_are_too_short():
    r = np.random.default_rng(4)
    for _ in range(400):
        here = r.integers(0, 2**63, 60).astype(np.uint64)
        there = np.where(r.random(60) < r.choice([0.1, 0.4, 0.9]), here, r.integers(0, 2**63, 60).astype(np.uint64))
        there[27:33] = here[27:33]
        near = [substring.next_words(x, np.array([27])) for x in (here, there)]
        if not substring.may_go_on((near[0] ^ near[1]).view(np.int64))[0]:
            words = [(x >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in (here, there)]
            assert all(b - a < substring.PART_WORDS for a, b, *_ in substring.align([(27, 27)], *words, 0, 0))


@pytest.mark.parametrize("every", [10, 12, 15])
def test_fuzzy_passages_with_every_nth_word_replaced(spark, every):
    r = random.Random(every)
    texts = []
    for n in range(40):
        passage = prose(r, 80, "p")
        copy = [f"x{r.random()}" if i % every == n % every else w for i, w in enumerate(passage)]
        texts += [" ".join(prose(r, 20, "a") + passage + prose(r, 20, "b")), " ".join(prose(r, 30, "c") + copy + prose(r, 30, "d"))]
    got = found_words(spark, texts)
    assert set(got) == set(range(1, 80, 2)) and all(got[i][0][1] == i - 1 for i in got)


def test_places_of_many_texts_equal_those_of_each():
    rng = np.random.default_rng(3)
    for turn in range(60):
        sizes = rng.integers(0, 60, rng.integers(1, 9))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        runs = rng.integers(0, 2**60 if turn % 3 else 5, max(0, offsets[-1] - 5)).astype(np.uint64)
        for window in (4, 14):
            at, text = substring.places_of(offsets, runs, 6, window)
            want = [(a + int(p), i) for i, (a, b) in enumerate(itertools.pairwise(offsets.tolist())) for p in substring.minimisers(runs[a : max(a, b - 5)], window)]
            assert list(zip(at.tolist(), text.tolist(), strict=True)) == want


def test_minimisers_are_the_first_least_of_every_window():
    rng = np.random.default_rng(4)
    for _ in range(200):
        hashes = rng.permutation(rng.integers(1, 80)).astype(np.uint64)
        want = {s + int(hashes[s : s + 14].argmin()) for s in range(max(1, len(hashes) - 13))}
        assert set(substring.minimisers(hashes, 14).tolist()) == want


def test_grouped_chains_equal_chains_of_each_pair():
    rng = np.random.default_rng(5)
    rows = []
    for pair in range(80):
        n = int(rng.integers(1, 12))
        p = np.sort(rng.integers(0, 400, n))
        q = p + int(rng.integers(0, 50)) if pair % 2 else rng.integers(0, 400, n)
        rows += [(pair // 3, pair, int(a), int(b), int(x)) for a, b, x in zip(p, q, rng.integers(-(2**62), 2**62, n) * (pair % 5 > 0), strict=True)]
    rows += rows[:40]  # repeated rows give repeated matches
    rows.sort(key=lambda r: r[:4])
    once = {}
    for d, o, p, q, x in rows:
        once.setdefault((d, o), {}).setdefault((p, q), x)
    want = []
    for (d, o), matches in once.items():
        for path in substring.chains(list(matches)):
            if len(path) > 1 or substring.may_go_on(np.array([matches[path[0]]]))[0]:
                want.append((d, o, path))
    d, o, p, q, x = (np.array(c, dtype=np.int64) for c in zip(*rows, strict=True))
    d, o, here, there = substring.grouped_chains(d, o, p, q, x)
    got = [(a, b, list(zip(x, y, strict=True))) for a, b, x, y in zip(d.tolist(), o.tolist(), here.to_pylist(), there.to_pylist(), strict=True)]
    assert sorted(got) == sorted(want) and len(want) > 60


def test_chains_of_two_texts_ask_for_their_words_once(spark):
    """A line that two texts share at many places makes a chain each; blocks are joined for a pair's region, not for each chain."""
    r, asked = random.Random(8), {}
    line = " ".join(f"line{i}" for i in range(12))
    texts = [" ".join(line + " " + " ".join(f"w{r.randrange(10**9)}" for _ in range(70)) for _ in range(40)) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    class Seen(Stage):
        def __call__(self, df, name):
            out = super().__call__(df, name)
            if name == "chains":
                asked["chains"] = out.count()
            elif name.startswith("asking"):
                asked.setdefault("regions", out.count())
                asked.setdefault("held", out.selectExpr("sum(size(chains))").first()[0])
            return out

    substring.passages(docs, stage=Seen(spark, "seen")).collect()
    assert asked["chains"] >= 20 and asked["held"] == asked["chains"]
    assert asked["regions"] <= asked["chains"] / 2


def test_pipeline_steps_leave_only_what_their_result_reads(spark):
    r = random.Random(3)
    body = [" ".join(f"w{r.randrange(500)}" for _ in range(120)) for _ in range(12)]
    texts = [*body, body[0], body[1] + " end", "mail a@b.org " + body[2], None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = pathlib.Path(checkpoint_dir(spark).removeprefix("file://"))
    for name, step in (("gone", trie_join.keep_one), ("cuts", substring.remove), ("spans", pii.redact)):
        before = set(root.rglob("*.parquet"))
        out = step(docs)
        assert {p.parent.name for p in set(root.rglob("*.parquet")) - before} == {name}
        assert out.count() <= len(texts) and out.columns == docs.columns


def test_rows_with_a_key_stand_in_the_first_part(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else f"t{i % 40}") for i in range(200)], "i long, t string")
    keys = rows.where("i % 40 = 7").select(F.xxhash64("t").alias("k"))
    some, others = parted(rows, F.xxhash64("t"), keys, "k")
    own = sorted(x["i"] for x in some.collect())
    assert {i for i in range(200) if i % 40 == 7} <= set(own) and len(own) < 100
    assert sorted(own + [x["i"] for x in others.collect()]) == list(range(200))


def test_shingles_are_made_step_by_step(monkeypatch):
    """A task of the n-gram join never works on more than one small step of a batch's texts."""
    seen, words = [], trie_join.Words
    monkeypatch.setattr(trie_join, "Words", lambda texts: seen.append(sum(map(len, texts))) or words(texts))

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    class Sent:
        value = np.zeros(1 << trie_join.LEVEL_BITS, dtype=np.uint8)

    texts = [" ".join(f"w{i}x{j}" for j in range(20_000)) for i in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts), pa.array(range(8))], ["id", "t", "k"])
    [out] = trie_join._described(Rows(), Sent, 5, 80)(iter([batch]))
    assert out.column(3).to_pylist() == [20_000 - 4] * 8 and sum(seen) == sum(map(len, texts))
    assert max(seen) <= max(PART_BYTES, max(map(len, texts)))
