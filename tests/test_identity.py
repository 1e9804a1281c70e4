import random

import pytest

from tidewatch.functions.similarity import jaro_winkler_text
from tidewatch.operators import identity
from tidewatch.plans import workforce

HR = [
    ("E1", "Robert Smith", "ICU"), ("E2", "Ann Lee", "ICU"), ("E3", "Robert Jones", "ED"), ("E4", "Mary Stone", "ED"),
    ("E5", "Al Kay", "ED"), ("E6", "Al Kay", "ED"), ("E7", "Zed Only", "ED"), ("E8", "Susan Meyer", "LAB"), ("E9", "", "LAB"),
]
TAS = [
    ("T1", "Bob J. Smith RN", " icu "), ("T2", "ANN LEE", "ICU"), ("T3", "Rboert Jones", "ED"), ("T4", "Mary Wood", "ED"),
    ("T5", "Al Kay", "ED"), ("T6", "Agency Person", "POOL"), ("T7", "Sue Maier", "LAB"), ("T8", "Robert Smith", "OR"),
]


@pytest.fixture(scope="module")
def sides(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, n string, d string")
    return [identity.people(make(x), "id", "n", "d") for x in (HR, TAS)]


@pytest.fixture(scope="module")
def links(sides):
    return {(r["left_id"], r["right_id"]): r for r in identity.build_crosswalk(*sides).collect()}


def test_likeness_known_values():
    assert abs(jaro_winkler_text("MARTHA", "MARHTA") - 0.961111) < 1e-6
    assert abs(jaro_winkler_text("DIXON", "DICKSONX") - 0.813333) < 1e-6
    assert jaro_winkler_text("", "A") == 0.0 and jaro_winkler_text("A", None) is None


def test_tiers(links):
    by = {k: (r["match_method"], r["match_rule"], r["needs_review"]) for k, r in links.items()}
    assert by[("E1", "T1")] == ("EXACT_NAME", "same_name", False)  # nickname, initial, suffix, blanks
    assert by[("E2", "T2")] == ("EXACT_NAME", "same_name", False)
    assert by[("E3", "T3")] == ("FUZZY", "similar_name", False)        # adjacent swap
    assert by[("E8", "T7")] == ("FUZZY", "similar_name", False)    # alike in sound and writing
    assert by[("E4", "T4")] == ("FUZZY", "same_first_name", True)  # married name


def test_ties_and_leftovers_stay_visible(links):
    by = {k: (r["match_method"], r["match_rule"]) for k, r in links.items()}
    assert by[("E5", None)] == by[("E6", None)] == ("UNMATCHED", "tie")
    assert by[("E7", None)] == by[("E9", None)] == ("UNMATCHED", "none")
    assert by[(None, "T6")] == by[(None, "T8")] == ("UNMATCHED", "none")
    assert by[(None, "T5")] == ("UNMATCHED", "tie")  # fits two people of the other side


def test_every_id_exactly_once(links):
    assert sorted(k[0] for k in links if k[0]) == sorted(r[0] for r in HR)
    assert sorted(k[1] for k in links if k[1]) == sorted(r[0] for r in TAS)


def test_equal_ids_link_first(spark, rows):
    make = lambda r: spark.createDataFrame(r, "id string, dept string, first string, last string")
    out = identity.build_crosswalk(make([("X1", "A", "ANN", "LEE")]), make([("X1", "B", "BEA", "ROE")]))
    assert rows(out, "left_id", "right_id", "match_method") == [("X1", "X1", "EXACT_ID")]


def test_a_hot_name_makes_no_pairs(spark, rows):
    hot = spark.range(3000).selectExpr("concat('L', id) id", "'D' dept", "'ANN' first", "'LEE' last")
    other = spark.range(3000).selectExpr("concat('R', id) id", "'D' dept", "'ANN' first", "'LEES' last")
    assert identity.candidate_pairs(hot, other).count() == 1
    out = identity.build_crosswalk(hot, other)
    assert out.count() == 6000 and rows(out.select("match_rule").distinct()) == [("tie",)]


def test_naive_join_beside_crosswalk(spark, sides, rows):
    hr = spark.createDataFrame([(i, n, d, 0.5) for i, n, d in HR], "employee_id string, worker_name string, department string, fte double")
    tas = spark.createDataFrame(TAS, "tas_worker_id string, worker_name string, department string")
    out = workforce.naive_vs_reconciled(hr, tas, workforce.crosswalk(hr, tas))
    assert rows(out) == [("crosswalk", 5, 2.5), ("naive id join", 0, 0.0), ("roster", 9, 4.5)]


def test_ids_with_several_links_go_to_review_and_none_is_lost(spark):
    make = lambda rows: identity.people(spark.createDataFrame(rows, "id string, n string, d string"), "id", "n", "d")
    hr = make([("E1", "Ann Lee", "ICU"), ("E1", "Bea Moss", "ICU"), ("E2", "Cy Young", "ICU"), ("E3", "Di Xu", "ICU"), ("E4", "Ed Fox", "ED")])
    tas = make([("T1", "Ann Lee", "ICU"), ("T2", "Bea Moss", "ICU"), ("T3", "Cy Young", "ICU"), ("T3", "Di Xu", "ICU"), ("T4", "Ed Fox", "ED")])
    got = {(r["left_id"], r["right_id"]): (r["match_rule"], r["needs_review"]) for r in identity.build_crosswalk(hr, tas).collect()}
    several = ("several_links", True)
    assert got == {
        ("E4", "T4"): ("same_name", False), ("E1", None): several, (None, "T1"): several, (None, "T2"): several,
        ("E2", None): several, ("E3", None): several, (None, "T3"): several,
    }


def test_scored_names_within_and_across_departments(spark):
    make = lambda rows: identity.people(spark.createDataFrame(rows, "id string, n string, d string"), "id", "n", "d")
    hr = make([("E1", "Margaret Henderson", "ICU"), ("E2", "James Kowalski", "ED"), ("E3", "Nora Field", "ED"), ("E4", "Nora Field", "OR")])
    tas = make([("T1", "Margerat Hendreson", "ICU"), ("T2", "James Kowalski", "LAB"), ("T3", "Nora Feild", "ED")])
    got = {(r["left_id"], r["right_id"]): (r["match_rule"], r["needs_review"]) for r in identity.build_crosswalk(hr, tas).collect()}
    assert got["E1", "T1"] == ("similar_name", False)
    assert got["E2", "T2"] == ("similar_name", True)  # another department: for review
    assert got["E3", "T3"] == ("similar_name", False) and got["E4", None][0] in ("none", "tie")  # the department decides


def brute_grams(x):
    return {x[i : i + 2] for i in range(max(len(x) - 1, 1))}


@pytest.mark.parametrize("percent", [50, 70])
def test_gram_join_equals_all_pairs(spark, percent):
    r = random.Random(percent)
    base = ["ANN LEE", "MARGARET HENDERSON", "ROBERT SMITH", "BO LI", "A B", "SUSAN MEYER", "AAAA AAAA"]

    def bent(x):
        x = list(x)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(x))
            x[k : k + 1] = r.choice([[], [r.choice("ABCDE")], [x[k], x[k]]])
        return "".join(x) or "X"

    sides = {k: sorted({(r.choice("PQ"), bent(r.choice(base))) for _ in range(150)} | {("P", "Z"), ("P", "ANN LEE")}) for k in "lr"}
    make = lambda k: spark.createDataFrame([(d, d, n, 1, "x") for d, n in sides[k]], f"dept string, dept_{k} string, name_{k} string, n_{k} bigint, id_{k} string")
    got = {(x["dept_l"], x["name_l"], x["name_r"]) for x in identity.alike_in_grams(make("l"), make("r"), percent).collect()}
    want = set()
    for d, a in sides["l"]:
        for e, b in sides["r"]:
            x, y = brute_grams(a), brute_grams(b)
            if d == e and 100 * len(x & y) >= percent * len(x | y):
                want.add((d, a, b))
    assert got == want and len(want) > 100


FIRST = ["ANNA", "BRUNO", "CARLA", "DAVID", "ELENA", "FRANK", "GRETA", "HUGO", "IRENE", "JONAS", "KAREN", "LEO", "MARTA", "NILS", "OLGA", "PETER"]
LAST = ["HENDERSON", "KOWALSKI", "MEYER", "OKAFOR", "PETROVA", "QUINN", "RAMIREZ", "SCHMIDT", "TANAKA", "URBAN", "VARGAS", "WEAVER", "XAVIER", "YOUNGER", "ZELLER", "ABBOTT"]


def test_link_model_finds_planted_people(spark):
    """Precision and recall of probability 0.9 on planted pairs: a typing error in the last name, some in another department."""
    r = random.Random(21)
    left, right, true = [], [], set()
    people_ = r.sample([(f, x) for f in FIRST for x in LAST], 200)
    for i, (f, x) in enumerate(people_):
        dept = f"D{i % 8}"
        left.append((f"L{i}", f"{f} {x}", dept))
        if i < 130:
            k = r.randrange(1, len(x) - 1)
            typo = x if i % 2 else x[:k] + r.choice("BCDFG") + x[k + 1 :]
            right.append((f"R{i}", f"{f} {typo}", dept if i % 10 else f"D{(i + 1) % 8}"))
            true.add((f"L{i}", f"R{i}"))
        else:  # someone else of the same last name
            right.append((f"R{i}", f"{('ZOE', 'WALT', 'YARA')[i % 3]} {x}", f"D{r.randrange(8)}"))
    make = lambda rows: identity.people(spark.createDataFrame(rows, "id string, n string, d string"), "id", "n", "d")
    pairs = identity.candidate_pairs(make(left), make(right)).cache()
    model = identity.fit_weights(identity.agreement_patterns(pairs))
    scored = identity.link_probabilities(pairs, model)
    found = {(x["id_l"], x["id_r"]) for x in identity.probable_links(scored).collect()}
    assert scored.count() == pairs.count() and 1 < model.rounds
    reached = {(x["id_l"], x["id_r"]) for x in pairs.collect()} & true
    assert len(found & true) >= 0.95 * len(found) and len(found & true) >= 0.95 * len(reached) and len(reached) >= 0.9 * len(true)
    assert model.m["first"][2] > model.u["first"][2] and model.m["last"][0] < model.u["last"][0]


def test_link_model_without_pairs(spark):
    none = spark.createDataFrame([], "dept_l string, dept_r string, name_l string, name_r string")
    model = identity.fit_weights(identity.agreement_patterns(none))
    assert model.rounds == 0 and identity.link_probabilities(none, model).count() == 0
