import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelweave.functions import text as t
from labelweave.functions.similarity import cosine, jaro_winkler, jaro_winkler_arrays
from labelweave.operators.matching import filter_labels, score_responses
from labelweave.operators.records import extract_is_match, resolve_column


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_normalize(spark):
    cases = [("Énergie", "energie"), ("Café", "cafe"), ("Déjà Vu", "deja vu"), ("Straße", "strasse"),
             ("é", "e"), ("œuvre ﬁn Ⅳ №", "oeuvre fin iv no"), ("«a»…", "<<a>>..."), ("plain", "plain"),
             ("", ""), (None, None), ("ΑΒγ é", "abg e")]
    df = spark.createDataFrame(cases, "i string, o string")
    assert all(r[0] == r[1] for r in rows(df.select(t.normalize_text("i"), "o")))
    empty = df.where("i is null").select(t.normalize_text("i", "empty"))
    assert rows(empty) == [("",)]
    with pytest.raises(PySparkException):
        df.where("i is null").select(t.normalize_text("i", "fail")).collect()


def test_labels(spark):
    df = spark.createDataFrame([(["a", " ", "b"],), (["x", None, ""],)], "levels array<string>")
    got = rows(df.select(*[t.hierarchy_label("levels", m) for m in ("joined", "joined_all", "first")]))
    assert got == [("a | b", "a |   | b", "a"), ("x", "x | nan | ", "x")]


def test_filter_keeps_ids_and_rejects_bad_patterns(spark):
    df = spark.createDataFrame([(2, "Solar ENERGY"), (3, "water"), (5, "énergie")], "row_id long, label string")
    assert sorted(r[0] for r in rows(filter_labels(df, "energ|éNERG"))) == [2, 5]
    with pytest.raises(Exception):
        filter_labels(df, "(")


def test_jaro_winkler(spark):
    got = jaro_winkler_arrays(["martha", "abcd", "", "", "same"], ["marhta", "abxy", "", "a", "same"])
    assert [round(x, 4) for x in got] == [0.9611, 0.6667, 1.0, 0.0, 1.0]
    long = jaro_winkler_arrays(["a" * 50 + "b" * 50], ["a" * 50 + "c" * 50])
    assert 0.6 < long[0] < 0.9
    df = spark.createDataFrame([("martha", "marhta"), ("x", None)], "a string, b string")
    got = rows(df.select(F.round(jaro_winkler("a", "b"), 4)))
    assert got == [(0.9611,), (None,)]


def plain_jaro_winkler(a, b):
    if not a or not b:
        return float(a == b)
    reach, taken, hits = max(max(len(a), len(b)) // 2 - 1, 0), [False] * len(a), []
    for j, c in enumerate(b):
        for i in range(max(0, j - reach), min(len(a), j + reach + 1)):
            if not taken[i] and a[i] == c:
                taken[i] = True
                hits.append(c)
                break
    if not hits:
        return 0.0
    m, mine = len(hits), [c for c, t in zip(a, taken) if t]
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(mine, hits)) // 2) / m) / 3
    prefix = next((k for k in range(4) if a[k:k + 1] != b[k:k + 1] or not a[k:k + 1]), 4)
    return jaro + 0.1 * prefix * (1 - jaro) if jaro > 0.7 else jaro


def test_jaro_winkler_at_every_length():
    rng, pairs = random.Random(4), []
    for size in [0, 1, 2, 63, 64, 65, 127, 128, 129, 191, 192, 193, 300, 1024, 1025, 1500] * 6:
        letters = rng.choice(["ab", "abcdefgh ", "aé漢😀z\0"])
        a = "".join(rng.choice(letters) for _ in range(size))
        other = "".join(rng.choice(letters) for _ in range(rng.choice([0, 64, 130, 400])))
        pairs += [(a, "".join(c for c in a if rng.random() < 0.9)), (a, other), (other, a), (a, a)]
    got = jaro_winkler_arrays([p[0] for p in pairs], [p[1] for p in pairs])
    assert [round(x, 12) for x in got] == [round(plain_jaro_winkler(*p), 12) for p in pairs]


def test_char_overlap_and_cosine(spark):
    df = spark.createDataFrame([("abc", "bcd", [0.0, 0.0], [1.0, 0.0])], "a string, b string, u array<double>, v array<double>")
    got = rows(df.select(t.char_overlap("a", "b"), cosine("u", "v"), cosine("v", "v")))
    assert got == [(0.5, 0.0, 1.0)]


def test_is_match(spark):
    cells = ['{"isMatch": true}', '{"isMatch": "false"}', '{"isMatch": 0}', '{"isMatch": null}', "[]",
             "isMatch: TRUE", '{"isMatch": true', None, '{"isMatch": 0.0}', '{"a": 1}', '{"isMatch": {"x": 1}}']
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[1] for r in sorted(rows(df.select("i", extract_is_match("c"))))]
    assert got == [True, True, False, False, False, True, False, False, False, False, True]


def test_resolve_column(spark):
    df = spark.createDataFrame([("a", "b", "c")], "`Sous-Domaine` string, `Typé` string, last string")
    assert resolve_column(df, "type", normalized=True) == "Typé"
    assert resolve_column(df, "last") == "last" and resolve_column(df, 0) == "Sous-Domaine"
    assert resolve_column(df, "1") == "Typé" and resolve_column(df) == "last"
    with pytest.raises(ValueError):
        resolve_column(df, "absent", normalized=True)


def test_rewards_and_names(spark):
    df = spark.createDataFrame([("\n Yes, sure", True), ("no", True), ("no", False)], "response string, want boolean")
    got = [r[2] for r in rows(score_responses(df, "response", F.col("want")))]
    assert got == [1.0, -1.0, 1.0]
    named = spark.createDataFrame([("securite / TRAVAIL",), ("***",)], "n string")
    got = rows(named.select(t.capitalize(F.col("n")), t.sheet_key("n", "Theme_1")))
    assert got[0] == ("Securite / travail", "securite  TRAVAIL") and got[1][1] == "Theme_1"


def test_other_scripts_and_symbols(spark):
    cases = {"Ελλάδα ψυχή": "ellada psukhe", "Москва Щёлково": "moskva shchiolkovo", "Київ": "kiyiv", "µ": "m", "5 £ ± §": "5 gbp +- ss",
             "ｶﾀｶﾅ": "カタカナ", "㎏": "kg", "ﬁn": "fin", "①": "1", "東京": "東京"}
    df = spark.createDataFrame(list(cases.items()), "x string, want string")
    assert [r.x for r in df.where(t.normalize_text("x") != F.col("want")).collect()] == []
