import random
import re

import pytest

from corpusloom.llm import url_filter as U

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/")]
CASES = [  # url, host, path, rule, verdict
    ("http://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
    ("http://a.example.com/EN/", "a.example.com", "/EN/", "com/", "allow"),
    ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("http://com", "com", "", None, "allow"), ("http://net/es/", "net", "/es/", "net/es/", "block"),
    ("x://casino.org/a", "casino.org", "/a", None, "block"),
    ("x://casinos.org/a", "casinos.org", "/a", None, "allow"),
    ("x://a.org/free-win", "a.org", "/free-win", None, "allow"),
    ("x://a.org/free-win/bonus", "a.org", "/free-win/bonus", None, "block"),
    ("x://a.org/free-poker", "a.org", "/free-poker", None, "block"),
    ("x://a.org/poker-poker", "a.org", "/poker-poker", None, "allow"),
    ("x://a.org/freepoker", "a.org", "/freepoker", None, "allow"),
    ("x://a.org?q=casino", "a.org", "", None, "block"), ("no scheme/net", "", "", None, "allow"),
    ("x://a://b/c", "a:", "//b/c", None, "allow"), ("", "", "", None, "allow"),
    (None, "", "", None, "allow"), ("x://" + "a" * 50_000 + ".com/", "a" * 50_000 + ".com", "/", "com/", "allow"),
]


def test_cases_twice_beside_clashing_names(spark):
    rows = [(u, "x", "y") for u, *_ in CASES] * 2
    df = spark.createDataFrame(rows, "url string, host string, verdict string")
    got = [tuple(r.j[:4]) for r in df.select(U.judge_url("url", RULES).alias("j")).collect()]
    assert got == [(h, p, r, v) for _, h, p, r, v in CASES] * 2


def test_terms_and_weight(spark):
    df = spark.createDataFrame([("http://x.org/free/casino-win",)], "url string")
    j = df.select(U.judge_url("url", ()).alias("j")).first().j
    assert (j.strict, j.soft, j.weight) == (["casino"], ["free", "win"], 5.0)
    assert df.limit(0).select(U.judge_url("url", ())).count() == 0
    assert df.select(U.judge_url("url", (), ()).alias("j")).first().j.verdict == "allow"


def test_thousands_of_terms_against_a_search_for_each(spark):
    rng = random.Random(8)
    parts = ["".join(rng.choices("abc1", k=rng.randint(1, 4))) for _ in range(2500)]
    terms = [(t, rng.choice(["strict", "soft", "soft", "soft"]), rng.choice([0.5, 1.0, 2.5])) for t in
             dict.fromkeys(p + rng.choice(["", "-x", ".y"]) for p in parts)]
    table = spark.createDataFrame([*terms, ("", "strict", 9.0), (None, "soft", 1.0)],
                                  "term string, kind string, weight double")
    vocabulary = U.read_vocabulary(table)
    assert sorted(vocabulary) == sorted(terms) and len(terms) > 300
    with pytest.raises(ValueError):
        U.read_vocabulary(table, 10)
    urls = ["x://" + rng.choice("/.-").join(rng.choice(parts) + rng.choice(["", "zz", "-x"]) for _ in range(6))
            for _ in range(150)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    for r in df.select("url", U.judge_url("url", (), vocabulary, 4.0, 3).alias("j")).collect():
        found = [(t, kind, w) for t, kind, w in terms
                 if re.search(f"(?<![a-zA-Z0-9]){re.escape(t)}(?![a-zA-Z0-9])", r.url)]
        soft = [w for _, kind, w in found if kind == "soft"]
        assert r.j.strict == sorted(t for t, kind, _ in found if kind == "strict")
        assert r.j.weight == pytest.approx(sum(w for *_, w in found))
        assert (r.j.verdict == "block") == (bool(r.j.strict) or len(soft) >= 3 and sum(soft) >= 4)


@pytest.mark.parametrize("rule", [("a.b", "/x"), ("b", "/x/y")])
def test_longest_rule(rule):
    rules = {"b": {"/x/y": "block"}, "a.b": {"/x": "allow"}}
    best = U.fitting_rule("a.b", "/x/y", rules)
    assert best[1] == "a.b/x" and U.fitting_rule("c", "/x", rules) is None and rule[0] in rules
