import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from rows import AWKWARD, empty, table

from corpusloom.llm import exact_dedup as E


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[normal(text)].append(key)
    return sorted(((k, min((x for x in groups[normal(t)] if x is not None), default=None),
                    len(groups[normal(t)]), sha256(normal(t).encode()).hexdigest())
                   for k, t in rows), key=repr)


@pytest.mark.parametrize("digest", [E.sha256_digest, lambda text: F.length(text) % 3])
def test_groups_also_with_digests_that_collide(spark, digest):
    got = E.exact_dedup(table(spark), salts=3, digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_key, r.group_size, r.normalised_sha256) for r in got),
                  key=repr) == expected(AWKWARD)
    kept = [r.normalised_sha256 for r in got if r.kept]
    assert sorted(kept) == sorted({r.normalised_sha256 for r in got})


def test_rows_that_stay(spark):
    stay = E.without_duplicates(table(spark))
    assert stay.columns == table(spark).columns
    rows = stay.collect()
    assert sorted(normal(r.text) for r in rows) == sorted({normal(t) for _, t in AWKWARD})
    assert {r.doc_id for r in rows if normal(r.text).startswith("Hello")} == {1}


def test_empty_table(spark):
    assert E.exact_dedup(empty(spark)).count() == 0


def test_nothing_runs_in_python(spark):
    plan = E.exact_dedup(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
