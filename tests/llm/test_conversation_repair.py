import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from corpusloom.llm import conversation_repair as R
from corpusloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
LAWFUL = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s?(ua)*u?)?")


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else (
            None if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
        found.append(fault)
    return found


def brute(rows):
    """(cost, audit, repaired) by whole strings: every edit of every row, unlawful beginnings cut."""
    found = {"": (0, "", [])}  # initials so far -> best

    def better(table, state, candidate):
        if state not in table or candidate[:2] < table[state][:2]:
            table[state] = candidate

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                for role in ("user", "assistant"):
                    if PREFIX.fullmatch(state + role[0]):
                        better(table, short(state + role[0]), (cost + 2, audit + "I", out + [f"{role}:"]))
        return table

    def short(initials):  # what may follow depends on the end alone
        return initials if len(initials) < 2 else "ua" if initials[-1] == "a" else "u"

    for (role, text), fault in zip(rows, faults(rows)):
        new = {}
        for state, (cost, audit, out) in inserted(found).items():
            better(new, state, (cost + 3, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            for letter, kept, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                if PREFIX.fullmatch(state + (kept[:1] or "?")):
                    better(new, short(state + kept[:1]), (cost + price, audit + letter, out + [f"{kept}:{text}"]))
        found = new
    cost, audit, out = min(v for k, v in inserted(found).items() if LAWFUL.fullmatch(k))
    return cost, audit, "\n".join(out)


def exhaustive(rows):
    """The same over all sequences of edits, for a few rows."""
    options = []
    for (role, text), fault in zip(rows, faults(rows)):
        own = [(3, "D", "")]
        if fault not in ("blank", "duplicate"):
            extra = fault == "truncated"
            own += [(extra, "K", role[:1] or "?"), (2 + extra, "R", "u"), (2 + extra, "R", "a")]
        options += [[(2 * n, "I" * n, r) for n in range(3) for r in map("".join, itertools.product("ua", repeat=n))], own]
    options.append(options[0] if options else [(0, "", "")])
    best = None
    for choice in itertools.product(*options):
        if LAWFUL.fullmatch("".join(c[2] for c in choice)):
            here = sum(c[0] for c in choice), "".join(c[1] for c in choice)
            best = here if best is None or here < best else best
    return best


def turns(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", ""]
    texts = ["Yes.", "no", " \n", "", "One more?", "So it is!  \n", "u"]
    return [(rng.choice(roles), rng.choice(texts) + rng.choice(["", "", str(rng.randint(0, 9)) + "."]))
            for _ in range(n)]


def test_whole_strings_agree_with_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3, 3):
        rows = turns(rng, n)
        assert brute(rows)[:2] == exhaustive(rows)


@pytest.mark.parametrize("modulus", [R.MODULUS, 3])
def test_audits_of_one_segment_and_of_many(modulus):
    rng = random.Random(2)
    for trial in range(60):
        rows = turns(rng, rng.randint(1, 40))
        needs = [{None: R.SOUND, "truncated": R.TRUNCATED}.get(f, R.UNFIT) for f in faults(rows)]
        known = [(role[:1], need) for (role, _), need in zip(rows, needs)]
        step = 100 if trial % 2 else rng.randint(1, 7)
        segments, names = [], []
        for at in range(0, len(known), step):
            found = {(a, b): best for a in range(4) for b, best in
                     R.segment_audits(known[at:at + step], a, R.Audits(modulus)).items()}
            order = sorted({x for _, x in found.values()})
            segments.append({k: (cost, order.index(x)) for k, (cost, x) in found.items()})
            names.append({k: x for k, (_, x) in found.items()})
        cost, path, tail = R.join_segments(segments, R.Audits(modulus))
        audit = "".join(own[states] for own, states in zip(names, path)) + tail
        assert (cost, audit) == brute(rows)[:2]


def test_audits_are_compared_like_strings():
    rng = random.Random(3)
    for modulus in (R.MODULUS, 2):
        audits = R.Audits(modulus)
        nodes = {"": R.EMPTY}
        for _ in range(300):
            start = rng.choice(sorted(nodes))
            letter = rng.choice("DIK")
            nodes[start + letter] = audits.extend(nodes[start], [ord(letter)])
        loose = [(s, audits.extend(R.EMPTY, map(ord, s))) for s in rng.sample(sorted(nodes), 40)]
        for a, x in loose:
            assert "".join(map(chr, x.letters())) == a
            for b, y in rng.sample(sorted(nodes.items()), 30) + loose[:10]:
                assert audits.less(x, y) == (a < b)


def expected(rows):
    """(conversation, turn, role, text) rows to what repair() says about each conversation."""
    found = {}
    for key in {r[0] for r in rows}:
        own = [(t, r or "", x or "") for k, t, r, x in rows if k == key]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        plain = [(r, x) for _, r, x in own]
        kinds = faults(plain)
        known = [t for t, *_ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
        cost, audit, repaired = brute(plain)
        found[key] = (gaps, *(kinds.count(n) for n in ("blank", "duplicate", "truncated")), illegal,
                      cost, audit, hashlib.sha256(repaired.encode()).hexdigest())
    return found


def found(spark, rows, **options):
    schema = ("conv_id long, turn long, role string, text string, part string, need string, "
              "audit string, edit string, conversation string, row string, digest string")
    df = spark.createDataFrame([(*r, *["x"] * 7) for r in rows], schema)
    repaired = R.repair(df, **options)
    summary = {r.conversation: r for r in repaired.summary.collect()}
    audits = {r.conversation: r for r in R.audits_and_digests(repaired.edits).collect()}
    assert summary.keys() == audits.keys()
    return {k: (s.gaps, s.blank, s.duplicate, s.truncated, s.illegal, s.cost, audits[k].audit,
                audits[k].repaired_sha256) for k, s in summary.items()}


def test_conversations_over_many_parts(spark):
    rng = random.Random(4)
    rows = []
    for key in [None, *range(12)]:
        at = 0
        for role, text in turns(rng, rng.randint(1, 9)):
            at += rng.choice([1, 1, 1, 2, 5])
            rows.append((key, at, role, text))
    # One conversation of many rows, with many copies of one of them.
    rows += [(99, i, role, text) for i, (role, text) in enumerate(turns(rng, 300))]
    rows += [(99, 150, "user", "And again.")] * 60
    rows += [(50, None, "user", "Null turn."), (50, None, "assistant", "Null turn."), (51, 3, None, None)]
    rows.append((52, 1, "user", "long " * 30_000))
    want = expected(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, part_bytes=400, segment_rows=7) == want


def test_no_rows(spark):
    assert found(spark, []) == {}


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
def test_op11(spark):
    t = pq.read_table(f"{FOLDER}/conversations.parquet").to_pydict()
    kept = []
    for key, turn, role, text in zip(t["conv_id"], t["turn"], t["role"], t["text"]):
        fault = zlib.crc32(f"{key}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        kept += [(key, turn, "user" if fault == 4 else role, text)] * (0 if not fault else 2 if fault == 3 else 1)
    want = expected(kept)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = queries.QUERIES["op11_conversation_repair"](spark, FOLDER).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {k: want.get(k, nothing) for k in t["conv_id"]}
    assert len(got) == len(set(t["conv_id"])) and len({r.audit for r in got}) > 5
