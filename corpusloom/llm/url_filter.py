"""Host rules and a weighted vocabulary for URLs.

A rule decides where one fits. Elsewhere one pass of an Aho-Corasick automaton over the URL finds
all terms; a term counts only between characters other than ASCII letters and digits. One strict
term rejects, or several distinct soft ones whose weights reach a bound together.
"""

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
STRICT, SOFT = "strict", "soft"
RESULT = ("host string, path string, rule string, verdict string, strict array<string>, "
          "soft array<string>, weight double")

# A small general vocabulary as (kind, weight, terms); larger ones are a parameter.
GENERAL = (
    (STRICT, 3, "casino porn porno xxx hentai milf escort viagra cialis levitra warez phishing "
                "malware sexcam camgirl jackpot sportsbook payday"),
    (SOFT, 2, "poker roulette slots betting gambling lottery pills pharmacy steroids tramadol "
              "keygen crack torrent serial nulled replica counterfeit adult nude erotic sex dating "
              "forex binary crypto airdrop loan loans mortgage refinance spam scam"),
    (SOFT, 1, "free cheap discount deal deals bonus win winner prize bet coupon promo sale buy "
              "order offer offers now best top hot click earn cash money credit debt weight diet "
              "miracle download full cracked unlimited online live hack cheat generator"),
)
VOCABULARY = tuple((term, kind, float(weight)) for kind, weight, terms in GENERAL
                   for term in terms.split())
# Soft terms reject from this weight on, and never alone.
SOFT_BOUND, MIN_SOFT = 3.0, 2
# A vocabulary travels to every task, so it is bounded.
MAX_TERMS = 1_000_000


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): from the first '://' up to '/', '?', '#'; then up to '?', '#'."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.split("?", 1)[0].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    return ascii_lower(host), slash + path


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def fitting_rule(host: str, path: str, rules: Mapping[tuple[str, str], str]):
    """The longest rule whose host is the URL's or a parent of it and whose path begins the
    URL's; of equally long ones that with the longer host. None if there is none."""
    best = None
    labels = host.split(".")
    for i in range(len(labels)):
        parent = ".".join(labels[i:])
        for rule_path in rules.get(parent, ()):
            if path.startswith(rule_path):
                rank = (len(parent) + len(rule_path), len(parent))
                if best is None or rank > best[0]:
                    best = rank, parent + rule_path, rules[parent][rule_path]
    return best


def _alone(text: str, start: int, end: int) -> bool:
    before, after = text[start - 1:start], text[end:end + 1]
    return not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum())


def read_vocabulary(terms: DataFrame, limit: int = MAX_TERMS) -> tuple[tuple[str, str, float], ...]:
    """A table (term, kind, weight) as a vocabulary; of a term given twice the row that weighs most
    counts, strict before soft. Null and empty terms are left out. More than ``limit`` raise."""
    rows = terms.select("term", "kind", F.col("weight").cast("double").alias("weight")).filter(
        F.length("term") > 0).groupBy("term").agg(
        F.max(F.struct(F.col("kind") == STRICT, "weight")).alias("most")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} terms")
    return tuple(sorted((r.term, STRICT if r.most[0] else SOFT, r.most[1]) for r in rows))


def judge_url(url: Column | str, rules: Sequence[tuple[str, str, str]],
              vocabulary: Sequence[tuple[str, str, float]] = VOCABULARY,
              bound: float = SOFT_BOUND, min_soft: int = MIN_SOFT) -> Column:
    """A struct of host, path, rule, verdict and the distinct terms found with their weight.

    ``rules`` are (verdict, host, path), ``vocabulary`` (term, kind, weight) with terms in lower
    case. Without a fitting rule a URL is blocked by one strict term, or by ``min_soft`` distinct
    soft ones that weigh ``bound`` together; ``weight`` adds up all terms found. A null URL and one
    without '://' have empty host and path; null holds no term, so it is allowed. A long URL is read
    whole, repeated ones each. Any other column is left alone.
    """
    by_host: dict[str, dict[str, str]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host, {})[path] = verdict
    terms = {term: (kind, weight) for term, kind, weight in vocabulary}

    @F.pandas_udf(RESULT)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in terms:
            automaton.add_word(term, term)
        if terms:
            automaton.make_automaton()

        def one(url):
            host, path = split_url(url)
            text = ascii_lower(url or "")
            hits = {t for end, t in automaton.iter(text)
                    if _alone(text, end + 1 - len(t), end + 1)} if terms else set()
            strict = sorted(t for t in hits if terms[t][0] == STRICT)
            soft = sorted(t for t in hits if terms[t][0] != STRICT)
            together = sum(terms[t][1] for t in soft)
            bad = bool(strict) or len(soft) >= min_soft and together >= bound
            rule = fitting_rule(host, path, by_host)
            verdict = rule[2] if rule else BLOCK if bad else ALLOW
            return (host, path, rule and rule[1], verdict, strict, soft,
                    float(together + sum(terms[t][1] for t in strict)))

        names = [f.split()[0] for f in RESULT.split(", ")]
        for urls in batches:
            yield pd.DataFrame([one(None if pd.isna(u) else u) for u in urls], columns=names)

    return judge(F.col(url) if isinstance(url, str) else url)
