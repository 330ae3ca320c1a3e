"""Log-probabilities of texts under a smoothed n-gram model of the corpus.

The model is a weighted automaton. A state is a context of words, an arc the next word; a state
without an arc for a word is left by its failure arc, whose weight is paid, to the state of the
context without its first word. One pass from left to right carries the number of the state, over
many stretches of text abreast, and adds up weights.

The model grows with the corpus and no task holds it. Texts are dealt into blocks. A block sends
each distinct n-gram once, with its count in the texts to learn from, to the range of n-grams that
adds the counts of all blocks; the sums come back, and the block builds the part of the automaton
that its texts can reach.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import blocks_for
from corpusloom.llm.sorted_keys import pack, pack_numbers, unpack, unpack_numbers

ORDER = 2
# The weight of the shorter context, in occurrences: p(w|h) = (c(hw) + PRIOR p(w|h')) / (c(h) + PRIOR).
PRIOR = 100.0
BLOCK_BYTES = 16 << 20
# Tokens of a lane, and so steps of a walk over a block.
LANE = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Tokens that no word hashes to except by chance: the start and the end of a text.
_START, _END = np.uint64(0x5354415254), np.uint64(0x454E44)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


@dataclass
class Grams:
    """The n-grams of a block of texts, each text being start, words, end.

    ``places`` of order k are the positions where an n-gram of k tokens ends, ``index`` gives the
    number of the n-gram at a position, ``keys`` are the distinct n-grams, ascending, and ``at``
    one position of each. The start alone is no n-gram.
    """

    starts: np.ndarray
    length: np.ndarray
    places: list[np.ndarray]
    index: list[np.ndarray]
    keys: list[np.ndarray]
    at: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[str | None], order: int) -> "Grams":
        known, held = _Words(), []
        for text in texts:
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            held.append(np.concatenate([[_START], hashes, [_END]]))
        length = np.array([len(h) for h in held], np.int64)
        starts = np.cumsum(length) - length
        token = np.concatenate(held)
        depth = np.arange(len(token)) - np.repeat(starts, length)
        places, index, keys, at = [], [], [], []
        mixed = token.copy()
        for k in range(1, order + 1):
            if k > 1:  # the n-gram before, one position on, with this token
                mixed[1:] = (mixed[:-1] + token[1:] * np.uint64(2 * k + 1)) * _STEP
                mixed ^= mixed >> np.uint64(29)
            place = np.flatnonzero(depth >= max(1, k - 1))
            found, first, inverse = np.unique(mixed[place], return_index=True, return_inverse=True)
            number = np.full(len(token), -1, np.int64)
            number[place] = inverse
            places.append(place), index.append(number), keys.append(found), at.append(place[first])
        return cls(starts, length, places, index, keys, at)

    def counts(self, learn: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram occurs in the texts to learn from."""
        chosen = np.repeat(learn, self.length)
        return [np.bincount(index[place], chosen[place], len(keys)).astype(np.int64)
                for place, index, keys in zip(self.places, self.index, self.keys)]


def word_chances(counts: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    """log10 of the chance of a word by its count, half an occurrence added to each word and to
    one unseen word."""
    return np.log10((counts + 0.5) / (tokens + 0.5 * (distinct + 1)))


@dataclass
class Automaton:
    """The states and arcs that a block of texts can reach.

    State 0 is no context, then come the n-grams of 1 to order - 1 tokens, and last the start of a
    text. ``arcs`` are state * words + word, ascending, with the weight of each and the state it
    leads to; a state that lacks an arc is left for ``fail_to`` at the cost of ``fail_weight``.
    State 0 has an arc for every word.
    """

    words: int
    start: int
    arcs: np.ndarray
    weight: np.ndarray
    leads_to: np.ndarray
    fail_to: np.ndarray
    fail_weight: np.ndarray

    @classmethod
    def of(cls, grams: Grams, counts: list[np.ndarray], tokens: int, distinct: int,
           prior: float) -> "Automaton":
        order, words = len(grams.keys), len(grams.keys[0])
        first = np.cumsum([1, *map(len, grams.keys[:order - 1])])
        start = int(first[-1])
        texts = counts[0][np.searchsorted(grams.keys[0], _END)]
        # A state is met as often as its tokens occur; the start as often as an end.
        seen = np.concatenate([[0], *counts[:order - 1], [texts]]).astype(np.float64)
        fail_to = np.concatenate([[0], *(
            np.zeros(words, np.int64) if k == 0 else first[k - 1] + grams.index[k - 1][grams.at[k]]
            for k in range(order - 1)), [0]]).astype(np.int64)
        chance = word_chances(counts[0], tokens, distinct)
        own = np.arange(words)
        parts = [(own, chance, np.where(counts[0] > 0, 1 + own, 0) if order > 1 else own * 0)]
        for k in range(1, order):
            at, shorter = grams.at[k], grams.index[k - 1]
            state = np.where(shorter[at - 1] >= 0, first[k - 1] + shorter[at - 1], start)
            chance = np.log10((counts[k] + prior * 10 ** chance[shorter[at]]) / (seen[state] + prior))
            after = first[k] + np.arange(len(at)) if k < order - 1 else first[k - 1] + shorter[at]
            learned = counts[k] > 0
            parts.append(((state * words + grams.index[0][at])[learned], chance[learned], after[learned]))
        arcs, weight, leads_to = map(np.concatenate, zip(*parts))
        ascending = np.argsort(arcs, kind="stable")
        return cls(words, start, arcs[ascending], weight[ascending], leads_to[ascending], fail_to,
                   np.log10(prior / (seen + prior)))

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states that words lead to, and the weights paid, failure arcs included."""
        state, paid = state.copy(), np.zeros(len(state))
        waiting = np.arange(len(state))
        while len(waiting):
            wanted = state[waiting] * self.words + word[waiting]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            found = self.arcs[at] == wanted
            there, missing = waiting[found], waiting[~found]
            paid[there] += self.weight[at[found]]
            state[there] = self.leads_to[at[found]]
            paid[missing] += self.fail_weight[state[missing]]
            state[missing] = self.fail_to[state[missing]]
            waiting = missing
        return state, paid

    def traverse(self, grams: Grams, order: int, lane: int = LANE) -> np.ndarray:
        """The weight paid for each position, every text from left to right.

        Long texts are cut into lanes that are walked abreast, each carrying its state. A lane
        begins order - 1 tokens before its own, from no context or the start of the text: that many
        tokens determine the state, and what they cost is paid by the lane before.
        """
        begin = np.concatenate([np.arange(s + 1, s + n, lane) for s, n in zip(
            grams.starts.tolist(), grams.length.tolist())])
        text = np.searchsorted(grams.starts, begin, "right") - 1
        end = np.minimum(begin + lane, (grams.starts + grams.length)[text])
        warm = np.maximum(begin - (order - 1), grams.starts[text])
        at_start = warm == grams.starts[text]
        warm = warm + at_start
        by_length = np.argsort(warm - end, kind="stable")
        begin, end, warm, at_start = (x[by_length] for x in (begin, end, warm, at_start))
        state = np.where(at_start, self.start, 0)
        lengths, paid = end - warm, np.zeros(len(grams.index[0]))
        for k in range(int(lengths.max(initial=0))):
            active = np.searchsorted(-lengths, -k, "left")
            place = warm[:active] + k
            state[:active], cost = self.step(state[:active], grams.index[0][place])
            own = place >= begin[:active]
            paid[place[own]] = cost[own]
        return paid


def score_texts(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
                order: int = ORDER, prior: float = PRIOR,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per text: key, learned, n_tokens, n_known, train_tokens, base_score, score.

    A-Z is lower-cased; tokens are words between space and U+0009 to U+000D, then one end. The
    model is learned from rows where ``learn`` holds (null: not). ``base_score`` takes words one
    by one, ``score`` follows the automaton; both are log10. n_known counts tokens seen in
    learning. A null text is empty, so its end is its only token. Rows with equal or null keys
    are kept apart, repeated rows count and are scored each; a long text is read by one task. No
    other column is looked at. An empty table gives no rows.
    """
    if order < 1 or prior <= 0:
        raise ValueError("order is at least 1, prior above 0")
    blocks = blocks_for(df, text, block_bytes)
    source = df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(learn, F.lit(False)).alias("learned"),
        F.col(f"`{text}`").alias("text"))
    texts = source.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)).cast("int"))
    borders = np.array([(i << 64) // blocks for i in range(1, blocks)], np.uint64)

    def grams_of(table) -> tuple[Grams, np.ndarray]:
        learned = table.column("learned").to_numpy(zero_copy_only=False).astype(bool)
        return Grams.of(table.column("text").to_pylist(), order), learned

    def send(table):
        import pyarrow as pa

        grams, learned = grams_of(table)
        block = table.column("block")[0].as_py()
        parts = [[] for _ in range(blocks)]
        for own, times in zip(grams.keys, grams.counts(learned)):
            cuts = np.searchsorted(own, borders)
            for part, keys, counts in zip(parts, np.split(own, cuts), np.split(times, cuts)):
                part.append((keys, counts))
        # One at least, so that every block is answered.
        parts = [(r, p) for r, p in enumerate(parts) if not r or any(len(keys) for keys, _ in p)]
        return pa.table({
            "range": pa.array([r for r, _ in parts], pa.int32()),
            "block": pa.array([block] * len(parts), pa.int32()),
            "keys": pa.array([[pack(k) for k, _ in p] for _, p in parts], pa.list_(pa.binary())),
            "counts": pa.array([[pack_numbers(c) for _, c in p] for _, p in parts],
                               pa.list_(pa.binary()))})

    def add(table):
        import pyarrow as pa

        answers, tokens, distinct = [], 0, 0
        sent = table.column("keys").to_pylist()
        times = table.column("counts").to_pylist()
        for k in range(order):
            keys = [unpack(s[k], np.uint64) for s in sent]
            every, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(place, np.concatenate([unpack_numbers(t[k]) for t in times]),
                               len(every)).astype(np.int64)
            if not k:
                tokens, distinct = int(sums.sum()), int((sums > 0).sum())
            answers.append([pack_numbers(sums[np.searchsorted(every, own)]) for own in keys])
        n = table.num_rows
        return pa.table({
            "range": table.column("range"), "block": table.column("block"),
            "counts": pa.array(list(map(list, zip(*answers))), pa.list_(pa.binary())),
            "tokens": pa.array([tokens] * n, pa.int64()),
            "distinct": pa.array([distinct] * n, pa.int64())})

    def score(table, answers):
        import pyarrow as pa

        grams, _ = grams_of(table)
        back = dict(zip(answers.column("range").to_pylist(), answers.column("counts").to_pylist()))
        counts = [np.concatenate([unpack_numbers(back[r][k]) for r in sorted(back)]).astype(np.int64)
                  for k in range(order)]
        tokens, distinct = (answers.column(c)[0].as_py() for c in ("all_tokens", "all_distinct"))
        paid = Automaton.of(grams, counts, tokens, distinct, prior).traverse(grams, order)
        single = np.zeros(len(paid))
        known = np.zeros(len(paid), np.int64)
        place, index = grams.places[0], grams.index[0]
        single[place] = word_chances(counts[0], tokens, distinct)[index[place]]
        known[place] = counts[0][index[place]] > 0

        def per_text(values):
            return pa.array(np.add.reduceat(values, grams.starts))

        return pa.table({
            "key": table.column("key"), "learned": table.column("learned"),
            "n_tokens": pa.array(grams.length - 1), "n_known": per_text(known),
            "train_tokens": pa.array([tokens] * table.num_rows, pa.int64()),
            "base_score": per_text(single), "score": per_text(paid)})

    sent = texts.groupBy("block").applyInArrow(
        send, "range int, block int, keys array<binary>, counts array<binary>")
    answers = sent.groupBy("range").applyInArrow(
        add, "range int, block int, counts array<binary>, tokens long, distinct long")
    per_range = answers.groupBy("range").agg(F.max("tokens").alias("t"), F.max("distinct").alias("d"))
    totals = per_range.agg(F.sum("t").alias("all_tokens"), F.sum("d").alias("all_distinct"))
    answers = answers.withColumn("one", F.lit(1)).join(
        F.broadcast(totals.withColumn("one", F.lit(1))), "one").drop("one", "tokens", "distinct")
    result = (T.StructType().add("key", source.schema["key"].dataType)
              .add("learned", T.BooleanType()).add("n_tokens", T.LongType())
              .add("n_known", T.LongType()).add("train_tokens", T.LongType())
              .add("base_score", T.DoubleType()).add("score", T.DoubleType()))
    return (texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, result)
            .withColumnRenamed("key", key))
