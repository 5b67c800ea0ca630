"""Language identification by cross-parsing entropy.

Method: per language a suffix automaton is built over a bounded sample of labelled text.  A
document is parsed against each automaton into phrases, each the longest match of the
remaining text with any substring of the sample (and the symbol that ended it, if the sample lacks that); a language's code length is its phrases times
log2 of its sample's length (the bits that name a phrase).  The language with the
fewest bits per symbol wins.

Texts are lower-cased; each letter is one symbol and every run of other characters one space.
They are parsed in blocks of ``BLOCK`` symbols, a phrase ending with its block, so that
many blocks advance together through numpy: one step reads one symbol of every block
against every language.  Whole texts are parsed, whatever their length.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basket.llm.common import extend, filtered, text_crc

BLOCK = 2048
UNKNOWN = "und"
#: Symbol 0 is the space, 1 any letter that no sample has.
_SPACE, _OTHER = 0, 1


class SuffixAutomaton:
    """All substrings of a symbol sequence.

    ``next`` has a row of transitions per state by the symbols below ``size``, -1 where there is none; ``far`` lists
    those by any other symbol: (states, symbols, next states).
    """

    def __init__(self, symbols: np.ndarray, size: int):
        rows: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for s in symbols.tolist():
            new = len(rows)
            rows.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and s not in rows[p]:
                rows[p][s] = new
                p = link[p]
            if p >= 0:
                q = rows[p][s]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    clone = len(rows)
                    rows.append(rows[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and rows[p].get(s) == q:
                        rows[p][s] = clone
                        p = link[p]
                    link[q] = link[new] = clone
            last = new
        state = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        symbol = np.array([s for r in rows for s in r], np.int64)
        to = np.array([t for r in rows for t in r.values()], np.int64)
        near = symbol < size
        self.next = np.full((len(rows), size), -1, np.int32)
        self.next[state[near], symbol[near]] = to[near]
        self.far = state[~near], symbol[~near], to[~near]


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point, whether it is a letter (built once per Python worker)."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


class Model:
    """The automata of all languages in one transition table.

    Row ``state``, column ``symbol``: where the phrase goes on, the next row's offset; where it
    ends there, the complement of the row after starting a new phrase with that symbol.
    The table has ``columns`` columns at most, for the most frequent letters.  The transitions by all
    other letters of the samples are a sorted list of (state, symbol) ``keys`` with the next row's offset in ``targets``.
    """

    def __init__(self, samples: dict[str, str], columns: int = 46):
        self.languages = sorted(samples)
        counts: Counter[int] = Counter()
        for text in samples.values():
            points = _code_points(text)
            counts.update(points[_letter_table()[points]].tolist())
        order = sorted(counts, key=lambda c: (-counts[c], c))
        near, far = sorted(order[: columns - 2]), sorted(order[columns - 2 :])
        self.alphabet = near + far
        self.size, self.far = len(near) + 2, len(far)
        self._symbols = None
        tables, self.roots, self.bits, base = [], [], [], 0
        keys, targets = [], []
        #: Per language and far symbol, the row after starting a phrase with it.
        self.starts = np.zeros((len(self.languages), self.far), np.int32)
        for lang in self.languages:
            sequence = self.symbols(samples[lang])
            automaton = SuffixAutomaton(sequence, self.size)
            rows = automaton.next
            going = np.where(rows >= 0, (rows + base) * self.size, 0)
            root = np.where(rows[0] >= 0, (rows[0] + base) * self.size, base * self.size)
            tables.append(np.where(rows >= 0, going, ~root[None, :]).astype(np.int32))
            state, symbol, to = automaton.far
            offset = (to + base) * self.size
            self.starts[len(self.roots)] = base * self.size
            self.starts[len(self.roots), symbol[state == 0] - self.size] = offset[state == 0]
            keys.append((state + base) * self.far + symbol - self.size)
            targets.append(offset.astype(np.int32))
            self.roots.append(base * self.size)
            # A phrase of a tiny sample is no cheaper to name than a bare symbol.
            self.bits.append(math.log2(max(len(sequence), len(self.alphabet) + 2)))
            base += len(rows)
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        key, target = np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate([*targets, np.empty(0, np.int32)])
        order = np.argsort(key)
        # The last key is beyond any other, so that every search ends on one.
        self.keys = np.append(key[order], np.iinfo(np.int64).max)
        self.targets = np.append(target[order], np.int32(0))

    def __getstate__(self):
        return self.__dict__ | {"_symbols": None}

    def symbols(self, text: str) -> np.ndarray:
        """The text's symbols; empty if it has no letter."""
        if self._symbols is None:
            table = np.where(_letter_table(), _OTHER, _SPACE).astype(np.min_scalar_type(len(self.alphabet) + 2))
            for i, c in enumerate(self.alphabet):
                table[c] = i + 2
            self._symbols = table
        out = self._symbols[_code_points(text)]
        gap = out == _SPACE
        if gap.all():
            return out[:0]
        out = out[~(gap & np.concatenate(([True], gap[:-1])))]
        return out[:-1] if out[-1] == _SPACE else out

    def _far_steps(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """What ``table`` holds for other symbols, for the symbols without a column."""
        column = symbols.astype(np.int64) - self.size
        key = (state // self.size).astype(np.int64) * self.far + column
        place = np.searchsorted(self.keys, key)
        return np.where(self.keys[place] == key, self.targets[place], ~self.starts[:, column])

    def phrases(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Number of phrases of each sequence (rows) against each language (columns)."""
        langs = len(self.languages)
        owner, blocks = [], []
        for i, s in enumerate(sequences):
            for lo in range(0, len(s), BLOCK):
                owner.append(i)
                blocks.append(s[lo : lo + BLOCK])
        total = np.zeros((len(sequences), langs), np.int64)
        if not blocks or not langs:
            return total
        lengths = np.array([len(b) for b in blocks])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        steps = np.zeros((int(lengths[0]), len(blocks)), blocks[0].dtype)
        for lane, b in enumerate(order.tolist()):
            steps[: len(blocks[b]), lane] = blocks[b]
        beyond = steps >= self.size
        some = beyond.any(axis=1).tolist()
        near = np.where(beyond, _OTHER, steps).astype(np.uint8) if any(some) else steps
        active = np.searchsorted(-lengths, -np.arange(len(steps)), side="left")
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(blocks), axis=1)
        ended = np.zeros((langs, len(blocks)), np.int32)
        for t, k in enumerate(active.tolist()):
            at = self.table.take(state[:, :k] + near[t, :k])
            if some[t]:
                lanes = np.flatnonzero(beyond[t, :k])
                at[:, lanes] = self._far_steps(state[:, lanes], steps[t, lanes])
            over = at >> 31
            ended[:, :k] -= over
            state[:, :k] = at ^ over
        np.add.at(total, np.array(owner)[order], (ended + (state != roots)).T)
        return total

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score) of each text.

        The score is the softmax share of the winner at 16 symbols' worth of code length.
        """
        sequences = [self.symbols(t or "") for t in texts]
        lengths = np.array([len(s) for s in sequences])
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = self.phrases(sequences) * np.array(self.bits) / np.maximum(lengths, 1)[:, None]
        best = cost.argmin(axis=1)
        weight = np.exp2(-16 * (cost - cost.min(axis=1, keepdims=True)))
        score = np.where(lengths > 0, 1 / weight.sum(axis=1), 0.0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), lengths.tolist(), strict=True)], score


def training_sample(labelled: DataFrame, rows: int, chars: int) -> DataFrame:
    """At most ``rows`` (lang, text) rows of each language, by hash order; a text over ``chars`` characters gives a piece of that length.

    The piece lies where the text's hash says (from the first letter on, if there is none in it).  Equal texts or pieces
    count once; texts without a letter are left out.  A first count of the different ones sets a hash threshold per
    language that keeps somewhat more than enough, or all when they are few, so no language's rows are all gathered or sorted.
    """
    from pyspark.sql import Window

    text, letter = F.col("text"), r"\p{L}"
    start = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - chars, F.lit(0)) + 1) + 1
    drawn = text.substr(start.cast("int"), F.lit(chars))
    piece = F.when(drawn.rlike(letter), drawn).otherwise(text.substr(F.regexp_instr(text, F.lit(letter)), F.lit(chars)))
    fit = labelled.filter(F.col("lang").isNotNull() & text.isNotNull() & text.rlike(letter)).select("lang", piece.alias("text"))
    keyed = fit.withColumn("h", F.xxhash64("text"))
    # Within some per cent, which the factor of 8 below covers many times over.
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    # One row per language: small by nature.
    near = keyed.join(F.broadcast(counts), "lang").filter(share < F.lit(8.0 * rows) / F.col("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(share, "h", "text"))
    return near.dropDuplicates(["lang", "h", "text"]).withColumn("place", place).filter(F.col("place") <= rows).select("lang", "text")


def train(labelled: DataFrame, rows: int = 150, chars: int = 4000, symbols: int = 40_000) -> Model:
    """Fit on a bounded sample: ``rows`` texts or pieces of up to ``chars`` characters, ``symbols`` in all, per language.

    The sample (at most rows * chars characters a language) comes to the driver; the
    model has at most two states per symbol.
    """
    texts: dict[str, list[str]] = {}
    for r in training_sample(labelled, rows, chars).orderBy("lang", F.xxhash64("text"), "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    samples = {}
    for lang, own in texts.items():
        taken, size = [], 0
        for t in own:
            if size >= symbols:
                break
            taken.append(t)
            size += len(t)
        samples[lang] = "\n".join(taken)[:symbols]
    return Model(samples)


def _label(model):
    def function(batch: pa.RecordBatch) -> list[pa.Array]:
        langs, score = model.value.predict(batch.column("text").to_pylist())
        return [pa.array(langs, pa.string()), pa.array(score, pa.float64())]

    return function


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from ``text`` alone.

    A null text, or one without a letter, is ``und`` with score 0.  Ties go to the first language by
    name.  Repeated rows are labelled alike; columns of those names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return extend(docs, _label(shared), "lang_pred string, score double", limit=4 << 20)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(text_crc(doc_id) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.3, sure: float = 0.9) -> DataFrame:
    """The documents with a language: not ``und``, and a score of ``min_score`` or more; columns as in ``docs``.

    A ``lang`` column gets the language found where it is null, or where it says another and the score is ``sure`` or more;
    without that column nothing is written.
    """
    good = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)

    def identified(d: DataFrame) -> DataFrame:
        found = identify(d, model).filter(good)
        if "lang" not in d.columns:
            return found
        kept = F.col("lang").isNotNull() & ((F.col("lang") == F.col("lang_pred")) | (F.col("score") < sure))
        return found.withColumn("lang", F.when(kept, F.col("lang")).otherwise(F.col("lang_pred")))

    return filtered(docs, {"lang_pred", "score"}, identified)
