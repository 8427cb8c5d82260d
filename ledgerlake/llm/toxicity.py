"""Toxicity of texts whose words may be disguised: noisy-channel decoding, then scoring.

A disguised word is a lattice: a leetspeak sign may stand for letters, a
repeated letter or a sign may be an insertion, and a blank may be kept or
dropped. The Viterbi path under a trigram model of letters (counted over all
documents) and the channel's costs is the restored text. Words that consist of
letters, none doubled, have one path and need no decoding; each distinct other
token is decoded once per task. Signs that may stand for letters stay in the
lattice at a word's ends too. Of words with a doubled letter, and of words
within such signs, the plain reading counts beside the path. Whether the path
drops a blank hangs on the two signs on either side; where neighbouring words lose
theirs, each stretch of them that can spell a toxic word across a dropped blank is read as
a whole, beside its words, when a text is scored. Words themselves are learned
from undivided tokens, as chance neighbours that the path joins would be learned
as words otherwise.

When texts are scored, only what can spell a toxic word is decoded: the lattice
keeps every letter but repeated ones, so a word can come out only if its letters
follow each other in the token, with nothing but signs, blanks and repeated
letters between. One automaton over all toxic words (``Spelling``) tests that in
one pass. It never rejects what the decoder would find (tested), so scores are those of
decoding everything.

The toxicity of a word is learned from a bounded sample of labelled rows
(``sample_rows``). Copies are no evidence of their own: of the sampled rows
that share their least three-word shingle hash, one stands for all, with their
mean label. A word is kept if its share of toxic documents beats the base rate
by more than chance over all words tested. A document's score is a noisy-or
over its kept words above the rate of documents that have none.

Edge cases: null and empty texts score the base rate; a null label is no
label, a document labelled several times is toxic if any of its labels is;
repeated rows are scored alike; without toxic labels every score is the base
rate. Only doc_id and text (and labels' doc_id, toxic) are read, so extra
columns never clash; a null doc_id counts as the empty string in crc32.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerlake.llm.common import chunks, fresh, materialize, prepare, text_bytes

SAMPLE_ROWS = 20_000
FOLD, FOLDS = 0, 5
# Tokens whose decoding a task remembers; beyond it the memory starts anew.
MEMORY = 300_000
# Letters that a leetspeak sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
        "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
        "€": "e", "£": "l"}
SUBSTITUTE, INSERTED, SPLIT, BLANK_KEPT, BLANK_DROPPED, REPEATED = -1.0, -2.5, -3.0, -0.3, -1.5, -1.0
# A token of letters, perhaps in punctuation: one path through the lattice, itself.
PLAIN = re.compile(r"[^\W\d_]+")
TWICE, RUN = re.compile(r"(.)\1+"), re.compile(r"(.)\1\1")
# Words of letters between blanks that are dropped: joined, they are the path.
PIECES = re.compile(r"[^\W\d_]{2,}(?: [^\W\d_]{2,})+")
# Marks around a word that stand for no letter.
MARKS = re.compile(r"^[\"'\[{<*_~.,;:?#%&-]+|[\"')\]}<>*_~.,;:?#%&-]+$")
# Signs around a plain word: sentence marks, and any sign that is repeated.
EDGE = re.compile(r"^[\"'(\[{<*_~.,;:?#%&-]+|(?:[\"')\]}>*_~.,;:?!#%&-]|([#*$%&|<>@+!])\1+)+$")
CLASSES = 28
# Kinds of two signs at a word's end: a-z, leetspeak signs, another letter, another sign, a blank.
KINDS = (26 + len(LEET) + 3) ** 2
STEM = 4
# How much a word must beat the number of words tested, in nats: exp(-SURE) chance words.
SURE = 1.0


def letter_class(c: str) -> int:
    """0 a blank, 1-26 a-z, 27 anything else."""
    if c == " ":
        return 0
    return ord(c) - 96 if "a" <= c <= "z" else 27


_BYTE_CLASS = np.full(256, 27, np.uint8)
_BYTE_CLASS[97:123] = np.arange(1, 27)
_BYTE_CLASS[65:91] = np.arange(1, 27)
for _b in b" \t\n\x0b\x0c\r":
    _BYTE_CLASS[_b] = 0


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter-class trigrams over all texts; the driver gets 28^3 sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES ** 3, np.int64)
        for b in batches:
            texts = text_bytes(b.column("text"))
            for lo, hi in chunks(texts, 4 << 20):
                # every text between two blanks: no trigram spans texts
                c = _BYTE_CLASS[np.frombuffer(b"  " + b"  ".join(texts[lo:hi]) + b"  ", np.uint8)] \
                    .astype(np.int32)
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:],
                                     minlength=CLASSES ** 3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    rows = docs.select("text").mapInArrow(run, "k long, n long") \
        .groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(CLASSES ** 3)
    for k, n in rows:
        out[k] = n
    return out.reshape(CLASSES, CLASSES, CLASSES)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), trigrams smoothed by bigrams, those by letters."""
    uni = counts.sum((0, 1)) + 1.0
    uni /= uni.sum()
    two = counts.sum(0)
    bi = (two + 20 * uni) / (two.sum(1, keepdims=True) + 20)
    tri = (counts + 5 * bi[None]) / (counts.sum(2, keepdims=True) + 5)
    return np.log(tri)


class Decoder:
    """Restores tokens; ``model`` is the letter model."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def choices(self, text: str, i: int) -> list[tuple[str, float]]:
        """What the sign at i may have been: (letter, blank or nothing, log cost)."""
        c = text[i]
        if c == " ":
            return [(" ", BLANK_KEPT), ("", BLANK_DROPPED)]
        if c in LEET:
            out = [(x, SUBSTITUTE) for x in LEET[c]] + [("", INSERTED), (" ", SPLIT)]
        elif c.isalpha():
            out = [(c, 0.0)]
        else:
            return [("", BLANK_DROPPED), (" ", BLANK_KEPT + SUBSTITUTE)]
        if i and text[i - 1] == c:
            out.append(("", REPEATED))
        return out

    def viterbi(self, text: str) -> str:
        """The best path's letters and blanks."""
        # state: the last two classes; value: score, link to the path so far
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(text)):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for letter, cost in self.choices(text, i):
                k = letter_class(letter) if letter else -1
                for (a, b), (score, path) in states.items():
                    if k < 0:
                        s, to, p = score + cost, (a, b), path
                    elif k == 0 and b == 0:  # blanks do not pile up
                        s, to, p = score + cost, (a, b), path
                    else:
                        s, to, p = score + cost + self.model[a][b][k], (b, k), (letter, path)
                    if to not in new or s > new[to][0]:
                        new[to] = (s, p)
            states = new
        end = max(states.items(), key=lambda x: x[1][0] + self.model[x[0][0]][x[0][1]][0])
        out, path = [], end[1][1]
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out))

    def restore(self, token: str) -> list[str]:
        """The words of a lower-case token, or of several with blanks that the path drops."""
        if PLAIN.fullmatch(token) and not TWICE.search(token):
            return [token]
        if PIECES.fullmatch(token) and not TWICE.search(token):
            return [token.replace(" ", "")]
        if " " in token:
            return self.viterbi(token).split()
        out: dict[str, None] = {}
        for own in dict.fromkeys((MARKS.sub("", token), EDGE.sub("", token))):
            plain = PLAIN.fullmatch(own) and not RUN.search(own)
            if plain:
                out[own] = None
            if own and not (plain and not TWICE.search(own)):
                out.update(dict.fromkeys(self.viterbi(own).split()))
        return list(out)

    def drops(self, key: str) -> bool:
        """Whether the best path drops a blank, by two signs before it and two after."""
        x, y = key.split(" ")
        if not (x[-1] in LEET or x[-1].isalpha()) or not (y[0] in LEET or y[0].isalpha()):
            return False
        kept = dropped = -math.inf
        for own in product(*([(letter_class(k), SUBSTITUTE) for k in LEET.get(c, "")]
                             or [(letter_class(c), 0.0)] for c in (" " + x)[-2:] + (y + " ")[:2])):
            (a, b, c, d), cost = (k for k, _ in own), sum(v for _, v in own)
            m = self.model
            kept = max(kept, cost + BLANK_KEPT + m[a][b][0] + m[b][0][c] + m[0][c][d])
            dropped = max(dropped, cost + BLANK_DROPPED + m[a][b][c] + m[b][c][d])
        return dropped > kept


def features(words: list[str]) -> list[str]:
    """The words, and the beginnings of longer ones: variants of a word share theirs."""
    return words + ["^" + w[:STEM] for w in words if len(w) > STEM + 1]


def spaced(words: list[str]) -> list[str]:
    """Runs of three or more single signs, with their blanks."""
    if sum(len(w) == 1 for w in words) < 3:
        return []
    runs = []
    for single, run in groupby(words, key=lambda w: len(w) == 1):
        if single and len(own := list(run)) >= 3:
            runs.append(" ".join(own))
    return runs


class Restorer:
    """Distinct features of texts' restored tokens, with a bounded memory of them."""

    def __init__(self, model: np.ndarray):
        self.decoder, self.memory = Decoder(model), {}

    def __call__(self, text: str) -> set[str]:
        words = text.lower().split()
        tokens = {*words, *spaced(words)}
        if len(self.memory) > MEMORY:
            self.memory = {}
        known, out = self.memory, set()
        for t in tokens:
            r = known.get(t)
            if r is None:
                r = known[t] = features(self.decoder.restore(t))
            out.update(r)
        return out


class Spelling:
    """Which texts can spell one of some words, by one pass of a bit-parallel automaton.

    A bit stands for a letter of a word, set while the word's letters up to it follow each
    other. A sign moves on to letters that it may stand for, and may be skipped; a letter moves
    on to itself, and may be skipped where it repeats the one before.
    """

    def __init__(self, words: list[str]):
        letters = "".join(words)
        at = np.cumsum([0, *map(len, words)]).tolist()
        self.begins = [1 << a for a in at[:-1]]
        self.ends = [1 << (b - 1) for b in at[1:]]
        self.begin, self.end = sum(self.begins), sum(self.ends)
        self.bits: dict[str, int] = {}
        for i, c in enumerate(letters):
            self.bits[c] = self.bits.get(c, 0) | 1 << i
        self.every = (1 << len(letters)) - 1
        self.known: dict[str, tuple[int, int]] = {}

    def masks(self, c: str) -> tuple[int, int]:
        """(letters that c may be, letters after which c may be skipped)."""
        got = self.known.get(c)
        if got is None:
            own = self.bits.get(c, 0)
            if c in LEET:
                own = 0
                for x in LEET[c]:
                    own |= self.bits.get(x, 0)
                got = own, self.every
            elif c.isalpha():
                got = own, own
            else:
                got = 0, self.every
            if len(self.known) < MEMORY:
                self.known[c] = got
        return got

    def step(self, state: int, text: str, begin: int) -> tuple[int, bool]:
        """The state after a text, and whether a word was complete in it."""
        hit, masks, known = False, self.masks, self.known
        for c in text:
            own, stay = known.get(c) or masks(c)
            state = (state << 1 & ~self.begin | begin) & own | state & stay
            if state & self.end:
                hit = True
        return state, hit

    def spells(self, text: str) -> bool:
        return self.step(0, text, self.begin)[1]


class Scorer:
    """Scores of texts; each distinct token is looked at once in the memory's time."""

    def __init__(self, model: np.ndarray, words: dict[str, float], rest: float):
        self.decoder, self.words, self.rest = Decoder(model), words, rest
        self.whole = whole = [w for w in words if w[0] != "^"]
        # the stem of a longer word is the beginning of its letters
        self.spelling = Spelling(whole + [w[1:] for w in words if w[0] == "^"])
        self.stems = {w[1:] for w in words if w[0] == "^"}
        self.across_spelling = Spelling(whole)
        self.reverse = Spelling([w[::-1] for w in whole])
        # by the last two signs of a word and the first two of the next: is the blank dropped
        self.kinds: dict[str, int] = {}
        self.glue = np.full((KINDS, KINDS), -1, np.int8)
        self._forget()

    def _forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.toxic: dict[int, list[str]] = {}
        # states of the automaton after a word, and kinds of two signs, as they are met
        self.tails: dict[int, int] = {}
        self.two: dict[str, int] = {}
        size = 2 * MEMORY
        self.is_toxic, self.is_single = np.zeros(size, bool), np.zeros(size, bool)
        self.last, self.first = np.zeros(size, np.int32), np.zeros(size, np.int32)

    def _add(self, token: str) -> int:
        i = self.ids[token] = len(self.ids)
        if i == len(self.last):  # one text of very many words
            for name in ("is_toxic", "is_single", "last", "first"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        own = self._toxic_of(token)
        if own:
            self.toxic[i], self.is_toxic[i] = own, True
        if len(token) == 1:
            self.is_single[i] = True
        self.last[i], self.first[i] = self._kind((" " + token)[-2:]), self._kind((token + " ")[:2])
        return i

    def _toxic_of(self, token: str) -> list[str]:
        if PLAIN.fullmatch(token) and not TWICE.search(token):
            if token not in self.words and token[:STEM] not in self.stems:
                return []
            own = features([token])
        elif self.spelling.spells(token):
            own = features(self.decoder.restore(token))
        else:
            return []
        return [w for w in own if w in self.words]

    def _kind(self, two: str) -> int:
        """A number for two signs, as far as blanks beside them go."""
        got = self.two.get(two)
        if got is None:
            code = "".join(c if c == " " or c in LEET or "a" <= c <= "z" else
                           "\u00e0" if c.isalpha() else "." for c in two)
            got = self.two[two] = self.kinds.setdefault(code, len(self.kinds))
        return got

    def _dropped(self, ids: np.ndarray, words: list[str]) -> np.ndarray:
        """Places of words after which the path drops the blank."""
        last, first = self.last[ids[:-1]], self.first[ids[1:]]
        drop = self.glue[last, first]
        for i in np.flatnonzero(drop < 0).tolist():
            x, y = words[i], words[i + 1]
            drop[i] = self.glue[last[i], first[i]] = self.decoder.drops(x[-2:] + " " + y[:2])
        return np.flatnonzero(drop > 0)

    def __call__(self, text: str) -> float:
        if not self.words:
            return self.rest
        words = text.lower().split()
        if len(self.ids) > MEMORY:
            self._forget()
        ids = list(map(self.ids.get, words))
        if None in ids:
            for i, w in enumerate(words):
                if ids[i] is None:
                    own = self.ids.get(w)
                    ids[i] = self._add(w) if own is None else own
        at = np.array(ids, np.int64)
        found = {w for i in set(at[self.is_toxic[at]].tolist()) for w in self.toxic[i]}
        if self.is_single[at].sum() >= 3:
            for t in spaced(words):
                if self.spelling.spells(t):
                    found.update(w for w in features(self.decoder.restore(t)) if w in self.words)
        if len(words) > 1:
            found.update(self.across(words, ids, self._dropped(at, words), found.copy()))
        clean = 1.0 - self.rest
        for w in sorted(found):
            clean *= 1.0 - self.words[w]
        return 1.0 - clean

    def across(self, words: list[str], ids: list[int], dropped: np.ndarray,
               found: set[str]) -> Iterator[str]:
        """Toxic words beside ``found`` across dropped blanks (``dropped``: places before them).

        For each word that may end a toxic word begun before it, the shortest such stretch of
        words is decoded.
        """
        own, tails = self.across_spelling, self.tails
        ends, inner, known = own.end, ~own.begin, own.known
        left = {k for k, w in enumerate(self.whole) if w not in found}
        carry, last = 0, -2  # toxic words begun before word i, and still under way after it
        lo = 0
        for i in dropped.tolist():
            if i != last + 1:
                carry, lo = 0, i
            last = i
            tail = tails.get(ids[i])
            if tail is None:
                tail = tails[ids[i]] = own.step(0, words[i], own.begin)[0]
            carry |= tail
            ended = 0
            for c in words[i + 1] if carry else "":
                be, stay = known.get(c) or own.masks(c)
                carry = carry << 1 & inner & be | carry & stay
                if not carry:
                    break
                ended |= carry & ends
            if ended:
                for k in self._decoded(words, lo, i + 1, [
                        k for k in left if ended & own.ends[k]]):
                    left.discard(k)
                    yield self.whole[k]

    def _decoded(self, words: list[str], lo: int, j: int, ending: list[int]) -> list[int]:
        """Toxic words that the shortest stretch up to word j gives, of those that may end there."""
        back = self.reverse
        state, _ = back.step(0, words[j][::-1], sum(back.begins[k] for k in ending))
        for i in range(j - 1, lo - 1, -1):
            state, hit = back.step(state, words[i][::-1], 0)
            if hit:
                r = self.decoder.restore(MARKS.sub("", " ".join(words[i:j + 1])))
                return [k for k in range(len(self.whole)) if self.whole[k] in r]
            if not state:
                break
        return []


def least_shingle(text: bytes) -> int:
    """The least hash of the text's three-word shingles: near copies mostly share it."""
    w = text.lower().split()
    shingles = map(b" ".join, zip(w, w[1:], w[2:])) if len(w) > 2 else [b" ".join(w)]
    return min(map(xxhash.xxh64_intdigest, shingles)) >> 1


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == FOLD


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple:
    """(letter model, toxic words with their rates, rate of the other documents)."""
    model = letter_model(trigram_counts(docs))
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                         & ~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [least_shingle(t) for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("text"), b.column("toxic"), pa.array(own, pa.int64())],
                names=["text", "toxic", "copies"])

    # at most sample_rows ids: broadcast, so that the texts are not shuffled
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id")) \
        .select("text", F.col("toxic").cast("double").alias("toxic")).repartition(32) \
        .mapInArrow(group, "text string, toxic double, copies long")
    sample = materialize(rows.groupBy("copies").agg(
        F.min("text").alias("text"), (F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
        .select("text", "toxic").repartition(32), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(sent.value)
        for b in batches:
            bad, good = Counter(), Counter()
            for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                (bad if y else good).update(restore(t or ""))
            words = list(bad.keys() | good.keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([bad[w] for w in words], pa.int64()),
                 pa.array([good[w] for w in words], pa.int64())], names=["word", "bad", "good"])

    n, base = sample.agg(F.count("*"), F.avg(F.col("toxic").cast("double"))).first()
    if not n or not base or base >= 1:
        return model, {}, float(base or 0.0)
    stats = materialize(sample.mapInArrow(count, "word string, bad long, good long")
                        .groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
                        .where(F.col("bad") + F.col("good") >= 3), "toxic-words")
    tested = max(1, stats.count())
    m, bad, good = F.col("bad") + F.col("good"), F.col("bad"), F.col("good")
    gain = bad * F.log(bad / (m * base)) + F.when(
        good > 0, good * F.log(good / (m * (1 - base)))).otherwise(0.0)
    kept = stats.where((bad > m * base) & (gain > math.log(tested) + SURE)
                       & (bad > good)).collect()
    words = {r.word: (r.bad + 2 * base) / (r.bad + r.good + 2) for r in kept}

    def miss(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(sent.value, words, 0.0)
        for b in batches:
            clean = [score(t or "") == 0.0 for t in b.column("text").to_pylist()]
            y = b.column("toxic").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(clean)]), pa.array([sum(bool(v) for v, c in zip(y, clean) if c)])],
                names=["n", "bad"])

    free, bad_free = sample.mapInArrow(miss, "n long, bad long") \
        .agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    return model, words, (bad_free + base) / (free + 1.0)


def score(docs: DataFrame, fitted: tuple) -> DataFrame:
    """docs with the score in a column toxicity (``fresh`` where that name is taken)."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)
    name = fresh(docs.columns, "toxicity")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for b in batches:
            s = [min(1.0, max(0.0, scorer(t or ""))) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with toxicity, learned from ``labels`` outside the held-out fold."""
    prepare(docs.sparkSession)
    return score(docs, fit(docs, labels, sample_rows))
