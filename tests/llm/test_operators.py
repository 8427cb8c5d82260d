"""Each training-data operator against brute force, and over its edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import (chat, decontam, html, lines, lm, mixing, quality, simhash, tokens,
                            toxicity)
from ledgerlake.llm.common import SHUFFLE_CLEANUP
from ledgerlake.llm.oracle import ORACLE
from ledgerlake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, spans int, items int, toxicity int, runs int, " \
       "fp int, row int, lang string, n_chars long"
LONG = " ".join(f"w{i % 997}x{i % 89}" for i in range(30_000))


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame(
        [(i, t, s, 1, 2, 3, 4, 5, 6, "en", 7) for i, t, s in rows], DOCS)


EDGE = [(1, None, "a"), (2, "", None), (3, "   \n\t ", "a"), (None, "one two three", "b"),
        (4, LONG, None), (5, LONG, "b"), (6, "same text here", "a"), (6, "same text here", "a"),
        (7, "x", "é"), (8, "Σωκράτης 你好 ok", "b")]


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def duck(name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    return sorted(tuple(sorted(zip(cols, r))) for r in cur.fetchall())


def rows(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


# 1 ---------------------------------------------------------------- line dedup

def test_line_dedup_equals_sql(spark):
    assert rows(QUERIES["op1_line_dedup"](spark, SF)) == duck("op1_line_dedup", "documents")


def test_line_dedup_edges(spark, edge, empty):
    assert lines.dedup_lines(empty).count() == 0
    got = lines.dedup_lines(edge).collect()
    assert len(got) == len(EDGE) and set(edge.columns) < set(got[0].asDict())
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text is None and by_id[1].line_counts.n_lines == 0
    assert by_id[4].text == LONG and by_id[5].text == ""  # the later copy goes
    assert by_id[3].text == "   \n\t " and by_id[None].text == "one two three"
    assert [r.text for r in got if r.doc_id == 6] == ["same text here"] * 2


def test_line_dedup_runs_of_lines(spark):
    run = "\n".join(f"shared line {i} " + "word " * 9 for i in range(6))
    other = "\n".join(f"own line {i} " + "blah " * 9 for i in range(6))
    d = frame(spark, [(1, f"begin\n{run}\nend", "a"), (2, f"{other}\n{run}\n\nlast", "a"),
                      (3, "shared line 0 " + "word " * 9, "a")])
    got = {r.doc_id: r for r in lines.dedup_lines(d).collect()}
    assert got[1].text == f"begin\n{run}\nend"
    assert got[2].text == f"{other}\n\nlast" and got[2].line_counts.n_removed == 6
    assert got[3].line_counts.n_removed == 0  # under min_words


def test_line_dedup_short_last_lines(spark):
    """A repeated run goes up to its last line, though no window begins there."""
    sixty, ten = "word " * 59 + "end", "ten " * 9 + "end"
    copy = "\n".join([sixty, ten, *(f"few words {i}" for i in range(4))])
    d = frame(spark, [(1, f"{sixty}\n{ten}", "a"), (2, f"{sixty}\n{ten}", "a"),
                      (3, f"{ten}\n{sixty}\n{ten}\nlast", "a"), (4, copy, "a"), (5, copy, "a")])
    got = {r.doc_id: r.text for r in lines.dedup_lines(d).collect()}
    assert got[1] == f"{sixty}\n{ten}" and got[2] == "" and got[3] == f"{ten}\nlast"
    assert got[4].split("\n") == copy.split("\n")[2:] and got[5] == ""


def test_line_dedup_equals_extended_matches(spark, documents):
    """Against pairs of equal lines, extended line by line both ways."""
    own = {i: [(n, x.strip(" \t\v\f\r")) for n, x in enumerate(t.split("\n")) if WORD.search(x)]
           for i, t in documents.items()}
    places = defaultdict(list)
    for i in sorted(own):
        for k, (_, x) in enumerate(own[i]):
            places[x].append((i, k))
    gone = defaultdict(set)
    for at in places.values():
        for p, (i, a) in enumerate(at):
            for j, b in at[p + 1:]:
                if a and b and own[i][a - 1][1] == own[j][b - 1][1]:
                    continue  # not the match's first line
                n = words = 0
                while (a + n < len(own[i]) and b + n < len(own[j])
                       and own[i][a + n][1] == own[j][b + n][1]):
                    words += len(WORD.findall(own[j][b + n][1]))
                    n += 1
                if words >= lines.MIN_WORDS:
                    lo, hi = own[j][b][0], own[j][b + n - 1][0]
                    gone[j].update(range(lo, hi + 1))
    assert gone
    for r in QUERIES["op1_line_dedup"](spark, SF).collect():
        kept = [x for n, x in enumerate(documents[r.doc_id].split("\n")) if n not in gone[r.doc_id]]
        assert (r.text or "") == "\n".join(kept), r.doc_id
        assert r.n_removed == len(gone[r.doc_id])


# 2 ------------------------------------------------------------- quality rules

def base_of(text):
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1
               for k in (i, i + 1, i + 2)}
    own = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(own) - len(set(own)), len(covered))


def test_quality_base_columns(spark, documents):
    for r in QUERIES["op2_quality_rules"](spark, SF).collect():
        want = base_of(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_learns_rules_and_is_native(spark):
    good = [" ".join(f"word{(i * 7 + k) % 301} and" for k in range(60)) for i in range(120)]
    bad = [t.replace("and", "###") for t in good]
    d = frame(spark, [(i, t, "a") for i, t in enumerate(good + bad)])
    labels = spark.createDataFrame([(i, int(i < 120), None) for i in range(0, 240)],
                                   "doc_id long, quality int, toxic int")
    out, rules = quality.judge(d, labels)
    assert rules and "Python" not in out._jdf.queryExecution().toString()
    got = {r.doc_id: r.kept for r in out.collect()}
    assert all(got[i] == (i < 120) for i in got)


def test_quality_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, None), (None, 0, 1)],
                                 "doc_id long, quality int, toxic int")
    assert quality.judge(empty, some)[0].count() == 0
    for labels in (none, some):
        got = quality.judge(edge, labels)[0].collect()
        assert len(got) == len(EDGE)
        assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                   in {base_of(t or "") for _, t, _ in EDGE} for r in got)


# 3 ---------------------------------------------------------------- LM scoring

def exact_scores(texts, train):
    tok = {i: t.encode().lower().split() + [b"\n"] for i, t in texts.items()}
    c = Counter(w for i in tok if train(i) for w in tok[i])
    n, v, d = sum(c.values()), len(c), lm.DISCOUNT
    pair, ctx, kinds = Counter(), Counter(), Counter()
    for i in tok:
        if train(i):
            for p, w in zip([None] + tok[i], tok[i]):
                pair[p, w] += 1
    for (p, _), m in pair.items():
        ctx[p] += m
        kinds[p] += 1
    out = {}
    for i, own in tok.items():
        base = score = 0.0
        for p, w in zip([None] + own, own):
            base += math.log10((c[w] + 1) / (n + v + 1))
            alone = (c[w] - d) / n if c[w] else d * v / n
            score += math.log10(alone if not ctx[p] else
                                max(pair[p, w] - d, 0) / ctx[p] + d * kinds[p] / ctx[p] * alone)
        out[i] = (len(own), sum(c[w] > 0 for w in own), n, base, score)
    return out


def test_lm_equals_exact_model(spark, documents):
    want = exact_scores(documents, lambda i: zlib.crc32(str(i).encode()) % 7 != 2)
    better = 0
    for r in QUERIES["op3_lm_scoring"](spark, SF).collect():
        n_tokens, n_known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n_tokens, n_known, total)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert abs(r.score - score) <= 0.05 * n_tokens  # quantised
        better += r.held_out and r.score > r.base_score
    assert better


def test_lm_splits_hot_contexts_exactly(spark):
    texts = {i: " ".join(f"the w{(i * 31 + k * 17) % 211}" for k in range(50)) for i in range(60)}
    want = exact_scores(texts, lambda i: i % 7 != 2)
    d = frame(spark, [(i, t, "a") for i, t in texts.items()])
    for r in lm.score(d, F.col("doc_id") % 7 != 2).collect():
        assert abs(r.score - want[r.doc_id][4]) <= 0.05 * r.n_tokens


def test_lm_edges(spark, edge, empty):
    assert lm.score(empty, F.lit(True)).count() == 0
    got = lm.score(edge, F.lit(True)).collect()
    assert len(got) == len(EDGE)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    none = lm.score(edge, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in none)


# 4 ------------------------------------------------------------------ toxicity

@pytest.fixture(scope="module")
def model():
    import numpy as np
    counts = np.zeros((28, 28, 28))
    words = ["idiot", "trash", "stupid", "reading", "nation", "other", "letter", "people"] * 40
    for w in words:
        c = [0, 0, *map(toxicity.letter_class, w), 0]
        for a, b, k in zip(c, c[1:], c[2:]):
            counts[a, b, k] += 1
    return toxicity.letter_model(counts)


@pytest.mark.parametrize("token,word", [
    ("1d10t", "idiot"), ("tr@sh", "trash"), ("stuuuupid", "stupid"), ("s.t.u.p.i.d", "stupid"),
    ("$tup1d!!", "stupid"), ("i d i o t", "idiot"), ("letter", "letter"), ("(nation),", "nation")])
def test_decoding(model, token, word):
    d = toxicity.Decoder(model)
    got = d.viterbi(token).split() if " " in token else d.restore(token)
    assert got == [word]


@pytest.fixture(scope="module")
def wide_model():
    import numpy as np
    counts = np.zeros((28, 28, 28))
    for w in ["idiot", "stupid", "ass", "hell", "clown", "reading", "nation", "other"] * 40:
        c = [0, 0, *map(toxicity.letter_class, w), 0]
        for a, b, k in zip(c, c[1:], c[2:]):
            counts[a, b, k] += 1
    return toxicity.letter_model(counts)


@pytest.mark.parametrize("text,word", [
    ("stuupid", "stupid"), ("iddiot", "idiot"), ("a$$", "ass"), ("he||", "hell"),
    ("(lown", "clown"), ("(idiot", "idiot"), ("idiot!!", "idiot"), ("hell", "hell"),
    ("st upid", "stupid"), ("id iot.", "idiot"), ("st up id", "stupid"), ("s tupid", "stupid"),
    ("st up1d", "stupid"), ("\"st upid\"", "stupid")])
def test_disguises_reach_the_decoder(wide_model, text, word):
    """Doubled letters, signs at a word's ends, and words of a few pieces."""
    scorer = toxicity.Scorer(wide_model, {word: 0.9}, 0.0)
    assert scorer(f"reading {text} nation") == pytest.approx(0.9)


def test_joins_follow_the_viterbi_path(wide_model):
    """Two signs on either side decide as the decoder does over both words."""
    d = toxicity.Decoder(wide_model)
    words = ["st", "upid", "id", "iot", "reading", "nation", "other", "stupid", "hel", "clown"]
    for x in words:
        for y in words:
            assert d.drops(f"{x[-2:]} {y[:2]}") == (d.viterbi(f"{x} {y}").count(" ") == 0)
    assert not d.drops("g, na")


LEETED = {"o": "0", "i": "1!", "s": "5$", "a": "4@", "e": "3", "t": "7+", "l": "1|", "c": "("}


def disguise(rng, word):
    out = []
    for c in word:
        c = rng.choice(LEETED[c]) if c in LEETED and rng.random() < .3 else c
        out.append(c * rng.choice([1, 1, 1, 2, 3]))
        if rng.random() < .15:
            out.append(rng.choice(".-*!1$"))
    return "".join(out)


def test_filter_never_rejects_what_the_decoder_finds(wide_model):
    """Scores of single tokens are those of decoding every token."""
    rng = random.Random(9)
    words = {"idiot": .5, "stupid": .6, "ass": .7, "hell": .4, "^clow": .3}
    s = toxicity.Scorer(wide_model, words, 0.0)
    pool = ["idiot", "stupid", "ass", "hell", "clowning", "reading", "nation", "assess", "shell"]
    found = 0
    for _ in range(3000):
        t = disguise(rng, rng.choice(pool)) + rng.choice(["", "", ".", "!!", ",", disguise(rng, "in")])
        want = [w for w in toxicity.features(s.decoder.restore(t)) if w in words]
        assert sorted(s._toxic_of(t)) == sorted(want), t
        found += bool(want)
    assert found > 500


def test_spelling_equals_all_paths(wide_model):
    """A word comes out of some path of the lattice exactly if the automaton says so."""
    d, spelling = toxicity.Decoder(wide_model), toxicity.Spelling(["ass", "hell", "lit"])

    def outputs(text, i=0):
        if i == len(text):
            yield ""
            return
        for letter, _ in d.choices(text, i):
            for rest in outputs(text, i + 1):
                yield letter + rest

    rng = random.Random(2)
    for _ in range(400):
        t = "".join(rng.choice("asheliat15$|. ") for _ in range(rng.randint(1, 7)))
        can = any(w in x for x in outputs(t) for w in ("ass", "hell", "lit"))
        assert not can or spelling.spells(t), t


def test_divided_words_of_any_length(wide_model):
    """No bound on the signs of a divided word, nor on the words beside it."""
    s = toxicity.Scorer(wide_model, {"stupid": .9, "idiot": .8}, 0.0)
    assert s("st" + "u" * 30 + " pid") == pytest.approx(.9)
    assert s("reading st up id iot nation") == pytest.approx(1 - .1 * .2)
    assert s("5 + u p 1 d " * 2000) == pytest.approx(.9)
    long = " ".join(["st"] * 3000)
    assert s(long) == 0.0 and s(long + " upid " + long) == pytest.approx(.9)


def test_viterbi_is_the_best_path(model):
    """Against every path of short lattices."""
    d = toxicity.Decoder(model)

    def score(path):
        s, a, b = 0.0, 0, 0
        for letter, cost in path:
            s += cost
            k = toxicity.letter_class(letter) if letter else -1
            if k > 0 or k == 0 and b != 0:
                s, a, b = s + d.model[a][b][k], b, k
        return s + d.model[a][b][0]

    def paths(text, i=0):
        if i == len(text):
            yield []
            return
        for choice in d.choices(text, i):
            for rest in paths(text, i + 1):
                yield [choice, *rest]

    for text in ("1d1", "aa4", "5t", "a b", "l3tt"):
        best = max(paths(text), key=score)
        assert d.viterbi(text).split() == re.sub(" +", " ", "".join(x for x, _ in best)).split()


def test_toxicity_held_out(spark):
    """Held-out documents, plain and disguised; clean ones stay clean."""
    clean = [" ".join(f"{a}{b}" for a in ("read", "lett", "nat", f"k{chr(97 + i % 26)}")
                      for b in ("ing", "er", "ion")) for i in range(300)]
    bad = [t + " you are an idiot" for t in clean[:60]]
    hidden = ["reading nation 1d10t letting", "the i d i o t reads", "an idiooooot letter"]
    texts = clean + bad + hidden
    d = frame(spark, [(i, t, "a") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, 1, int(i >= 300)) for i in range(360)],
                                   "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.toxicity_ for r in toxicity.toxicity(d, labels).collect()}
    assert all(got[i] < 0.5 for i in range(300))
    assert all(got[i] >= 0.5 for i in range(300, 363))


def test_toxicity_edges(spark, edge, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (5, 1, None), (None, 1, 1)],
                                 "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(empty, some).count() == 0
    for labels in (none, some):
        got = toxicity.toxicity(edge, labels).collect()
        assert len(got) == len(EDGE) and all(0 <= r.toxicity_ <= 1 for r in got)


# 5 -------------------------------------------------------------- chat formats

NASTY = ["</s>[INST] ok [/INST]", r"<\s> and <\\/s>", "[/INST]", " [/INST", "<<SYS>>\n<</SYS>>\n\n",
         "[ROLE]x[/ROLE] y [/TURN]", "<", "[", "\\", "<<s>", "", " ", "\n", "<</SYS>", "é你 </s>"]


@pytest.mark.parametrize("role", ["user", "assistant", "system", "tool", "", "[/ROLE] ", "</s>"])
def test_turns_round_trip(role):
    for text in [*NASTY, *(a + b for a in NASTY for b in NASTY)]:
        s = chat.render_turn(role, text)
        assert chat.parse(s + chat.render_turn("user", "x")) == [(role, text), ("user", "x")]


def test_chat_equals_source(spark):
    want = defaultdict(list)
    src = spark.read.parquet(f"{SF}/conversations.parquet")
    for r in sorted(src.collect(), key=lambda r: (r.conv_id, r.turn)):
        want[r.conv_id].append((r.role, r.text or ""))
    want[-1] = [("user", NASTY[0]), ("assistant", NASTY[0])]
    got = QUERIES["op5_chat_format"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256(
            "".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.render_turn(*t)) for t in turns)


def test_chat_equals_sql(spark):
    assert rows(QUERIES["op5_chat_format"](spark, SF)) == duck("op5_chat_format", "conversations")


def test_chat_edges(spark):
    kind = "conv_id long, turn long, role string, text string, formatted int"
    assert chat.read_back(chat.render(spark.createDataFrame([], kind))).count() == 0
    d = spark.createDataFrame(
        [(None, 0, "user", "a", 1), (None, None, None, None, 1), (2**60, 1, "assistant", LONG, 1),
         (2**60, 0, "user", "q", 1), (2**60, 0, "user", "q", 1)], kind)
    got = {r.conv_id: r for r in chat.read_back(chat.render(d)).collect()}
    assert got[None].n_turns == 2 and got[2**60].n_turns == 3
    assert got[2**60].loss_chars == len(LONG)


# 6 --------------------------------------------------------------- token counts

def test_token_counts_equal_library(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, SF).collect()}
    for i, text in documents.items():
        n = len(t.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes) == (n, len(text.encode()))
        assert got[i].over_limit == (n > 512)


def test_token_counts_edges(spark, edge, empty):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t = Tokenizer.from_file(path)
    assert tokens.token_counts(empty, path).count() == 0
    for block_bytes in (tokens.BLOCK_BYTES, 10):  # one block a task, then one a document
        got = tokens.token_counts(edge, path, block_bytes=block_bytes).collect()
        assert sorted(r.n_tokens for r in got) == sorted(
            len(t.encode(x or "").ids) for _, x, _ in EDGE)
    c = tokens.PieceCounter(path)
    for text in ("a<|endoftext|>b <|endoftext|>", "  lead", "x  \n\n  y\t", "don't we'll 12 345",
                 "<|endoftext|", "  　z", "🙂🙂 naïve", "\r\n", "1²³ á"):
        freq, n = c.cut(text)
        assert n + sum(k * m for k, m in zip(freq.values(), c.pieces(list(freq)))) == len(
            t.encode(text).ids)


def test_pieces_go_back_to_their_blocks(spark, edge):
    """Of all documents together, whatever batches its rows come in."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    own = tokens.blocks(edge.repartition(3), path, 10).select(
        "block", F.posexplode("vocab").alias("place", "piece"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    got = {(r.block, int(p)): int(n) for r in tokens.piece_counts(own, path).collect()
           for p, n in zip(tokens._unzip(r.places), tokens._unzip(r.n))}
    t = Tokenizer.from_file(path)
    rows = own.collect()
    assert len(got) == len(rows) and len({r.piece for r in rows}) < len(rows)
    assert all(got[r.block, r.place] == len(t.encode(r.piece).ids) for r in rows)


# Tasks of one Python worker, one after another; prints MB after a few and after all of them.
TASKS = """
import random, re, string, sys
import pyarrow as pa
from ledgerlake.llm import tokens

class Own:
    repartition = sortWithinPartitions = lambda self, *by: self
    mapInArrow = lambda self, run, kind: run

def mb():
    return int(re.search(r"RssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

draw, run = random.Random(1), tokens.piece_counts(Own(), sys.argv[1])
for task in range(12):
    made = [pa.RecordBatch.from_pydict({
        "block": [0] * 4000, "place": list(range(i, i + 4000)),
        "piece": ["".join(draw.choices(string.ascii_letters, k=9)) for _ in range(4000)]})
        for i in range(0, 20000, 4000)]
    assert sum(b.num_rows for b in run(iter(made))) == 1
    if task in (3, 11):
        print(mb())
"""


def test_pieces_of_more_tasks_take_no_more_memory():
    import subprocess
    import sys
    from pathlib import Path

    import public_tokenizers
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    out = subprocess.run([sys.executable, "-c", TASKS, path], check=True, capture_output=True,
                         text=True, cwd=Path(tokens.__file__).parents[2]).stdout
    few, many = map(float, out.split())
    assert many - few < 40, (few, many)


def test_places_of_a_document_rise_and_take_little(spark):
    import public_tokenizers
    draw = random.Random(3)
    words = [f"{draw.getrandbits(40):x}" for _ in range(20_000)]
    docs = frame(spark, [(i, " ".join(draw.choices(words, k=300)), "a") for i in range(400)])
    made = tokens.blocks(docs.coalesce(1), str(public_tokenizers.path("byte_bpe_50k.json")))
    [block] = made.collect()
    places, lo = tokens._unzip(block.places), 0
    for k in block.kinds:
        assert (places[lo + 1:lo + k] > places[lo:lo + k - 1]).all()
        lo += k
    assert lo == len(places) and set(places) == set(range(len(block.vocab)))
    assert len(block.places) < 1.25 * len(places)


@pytest.mark.parametrize("rising", [False, True])
@pytest.mark.parametrize("numbers", [[], [0], [5, 5, 0, 2**32 - 1, 0, 7], [1, 2, 300, 70_000]])
def test_zipped_numbers_come_back(numbers, rising):
    assert tokens._unzip(tokens._zip(numbers, rising)).tolist() == numbers


def test_shuffle_of_pieces_is_gone_when_blocks_are_joined(spark, edge):
    """Only rows that are still to be joined lie on disk; the session's setting is as before."""
    import public_tokenizers
    from pathlib import Path
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f.name for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP)
    docs = edge.repartition(3)
    assert docs.count() == len(EDGE)  # its own shuffle, and proof that files are seen
    assert files() - before
    before = files()
    got = tokens.token_counts(edge, str(public_tokenizers.path("byte_bpe_50k.json")))
    for _ in range(100):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert got.count() == len(EDGE)


# 7 ------------------------------------------------------------ decontamination

def test_decontamination_equals_sql(spark):
    assert rows(QUERIES["op7_decontamination"](spark, SF)) == duck(
        "op7_decontamination", "documents", "benchmark")


def test_decontamination_edges(spark, edge, empty):
    items = spark.createDataFrame(
        [(1, "One, two; THREE!"), (1, "x"), (2, None), (3, ""), (4, " ".join(LONG.split()[5:17])),
         (5, "two three"), (5, "two three"), (None, "x")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(empty, items).count() == 0
    assert {len(r.items_ or []) for r in decontam.find(edge, none).collect()} == {0}
    for limit in (1 << 20, 20):  # one block, then many
        got = {r.doc_id: r for r in decontam.find(edge, items, block_bytes=limit).collect()}
        assert got[None].items_ == ["1", "5"] and [tuple(s) for s in got[None].spans_] == [(0, 3)]
        assert got[4].items_ == got[5].items_ == ["4"] and got[1].items_ == []
        first = [tuple(s) for s in got[4].spans_][0]
        assert first == (5, 17) and got[4].n_words == 30_000
        assert got[7].items_ == ["1", "None"]


def test_wu_manber_equals_scan():
    import random
    rng = random.Random(5)
    for n in (1, 2, 3, 10):
        text = [rng.choice("abc") for _ in range(400)]
        pats = {tuple(x.encode() for x in text[k:k + n]) for k in rng.sample(range(380), 8)}
        t, = decontam.build([(b" ".join(p).decode(), b" ".join(p).decode()) for p in pats], n)
        raw = " ".join(text).encode()
        w = decontam.Words([raw, b"", raw], decontam.WORD_BYTES)
        got = sorted((at, tuple(x.encode() for x in p.split()))
                     for at, found in t.search(w) for p in found)
        want = sorted((at + d, tuple(x.encode() for x in text[at:at + n])) for d in (0, 400)
                      for at in range(400 - n + 1)
                      if tuple(x.encode() for x in text[at:at + n]) in pats)
        assert got == want


def test_wu_manber_tables_stay_small():
    """Of a block of items: its words' places and windows, not copies of their words."""
    import pickle
    text = " ".join(f"w{i * 7919 % 100_003}" for i in range(100_000))
    tables = decontam.build([(k, text[k * 5000:(k + 1) * 5000]) for k in range(len(text) // 5000)])
    assert len(pickle.dumps(tables, 5)) < 12 * len(text) + (1 << 23)


# 8 ----------------------------------------------------------------- SimHash

def slow_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), seed=42)
         for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, bits=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    own = sorted(fps)
    for i, a in enumerate(own):
        for b in own[:i]:
            if bin(a ^ b).count("1") <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_simhash_equals_brute_force(spark, documents):
    fps = {i: slow_fingerprint(t) for i, t in documents.items()}
    root = slow_components(set(fps.values()))
    least = {}
    for i, f in fps.items():
        least[root[f]] = min(i, least.get(root[f], i))
    for r in QUERIES["op8_simhash_dedup"](spark, SF).collect():
        assert r.fingerprint == format(fps[r.doc_id], "016x")
        assert r.component_id == least[root[fps[r.doc_id]]]


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_simhash_links_short_and_long_lists(spark, bits):
    import random
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])))
           for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)} | {0, 1, 2**63}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    from ledgerlake.llm.components import connected
    d = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = slow_components(fps, bits)
    groups = {frozenset(f for f in fps if want[f] == r) for r in set(want.values())}
    for most in (4, 1000):
        got = {r.node % 2**64: r.root for r in
               connected(simhash.links(d, bits, max_list=most)).collect()}
        by_root = defaultdict(set)
        for f in fps:
            by_root[got.get(f, ("own", f))].add(f)
        assert {frozenset(g) for g in by_root.values()} == groups


def test_simhash_edges(spark, edge, empty):
    assert simhash.components(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    got = [(r.doc_id, r.component_id) for r in simhash.components(edge).collect()]
    assert len(got) == len(EDGE)
    by_id = dict(got)
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[5] == 4 and by_id[None] is None
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8]


def test_keep_one_when_ids_repeat_across_groups(spark):
    d = frame(spark, [(5, "alpha beta gamma delta", "a"), (9, "alpha beta gamma delta", "a"),
                      (5, "one two three four five", "a"), (8, "one two three four five", "a")])
    got = sorted((r.doc_id, r.text) for r in simhash.keep_one(d).collect())
    assert got == [(5, "alpha beta gamma delta"), (5, "one two three four five")]


# 9 -------------------------------------------------------------- HTML extraction

def test_main_text_of_all_pages(spark):
    import html as h
    for r in QUERIES["op9_html_extraction"](spark, SF).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"(?s)<article>(.*?)(?:</article>|\Z)", r.html)[1]
        parts = [" ".join(h.unescape(re.sub("<[^>]*>", " ", p)).split())
                 for p in re.split(r"<p>|</p>|</?h1>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><style>a{}</style></head><body>
<header id=top><h1>Site</h1></header><ul class="main-menu"><li><a href=/a>Home</a><li><a>Back</a></ul>
<div class=content><h2>Head &amp;&nbsp; line</h2><p>First   para
with <a href=x>a link</a> and <b>bold</b>text.<p>Second one<br>goes on &lt;here&gt;.
<div class="cookie-notice">We use cookies on this site, please accept them all.</div>
<script>if (a < b) document.write("<p>no</p>")</script><p>Third.</p></div>
<aside>Popular posts of this week and the last</aside>
<div id="comments"><p>A reader says that this is a long and thoughtful comment.</p></div>
<form><p>Your mail address please, for our letters</p><input></form>
<footer>&copy; 2024</footer></body></html><!-- open"""


def test_extract_leaves_boilerplate_out():
    assert html.extract(PAGE) == ("Head & line\n\nFirst para with a link and boldtext.\n\n"
                                  "Second one goes on <here>.\n\nThird.")
    assert html.extract("") == "" and html.extract("<p") == ""
    assert html.extract("just some plain text") == "just some plain text"


def test_min_cut_is_minimal():
    import itertools
    import random
    rng = random.Random(1)
    for _ in range(60):
        n = rng.randint(1, 7)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = {(i, j): rng.uniform(0, 2) for i in range(n) for j in range(i) if rng.random() < .5}

        def cost(side):
            return (sum(max(0, -o) if s else max(0, o) for o, s in zip(odds, side))
                    + sum(c for (i, j), c in edges.items() if side[i] != side[j]))
        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert cost(html.min_cut(odds, edges)) == pytest.approx(best)


def test_min_cut_of_long_and_deep_pages():
    """Flows of all shortest paths at once, and no scan of the open elements per tag."""
    n = 20_000
    page = "<body>" + "".join(
        f"<p>text words here number {i} and some more words in it</p><p><a href=x>link {i} one</a></p>"
        for i in range(n // 2))
    begun = time.monotonic()
    assert html.extract(page).count("number") == n // 2
    odds = [6.0 if i % 500 == 0 else -0.01 for i in range(n)]  # flows that go far
    kept = html.min_cut(odds, {(i - 1, i): 0.4 for i in range(1, n)})
    assert kept[0] and not kept[250] and sum(kept) < n
    deep = "<div>" * n + "x" + "</div>" * n + "<span>" * 3000 + "<p>y y</p>" * 3000
    assert html.extract(deep).startswith("x\n\ny y\n\ny y")
    assert time.monotonic() - begun < 60


def test_html_edges(spark):
    kind = "page_id long, url string, html string, text int, n_chars string"
    d = spark.createDataFrame([(1, None, None, 1, "x"), (None, "u", "", 1, "x"),
                               (2, "u", "<p>" + LONG, 1, "x"), (2, "u", "<p>" + LONG, 1, "x")], kind)
    got = html.main_text(d).collect()
    assert sorted(r.n_chars for r in got) == [0, 0, len(LONG), len(LONG)]
    assert html.main_text(d.limit(0)).count() == 0


# 10 ------------------------------------------------------------------- mixing

def test_targets(spark):
    sizes = spark.createDataFrame([(None, 50), ("é", 10), ("z", 60), ("z", 40), ("a", 40)],
                                  "source string, size long")
    got = {s["source"]: s["target"] for s in mixing.source_targets(sizes).collect()}
    # weights a 5, z 2, é 1, null 5; none is over three times its size
    assert got == {"a": pytest.approx(200 * 5 / 13), "z": pytest.approx(200 * 2 / 13),
                   "é": pytest.approx(200 / 13), None: pytest.approx(200 * 5 / 13)}
    assert mixing.source_targets(sizes.limit(0)).count() == 0


def test_targets_of_many_capped_sources(spark):
    """Against resharing the excess source by source."""
    rng = random.Random(8)
    rows = [(f"s{i:04d}", rng.choice([0, 1, 3, 10, 1000])) for i in range(500)]
    size = dict(rows)
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(sorted(size))}
    want, free, left = {}, set(size), float(sum(size.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] > 3 * size[s]}
        if not over:
            want.update({s: unit * weight[s] for s in free})
            break
        want.update({s: 3.0 * size[s] for s in over})
        left -= sum(want[s] for s in over)
        free -= over
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(size.values()))


def test_draws_among_groups_of_sources(spark):
    """More sources than one group: each still gets its expectation, no shard more than its slots."""
    rows = [(i, f"s{i}", 3200 * (1 + i % 4), 3200.0 * (1 + i % 4)) for i in range(50)]
    sources = spark.createDataFrame(rows, "sid long, source string, source_size long, target double")
    runs = [mixing.draw_slots(sources, 32, shard_slots=200, group_sources=g) for g in (7, 1000)]
    for slots in runs:
        got = slots.groupBy("sid").count().collect()
        for r in got:
            assert r["count"] == pytest.approx(100 * (1 + r.sid % 4), rel=.2)
        assert len(got) == 50 and slots.count() == pytest.approx(12_450, rel=.02)
        assert sorted(slots.collect()) == sorted(slots.collect())
        # a round of a source has each of its blocks once
        assert slots.groupBy("sid", "epoch", "block").count().where("count > 1").count() == 0


def test_mixing_of_repeated_rows(spark):
    d = frame(spark, [(1, "one two three", "a")] * 300 + [(None, f"x{i} y", "b") for i in range(300)])
    got = mixing.mix_usage(spark, d).collect()
    assert len(got) == 600 and sum(r.size for r in got) == 1500
    mixed = mixing.mix_documents(spark, d).collect()
    assert sum(r.n_words for r in mixed) == sum(r.taken for r in got)


def test_permutation_is_one():
    import numpy as np
    for n in (1, 2, 3, 10, 1000, 4097):
        x = np.arange(n)
        y = mixing.permuted(x, np.full(n, n), np.full(n, 77, np.uint64))
        assert sorted(y) == list(range(n))


def test_mixing_query(spark, documents):
    got = QUERIES["op10_mixing"](spark, SF).collect()
    again = QUERIES["op10_mixing"](spark, SF).collect()
    assert sorted(got) == sorted(again) and len(got) == len(documents)
    by_target = defaultdict(int)
    for r in got:
        assert r.size == len(WORD.findall(documents[r.doc_id])) and 0 <= r.taken <= 3 * r.size
        by_target[r.source_size, r.target] += r.taken
    for (_, target), taken in by_target.items():
        assert taken == pytest.approx(target, rel=0.05)


def test_mix_blocks_are_the_texts_words(spark, documents):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    blocks = mixing.mix_documents(spark, d).collect()
    used = Counter()
    for r in blocks:
        assert len(r.text.split(" ")) == r.n_words <= mixing.BLOCK_WORDS
        own = " ".join(" ".join(WORD.findall(documents[i])) for i in r.doc_ids)
        assert r.text in own and r.epoch < 3
        used[r.source] += r.n_words
    want = Counter()
    for r in QUERIES["op10_mixing"](spark, SF).join(d.select("doc_id", "source"), "doc_id").collect():
        want[r.source] += r.taken
    assert used == want


def test_mixing_edges(spark, edge, empty):
    assert mixing.mix_usage(spark, empty).count() == 0
    assert mixing.mix_documents(spark, empty).count() == 0
    got = mixing.mix_usage(spark, edge).collect()
    assert len(got) == len(EDGE) and all(r.taken <= 3 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    blank = frame(spark, [(1, None, None), (2, "", "a")])
    assert {r.taken for r in mixing.mix_usage(spark, blank).collect()} == {0}
    taken = sum(r.taken for r in got)
    assert sum(r.n_words for r in mixing.mix_documents(spark, edge).collect()) == taken
