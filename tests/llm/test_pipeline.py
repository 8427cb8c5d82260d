"""The corpus pipeline: its stages against brute force, planted cases, edge cases."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerlake.llm import decontam, simhash, toxicity
from ledgerlake.llm.common import materialize, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def staged(spark):
    """(name, input rows, output frame) of each stage over the whole table."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        after = materialize(stage(spark, docs, SF), "stage")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns_of_documents(spark, staged):
    cols = table(spark, SF, "documents").columns
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "simhash", "decontamination",
                                       "mixing"]
    for _, _, after in staged[:-1]:
        assert after.columns == cols


def test_toxicity_stage_drops_the_toxic_alone(spark, staged):
    _, before, after = staged[0]
    scored = toxicity.toxicity(before, table(spark, SF, "labels"))
    want = {r.doc_id for r in scored.where("toxicity < 0.5").collect()}
    assert {r.doc_id for r in after.collect()} == want and after.count() == len(want)


def test_line_stage_deletes_only_repeats(spark, staged):
    _, before, after = staged[1]
    old = {r.doc_id: r for r in before.collect()}
    new = {r.doc_id: r for r in after.collect()}
    kept_lines = {x.strip() for r in new.values() for x in (r.text or "").split("\n")}
    for i, r in old.items():
        lines = [x.strip() for x in (r.text or "").split("\n") if x.strip()]
        assert all(x in kept_lines for x in lines)  # every line is still somewhere
        if i in new:
            left = iter(lines)
            assert all(x.strip() in left for x in new[i].text.split("\n") if x.strip())
            assert new[i].n_chars == len(new[i].text)


def test_simhash_stage_keeps_one_of_each_group(staged):
    _, before, after = staged[2]
    groups = {}
    for r in simhash.components(before).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(groups)


def test_decontamination_stage_equals_the_operator(spark, staged):
    _, before, after = staged[3]
    found = decontam.find(before, table(spark, SF, "benchmark"))
    assert {r.doc_id for r in after.collect()} == {
        r.doc_id for r in found.where(F.size("items") == 0).collect()}


def test_mix_holds_whole_blocks_of_the_kept(staged):
    _, before, after = staged[4]
    words = {r.doc_id: " ".join(WORD.findall(r.text or "")) for r in before.collect()}
    sizes, taken = {}, {}
    for r in before.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    for r in after.collect():
        assert r.text in " ".join(words[i] for i in r.doc_ids)
        taken[r.source] = taken.get(r.source, 0) + r.n_words
    assert sum(taken.values()) == pytest.approx(sum(sizes.values()), rel=0.05)
    assert all(taken[s] <= 3 * sizes[s] for s in taken)


def test_planted_cases(spark):
    """Copies, a near copy, a shared passage, a benchmark passage and a toxic text."""
    rng = random.Random(9)
    new = lambda n: " ".join("".join(rng.choice("bdklmnprt") + rng.choice("aeiou")
                                     for _ in range(3)) for _ in range(n))
    sf = "/root/testdata/sf0.01"  # enough labels to learn the toxic words
    docs = table(spark, sf, "documents")
    base = 10_000_000
    long, passage = new(3000), new(70)
    near = long.split()
    near[200] = "changed"
    item = max((r.text for r in table(spark, sf, "benchmark").collect()), key=len)
    rows = {0: long, 1: long, 2: " ".join(near), 3: f"{new(120)}\n{passage}\n{new(90)}",
            4: f"{new(150)}\n{passage}\n{new(80)}", 5: f"{new(60)} {item} {new(60)}",
            6: f"{new(40)} idiot {new(40)} scum {new(40)} worthless trash {new(30)}",
            7: new(200), 8: new(90)}
    planted = spark.createDataFrame(
        [(base + i, t, "en", "src1", len(t)) for i, t in rows.items()], docs.schema)
    both = docs.unionByName(planted)
    at = both
    for _, stage in P.STAGES[:-1]:
        at = stage(spark, at, sf)
    left = {r.doc_id - base: r.text for r in at.where(F.col("doc_id") >= base).collect()}
    assert set(left) == {0, 3, 4, 7, 8}
    assert passage in left[3] and passage not in left[4]
    assert left[7] == rows[7] and left[8] == rows[8]


def test_edge_tables(spark):
    docs = table(spark, SF, "documents")
    none = docs.limit(0)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0),
         (2, None, "en", None, 5), (3, "few words here", "en", "a", 14),
         (3, "few words here", "en", "a", 14)], docs.schema)
    for rows, most in ((none, 0), (odd, 3)):
        at = rows
        for _, stage in P.STAGES[:-1]:
            at = stage(spark, at, SF)
            assert at.columns == docs.columns
        kept = at.collect()
        assert len(kept) <= max(most, 0) and (most == 0 or len(kept) >= 2)
        mixed = P.mix_sources(spark, at, SF)
        assert sum(r.n_words for r in mixed.collect()) == (3 if most else 0)


def test_run_writes_every_stage(spark, staged):
    assert P.run(spark, SF).count() == staged[-1][2].count()
